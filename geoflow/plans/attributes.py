"""Queries on attributes: field edits, filters, routing, key joins, counts, previews, user code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_text, parse_coord, parse_epsg
from ..operators import code, fields, filters, joins, preview, routing
from ..operators.lineage import scratch_path
from ..operators.profile import StepCounts, infer_crs, layer_profile
from ..functions.crs import reproject
from ..sources.sinks import append_log
from . import layers as L
from .layers import table
from .registry import query

# --- field edits ---------------------------------------------------------------------------


@query("fields_rename", "select c_custkey client_id, c_name client, c_nationkey, c_acctbal, c_mktsegment from customer")
def fields_rename(spark: SparkSession, sf: str) -> DataFrame:
    ops = [
        {"op": "rename", "from": "c_custkey", "to": "client_id"},
        {"op": "rename", "from": "c_name", "to": "client"},
        {"op": "rename", "from": "c_acctbal", "to": "c_acctbal"},
        {"op": "rename", "from": "c_mktsegment", "to": ""},
    ]
    return fields.edit_fields(table(spark, sf, "customer"), ops)


@query("fields_delete", "select c_custkey, c_nationkey, c_mktsegment from customer")
def fields_delete(spark: SparkSession, sf: str) -> DataFrame:
    ops = [{"op": "delete", "name": "c_name"}, {"op": "delete", "name": "c_acctbal"}]
    return fields.edit_fields(table(spark, sf, "customer"), ops)


@query(
    "fields_create",
    """select o_orderkey, o_totalprice, round(o_totalprice * 1.2e0, 4) gross, 'VALID' status,
       o_orderstatus = 'F' closed from orders""",
)
def fields_create(spark: SparkSession, sf: str) -> DataFrame:
    ops = [
        {"op": "create", "name": "gross", "expr": "round(o_totalprice * 1.2e0, 4)"},
        {"op": "create", "name": "status", "value": "VALID"},
        {"op": "create", "name": "closed", "expr": "o_orderstatus = 'F'"},
    ]
    return fields.edit_fields(table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), ops).drop(
        "o_orderstatus"
    )


@query(
    "fields_keep",
    "select s_suppkey, s_name label, s_nationkey, round(s_acctbal / 2e0, 6) half_balance from supplier",
)
def fields_keep(spark: SparkSession, sf: str) -> DataFrame:
    ops = [
        {"op": "rename", "from": "s_name", "to": "label"},
        {"op": "create", "name": "half_balance", "expr": "round(s_acctbal / 2e0, 6)"},
        {"op": "delete", "name": "s_acctbal"},
    ]
    return fields.edit_fields(table(spark, sf, "supplier"), ops)


@query(
    "counter",
    """select o_orderkey, o_orderpriority,
       CAST(100 + 5 * (row_number() over (partition by o_orderpriority order by o_orderkey) - 1) AS BIGINT) seq,
       CAST(row_number() over (order by o_orderkey) AS BIGINT) line_no from orders""",
)
def counter(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    numbered = fields.add_counter(df, "seq", "o_orderkey", 100, 5, ["o_orderpriority"])
    return fields.add_counter(numbered, "line_no", "o_orderkey")


@query(
    "map_values",
    """select c_custkey, case c_mktsegment when 'BUILDING' then 'construction' when 'MACHINERY' then 'industry'
       else c_mktsegment end sector, n.n_name nation from customer left join nation n on n_nationkey = c_nationkey""",
)
def map_values(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.col("c_nationkey").cast("string").alias("nation"))
    coded = fields.map_values(df, "c_mktsegment", {"BUILDING": "construction", "MACHINERY": "industry"}, "sector")
    names = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("key"), "n_name")
    return fields.map_values(coded, "nation", names).drop("c_mktsegment")


@query(
    "list_explode",
    """select doc_id, CAST(i - 1 AS INT) item_index, l[CAST(i AS INT)] item from (
         select doc_id, string_split(text, chr(10)) l, unnest(generate_series(1, len(string_split(text, chr(10))))) i
         from documents)""",
)
def list_explode(spark: SparkSession, sf: str) -> DataFrame:
    lists = table(spark, sf, "documents").select("doc_id", F.split("text", "\n", -1).alias("lines"))
    return fields.explode_list(lists, "lines")


@query(
    "normalize_names",
    """select p_partkey p_part_key, p_name p_name_text,
       regexp_replace(lower(trim(p_name)), '[\\s._-]+', '_', 'g') slug from part""",
)
def normalize_names(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "part").select(
        F.col("p_partkey").alias(" P Part-Key"), F.col("p_name").alias("P. Name__Text"), normalize_text("p_name").alias("Slug")
    )
    return fields.normalize_columns(df)


# --- filters -------------------------------------------------------------------------------


@query("filter_equals", "select c_custkey, c_name from customer where c_mktsegment = 'BUILDING'")
def filter_equals(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_rows(table(spark, sf, "customer"), "c_mktsegment", "equals", "BUILDING").select("c_custkey", "c_name")


@query("filter_contains", "select p_partkey, p_type from part where regexp_matches(p_type, '(?i)s(t|m)[a-l]')")
def filter_contains(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_rows(table(spark, sf, "part"), "p_type", "like", "s(t|m)[a-l]").select("p_partkey", "p_type")


@query(
    "filter_not_equals",
    """select c_custkey, nullif(c_nationkey, 5) nation from customer
       where CAST(nullif(c_nationkey, 5) AS VARCHAR) is distinct from '3'""",
)
def filter_not_equals(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "customer").selectExpr("c_custkey", "nullif(c_nationkey, 5) nation")
    return filters.filter_rows(df, "nation", "!=", 3)


@query(
    "search_any",
    """select c_custkey, c_name, c_mktsegment from customer
       where contains(lower(c_name), 'mer#0000000') or contains(lower(c_mktsegment), 'mach')
          or contains(CAST(c_custkey AS VARCHAR), 'mach')""",
)
def search_any(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    by_name = filters.search_any(df, "MER#0000000")
    return by_name.union(filters.search_any(df, " Mach ")).distinct()


# --- routing -------------------------------------------------------------------------------


@query("split_by_value", "select l_orderkey, l_linenumber, l_returnflag port from lineitem")
def split_by_value(spark: SparkSession, sf: str) -> DataFrame:
    routed = routing.split_by_value(table(spark, sf, "lineitem"), "l_returnflag")
    return routed.select("l_orderkey", "l_linenumber", "port")


@query(
    "tester",
    """select o_orderkey, case when nullif(o_orderstatus, 'P') = 'F' and o_totalprice > 100000 then 'passed'
       else 'failed' end port from orders""",
)
def tester(spark: SparkSession, sf: str) -> DataFrame:
    passes = F.expr("nullif(o_orderstatus, 'P') = 'F' and o_totalprice > 100000")
    return routing.tester(table(spark, sf, "orders"), passes).select("o_orderkey", "port")


@query(
    "test_filter",
    """select o_orderkey, case when o_totalprice > 300000 then 'output1' when o_orderpriority like '1%' then 'output2'
       when o_orderstatus = 'O' then 'output3' else 'else' end port from orders""",
)
def test_filter(spark: SparkSession, sf: str) -> DataFrame:
    conditions = [F.expr(c) for c in ("o_totalprice > 300000", "o_orderpriority like '1%'", "o_orderstatus = 'O'")]
    return routing.switch(table(spark, sf, "orders"), conditions).select("o_orderkey", "port")


@query(
    "geometry_filter",
    """select CAST(c_custkey AS BIGINT) id, 'sites' origin, case when c_acctbal < 0 then 'null' else 'point' end port from customer
       union all select o_orderkey, 'streets', 'line' from orders
       union all select p_partkey, 'parcels', case when p_partkey % 3 = 0 then 'multipolygon' else 'polygon' end from part""",
)
def geometry_filter(spark: SparkSession, sf: str) -> DataFrame:
    sites = L.sites(spark, sf).selectExpr("site_id id", "'sites' origin", "if(c_acctbal < 0, null, geom) geom")
    streets = L.streets(spark, sf).selectExpr("street_id id", "'streets' origin", "geom")
    parcels = L.parcels(spark, sf).selectExpr(
        "parcel_id id",
        "'parcels' origin",
        "named_struct('type', if(parcel_id % 3 = 0, 'MultiPolygon', geom.type), 'parts', geom.parts) geom",
    )
    return routing.geometry_filter(sites.union(streets).union(parcels)).select("id", "origin", "port")


@query(
    "duplicate_filter",
    """select event_id, case when row_number() over (partition by user_id, event_type order by event_id) = 1
       then 'unique' else 'duplicate' end port from events""",
)
def duplicate_filter(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return routing.duplicate_filter(df, ["user_id", "event_type"], "event_id").select("event_id", "port")


@query(
    "duplicate_filter_ties",
    """select event_id, case when row_number() over (partition by user_id order by date_trunc('hour', ts) nulls last, event_id) = 1
       then 'unique' else 'duplicate' end port from events""",
)
def duplicate_filter_ties(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").select("event_id", "user_id", F.date_trunc("hour", "ts").alias("hour"))
    return routing.duplicate_filter(df, ["user_id"], ["hour", "event_id"]).select("event_id", "port")


@query(
    "rejected_rows",
    """select event_id, case when k is null then 'no number' when k > 50 then 'out of range' end reject_reason
       from (select event_id, try_cast(regexp_extract(props, '"k": *([0-9]+)', 1) AS INT) k,
             event_id % 7 = 0 broken from events) where not broken
       union all select event_id, 'no number' from events where event_id % 7 = 0""",
)
def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").selectExpr(
        "event_id", "try_cast(if(event_id % 7 = 0, 'abc', get_json_object(props, '$.k')) as int) k"
    )
    checked = routing.reject_where(df, {"no number": F.col("k").isNull(), "out of range": F.col("k") > 50})
    good, bad = routing.split_rejected(checked)
    return good.selectExpr("event_id", "cast(null as string) reject_reason").union(bad.select("event_id", "reject_reason"))


# --- joins by key --------------------------------------------------------------------------

_JOIN_SQL = """
with c as (select nullif(c_custkey, 2) k, c_mktsegment tag from customer),
     o as (select nullif(o_custkey, 1) k, o_orderstatus tag, o_orderkey from orders)
select coalesce(c.k, o.k) k, c.tag tag_x, o.tag tag_y, o.o_orderkey from c full join o on c.k is not distinct from o.k
"""


@query("join_keys", _JOIN_SQL)
def join_keys(spark: SparkSession, sf: str) -> DataFrame:
    left = table(spark, sf, "customer").selectExpr("nullif(c_custkey, 2) k", "c_mktsegment tag")
    right = table(spark, sf, "orders").selectExpr("nullif(o_custkey, 1) k", "o_orderstatus tag", "o_orderkey")
    return joins.join_keys(left, right, ["k"], "outer")


@query(
    "feature_merge",
    """with r as (select nullif(o_custkey, 7) - 5 k, o_orderkey from orders), s as (select c_custkey k, c_name from customer)
       select coalesce(r.k, s.k) k, o_orderkey, c_name, case when s.k is null then 'unmerged_request'
         when o_orderkey is null then 'unmerged_supplier' else 'merged' end port from r full join s on r.k = s.k""",
)
def feature_merge(spark: SparkSession, sf: str) -> DataFrame:
    request = table(spark, sf, "orders").selectExpr("nullif(o_custkey, 7) - 5 k", "o_orderkey")
    supplier = table(spark, sf, "customer").selectExpr("c_custkey k", "c_name")
    return joins.feature_merge(request, supplier, ["k"])


# --- counts, profiles, previews ------------------------------------------------------------

_STEP_SQL = """
select 1 "position", 'read' step, count(*) row_count from customer
union all select 2, 'in credit', count(*) from customer where c_acctbal >= 0
union all select 3, 'building', count(*) from customer where c_acctbal >= 0 and c_mktsegment = 'BUILDING'
"""


def _counted_flow(spark: SparkSession, sf: str) -> dict[str, int]:
    steps = StepCounts()
    read = steps.watch(table(spark, sf, "customer"), "read")
    credit = steps.watch(read.where("c_acctbal >= 0"), "in credit")
    building = steps.watch(filters.filter_rows(credit, "c_mktsegment", "=", "BUILDING"), "building")
    building.write.format("noop").mode("overwrite").save()
    return steps.result()


@query("row_counts", _STEP_SQL)
def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = _counted_flow(spark, sf)
    rows = [(i, step, n) for i, (step, n) in enumerate(counts.items(), start=1)]
    return spark.createDataFrame(rows, "position int, step string, row_count bigint")


@query("sink_log", f"select 'credit check' flow, \"position\", step, row_count from ({_STEP_SQL})")
def sink_log(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "log")
    append_log(spark, path, "credit check", _counted_flow(spark, sf))
    return spark.read.schema("flow string, position int, step string, row_count bigint").json(path)


_MERCATOR = "6378137e0 * radians({lon})", "6378137e0 * ln(tan(pi() / 4 + radians({lat}) / 2))"


@query(
    "layer_profile",
    f"""select count(*) feature_count, 'EPSG:3857' crs, 'site_id,c_mktsegment' "columns", 'Point' geometry_types,
       round(min(lon), 6) wgs84_xmin, round(min(lat), 6) wgs84_ymin, round(max(lon), 6) wgs84_xmax, round(max(lat), 6) wgs84_ymax,
       round(min(x), 3) native_xmin, round(min(y), 3) native_ymin, round(max(x), 3) native_xmax, round(max(y), 3) native_ymax
       from (select lon, lat, {_MERCATOR[0].format(lon='lon')} x, {_MERCATOR[1].format(lat='lat')} y from sites)""",
    layers=("sites",),
)
def layer_profile_(spark: SparkSession, sf: str) -> DataFrame:
    layer = reproject(L.sites(spark, sf).select("site_id", "c_mktsegment", "geom"), 3857)
    p = layer_profile(layer)
    digits = {c: 6 if c.startswith("wgs84") else 3 for c in p.columns if c.startswith(("wgs84", "native"))}
    return p.select(*[F.round(c, digits[c]).alias(c) if c in digits else c for c in p.columns])


_CRS_CASES = {
    "degrees": ("lon", "lat"),
    "national": ("lon * 10000 + 600000", "lat * 10000 + 6000000"),
    "mercator": ("lon * 1000000", "lat * 100000"),
    "local": ("lon * 1000", "lat * 1000"),
    "mixed": ("case when site_id % 10 = 0 then 1e7 else lon end", "lat"),
}
_CRS_SQL = " union all ".join(
    f"""select '{name}' layer, median(x) mx, median(y) my, max(abs(x)) fx, max(abs(y)) fy, count(*) parsed
        from (select {x} x, {y} y from sites)"""
    for name, (x, y) in _CRS_CASES.items()
)


@query(
    "infer_crs",
    f"""select layer, parsed, case when abs(mx) <= 180 and abs(my) <= 90 and fx <= 180 and fy <= 90 then 4326
          when mx > 100000 and mx < 1300000 and my > 6000000 and my < 7500000 then 2154
          when greatest(abs(mx), abs(my)) > 1000000 then 3857 else 4326 end srid from ({_CRS_SQL})""",
    layers=("sites",),
)
def infer_crs_(spark: SparkSession, sf: str) -> DataFrame:
    sites = L.layer_table(spark, sf, "sites")
    out = None
    for name, (x, y) in _CRS_CASES.items():
        one = infer_crs(sites.selectExpr(f"{x} x", f"{y} y"), "x", "y").select(F.lit(name).alias("layer"), "parsed", "srid")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "preview_rows",
    """select o_orderkey, o_custkey, o_orderstatus, (select count(*) from orders) total from orders
       order by o_orderkey limit 50""",
)
def preview_rows(spark: SparkSession, sf: str) -> DataFrame:
    return preview.preview_rows(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "o_orderkey")


@query(
    "preview_features",
    """select street_id, 'LineString' _geom, round(x1, 6) x1, round(y2, 6) y2, (select count(*) from orders) total,
       (select count(*) from orders) > 2500 truncated from streets order by street_id limit 2500""",
    layers=("streets",),
)
def preview_features(spark: SparkSession, sf: str) -> DataFrame:
    shown = preview.preview_features(L.streets(spark, sf).select("street_id", "geom"), "street_id")
    # the two GeoJSON texts are equal for a layer in longitude/latitude
    return shown.where("geojson = map_geojson").selectExpr(
        "street_id", "_geom",
        "round(double(get_json_object(map_geojson, '$.coordinates[0][0]')), 6) x1",
        "round(double(get_json_object(map_geojson, '$.coordinates[1][1]')), 6) y2",
        "total", "truncated",
    )


@query(
    "page_rows",
    """select * from (select 'after' page, o_orderkey, o_totalprice from orders where o_orderkey > 700 order by o_orderkey limit 200)
       union all select * from (select 'skip', o_orderkey, o_totalprice from orders order by o_orderkey limit 50 offset 100)""",
)
def page_rows(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    after = preview.page_rows(df, "o_orderkey", 200, after=700).select(F.lit("after").alias("page"), "*")
    skip = preview.page_rows(df, "o_orderkey", 50, page=3).select(F.lit("skip").alias("page"), "*")
    return after.union(skip)


# --- values --------------------------------------------------------------------------------


@query(
    "parse_coord",
    """select c_custkey, case c_custkey % 5 when 0 then null when 1 then 650000.5e0 when 2 then c_custkey + 0.25e0
       when 3 then CAST(c_custkey AS DOUBLE) else null end coord from customer""",
)
def parse_coord_(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "customer").selectExpr(
        "c_custkey",
        "case c_custkey % 5 when 0 then 'abc' when 1 then ' 650 000,5' when 2 then concat(c_custkey, ',25')"
        " when 3 then concat(c_custkey, ' ') else '' end raw",
    )
    return df.select("c_custkey", parse_coord("raw").alias("coord"))


@query(
    "parse_epsg",
    """select c_custkey, case c_custkey % 4 when 0 then 2154 when 1 then CAST(3945 + c_custkey % 2 AS INT) when 2 then 4326 end srid
       from customer""",
)
def parse_epsg_(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "customer").selectExpr(
        "c_custkey",
        "case c_custkey % 4 when 0 then 'EPSG:2154' when 1 then concat('urn:ogc:def:crs:EPSG::', 3945 + c_custkey % 2)"
        " when 2 then ' epsg: 4326 ' else 'unknown' end crs",
    )
    return df.select("c_custkey", parse_epsg("crs").alias("srid"))


# --- user code -----------------------------------------------------------------------------


@query(
    "code_sql",
    """select site_id __row_id__, upper(c_mktsegment) segment, round(lon, 6) x from sites
       where c_acctbal > (select avg(c_acctbal) from sites)""",
    layers=("sites",),
)
def code_sql(spark: SparkSession, sf: str) -> DataFrame:
    text = "select __row_id__, upper(c_mktsegment) segment from items where c_acctbal > (select avg(c_acctbal) from gdf)"
    result = code.run_sql(L.sites(spark, sf), text, "site_id", keep_geometry=True)
    return result.selectExpr("__row_id__", "segment", "round(geom.parts[0][0][0].x, 6) x")


@query(
    "code_table",
    """select c_mktsegment, count(*) n, round(sum(c_acctbal), 2) balance from sites group by c_mktsegment""",
    layers=("sites",),
)
def code_table(spark: SparkSession, sf: str) -> DataFrame:
    def per_segment(gdf: DataFrame) -> DataFrame:
        return gdf.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))

    return code.run_table(L.sites(spark, sf), per_segment)


@query(
    "code_item",
    """select s_suppkey, case when s_acctbal < 0 then null else CAST(length(s_name) + s_nationkey AS BIGINT) end score,
       case when s_acctbal < 0 then 'ValueError: in debt' end reject_reason from supplier""",
)
def code_item(spark: SparkSession, sf: str) -> DataFrame:
    def score(item: dict) -> dict:
        if item["s_acctbal"] < 0:
            raise ValueError("in debt")
        return {"score": len(item["s_name"]) + item["s_nationkey"]}

    return code.run_item(table(spark, sf, "supplier"), score, "score bigint").select("s_suppkey", "score", "reject_reason")

"""Queries on geometry: measures, edits, projections, joins by location, overlay, rasters."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import measures as M
from ..functions.crs import reproject
from ..functions.layer import describe
from ..operators import edges, edit, nearest, raster, spatial
from ..operators.points import points_from_xy
from . import layers as L
from .layers import table
from .registry import ORACLES, query

_TOL = "1e-9"

# --- points and projections ----------------------------------------------------------------


@query(
    "points_from_xy",
    """select c_custkey, 2154 srid, CAST(600000 + c_custkey*7919 % 12000 AS DOUBLE) + 0.5e0 x,
       CAST(6800000 + c_custkey*104729 % 8000 AS DOUBLE) y from customer where c_custkey % 11 <> 0""",
)
def points_from_xy_(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "customer").selectExpr(
        "c_custkey",
        "if(c_custkey % 11 = 0, 'n/a', concat(600000 + c_custkey*7919 % 12000, ',5')) `Coord.X`",
        "6800000 + c_custkey*104729 % 8000 `COORD Y`",
    )
    layer = points_from_xy(df)
    return layer.selectExpr(
        "c_custkey", f"{layer.schema['geom'].metadata['srid']} srid", f"{G.single_point('geom')}.x x", f"{G.single_point('geom')}.y y"
    )


def _lambert_sql(lat1: float, lat2: float, lat0: float, lon0: float, fe: float, fn: float) -> tuple[str, str]:
    """Textbook forward formula (Snyder, PP 1395, 15-1 to 15-9) with its constants worked out here."""
    f = 1 / 298.257222101
    e = math.sqrt(f * (2 - f))

    def t(lat: float) -> float:
        s = math.sin(math.radians(lat))
        return math.tan(math.pi / 4 - math.radians(lat) / 2) / ((1 - e * s) / (1 + e * s)) ** (e / 2)

    def m(lat: float) -> float:
        return math.cos(math.radians(lat)) / math.sqrt(1 - e * e * math.sin(math.radians(lat)) ** 2)

    n = (math.log(m(lat1)) - math.log(m(lat2))) / (math.log(t(lat1)) - math.log(t(lat2)))
    big = m(lat1) / (n * t(lat1) ** n)
    rho0 = 6378137.0 * big * t(lat0) ** n
    sin = "sin(radians(lat))"
    t_sql = f"(tan(pi()/4 - radians(lat)/2) / pow((1 - {e!r}::DOUBLE*{sin})/(1 + {e!r}::DOUBLE*{sin}), {e / 2!r}::DOUBLE))"
    rho = f"({6378137.0 * big!r}::DOUBLE * pow({t_sql}, {n!r}::DOUBLE))"
    theta = f"({n!r}::DOUBLE * radians(lon - {lon0}))"
    return f"{fe!r}::DOUBLE + {rho} * sin({theta})", f"{fn + rho0!r}::DOUBLE - {rho} * cos({theta})"


_L93 = _lambert_sql(44.0, 49.0, 46.5, 3.0, 700000.0, 6600000.0)


@query(
    "reproject",
    f"""select site_id, round({_L93[0]}, 3) x_2154, round({_L93[1]}, 3) y_2154,
       round(6378137e0 * radians(lon), 3) x_3857, round(6378137e0 * ln(tan(pi()/4 + radians(lat)/2)), 3) y_3857,
       round(lon, 7) lon, round(lat, 7) lat from sites""",
    layers=("sites",),
)
def reproject_(spark: SparkSession, sf: str) -> DataFrame:
    """Through the national and a UTM plane, and back to longitude/latitude."""
    layer = L.sites(spark, sf).select("site_id", "geom")
    p = G.single_point("geom")
    national = reproject(layer, 2154)
    out = national.selectExpr("site_id", f"round({p}.x, 3) x_2154", f"round({p}.y, 3) y_2154", "geom")
    out = describe(out, srid=2154, kind="Point")
    mercator = reproject(reproject(out, 32631), 3857)
    out = mercator.selectExpr("site_id", "x_2154", "y_2154", f"round({p}.x, 3) x_3857", f"round({p}.y, 3) y_3857", "geom")
    back = reproject(describe(out, srid=3857, kind="Point"), 4326)
    return back.selectExpr("site_id", "x_2154", "y_2154", "x_3857", "y_3857", f"round({p}.x, 7) lon", f"round({p}.y, 7) lat")


# --- measures and edits --------------------------------------------------------------------


@query(
    "centroid",
    """select 'wedge' kind, CAST(wedge_id AS BIGINT) id, round(cx + leg/3, 6) x, round(cy + 2*leg/3, 6) y from wedges
       union all select 'street', street_id, round((x1 + x2)/2, 6), round((y1 + y2)/2, 6) from streets""",
    layers=("wedges", "streets"),
)
def centroid(spark: SparkSession, sf: str) -> DataFrame:
    wedges = L.wedges(spark, sf).selectExpr("'wedge' kind", "wedge_id id", "geom")
    streets = L.streets(spark, sf).selectExpr("'street' kind", "street_id id", "geom")
    p = G.single_point("geom")
    return edit.centroid(wedges.union(streets)).selectExpr("kind", "id", f"round({p}.x, 6) x", f"round({p}.y, 6) y")


@query(
    "bbox_replace",
    """select street_id, round(least(x1, x2), 6) xmin, round(least(y1, y2), 6) ymin, round(greatest(x1, x2), 6) xmax,
       round(greatest(y1, y2), 6) ymax, 'Polygon' kind, round(abs(x2 - x1) * abs(y2 - y1), 9) area from streets""",
    layers=("streets",),
)
def bbox_replace(spark: SparkSession, sf: str) -> DataFrame:
    boxed = edit.replace_with_bbox(L.streets(spark, sf))
    return boxed.selectExpr(
        "street_id", "geom.type kind", f"round({M.area('geom')}, 9) area", f"inline(array({G.bbox('geom')}))"
    ).selectExpr("street_id", "kind", "area", *[f"round({c}, 6) {c}" for c in ("xmin", "ymin", "xmax", "ymax")])


@query(
    "feature_bbox",
    """select wedge_id, round(cx, 6) xmin, round(cy, 6) ymin, round(cx + leg, 6) xmax, round(cy + 2*leg, 6) ymax from wedges""",
    layers=("wedges",),
)
def feature_bbox(spark: SparkSession, sf: str) -> DataFrame:
    boxes = edit.feature_bbox(L.wedges(spark, sf).select("wedge_id", "geom"))
    return boxes.select("wedge_id", *[F.round(c, 6).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


@query(
    "vertex_count",
    """select 'wedge' kind, 4 vertices, count(*) n from part union all select 'street', 2, count(*) from orders
       union all select 'site', 1, count(*) from customer""",
)
def vertex_count(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        layer.select(F.lit(kind).alias("kind"), F.expr(G.vertex_count("geom")).alias("vertices"))
        for kind, layer in (("wedge", L.wedges(spark, sf)), ("street", L.streets(spark, sf)), ("site", L.sites(spark, sf)))
    ]
    return parts[0].union(parts[1]).union(parts[2]).groupBy("kind", "vertices").agg(F.count("*").alias("n"))


@query(
    "area_length",
    """select 'wedge' kind, CAST(wedge_id AS BIGINT) id, round(leg * leg, 9) area, round(leg * (3 + sqrt(5)), 7) length from wedges
       union all select 'street', street_id, 0.0e0, round(sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)), 7) from streets""",
    layers=("wedges", "streets"),
)
def area_length(spark: SparkSession, sf: str) -> DataFrame:
    wedges = L.wedges(spark, sf).selectExpr("'wedge' kind", "wedge_id id", "geom")
    streets = L.streets(spark, sf).selectExpr("'street' kind", "street_id id", "geom")
    measured = edit.add_measures(wedges.union(streets))
    return measured.select("kind", "id", F.round("area", 9).alias("area"), F.round("length", 7).alias("length"))


_CIRCLE = 0.5 * 64 * math.sin(2 * math.pi / 64)
_HALF_SIDE = 2 * 64 * math.sin(math.pi / 64)


@query(
    "buffer",
    f"""select 'site' kind, CAST(site_id AS BIGINT) id, round({_CIRCLE!r}::DOUBLE * 0.0025e0, 7) area,
          round({_HALF_SIDE!r}::DOUBLE * 0.05e0, 6) length from sites
       union all select 'zone', zone_id, round(2.4e0 * 1.6e0 + 8e0 * 0.05e0 + {_CIRCLE!r}::DOUBLE * 0.0025e0, 7),
          round(8e0 + {_HALF_SIDE!r}::DOUBLE * 0.05e0, 6) from zones
       union all select 'street', street_id, round(2 * 0.05e0 * sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) + {_CIRCLE!r}::DOUBLE * 0.0025e0, 7),
          round(2 * sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) + {_HALF_SIDE!r}::DOUBLE * 0.05e0, 6)
          from streets""",
    layers=("sites", "zones", "streets"),
)
def buffer(spark: SparkSession, sf: str) -> DataFrame:
    layers = [
        ("site", "site_id", L.sites(spark, sf)),
        ("zone", "zone_id", L.zones(spark, sf)),
        ("street", "street_id", L.streets(spark, sf)),
    ]
    out = None
    for kind, id_, layer in layers:
        grown = edges.buffer(layer.select(id_, "geom"), 0.05, id_)
        one = edit.add_measures(grown).select(
            F.lit(kind).alias("kind"), F.col(id_).alias("id"), F.round("area", 7).alias("area"), F.round("length", 6).alias("length")
        )
        out = one if out is None else out.union(one)
    return out


@query(
    "densify",
    """select street_id, CAST(greatest(1, ceil(len / 0.01e0)) + 1 AS INT) vertices, round(len, 7) length
       from (select street_id, sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) len from streets)""",
    layers=("streets",),
)
def densify(spark: SparkSession, sf: str) -> DataFrame:
    dense = edit.densify(L.streets(spark, sf), 0.01)
    return dense.selectExpr("street_id", f"{G.vertex_count('geom')} vertices", f"round({M.length('geom')}, 7) length")


@query("simplify")
def simplify(spark: SparkSession, sf: str) -> DataFrame:
    """Zigzag lines of 41 vertices; the tests compare the result with the textbook recursion."""
    zigzag = L.streets(spark, sf).selectExpr(
        "street_id",
        G.line(
            "transform(sequence(0, 40), i -> named_struct('x', x1 + (x2 - x1) * i / 40 + ((street_id * i * 7) % 11) / 10000,"
            " 'y', y1 + (y2 - y1) * i / 40 + ((street_id * i * 5) % 13) / 10000))"
        )
        + " geom",
    )
    simple = edit.simplify(describe(zigzag, srid=4326), 0.0008)
    return simple.selectExpr("street_id", f"{G.vertex_count('geom')} vertices", f"round({M.length('geom')}, 9) length")


@query(
    "simplify_zigzag",
    """select street_id, case when street_id % 3 = 0 then 5 - CAST(s = 1 AS INT) - CAST(s = 39 AS INT) when street_id % 3 = 1 then 41 else 2 end vertices,
       round(case when street_id % 3 = 0 then 0.38e0 + 2 * sqrt(0.0001e0 + 0.000025e0)
             when street_id % 3 = 1 then 40 * sqrt(0.0001e0 + 0.000025e0) else 0.4e0 end, 7) length
       from (select street_id, 1 + street_id % 39 s from streets)""",
    layers=("streets",),
)
def simplify_zigzag(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with one spike, with teeth above the tolerance, and with teeth below it."""
    height = (
        "case when street_id % 3 = 0 then if(i = 1 + street_id % 39, 0.005D, 0D)"
        " when i % 2 = 0 then 0D when street_id % 3 = 1 then 0.005D else 0.0004D end"
    )
    lines = L.streets(spark, sf).selectExpr(
        "street_id", G.line(f"transform(sequence(0, 40), i -> named_struct('x', x1 + i * 0.01D, 'y', y1 + {height}))") + " geom"
    )
    simple = edit.simplify(describe(lines, srid=4326), 0.0008)
    return simple.selectExpr("street_id", f"int({G.vertex_count('geom')}) vertices", f"round({M.length('geom')}, 7) length")


@query(
    "snap_grid",
    """select street_id, round(floor(x1/0.25e0 + 0.5e0)*0.25e0, 6) x, round(floor(y1/0.25e0 + 0.5e0)*0.25e0, 6) y,
       case when floor(x1/0.25e0 + 0.5e0) = floor(x2/0.25e0 + 0.5e0) and floor(y1/0.25e0 + 0.5e0) = floor(y2/0.25e0 + 0.5e0)
       then 1 else 2 end vertices from streets""",
    layers=("streets",),
)
def snap_grid(spark: SparkSession, sf: str) -> DataFrame:
    snapped = edit.snap_to_grid(L.streets(spark, sf), 0.25)
    p = G.single_point("geom")
    return snapped.selectExpr("street_id", f"round({p}.x, 6) x", f"round({p}.y, 6) y", f"{G.vertex_count('geom')} vertices")


@query(
    "orient",
    """select wedge_id, round(leg * leg, 9) ccw, round(-leg * leg, 9) cw from wedges""",
    layers=("wedges",),
)
def orient(spark: SparkSession, sf: str) -> DataFrame:
    mixed = L.wedges(spark, sf).selectExpr(
        "wedge_id",
        f"if(wedge_id % 2 = 0, geom, {G.map_rings('geom', lambda r: f'reverse({r})')}) geom",
    )
    ring = "geom.parts[0][0]"
    ccw = edit.orient(mixed).selectExpr("wedge_id", f"round({M.ring_area(ring)}, 9) ccw")
    cw = edit.orient(mixed, ccw=False).selectExpr("wedge_id", f"round({M.ring_area(ring)}, 9) cw")
    return ccw.join(cw, "wedge_id")


_DEFECTS = {
    0: (None, "cx, cy|cx + leg, cy|cx, cy + leg|cx, cy"),
    1: ("unclosed ring", "cx, cy|cx + leg, cy|cx, cy + leg|cx, cy + leg/2"),
    2: ("too few points", "cx, cy|cx + leg, cy|cx, cy"),
    3: ("repeated vertex", "cx, cy|cx + leg, cy|cx + leg, cy|cx, cy + leg|cx, cy"),
    4: ("self crossing", "cx, cy|cx + leg, cy + leg|cx + leg, cy|cx, cy + leg|cx, cy"),
    5: ("bad coordinate", "cx, cy|double('NaN'), cy|cx, cy + leg|cx, cy"),
    6: ("null geometry", ""),
}


@query(
    "validate",
    "select wedge_id, case wedge_id % 7 "
    + " ".join(f"when {k} then {'null' if p is None else repr(p)}" for k, (p, _) in _DEFECTS.items())
    + " end problem, case wedge_id % 7 when 2 then 'null geometry' when 4 then 'self crossing' when 5 then 'bad coordinate'"
    " when 6 then 'null geometry' end reject_reason from wedges",
    layers=("wedges",),
)
def validate(spark: SparkSession, sf: str) -> DataFrame:
    def shape(spec: str) -> str:
        if not spec:
            return G.null_geom()
        return G.polygon(f"array(array({', '.join(G.xy(*v.split(', ')) for v in spec.split('|'))}))")

    branches = " ".join(f"when {k} then {shape(s)}" for k, (_, s) in _DEFECTS.items())
    broken = L.wedges(spark, sf).selectExpr("wedge_id", f"case wedge_id % 7 {branches} end geom")
    return edit.validate(describe(broken, srid=4326), repair=True).select("wedge_id", "problem", "reject_reason")


# --- joins by location ---------------------------------------------------------------------

_PARCEL_BOX = "select *, cx - half pxmin, cy - half pymin, cx + half pxmax, cy + half pymax from parcels"


def _pairs(spark: SparkSession, sf: str, left: str, right: str, predicate: str, **options: object) -> DataFrame:
    ids = {"sites": "site_id", "zones": "zone_id", "parcels": "parcel_id", "depots": "depot_id", "plots": "plot_id",
           "routes": "route_id", "streets": "street_id"}
    lhs = getattr(L, left)(spark, sf).select(F.col(ids[left]).alias("left_id"), "geom")
    rhs = getattr(L, right)(spark, sf).select(F.col(ids[right]).alias("right_id"), "geom")
    return spatial.spatial_join(lhs, rhs, "left_id", "right_id", predicate, **options).select("left_id", "right_id")


@query(
    "sjoin_intersects",
    f"""select a.parcel_id left_id, b.parcel_id right_id from ({_PARCEL_BOX}) a join ({_PARCEL_BOX}) b
       on a.pxmin <= b.pxmax + {_TOL} and b.pxmin <= a.pxmax + {_TOL} and a.pymin <= b.pymax + {_TOL} and b.pymin <= a.pymax + {_TOL}""",
    layers=("parcels",),
)
def sjoin_intersects(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf, "parcels", "parcels", "intersects")


@query(
    "sjoin_within",
    """select site_id left_id, zone_id right_id from sites join zones on lon > xmin + 1e-10 and lon < xmax - 1e-10
       and lat > ymin + 1e-10 and lat < ymax - 1e-10""",
    layers=("sites", "zones"),
)
def sjoin_within(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf, "sites", "zones", "within")


@query(
    "sjoin_contains",
    f"""select zone_id left_id, parcel_id right_id from zones join ({_PARCEL_BOX}) on pxmin >= xmin - {_TOL} and pxmax <= xmax + {_TOL}
       and pymin >= ymin - {_TOL} and pymax <= ymax + {_TOL}""",
    layers=("parcels", "zones"),
)
def sjoin_contains(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf, "zones", "parcels", "contains")


@query(
    "sjoin_touches",
    """select a.plot_id left_id, b.plot_id right_id from plots a join plots b
       on a.xmin <= b.xmax and b.xmin <= a.xmax and a.ymin <= b.ymax and b.ymin <= a.ymax and a.plot_id <> b.plot_id""",
    layers=("plots",),
)
def sjoin_touches(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf, "plots", "plots", "touches")


@query(
    "sjoin_crosses",
    """select route_id left_id, zone_id right_id from (
         select *, greatest(0e0, least((xmin - x1)/nullif(x2 - x1, 0), (xmax - x1)/nullif(x2 - x1, 0)),
                            least((ymin - y1)/nullif(y2 - y1, 0), (ymax - y1)/nullif(y2 - y1, 0))) t0,
                   least(1e0, greatest((xmin - x1)/nullif(x2 - x1, 0), (xmax - x1)/nullif(x2 - x1, 0)),
                         greatest((ymin - y1)/nullif(y2 - y1, 0), (ymax - y1)/nullif(y2 - y1, 0))) t1
         from routes, zones)
       where t1 - t0 > 1e-11 and (x1 <> x2 or x1 > xmin + 1e-10 and x1 < xmax - 1e-10)
         and (y1 <> y2 or y1 > ymin + 1e-10 and y1 < ymax - 1e-10) and (t0 > 1e-11 or t1 < 1 - 1e-11)""",
    layers=("routes", "zones"),
)
def sjoin_crosses(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf, "routes", "zones", "crosses")


@query(
    "sjoin_overlaps",
    f"""select parcel_id left_id, zone_id right_id from ({_PARCEL_BOX}) join zones on pxmin < xmax - {_TOL} and pxmax > xmin + {_TOL}
       and pymin < ymax - {_TOL} and pymax > ymin + {_TOL}
       and not (pxmin >= xmin - {_TOL} and pxmax <= xmax + {_TOL} and pymin >= ymin - {_TOL} and pymax <= ymax + {_TOL})""",
    layers=("parcels", "zones"),
)
def sjoin_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf, "parcels", "zones", "overlaps")


@query(
    "sjoin_covers",
    """select plot_id left_id, site_id right_id from (select plot_id, xmin - 4.5e0 x0, xmax - 4.5e0 x1, ymin + 42.5e0 y0, ymax + 42.5e0 y1
       from plots) join sites on lon >= x0 - 1e-10 and lon <= x1 + 1e-10 and lat >= y0 - 1e-10 and lat <= y1 + 1e-10""",
    layers=("plots", "sites"),
)
def sjoin_covers(spark: SparkSession, sf: str) -> DataFrame:
    moved = L.plots(spark, sf).select(
        F.col("plot_id").alias("left_id"),
        F.expr(G.rectangle("xmin - 4.5e0", "ymin + 42.5e0", "xmax - 4.5e0", "ymax + 42.5e0")).alias("geom"),
    )
    sites = L.sites(spark, sf).select(F.col("site_id").alias("right_id"), "geom")
    return spatial.spatial_join(describe(moved, srid=4326), sites, "left_id", "right_id", "covers").select("left_id", "right_id")


@query(
    "sjoin_covered_by",
    f"""select parcel_id left_id, zone_id right_id from ({_PARCEL_BOX}) join zones on pxmin >= xmin - {_TOL} and pxmax <= xmax + {_TOL}
       and pymin >= ymin - {_TOL} and pymax <= ymax + {_TOL}""",
    layers=("parcels", "zones"),
)
def sjoin_covered_by(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf, "parcels", "zones", "covered_by")


@query(
    "sjoin_contains_properly",
    f"""select zone_id left_id, parcel_id right_id from zones join ({_PARCEL_BOX}) on pxmin > xmin + {_TOL} and pxmax < xmax - {_TOL}
       and pymin > ymin + {_TOL} and pymax < ymax - {_TOL}""",
    layers=("parcels", "zones"),
)
def sjoin_contains_properly(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf, "zones", "parcels", "contains_properly")


@query(
    "sjoin_dwithin",
    """select site_id left_id, depot_id right_id from sites s join depots d
       on sqrt(pow(s.lon - d.lon, 2) + pow(s.lat - d.lat, 2)) <= 0.15e0""",
    layers=("sites", "depots"),
)
def sjoin_dwithin(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf, "sites", "depots", "dwithin", distance=0.15)


_SITE_IN_PARCEL = f"""lon >= pxmin - 1e-10 and lon <= pxmax + 1e-10 and lat >= pymin - 1e-10 and lat <= pymax + 1e-10"""


_IN_ZONE = "lon > xmin + 1e-10 and lon < xmax - 1e-10 and lat > ymin + 1e-10 and lat < ymax - 1e-10"


def _loose_ids(spark: SparkSession, sf: str, how: str) -> DataFrame:
    sites = L.sites(spark, sf).selectExpr("nullif(site_id % 50, 0) left_id", "geom")
    zones = L.zones(spark, sf).selectExpr("nullif(zone_id % 4, 0) right_id", "geom")
    return spatial.spatial_join(sites, zones, "left_id", "right_id", "within", how).select("left_id", "right_id")


@query(
    "sjoin_ids",
    f"select nullif(site_id % 50, 0) left_id, nullif(zone_id % 4, 0) right_id from sites join zones on {_IN_ZONE}",
    layers=("sites", "zones"),
)
def sjoin_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Null and repeated ids on both sides."""
    return _loose_ids(spark, sf, "inner")


@query(
    "sjoin_ids_left",
    f"select nullif(site_id % 50, 0) left_id, nullif(zone_id % 4, 0) right_id from sites left join zones on {_IN_ZONE}",
    layers=("sites", "zones"),
)
def sjoin_ids_left(spark: SparkSession, sf: str) -> DataFrame:
    return _loose_ids(spark, sf, "left")


@query(
    "sjoin_left",
    f"""select site_id left_id, parcel_id right_id, round(lon, 6) x from sites left join ({_PARCEL_BOX}) on {_SITE_IN_PARCEL}""",
    layers=("parcels", "sites"),
)
def sjoin_left(spark: SparkSession, sf: str) -> DataFrame:
    sites = L.sites(spark, sf).select(F.col("site_id").alias("id"), "geom")
    parcels = L.parcels(spark, sf).select(F.col("parcel_id").alias("id"), "geom")
    joined = spatial.spatial_join(sites, parcels, "id", "id", "intersects", "left_outer")
    return joined.selectExpr("id_left left_id", "id_right right_id", f"round({G.single_point('geom')}.x, 6) x")


@query(
    "sjoin_right",
    f"""select site_id left_id, parcel_id right_id, round(pxmin, 6) x from sites right join ({_PARCEL_BOX}) on {_SITE_IN_PARCEL}""",
    layers=("parcels", "sites"),
)
def sjoin_right(spark: SparkSession, sf: str) -> DataFrame:
    sites = L.sites(spark, sf).select(F.col("site_id").alias("id"), "geom")
    parcels = L.parcels(spark, sf).select(F.col("parcel_id").alias("id"), "geom")
    joined = spatial.spatial_join(sites, parcels, "id", "id", "intersects", "right")
    return joined.selectExpr("id_left left_id", "id_right right_id", f"round({G.single_point('geom')}.x, 6) x")


@query(
    "spatial_relate",
    f"""select site_id, case when exists (select 1 from ({_PARCEL_BOX}) where {_SITE_IN_PARCEL}) then 'related'
       else 'unrelated' end port from sites""",
    layers=("parcels", "sites"),
)
def spatial_relate(spark: SparkSession, sf: str) -> DataFrame:
    return spatial.spatial_relate(L.sites(spark, sf), L.parcels(spark, sf), "site_id", "parcel_id").select("site_id", "port")


@query(
    "neighbors",
    """select site_id, CAST(rank AS INT) rank, depot_id, round(distance, 9) distance from (
         select site_id, depot_id, d distance, row_number() over (partition by site_id order by d, depot_id) rank
         from (select site_id, depot_id, sqrt(pow(s.lon - p.lon, 2) + pow(s.lat - p.lat, 2)) d from sites s, depots p))
       where rank <= 3""",
    layers=("sites", "depots"),
)
def neighbors(spark: SparkSession, sf: str) -> DataFrame:
    found = nearest.neighbors(L.sites(spark, sf), L.depots(spark, sf), "site_id", "depot_id", 3)
    return found.withColumn("distance", F.round("distance", 9))


def _to_square(x1: str, y1: str, x2: str, y2: str) -> str:
    """Distance of a line of two vertices to the square ``pxmin, pymin, pxmax, pymax``: 0 where they meet, which is so where their
    boxes do and the corners are not all on one side of the line; else from a corner to the line or from an end to the square."""
    dx, dy = f"({x2} - {x1})", f"({y2} - {y1})"
    corners = [(x, y) for x in ("pxmin", "pxmax") for y in ("pymin", "pymax")]
    sides = ", ".join(f"{dx} * ({y} - {y1}) - {dy} * ({x} - {x1})" for x, y in corners)

    def from_corner(x: str, y: str) -> str:
        t = f"coalesce(greatest(0e0, least(1e0, (({x} - {x1}) * {dx} + ({y} - {y1}) * {dy}) / nullif({dx} * {dx} + {dy} * {dy}, 0))), 0e0)"
        return f"pow({x} - {x1} - {t} * {dx}, 2) + pow({y} - {y1} - {t} * {dy}, 2)"

    def from_end(x: str, y: str) -> str:
        return f"pow(greatest(pxmin - {x}, 0e0, {x} - pxmax), 2) + pow(greatest(pymin - {y}, 0e0, {y} - pymax), 2)"

    apart = ", ".join([from_corner(*c) for c in corners] + [from_end(x1, y1), from_end(x2, y2)])
    return f"""case when least({x1}, {x2}) <= pxmax and greatest({x1}, {x2}) >= pxmin and least({y1}, {y2}) <= pymax
        and greatest({y1}, {y2}) >= pymin and least({sides}) <= 0 and greatest({sides}) >= 0 then 0e0 else sqrt(least({apart})) end"""


_PATH_CORNERS = [("x", "y"), ("(x + a)", "(y + b)"), ("(x + 0.9e0 * a)", "y"), ("(x + 0.1e0 * a)", "(y + 0.95e0 * b)")]


@query(
    "neighbors_lines",
    f"""select path_id, CAST(rank AS INT) rank, parcel_id, round(d, 9) distance from (
         select path_id, parcel_id, d, row_number() over (partition by path_id order by d, parcel_id) rank from (
           select path_id, parcel_id, least({', '.join(f'd{i}' for i in range(3))}) d from (
             select path_id, parcel_id, {', '.join(f'{_to_square(*a, *b)} d{i}' for i, (a, b) in enumerate(zip(_PATH_CORNERS, _PATH_CORNERS[1:], strict=False)))}
             from (select path_id, x, y, a, b from paths), ({_PARCEL_BOX}))))
       where rank <= 3""",
    layers=("paths", "parcels"),
)
def neighbors_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of four vertices to areas."""
    found = nearest.neighbors(L.paths(spark, sf), L.parcels(spark, sf), "path_id", "parcel_id", 3)
    return found.withColumn("distance", F.round("distance", 9))


@query(
    "neighbors_streets",
    f"""select street_id, CAST(rank AS INT) rank, round(d, 9) distance from (
         select street_id, d, row_number() over (partition by street_id order by d) rank from (
           select street_id, {_to_square('x1', 'y1', 'x2', 'y2')} d from streets, ({_PARCEL_BOX})))
       where rank <= 3 and d <= 0.25e0""",
    layers=("streets", "parcels"),
)
def neighbors_streets(spark: SparkSession, sf: str) -> DataFrame:
    """Many short lines on the lattice of the areas, with ties, up to a distance."""
    found = nearest.neighbors(L.streets(spark, sf), L.parcels(spark, sf), "street_id", "parcel_id", 3, 0.25)
    return found.select("street_id", "rank", F.round("distance", 9).alias("distance"))


# --- overlay -------------------------------------------------------------------------------

_ZONE_OVERLAP = """greatest(0e0, least(pxmax, xmax) - greatest(pxmin, xmin)) * greatest(0e0, least(pymax, ymax) - greatest(pymin, ymin))"""


@query(
    "clip",
    f"""select * from (
         select parcel_id, 'inside' port, round(sum(a), 8) area from (select parcel_id, {_ZONE_OVERLAP} a
           from ({_PARCEL_BOX}), zones where n_regionkey < 3) group by parcel_id
         union all select parcel_id, 'outside', round(any_value(4 * half * half) - sum(a), 8) from (select parcel_id, half, {_ZONE_OVERLAP} a
           from ({_PARCEL_BOX}), zones where n_regionkey < 3) group by parcel_id)
       where area > 1e-8""",
    layers=("parcels", "zones"),
)
def clip(spark: SparkSession, sf: str) -> DataFrame:
    mask = L.zones(spark, sf).where("n_regionkey < 3")
    parts = edges.clip(L.parcels(spark, sf), mask, "parcel_id", "zone_id")
    return parts.selectExpr("parcel_id", "port", f"round({M.area('geom')}, 8) area").where("area > 1e-8")


@query(
    "overlay_areas",
    f"""select * from (select a.parcel_id left_id, b.parcel_id right_id,
         round((least(a.pxmax, b.pxmax) - greatest(a.pxmin, b.pxmin)) * (least(a.pymax, b.pymax) - greatest(a.pymin, b.pymin)), 8) area,
         round(2 * (least(a.pxmax, b.pxmax) - greatest(a.pxmin, b.pxmin) + least(a.pymax, b.pymax) - greatest(a.pymin, b.pymin)), 6) length
       from ({_PARCEL_BOX}) a join ({_PARCEL_BOX}) b on a.pxmin < b.pxmax - {_TOL} and b.pxmin < a.pxmax - {_TOL}
         and a.pymin < b.pymax - {_TOL} and b.pymin < a.pymax - {_TOL} and a.parcel_id < b.parcel_id)""",
    layers=("parcels",),
)
def overlay_areas(spark: SparkSession, sf: str) -> DataFrame:
    parcels = L.parcels(spark, sf)
    pairs = edges.overlay_areas(parcels, parcels, "parcel_id", "parcel_id", "_lid < _rid")
    return edit.add_measures(pairs).selectExpr(
        "_lid left_id", "_rid right_id", "round(area, 8) area", "round(length, 6) length"
    )


@query(
    "split_lines",
    """, p as (
         select a.street_id, a.x1, a.y1, a.x2, a.y2, b.x1 bx1, b.y1 by1, b.x2 bx2, b.y2 by2
         from streets a join streets b on least(a.x1, a.x2) <= greatest(b.x1, b.x2) + 1e-10 and least(b.x1, b.x2) <= greatest(a.x1, a.x2) + 1e-10
           and least(a.y1, a.y2) <= greatest(b.y1, b.y2) + 1e-10 and least(b.y1, b.y2) <= greatest(a.y1, a.y2) + 1e-10
           and a.street_id <> b.street_id),
       q as (
         select *, x2 - x1 ux, y2 - y1 uy, bx2 - bx1 vx, by2 - by1 vy, bx1 - x1 qx, by1 - y1 qy from p
         where (x1 <> x2 or y1 <> y2) and (bx1 <> bx2 or by1 <> by2)),
       r as (
         select street_id, (qx*vy - qy*vx) / (ux*vy - uy*vx) t, (qx*uy - qy*ux) / (ux*vy - uy*vx) w from q
           where abs(ux*vy - uy*vx) > 1e-12
         union all select street_id, (qx*ux + qy*uy) / (ux*ux + uy*uy), 0 from q
           where abs(ux*vy - uy*vx) <= 1e-12 and abs(qx*uy - qy*ux) <= 1e-12
         union all select street_id, ((qx + vx)*ux + (qy + vy)*uy) / (ux*ux + uy*uy), 0 from q
           where abs(ux*vy - uy*vx) <= 1e-12 and abs(qx*uy - qy*ux) <= 1e-12),
       s as (select street_id, count(distinct round(t, 6)) cuts from r
             where t > 1e-7 and t < 1 - 1e-7 and w >= -1e-7 and w <= 1 + 1e-7 group by street_id)
       select street_id, CAST(coalesce(cuts, 0) + 1 AS BIGINT) pieces, round(sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)), 7) length
       from streets left join s using (street_id)""",
    layers=("streets",),
)
def split_lines(spark: SparkSession, sf: str) -> DataFrame:
    pieces = edges.split_lines(L.streets(spark, sf), "street_id")
    return pieces.groupBy("street_id").agg(
        F.count("*").alias("pieces"), F.round(F.sum(F.expr(M.length("geom"))), 7).alias("length")
    )


@query(
    "dissolve",
    """select c_mktsegment, round(count(*) * 0.015625e0, 6) area,
       round(sum(0.5e0 - 0.125e0 * (select count(*) from plots n where n.c_mktsegment = p.c_mktsegment
         and (n.xmin = p.xmin and abs(n.ymin - p.ymin) = 0.125e0 or n.ymin = p.ymin and abs(n.xmin - p.xmin) = 0.125e0))), 6) length
       from plots p group by c_mktsegment""",
    layers=("plots",),
)
def dissolve(spark: SparkSession, sf: str) -> DataFrame:
    parts = edges.dissolve(L.plots(spark, sf), ["c_mktsegment"], "plot_id")
    return edit.add_measures(parts).groupBy("c_mktsegment").agg(
        F.round(F.sum("area"), 6).alias("area"), F.round(F.sum("length"), 6).alias("length")
    )


@query(
    "split_lines_ids",
    f"""select nullif(street_id % 50, 0) street_id, CAST(sum(pieces) AS BIGINT) pieces, round(sum(sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2))), 7) length
       from ({ORACLES['split_lines']}) join streets using (street_id) group by 1""",
    layers=("streets",),
)
def split_lines_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Null and repeated ids."""
    streets = L.streets(spark, sf).selectExpr("nullif(street_id % 50, 0) street_id", "geom")
    pieces = edges.split_lines(streets, "street_id")
    return pieces.groupBy("street_id").agg(F.count("*").alias("pieces"), F.round(F.sum(F.expr(M.length("geom"))), 7).alias("length"))


_PATH_EDGES = """select path_id, 0 seg, x x1, y y1, x + a x2, y + b y2 from paths
       union all select path_id, 1, x + a, y + b, x + 0.9e0 * a, y from paths
       union all select path_id, 2, x + 0.9e0 * a, y, x + 0.1e0 * a, y + 0.95e0 * b from paths"""
_PATH_LENGTH = f"select path_id, sum(sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2))) len from ({_PATH_EDGES}) group by path_id"


@query(
    "split_paths",
    f""", e as ({_PATH_EDGES}),
       q as (
         select l.path_id, l.seg, l.x2 - l.x1 ux, l.y2 - l.y1 uy, r.x2 - r.x1 vx, r.y2 - r.y1 vy, r.x1 - l.x1 qx, r.y1 - l.y1 qy
         from e l join e r on least(l.x1, l.x2) <= greatest(r.x1, r.x2) and least(r.x1, r.x2) <= greatest(l.x1, l.x2)
           and least(l.y1, l.y2) <= greatest(r.y1, r.y2) and least(r.y1, r.y2) <= greatest(l.y1, l.y2)
           and (l.path_id <> r.path_id or abs(l.seg - r.seg) > 1)),
       s as (
         select path_id, count(distinct (seg, round((qx*vy - qy*vx) / (ux*vy - uy*vx), 9))) cuts from q
         where ux*vy - uy*vx <> 0 and (qx*vy - qy*vx) / (ux*vy - uy*vx) between 0 and 1 and (qx*uy - qy*ux) / (ux*vy - uy*vx) between 0 and 1
         group by path_id)
       select path_id, c_mktsegment, CAST(cuts + 1 AS BIGINT) pieces, CAST(4 + 2 * cuts AS BIGINT) vertices, round(len, 7) length
       from paths join s using (path_id) join ({_PATH_LENGTH}) using (path_id)""",
    layers=("paths",),
)
def split_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Polylines that cross each other and themselves keep their vertices and attributes."""
    pieces = edges.split_lines(L.paths(spark, sf).select("path_id", "c_mktsegment", "geom"), "path_id")
    measured = pieces.selectExpr("path_id", "c_mktsegment", f"{G.vertex_count('geom')} n", f"{M.length('geom')} len")
    return measured.groupBy("path_id", "c_mktsegment").agg(
        F.count("*").alias("pieces"), F.sum("n").cast("bigint").alias("vertices"), F.round(F.sum("len"), 7).alias("length")
    )


@query(
    "clip_lines",
    f""", e as (select *, sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) len from ({_PATH_EDGES})),
       i as (
         select path_id, seg, len, greatest(0e0, least((xmin - x1) / (x2 - x1), (xmax - x1) / (x2 - x1)), least((ymin - y1) / (y2 - y1), (ymax - y1) / (y2 - y1))) t0,
           least(1e0, greatest((xmin - x1) / (x2 - x1), (xmax - x1) / (x2 - x1)), greatest((ymin - y1) / (y2 - y1), (ymax - y1) / (y2 - y1))) t1
         from e, zones where n_regionkey < 3),
       m as (
         select *, max(b) over (partition by path_id order by a rows between unbounded preceding and 1 preceding) m
         from (select path_id, seg + t0 a, seg + t1 b, (t1 - t0) * len l from i where t1 - t0 > 1e-9)),
       p as (
         select path_id, sum(case when m is null or a > m + 1e-9 then 1 else 0 end) runs, sum(l) l, min(a) low, max(b) high from m group by path_id),
       r as (
         select path_id, coalesce(runs, 0) ins, case when runs is null then 1
           else runs - 1 + case when low > 1e-9 then 1 else 0 end + case when high < 3 - 1e-9 then 1 else 0 end end outs, coalesce(l, 0e0) l, len
         from ({_PATH_LENGTH}) left join p using (path_id))
       select * from (
         select path_id, c_mktsegment, 'inside' port, CAST(ins AS BIGINT) pieces, round(l, 7) length, CAST(4 + 2 * (ins + outs - 1) AS BIGINT) vertices
           from r join paths using (path_id)
         union all select path_id, c_mktsegment, 'outside', CAST(outs AS BIGINT), round(len - l, 7), CAST(4 + 2 * (ins + outs - 1) AS BIGINT) from r join paths using (path_id))
       where pieces > 0""",
    layers=("paths", "zones"),
)
def clip_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Stretches of polylines inside and outside a mask; vertices are those of all stretches of a path."""
    mask = L.zones(spark, sf).where("n_regionkey < 3")
    parts = edges.clip(L.paths(spark, sf).select("path_id", "c_mktsegment", "geom"), mask, "path_id", "zone_id")
    measured = parts.selectExpr("path_id", "c_mktsegment", "port", f"{G.vertex_count('geom')} n", f"{M.length('geom')} len")
    sides = measured.groupBy("path_id", "c_mktsegment", "port").agg(F.count("*").alias("pieces"), F.round(F.sum("len"), 7).alias("length"))
    return sides.join(measured.groupBy("path_id").agg(F.sum("n").cast("bigint").alias("vertices")), "path_id").select(
        "path_id", "c_mktsegment", "port", "pieces", "length", "vertices"
    )


@query("clip_ids", f"select nullif(parcel_id % 50, 0) parcel_id, port, area from ({ORACLES['clip']})")
def clip_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Null and repeated ids."""
    parcels = L.parcels(spark, sf).selectExpr("nullif(parcel_id % 50, 0) parcel_id", "geom")
    parts = edges.clip(parcels, L.zones(spark, sf).where("n_regionkey < 3").withColumn("zone_id", F.lit(None).cast("int")), "parcel_id", "zone_id")
    return parts.selectExpr("parcel_id", "port", f"round({M.area('geom')}, 8) area").where("area > 1e-8")


@query("dissolve_ids", ORACLES["dissolve"])
def dissolve_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Null and repeated ids."""
    plots = L.plots(spark, sf).selectExpr("c_mktsegment", "nullif(plot_id % 50, 0) plot_id", "geom")
    parts = edges.dissolve(plots, ["c_mktsegment"], "plot_id")
    return edit.add_measures(parts).groupBy("c_mktsegment").agg(
        F.round(F.sum("area"), 6).alias("area"), F.round(F.sum("length"), 6).alias("length")
    )


@query("neighbors_ids", f"select nullif(site_id % 50, 0) site_id, rank, depot_id, distance from ({ORACLES['neighbors']})")
def neighbors_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Null and repeated ids of the base points."""
    sites = L.sites(spark, sf).selectExpr("nullif(site_id % 50, 0) site_id", "geom")
    return nearest.neighbors(sites, L.depots(spark, sf), "site_id", "depot_id", 3).withColumn("distance", F.round("distance", 9))


# --- the same on areas that no edge of which is parallel to an axis --------------------------


def _turned_pairs(spark: SparkSession, sf: str, left: str, right: str, predicate: str) -> DataFrame:
    lhs, rhs = (L.turned(getattr(L, name)(spark, sf).select(F.col(f"{name[:-1]}_id").alias(id_), "geom")) for name, id_ in ((left, "left_id"), (right, "right_id")))
    return spatial.spatial_join(lhs, rhs, "left_id", "right_id", predicate).select("left_id", "right_id")


@query("sjoin_overlaps_turned", ORACLES["sjoin_overlaps"])
def sjoin_overlaps_turned(spark: SparkSession, sf: str) -> DataFrame:
    return _turned_pairs(spark, sf, "parcels", "zones", "overlaps")


@query("sjoin_intersects_turned", ORACLES["sjoin_intersects"])
def sjoin_intersects_turned(spark: SparkSession, sf: str) -> DataFrame:
    return _turned_pairs(spark, sf, "parcels", "parcels", "intersects")


@query(
    "overlay_areas_turned",
    f"select left_id, right_id, round(2 * area, 7) area, round(sqrt(2e0) * length, 5) length from ({ORACLES['overlay_areas']})",
)
def overlay_areas_turned(spark: SparkSession, sf: str) -> DataFrame:
    parcels = L.turned(L.parcels(spark, sf))
    pairs = edges.overlay_areas(parcels, parcels, "parcel_id", "parcel_id", "_lid < _rid")
    return edit.add_measures(pairs).selectExpr("_lid left_id", "_rid right_id", "round(round(area / 2, 8) * 2, 7) area", "round(sqrt(2) * round(length / sqrt(2), 6), 5) length")


@query("clip_turned", f"select parcel_id, port, round(2 * area, 7) area from ({ORACLES['clip']})")
def clip_turned(spark: SparkSession, sf: str) -> DataFrame:
    mask = L.turned(L.zones(spark, sf).where("n_regionkey < 3"))
    parts = edges.clip(L.turned(L.parcels(spark, sf)).select("parcel_id", "geom"), mask, "parcel_id", "zone_id")
    return parts.selectExpr("parcel_id", "port", f"round({M.area('geom')} / 2, 8) half").where("half > 1e-8").selectExpr("parcel_id", "port", "round(2 * half, 7) area")


@query("dissolve_turned", f"select c_mktsegment, round(2 * area, 5) area, round(sqrt(2e0) * length, 4) length from ({ORACLES['dissolve']})")
def dissolve_turned(spark: SparkSession, sf: str) -> DataFrame:
    parts = edges.dissolve(L.turned(L.plots(spark, sf)), ["c_mktsegment"], "plot_id")
    return edit.add_measures(parts).groupBy("c_mktsegment").agg(
        F.round(F.sum("area"), 5).alias("area"), F.round(F.sum("length"), 4).alias("length")
    )


# --- rasters -------------------------------------------------------------------------------

_CENTRES = "select *, -4.5e0 + (c + 0.5e0)*0.02e0 x, 42.5e0 + (r + 0.5e0)*0.02e0 y from pixels"


def _pixels(spark: SparkSession, sf: str) -> DataFrame:
    return L.pixels(spark, sf).withColumn("pixel_id", F.expr("r * 1000 + c"))


@query(
    "zonal_stats",
    f"""select zone_id, count(v) n, min(v) vmin, max(v) vmax, round(avg(v), 6) vavg, round(sum(v), 4) vsum, round(stddev_samp(v), 6) vstd
       from ({_CENTRES}) join zones on x >= xmin and x <= xmax and y >= ymin and y <= ymax group by zone_id""",
    layers=("pixels", "zones"),
)
def zonal_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = raster.zonal_stats(_pixels(spark, sf), L.zones(spark, sf), "pixel_id", "zone_id", "v")
    return stats.select(
        "zone_id", "n", "vmin", "vmax", F.round("vavg", 6).alias("vavg"), F.round("vsum", 4).alias("vsum"), F.round("vstd", 6).alias("vstd")
    )


@query(
    "raster_stats",
    """select CAST(r // 100 AS BIGINT) tile, count(v) n, min(v) vmin, max(v) vmax, round(avg(v), 6) vavg from pixels group by r // 100""",
    layers=("pixels",),
)
def raster_stats(spark: SparkSession, sf: str) -> DataFrame:
    tiled = L.layer_table(spark, sf, "pixels").withColumn("tile", F.expr("r div 100"))
    return raster.raster_stats(tiled, "v", ["tile"]).withColumn("vavg", F.round("vavg", 6))


@query(
    "raster_clip",
    f"""select r, c, v from ({_CENTRES}) where exists (select 1 from zones where n_regionkey = 2 and x >= xmin and x <= xmax
       and y >= ymin and y <= ymax)""",
    layers=("pixels", "zones"),
)
def raster_clip(spark: SparkSession, sf: str) -> DataFrame:
    mask = L.zones(spark, sf).where("n_regionkey = 2")
    return raster.raster_clip(_pixels(spark, sf), mask, "pixel_id", "zone_id").select("r", "c", "v")


# --- composed flows ------------------------------------------------------------------------


@query(
    "flow_zone_report",
    """select zone_id, n_name, count(*) sites, round(sum(c_acctbal), 2) balance, round(avg(lat), 6) mean_lat
       from sites join zones on lon >= xmin - 1e-10 and lon <= xmax + 1e-10 and lat >= ymin - 1e-10 and lat <= ymax + 1e-10
       where c_mktsegment = 'BUILDING' group by zone_id, n_name""",
    layers=("sites", "zones"),
)
def flow_zone_report(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.filters import filter_rows

    return (
        L.layer_table(spark, sf, "sites")
        .transform(filter_rows, "c_mktsegment", "equals", "BUILDING")
        .transform(points_from_xy)
        .transform(spatial.spatial_join, L.zones(spark, sf), "site_id", "zone_id", "intersects")
        .groupBy("zone_id", "n_name")
        .agg(
            F.count("*").alias("sites"),
            F.round(F.sum("c_acctbal"), 2).alias("balance"),
            F.round(F.avg(F.expr(f"{G.single_point('geom')}.y")), 6).alias("mean_lat"),
        )
    )

"""Queries on sources and sinks: layers derived from the tables are written, or built as file contents, and read back."""

from __future__ import annotations

import io
import zipfile
from functools import reduce
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import crs
from ..functions import geometry as G
from ..functions import measures as M
from ..operators import edit
from ..operators.filters import filter_rows
from ..operators.lineage import scratch_path
from ..operators.points import points_from_xy
from ..sources import delimited, dxf, geojson, gpkg, inventory, kml, pixels, shapefile, sinks, workbook
from . import layers as L
from .layers import table
from .registry import query

# Rows per derived file, so that no file grows with the data.
FILE_ROWS = 500

_SITE_PROPERTIES = "site_id:bigint,c_mktsegment:string,c_acctbal:double"
_SITE_COLUMNS = ["site_id", "c_mktsegment", "c_acctbal", "geom"]
_SITES_BACK = "select site_id, c_mktsegment, c_acctbal, round(lon, 9) x, round(lat, 9) y from sites"


def _back(df: DataFrame) -> DataFrame:
    p = G.single_point("geom")
    return df.selectExpr("site_id", "c_mktsegment", "c_acctbal", f"round({p}.x, 9) x", f"round({p}.y, 9) y")


def _sites(spark: SparkSession, sf: str) -> DataFrame:
    return L.sites(spark, sf).select(*_SITE_COLUMNS)


# --- delimited text ------------------------------------------------------------------------


@query("scan_csv", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "customers")
    delimited.write_csv(table(spark, sf, "customer"), path, delimiter=";")
    ddl = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return delimited.read_csv(spark, path, schema=ddl)


@query("scan_csv_quoted", "select doc_id, nullif(text, '') text, nullif(lang, '') lang from documents")
def scan_csv_quoted(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with line breaks, quotes and separators in them, read in byte ranges; an empty text comes back as null."""
    path = scratch_path(spark, "texts")
    delimited.write_csv(table(spark, sf, "documents").select("doc_id", "text", "lang"), path)
    return delimited.read_csv(spark, path, ",", "utf-8", schema="doc_id bigint, text string, lang string", multiline="ranges")


@query(
    "detect_text_profile",
    """select doc_id, case when greatest(s, t, p, c) = 0 then ',' when s = greatest(s, t, p, c) then ';'
       when t = greatest(s, t, p, c) then chr(9) when p = greatest(s, t, p, c) then '|' else ',' end separator,
       CAST(greatest(s, t, p, c) AS BIGINT) occurrences from (
         select doc_id, length(l) - length(replace(l, ';', '')) s, length(l) - length(replace(l, chr(9), '')) t,
           length(l) - length(replace(l, '|', '')) p, length(l) - length(replace(l, ',', '')) c
         from (select doc_id, split_part(text, chr(10), 1) l from documents))""",
)
def detect_text_profile(spark: SparkSession, sf: str) -> DataFrame:
    heads = table(spark, sf, "documents").select("doc_id", F.substring_index("text", "\n", 1).alias("header"))
    return delimited.profile_lines(heads, "header").select("doc_id", "separator", "occurrences")


@query("sink_csv", "select site_id, c_mktsegment, c_acctbal from sites", layers=("sites",))
def sink_csv(spark: SparkSession, sf: str) -> DataFrame:
    layer = _sites(spark, sf)
    # features without geometry are written as well
    some_missing = layer.withColumn("geom", F.expr(f"if(site_id % 5 = 0, {G.null_geom()}, geom)"))
    path = sinks.write_layer(some_missing, scratch_path(spark, "sites") + ".csv")
    return spark.read.option("header", True).schema("site_id bigint, c_mktsegment string, c_acctbal double").csv(path)


# --- GeoJSON -------------------------------------------------------------------------------


@query("scan_geojson", _SITES_BACK, layers=("sites",))
def scan_geojson(spark: SparkSession, sf: str) -> DataFrame:
    path = sinks.write_layer(_sites(spark, sf), scratch_path(spark, "sites"), "geojson")
    return _back(geojson.read_geojson(spark, path, _SITE_PROPERTIES))


@query("sink_geojson", _SITES_BACK, layers=("sites",))
def sink_geojson(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "sites")
    geojson.write_geojson(_sites(spark, sf), path)
    return _back(geojson.read_geojson(spark, path, _SITE_PROPERTIES, layout="lines"))


@query(
    "scan_geojson_layouts",
    """select site_id, c_mktsegment, round(lon, 9) x, round(lat, 9) y, CAST(null AS VARCHAR) reject_reason from sites where site_id % 50 <> 7
       union all select null, null, null, null, 'unreadable line' from sites where site_id % 50 = 7""",
    layers=("sites",),
)
def scan_geojson_layouts(spark: SparkSession, sf: str) -> DataFrame:
    """One folder with features to a line, broken ones among them, collections on one line, and indented collections."""
    path = scratch_path(spark, "sites")
    text = geojson.feature_text(_sites(spark, sf).drop("c_acctbal")).select(
        "value", F.get_json_object("value", "$.properties.site_id").cast("bigint").alias("site_id")
    )
    text = text.withColumn("file", F.expr(f"site_id div {FILE_ROWS}")).withColumn("layout", F.expr("file % 3"))
    # every layout loses the same features, which stand as broken lines in the files of lines
    text.where("layout = 0 or site_id % 50 = 7").selectExpr(
        "if(site_id % 50 = 7, substr(value, 1, length(value) - 9), value) value"
    ).write.text(path)
    whole = text.where("layout > 0 and site_id % 50 <> 7").groupBy("layout", "file").agg(F.array_join(F.collect_list("value"), ",").alias("body"))
    whole = whole.withColumn("value", F.concat(F.lit('{"type":"FeatureCollection","features":['), "body", F.lit("]}")))
    whole.where("layout = 1").select("value").write.mode("append").text(path)
    whole.where("layout = 2").select(F.regexp_replace("value", "([{\\[,])", "$1\n  ").alias("value")).repartition(
        8, "value"
    ).write.mode("append").option("maxRecordsPerFile", 1).text(path)
    layer = geojson.read_geojson(spark, path, "site_id:bigint,c_mktsegment:string", keep_rejected=True)
    p = G.single_point("geom")
    return layer.selectExpr("site_id", "c_mktsegment", f"round({p}.x, 9) x", f"round({p}.y, 9) y", "reject_reason")


@query("scan_geojson_ranges", _SITES_BACK, layers=("sites",))
def scan_geojson_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """One document for all features, read in byte ranges."""
    path = scratch_path(spark, "sites")
    geojson.write_geojson(_sites(spark, sf), path, layout="document")
    return _back(geojson.read_geojson(spark, path, _SITE_PROPERTIES, layout="ranges"))


_MOVED_BACK = "select site_id, round(lon, 6) x, round(lat, 6) y, format, system from sites, " + (
    "(values ('geojson'), ('shapefile'), ('gpkg')) f(format), (values (2154), (3857), (32631)) s(system)"
)


@query("crs_of_files", _MOVED_BACK, layers=("sites",))
def crs_of_files(spark: SparkSession, sf: str) -> DataFrame:
    """Layers in other systems are written and read without naming the system again."""
    sites = _sites(spark, sf).select("site_id", "geom")
    p, parts = G.single_point("geom"), []
    for system in (2154, 3857, 32631):
        moved = crs.reproject(sites, system)
        for kind, read in (("geojson", geojson.read_geojson), ("shapefile", shapefile.read_shapefile), ("gpkg", gpkg.read_gpkg)):
            back = read(spark, sinks.write_layer(moved, scratch_path(spark, f"{kind}{system}"), kind))
            back = crs.reproject(back.select(F.col("site_id").cast("bigint"), "geom"), 4326)
            parts.append(back.selectExpr("site_id", f"round({p}.x, 6) x", f"round({p}.y, 6) y", f"'{kind}' format", f"{system} system"))
    return reduce(DataFrame.union, parts)


@query(
    "scan_geojson_inline",
    """select c_custkey // 100 doc, case when (c_custkey // 100) % 7 <> 3 then c_custkey end site_id,
       case when (c_custkey // 100) % 7 <> 3 then round(lon, 9) end x,
       case when (c_custkey // 100) % 7 = 3 then 'unreadable document' end reject_reason
       from (select *, site_id c_custkey from sites) group by all""",
    layers=("sites",),
)
def scan_geojson_inline(spark: SparkSession, sf: str) -> DataFrame:
    features = geojson.feature_text(L.sites(spark, sf).select("site_id", "geom")).select(
        "value", F.get_json_object("value", "$.properties.site_id").cast("bigint").alias("site_id")
    )
    body = F.array_join(F.array_sort(F.collect_list("value")), ",")
    documents = (
        features.groupBy(F.expr("site_id div 100").alias("doc"))
        .agg(body.alias("body"))
        .select("doc", F.expr("concat('{\"type\":\"FeatureCollection\",\"features\":[', body, if(doc % 7 = 3, '', ']}')) document"))
    )
    layer = geojson.parse_documents(documents, "document", "site_id:bigint", ["doc"])
    return layer.selectExpr("doc", "site_id", f"round({G.single_point('geom')}.x, 9) x", "reject_reason")


@query(
    "check_geojson",
    """select count(*) feature_count, CAST(count(*) filter (c_acctbal < 0) AS BIGINT) null_geometries, count(*) > 0 "valid" from customer""",
)
def check_geojson(spark: SparkSession, sf: str) -> DataFrame:
    layer = _sites(spark, sf).withColumn("geom", F.expr(f"if(c_acctbal < 0, {G.null_geom()}, geom)"))
    path = scratch_path(spark, "sites")
    geojson.write_geojson(layer, path)
    return geojson.check_geojson(spark, path)


# --- binary layers -------------------------------------------------------------------------


@query("scan_shapefile", _SITES_BACK, layers=("sites",))
def scan_shapefile(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "sites")
    shapefile.write_shapefile(_sites(spark, sf), path)
    return _back(shapefile.read_shapefile(spark, path, records_per_task=400).withColumnRenamed("c_mktsegme", "c_mktsegment"))


_WEDGES_BACK = """select wedge_id, p_size, round(leg * leg, 9) area, round(cx, 6) xmin, round(cy + 2 * leg, 6) ymax from wedges"""


def _wedges_back(df: DataFrame) -> DataFrame:
    measured = df.withColumn("area", F.expr(f"round({M.area('geom')}, 9)"))
    return edit.feature_bbox(measured).selectExpr(
        "wedge_id", "int(p_size) p_size", "area", "round(xmin, 6) xmin", "round(ymax, 6) ymax"
    )


@query("sink_shapefile", _WEDGES_BACK, layers=("wedges",))
def sink_shapefile(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "wedges")
    sinks.write_layer(L.wedges(spark, sf).select("wedge_id", "p_size", "geom"), path, "ESRI Shapefile")
    return _wedges_back(shapefile.read_shapefile(spark, path))


@query("scan_gpkg", _SITES_BACK, layers=("sites",))
def scan_gpkg(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "sites")
    gpkg.write_gpkg(_sites(spark, sf), path, layer="sites")
    return _back(gpkg.read_gpkg(spark, path, "sites", rows_per_task=400))


@query("sink_gpkg", _WEDGES_BACK, layers=("wedges",))
def sink_gpkg(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "wedges")
    sinks.write_layer(L.wedges(spark, sf).select("wedge_id", "p_size", "geom"), path, "gpkg")
    return _wedges_back(gpkg.read_gpkg(spark, path))


# --- other formats, as contents of many files ----------------------------------------------


def workbook_bytes(header: list[str], rows: list[list[object]], sheet: str = "Data") -> bytes:
    """A minimal workbook with one sheet of inline values."""

    def cell(value: object, ref: str) -> str:
        if value is None:
            return ""
        if isinstance(value, str):
            return f'<c r="{ref}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'
        return f'<c r="{ref}"><v>{value!r}</v></c>'

    lines = []
    for n, row in enumerate([header, *rows], start=1):
        cells = "".join(cell(v, f"{chr(65 + i)}{n}") for i, v in enumerate(row))
        lines.append(f'<row r="{n}">{cells}</row>')
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    members = {
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets>'
        f'<sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}"><Relationship Id="rId1" '
        f'Type="{office}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in members.items():
            book.writestr(name, text)
    return out.getvalue()


@query("scan_excel", _SITES_BACK, layers=("sites",))
def scan_excel(spark: SparkSession, sf: str) -> DataFrame:
    """Workbooks of at most ``FILE_ROWS`` rows with coordinate columns that become points."""

    def to_book(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        columns = ["site_id", "c_mktsegment", "c_acctbal", "lon", "lat"]
        rows = [[int(r[0]), r[1], float(r[2]), float(r[3]), float(r[4])] for r in pdf[columns].itertuples(index=False)]
        return pd.DataFrame({"path": [f"book{key[0]}.xlsx"], "content": [workbook_bytes(columns, rows)]})

    books = (
        L.layer_table(spark, sf, "sites")
        .groupBy(F.expr(f"site_id div {FILE_ROWS}"))
        .applyInPandas(to_book, "path string, content binary")
    )
    wanted = {"site_id": "bigint", "c_mktsegment": "string", "c_acctbal": "double", "lon": "double", "lat": "double"}
    return _back(points_from_xy(workbook.parse_workbooks(books, wanted)))


@query("scan_kml", _SITES_BACK, layers=("sites",))
def scan_kml(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of at most ``FILE_ROWS`` placemarks, one file each, read through the XML reader."""
    placemark = F.format_string(
        "<Placemark><name>%s</name><description>%s</description><ExtendedData><Data name=\"balance\"><value>%s</value></Data>"
        "</ExtendedData><Point><coordinates>%s,%s,0</coordinates></Point></Placemark>",
        F.col("site_id"), F.col("c_mktsegment"), F.col("c_acctbal").cast("string"), F.col("lon").cast("string"), F.col("lat").cast("string"),
    )
    path = scratch_path(spark, "sites")
    head = '<?xml version="1.0" encoding="UTF-8"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document>'
    documents = (
        L.layer_table(spark, sf, "sites")
        .groupBy(F.expr(f"site_id div {FILE_ROWS}").alias("doc"))
        .agg(F.concat(F.lit(head), F.array_join(F.collect_list(placemark), ""), F.lit("</Document></kml>")).alias("value"))
    )
    documents.write.partitionBy("doc").text(path)
    return _back(
        kml.read_kml(spark, path).selectExpr(
            "bigint(name) site_id", "description c_mktsegment", "double(data['balance']) c_acctbal", "geom"
        )
    )


@query(
    "scan_kml_mixed",
    """select site_id, unnest(['MultiPoint', 'MultiLineString']) kind, unnest([2, 3]) vertices from sites
       union all select site_id, 'Point', 1 from sites""",
    layers=("sites",),
)
def scan_kml_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Placemarks with points and a line in one geometry, and placemarks with a point."""
    at = F.format_string("%s,%s", F.col("lon").cast("string"), F.col("lat").cast("string"))
    dot = F.concat(F.lit("<Point><coordinates>"), at, F.lit("</coordinates></Point>"))
    path = F.concat(F.lit("<LineString><coordinates>0,0 1,1 "), at, F.lit("</coordinates></LineString>"))
    placemarks = F.concat(
        F.format_string("<Placemark><name>%s</name><MultiGeometry>", F.col("site_id")), dot, path, dot,
        F.format_string("</MultiGeometry></Placemark><Placemark><name>%s</name>", F.col("site_id")), dot, F.lit("</Placemark>"),
    )
    files = (
        L.layer_table(spark, sf, "sites")
        .groupBy(F.expr(f"string(site_id div {FILE_ROWS})").alias("path"))
        .agg(F.concat(F.lit("<kml><Document>"), F.array_join(F.collect_list(placemarks), ""), F.lit("</Document></kml>")).cast("binary").alias("content"))
    )
    return kml.parse_kml_files(files).selectExpr("bigint(name) site_id", "geom.type kind", f"int({G.vertex_count('geom')}) vertices")


@query(
    "scan_kml_folders",
    """select site_id, case when site_id % 3 = 0 then 'top' when site_id % 3 = 1 then 'A & B' else 'inner' end layer, round(lon, 9) x, round(lat, 9) y
       from sites where site_id % 3 <> 0
       union all select site_id, 'only', round(lon, 9), round(lat, 9) from sites where site_id % 3 = 1""",
    layers=("sites",),
)
def scan_kml_folders(spark: SparkSession, sf: str) -> DataFrame:
    """Folders inside folders: the layer of every placemark, and the placemarks of one layer."""
    mark = F.format_string(
        "<Placemark><name>%s</name><Point><coordinates>%s,%s</coordinates></Point></Placemark>",
        F.col("site_id"), F.col("lon").cast("string"), F.col("lat").cast("string"),
    )
    held = [F.array_join(F.collect_list(F.when(F.expr(f"site_id % 3 = {i}"), mark)), "") for i in range(3)]
    texts = ["<kml><Document><name>top</name>", "<Folder><name>A &amp; B</name>", "<Folder><name>inner</name>", "</Folder>", "</Folder></Document></kml>"]
    top, first, inner, end, foot = (F.lit(t) for t in texts)
    files = (
        L.layer_table(spark, sf, "sites")
        .groupBy(F.expr(f"string(site_id div {FILE_ROWS})").alias("path"))
        .agg(F.concat(top, held[0], first, inner, held[2], end, held[1], foot).cast("binary").alias("content"))
    )
    p = G.single_point("geom")
    every = kml.parse_kml_files(files).where("layer <> 'top'")
    one = kml.parse_kml_files(files, layer="A & B").withColumn("layer", F.lit("only"))
    return every.unionByName(one).selectExpr("bigint(name) site_id", "layer", f"round({p}.x, 9) x", f"round({p}.y, 9) y")


@query(
    "scan_dxf_curves",
    f"""select handle, entity, round(area, 9) area, round(length, 7) length, reason from (
         select CAST(parcel_id AS VARCHAR) handle, 'LWPOLYLINE' entity, half * half * (4 + 32 * sin(pi() / 32)) area,
           half * (4 + 128 * sin(pi() / 64)) length, null reason from parcels
         union all select CAST(parcel_id AS VARCHAR), 'POLYLINE', half * half * (4 + 32 * sin(pi() / 32)), half * (4 + 128 * sin(pi() / 64)), null from parcels
         union all select CAST(parcel_id AS VARCHAR), 'ARC', 0e0, half * 32 * sin(pi() / 64), null from parcels
         union all select CAST(parcel_id AS VARCHAR), 'TEXT', null, null, 'TEXT is not read' from parcels)""",
    layers=("parcels",),
)
def scan_dxf_curves(spark: SparkSession, sf: str) -> DataFrame:
    """Squares with half circles on two sides as polylines of both forms, quarter circles, and entities that are rejected."""

    def entity(kind: str, *pairs: tuple[int, str]) -> str:
        codes = [(0, f"'{kind}'"), (5, "string(parcel_id)"), (8, "p_brand"), *pairs]
        return "concat_ws('\\n', " + ", ".join(f"'{c}', {v}" for c, v in codes) + ")"

    corners = [("cx - half", "cy - half", 0), ("cx + half", "cy - half", 1), ("cx + half", "cy + half", 0), ("cx - half", "cy + half", 1)]
    at = [[(10, f"string({x})"), (20, f"string({y})"), (42, f"'{bulge}'")] for x, y, bulge in corners]
    light = entity("LWPOLYLINE", (70, "'1'"), *[pair for corner in at for pair in corner])
    members = ", ".join(entity("VERTEX", *corner) for corner in at)
    old = f"concat_ws('\\n', {entity('POLYLINE', (66, chr(39) + '1' + chr(39)), (70, chr(39) + '1' + chr(39)))}, {members}, {entity('SEQEND')})"
    arc = entity("ARC", (10, "string(cx)"), (20, "string(cy)"), (40, "string(half)"), (50, "'315'"), (51, "'45'"))
    note = entity("TEXT", (10, "string(cx)"), (20, "string(cy)"), (1, "'note'"))
    head, foot = "0\nSECTION\n2\nENTITIES\n", "\n0\nENDSEC\n0\nEOF\n"
    drawings = (
        L.layer_table(spark, sf, "parcels")
        .selectExpr(f"concat('parcels', parcel_id div {FILE_ROWS}, '.dxf') path", f"concat_ws('\\n', {light}, {old}, {arc}, {note}) entity")
        .groupBy("path")
        .agg(F.concat(F.lit(head), F.array_join(F.collect_list("entity"), "\n"), F.lit(foot)).cast("binary").alias("content"))
    )
    layer = edit.add_measures(dxf.parse_dxf_files(drawings, keep_rejected=True))
    return layer.select("handle", "entity", F.round("area", 9).alias("area"), F.round("length", 7).alias("length"), F.col("reject_reason").alias("reason"))


@query(
    "scan_dxf",
    """select CAST(parcel_id AS VARCHAR) handle, p_brand layer, 'LWPOLYLINE' entity, round(4 * half * half, 9) area,
       round(8 * half, 7) length from parcels where p_brand <> 'Brand#13'
       union all select CAST(street_id AS VARCHAR), 'ROAD', 'LINE', 0.0e0, round(sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)), 7) from streets""",
    layers=("parcels", "streets"),
)
def scan_dxf(spark: SparkSession, sf: str) -> DataFrame:
    """Drawings of at most ``FILE_ROWS`` entities: closed polylines and lines, some layers left out."""

    def codes(*pairs: str) -> str:
        return "concat_ws('\\n', " + ", ".join(pairs) + ")"

    corners = [("cx - half", "cy - half"), ("cx + half", "cy - half"), ("cx + half", "cy + half"), ("cx - half", "cy + half")]
    points = [t for x, y in corners for t in ("'10'", f"string({x})", "'20'", f"string({y})")]
    squares = L.layer_table(spark, sf, "parcels").selectExpr(
        f"concat('parcels', parcel_id div {FILE_ROWS}, '.dxf') path",
        codes("'0'", "'LWPOLYLINE'", "'5'", "string(parcel_id)", "'8'", "p_brand", "'90'", "'4'", "'70'", "'1'", *points) + " entity",
    )
    roads = L.layer_table(spark, sf, "streets").selectExpr(
        f"concat('streets', street_id div {FILE_ROWS}, '.dxf') path",
        codes("'0'", "'LINE'", "'5'", "string(street_id)", "'8'", "'ROAD'", "'10'", "string(x1)", "'20'", "string(y1)", "'11'", "string(x2)",
              "'21'", "string(y2)") + " entity",
    )
    head, foot = "0\nSECTION\n2\nENTITIES\n", "\n0\nENDSEC\n0\nEOF\n"
    drawings = squares.union(roads).groupBy("path").agg(
        F.concat(F.lit(head), F.array_join(F.collect_list("entity"), "\n"), F.lit(foot)).cast("binary").alias("content")
    )
    brands = [f"Brand#{i}" for i in range(1, 26) if i != 13]
    layer = edit.add_measures(dxf.parse_dxf_files(drawings, layers=",".join([*brands, "ROAD"])))
    return layer.select("handle", "layer", "entity", F.round("area", 9).alias("area"), F.round("length", 7).alias("length"))


_PIXELS_BACK = """select l_orderkey % 400 "row", l_partkey % 600 "col", round(avg(l_discount), 6) "value"
    from lineitem group by l_orderkey % 400, l_partkey % 600"""


@query("scan_pixels", _PIXELS_BACK)
def scan_pixels(spark: SparkSession, sf: str) -> DataFrame:
    """Two bands are written, one is read."""
    cells = table(spark, sf, "lineitem").groupBy(
        F.expr("l_orderkey % 400").alias("row"), F.expr("l_partkey % 600").alias("col")
    )
    bands = cells.agg(F.round(F.avg("l_quantity"), 6).alias("a"), F.round(F.avg("l_discount"), 6).alias("b")).selectExpr(
        "'r1' raster_id", "row", "col", "-4.5D + (col + 0.5D) * 0.02D x", "42.5D + (row + 0.5D) * 0.02D y",
        "inline(array(named_struct('band', 1, 'value', a), named_struct('band', 2, 'value', b)))",
    )
    path = scratch_path(spark, "pixels")
    pixels.write_pixels(bands, path)
    return pixels.read_pixels(spark, path, band=2).select("row", "col", "value")


# --- inventories ---------------------------------------------------------------------------

_SUFFIXES = [".csv", ".CSV", ".geojson", ".json", ".shp", ".zip", ".xlsx", ".gpkg", ".kmz", ".dxf", ".tif", ".txt", ""]
_TYPES = {
    ".csv": "csv", ".CSV": "csv", ".geojson": "geojson", ".shp": "shapefile", ".xlsx": "excel", ".gpkg": "gpkg",
    ".kmz": "kml", ".dxf": "dxf", ".tif": "geotiff",
}
_N = len(_SUFFIXES)
_TYPE_CASE = " ".join(f"when {i} then '{_TYPES[s]}'" for i, s in enumerate(_SUFFIXES) if s in _TYPES)


@query(
    "file_type_inventory",
    f"""select file_type, case when file_type is not null then file_type || '_reader' end reader, count(*) files,
       CAST(sum(n_chars) AS BIGINT) bytes from (
         select n_chars, case doc_id % {_N} {_TYPE_CASE}
           when {_SUFFIXES.index('.json')} then case when doc_id % 2 = 0 then 'geojson' end
           when {_SUFFIXES.index('.zip')} then case when doc_id % 3 = 0 then 'shapefile' end end file_type from documents)
       group by file_type""",
)
def file_type_inventory(spark: SparkSession, sf: str) -> DataFrame:
    suffixes = ", ".join(f"'{s}'" for s in _SUFFIXES)
    files = table(spark, sf, "documents").selectExpr(
        f"concat('up.load/file_', doc_id, element_at(array({suffixes}), int(doc_id % {_N}) + 1)) name",
        "concat(if(doc_id % 2 = 0, '{\"type\" : \"FeatureCollection\", ', '{\"kind\": '), text) head",
        "doc_id % 3 = 0 archive_ok",
        "n_chars",
    )
    return inventory.summarize_types(inventory.classify_files(files, "name", "head", "archive_ok"), "n_chars")


@query(
    "folder_inventory",
    f"""with d as (select c_custkey // {FILE_ROWS} doc, string_agg(c_name, '|') names from customer group by 1)
       select 'csv' file_type, 'csv_reader' reader, count(*) files, CAST(sum(length(names) + 1) AS BIGINT) bytes from d
       union all select 'geojson', 'geojson_reader', count(*), CAST(sum(length(names) + length('{{"type":"FeatureCollection","n":""}}') + 1) AS BIGINT) from d
       union all select null, null, 2 * count(*), CAST(sum(2 * length(names) + length('{{"n":""}}') + 2) AS BIGINT) from d""",
)
def folder_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """A folder of files by type: tables, layers, and texts that no reader takes."""
    path = scratch_path(spark, "folder")
    documents = (
        table(spark, sf, "customer")
        .groupBy(F.expr(f"c_custkey div {FILE_ROWS}").alias("doc"))
        .agg(F.array_join(F.collect_list("c_name"), "|").alias("n"))
    )
    documents.write.partitionBy("doc").csv(f"{path}/tables")
    documents.write.partitionBy("doc").text(f"{path}/notes")
    documents.write.partitionBy("doc").json(f"{path}/others")
    documents.select("doc", F.lit("FeatureCollection").alias("type"), "n").write.partitionBy("doc").json(f"{path}/layers")
    return inventory.inventory(spark, path)


_EXTENSIONS = [".shp", ".SHX", ".dbf", ".prj", ".cpg", ".txt", ".sbn", ".qix", ".shp.xml"]


@query(
    "shapefile_sets",
    """with e as (
         select 'a' || (doc_id % 40) archive, 'data/layer' || (doc_id % 3) || case when ext = '.xml' then '.shp' else '' end stem, ext
         from (select doc_id, ['.shp', '.shx', '.dbf', '.prj', '.cpg', '.txt', '.sbn', '.qix', '.xml'][CAST((doc_id // 7) % 9 AS INT) + 1] ext
               from documents) where ext <> '.txt'),
       s as (select archive, stem, string_agg(distinct ext, ',' order by ext) extensions, count(distinct ext) n
             from e group by archive, stem having count(distinct case when ext in ('.shp', '.shx', '.dbf') then ext end) = 3)
       select archive, stem, split_part(stem, '/', 2) layer_name, extensions,
         stem = min(stem) over (partition by archive) is_first,
         row_number() over (partition by archive order by n desc, stem) = 1 is_richest from s""",
)
def shapefile_sets(spark: SparkSession, sf: str) -> DataFrame:
    extensions = ", ".join(f"'{e}'" for e in _EXTENSIONS)
    entries = table(spark, sf, "documents").selectExpr(
        "concat('a', doc_id % 40) archive",
        f"concat('data\\\\layer', doc_id % 3, element_at(array({extensions}), int((doc_id div 7) % 9) + 1)) name",
    )
    return inventory.complete_sets(entries, "archive", "name")


# --- composed flow -------------------------------------------------------------------------


@query(
    "flow_lights",
    "select site_id, c_mktsegment, c_acctbal, round(lon, 9) x, round(lat, 9) y from sites where c_mktsegment = 'BUILDING'",
    layers=("sites",),
)
def flow_lights(spark: SparkSession, sf: str) -> DataFrame:
    """CSV with a detected separator, attribute filter, points from coordinate columns, GeoJSON, read back."""
    source, target = scratch_path(spark, "lights"), scratch_path(spark, "filtered")
    sites = L.layer_table(spark, sf, "sites").selectExpr("site_id", "c_mktsegment", "c_acctbal", "lon longitude", "lat latitude")
    delimited.write_csv(sites, source, delimiter=";")
    ddl = "site_id bigint, c_mktsegment string, c_acctbal double, longitude double, latitude double"
    flow = (
        delimited.read_csv(spark, source, schema=ddl)
        .transform(filter_rows, "c_mktsegment", "equals", "BUILDING")
        .transform(points_from_xy)
    )
    geojson.write_geojson(flow, target)
    return _back(geojson.read_geojson(spark, target, _SITE_PROPERTIES, layout="lines"))



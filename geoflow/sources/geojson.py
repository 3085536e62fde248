"""GeoJSON in two layouts: one feature per line (splittable) and whole FeatureCollection documents."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.layer import GEOM, describe, srid_of
from ..operators.lineage import scratch_path
from . import geojson_ranges, listing

_GEOMETRY = "struct<type:string,coordinates:string,geometries:array<struct<type:string,coordinates:string>>>"


#: The name in a crs member that stands on one line.
_CRS_MEMBER = r'"crs"\s*:\s*\{[^{}]*\{[^{}]*"name"\s*:\s*"([^"]*)"'


#: What only a feature has; a line with it that can't be read is a broken feature and no line around features.
_FEATURE_PART = r'"type"\s*:\s*"Feature"|"(geometry|coordinates)"\s*:|^\s*\{(?!.*"FeatureCollection").*"properties"\s*:'


def _feature_ddl(properties: str) -> str:
    return f"type string, properties struct<{properties}>, geometry {_GEOMETRY}"


def _nested(ddl: str) -> str:
    """Struct type with the fields of a table DDL."""
    return "struct<" + ", ".join(f.replace(" ", ":", 1) for f in re.split(r", (?=properties |geometry )", ddl)) + ">"


def _srid(name: str | None) -> int:
    """CRS of a ``crs`` member; GeoJSON without one is in longitude/latitude."""
    code = re.search(r"EPSG:+(\d+)", name or "")
    return int(code.group(1)) if code else 4326


def features_to_layer(features: DataFrame, keep: list[str], srid: int, geom: str = GEOM) -> DataFrame:
    """Rows with ``properties`` and ``geometry`` become a layer; members of collections become rows.

    ``reject_reason`` is set where a geometry is present but cannot be read.
    """
    members = F.expr(
        "if(geometry.type = 'GeometryCollection',"
        " transform(geometry.geometries, g -> named_struct('type', g.type, 'coordinates', g.coordinates)),"
        " array(named_struct('type', geometry.type, 'coordinates', geometry.coordinates)))"
    )
    shaped = features.select(*keep, "properties.*", F.explode_outer(members).alias("_m")).withColumn(
        geom, F.expr(G.from_geojson("_m.type", "_m.coordinates"))
    )
    bad = F.col(geom).isNull() & F.col("_m.type").isNotNull()
    return describe(
        shaped.withColumn("reject_reason", F.when(bad, F.lit("unreadable geometry"))).drop("_m"), geom, srid=srid
    )


def _infer_properties(spark: SparkSession, path: str | list[str], multiline: bool) -> dict[str, str]:
    """Attributes of features on their own, then those of features inside collections."""
    found = spark.read.option("multiLine", multiline).json(path).schema
    kinds = [found["properties"].dataType] if "properties" in found.fieldNames() else []
    if "features" in found.fieldNames():
        member = getattr(found["features"].dataType, "elementType", None)
        kinds += [member["properties"].dataType] if "properties" in getattr(member, "names", []) else []
    fields = [f for kind in kinds for f in getattr(kind, "fields", [])]
    return {f.name: f.dataType.simpleString() for f in reversed(fields)}


def _profile(spark: SparkSession, path: str) -> tuple[list[str], list[str], str | None]:
    """Files with a feature or a collection to a line, other files, and the name of the CRS.

    Collected are one row for each file, which the file index of the driver holds as well.
    """
    line = F.col("value")
    kind = F.from_json(line, "type string")["type"]
    started = kind.isNull() & line.rlike('"FeatureCollection".*"Feature"|^\\s*,\\s*\\{')
    files = (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.coalesce(kind.isin("Feature", "FeatureCollection"), F.lit(False)).alias("whole"),
            F.coalesce(started, F.lit(False)).alias("started"),
            F.nullif(F.regexp_extract(line, _CRS_MEMBER, 1), F.lit("")).alias("crs"),
        )
        .groupBy("file")
        .agg(F.max("whole").alias("whole"), F.max("started").alias("started"), F.min("crs").alias("low"), F.max("crs").alias("high"))
        .collect()
    )
    names = {n for f in files for n in (f.low, f.high) if n}
    if len({_srid(n) for n in names}) > 1:
        raise ValueError(f"the files under {path} have different coordinate systems: {sorted(names)}")
    # the scan names files as URIs
    lines = [unquote(f.file) for f in files if f.whole and not f.started]
    return lines, [unquote(f.file) for f in files if not f.whole or f.started], min(names, default=None)


def _line_features(spark: SparkSession, path: str | list[str], ddl: str) -> DataFrame:
    """Features of lines that hold one, of collections on one line, and a row with a reason for each broken line."""
    lines = spark.read.schema(f"{ddl}, features array<{_nested(ddl)}>, _corrupt_record string").json(path)
    # lines of the document around the features: brackets, members, and the opening of the list
    text = F.col("_corrupt_record")
    around = text.rlike('^[\\s\\[\\]{},]*$|^\\s*"|^\\s*\\{.*\\[\\s*$') & ~text.rlike(_FEATURE_PART)
    broken = text.isNotNull() & ~around
    own = F.struct("type", "properties", "geometry")
    held = F.when(broken | (F.col("type") == "Feature"), F.array(own)).when(F.col("type") == "FeatureCollection", F.col("features"))
    return lines.select(F.when(broken, "unreadable line").alias("_bad"), F.explode(held).alias("f")).select("f.*", "_bad")


def _document_features(spark: SparkSession, path: str | list[str], ddl: str) -> DataFrame:
    """Features of files that are one JSON value each; a row with a reason for each other file."""
    reader = spark.read.option("multiLine", True)
    documents = reader.schema(f"{ddl}, features array<{_nested(ddl)}>, _corrupt_record string").json(path)
    good = F.expr("_corrupt_record is null and (type = 'Feature' or type = 'FeatureCollection' and features is not null)")
    bad = ~F.coalesce(good, F.lit(False))
    own = F.struct("type", "properties", "geometry")
    held = F.when(bad | (F.col("type") == "Feature"), F.array(own)).otherwise(F.col("features"))
    return documents.select(F.when(bad, "unreadable document").alias("_bad"), F.explode(held).alias("f")).select("f.*", "_bad")


def _document_crs(spark: SparkSession, path: str | list[str]) -> str | None:
    documents = spark.read.option("multiLine", True).schema("crs struct<properties:struct<name:string>>").json(path)
    named = documents.select(F.col("crs.properties.name").alias("n")).where("n is not null").first()
    return named and named.n


def _range_features(texts: DataFrame, ddl: str) -> DataFrame:
    """Features of texts that hold one each, with a reason for each broken one."""
    corrupt = {"columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = texts.select(F.from_json("value", f"{ddl}, _corrupt_record string", corrupt).alias("f"))
    return parsed.select("f.type", "f.properties", "f.geometry", F.expr("if(f._corrupt_record is not null, 'unreadable feature', null)").alias("_bad"))


def read_geojson(
    spark: SparkSession,
    path: str,
    properties: str | None = None,
    layout: str | None = None,
    srid: int | None = None,
    keep_rejected: bool = False,
    geom: str = GEOM,
) -> DataFrame:
    """Read a layer.

    ``lines``: files with one feature or collection per line, or collections whose features stand
    on their own lines; these are split across tasks.  ``document``: each file is one JSON value; a
    collection larger than ``spark.sql.files.maxPartitionBytes`` is read in byte ranges, other files by
    one task each.  ``ranges``: collections of any size are read in byte ranges.  Without ``layout`` a
    pass over the text chooses for each file.  ``properties`` gives the attributes as DDL fields
    (``a:int,b:string``) and saves the pass that infers them, ``srid`` the look for a ``crs`` member.
    Features with unreadable geometries, broken lines and files that are no GeoJSON raise an error; with
    ``keep_rejected`` each is a row with a ``reject_reason``.  In byte ranges a document whose brackets
    don't close is one such row, and a broken feature between sound brackets another.
    """
    if layout not in (None, "lines", "document", "ranges"):
        raise ValueError(f"unknown layout {layout!r}; known: lines, document, ranges")
    ranged, refused, path = _by_ranges(spark, path, layout) if layout != "lines" else ([], 0, path)
    lines, documents, names = [], [], {d.crs for d in ranged if d.crs}
    if path and layout is None:
        lines, documents, name = _profile(spark, path)
        names |= {name} if name else set()
        # a folder of one layout is read as a whole
        lines, documents = (lines if documents else path), (documents if lines else path if documents else [])
    elif path and layout == "lines":
        lines = path
        if srid is None:
            head = spark.read.text(path).select(F.regexp_extract("value", _CRS_MEMBER, 1).alias("n")).where("n != ''").first()
            names |= {head.n} if head else set()
    elif path:
        documents = path
    if srid is None:
        name = _document_crs(spark, documents) if documents and layout else None
        names |= {name} if name else set()
        if len({_srid(n) for n in names}) > 1:
            raise ValueError(f"the files under {path} have different coordinate systems: {sorted(names)}")
        srid = _srid(min(names, default=None))
    texts = geojson_ranges.feature_texts(spark, ranged) if ranged else None
    if properties is None:
        found = {}
        if ranged:
            # line breaks in a feature are white space
            written = scratch_path(spark, "features")
            texts.select(F.translate("value", "\r\n", "  ").alias("value")).write.text(written)
            texts = spark.read.text(written)
            found |= _infer_properties(spark, written, False)
        for files, multiline in ((documents, True), (lines, False)):
            found |= _infer_properties(spark, files, multiline) if files else {}
        properties = ",".join(f"`{n}`:{kind}" for n, kind in found.items())
    ddl = _feature_ddl(properties)
    parts = [_line_features(spark, lines, ddl)] if lines else []
    parts += [_document_features(spark, documents, ddl)] if documents else []
    parts += [_range_features(texts, ddl)] if ranged else []
    if refused:
        bad = spark.range(refused).select(F.from_json(F.lit("{}"), ddl).alias("f"), F.lit("unreadable document").alias("_bad"))
        parts.append(bad.select("f.*", "_bad"))
    features = reduce(DataFrame.union, parts)
    layer = features_to_layer(features.where("type = 'Feature' or _bad is not null"), ["_bad"], srid, geom)
    layer = layer.withColumn("reject_reason", F.coalesce("_bad", "reject_reason")).drop("_bad")
    if keep_rejected:
        return layer
    stop = "raise_error(concat('GeoJSON that can not be read: ', reject_reason))"
    return layer.where(F.expr(f"if(reject_reason is null, true, {stop})")).drop("reject_reason")


def _by_ranges(
    spark: SparkSession, path: str | list[str], layout: str | None
) -> tuple[list[geojson_ranges.Document], int, str | list[str]]:
    """Collections to be read in byte ranges, number of documents that don't close, and what is left for the other ways."""
    large = listing.files(spark, path, -1 if layout == "ranges" else listing.split_bytes(spark))
    large = [f for f in large if not f.endswith((".gz", ".bz2", ".zst", ".lz4", ".snappy", ".xz", ".deflate"))]
    known = geojson_ranges.documents(spark, large) if large else []
    ranged = [d for d in known if d.collection]
    # without a layout, what does not close may be a file of lines
    broken = [d for d in known if layout and not d.closed]
    if not ranged and not broken:
        return [], 0, path
    taken = {d.path for d in ranged + broken}
    return ranged, len(broken), [f for f in listing.files(spark, path) if f not in taken]


def parse_documents(
    df: DataFrame, column: str, properties: str, keep: list[str], srid: int = 4326, geom: str = GEOM
) -> DataFrame:
    """Explode a column of FeatureCollection documents into features.

    Documents that do not parse stay as one row with a ``reject_reason``.
    """
    ddl = f"type string, features array<{_nested(_feature_ddl(properties))}>"
    parsed = df.select(*keep, F.from_json(column, ddl).alias("_doc"))
    good = F.expr("_doc.type = 'FeatureCollection' and _doc.features is not null")
    features = parsed.where(good).select(*keep, F.expr("inline(_doc.features)"))
    layer = features_to_layer(features.where("type = 'Feature'"), keep, srid, geom)
    rejected = parsed.where(~F.coalesce(good, F.lit(False))).select(
        *keep, F.lit("unreadable document").alias("reject_reason")
    )
    return describe(layer.unionByName(rejected, allowMissingColumns=True), geom, srid=srid)


def feature_text(df: DataFrame, geom: str = GEOM) -> DataFrame:
    """One GeoJSON feature per row, as text in ``value``."""
    attributes = [c for c in df.columns if c != geom]
    properties = (
        F.to_json(F.struct(*attributes), {"ignoreNullFields": "false"}) if attributes else F.lit("{}")
    )
    return df.select(
        F.concat(
            F.lit('{"type":"Feature","properties":'), properties,
            F.lit(',"geometry":'), F.expr(G.to_geojson(geom)), F.lit("}"),
        ).alias("value")
    )


def _crs_member(srid: int) -> str:
    name = "urn:ogc:def:crs:OGC:1.3:CRS84" if srid == 4326 else f"urn:ogc:def:crs:EPSG::{srid}"
    return f'"crs":{{"type":"name","properties":{{"name":"{name}"}}}}'


def write_geojson(
    df: DataFrame, path: str, layout: str = "lines", geom: str = GEOM, mode: str = "errorifexists"
) -> None:
    """Write features as text: ``lines`` in parallel, ``document`` as one FeatureCollection by one task.

    The coordinate system stands in a ``crs`` member of the document; in ``lines`` each file begins
    with an empty collection that has it.
    """
    lines = feature_text(df, geom)
    member = _crs_member(srid_of(df, geom) or 4326)
    if layout == "lines":
        head = f'{{"type":"FeatureCollection",{member},"features":[]}}\n'
        first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
        lines.select(F.concat(F.when(first, head).otherwise(""), "value").alias("value")).write.mode(mode).text(path)
        return
    if layout != "document":
        raise ValueError(f"unknown layout {layout!r}; known: lines, document")
    head, foot = f'{{"type":"FeatureCollection",{member},"features":[', "]}"
    total = df.count()
    if total == 0:
        df.sparkSession.createDataFrame([(head + foot,)], "value string").write.mode(mode).text(path)
        return
    # a single JSON value has one writer by nature; only the finished text goes to it
    numbered = lines.repartition(1).withColumn("_n", F.monotonically_increasing_id())
    framed = F.concat(
        F.when(F.col("_n") == 0, head + "\n").otherwise(""),
        F.col("value"),
        F.when(F.col("_n") == total - 1, "\n" + foot).otherwise(","),
    )
    numbered.select(framed.alias("value")).write.mode(mode).text(path)


def check_geojson(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """One row about a written layer: feature and null-geometry counts, ``valid`` when it has features and nothing broken."""
    layer = read_geojson(spark, path, properties="_none:string", layout=layout, srid=4326, keep_rejected=True)
    broken = F.coalesce(F.col("reject_reason").isin("unreadable line", "unreadable document"), F.lit(False))
    return layer.agg(
        F.count_if(~broken).alias("feature_count"),
        F.count_if(~broken & F.col(GEOM)["type"].isNull()).alias("null_geometries"),
        F.count_if(broken).alias("broken"),
    ).select("feature_count", "null_geometries", F.expr("feature_count > 0 and broken = 0").alias("valid"))

"""What lies in a folder: file types, suggested readers, complete shapefile sets."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# File suffixes by type, and the reader suggested for each type.
SUFFIXES = {
    "shapefile": [".shp", ".zip"],
    "excel": [".xlsx", ".xls"],
    "csv": [".csv"],
    "gpkg": [".gpkg"],
    "kml": [".kml", ".kmz"],
    "dxf": [".dxf"],
    "geotiff": [".tif", ".tiff", ".geotiff"],
    "geojson": [".geojson", ".json"],
}
READERS = {
    "shapefile": "shapefile_reader", "excel": "excel_reader", "csv": "csv_reader", "gpkg": "gpkg_reader",
    "kml": "kml_reader", "dxf": "dxf_reader", "geotiff": "geotiff_reader", "geojson": "geojson_reader",
}
GEOJSON_PROBE = r'"type"\s*:\s*"(FeatureCollection|Feature|Geometry)"'

SHAPEFILE_REQUIRED = [".shp", ".shx", ".dbf"]
SHAPEFILE_SIDECARS = [".prj", ".cpg", ".sbn", ".sbx", ".xml", ".qix", ".fix"]


def suffix_of(name: str) -> Column:
    """Lower-case suffix with its dot, empty when the name has none."""
    return F.regexp_extract(F.lower(name), r"[^/\\](\.[^./\\]+)$", 1)


def classify_files(files: DataFrame, name: str, head: str, archive_ok: str | None = None) -> DataFrame:
    """Add ``file_type`` and ``reader``; null for files no reader takes.

    ``.json`` needs a GeoJSON type in ``head`` (text from the start of the file); ``.zip`` needs
    ``archive_ok``, a column that tells whether the archive holds a complete shapefile set.
    """
    suffix = suffix_of(name)
    zip_ok = F.coalesce(F.col(archive_ok), F.lit(False)) if archive_ok else F.lit(False)
    kind = F.when((suffix == ".zip") & ~zip_ok, None).when(
        (suffix == ".json") & ~F.coalesce(F.col(head).rlike(GEOJSON_PROBE), F.lit(False)), None
    )
    for name_, suffixes in SUFFIXES.items():
        kind = kind.when(suffix.isin(*suffixes), name_)
    readers = F.create_map(*[F.lit(v) for kv in READERS.items() for v in kv])
    return files.withColumn("file_type", kind).withColumn("reader", F.try_element_at(readers, F.col("file_type")))


def summarize_types(classified: DataFrame, size: str) -> DataFrame:
    return classified.groupBy("file_type", "reader").agg(
        F.count(F.lit(1)).alias("files"), F.sum(size).cast("bigint").alias("bytes")
    )


def complete_sets(entries: DataFrame, archive: str, name: str) -> DataFrame:
    """Complete shapefile sets per archive or folder, with their extensions.

    ``is_first`` marks the set a reader takes by default (first by name), ``is_richest`` the one an
    import takes (most files, then first).
    """
    known = SHAPEFILE_REQUIRED + SHAPEFILE_SIDECARS
    path = F.replace(F.col(name), F.lit("\\"), F.lit("/"))
    parts = entries.select(
        F.col(archive).alias("archive"),
        F.regexp_replace(path, r"\.[^./]+$", "").alias("stem"),
        suffix_of(name).alias("ext"),
    ).where(F.col("ext").isin(*known))
    # the set of extensions is bounded by the list of known ones
    sets = (
        parts.groupBy("archive", "stem")
        .agg(F.array_sort(F.collect_set("ext")).alias("extensions"))
        .where(F.size(F.array_except(F.array(*[F.lit(e) for e in SHAPEFILE_REQUIRED]), "extensions")) == 0)
        .withColumn("layer_name", F.regexp_extract("stem", r"([^/]+)$", 1))
    )
    chosen = sets.groupBy("archive").agg(
        F.min("stem").alias("_first"),
        F.min(F.struct((-F.size("extensions")).alias("n"), "stem")).alias("_rich"),
    )
    return sets.join(chosen, "archive").select(
        "archive", "stem", "layer_name", F.array_join("extensions", ",").alias("extensions"),
        (F.col("stem") == F.col("_first")).alias("is_first"),
        (F.col("stem") == F.col("_rich.stem")).alias("is_richest"),
    )


def list_archive_entries(files: DataFrame) -> DataFrame:
    """Entry names of zip archives given as ``path, content`` rows."""

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    rows += [(path, n) for n in archive.namelist() if not n.endswith("/")]
            yield pd.DataFrame(rows, columns=["path", "entry"])

    return files.select("path", "content").mapInPandas(entries, "path string, entry string")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files below a folder with ``path``, ``length`` and ``content``; unread columns are not loaded."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Number and size of the files of each type below a folder."""
    files = list_files(spark, folder)
    zips = files.where(F.lower("path").endswith(".zip"))
    sets = complete_sets(list_archive_entries(zips), "path", "entry").select("archive").distinct()
    heads = files.select(
        "path", "length", F.when(F.lower("path").endswith(".json"), F.col("content").substr(1, 65536).cast("string")).alias("head")
    )
    marked = heads.join(sets, F.col("path") == F.col("archive"), "left").withColumn(
        "archive_ok", F.col("archive").isNotNull()
    )
    return summarize_types(classify_files(marked, "path", "head", "archive_ok"), "length")

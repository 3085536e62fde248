"""One entry point for writing layers, and the log of a flow's steps."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from .delimited import write_csv
from .geojson import write_geojson
from .gpkg import write_gpkg
from .shapefile import local_path, write_shapefile

# Format names and the suffix each one is known by.
FORMATS = {"geojson": ".geojson", "json": ".json", "csv": ".csv", "shapefile": ".shp", "gpkg": ".gpkg"}


def write_layer(df: DataFrame, path: str, format: str | None = None, mode: str = "errorifexists") -> str:
    """Write a layer; without ``format`` the suffix of the path decides, GeoJSON when it says nothing."""
    kind = (format or "").lower()
    if not kind:
        kind = next((f for f, suffix in FORMATS.items() if path.lower().endswith(suffix)), "geojson")
    kind = "shapefile" if "shape" in kind or kind == "shp" else kind
    if kind not in FORMATS:
        raise ValueError(f"unknown format {format!r}; known: {sorted(FORMATS)}")
    if kind == "csv":
        write_csv(df, path, mode=mode)
    elif kind in ("shapefile", "gpkg"):
        if mode not in ("append", "overwrite") and os.path.exists(local_path(path)):
            if mode == "ignore":
                return path
            raise FileExistsError(f"{path} exists")
        (write_shapefile if kind == "shapefile" else write_gpkg)(df, path, mode="overwrite" if mode == "overwrite" else "append")
    else:
        write_geojson(df, path, mode=mode)
    return path


def append_log(spark: SparkSession, path: str, flow: str, counts: dict[str, int]) -> DataFrame:
    """Append one JSON line per step with its row count and return the lines."""
    rows = [(flow, position, step, n) for position, (step, n) in enumerate(counts.items(), start=1)]
    log = spark.createDataFrame(rows, "flow string, position int, step string, row_count bigint")
    log.coalesce(1).write.mode("append").json(path)
    return log

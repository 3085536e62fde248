"""Rasters stored as pixel tables: ``raster_id, band, row, col, x, y, value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.spatial import point_layer


def read_pixels(spark: SparkSession, path: str, band: int = 1, srid: int = 4326, format: str = "parquet") -> DataFrame:
    """One band of a pixel table with the cell centres as points; the band filter reaches the scan."""
    rows = spark.read.format(format).load(path).where(F.col("band") == band)
    return point_layer(rows, "x", "y", srid)


def write_pixels(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a pixel table with one folder per band."""
    df.write.mode(mode).partitionBy("band").parquet(path)

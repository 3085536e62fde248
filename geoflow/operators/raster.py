"""Rasters as pixel tables: one row per cell with its centre as a point geometry and a value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.layer import GEOM
from .spatial import matching_pairs, row_key, spatial_join


def raster_stats(pixels: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, minimum, maximum and mean per raster and band."""
    return pixels.groupBy(*by).agg(
        F.count(value).alias("n"), F.min(value).alias("vmin"), F.max(value).alias("vmax"), F.avg(value).alias("vavg")
    )


def raster_clip(pixels: DataFrame, mask: DataFrame, pixel_id: str, mask_id: str, geom: str = GEOM) -> DataFrame:
    """Pixels whose centre lies in the mask, edges included."""
    keyed = pixels.withColumn("_key", row_key(pixels))
    inside = matching_pairs(keyed, mask, "_key", mask_id, "intersects", geom=geom).select("_lid").distinct()
    return keyed.join(inside, F.col("_key") == F.col("_lid"), "left_semi").drop("_key")


def zonal_stats(
    pixels: DataFrame, zones: DataFrame, pixel_id: str, zone_id: str, value: str, predicate: str = "intersects"
) -> DataFrame:
    """Statistics of the pixels of each zone, combined before the shuffle; zones without pixels do not appear."""
    slim = zones.select(zone_id, GEOM)
    joined = spatial_join(pixels.select(F.col(pixel_id).alias("_pixel"), F.col(value).alias("_value"), GEOM), slim, "_pixel", zone_id, predicate)
    v = F.col("_value")
    return joined.groupBy(zone_id).agg(
        F.count(v).alias("n"),
        F.min(v).alias("vmin"),
        F.max(v).alias("vmax"),
        F.avg(v).alias("vavg"),
        F.sum(v).alias("vsum"),
        F.stddev_samp(v).alias("vstd"),
    )

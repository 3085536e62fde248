"""First rows, first features and pages, for looking at data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.crs import reproject_geom
from ..functions.layer import GEOM, srid_of

ROW_LIMIT = 50
FEATURE_LIMIT = 2500


def preview_rows(df: DataFrame, order_by: str, limit: int = ROW_LIMIT) -> DataFrame:
    """The first rows with the number of all rows in ``total``."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.orderBy(order_by).limit(limit).withColumn("total", total)


def preview_features(df: DataFrame, order_by: str, limit: int = FEATURE_LIMIT, geom: str = GEOM) -> DataFrame:
    """The first features with native and WGS84 GeoJSON, geometry type, total and a truncation flag.

    The limit comes first, so only the shown features are moved and serialised.
    """
    srid = srid_of(df, geom) or 4326
    total = df.agg(F.count(F.lit(1))).scalar()
    head = df.orderBy(order_by).limit(limit)
    return (
        head.withColumn("_geom", F.col(geom)["type"])
        .withColumn("geojson", F.expr(G.to_geojson(geom)))
        .withColumn("_moved", F.expr(reproject_geom(geom, srid, 4326)))
        .withColumn("map_geojson", F.expr(G.to_geojson("_moved")))
        .withColumn("total", total)
        .withColumn("truncated", F.col("total") > limit)
        .drop(geom, "_moved")
    )


def page_rows(
    df: DataFrame, order_by: str, size: int | None = ROW_LIMIT, page: int = 1, after: object = None
) -> DataFrame:
    """One page in the order of a unique column; ``size=None`` is everything.

    Pass the last value seen as ``after`` for deep pages: it becomes a pushed-down filter, where
    ``page`` has to skip rows.
    """
    if size is None:
        return df
    if after is not None:
        return df.where(F.col(order_by) > F.lit(after)).orderBy(order_by).limit(size)
    ordered = df.orderBy(order_by)
    return ordered.limit(size) if page <= 1 else ordered.offset((page - 1) * size).limit(size)

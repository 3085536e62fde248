"""Routing: rows get a ``port`` column; :func:`take_port` selects one output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.layer import GEOM
from ..functions.text import as_text
from .lineage import cut_lineage

PORT = "port"


def take_port(df: DataFrame, port: str) -> DataFrame:
    return df.where(F.col(PORT) == port).drop(PORT)


def split_by_value(df: DataFrame, field: str) -> DataFrame:
    """The port is the text of the field (null stays null); write with ``partitionBy('port')`` for one output each."""
    return df.withColumn(PORT, as_text(df, field))


def tester(df: DataFrame, passes: Column) -> DataFrame:
    """``passed`` or ``failed``; an unknown outcome fails."""
    return df.withColumn(PORT, F.when(passes, "passed").otherwise("failed"))


def switch(df: DataFrame, conditions: Sequence[Column], names: Sequence[str] | None = None) -> DataFrame:
    """Port of the first condition that holds (``output1``, ``output2``...), or ``else``."""
    names = names or [f"output{i}" for i in range(1, len(conditions) + 1)]
    choice = None
    for name, held in zip(names, conditions, strict=True):
        choice = F.when(held, name) if choice is None else choice.when(held, name)
    return df.withColumn(PORT, F.lit("else") if choice is None else choice.otherwise("else"))


def geometry_filter(df: DataFrame, geom: str = GEOM) -> DataFrame:
    t = F.col(geom)["type"]
    port = (
        F.when(t.isNull(), "null")
        .when(t.isin("Point", "MultiPoint"), "point")
        .when(t.isin("LineString", "MultiLineString"), "line")
        .when(t == "Polygon", "polygon")
        .when(t == "MultiPolygon", "multipolygon")
        .otherwise("else")
    )
    return df.withColumn(PORT, port)


def duplicate_filter(df: DataFrame, keys: Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """``unique`` for one row of each key, the first in the order of the columns, ``duplicate`` for the rest.

    Nulls come last, a null key is a key like any other, and rows that are equal in the order go by a
    hash of all their columns.  The rows get numbers first and are written with them, so the first of a
    key is one row even among rows that are the same; it comes from a map-side combined ``min``, so a
    key that holds a large share of the rows never meets in one task.
    """
    orders = [order_by] if isinstance(order_by, str) else list(order_by)
    numbered = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
    place = [x for i, c in enumerate(orders) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))]
    place += [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("h"), F.col("_row")]
    firsts = numbered.groupBy(*keys).agg(F.min(F.struct(*place)).alias("_first")).select(F.col("_first._row").alias("_found"))
    return (
        numbered.join(firsts, F.col("_row") == F.col("_found"), "left")
        .withColumn(PORT, F.when(F.col("_found").isNotNull(), "unique").otherwise("duplicate"))
        .drop("_row", "_found")
    )


def reject_where(df: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    """Add ``reject_reason``: the name of the first check that fails, null for good rows."""
    choice = None
    for reason, bad in reasons.items():
        choice = F.when(bad, reason) if choice is None else choice.when(bad, reason)
    return df.withColumn("reject_reason", choice if choice is not None else F.lit(None).cast("string"))


def split_rejected(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with their reason)."""
    bad = F.col("reject_reason").isNotNull()
    return df.where(~bad).drop("reject_reason"), df.where(bad)

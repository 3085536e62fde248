"""Spatial tables in a database, read and written in parallel with the geometry as WKB."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.layer import GEOM, describe
from .columnar import GEOM_ARROW, geometry_type
from .wkb import decode, encode


# These objects stand apart from the functions that other formats send to the workers: once used they hold a handle of the JVM.
@F.arrow_udf(T.BinaryType())
def to_wkb(geoms: pa.Array) -> pa.Array:
    return pa.array([encode(g) for g in geoms.to_pylist()], pa.binary())


@F.arrow_udf(geometry_type())
def from_wkb(values: pa.Array) -> pa.Array:
    return pa.array([decode(v) for v in values.to_pylist()], GEOM_ARROW)


def read_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int = 1,
    **extra: str,
) -> dict[str, str]:
    """Options of a partitioned read; ``lower``/``upper`` only place the cuts, no row is left out."""
    options = {"url": url, "dbtable": table, **extra}
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("a partition column needs lower and upper bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession, url: str, table: str, wkb_column: str | None = None, srid: int = 4326, geom: str = GEOM, **options: object
) -> DataFrame:
    """Read a table or a parenthesised query; ``wkb_column`` (for instance ``ST_AsBinary(...)``) becomes the geometry."""
    df = spark.read.format("jdbc").options(**read_options(url, table, **options)).load()
    if wkb_column is None:
        return df
    return describe(df.withColumn(geom, from_wkb(wkb_column)).drop(wkb_column), geom, srid=srid)


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "append", wkb_column: str = "geom_wkb", geom: str = GEOM, **options: str
) -> None:
    """Write attributes and the geometry as WKB, one connection per partition."""
    rows = df.withColumn(wkb_column, to_wkb(F.col(geom))).drop(geom) if geom in df.columns else df
    rows.write.format("jdbc").options(url=url, dbtable=table, **options).mode(mode).save()

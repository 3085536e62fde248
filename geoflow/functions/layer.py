"""What is known about a layer without reading it, kept as metadata of its geometry column.

Schema metadata costs no data column and survives projections, filters and joins.  ``srid`` is the
coordinate system; ``kind`` is set to ``Point`` when every geometry of the layer is a single point,
which lets spatial joins skip looking for feature sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GEOM = "geom"


def describe(df: DataFrame, geom: str = GEOM, **facts: object) -> DataFrame:
    """Set facts (``srid``, ``kind``) on the geometry column; ``None`` removes one."""
    known = {**df.schema[geom].metadata, **facts}
    known = {k: v for k, v in known.items() if v is not None}
    return df.withColumn(geom, F.col(geom).alias(geom, metadata=known))


def replace_geom(df: DataFrame, value, geom: str = GEOM, **facts: object) -> DataFrame:
    """Overwrite the geometry and carry the layer's coordinate system over."""
    srid = df.schema[geom].metadata.get("srid")
    return describe(df.withColumn(geom, value), geom, **{"srid": srid, **facts})


def srid_of(df: DataFrame, geom: str = GEOM) -> int | None:
    return df.schema[geom].metadata.get("srid")


def is_point_layer(df: DataFrame, geom: str = GEOM) -> bool:
    return df.schema[geom].metadata.get("kind") == "Point"

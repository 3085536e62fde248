"""Point layers from tables with coordinate columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.crs import check_srid
from ..functions.layer import GEOM
from ..functions.text import find_xy_columns, parse_coord
from .profile import infer_crs
from .spatial import point_layer


def coordinate(df: DataFrame, name: str) -> Column:
    """A column as a coordinate: numbers as they are, text parsed."""
    numeric = isinstance(df.schema[name].dataType, T.NumericType)
    return F.col(f"`{name}`").cast("double") if numeric else parse_coord(F.col(f"`{name}`"))


def points_from_xy(
    df: DataFrame, lon_col: str | None = None, lat_col: str | None = None, srid: int | None = None, geom: str = GEOM
) -> DataFrame:
    """Points from coordinate columns, found by name when not given; rows with bad coordinates are dropped.

    A given system other than 4326 is taken; else it is inferred from the numbers (one pass).
    """
    found = (lon_col, lat_col) if lon_col and lat_col else find_xy_columns(df.columns)
    if not all(found):
        raise ValueError("no coordinate columns found (x/y or lon/lat)")
    parsed = df.withColumns({"_x": coordinate(df, found[0]), "_y": coordinate(df, found[1])})
    if srid in (None, 4326):
        srid = infer_crs(parsed, "_x", "_y").first().srid
    return point_layer(parsed, "_x", "_y", check_srid(srid), geom).drop("_x", "_y")

"""Counts and summaries of tables and layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as G
from ..functions.crs import reproject_geom
from ..functions.layer import GEOM, is_point_layer, srid_of
from ..functions.text import parse_coord


class StepCounts:
    """Row counts of the steps of a flow, gathered while an action runs it (no extra pass)."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, step: str) -> DataFrame:
        observation = Observation(step)
        self._seen[step] = observation
        return df.observe(observation, F.count(F.lit(1)).alias("row_count"))

    def result(self) -> dict[str, int]:
        """Counts by step; waits for the action."""
        return {step: o.get["row_count"] for step, o in self._seen.items()}


def layer_profile(df: DataFrame, geom: str = GEOM) -> DataFrame:
    """One row: feature count, attribute columns, CRS, native and WGS84 bounds, sorted geometry types."""
    srid = srid_of(df, geom) or 4326
    points = is_point_layer(df, geom)
    box = G.point_box if points else G.bbox
    boxes = df.select(
        F.col(geom)["type"].alias("kind"),
        F.expr(box(geom)).alias("native"),
        F.expr(f"{reproject_geom(geom, srid, 4326, points)}").alias("moved"),
    ).select("kind", "native", F.expr(box("moved")).alias("wgs84"))
    edges = [("xmin", F.min), ("ymin", F.min), ("xmax", F.max), ("ymax", F.max)]
    return boxes.agg(
        F.count(F.lit(1)).alias("feature_count"),
        *[f(F.col(side)[e]).alias(f"{side}_{e}") for side in ("native", "wgs84") for e, f in edges],
        F.array_join(F.sort_array(F.collect_set("kind")), ",").alias("geometry_types"),
    ).select(
        "*",
        F.lit(f"EPSG:{srid}").alias("crs"),
        F.lit(",".join(c for c in df.columns if c != geom)).alias("columns"),
    )


# The number ranges that tell coordinate systems apart.
GEOGRAPHIC_X, GEOGRAPHIC_Y = 180.0, 90.0
LAMBERT_X, LAMBERT_Y = (100_000.0, 1_300_000.0), (6_000_000.0, 7_500_000.0)
WEB_LIMIT = 1_000_000.0


class _MedianTest:
    """Compares the median of a column with constants in one map-side combined pass.

    The median itself would need a sort; which side of a constant it lies on only needs the number
    of values below, and the two values around the constant when it falls between the middle two.
    """

    def __init__(self, value: Column, prefix: str, less: list[float], at_most: list[float]) -> None:
        self.prefix = prefix
        self.tests = [("lt", t) for t in less] + [("le", t) for t in at_most]
        self.aggregates = []
        for i, (op, t) in enumerate(self.tests):
            below = value < t if op == "lt" else value <= t
            self.aggregates += [
                F.count(F.when(below, 1)).alias(f"{prefix}{i}_n"),
                F.max(F.when(below, value)).alias(f"{prefix}{i}_lo"),
                F.min(F.when(~below, value)).alias(f"{prefix}{i}_hi"),
            ]

    def _below(self, op: str, t: float) -> Column:
        n = f"{self.prefix}{self.tests.index((op, t))}"
        middle = (F.col(f"{n}_lo") + F.col(f"{n}_hi")) / 2
        between = middle < t if op == "lt" else middle <= t
        twice = 2 * F.col(f"{n}_n")
        return F.when(twice > F.col("n"), True).when(twice == F.col("n"), between).otherwise(False)

    def less(self, t: float) -> Column:
        return self._below("lt", t)

    def at_most(self, t: float) -> Column:
        return self._below("le", t)


def infer_crs(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row with ``srid`` guessed from all coordinates; unparsable rows are skipped.

    Medians and maxima within the degrees mean 4326; medians in the national range mean 2154; a
    median beyond a million means 3857; everything else 4326.
    """

    def number(name: str) -> Column:
        numeric = isinstance(df.schema[name].dataType, T.NumericType)
        return F.col(name).cast("double") if numeric else parse_coord(name)

    parsed = df.select(number(x).alias("x"), number(y).alias("y")).where(
        f"{G.is_finite('x')} and {G.is_finite('y')}"
    )
    mx = _MedianTest(
        F.col("x"), "x", [-WEB_LIMIT, -GEOGRAPHIC_X, LAMBERT_X[1]], [GEOGRAPHIC_X, LAMBERT_X[0], WEB_LIMIT]
    )
    my = _MedianTest(
        F.col("y"), "y", [-WEB_LIMIT, -GEOGRAPHIC_Y, LAMBERT_Y[1]], [GEOGRAPHIC_Y, LAMBERT_Y[0], WEB_LIMIT]
    )
    seen = parsed.agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.abs("x")).alias("far_x"),
        F.max(F.abs("y")).alias("far_y"),
        *mx.aggregates,
        *my.aggregates,
    )
    degrees = (
        mx.at_most(GEOGRAPHIC_X)
        & ~mx.less(-GEOGRAPHIC_X)
        & my.at_most(GEOGRAPHIC_Y)
        & ~my.less(-GEOGRAPHIC_Y)
        & (F.col("far_x") <= GEOGRAPHIC_X)
        & (F.col("far_y") <= GEOGRAPHIC_Y)
    )
    national = (
        ~mx.at_most(LAMBERT_X[0]) & mx.less(LAMBERT_X[1]) & ~my.at_most(LAMBERT_Y[0]) & my.less(LAMBERT_Y[1])
    )
    far = (
        ~mx.at_most(WEB_LIMIT) | mx.less(-WEB_LIMIT) | ~my.at_most(WEB_LIMIT) | my.less(-WEB_LIMIT)
    )
    srid = F.when(F.col("n") == 0, 4326).when(degrees, 4326).when(national, 2154).when(far, 3857).otherwise(4326)
    return seen.select(srid.alias("srid"), F.col("n").alias("parsed"))

"""Attribute edits: rename, delete, create, counters, value lookups, list attributes, column names."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_name
from .gridjoin import is_small

# Order values are cut into ranges of about this many rows when a long sequence is numbered, ...
RANGE_ROWS = 1_000_000
# ... but not into fewer ranges, so that all cores have work, nor into more, as the limits travel with the plan.
MIN_RANGES, MAX_RANGES = 64, 65_536


def edit_fields(df: DataFrame, operations: Sequence[Mapping[str, str]]) -> DataFrame:
    """Apply ``rename`` (from, to), ``delete`` (name) and ``create`` (name, expr or value) in order.

    Columns without an operation pass through; Catalyst folds the whole list into one projection.
    """
    for op in operations:
        kind = op.get("op", "").lower()
        if kind == "rename":
            source, target = op.get("from", "").strip(), op.get("to", "").strip()
            if source and target and source != target:
                df = df.withColumnRenamed(source, target)
        elif kind == "delete":
            df = df.drop(op["name"])
        elif kind == "create":
            value = F.expr(op["expr"]) if op.get("expr") else F.lit(op.get("value"))
            df = df.withColumn(op["name"], value)
        else:
            raise ValueError(f"unknown field operation {op.get('op')!r}; known: rename, delete, create")
    return df


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name and turn runs of space, dot, dash and underscore into one underscore."""
    return df.withColumnsRenamed({c: normalize_name(c) for c in df.columns})


def explode_list(df: DataFrame, column: str, value: str = "item", position: str = "item_index") -> DataFrame:
    """One row per list element; rows with an empty or missing list stay once with nulls."""
    kept = [c for c in df.columns if c != column]
    return df.select(*kept, F.posexplode_outer(column).alias(position, value))


def map_values(
    df: DataFrame, column: str, mapping: Mapping[str, str] | DataFrame, target: str | None = None
) -> DataFrame:
    """Replace values through a lookup; values without an entry stay.

    The lookup is a dict, or a DataFrame whose first two columns are key and value.
    """
    target = target or column
    if not isinstance(mapping, DataFrame):
        if not mapping:
            return df.withColumn(target, F.col(column))
        pairs = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
        return df.withColumn(target, F.coalesce(F.try_element_at(pairs, F.col(column)), F.col(column)))
    key, value = mapping.columns[:2]
    lookup = mapping.groupBy(F.col(key).alias("_key")).agg(F.min(value).alias("_value"))
    if is_small(mapping, fan_out=1):
        lookup = F.broadcast(lookup)
    joined = df.join(lookup, F.col(column) == F.col("_key"), "left")
    return joined.withColumn(target, F.coalesce("_value", F.col(column))).drop("_key", "_value")


def add_counter(
    df: DataFrame,
    name: str,
    order_by: str,
    start: int = 1,
    step: int = 1,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Number the rows in the order of a unique column, restarting for each combination of ``partition_by``.

    No single task ever sorts a whole group: the order column is cut into ranges at values taken
    from a small sample, whose size follows the number of rows, rows are numbered within (group, range),
    and the number of rows in the ranges before is added.  Any cut points give the same result, so a lost executor is harmless.
    """
    groups = list(partition_by)
    rows = df.count()
    ranges = max(MIN_RANGES, min(MAX_RANGES, rows // RANGE_ROWS))
    # a hash picks about one value a range, each task by itself
    sampled = (
        df.select(F.col(order_by).alias("v"))
        .where("v is not null")
        .where(F.pmod(F.xxhash64("v"), F.lit(max(1, rows // ranges))) == 0)
        .distinct()
        .collect()
    )
    cuts = sorted({row.v for row in sampled})
    # two steps of about sqrt(ranges) comparisons find the range of a value
    width = max(1, round(len(cuts) ** 0.5))
    chunks = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    kind = df.schema[order_by].dataType.simpleString()
    # a constant, folded when the plan is made
    limits = F.from_json(
        F.lit(json.dumps({"heads": [c[0] for c in chunks], "chunks": chunks}, default=str)),
        f"heads array<{kind}>, chunks array<array<{kind}>>",
    )
    ranged = (
        df.withColumn("_cuts", limits)
        .withColumn("_chunk", F.size(F.filter("_cuts.heads", lambda c: c <= F.col(order_by))))
        .withColumn("_row", F.get("_cuts.chunks", F.col("_chunk") - 1))
        .withColumn("_range", F.expr(f"_chunk * {width + 1} + coalesce(size(filter(_row, c -> c <= `{order_by}`)), 0)"))
        .drop("_cuts", "_chunk", "_row")
    )
    sizes = ranged.groupBy(*groups, "_range").agg(F.count(F.lit(1)).alias("_n"))
    # one row for each range of a group
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        F.col("_range").alias("_r"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    within = Window.partitionBy(*groups, "_range").orderBy(order_by)
    numbered = ranged.withColumn("_rn", F.row_number().over(within))
    on = [F.col("_range") == F.col("_r")]
    on += [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)]
    return numbered.join(offsets, on).select(
        *df.columns, (F.lit(start) + (F.col("_before") + F.col("_rn") - 1) * step).cast("bigint").alias(name)
    )

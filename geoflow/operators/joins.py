"""Joins by key.

Hot keys are left to the skew handling of adaptive execution, which splits the streamed side of
inner and left joins; right and full joins are therefore expressed through left joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JOIN_TYPES = {
    "inner": "inner", "left": "left", "left_outer": "left", "right": "right", "right_outer": "right",
    "outer": "outer", "full": "outer", "full_outer": "outer",
}


def _null_safe(pairs: list[tuple[str, str]]) -> Column:
    return reduce(and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs])


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns of the same name; null keys match each other.

    Keys appear once and come first in the left order of columns; other columns that occur on both
    sides get the suffixes ``_x`` and ``_y``.
    """
    kind = JOIN_TYPES.get((how or "inner").lower())
    if kind is None:
        raise ValueError(f"unknown join type {how!r}; known: {sorted(JOIN_TYPES)}")
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    l_names = {c: c + "_x" if c in clash else c for c in left.columns}
    r_names = {c: c + "_y" if c in clash else c for c in right.columns if c not in keys}
    lhs = left.withColumnsRenamed({c: n for c, n in l_names.items() if c != n})
    r_keys = {k: f"_rk_{i}" for i, k in enumerate(keys)}
    rhs = right.withColumnsRenamed({**{c: n for c, n in r_names.items() if c != n}, **r_keys})
    on = _null_safe([(k, r_keys[k]) for k in keys])
    out = [*l_names.values(), *r_names.values()]

    if kind in ("inner", "left"):
        return lhs.join(rhs, on, kind).select(*out)
    if kind == "right":
        joined = rhs.join(lhs, on, "left")
        return joined.select(*[F.col(r_keys[c]).alias(c) if c in r_keys else F.col(c) for c in out])
    matched = lhs.join(rhs, on, "left").select(*out)
    known = lhs.select(*[F.col(k).alias(f"_lk_{i}") for i, k in enumerate(keys)]).distinct()
    alone = rhs.join(known, _null_safe([(r_keys[k], f"_lk_{i}") for i, k in enumerate(keys)]), "left_anti")
    only_right = alone.select(
        *[
            F.col(r_keys[c]).alias(c)
            if c in r_keys
            else F.col(c)
            if c in r_names.values()
            else F.lit(None).cast(lhs.schema[c].dataType).alias(c)
            for c in out
        ]
    )
    return matched.unionByName(only_right)


def feature_merge(request: DataFrame, supplier: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Request rows with the supplier's columns, and a ``port``.

    ``merged`` where the key occurs on both sides (every combination), ``unmerged_request`` and
    ``unmerged_supplier`` where it does not.
    """
    marked = supplier.withColumn("_supplied", F.lit(True))
    requested = request.withColumn("_requested", F.lit(True))
    joined = join_keys(requested, marked, keys, "outer")
    port = (
        F.when(F.col("_requested").isNull(), "unmerged_supplier")
        .when(F.col("_supplied").isNull(), "unmerged_request")
        .otherwise("merged")
    )
    return joined.withColumn("port", port).drop("_requested", "_supplied")

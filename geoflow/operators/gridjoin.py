"""The one spatial join: bounding boxes meet through an equi-join on grid cells.

Cells come from a pyramid of grids whose cell sizes are powers of two.  A feature belongs to the
level whose cells are a fixed fraction of its own size, so it covers a bounded number of cells
however large it is, and two features of different sizes meet at the level of the larger one.  No
cell size has to be chosen, and the candidates of a cell are within a constant factor of the pairs
whose boxes intersect.  A pair that shares several cells is kept only in the cell that holds the
lower left corner of the common box (Patel & DeWitt, SIGMOD 1996), so no distinct is needed.

Which side is broadcast, if any, and how cells with a large share of a side are split, is left to
adaptive execution, which knows the sizes of both sides after their cells were made.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_LEVEL, MAX_LEVEL = -30, 40
# Cells a feature may be listed under, at most, relative to its own row; used to size broadcasts.
_FAN_OUT = 32

_CELL = ["_lvl", "_cx", "_cy"]


_UNITS = {"B": 0, "KiB": 1, "MiB": 2, "GiB": 3, "TiB": 4, "PiB": 5, "EiB": 6}


def _bytes(stats: object) -> float:
    # read from the text form: the number of a deep plan can have thousands of digits
    size, unit = re.search(r"sizeInBytes=([0-9.E+]+) ([KMGTPE]?i?B)", stats.simpleString()).groups()
    return float(size) * 1024 ** _UNITS[unit]


def estimated_bytes(df: DataFrame) -> float:
    """Catalyst's size estimate of the plan: file sizes for scans, unknown counts as enormous."""
    return _bytes(df._jdf.queryExecution().optimizedPlan().stats())


def broadcast_limit(df: DataFrame) -> int:
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def is_small(df: DataFrame, fan_out: int = _FAN_OUT) -> bool:
    """Is the side, multiplied by its fan-out, below the session's broadcast limit?"""
    return estimated_bytes(df) * fan_out <= broadcast_limit(df)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores for expensive work on rows that come from inputs too small to be split.

    Inputs with at least one split per core stay where they are.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [_bytes(leaves.apply(i).stats()) for i in range(leaves.size())]
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    cores = df.sparkSession.sparkContext.defaultParallelism
    if max(sizes, default=0) >= cores * conf.filesMaxPartitionBytes():
        return df
    return df.repartition(cores, *keys)


def _with_box(df: DataFrame, box: str, side: str, fine: int, points: bool) -> DataFrame:
    """Add the box and the feature's own level."""
    names = ("xmin", "ymin", "xmax", "ymax")
    if points:
        p = f"({box})"
        boxed = df.selectExpr("*", *[f"{p}.{n} _{side}{n}" for n in names])
    else:
        # the generator keeps filters on the edges from being pushed below and evaluated twice
        boxed = df.selectExpr("*", f"inline(array({box})) as ({', '.join(f'_{side}{n}' for n in names)})")
    size = f"greatest(_{side}xmax - _{side}xmin, _{side}ymax - _{side}ymin)"
    level = f"if({size} > 0, int(greatest({MIN_LEVEL}, least({MAX_LEVEL}, ceil(log2({size})) - {fine}))), {MIN_LEVEL})"
    return boxed.selectExpr("*", f"{MIN_LEVEL if points else level} _{side}lvl")


def _levels(df: DataFrame, side: str, points: bool) -> Column:
    """The levels that occur, a one-row result of at most ``MAX_LEVEL - MIN_LEVEL + 1`` numbers."""
    if points:
        return F.array(F.lit(MIN_LEVEL))
    return df.agg(F.sort_array(F.collect_set(f"_{side}lvl"))).scalar()


def _cell_index(value: str, level: str) -> str:
    return f"floor({value} * power(2.0D, -({level})))"


def _cells(df: DataFrame, side: str, meeting: str, points: bool) -> DataFrame:
    """One row per cell; ``meeting`` lists the numbers ``2 * level + kind`` the feature is listed under.

    Kind 0 means the cell size is that of the right feature, kind 1 that of the left one.
    """
    def along(axis: str) -> str:
        first, last = (_cell_index(f"_{side}{axis}{end}", "shiftright(_lvl, 1)") for end in ("min", "max"))
        return f"{first} _c{axis}" if points else f"explode(sequence({first}, {last})) _c{axis}"

    return (
        df.selectExpr("*", f"explode({meeting}) _lvl")
        .selectExpr("*", along("x"))
        .selectExpr("*", along("y"))
        .drop(f"_{side}lvl", "_other")
    )


def guarded(cells: DataFrame, side: DataFrame | None = None) -> DataFrame:
    """Keep the planner from broadcasting a side whose estimate is below the limit only as it ignores the cells.

    Without ``side`` the same for a frame made of geometries or their edges: estimates know file sizes, not what a row unfolds to.
    """
    side = cells if side is None else side
    return cells.hint("merge") if not is_small(side) and is_small(side, fan_out=1) else cells


def box_pairs(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    left_box: str,
    right_box: str,
    *,
    left_points: bool = False,
    right_points: bool = False,
    by: Sequence[str] = (),
    test: str | None = None,
    strategy: str | None = None,
    fine: int = 1,
    only: str | None = None,
) -> DataFrame:
    """Every pair of rows whose boxes intersect, exactly once, with the columns of both sides.

    Boxes and ``test`` are SQL text; column names must differ between the sides, boxes must not be null and ``*_points`` promises boxes
    without extent.  ``by`` names columns of both sides that must be equal, nulls included; they are
    returned once.  ``test`` is checked after the boxes.  ``only`` is ``left`` or ``right`` for the rows
    of that side that have a pair, once for each cell in which they have one: the search of a cell ends at the first.  ``strategy`` is ``broadcast_left``,
    ``broadcast_right`` or ``shuffle``, for callers who know better than adaptive execution.
    """
    l_boxed = _with_box(left, left_box, "l", fine, left_points)
    r_boxed = _with_box(right, right_box, "r", fine, right_points)
    # the levels of the other side ride along as a column: they come from a scalar subquery
    l_boxed, r_boxed = (
        l_boxed.withColumn("_other", _levels(r_boxed, "r", right_points)),
        r_boxed.withColumn("_other", _levels(l_boxed, "l", left_points)),
    )
    empty = "cast(array() as array<int>)"
    l_meeting = f"""concat(transform(filter(_other, v -> v >= _llvl), v -> 2 * v),
        if(array_min(_other) < _llvl, array(2 * _llvl + 1), {empty}))"""
    r_meeting = f"""concat(if(array_min(_other) <= _rlvl, array(2 * _rlvl), {empty}),
        transform(filter(_other, v -> v > _rlvl), v -> 2 * v + 1))"""
    l_cells = _cells(l_boxed, "l", l_meeting, left_points)
    r_cells = _cells(r_boxed, "r", r_meeting, right_points)
    keys = _CELL
    if strategy == "broadcast_right":
        r_cells = F.broadcast(r_cells)
    elif strategy == "broadcast_left":
        l_cells = F.broadcast(l_cells)
    elif strategy == "shuffle":
        l_cells, r_cells = l_cells.hint("merge"), r_cells.hint("merge")
    elif strategy is None:
        l_cells, r_cells = guarded(l_cells, left), guarded(r_cells, right)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")

    renamed = r_cells.withColumnsRenamed({k: f"{k}_r" for k in [*keys, *by]})
    on = [F.col(k) == F.col(f"{k}_r") for k in keys] + [F.col(k).eqNullSafe(F.col(f"{k}_r")) for k in by]
    lvl = "shiftright(_lvl, 1)"
    checks = f"""_lxmin <= _rxmax and _rxmin <= _lxmax and _lymin <= _rymax and _rymin <= _lymax
        and {_cell_index("greatest(_lxmin, _rxmin)", lvl)} = _cx
        and {_cell_index("greatest(_lymin, _rymin)", lvl)} = _cy"""
    if test is not None:
        checks = f"{checks} and {test}"
    if only is not None:
        one, other = (l_cells, renamed) if only == "left" else (renamed, l_cells)
        return one.join(other, [*on, F.expr(checks)], "left_semi").select(*(left if only == "left" else right).columns)
    # one filter after the join keeps the order: cheap box checks first, then the exact test
    return l_cells.join(renamed, on).where(checks).select(
        *left.columns, *[c for c in right.columns if c not in by]
    )

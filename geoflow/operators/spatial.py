"""Joins by location: predicate joins, related/unrelated routing and the box helpers behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.crs import reproject
from ..functions.geometry import bbox, is_finite, point, point_box, single_point
from ..functions.layer import GEOM, describe, is_point_layer, srid_of
from ..functions.sql import let, num, struct
from .gridjoin import box_pairs, spread

_SWAPPED = {"contains": "within", "covers": "covered_by", "intersects": "intersects", "touches": "touches"}
JOIN_TYPES = {
    "inner": "inner", "left": "left", "left_outer": "left", "right": "right", "right_outer": "right",
}


def grown(box: str, by: str) -> str:
    return let(
        box,
        lambda b: struct(xmin=f"{b}.xmin - {by}", ymin=f"{b}.ymin - {by}", xmax=f"{b}.xmax + {by}", ymax=f"{b}.ymax + {by}"),
    )


def tolerant(box: str) -> str:
    """Box grown by the distance below which coordinates count as equal."""
    return let(
        box,
        lambda b: grown(b, P.tolerance(f"greatest(abs({b}.xmin), abs({b}.xmax))", f"greatest(abs({b}.ymin), abs({b}.ymax))")),
    )


def same_crs(left: DataFrame, right: DataFrame, geom: str) -> DataFrame:
    target = srid_of(left, geom)
    source = srid_of(right, geom)
    if target is None or source is None or target == source:
        return right
    return reproject(right, target, geom=geom)


def _check(predicate: str, distance: float | None) -> None:
    if predicate not in P.PREDICATES:
        raise ValueError(f"unknown predicate {predicate!r}; known: {sorted(P.PREDICATES)}")
    if predicate == "dwithin" and distance is None:
        raise ValueError("predicate 'dwithin' needs a distance")


def plain_shapes(side: DataFrame, prefix: str) -> DataFrame:
    """Add ``_lbox, _ledge, _lquad`` or those of the right side: the simple shape that a geometry has, as the tests take it."""
    g = f"_{prefix}g"
    made = {"box": P.plain_box(g), "edge": P.plain_edge(g), "quad": P.plain_quad(g)}
    return side.selectExpr("*", *[f"{e} _{prefix}{n}" for n, e in made.items()])


def matched(
    lhs: DataFrame,
    rhs: DataFrame,
    predicate: str,
    *,
    left_points: bool = False,
    right_points: bool = False,
    distance: float | None = None,
    strategy: str | None = None,
    only: str | None = None,
) -> DataFrame:
    """Pairs of rows for which the predicate holds, with every column of both sides.

    Each side brings an id (``_lid``/``_rid``) and a geometry (``_lg``/``_rg``).  ``only`` is ``left`` or ``right`` for
    the rows of that side that are in a pair, some of them several times.
    """
    _check(predicate, distance)
    l_cols, r_cols = lhs.columns, rhs.columns
    # inputs are spread, pairs are not: there can be far more of them than rows
    lhs, rhs = spread(lhs.where("_lg.type is not null")), spread(rhs.where("_rg.type is not null"))
    # what the shapes of a row are for the tests of its pairs; columns that no test reads are not made
    if not left_points:
        lhs = plain_shapes(lhs, "l")
    if not right_points:
        rhs = plain_shapes(rhs, "r")
    l_box = point_box("_lg") if left_points else tolerant(bbox("_lg"))
    r_box = point_box("_rg") if right_points else tolerant(bbox("_rg"))
    p, q = single_point("_lg"), single_point("_rg")
    shapes = ["null" if points else name for points, name in ((left_points, "_lbox"), (right_points, "_rbox"))]
    shapes += [None if points else name for points, name in ((left_points, "_ledge"), (right_points, "_redge"))]
    quads = [None if points else name for points, name in ((left_points, "_lquad"), (right_points, "_rquad"))]
    test = None
    if predicate == "dwithin":
        l_box = grown(l_box, num(distance))
        if left_points and right_points:
            test = f"hypot({p}.x - {q}.x, {p}.y - {q}.y) <= {num(distance)}"
        else:
            test = f"({P.intersection_hit('_lg', '_rg', *shapes, *quads)} or {P.gap('_lg', '_rg')} <= {num(distance)})"
    elif left_points:
        test = P.point_holds(predicate, p, "_rg", None if right_points else "_rbox")
    elif right_points and predicate in _SWAPPED:
        test = P.point_holds(_SWAPPED[predicate], q, "_lg", "_lbox")
    if test is None:
        test = P.intersection_hit("_lg", "_rg", *shapes, *quads) if predicate == "intersects" else P.relation_test(predicate, "_lg", "_rg", *shapes)
    pairs = box_pairs(
        lhs,
        rhs,
        "_lid",
        "_rid",
        l_box,
        r_box,
        left_points=left_points and predicate != "dwithin",
        right_points=right_points,
        test=test,
        strategy=strategy,
        only=only,
    )
    return pairs.select(*([] if only == "right" else l_cols), *([] if only == "left" else r_cols))


def matching_pairs(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    predicate: str = "intersects",
    *,
    distance: float | None = None,
    strategy: str | None = None,
    geom: str = GEOM,
    only: str | None = None,
) -> DataFrame:
    """Ids and geometries (``_lid, _lg, _rid, _rg``) of the pairs for which the predicate holds."""
    right = same_crs(left, right, geom)
    return matched(
        left.select(F.col(left_id).alias("_lid"), F.col(geom).alias("_lg")),
        right.select(F.col(right_id).alias("_rid"), F.col(geom).alias("_rg")),
        predicate,
        left_points=is_point_layer(left, geom),
        right_points=is_point_layer(right, geom),
        distance=distance,
        strategy=strategy,
        only=only,
    )


def row_key(df: DataFrame) -> Column:
    """128 bits that stand for all values of a row; rows with equal ones are the same."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return F.struct(F.xxhash64(F.lit(1), *columns).alias("a"), F.xxhash64(F.lit(2), *columns).alias("b"))


def spatial_join(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    predicate: str = "intersects",
    how: str = "inner",
    *,
    distance: float | None = None,
    strategy: str | None = None,
    geom: str = GEOM,
) -> DataFrame:
    """Join two layers by location, one output row per matching pair.

    The geometry of the kept side stays (the left one for inner and left joins, the right one for
    right joins).  Columns that occur on both sides get the suffixes ``_left`` and ``_right``.  Ids may
    be null or repeated: every row is joined for itself, whatever the strategy.  The columns of both
    sides travel through the cell join; rows without a pair, where they are kept, come from a second
    join that stops at the first pair of a row.
    """
    kind = JOIN_TYPES.get(how.lower())
    if kind is None:
        raise ValueError(f"unknown join type {how!r}; known: {sorted(JOIN_TYPES)}")
    _check(predicate, distance)
    right = same_crs(left, right, geom)
    clash = (set(left.columns) & set(right.columns)) - {geom}
    l_out = [(c, c + "_left" if c in clash else c) for c in left.columns if kind != "right" or c != geom]
    r_out = [(c, c + "_right" if c in clash else c) for c in right.columns if kind == "right" or c != geom]
    l_points, r_points = is_point_layer(left, geom), is_point_layer(right, geom)
    def side(df: DataFrame, prefix: str, out: list[tuple[str, str]]) -> DataFrame:
        carried = [F.col(c).alias(n) for c, n in out if c != geom]
        return df.select(
            F.lit(None).cast("int").alias(f"_{prefix}id"), F.col(geom).alias(f"_{prefix}g"), F.struct(F.lit(True).alias("_"), *carried).alias(f"_{prefix}row")
        )

    def met(**options: object) -> DataFrame:
        return matched(
            side(left, "l", l_out), side(right, "r", r_out), predicate,
            left_points=l_points, right_points=r_points, distance=distance, strategy=strategy, **options,
        )

    def carried(prefix: str, out: list[tuple[str, str]]) -> list[Column]:
        return [F.col(f"_{prefix}g").alias(n) if c == geom else F.col(f"_{prefix}row")[n].alias(n) for c, n in out]

    joined = met().select(*carried("l", l_out), *carried("r", r_out))
    if kind != "inner":
        # the pairs stay where they are found; the rows without one are looked for by themselves
        kept, others, out = (left, right, l_out) if kind == "left" else (right, left, r_out)
        alone = unmatched(kept, others, predicate, geom, kind == "right", distance, strategy)
        kinds = dict(joined.dtypes)
        names = {n: c for c, n in out}
        joined = joined.unionByName(alone.select(*[
            F.col(names[n]).alias(n) if n in names else F.lit(None).cast(kinds[n]).alias(n) for n in joined.columns
        ]))
    srid = srid_of(left, geom)
    return describe(
        joined.select(*[n for _, n in l_out + r_out]), geom, srid=srid, kind="Point" if (r_points if kind == "right" else l_points) else None
    )


def unmatched(
    kept: DataFrame, others: DataFrame, predicate: str, geom: str, right: bool, distance: float | None, strategy: str | None
) -> DataFrame:
    """The rows of a side that are in no pair; ``right`` tells that it is the right side of the predicate."""
    keyed = kept.withColumn("_key", row_key(kept))
    # rows that are the same have the same pairs
    own, other = ("r", "l") if right else ("l", "r")
    once = keyed.select(F.col("_key").alias(f"_{own}id"), F.col(geom).alias(f"_{own}g")).dropDuplicates([f"_{own}id"])
    rest = others.select(F.lit(None).cast("int").alias(f"_{other}id"), F.col(geom).alias(f"_{other}g"))
    found = matched(
        rest if right else once, once if right else rest, predicate,
        left_points=is_point_layer(others if right else kept, geom), right_points=is_point_layer(kept if right else others, geom),
        distance=distance, strategy=strategy, only="right" if right else "left",
    )
    hits = found.select(F.col(f"_{own}id").alias("_met")).distinct()
    return keyed.join(hits, F.col("_key") == F.col("_met"), "left_anti").drop("_key")


def spatial_relate(
    base: DataFrame,
    candidates: DataFrame,
    base_id: str,
    candidate_id: str,
    predicate: str = "intersects",
    **options: object,
) -> DataFrame:
    """Base features with ``port`` = ``related`` when any candidate matches, else ``unrelated``."""
    keyed = base.withColumn("_key", row_key(base))
    found = (
        matching_pairs(keyed, candidates, "_key", candidate_id, predicate, only="left", **options)
        .select(F.col("_lid").alias("_hit"))
        .distinct()
    )
    return (
        keyed.join(found, F.col("_key") == F.col("_hit"), "left")
        .withColumn("port", F.when(F.col("_hit").isNotNull(), "related").otherwise("unrelated"))
        .drop("_hit", "_key")
    )


def point_layer(df: DataFrame, x: str, y: str, srid: int = 4326, geom: str = GEOM) -> DataFrame:
    """Layer of points from two number columns (or expressions); rows without finite coordinates are dropped."""
    usable = df.where(f"{is_finite(x)} and {is_finite(y)}")
    made = point(f"double({x})", f"double({y})")
    return describe(usable.withColumn(geom, F.expr(made)), geom, srid=srid, kind="Point")

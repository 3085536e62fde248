"""Overlay of linework: cutting, dissolving, clipping, area intersection, ring stitching.

Areas become directed edges with the interior on the left.  Edges are cut where they meet, every
piece is located by its midpoint, and an operation keeps the pieces with the right locations.
Areas follow from the kept pieces by Green's formula without building rings; rings are stitched by
pointer doubling, so that no task ever holds the edges of a whole group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import measures as M
from ..functions import predicates as P
from ..functions.crs import is_geographic, reproject
from ..functions.layer import GEOM, describe, is_point_layer, replace_geom, srid_of
from ..functions.sql import case, each, let, num, struct, total
from .edit import CIRCLE_SIDES, circle
from .gridjoin import box_pairs, guarded, spread
from .lineage import ROW, Rounds, cut_lineage, number_rows
from .spatial import spatial_relate, tolerant
from .stitch import stitch_rows

# Vertices are identified after rounding to this step, in degrees and in metres.
SNAP_DEGREES, SNAP_METRES = 1e-9, 1e-5

_XY = ["x1", "y1", "x2", "y2"]


def snap_step(srid: int | None) -> float:
    return SNAP_DEGREES if srid is None or is_geographic(srid) else SNAP_METRES


def explode_segments(df: DataFrame, keep: list[Column], geom: str = GEOM) -> DataFrame:
    """Rows ``keep..., seg, x1, y1, x2, y2``: one per edge, areas oriented, zero-length edges dropped."""
    shape = M.orient(geom)
    return (
        df.select(*keep, F.expr(f"posexplode({let(shape, G.segments)})").alias("seg", "_s"))
        .select("*", "_s.*")
        .drop("_s")
        .where("x1 != x2 or y1 != y2")
    )


def segment_box(prefix: str = "") -> str:
    a, b, c, d = (prefix + n for n in _XY)
    return tolerant(
        struct(
            xmin=f"least({a}, {c})", ymin=f"least({b}, {d})", xmax=f"greatest({a}, {c})", ymax=f"greatest({b}, {d})"
        )
    )


def _segment(prefix: str = "") -> str:
    return G.segment(*(prefix + n for n in _XY))


def cut_segments(left: DataFrame, right: DataFrame, key: list[str], apart: str = "true", by: list[str] | None = None) -> DataFrame:
    """Pieces of the left segments, cut where they meet right segments.

    ``key`` identifies a left segment and has no nulls; ``apart`` is a condition on columns prefixed ``l_``
    and ``r_`` that a pair must satisfy; ``by`` are columns on which both sides must agree.  Returns
    the left columns with ``piece`` numbers and the ends of the pieces.  Segments that meet none are not sorted.
    """
    hits = meetings(left, right, key, apart, by)
    # a window sorts and spills, where a list of the positions of one long segment might not fit
    stops = Window.partitionBy(*key).orderBy("t")
    inner = (
        hits.withColumn("_before", F.lag("t", 1, 0.0).over(stops))
        # positions closer than the tolerance are one position
        .where(f"(t - _before) * {_LENGTH} > {_TOLERANCE} and (1 - t) * {_LENGTH} > {_TOLERANCE}")
        .drop("_before")
    )
    inner = inner.withColumn("u", F.lead("t", 1, 1.0).over(stops)).withColumn("piece", F.row_number().over(stops) + 1)
    firsts = inner.groupBy(*key).agg(F.min("t").alias("u"))
    whole = left.join(firsts, key, "left").withColumn("t", F.lit(0.0)).withColumn("u", F.coalesce("u", F.lit(1.0))).withColumn("piece", F.lit(1))
    pieces = whole.where(f"{_LENGTH} > {_TOLERANCE}").unionByName(inner)

    def at(t: str, a: str, b: str) -> Column:
        return F.expr(f"if({t} = 1, {b}, {a} + {t} * ({b} - {a}))")

    return pieces.select(
        *[c for c in left.columns if c not in _XY],
        "piece",
        at("t", "x1", "x2").alias("x1"),
        at("t", "y1", "y2").alias("y1"),
        at("u", "x1", "x2").alias("x2"),
        at("u", "y1", "y2").alias("y2"),
    )


_LENGTH = P.norm("x2 - x1", "y2 - y1")
_TOLERANCE = P.tolerance("x1", "y1")


def meetings(
    left: DataFrame, right: DataFrame, key: list[str], apart: str = "true", by: list[str] | None = None, most: bool = False
) -> DataFrame:
    """The left segments once for every position ``t`` in [0, 1] where they meet a right one; see :func:`cut_segments`.

    ``most`` tells that most pairs whose boxes meet are wanted: positions are then worked out along with the join, which makes pairs cheap
    and the join itself slower.
    """
    by = by or []
    lhs = left.select(
        *[F.col(c).alias(f"l_{c}") for c in left.columns if c not in by],
        *by,
        F.xxhash64(*by, *key).alias("_lid"),
    )
    rhs = right.select(
        *[F.col(c).alias(f"r_{c}") for c in right.columns if c not in by],
        *by,
        F.xxhash64(*right.columns).alias("_rid"),
    )
    pairs = box_pairs(lhs, rhs, "_lid", "_rid", segment_box("l_"), segment_box("r_"), by=by, test=apart, fine=0)
    own = [F.col(c if c in by else f"l_{c}").alias(c) for c in left.columns]
    if not most:
        meets = let(_segment("l_"), lambda s: P.meeting_params(s, f"array({_segment('r_')})"))
        return pairs.select(*own, F.expr(f"explode({meets})").alias("t"))
    # a step for each kind of value keeps all of it in generated code
    for step in P.meeting_steps("l_", "r_"):
        pairs = pairs.selectExpr("*", *[f"{v} {n}" for n, v in step.items()])
    return pairs.select(*own, F.expr("explode(array(_ta, _tb))").alias("t")).where("t is not null")


def snapped(edges: DataFrame, step: float) -> DataFrame:
    """Round the ends of the pieces to the vertex grid and drop pieces that vanish."""
    return edges.withColumns(
        {c: F.expr(f"cast(floor({c} / {num(step)} + 0.5D) as bigint)") for c in _XY}
    ).where("x1 != x2 or y1 != y2")


#: The ends of an edge, the smaller one first.
_LOW = ["ax", "ay", "bx", "by"]


def _sides(edges: DataFrame, group: list[str], at: str | None = None) -> DataFrame:
    """Every undirected edge once, with the directions it occurs in: 1 from the smaller end, 2 to it, 3 both.

    ``at`` is a column with the ends before rounding, of which one occurrence is kept, from the smaller end on.
    """
    forward = "(x1 < x2 or (x1 = x2 and y1 < y2))"
    low = {
        "ax": f"if({forward}, x1, x2)", "ay": f"if({forward}, y1, y2)",
        "bx": f"if({forward}, x2, x1)", "by": f"if({forward}, y2, y1)",
    }
    turned = f"if({forward}, {at}, {G.segment(*(f'{at}.{n}' for n in ('x2', 'y2', 'x1', 'y1')))})"
    sides = edges.select(
        *group, *[F.expr(e).alias(n) for n, e in low.items()], F.expr(f"if({forward}, 1, 2)").alias("way"), *([F.expr(turned).alias(at)] if at else [])
    )
    return sides.groupBy(*group, *low).agg(F.bit_or("way").alias("way"), *([F.min(at).alias(at)] if at else []))


def cancel_opposites(edges: DataFrame, group: list[str]) -> DataFrame:
    """One copy of each directed edge, and none where both directions occur (combined before the shuffle)."""
    return _sides(edges, group).where("way < 3").selectExpr(
        *[f"`{g}`" for g in group],
        "if(way = 1, ax, bx) x1", "if(way = 1, ay, by) y1", "if(way = 1, bx, ax) x2", "if(way = 1, by, ay) y2",
    )


def edge_measures(edges: DataFrame, group: list[str], step: float) -> DataFrame:
    """Area and perimeter of each group from its boundary edges (vertex grid units)."""
    s = num(step)
    # coordinates relative to a fixed origin per plane would lose digits; integers keep them all
    cross = "(cast(x1 as decimal(19,0)) * y2 - cast(x2 as decimal(19,0)) * y1)"
    return edges.groupBy(*group).agg(
        (F.expr(f"double(sum({cross})) / 2") * F.expr(f"{s} * {s}")).alias("area"),
        (F.expr(f"sum(hypot(double(x2 - x1), double(y2 - y1))) * {s}")).alias("perimeter"),
    )


# --- stitching -----------------------------------------------------------------------------


def _successors(edges: DataFrame, group: list[str]) -> DataFrame:
    """The number of the edge that follows each numbered edge: at a vertex with several ways on, the leftmost turn.

    Arrivals and departures of a vertex are sorted by angle; an arrival continues with the next
    departure clockwise from where it came.
    """
    none = F.lit(None).cast("bigint")
    arrivals = edges.select(
        *group, F.col("x2").alias("vx"), F.col("y2").alias("vy"),
        F.expr("atan2(double(y1 - y2), double(x1 - x2))").alias("angle"), F.col(ROW).alias("came"), none.alias("goes"),
    )
    departures = edges.select(
        *group, F.col("x1").alias("vx"), F.col("y1").alias("vy"),
        F.expr("atan2(double(y2 - y1), double(x2 - x1))").alias("angle"), none.alias("came"), F.col(ROW).alias("goes"),
    )
    vertex = Window.partitionBy(*group, "vx", "vy").orderBy(F.desc("angle"), F.col("came").isNull())
    later = vertex.rowsBetween(1, Window.unboundedFollowing)
    first = vertex.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        arrivals.unionByName(departures)
        .withColumn(
            "nxt",
            F.coalesce(F.first("goes", ignorenulls=True).over(later), F.first("goes", ignorenulls=True).over(first)),
        )
        .where("came is not null and nxt is not null")
        .select(F.col("came").alias("id"), "nxt")
    )


def stitch_rings(edges: DataFrame, group: list[str]) -> DataFrame:
    """Closed rings of directed boundary edges: ``group..., ring_id, ring`` with an array of grid vertices.

    Every edge has a number and learns the smallest number of its ring and its distance to it by pointer doubling, in
    as many rounds as the longest ring has doublings; only numbers travel, and a ring is only collected as its own value.
    ``ring_id`` is that smallest number.
    """
    edges = number_rows(edges)
    links = _successors(edges, group).select("id", "nxt", F.col("id").alias("lead"), F.lit(0).cast("bigint").alias("off"))

    def jump(state: DataFrame, span: int) -> DataFrame:
        """Every edge takes over what the edge ``span`` further on knows."""
        ahead = state.select(F.col("id").alias("_id"), F.col("nxt").alias("_nxt"), F.col("lead").alias("_lead"), F.col("off").alias("_off"))
        nearer = F.col("_lead") < F.col("lead")
        return state.join(ahead, F.col("nxt") == F.col("_id")).select(
            "id",
            F.col("_nxt").alias("nxt"),
            F.when(nearer, F.col("_lead")).otherwise(F.col("lead")).alias("lead"),
            F.when(nearer, F.col("_off") + span).otherwise(F.col("off")).alias("off"),
            nearer.alias("moved"),
        )

    rounds = Rounds(edges.sparkSession, "stitch")
    state = rounds.keep(links)
    span = 1
    while True:
        # two jumps per written round; rings shorter than the span learn nothing new in the second
        state = rounds.keep(jump(jump(state, span).drop("moved"), 2 * span))
        span *= 4
        if state.where("moved").isEmpty():
            break
        state = state.drop("moved")
    corner = F.struct(
        F.when(F.col("off") == 0, F.lit(-(2**62))).otherwise(-F.col("off")).alias("k"),
        F.col("x1").alias("x"),
        F.col("y1").alias("y"),
    )
    return (
        state.join(edges.select(*group, ROW, "x1", "y1"), F.col("id") == F.col(ROW)).groupBy(*group, "lead")
        .agg(F.array_sort(F.collect_list(corner)).alias("c"))
        .selectExpr(
            *[f"`{g}`" for g in group],
            "lead ring_id",
            f"concat({each('transform', 'c', lambda v: struct(x=f'{v}.x', y=f'{v}.y'))},"
            " array(named_struct('x', c[0].x, 'y', c[0].y))) ring",
        )
    )


def assemble(rings: DataFrame, group: list[str], step: float, geom: str = GEOM, srid: int | None = None) -> DataFrame:
    """Polygons from rings: one row per group and shell, with the holes inside it."""
    s = num(step)
    scaled = each("transform", "ring", lambda v: G.xy(f"{v}.x * {s}", f"{v}.y * {s}"))
    measured = rings.select(*group, "ring_id", F.expr(scaled).alias("ring")).withColumn("size", F.expr(M.ring_area("ring")))
    shells = measured.where("size > 0").select(
        *group, F.col("ring_id").alias("shell_id"), F.col("ring").alias("shell"), F.col("size").alias("shell_size")
    )
    holes = measured.where("size < 0").select(*group, F.col("ring_id").alias("hole_id"), F.col("ring").alias("hole"))
    # the middle of a hole's first edge is inside the shell that owns it
    probe = G.xy("(hole[0].x + hole[1].x) / 2", "(hole[0].y + hole[1].y) / 2")
    probes = holes.withColumn("p", F.expr(probe))
    targets = shells.select(
        *group, F.col("shell_id").alias("owner"), "shell", "shell_size", F.expr(G.polygon("array(shell)")).alias("_rg")
    )
    inside = P.inside_even_odd("p", G.ring_segments("shell"))
    owned = (
        box_pairs(
            probes, targets, "hole_id", "owner", struct(xmin="p.x", ymin="p.y", xmax="p.x", ymax="p.y"),
            tolerant(G.bbox("_rg")), left_points=True, by=group, test=inside,
        )
        .groupBy(*group, "hole_id")
        .agg(F.min_by("owner", "shell_size").alias("owner"), F.first("hole").alias("hole"))
        .groupBy(*[F.col(g).alias(f"_{g}") for g in group], "owner")
        .agg(F.array_sort(F.collect_list("hole")).alias("holes"))
    )
    shape = G.polygon("concat(array(shell), coalesce(holes, cast(array() as array<array<struct<x:double,y:double>>>)))")
    on = [F.col("shell_id") == F.col("owner")] + [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group]
    parts = shells.join(owned, on, "left").select(*group, F.expr(shape).alias(geom))
    return describe(parts, geom, srid=srid)


# --- dissolve ------------------------------------------------------------------------------


def union_edges(df: DataFrame, by: list[str], geom: str = GEOM, areas: str | None = None) -> DataFrame:
    """Boundary edges (vertex grid units) of the union of the areas of each group; ``areas`` tells which rows have one.

    An edge that two areas of a group have in opposite directions is covered on both sides and goes first,
    combined before the shuffle; only what is left is cut and located.
    """
    step = snap_step(srid_of(df, geom))
    rows = number_rows(df.where(areas or f"{G.family(geom)} = 2").select(*by, F.col(geom).alias("_g")))
    spread_rows = spread(rows, ROW)
    raw = explode_segments(spread_rows, [F.col(b) for b in by], "_g")
    # the grid tells which edges are the same; they are cut where they were, as the grid may put one place into two cells
    found = snapped(raw.withColumn("_at", F.struct(*_XY)), step)
    sides = _sides(found, by, at="_at")
    # the remaining edges meet all edges, also those that went: an edge ends where it enters an area
    sides = number_rows(sides)
    everything = sides.select(*by, ROW, *_LOW, *[F.col(f"_at.{n}").alias(n) for n in _XY])
    left = everything.join(guarded(sides.where("way < 3").select(ROW, "way")), ROW)
    turn = "((double(l_bx) - l_ax) * (double(r_by) - r_ay) - (double(l_by) - l_ay) * (double(r_bx) - r_ax))"
    along = "((double(l_bx) - l_ax) * (double(r_bx) - r_ax) + (double(l_by) - l_ay) * (double(r_by) - r_ay))"
    longer = "greatest(hypot(double(l_bx) - l_ax, double(l_by) - l_ay), hypot(double(r_bx) - r_ax, double(r_by) - r_ay))"
    alike = "(l_ax = r_ax and l_ay = r_ay or l_bx = r_bx and l_by = r_by)"
    unlike = "(l_ax = r_bx and l_ay = r_by or l_bx = r_ax and l_by = r_ay)"
    # edges with a common end meet nowhere else if they go apart from there, or if each leaves the other by some grid steps
    bent = f"abs({turn}) > 4 * {longer}"
    apart = f"l_{ROW} != r_{ROW} and not ({alike} and ({along} < 0 or {bent}) or {unlike} and ({along} > 0 or {bent}))"
    pieces = cut_lineage(cut_segments(left, everything, [ROW], apart, by).drop(*_LOW))
    middle = G.xy("(x1 + x2) / 2", "(y1 + y2) / 2")
    probes = pieces.select(*by, F.col(ROW).alias("l_row"), F.col("piece").alias("l_piece"), F.xxhash64(ROW, "piece").alias("_lid"), F.expr(middle).alias("p"))
    others = spread_rows.select(*by, F.col(ROW).alias("_rid"), "_g")
    covered = f"{let(G.segments('_g'), lambda s: P.locate_in_area('p', s))} = 'I'"
    hidden = box_pairs(
        probes, others, "_lid", "_rid", struct(xmin="p.x", ymin="p.y", xmax="p.x", ymax="p.y"),
        tolerant(G.bbox("_g")), left_points=True, by=by, test=covered,
    ).select(F.col("l_row").alias("_f"), F.col("l_piece").alias("_p"))
    visible = pieces.join(hidden, [F.col(ROW) == F.col("_f"), F.col("piece") == F.col("_p")], "left_anti")
    turned = visible.select(*by, *[F.expr(f"if(way = 1, {a}, {b})").alias(a) for a, b in (("x1", "x2"), ("y1", "y2"), ("x2", "x1"), ("y2", "y1"))])
    return cancel_opposites(snapped(turned, step), by)


def dissolve(df: DataFrame, by: list[str], id_: str, geom: str = GEOM) -> DataFrame:
    """Union of the areas of each group: one row per group and connected part.  Lines and points raise an error.

    Ids may be null or repeated, every row is an area of its own; a null group is a group.
    """
    srid = srid_of(df, geom)
    edges = union_edges(df, by, geom, G.only_family(geom, 2, "dissolve"))
    return assemble(stitch_rings(edges, by), by, snap_step(srid), geom, srid)


def dissolve_measures(df: DataFrame, by: list[str], id_: str, geom: str = GEOM) -> DataFrame:
    """Area and perimeter of the union of each group, without building its geometry."""
    return edge_measures(union_edges(df, by, geom, G.only_family(geom, 2, "dissolve")), by, snap_step(srid_of(df, geom)))


# --- overlay -------------------------------------------------------------------------------


def _overlay_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str, apart: str, geom: str) -> tuple[DataFrame, DataFrame]:
    """Pairs of axis-parallel rectangles that overlap with their overlap ``_common``, and the other pairs of areas whose boxes meet.

    Lines and points raise an error.  Sides are dealt out by rows, pairs never: there can be far more of them.
    """
    step = num(snap_step(srid_of(left, geom)))
    areas = G.only_family(geom, 2, "overlay")

    def side(df: DataFrame, id_: str, p: str) -> DataFrame:
        oriented = spread(df.where(areas).select(F.col(id_).alias(f"_{p}id"), F.expr(M.orient(geom)).alias(f"_{p}g")))
        # the generator keeps filters on the shapes from working them out again
        shape = struct(box=P.plain_box(f"_{p}g"), quad=P.plain_quad(f"_{p}g"))
        return oriented.selectExpr("*", f"inline(array({shape})) as (_{p}box, _{p}quad)")

    lhs, rhs = side(left, left_id, "l"), side(right, right_id, "r")

    def on_grid(c: str) -> str:
        return f"floor({c} / {step} + 0.5D)"

    common = {
        "xmin": "greatest(_lbox.xmin, _rbox.xmin)", "ymin": "greatest(_lbox.ymin, _rbox.ymin)",
        "xmax": "least(_lbox.xmax, _rbox.xmax)", "ymax": "least(_lbox.ymax, _rbox.ymax)",
    }
    overlap = " and ".join(f"{common[f'{c}min']} < {common[f'{c}max']} and {on_grid(common[f'{c}min'])} != {on_grid(common[f'{c}max'])}" for c in "xy")
    boxes = box_pairs(
        lhs.where("_lbox is not null").select("_lid", "_lbox"), rhs.where("_rbox is not null").select("_rid", "_rbox"),
        "_lid", "_rid", tolerant("_lbox"), tolerant("_rbox"), test=f"{apart} and {overlap}",
    ).selectExpr("_lid", "_rid", f"{struct(**common)} _common")
    others = None
    for one, other in ((lhs.where("_lbox is null"), rhs), (lhs.where("_lbox is not null"), rhs.where("_rbox is null"))):
        found = box_pairs(
            one.drop("_lbox"), other.drop("_rbox"), "_lid", "_rid", tolerant(G.bbox("_lg")), tolerant(G.bbox("_rg")),
            test=f"{apart} and not ({P.quads_apart('_lquad', '_rquad')})",
        ).select("_lid", "_rid", "_lg", "_rg")
        others = found if others is None else others.unionByName(found)
    return boxes, others


def _overlay_edges(pairs: DataFrame, step: float) -> DataFrame:
    """The boundary edges of the intersection of every pair of areas ``_lg, _rg`` in ``_edges``, in vertex grid units."""

    def located(own: str, other: str) -> str:
        return P.locate_pieces(P.cut(P.meet(own, other)), other, "2")

    def on_grid(c: str) -> str:
        return f"cast(floor({c} / {num(step)} + 0.5D) as bigint)"

    rounded = each("transform", "_kept", lambda e: G.segment(*(on_grid(f"{e}.{c}") for c in _XY)))
    general = "concat(filter(_lp, p -> p.code in ('I', 'S')), filter(_rp, p -> p.code = 'I'))"
    plain = each("transform", general, lambda p: G.segment(*(f"{p}.{c}" for c in _XY)))
    return (
        pairs.selectExpr("_lid", "_rid", f"{G.proper_segments('_lg')} _ls", f"{G.proper_segments('_rg')} _rs")
        .selectExpr("_lid", "_rid", f"{located('_ls', '_rs')} _lp", f"{located('_rs', '_ls')} _rp")
        .selectExpr("_lid", "_rid", f"{plain} _kept")
        # the generator keeps the filter below from being pushed into the steps above
        .selectExpr("_lid", "_rid", f"explode(array(filter({rounded}, e -> e.x1 != e.x2 or e.y1 != e.y2))) _edges")
        .where("size(_edges) >= 3")
    )


def overlay_areas(left: DataFrame, right: DataFrame, left_id: str, right_id: str, apart: str = "true", geom: str = GEOM) -> DataFrame:
    """Intersection of every pair of areas that overlap: ``_lid, _rid`` and the geometry."""
    srid = srid_of(left, geom)
    step = snap_step(srid)
    boxes, others = _overlay_pairs(left, right, left_id, right_id, apart, geom)
    # two axis-parallel rectangles overlap in a rectangle
    plain = boxes.selectExpr("_lid", "_rid", f"{G.rectangle('_common.xmin', '_common.ymin', '_common.xmax', '_common.ymax')} {geom}")
    stitched = _overlay_edges(others, step).select("_lid", "_rid", stitch_rows(step)("_edges").alias(geom))
    return describe(plain.unionByName(stitched.where(f"{geom}.type is not null")), geom, srid=srid)


def overlay_measures(left: DataFrame, right: DataFrame, left_id: str, right_id: str, apart: str = "true", geom: str = GEOM) -> DataFrame:
    """Area and perimeter of the intersection of every overlapping pair, without building rings."""
    step = snap_step(srid_of(left, geom))
    s = num(step)
    boxes, others = _overlay_pairs(left, right, left_id, right_id, apart, geom)
    sizes = [f"double(cast(floor(_common.{c}max / {s} + 0.5D) as bigint) - cast(floor(_common.{c}min / {s} + 0.5D) as bigint))" for c in "xy"]
    plain = boxes.selectExpr("_lid", "_rid", f"{sizes[0]} * {sizes[1]} * {s} * {s} area", f"2 * ({sizes[0]} + {sizes[1]}) * {s} perimeter")
    cross = each(
        "transform",
        "_edges",
        lambda e: f"(double({e}.x1 - _edges[0].x1) * double({e}.y2 - _edges[0].y1)"
        f" - double({e}.x2 - _edges[0].x1) * double({e}.y1 - _edges[0].y1))",
    )
    sides = each("transform", "_edges", lambda e: f"hypot(double({e}.x2 - {e}.x1), double({e}.y2 - {e}.y1))")
    return plain.unionByName(_overlay_edges(others, step).selectExpr(
        "_lid", "_rid", f"{total(cross)} / 2 * {s} * {s} area", f"{total(sides)} * {s} perimeter"
    ).where("area > 0"))


def _stitched(edges: DataFrame, group: list[str], step: float, srid: int | None, geom: str) -> DataFrame:
    """One geometry per group of boundary edges; each group is the outline of one feature."""
    outlines = edges.groupBy(*group).agg(F.collect_list(F.struct(*_XY)).alias("_edges"))
    shaped = outlines.withColumn(geom, stitch_rows(step)("_edges")).drop("_edges")
    return describe(shaped.where(f"{geom}.type is not null"), geom, srid=srid)


# --- clip ----------------------------------------------------------------------------------


def _clip_areas(rows: DataFrame, mask: DataFrame) -> DataFrame:
    """Pieces of areas with their ``port``, and both sides of the mask's edges inside them; ``rows`` has ``_row, _g``."""
    feats = spread(rows, ROW)
    segs = explode_segments(feats, [F.col(ROW)], "_g")
    mask_segs = explode_segments(mask, [F.col("mid")], "_m")
    # the pieces are needed several times below
    pieces = cut_lineage(cut_segments(segs, mask_segs, [ROW, "seg"]))

    # which pieces lie inside the mask, or along it with the interior on the same side
    probes = pieces.select(
        F.col(ROW).alias("l_row"), F.col("seg").alias("l_seg"), F.col("piece").alias("l_piece"),
        F.xxhash64(ROW, "seg", "piece").alias("_lid"),
        F.expr(G.xy("(x1 + x2) / 2", "(y1 + y2) / 2")).alias("p"), F.expr(_segment()).alias("s"),
    )
    targets = mask.select(F.col("mid").alias("_rid"), "_m")
    code = let(G.segments("_m"), lambda segs_: P.piece_code("s", segs_, "2"))
    inside = (
        box_pairs(
            probes, targets, "_lid", "_rid", struct(xmin="p.x", ymin="p.y", xmax="p.x", ymax="p.y"),
            tolerant(G.bbox("_m")), left_points=True, test=let(code, lambda c: f"{c} in ('I', 'S')"),
        )
        .select(F.col("l_row").alias("_f"), F.col("l_seg").alias("_s"), F.col("l_piece").alias("_p"))
        .distinct()
    )
    on = [F.col(ROW) == F.col("_f"), F.col("seg") == F.col("_s"), F.col("piece") == F.col("_p")]
    own = pieces.join(inside, on, "left").select(
        ROW, F.when(F.col("_f").isNotNull(), "inside").otherwise("outside").alias("port"), *_XY
    )

    # the mask's edges inside an area bound it on both sides
    area_side = feats.select(F.col(ROW).alias("_lid"), "_g")
    mask_side = mask_segs.select(
        F.xxhash64("mid", "seg").alias("_rid"), *[F.col(c).alias(f"m_{c}") for c in _XY]
    )
    pairs = box_pairs(area_side, mask_side, "_lid", "_rid", tolerant(G.bbox("_g")), segment_box("m_"))
    strictly = let(
        G.segments("_g"),
        lambda segs_: each(
            "filter",
            P.locate_pieces(P.cut(P.meet(f"array({_segment('m_')})", segs_)), segs_, "2"),
            lambda q: f"{q}.code = 'I'",
        ),
    )
    bounds = pairs.select(F.col("_lid").alias(ROW), F.expr(f"inline({strictly})")).drop("code")
    both = bounds.selectExpr(ROW, "'inside' port", *_XY).unionByName(
        bounds.selectExpr(ROW, "'outside' port", "x2 x1", "y2 y1", "x1 x2", "y1 y2")
    )
    return own.unionByName(both)


def _clip_lines(rows: DataFrame, mask: DataFrame) -> DataFrame:
    """Lines as ``_row, part, run, port, geom``: the stretches on one side of the mask, each as long as it can be."""
    lines = line_parts(rows, "_g")
    mask_segs = explode_segments(mask, [F.col("mid")], "_m").select("mid", "seg", *_XY)
    stretches = cut_lineage(line_stretches(lines, mask_segs))
    # no mask edge is met within a stretch, so one point tells where it lies
    probes = stretches.join(lines, [ROW, "part"]).selectExpr(
        f"{ROW} l_row", "part l_part", "piece l_piece", f"xxhash64({ROW}, part, piece) _lid", f"{_first_middle()} p"
    )
    targets = mask.select(F.col("mid").alias("_rid"), "_m")
    code = let(G.segments("_m"), lambda segs_: P.locate_in_area("p", segs_))
    inside = (
        box_pairs(
            probes, targets, "_lid", "_rid", struct(xmin="p.x", ymin="p.y", xmax="p.x", ymax="p.y"),
            tolerant(G.bbox("_m")), left_points=True, test=f"{code} != 'E'",
        )
        .select(F.col("l_row").alias(ROW), F.col("l_part").alias("part"), F.col("l_piece").alias("piece"), F.lit("inside").alias("port"))
        .distinct()
    )
    known = stretches.join(inside, [ROW, "part", "piece"], "left").withColumn("port", F.coalesce("port", F.lit("outside")))
    # gaps and islands: a run goes on while the port stays the same
    along = Window.partitionBy(ROW, "part").orderBy("piece")
    turned = known.withColumn("_new", F.coalesce((F.lag("port").over(along) != F.col("port")).cast("int"), F.lit(1)))
    numbered = turned.withColumn("run", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    place = lambda end: F.struct("piece", *[F.col(f"{end}{c}").alias(c) for c in ("seg", "t")])
    runs = numbered.groupBy(ROW, "part", "run", "port").agg(F.min(place("from_")).alias("_a"), F.max(place("to_")).alias("_b"))
    spans = runs.selectExpr(ROW, "part", "run", "port", "_a.seg from_seg", "_a.t from_t", "_b.seg to_seg", "_b.t to_t")
    return spans.join(lines, [ROW, "part"]).selectExpr(ROW, "part", "cast(run as int) run", "port", f"{_stretch()} _shape")


def _clip_sides(df: DataFrame, mask: DataFrame, geom: str) -> tuple[DataFrame, DataFrame]:
    """The features with row numbers, and the areas of the mask."""
    masks = mask.where(f"{G.family(geom)} = 2").select(F.monotonically_increasing_id().alias("mid"), F.expr(M.orient(geom)).alias("_m"))
    return number_rows(df), cut_lineage(masks)


def clip_measures(df: DataFrame, mask: DataFrame, id_: str, mask_id: str, geom: str = GEOM) -> DataFrame:
    """Area (areas) and length (lines; perimeter of areas) of each feature inside and outside the mask.

    One row for each feature and side; ids may be null or repeated.
    The mask features must not overlap each other (dissolve them first); common edges are fine.
    """
    step = snap_step(srid_of(df, geom))
    rows, masks = _clip_sides(df, mask, geom)
    group = [ROW, "port"]
    pieces = snapped(_clip_areas(rows.where(f"{G.family(geom)} = 2").select(ROW, F.expr(M.orient(geom)).alias("_g")), masks), step)
    areas = edge_measures(cancel_opposites(pieces, group), group, step).where("area > 0")
    lines = _clip_lines(rows.where(f"{G.family(geom)} = 1").select(ROW, F.col(geom).alias("_g")), masks)
    lines = lines.groupBy(*group).agg(F.lit(0.0).alias("area"), F.expr(f"sum({M.length('_shape')})").alias("perimeter"))
    return areas.unionByName(lines).join(rows.select(ROW, id_), ROW).select(id_, "port", "area", F.col("perimeter").alias("length"))


def clip(df: DataFrame, mask: DataFrame, id_: str, mask_id: str, geom: str = GEOM) -> DataFrame:
    """Features split at the mask: all columns and ``port`` ``inside`` or ``outside``.

    Areas are one geometry for each side of the mask. Lines keep their vertices: one row for each stretch on
    one side, along the mask's edge counting as inside. Points stay whole. Null geometries and lines without length are left out.
    Ids may be null or repeated. The mask features must not overlap each other (dissolve them first); common edges are fine.
    """
    srid = srid_of(df, geom)
    step = snap_step(srid)
    rows, masks = _clip_sides(df, mask, geom)
    group = [ROW, "port"]
    pieces = _clip_areas(rows.where(f"{G.family(geom)} = 2").select(ROW, F.expr(M.orient(geom)).alias("_g")), masks)
    areas = _stitched(cancel_opposites(snapped(pieces, step), group), group, step, srid, "_shape")
    lines = _clip_lines(rows.where(f"{G.family(geom)} = 1").select(ROW, F.col(geom).alias("_g")), masks).select(*group, "_shape")
    attributes = [c for c in df.columns if c != geom]
    cut = areas.unionByName(lines).join(rows.select(ROW, *attributes), ROW).select(*attributes, "port", F.col("_shape").alias(geom))
    points = clip_points(df.where(f"{G.family(geom)} = 0"), mask, id_, mask_id, geom=geom).select(*attributes, "port", geom)
    return describe(cut.unionByName(points), geom, srid=srid, kind=None)


def clip_points(df: DataFrame, mask: DataFrame, id_: str, mask_id: str, **options: object) -> DataFrame:
    """Points with ``port`` ``inside`` (mask edges included) or ``outside``."""
    routed = spatial_relate(df, mask, id_, mask_id, "intersects", **options)
    return routed.withColumn("port", F.when(F.col("port") == "related", "inside").otherwise("outside"))


# --- buffer --------------------------------------------------------------------------------


def _capsule(s: str, radius: str) -> str:
    """Ring around a segment: a half circle at each end."""
    steps = CIRCLE_SIDES // 2

    def arc(x: str, y: str, turn: float) -> str:
        def corner(i: str) -> str:
            angle = f"(atan2({s}.y2 - {s}.y1, {s}.x2 - {s}.x1) + {num(turn)} + {num(math.pi / steps)} * {i})"
            return G.xy(f"{x} + {radius} * cos({angle})", f"{y} + {radius} * sin({angle})")

        return each("transform", f"sequence(0, {steps})", corner)

    ends = f"concat({arc(f'{s}.x2', f'{s}.y2', -math.pi / 2)}, {arc(f'{s}.x1', f'{s}.y1', math.pi / 2)})"
    return let(ends, lambda r: f"concat({r}, slice({r}, 1, 1))")


def buffer(
    df: DataFrame, distance: float, id_: str, unit: str | None = None, metric_srid: int = 2154, geom: str = GEOM
) -> DataFrame:
    """Replace geometries by the area within a distance; circles are drawn with 64 corners.

    Ids may be null or repeated. A line without length has a circle around its first vertex.
    ``unit`` ``m`` or ``km`` measures geographic layers in the plane of ``metric_srid``; without it
    the distance is in the units of the layer.
    """
    units = {None: 1.0, "m": 1.0, "km": 1000.0}
    if unit not in units:
        raise ValueError(f"unknown unit {unit!r}; known: m, km")
    if distance <= 0:
        raise ValueError("the distance must be positive")
    srid = srid_of(df, geom) or 4326
    if unit and is_geographic(srid):
        moved = reproject(df, metric_srid, geom=geom)
        return reproject(buffer(moved, distance, id_, unit, metric_srid, geom), srid, geom=geom)
    radius = num(distance * units[unit])
    if is_point_layer(df, geom):
        p = G.only_point(geom)
        return replace_geom(df, F.expr(G.polygon(f"array({circle(f'{p}.x', f'{p}.y', radius)})")), geom)

    # every vertex of a point geometry, every edge of the others, and areas themselves
    spots = let(G.vertices(geom), lambda vs: each("transform", vs, lambda v: G.polygon(f"array({circle(f'{v}.x', f'{v}.y', radius)})")))
    edges = let(
        G.proper_segments(geom),
        lambda proper: f"if(size({proper}) = 0, slice({spots}, 1, 1), "
        + each("transform", proper, lambda s: G.polygon(f"array({_capsule(s, radius)})")) + ")",
    )
    solids = each("transform", f"{geom}.parts", lambda part: G.make_geom("'Polygon'", f"array({part})"))
    pieces = f"case {G.family(geom)} when 0 then {spots} when 1 then {edges} else concat({edges}, {solids}) end"
    covered = number_rows(df.withColumn("_pieces", F.expr(pieces)))
    # one piece is the result; several pieces of a feature are united
    single = covered.withColumn(geom, F.expr("if(size(_pieces) = 1, _pieces[0], null)")).where(
        "_pieces is null or size(_pieces) <= 1"
    )
    several = covered.where("size(_pieces) > 1")
    parts = describe(
        several.select(F.col(ROW).alias("_owner"), F.expr("explode(_pieces)").alias(geom)), geom, srid=srid
    )
    step = snap_step(srid)
    outlines = _stitched(union_edges(parts, ["_owner"], geom), ["_owner"], step, srid, geom)
    united = several.drop(geom).join(outlines, F.col(ROW) == F.col("_owner"), "left")
    return describe(
        single.select(*df.columns).unionByName(united.select(*df.columns)), geom, srid=srid, kind=None
    )


# --- lines ---------------------------------------------------------------------------------


def line_parts(rows: DataFrame, geom: str, keep: list[str] | None = None) -> DataFrame:
    """``_row, part, segs`` and the kept columns in ``_own``: every part of the lines as the array of its edges that have a length."""
    kept = [F.struct(F.lit(True).alias("_"), *[F.col(f"`{c}`") for c in keep]).alias("_own")] if keep is not None else []
    proper = each("filter", G.ring_segments("_p[0]"), lambda e: f"({e}.x1 != {e}.x2 or {e}.y1 != {e}.y2)")
    parts = rows.select(ROW, *kept, F.expr(f"posexplode({geom}.parts)").alias("part", "_p"))
    return parts.select(ROW, "part", F.expr(proper).alias("segs"), *(["_own"] if kept else [])).where("size(segs) > 0")


def _line_edges(lines: DataFrame) -> DataFrame:
    """``_row, part, seg, last, closed, x1, y1, x2, y2``: the edges of the parts in their order."""
    closed = "segs[0].x1 = segs[size(segs) - 1].x2 and segs[0].y1 = segs[size(segs) - 1].y2"
    return lines.selectExpr(ROW, "part", "size(segs) - 1 last", f"{closed} closed", "posexplode(segs) as (seg, _e)").select("*", "_e.*").drop("_e")


def line_stretches(lines: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """The parts cut where they meet the other segments: ``_row, part, piece, from_seg, from_t, to_seg, to_t``.

    Without ``others`` they are cut where they meet each other and themselves; only neighbouring edges of a part, which share
    a vertex, don't cut each other.  Places are an edge and a position in [0, 1) on it; the end of a part is the edge after the
    last one.  Parts that meet nothing are not sorted, and no list of the places of a part is made.
    """
    edges = spread(_line_edges(lines), ROW, "part")
    apart = "true"
    if others is None:
        # both sides of the join and the levels of its grid read them
        edges = others = cut_lineage(edges)
        same = f"l_{ROW} = r_{ROW} and l_part = r_part"
        apart = f"not ({same} and (abs(l_seg - r_seg) <= 1 or l_closed and abs(l_seg - r_seg) = l_last))"
    key = [ROW, "part"]
    hits = meetings(edges, others, [*key, "seg"], apart, most=others is edges)
    # a place at the end of an edge is the start of the next one
    start, end = f"t * {_LENGTH} <= {_TOLERANCE}", f"(1 - t) * {_LENGTH} <= {_TOLERANCE}"
    places = hits.selectExpr(*key, "last", f"if({end}, seg + 1, seg) seg", f"if({start} or {end}, 0.0D, t) t", f"{_LENGTH} len", f"{_TOLERANCE} tol")
    inner = places.where("not (t = 0 and (seg = 0 or seg = last + 1))")
    # the start of a part is a place like the others, so one sort of them gives all pieces
    starts = lines.selectExpr(*key, "size(segs) - 1 last", "0 seg", "0.0D t", "0.0D len", "0.0D tol")
    along = Window.partitionBy(*key).orderBy("seg", "t")
    before = F.lag(F.struct("seg", "t")).over(along)
    stops = (
        starts.unionByName(inner).withColumn("_b", before)
        # positions closer than the tolerance are one position
        .where("_b is null or _b.seg != seg or (t - _b.t) * len > tol")
        .select(*key, "last", "seg", "t")
    )
    following = F.lead(F.struct("seg", "t")).over(along)
    return stops.withColumn("_n", following).withColumn("piece", F.row_number().over(along)).selectExpr(
        *key, "piece", "seg from_seg", "t from_t", "coalesce(_n.seg, last + 1) to_seg", "coalesce(_n.t, 0.0D) to_t"
    )


def _place(seg: str, t: str) -> str:
    """The point at a position of an edge of ``segs``; the place after the last edge is its end."""
    e = f"segs[least({seg}, size(segs) - 1)]"
    return case(
        (f"{seg} >= size(segs)", G.xy(f"{e}.x2", f"{e}.y2")), (f"{t} = 0", G.xy(f"{e}.x1", f"{e}.y1")),
        default=G.xy(f"{e}.x1 + {t} * ({e}.x2 - {e}.x1)", f"{e}.y1 + {t} * ({e}.y2 - {e}.y1)"),
    )


def _stretch() -> str:
    """Line between two places of ``segs``, with the vertices between them."""
    count = "to_seg - from_seg - if(to_t = 0, 1, 0)"
    between = each("transform", f"slice(segs, from_seg + 1, {count})", lambda e: G.xy(f"{e}.x2", f"{e}.y2"))
    first, last = _place("from_seg", "from_t"), _place("to_seg", "to_t")
    return G.line(f"if({count} <= 0, array({first}, {last}), concat(array({first}), {between}, array({last})))")


def _first_middle() -> str:
    """A point within the first straight bit between two places of ``segs``."""
    a = _place("from_seg", "from_t")
    b = f"if(to_seg = from_seg, {_place('to_seg', 'to_t')}, {G.xy('segs[from_seg].x2', 'segs[from_seg].y2')})"
    return let(f"array({a}, {b})", lambda p: G.xy(f"({p}[0].x + {p}[1].x) / 2", f"({p}[0].y + {p}[1].y) / 2"))


def split_lines(df: DataFrame, id_: str, geom: str = GEOM) -> DataFrame:
    """Break lines where they meet other lines or themselves: all columns, ``part`` and ``piece`` of it, both from their start.

    Pieces keep the vertices between two breaks; ids may be null or repeated.  Points and areas raise an error, null geometries are left out.  A
    line without any length is one piece, unchanged, and breaks no other.
    """
    lines = number_rows(df.where(G.only_family(geom, 1, "split_lines")))
    attributes = [c for c in df.columns if c != geom]
    stretches = line_stretches(line_parts(lines, geom)).withColumnsRenamed({"part": "_part", ROW: "_of"})
    own = line_parts(lines, geom, attributes).withColumnsRenamed({ROW: "_l", "part": "_n"})
    met = stretches.join(guarded(own), (F.col("_of") == F.col("_l")) & (F.col("_part") == F.col("_n")))
    pieces = met.select(*[F.col("_own")[c].alias(c) for c in attributes], F.col("_part").alias("part"), "piece", F.expr(_stretch()).alias(geom))
    short = lines.where(f"size({G.proper_segments(geom)}) = 0").select(*attributes, F.lit(0).alias("part"), F.lit(1).alias("piece"), geom)
    return describe(pieces.unionByName(short), geom, srid=srid_of(df, geom), kind=None)

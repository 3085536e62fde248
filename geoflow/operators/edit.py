"""Geometry edits that stay within one feature."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import measures as M
from ..functions import predicates as P
from ..functions.layer import GEOM, is_point_layer, replace_geom
from ..functions.sql import case, each, each_with_index, let, num

CIRCLE_SIDES = 64


def centroid(df: DataFrame, geom: str = GEOM) -> DataFrame:
    """Replace geometries with their centres of mass."""
    centre = let(M.centroid_xy(geom), lambda c: case((f"{c} is not null", G.point(f"{c}.x", f"{c}.y"))))
    return replace_geom(df, F.expr(centre), geom)


def replace_with_bbox(df: DataFrame, geom: str = GEOM) -> DataFrame:
    """Replace geometries with their envelopes, always as polygons."""
    box = G.point_box(geom) if is_point_layer(df, geom) else G.bbox(geom)
    shape = let(
        box,
        lambda b: case((f"{b} is not null", G.rectangle(f"{b}.xmin", f"{b}.ymin", f"{b}.xmax", f"{b}.ymax"))),
    )
    return replace_geom(df, F.expr(shape), geom)


def orient(df: DataFrame, ccw: bool = True, geom: str = GEOM) -> DataFrame:
    return replace_geom(df, F.expr(M.orient(geom, ccw)), geom)


def densify(df: DataFrame, spacing: float, geom: str = GEOM) -> DataFrame:
    """Split every edge longer than ``spacing`` into the fewest equal pieces no longer than it."""

    def ring(r: str) -> str:
        def edge(s: str) -> str:
            pieces = f"int(greatest(1, ceil({M.segment_length(s)} / {num(spacing)})))"

            def stops(n: str) -> str:
                return each(
                    "transform",
                    f"sequence(0, {n} - 1)",
                    lambda i: G.xy(
                        f"{s}.x1 + ({s}.x2 - {s}.x1) * {i} / {n}", f"{s}.y1 + ({s}.y2 - {s}.y1) * {i} / {n}"
                    ),
                )

            return let(pieces, stops)

        inner = f"flatten({each('transform', M.ring_segments(r), edge)})"
        return f"concat({inner}, slice({r}, -1, 1))"

    lines = case((f"{G.family(geom)} = 0", geom), default=G.map_rings(geom, ring))
    return replace_geom(df, F.expr(lines), geom)


def snap_to_grid(df: DataFrame, tolerance: float, geom: str = GEOM) -> DataFrame:
    """Move vertices to multiples of ``tolerance`` (halves go up) and drop repeated ones."""
    t = num(tolerance)

    def snap(v: str) -> str:
        return f"floor({v} / {t} + 0.5D) * {t}"

    def ring(r: str) -> str:
        return M.drop_repeats(each("transform", r, lambda p: G.xy(snap(f"{p}.x"), snap(f"{p}.y"))))

    points = is_point_layer(df, geom)
    if points:
        p = G.only_point(geom)
        shape = G.point(snap(f"{p}.x"), snap(f"{p}.y"))
    else:
        shape = G.map_rings(geom, ring)
    return replace_geom(df, F.expr(shape), geom, kind="Point" if points else None)


def circle(x: str, y: str, radius: str, sides: int = CIRCLE_SIDES) -> str:
    """Ring of a regular polygon around a point, first vertex repeated at the end."""

    def corner(i: str) -> str:
        angle = f"({num(2 * math.pi / sides)} * ({i} % {sides}))"
        return G.xy(f"{x} + {radius} * cos({angle})", f"{y} + {radius} * sin({angle})")

    return each("transform", f"sequence(0, {sides})", corner)


# --- validation ----------------------------------------------------------------------------


def _self_crossing(ring: str) -> str:
    """Do two edges of the ring meet other than neighbours at their common vertex?"""

    def edges(segs: str) -> str:
        def with_later(s: str, i: str) -> str:
            later = f"slice({segs}, {i} + 2, greatest(size({segs}) - {i} - 1, 0))"

            def meets(r: str, k: str) -> str:
                neighbour = f"({k} = 0 or ({i} = 0 and {k} = size({segs}) - 2))"
                hits = P.meeting_params(s, f"array({r})")
                # neighbours share one vertex; folding back over each other gives two positions
                return f"(size({hits}) > if({neighbour}, 1, 0))"

            return f"array_contains({each_with_index('transform', later, meets)}, true)"

        return f"array_contains({each_with_index('transform', segs, with_later)}, true)"

    return let(M.ring_segments(ring), edges)


def problem(geom: str) -> str:
    """Name of the first defect of a geometry, null for a valid one."""
    vs = G.vertices(geom)
    area, not_point = f"{G.family(geom)} = 2", f"{G.family(geom)} > 0"
    first, last = (lambda r: f"get({r}, 0)"), (lambda r: f"get({r}, size({r}) - 1)")
    unclosed = each(
        "exists",
        G.rings(geom),
        lambda r: f"({first(r)}.x != {last(r)}.x or {first(r)}.y != {last(r)}.y)",
    )
    return case(
        (f"{geom}.type is null", "'null geometry'"),
        (f"size({vs}) = 0", "'empty'"),
        (each("exists", vs, lambda v: f"not ({G.is_finite(v + '.x')} and {G.is_finite(v + '.y')})"), "'bad coordinate'"),
        (f"{area} and {unclosed}", "'unclosed ring'"),
        (
            f"{not_point} and {each('exists', G.rings(geom), lambda r: f'size({M.drop_repeats(r)}) < if({area}, 4, 2)')}",
            "'too few points'",
        ),
        (
            f"{not_point} and {each('exists', G.rings(geom), lambda r: f'size({M.drop_repeats(r)}) < size({r})')}",
            "'repeated vertex'",
        ),
        (f"{area} and {each('exists', G.rings(geom), _self_crossing)}", "'self crossing'"),
        (f"{area} and {each('exists', G.rings(geom), lambda r: f'{M.ring_area(r)} = 0')}", "'zero area'"),
    )


def repaired(geom: str) -> str:
    """Close rings, drop repeated vertices, rings without extent and empty parts, orient areas."""

    def close(r: str) -> str:
        return let(
            r,
            lambda q: f"if(get({q}, 0).x = get({q}, size({q}) - 1).x and get({q}, 0).y = get({q}, size({q}) - 1).y,"
            f" {q}, concat({q}, slice({q}, 1, 1)))",
        )

    def solid(part: str) -> str:
        cleaned = each("transform", part, lambda r: M.drop_repeats(close(r)))
        return let(
            cleaned,
            lambda rs: f"if(size(get({rs}, 0)) >= 4 and {M.ring_area(f'get({rs}, 0)')} != 0, "
            f"{each('filter', rs, lambda r: f'(size({r}) >= 4 and {M.ring_area(r)} != 0)')}, slice({rs}, 1, 0))",
        )

    areas = each("filter", each("transform", f"{geom}.parts", solid), lambda p: f"size({p}) > 0")
    lines = each(
        "filter",
        each("transform", f"{geom}.parts", lambda part: each("transform", part, M.drop_repeats)),
        lambda p: f"size(get({p}, 0)) >= 2",
    )
    parts = f"case {G.family(geom)} when 2 then {areas} when 1 then {lines} else {geom}.parts end"
    rebuilt = let(
        parts, lambda ps: case((f"size({ps}) > 0", G.make_geom(f"{geom}.type", ps)), default=G.null_geom())
    )
    return let(rebuilt, M.orient)


# Defects that the repair removes.
REPAIRABLE = ("unclosed ring", "too few points", "repeated vertex", "zero area")


def validate(df: DataFrame, repair: bool = False, geom: str = GEOM) -> DataFrame:
    """Add ``problem``; with ``repair`` also fix what can be fixed and report what is left in ``reject_reason``."""
    checked = df.withColumn("problem", F.expr(problem(geom)))
    if not repair:
        return checked
    fixable = ", ".join(f"'{p}'" for p in REPAIRABLE)
    fixed = replace_geom(
        checked, F.expr(case((f"problem in ({fixable})", repaired(geom)), default=geom)), geom
    )
    left = case(("problem is null", "null"), (f"problem in ({fixable})", problem(geom)), default="problem")
    return fixed.withColumn("reject_reason", F.expr(left))


# --- simplification ------------------------------------------------------------------------


def _keep_mask(xs: np.ndarray, ys: np.ndarray, tolerance: float) -> np.ndarray:
    """Vertices kept by the Douglas-Peucker rule: split at the farthest one while it is too far."""
    n = len(xs)
    keep = np.zeros(n, dtype=bool)
    keep[[0, n - 1]] = True
    pending = [(0, n - 1)]
    while pending:
        a, b = pending.pop()
        if b - a < 2:
            continue
        px, py = xs[a + 1 : b] - xs[a], ys[a + 1 : b] - ys[a]
        dx, dy = xs[b] - xs[a], ys[b] - ys[a]
        len2 = dx * dx + dy * dy
        t = np.clip((px * dx + py * dy) / len2, 0.0, 1.0) if len2 > 0 else np.zeros(len(px))
        away = np.hypot(px - t * dx, py - t * dy)
        far = int(np.argmax(away))
        if away[far] > tolerance:
            middle = a + 1 + far
            keep[middle] = True
            pending += [(a, middle), (middle, b)]
    return keep


def simplify(df: DataFrame, tolerance: float, geom: str = GEOM) -> DataFrame:
    """Drop vertices closer than ``tolerance`` to the simplified line; rings that would collapse stay whole.

    The recursion needs a loop per ring, so the vertex lists go through Python in Arrow batches and
    come back as keep flags.
    """
    if is_point_layer(df, geom):
        return df

    @F.pandas_udf("array<boolean>")
    def keep_flags(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for xs, ys, sizes, closed in batches:
            out = []
            for fx, fy, ring_sizes, shut in zip(xs, ys, sizes, closed, strict=True):
                if fx is None:
                    out.append(None)
                    continue
                flags, at = np.ones(len(fx), dtype=bool), 0
                for n in ring_sizes:
                    if n >= 3:
                        kept = _keep_mask(fx[at : at + n], fy[at : at + n], tolerance)
                        if not shut or kept.sum() >= 4:
                            flags[at : at + n] = kept
                    at += n
                out.append(flags.tolist())
            yield pd.Series(out)

    flat = df.selectExpr(
        "*",
        f"{each('transform', G.vertices(geom), lambda v: f'{v}.x')} _xs",
        f"{each('transform', G.vertices(geom), lambda v: f'{v}.y')} _ys",
        f"{each('transform', G.rings(geom), lambda r: f'size({r})')} _sizes",
        f"{G.family(geom)} = 2 _closed",
    )
    flagged = flat.withColumn("_keep", keep_flags("_xs", "_ys", "_sizes", "_closed"))

    def ring(r: str, offset: str) -> str:
        return each_with_index("filter", r, lambda v, i: f"get(_keep, {offset} + {i})")

    def part(p: str, k: str) -> str:
        # vertices before this part, then before this ring
        before_part = f"size(flatten(flatten(slice({geom}.parts, 1, {k}))))"
        return each_with_index(
            "transform", p, lambda r, j: let(f"{before_part} + size(flatten(slice({p}, 1, {j})))", lambda o: ring(r, o))
        )

    parts = each_with_index("transform", f"{geom}.parts", part)
    shape = case((f"{geom}.type is not null", G.make_geom(f"{geom}.type", parts)))
    return replace_geom(flagged, F.expr(shape), geom).select(*df.columns)


def feature_bbox(df: DataFrame, geom: str = GEOM) -> DataFrame:
    """Add ``xmin, ymin, xmax, ymax`` and ``vertices``."""
    box = G.point_box(geom) if is_point_layer(df, geom) else G.bbox(geom)
    return df.select(
        "*", F.expr(f"inline(array({box}))"), F.expr(G.vertex_count(geom)).alias("vertices")
    )


def add_measures(df: DataFrame, geom: str = GEOM) -> DataFrame:
    return df.withColumns({"area": F.expr(M.area(geom)), "length": F.expr(M.length(geom))})


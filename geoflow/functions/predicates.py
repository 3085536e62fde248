"""Exact spatial predicates between two geometry columns of the same row, as SQL text.

The linework of each side is cut where it meets the other side, every piece is located by its
midpoint, and the predicates follow from which locations occur.  Location codes: ``I`` inside,
``E`` outside, ``S``/``O`` on the other boundary with the interiors on the same/opposite side
(areas), ``B`` on the other line or on a boundary point.  Areas must be oriented (shell
counter-clockwise), which :func:`relation` sees to.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .geometry import POINT, bbox, family, is_box, proper_segments, segment, segments, single_point, vertices, xy
from .measures import orient, ring_area
from .sql import case, each, each_with_index, let, num, stages, struct

# Coordinates closer than this share of their magnitude count as equal.
RELATIVE_TOLERANCE = 1e-12
# Directions whose sine is below this count as parallel.
PARALLEL = 1e-12

PREDICATES = (
    "intersects", "within", "contains", "touches", "crosses", "overlaps", "covers", "covered_by",
    "contains_properly", "dwithin",
)
_NO_PARAMS = "cast(array() as array<double>)"


def tolerance(x: str, y: str) -> str:
    return f"({num(RELATIVE_TOLERANCE)} * (abs({x}) + abs({y}) + 1.0D))"


def norm(x: str, y: str) -> str:
    return f"sqrt(({x}) * ({x}) + ({y}) * ({y}))"


def on_segment(p: str, s: str) -> str:
    """Is ``p`` on the segment, ends included?"""
    tol = tolerance(f"{p}.x", f"{p}.y")
    dx, dy = f"({s}.x2 - {s}.x1)", f"({s}.y2 - {s}.y1)"
    off = f"abs({dx} * ({p}.y - {s}.y1) - {dy} * ({p}.x - {s}.x1))"
    # the box check is cheap and settles most cases
    return (
        f"({p}.x >= least({s}.x1, {s}.x2) - {tol} and {p}.x <= greatest({s}.x1, {s}.x2) + {tol}"
        f" and {p}.y >= least({s}.y1, {s}.y2) - {tol} and {p}.y <= greatest({s}.y1, {s}.y2) + {tol}"
        f" and {off} <= {tol} * greatest({norm(dx, dy)}, {tol}))"
    )


def inside_even_odd(p: str, segs: str) -> str:
    """Ray casting over all rings; meaningless for a point on the boundary."""
    crossed = each(
        "filter",
        segs,
        lambda s: f"(({s}.y1 > {p}.y) != ({s}.y2 > {p}.y)"
        f" and {p}.x < {s}.x1 + ({p}.y - {s}.y1) * ({s}.x2 - {s}.x1) / ({s}.y2 - {s}.y1))",
    )
    return f"(size({crossed}) % 2 = 1)"


def on_any(p: str, segs: str) -> str:
    return each("exists", segs, lambda s: on_segment(p, s))


def locate_in_area(p: str, segs: str) -> str:
    """``I``, ``B`` or ``E`` of a point against the rings of an area."""
    return case((on_any(p, segs), "'B'"), (inside_even_odd(p, segs), "'I'"), default="'E'")


def same_point(p: str, q: str) -> str:
    tol = tolerance(f"{p}.x", f"{p}.y")
    return f"(abs({p}.x - {q}.x) <= {tol} and abs({p}.y - {q}.y) <= {tol})"


def line_ends(g: str) -> str:
    """Boundary of a line: the ends of its open parts."""

    def ends(part: str) -> str:
        return let(
            f"get({part}, 0)",
            lambda seq: let(
                struct(a=f"get({seq}, 0)", b=f"get({seq}, size({seq}) - 1)"),
                lambda e: f"if({same_point(e + '.a', e + '.b')}, slice({seq}, 1, 0), array({e}.a, {e}.b))",
            ),
        )

    return f"flatten({each('transform', f'{g}.parts', ends)})"


def meeting_params(s: str, segs: str) -> str:
    """Sorted positions in [0, 1] along ``s`` where it meets the other segments."""
    frame = struct(
        xlo=f"least({s}.x1, {s}.x2)", xhi=f"greatest({s}.x1, {s}.x2)",
        ylo=f"least({s}.y1, {s}.y2)", yhi=f"greatest({s}.y1, {s}.y2)",
        ux=f"{s}.x2 - {s}.x1", uy=f"{s}.y2 - {s}.y1",
        lu=norm(f"{s}.x2 - {s}.x1", f"{s}.y2 - {s}.y1"),
        tol=tolerance(f"greatest(abs({s}.x1), abs({s}.x2))", f"greatest(abs({s}.y1), abs({s}.y2))"),
    )

    def in_frame(f: str) -> str:
        near = each(
            "filter",
            segs,
            lambda r: f"(least({r}.x1, {r}.x2) <= {f}.xhi + {f}.tol and greatest({r}.x1, {r}.x2) >= {f}.xlo - {f}.tol"
            f" and least({r}.y1, {r}.y2) <= {f}.yhi + {f}.tol and greatest({r}.y1, {r}.y2) >= {f}.ylo - {f}.tol)",
        )

        def against(r: str) -> str:
            vx, vy = f"({r}.x2 - {r}.x1)", f"({r}.y2 - {r}.y1)"
            qx, qy = f"({r}.x1 - {s}.x1)", f"({r}.y1 - {s}.y1)"
            products = struct(
                den=f"{f}.ux * {vy} - {f}.uy * {vx}",
                tn=f"{qx} * {vy} - {qy} * {vx}",
                wn=f"{qx} * {f}.uy - {qy} * {f}.ux",
                lv=norm(vx, vy),
            )

            def params(m: str) -> str:
                proper = (
                    f"{m}.tn / {m}.den between -{f}.tol / {f}.lu and 1 + {f}.tol / {f}.lu"
                    f" and {m}.wn / {m}.den between -{f}.tol / {m}.lv and 1 + {f}.tol / {m}.lv"
                )
                along = f"({f}.lu * {f}.lu)"
                ends = (
                    f"array(({qx} * {f}.ux + {qy} * {f}.uy) / {along},"
                    f" (({qx} + {vx}) * {f}.ux + ({qy} + {vy}) * {f}.uy) / {along})"
                )
                return case(
                    (f"{f}.lu = 0 or {m}.lv = 0", _NO_PARAMS),
                    (
                        f"abs({m}.den) > {num(PARALLEL)} * {f}.lu * {m}.lv",
                        f"if({proper}, array({m}.tn / {m}.den), {_NO_PARAMS})",
                    ),
                    (f"abs({m}.wn) <= {f}.tol * {f}.lu", ends),
                    default=_NO_PARAMS,
                )

            return let(products, params)

        found = f"flatten({each('transform', near, against)})"
        kept = each("filter", found, lambda t: f"({t} * {f}.lu >= -{f}.tol and ({t} - 1) * {f}.lu <= {f}.tol)")
        return f"array_sort({each('transform', kept, lambda t: f'greatest(0.0D, least(1.0D, {t}))')})"

    return let(frame, in_frame)


def meeting_steps(s: str, r: str) -> list[dict[str, str]]:
    """The positions of :func:`meeting_params` for two segments in columns with prefixes ``s`` and ``r``, as steps of columns.

    The last step has ``_ta`` and ``_tb``; both are null where the segments don't meet, ``_tb`` also where they do in one point.
    """
    sx1, sy1, sx2, sy2 = (s + c for c in ("x1", "y1", "x2", "y2"))
    rx1, ry1, rx2, ry2 = (r + c for c in ("x1", "y1", "x2", "y2"))
    vx, vy, qx, qy = f"({rx2} - {rx1})", f"({ry2} - {ry1})", f"({rx1} - {sx1})", f"({ry1} - {sy1})"
    frame = {
        "_ux": f"{sx2} - {sx1}", "_uy": f"{sy2} - {sy1}", "_lu": norm(f"{sx2} - {sx1}", f"{sy2} - {sy1}"), "_lv": norm(vx, vy),
        "_tol": tolerance(f"greatest(abs({sx1}), abs({sx2}))", f"greatest(abs({sy1}), abs({sy2}))"),
    }
    products = {"_den": f"_ux * {vy} - _uy * {vx}", "_tn": f"{qx} * {vy} - {qy} * {vx}", "_wn": f"{qx} * _uy - {qy} * _ux"}
    near = (
        f"(least({rx1}, {rx2}) <= greatest({sx1}, {sx2}) + _tol and greatest({rx1}, {rx2}) >= least({sx1}, {sx2}) - _tol"
        f" and least({ry1}, {ry2}) <= greatest({sy1}, {sy2}) + _tol and greatest({ry1}, {ry2}) >= least({sy1}, {sy2}) - _tol)"
    )
    proper = (
        "_tn / _den between -_tol / _lu and 1 + _tol / _lu and _wn / _den between -_tol / _lv and 1 + _tol / _lv"
    )
    skew = f"abs(_den) > {num(PARALLEL)} * _lu * _lv"
    raw = {
        "_a": case(
            (f"_lu = 0 or _lv = 0 or not {near}", "null"),
            (skew, f"if({proper}, _tn / _den, null)"),
            ("abs(_wn) <= _tol * _lu", f"({qx} * _ux + {qy} * _uy) / (_lu * _lu)"),
        ),
        "_b": case(
            (f"_lu = 0 or _lv = 0 or not {near} or {skew}", "null"),
            ("abs(_wn) <= _tol * _lu", f"(({qx} + {vx}) * _ux + ({qy} + {vy}) * _uy) / (_lu * _lu)"),
        ),
    }

    def kept(t: str) -> str:
        return f"if({t} * _lu >= -_tol and ({t} - 1) * _lu <= _tol, greatest(0.0D, least(1.0D, {t})), null)"

    return [frame, products, raw, {"_ta": kept("_a"), "_tb": kept("_b")}]


def meet(segs: str, others: str) -> str:
    """Every segment together with its meeting positions ``ts``."""
    return each(
        "transform",
        segs,
        lambda s: segment(f"{s}.x1", f"{s}.y1", f"{s}.x2", f"{s}.y2", ts=meeting_params(s, others)),
    )


def cut_one(s: str) -> str:
    """Pieces of one segment ``struct<x1,y1,x2,y2,ts>``, split at its positions, in order."""
    slack = (
        f"({tolerance(f'{s}.x1', f'{s}.y1')} / greatest({norm(f'{s}.x2 - {s}.x1', f'{s}.y2 - {s}.y1')}, 1e-300D))"
    )
    inner = each("filter", f"{s}.ts", lambda t: f"({t} > {slack} and {t} < 1 - {slack})")

    def pieces(ts: str) -> str:
        # positions closer than the tolerance are one position
        distinct = each_with_index(
            "filter", ts, lambda t, i: f"({i} = 0 or {t} = 1 or {t} - get({ts}, {i} - 1) > {slack})"
        )

        def at(t: str, a: str, b: str) -> str:
            return f"if({t} = 1, {b}, {a} + {t} * ({b} - {a}))"

        def ends(us: str) -> str:
            def piece(u: str, i: str) -> str:
                start = f"get({us}, {i})"
                return segment(
                    at(start, f"{s}.x1", f"{s}.x2"),
                    at(start, f"{s}.y1", f"{s}.y2"),
                    at(u, f"{s}.x1", f"{s}.x2"),
                    at(u, f"{s}.y1", f"{s}.y2"),
                )

            return each_with_index("transform", f"slice({us}, 2, size({us}) - 1)", piece)

        return let(distinct, ends)

    return let(f"concat(array(0.0D), {inner}, array(1.0D))", pieces)


def cut(met: str) -> str:
    """Split segments at their meeting positions: ``struct<x1,y1,x2,y2>`` pieces in order."""
    return f"flatten({each('transform', met, cut_one)})"


def piece_code(s: str, other_segs: str, other_family: str) -> str:
    """Location code of one piece against the other geometry."""
    mid = xy(f"({s}.x1 + {s}.x2) / 2", f"({s}.y1 + {s}.y2) / 2")

    def located(m: str) -> str:
        def by_support(support: str) -> str:
            same_way = each(
                "exists",
                support,
                lambda r: f"(({s}.x2 - {s}.x1) * ({r}.x2 - {r}.x1) + ({s}.y2 - {s}.y1) * ({r}.y2 - {r}.y1) > 0)",
            )
            return case(
                (f"size({support}) > 0 and {other_family} = 1", "'B'"),
                (f"size({support}) > 0", f"if({same_way}, 'S', 'O')"),
                (f"{other_family} = 2 and {inside_even_odd(m, other_segs)}", "'I'"),
                default="'E'",
            )

        return let(each("filter", other_segs, lambda r: on_segment(m, r)), by_support)

    return let(mid, located)


def locate_pieces(pieces: str, other_segs: str, other_family: str) -> str:
    """Pieces with their location code against the other geometry."""
    return each(
        "transform",
        pieces,
        lambda s: segment(
            f"{s}.x1", f"{s}.y1", f"{s}.x2", f"{s}.y2", code=piece_code(s, other_segs, other_family)
        ),
    )


def point_code(p: str, other: str, other_segs: str, other_family: str | None = None) -> str:
    """Location code of a point against any geometry."""
    fam = other_family or family(other)
    return case(
        (f"{fam} = 2", locate_in_area(p, other_segs)),
        (
            f"{fam} = 1",
            case(
                (f"not {on_any(p, other_segs)}", "'E'"),
                (each("exists", line_ends(other), lambda e: same_point(p, e)), "'B'"),
                default="'I'",
            ),
        ),
        default=f"if({each('exists', vertices(other), lambda v: same_point(p, v))}, 'I', 'E')",
    )


def segments_meet(s: str, r: str) -> str:
    """Do two segments have a common point?"""
    ux, uy = f"({s}.x2 - {s}.x1)", f"({s}.y2 - {s}.y1)"
    vx, vy = f"({r}.x2 - {r}.x1)", f"({r}.y2 - {r}.y1)"
    qx, qy = f"({r}.x1 - {s}.x1)", f"({r}.y1 - {s}.y1)"

    def apart(axis: str) -> str:
        a, b, c, d = f"{s}.{axis}1", f"{s}.{axis}2", f"{r}.{axis}1", f"{r}.{axis}2"
        return (
            f"(least({a}, {b}) > greatest({c}, {d}) + {tolerance(a, b)}"
            f" or greatest({a}, {b}) < least({c}, {d}) - {tolerance(a, b)})"
        )

    products = struct(
        den=f"{ux} * {vy} - {uy} * {vx}", tn=f"{qx} * {vy} - {qy} * {vx}", wn=f"{qx} * {uy} - {qy} * {ux}",
        lu=norm(ux, uy), lv=norm(vx, vy), tol=tolerance(f"{s}.x1", f"{s}.y1"),
    )

    def decide(m: str) -> str:
        crossing = (
            f"({m}.tn / {m}.den between -{m}.tol / {m}.lu and 1 + {m}.tol / {m}.lu"
            f" and {m}.wn / {m}.den between -{m}.tol / {m}.lv and 1 + {m}.tol / {m}.lv)"
        )
        return case(
            (f"{m}.lu = 0 or {m}.lv = 0", "false"),
            (f"abs({m}.den) > {num(PARALLEL)} * {m}.lu * {m}.lv", crossing),
            # parallel segments on one line whose boxes meet have a common point
            default=f"abs({m}.wn) <= {m}.tol * {m}.lu",
        )

    return f"(not {apart('x')} and not {apart('y')} and {let(products, decide)})"


def _box_relation(a: str, b: str) -> dict[str, str]:
    """Outcome for two axis-parallel rectangles from their boxes alone (see :func:`plain_box`)."""
    t = f"{a}.tol"

    def along(axis: str) -> dict[str, str]:
        a0, a1, b0, b1 = f"{a}.{axis}min", f"{a}.{axis}max", f"{b}.{axis}min", f"{b}.{axis}max"
        return {
            "ii": f"({a0} < {b1} - {t} and {b0} < {a1} - {t})",
            "touch": f"({a0} <= {b1} + {t} and {b0} <= {a1} + {t})",
            "a_in": f"({a0} >= {b0} - {t} and {a1} <= {b1} + {t})",
            "b_in": f"({b0} >= {a0} - {t} and {b1} <= {a1} + {t})",
            "deep": f"({b0} > {a0} + {t} and {b1} < {a1} - {t})",
        }

    x, y = along("x"), along("y")
    m = {k: f"({x[k]} and {y[k]})" for k in x}
    return {
        "ii": m["ii"], "ae": f"(not {m['a_in']})", "be": f"(not {m['b_in']})", "touch": m["touch"], "shared": "false", "deep": m["deep"],
    }


# Beyond this share of their magnitude coordinates are apart for certain, whatever the rounding.
_CLEAR = 1e-9


def plain_box(g: str) -> str:
    """``struct<xmin,ymin,xmax,ymax,tol>`` of an axis-parallel rectangle, null for other geometries."""

    def framed(b: str) -> str:
        tol = tolerance(f"greatest(abs({b}.xmin), abs({b}.xmax))", f"greatest(abs({b}.ymin), abs({b}.ymax))")
        return struct(xmin=f"{b}.xmin", ymin=f"{b}.ymin", xmax=f"{b}.xmax", ymax=f"{b}.ymax", tol=tol)

    return case((is_box(g), let(bbox(g), framed)))


def plain_edge(g: str) -> str:
    """``struct<x1,y1,x2,y2,big>`` of a line with one edge, null for other geometries; ``big`` is its largest coordinate."""
    p, q = f"get(get(get({g}.parts, 0), 0), 0)", f"get(get(get({g}.parts, 0), 0), 1)"
    one = f"endswith({g}.type, 'LineString') and size({g}.parts) = 1 and size(get({g}.parts, 0)) = 1 and size(get(get({g}.parts, 0), 0)) = 2"
    big = f"greatest(abs({p}.x), abs({p}.y), abs({q}.x), abs({q}.y))"
    edge = segment(f"{p}.x", f"{p}.y", f"{q}.x", f"{q}.y", big=big)
    return case((f"{one} and ({p}.x != {q}.x or {p}.y != {q}.y) and {big} < 1e150D", edge))


def _edge_in_box(e: str, b: str, ifs: Callable[[dict[str, str]], str], swapped: bool) -> list[tuple[str, str]]:
    """Conditions and outcomes of a predicate of an edge and a rectangle that are clear by a margin; ``ifs`` has it by the outcome."""
    both = f"{e} is not null and {b} is not null"
    m = f"({num(_CLEAR)} * (1.0D + greatest({e}.big, abs({b}.xmin), abs({b}.xmax), abs({b}.ymin), abs({b}.ymax))))"

    def span(by: str) -> tuple[str, str, str]:
        """Positions between which the edge is in the box grown by ``by``, and whether it is where it runs along an axis."""
        lows, highs, flat = ["0.0D"], ["1.0D"], []
        for c in "xy":
            d = f"nullif({e}.{c}2 - {e}.{c}1, 0.0D)"
            first, last = f"({b}.{c}min - {by} - {e}.{c}1) / {d}", f"({b}.{c}max + {by} - {e}.{c}1) / {d}"
            lows.append(f"least({first}, {last})")
            highs.append(f"greatest({first}, {last})")
            flat.append(f"({e}.{c}1 != {e}.{c}2 or {e}.{c}1 > {b}.{c}min - {by} and {e}.{c}1 < {b}.{c}max + {by})")
        return f"greatest({', '.join(lows)})", f"least({', '.join(highs)})", f"({' and '.join(flat)})"

    def end(n: int, inside: bool) -> str:
        sides = [(f"{e}.x{n}", f"{b}.xmin", f"{b}.xmax"), (f"{e}.y{n}", f"{b}.ymin", f"{b}.ymax")]
        if inside:
            return "(" + " and ".join(f"{v} > {lo} + {m} and {v} < {hi} - {m}" for v, lo, hi in sides) + ")"
        return "(" + " or ".join(f"{v} < {lo} - {m} or {v} > {hi} + {m}" for v, lo, hi in sides) + ")"

    t0, t1, flat = span(m)
    u0, u1, within = span(f"-{m}")
    away = f"(not {flat} or {t0} > {t1})"
    through = f"({within} and ({u1} - {u0}) * {norm(f'{e}.x2 - {e}.x1', f'{e}.y2 - {e}.y1')} > {m})"

    def known(out: str) -> str:
        rel = {"ii": "true", "ae": out, "be": "true", "touch": "true", "shared": "false", "deep": "false"}
        return ifs(rel | {"ae": "true", "be": out} if swapped else rel)

    # an edge that is inside is so with all of it, as rectangles are convex
    return [
        (f"{both} and {away}", ifs(dict.fromkeys(("ii", "touch", "shared", "deep"), "false") | {"ae": "true", "be": "true"})),
        (f"{both} and {end(1, True)} and {end(2, True)}", known("false")),
        (f"{both} and ({end(1, False)} or {end(2, False)}) and {through}", known("true")),
    ]


def plain_quad(g: str) -> str:
    """The corners of a convex area of three or four edges against the clock, ``struct<x0,y0,...,x3,y3,big>``; null for other geometries."""

    def framed(r: str) -> str:
        v = [f"get({r}, {i})" for i in range(4)]

        def turn(a: str, b: str, c: str) -> str:
            return f"({b}.x - {a}.x) * ({c}.y - {b}.y) - ({b}.y - {a}.y) * ({c}.x - {b}.x) > 0"

        four = " and ".join(turn(v[i], v[(i + 1) % 4], v[(i + 2) % 4]) for i in range(4))
        three = " and ".join(turn(v[i], v[(i + 1) % 3], v[(i + 2) % 3]) for i in range(3))
        closed = f"get({r}, 0) = get({r}, size({r}) - 1)"
        big = "greatest(" + ", ".join(f"abs({p}.{c})" for p in v for c in "xy") + ")"
        corners = {f"{c}{i}": f"{p}.{c}" for i, p in enumerate(v) for c in "xy"}
        return case((f"{closed} and {big} < 1e150D and (size({r}) = 5 and {four} or size({r}) = 4 and {three})", struct(**corners, big=big)))

    ring = f"get(get({g}.parts, 0), 0)"
    one = f"endswith({g}.type, 'Polygon') and size({g}.parts) = 1 and size(get({g}.parts, 0)) = 1 and size({ring}) in (4, 5)"
    way = f"if({ring_area(ring)} > 0, {ring}, reverse({ring}))"
    return case((one, let(way, framed)))


def _quad_sides(a: str, b: str) -> list[tuple[str, str]]:
    """For every edge of one convex area how far the other one reaches over to its inner side, and the margin of that."""
    margin = f"{num(_CLEAR)} * (1.0D + greatest({a}.big, {b}.big))"
    found = []
    for p, q in ((a, b), (b, a)):
        for i in range(4):
            j = (i + 1) % 4
            dx, dy = f"({p}.x{j} - {p}.x{i})", f"({p}.y{j} - {p}.y{i})"
            reach = ", ".join(f"{dx} * ({q}.y{k} - {p}.y{i}) - {dy} * ({q}.x{k} - {p}.x{i})" for k in range(4))
            found.append((f"greatest({reach})", f"{margin} * (abs({dx}) + abs({dy}))"))
    return found


def quads_apart(a: str, b: str) -> str:
    """Are two convex areas apart by a margin, as an edge of one has the whole other one on its outer side?  Not null."""
    return f"({a} is not null and {b} is not null and ({' or '.join(f'{reach} < -({by})' for reach, by in _quad_sides(a, b))}))"


def _quads_meet(a: str, b: str) -> list[tuple[str, str]]:
    """Conditions and outcomes of the intersection of two convex areas that are clear by a margin.

    Convex areas are apart if and only if an edge of one has the whole other one on its outer side.
    """
    # a triangle has a fourth edge without length
    meet_ = " and ".join(f"({reach} > {by} or {by} = 0)" for reach, by in _quad_sides(a, b))
    return [(quads_apart(a, b), "false"), (f"{a} is not null and {b} is not null and ({meet_})", "true")]


def relation_test(predicate: str, a: str, b: str, a_box: str, b_box: str, a_edge: str | None = None, b_edge: str | None = None) -> str:
    """The predicate of a pair, as one expression.

    ``*_box`` and ``*_edge`` are columns made by :func:`plain_box` and :func:`plain_edge` before the pairs were.
    Pairs of axis-parallel rectangles, and clear ones of an edge and a rectangle, are settled by generated code.
    """

    def by(rel: dict[str, str], fa: str, fb: str) -> str:
        words = {f"_rel.{k}": v for k, v in rel.items()} | {"_fa": fa, "_fb": fb}
        return re.sub("|".join(sorted(map(re.escape, words), key=len, reverse=True)), lambda w: words[w.group()], f"({HOLDS[predicate]})")

    steps, general = _relation_steps(a, b)
    general = stages([*steps, {"_rel": general}], HOLDS[predicate])
    branches = [(f"{a_box} is not null and {b_box} is not null", by(_box_relation(a_box, b_box), "2", "2"))]
    if a_edge is not None:
        branches += _edge_in_box(a_edge, b_box, lambda r: by(r, "1", "2"), False)
    if b_edge is not None:
        branches += _edge_in_box(b_edge, a_box, lambda r: by(r, "2", "1"), True)
    return case(*branches, default=general)


def _relation_steps(a: str, b: str) -> tuple[list[dict[str, str]], str]:
    """What the predicates need to know about a pair of geometries: steps that bind names, and the outcome.

    ``ii`` interiors meet, ``ae``/``be`` a/b has a part outside the other, ``touch`` any common
    point, ``shared`` common linework, ``deep`` b stays clear of the boundary of a.
    """

    def codes(g: str, pieces: str, other: str, other_segs: str, own_family: str, other_family: str) -> str:
        of_points = each("transform", vertices(g), lambda p: point_code(p, other, other_segs, other_family))
        of_pieces = each("transform", pieces, lambda s: piece_code(s, other_segs, other_family))
        return f"if({own_family} = 0, {of_points}, {of_pieces})"

    def has(side: str, codes_: str) -> str:
        wanted = ", ".join(f"'{c}'" for c in codes_)
        return f"arrays_overlap({side}, array({wanted}))"

    meets = each("exists", "_ma", lambda s: f"size({s}.ts) > 0")
    spots = f"""flatten({each('transform', '_ma', lambda s: each('transform', f'{s}.ts', lambda t: xy(
        f'{s}.x1 + {t} * ({s}.x2 - {s}.x1)', f'{s}.y1 + {t} * ({s}.y2 - {s}.y1)')))})"""
    crossing = let(
        f"concat({line_ends('_ga')}, {line_ends('_gb')})",
        lambda ends: each("exists", spots, lambda p: f"not {each('exists', ends, lambda e: same_point(p, e))}"),
    )
    clear_of_ends = f"not {each('exists', line_ends('_ga'), lambda e: on_any(e, '_sb'))}"
    areas, lines = "_fa = 2 and _fb = 2", "_fa = 1 and _fb = 1"
    ii = case(
        (areas, f"({has('_ca', 'IS')} or {has('_cb', 'I')})"),
        (lines, f"({has('_ca', 'B')} or {crossing})"),
        ("_fa <= _fb", has("_ca", "I")),
        default=has("_cb", "I"),
    )
    general = struct(
        ii=ii,
        ae=case(
            (areas, f"({has('_ca', 'EO')} or {has('_cb', 'I')})"), ("_fa > _fb", "true"), default=has("_ca", "E")
        ),
        be=case(
            (areas, f"({has('_cb', 'EO')} or {has('_ca', 'I')})"), ("_fb > _fa", "true"), default=has("_cb", "E")
        ),
        touch=f"({meets} or {has('_ca', 'IBSO')} or {has('_cb', 'IBSO')})",
        shared=f"({lines} and {has('_ca', 'B')})",
        deep=case(
            ("_fa = 2", f"(not {meets} and not {has('_cb', 'BSOE')})"),
            (lines, clear_of_ends),
            default=f"not {has('_cb', 'BE')}",
        ),
    )
    steps = [
        {"_fa": family(a), "_fb": family(b), "_ga": orient(a), "_gb": orient(b)},
        {"_sa": proper_segments("_ga"), "_sb": proper_segments("_gb")},
        {"_ma": meet("_sa", "_sb"), "_mb": meet("_sb", "_sa")},
        {"_pa": cut("_ma"), "_pb": cut("_mb")},
        {
            "_ca": codes("_ga", "_pa", "_gb", "_sb", "_fa", "_fb"),
            "_cb": codes("_gb", "_pb", "_ga", "_sa", "_fb", "_fa"),
        },
    ]
    return steps, general


def intersection_hit(
    a: str, b: str, a_box: str, b_box: str, a_edge: str | None = None, b_edge: str | None = None, a_quad: str | None = None, b_quad: str | None = None
) -> str:
    """Do the geometries have a common point?  One expression, which stops at the first one found; see :func:`relation_test`."""

    def some_vertex_in(g: str, segs: str) -> str:
        first = each("exists", f"{g}.parts", lambda part: inside_even_odd(f"get(get({part}, 0), 0)", segs))
        return first

    def points_on(g: str, other: str, segs: str, other_family: str) -> str:
        return each("exists", vertices(g), lambda p: f"{point_code(p, other, segs, other_family)} != 'E'")

    edges = each("exists", "_sa", lambda s: each("exists", "_sb", lambda r: segments_meet(s, r)))
    hit = case(
        ("_fa = 0", points_on(a, b, "_sb", "_fb")),
        ("_fb = 0", points_on(b, a, "_sa", "_fa")),
        default=f"({edges} or _fb = 2 and {some_vertex_in(a, '_sb')} or _fa = 2 and {some_vertex_in(b, '_sa')})",
    )
    general = stages([{"_fa": family(a), "_fb": family(b), "_sa": segments(a), "_sb": segments(b)}], hit)
    branches = [(f"{a_box} is not null and {b_box} is not null", _box_relation(a_box, b_box)["touch"])]
    if a_edge is not None:
        branches += _edge_in_box(a_edge, b_box, lambda r: r["touch"], False)
    if b_edge is not None:
        branches += _edge_in_box(b_edge, a_box, lambda r: r["touch"], True)
    if a_quad is not None and b_quad is not None:
        branches += _quads_meet(a_quad, b_quad)
    return case(*branches, default=general)


def relation(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Add ``_fa, _fb, _rel``: what the predicates need to know about each pair of geometries, see :func:`_relation_steps`."""
    steps, general = _relation_steps(a, b)
    rel = case(("_xa is not null and _xb is not null", struct(**_box_relation("_xa", "_xb"))), default=stages(steps, general))
    boxed = pairs.selectExpr("*", f"{plain_box(a)} _xa", f"{plain_box(b)} _xb")
    # the generator keeps filters on the outcome from being pushed into the steps above
    return boxed.selectExpr(*pairs.columns, f"{family(a)} _fa", f"{family(b)} _fb", f"explode(array({rel})) _rel")


def intersection_test(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Add ``_hit``: do the geometries have a common point?"""
    boxed = pairs.selectExpr("*", f"{plain_box(a)} _xa", f"{plain_box(b)} _xb")
    return boxed.select(*pairs.columns, F.expr(f"explode(array({intersection_hit(a, b, '_xa', '_xb')}))").alias("_hit"))


# Predicates on the outcome of :func:`relation_test`.
HOLDS = {
    "intersects": "_rel.touch",
    "within": "_rel.ii and not _rel.ae",
    "contains": "_rel.ii and not _rel.be",
    "covered_by": "_rel.touch and not _rel.ae",
    "covers": "_rel.touch and not _rel.be",
    "touches": "_rel.touch and not _rel.ii",
    "crosses": "_rel.ii and case when _fa < _fb then _rel.ae when _fa > _fb then _rel.be"
    " else _fa = 1 and not _rel.shared end",
    "overlaps": "_fa = _fb and _rel.ii and _rel.ae and _rel.be and (_fa != 1 or _rel.shared)",
    "contains_properly": "_rel.touch and not _rel.be and _rel.deep",
}

_POINT_CODES = {"intersects": "'I', 'B'", "covered_by": "'I', 'B'", "within": "'I'", "touches": "'B'"}


def point_holds(predicate: str, p: str, other: str, box: str | None = None) -> str | None:
    """Predicate of a single point against any geometry, without the general machinery.

    ``box`` is a column made by :func:`plain_box`: against a rectangle only points about a tolerance from its boundary need more.
    """
    if predicate not in _POINT_CODES:
        return None
    code = let(segments(other), lambda segs: point_code(p, other, segs))
    general = f"{code} in ({_POINT_CODES[predicate]})"
    if box is None:
        return general
    # how far the point is outside of the rectangle, negative inside
    out = f"greatest({box}.xmin - {p}.x, {p}.x - {box}.xmax, {box}.ymin - {p}.y, {p}.y - {box}.ymax)"
    tol = tolerance(f"{p}.x", f"{p}.y")
    wide = f"(least({box}.xmax - {box}.xmin, {box}.ymax - {box}.ymin) > 4 * {tol})"
    codes = _POINT_CODES[predicate]
    clear = case(
        (f"{out} > 2 * {tol}", "false"),
        (f"abs({out}) <= 0.5D * {tol}", str("'B'" in codes).lower()),
        (f"{out} < -2 * {tol}", str("'I'" in codes).lower()),
        default=general,
    )
    return case((f"{box} is not null and {wide}", clear), default=general)


# --- distance ------------------------------------------------------------------------------


def point_segment_distance(p: str, s: str) -> str:
    def at(d: str) -> str:
        along = f"(({p}.x - {s}.x1) * {d}.x + ({p}.y - {s}.y1) * {d}.y) / ({d}.x * {d}.x + {d}.y * {d}.y)"
        t = f"if({d}.x = 0 and {d}.y = 0, 0.0D, greatest(0.0D, least(1.0D, {along})))"
        return let(t, lambda t: f"hypot({p}.x - ({s}.x1 + {t} * {d}.x), {p}.y - ({s}.y1 + {t} * {d}.y))")

    return let(xy(f"{s}.x2 - {s}.x1", f"{s}.y2 - {s}.y1"), at)


def gap(a: str, b: str) -> str:
    """Distance between two geometries that do not intersect."""

    def as_segments(g: str) -> str:
        stubs = each("transform", vertices(g), lambda v: segment(f"{v}.x", f"{v}.y", f"{v}.x", f"{v}.y"))
        return f"if({family(g)} = 0, {stubs}, {segments(g)})"

    def one_way(g: str, h: str) -> str:
        return let(
            as_segments(h),
            lambda segs: f"""array_min({each('transform', vertices(g), lambda v:
                f"array_min({each('transform', segs, lambda s: point_segment_distance(v, s))})")})""",
        )

    p, q = single_point(a), single_point(b)
    return case(
        (f"{a}.type = '{POINT}' and {b}.type = '{POINT}'", f"hypot({p}.x - {q}.x, {p}.y - {q}.y)"),
        default=f"least({one_way(a, b)}, {one_way(b, a)})",
    )


def edge_box_gap(e: str, g: str) -> str:
    """:func:`gap` of a line's only edge ``e`` (see :func:`plain_edge`) and a rectangle ``g``: the same distances, without lambdas."""
    ring = f"get(get({g}.parts, 0), 0)"
    corners = [(f"get({ring}, {i}).x", f"get({ring}, {i}).y") for i in range(5)]
    own = [(f"{e}.x1", f"{e}.y1"), (f"{e}.x2", f"{e}.y2")]

    def to_edge(p: tuple[str, str], a: tuple[str, str], b: tuple[str, str]) -> str:
        dx, dy = f"({b[0]} - {a[0]})", f"({b[1]} - {a[1]})"
        along = f"(({p[0]} - {a[0]}) * {dx} + ({p[1]} - {a[1]}) * {dy}) / ({dx} * {dx} + {dy} * {dy})"
        # neither a plain edge nor a side of a rectangle is without length
        t = f"greatest(0.0D, least(1.0D, {along}))"
        return f"hypot({p[0]} - ({a[0]} + {t} * {dx}), {p[1]} - ({a[1]} + {t} * {dy}))"

    sides = list(zip(corners, corners[1:], strict=False))
    distances = [to_edge(p, a, b) for p in own for a, b in sides] + [to_edge(c, *own) for c in corners[:4]]
    return f"least({', '.join(distances)})"

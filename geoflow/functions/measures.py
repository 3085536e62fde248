"""Area, length, centroid and ring orientation of the geometry column, as SQL text."""

from __future__ import annotations

from .geometry import family, make_geom, ring_segments, segments, single_point, vertices, xy
from .sql import case, each, each_with_index, fresh, let, struct, total


def ring_area(ring: str) -> str:
    """Signed area (counter-clockwise positive), taken relative to the first vertex."""

    def around(o: str) -> str:
        cross = each(
            "transform",
            ring_segments(ring),
            lambda s: f"(({s}.x1 - {o}.x) * ({s}.y2 - {o}.y) - ({s}.x2 - {o}.x) * ({s}.y1 - {o}.y))",
        )
        return f"{total(cross)} / 2"

    return let(f"get({ring}, 0)", around)


def part_area(part: str) -> str:
    """Area of one polygon: the shell minus its holes, whatever the ring directions."""
    sizes = each("transform", part, lambda r: f"abs({ring_area(r)})")
    return let(sizes, lambda a: f"coalesce(2 * get({a}, 0) - {total(a)}, 0.0D)")


def _only_ring(g: str, vertices_: int) -> str:
    """Is the geometry one ring of so many vertices?"""
    return f"size({g}.parts) = 1 and size(get({g}.parts, 0)) = 1 and size(get(get({g}.parts, 0), 0)) = {vertices_}"


def _corners(g: str, vertices_: int) -> list[str]:
    return [f"get(get(get({g}.parts, 0), 0), {i})" for i in range(vertices_)]


def _quad_area(g: str) -> str:
    """:func:`area` of a single ring of four edges, the same sums without lambdas."""
    p = _corners(g, 5)
    o = p[0]
    cross = [f"(({a}.x - {o}.x) * ({b}.y - {o}.y) - ({b}.x - {o}.x) * ({a}.y - {o}.y))" for a, b in zip(p, p[1:], strict=False)]
    return f"coalesce(abs((0.0D + {' + '.join(cross)}) / 2), 0.0D)"


def area(g: str) -> str:
    return case(
        (f"{family(g)} = 2 and {_only_ring(g, 5)}", _quad_area(g)),
        (f"{family(g)} = 2", total(each("transform", f"{g}.parts", part_area))),
        (f"{g}.type is not null", "0.0D"),
    )


def segment_length(s: str) -> str:
    return f"hypot({s}.x2 - {s}.x1, {s}.y2 - {s}.y1)"


def length(g: str) -> str:
    """Length of lines, perimeter (holes included) of areas, 0 for points."""

    def short(n: int) -> tuple[str, str]:
        p = _corners(g, n)
        return _only_ring(g, n), "0.0D + " + " + ".join(f"hypot({b}.x - {a}.x, {b}.y - {a}.y)" for a, b in zip(p, p[1:], strict=False))

    # lines of one edge and rings of four need no lambda
    return case(short(2), short(5), default=total(each("transform", segments(g), segment_length)))


def _weighted(moments: str) -> str:
    """Sum an array of ``struct<w,x,y>``."""
    a, m = fresh("a"), fresh("m")
    summed = struct(w=f"{a}.w + {m}.w", x=f"{a}.x + {m}.x", y=f"{a}.y + {m}.y")
    return f"aggregate({moments}, {struct(w='0.0D', x='0.0D', y='0.0D')}, ({a}, {m}) -> {summed})"


def _ring_moment(ring: str, o: str, sign: str) -> str:
    def of_segment(s: str) -> str:
        frame = struct(a=f"{s}.x1 - {o}.x", b=f"{s}.y1 - {o}.y", c=f"{s}.x2 - {o}.x", d=f"{s}.y2 - {o}.y")
        return let(
            frame,
            lambda f: let(
                f"{f}.a * {f}.d - {f}.c * {f}.b",
                lambda z: struct(w=f"{z} / 2", x=f"{z} * ({f}.a + {f}.c) / 6", y=f"{z} * ({f}.b + {f}.d) / 6"),
            ),
        )

    # a ring counts with the sign of its role, not of its direction
    return let(
        _weighted(each("transform", ring_segments(ring), of_segment)),
        lambda m: let(
            f"({sign}) * signum({m}.w)", lambda k: struct(w=f"{m}.w * {k}", x=f"{m}.x * {k}", y=f"{m}.y * {k}")
        ),
    )


def centroid_xy(g: str) -> str:
    """Centre of mass as ``struct<x,y>``: by area, by length or by vertex count.

    Areas of zero size fall back to their edges and lines of zero length to their vertices.
    """

    def in_frame(o: str) -> str:
        by_area = _weighted(
            f"""flatten({each('transform', f'{g}.parts', lambda part: each_with_index(
                'transform', part, lambda r, i: _ring_moment(r, o, f'if({i} = 0, 1.0D, -1.0D)')))})"""
        )

        def edge(s: str) -> str:
            return let(
                segment_length(s),
                lambda w: struct(
                    w=w, x=f"{w} * ({s}.x1 + {s}.x2 - 2 * {o}.x) / 2", y=f"{w} * ({s}.y1 + {s}.y2 - 2 * {o}.y) / 2"
                ),
            )

        by_length = _weighted(each("transform", segments(g), edge))
        by_count = _weighted(
            each("transform", vertices(g), lambda v: struct(w="1.0D", x=f"{v}.x - {o}.x", y=f"{v}.y - {o}.y"))
        )

        def centre(moments: str) -> str:
            return let(
                moments,
                lambda m: case((f"{m}.w != 0", xy(f"{o}.x + {m}.x / {m}.w", f"{o}.y + {m}.y / {m}.w"))),
            )

        return (
            f"coalesce({case((f'{family(g)} = 2', centre(by_area)))}, "
            f"{case((f'{family(g)} >= 1', centre(by_length)))}, {centre(by_count)})"
        )

    return case((f"size({vertices(g)}) > 0", let(single_point(g), in_frame)))


def orient(g: str, ccw: bool = True) -> str:
    """Shells counter-clockwise and holes clockwise (``ccw=False``: the other way round)."""
    shell = "=" if ccw else "!="

    def fix(ring: str, i: str) -> str:
        return f"if(({ring_area(ring)} > 0) = ({i} {shell} 0), {ring}, reverse({ring}))"

    turned = each("transform", f"{g}.parts", lambda part: each_with_index("transform", part, fix))
    return case((f"{family(g)} = 2", make_geom(f"{g}.type", turned)), (f"{g}.type is not null", g))


def drop_repeats(ring: str) -> str:
    """Remove vertices equal to the one before."""

    def keep(r: str) -> str:
        def differs(v: str, i: str) -> str:
            before = f"get({r}, {i} - 1)"
            return f"({i} = 0 or {v}.x != {before}.x or {v}.y != {before}.y)"

        return each_with_index("filter", r, differs)

    return let(ring, keep)

"""Geometry column: one nested-array layout for every geometry type.

``geom`` is ``struct<type, parts: array<rings: array<points: array<struct<x,y>>>>>``.  A point is
``[[[p]]]``, a line ``[[[p1..pn]]]``, a polygon ``[[shell, hole...]]`` and a multi-geometry has
several parts.  One depth for every type lets higher-order functions work on all of them without
leaving the JVM, and a point built from two columns folds back to those two columns in Catalyst.

Arguments and results are SQL text, see :mod:`geoflow.functions.sql`.
"""

from __future__ import annotations

from collections.abc import Callable

from .sql import case, each, fresh, let, struct, text

XY_DDL = "struct<x:double,y:double>"
PARTS_DDL = f"array<array<array<{XY_DDL}>>>"
GEOM_DDL = f"struct<type:string,parts:{PARTS_DDL}>"

POINT, LINE, POLYGON = "Point", "LineString", "Polygon"
MULTI = {POINT: "MultiPoint", LINE: "MultiLineString", POLYGON: "MultiPolygon"}


def xy(x: str, y: str) -> str:
    return struct(x=x, y=y)


def make_geom(type_: str, parts: str) -> str:
    """Geometry from the SQL text of its type and parts."""
    return struct(type=type_, parts=parts)


def point(x: str, y: str) -> str:
    """Point from two finite doubles; folds back to them when only coordinates are asked for."""
    return make_geom(text(POINT), f"array(array(array({xy(x, y)})))")


def is_finite(x: str) -> str:
    return f"({x} is not null and not isnan({x}) and abs({x}) < double('infinity'))"


def point_or_null(x: str, y: str) -> str:
    return case((f"{is_finite(x)} and {is_finite(y)}", point(x, y)))


def line(points: str | list[str]) -> str:
    pts = points if isinstance(points, str) else f"array({', '.join(points)})"
    return make_geom(text(LINE), f"array(array({pts}))")


def polygon(rings_: str) -> str:
    """Polygon from an array of closed rings, the shell first."""
    return make_geom(text(POLYGON), f"array({rings_})")


def rectangle(xmin: str, ymin: str, xmax: str, ymax: str) -> str:
    corners = [xy(xmin, ymin), xy(xmax, ymin), xy(xmax, ymax), xy(xmin, ymax), xy(xmin, ymin)]
    return polygon(f"array(array({', '.join(corners)}))")


def null_geom() -> str:
    return f"cast(null as {GEOM_DDL})"


# --- accessors -----------------------------------------------------------------------------


def family(g: str) -> str:
    """0 for points, 1 for lines, 2 for areas."""
    return case((f"endswith({g}.type, 'Polygon')", "2"), (f"endswith({g}.type, 'LineString')", "1"), default="0")


def only_family(g: str, number: int, operator: str) -> str:
    """Whether a geometry is of the family; false for none, and an error for other families, so that none is left out unseen."""
    wanted = ("points", "lines", "areas")[number]
    return case(
        (f"{g}.type is null", "false"),
        (f"{family(g)} = {number}", "true"),
        default=f"raise_error(concat('{operator} takes {wanted} only, the layer holds a ', {g}.type))",
    )


def single_point(g: str) -> str:
    """The coordinate of a point geometry (first vertex of any other)."""
    return f"get(get(get({g}.parts, 0), 0), 0)"


def only_point(g: str) -> str:
    """The coordinate in a layer marked as points; fails on other geometries, for instance after a union.

    The check folds away where the points are built in the same plan.
    """
    return case(
        (f"{g}.type = '{POINT}'", single_point(g)),
        (f"{g}.type is null", "null"),
        default="raise_error('the layer is marked as points but holds other geometries')",
    )


def rings(g: str) -> str:
    return f"flatten({g}.parts)"


def vertices(g: str) -> str:
    return f"flatten(flatten({g}.parts))"


def segment(x1: str, y1: str, x2: str, y2: str, **more: str) -> str:
    return struct(x1=x1, y1=y1, x2=x2, y2=y2, **more)


def ring_segments(ring: str) -> str:
    """Consecutive vertex pairs of one vertex sequence."""
    p, q = fresh("p"), fresh("q")
    n = f"greatest(size({ring}) - 1, 0)"
    pair = segment(f"{p}.x", f"{p}.y", f"{q}.x", f"{q}.y")
    return f"zip_with(slice({ring}, 1, {n}), slice({ring}, 2, {n}), ({p}, {q}) -> {pair})"


def segments(g: str) -> str:
    """Every edge of the geometry as ``struct<x1,y1,x2,y2>``; empty for points."""
    return f"flatten({each('transform', rings(g), ring_segments, 'r')})"


def proper_segments(g: str) -> str:
    """The edges that have a length."""
    return each("filter", segments(g), lambda s: f"({s}.x1 != {s}.x2 or {s}.y1 != {s}.y2)")


def map_rings(g: str, step: Callable[[str], str]) -> str:
    moved = each("transform", f"{g}.parts", lambda part: each("transform", part, step, "r"), "part")
    return case((f"{g}.type is not null", make_geom(f"{g}.type", moved)))


def map_vertices(g: str, steps: list[Callable[[str], str]], points: bool = False) -> str:
    """Apply each step to every vertex; the last step must return ``struct<x,y>``.

    ``points`` promises that every geometry is a single point, which keeps the arithmetic in
    generated code.
    """
    if points:
        moved = only_point(g)
        for step in steps:
            moved = let(moved, step) if step is not steps[0] else step(moved)
        return case((f"{g}.type is not null", make_geom(text(POINT), f"array(array(array({moved})))")))

    def on_ring(ring: str) -> str:
        for step in steps:
            ring = each("transform", ring, step, "p")
        return ring

    return map_rings(g, on_ring)


# --- bounding boxes ------------------------------------------------------------------------


def bbox(g: str) -> str:
    """``struct<xmin,ymin,xmax,ymax>``; null for a null geometry."""

    def of_vertices(vs: str) -> str:
        xs = each("transform", vs, lambda v: f"{v}.x")
        ys = each("transform", vs, lambda v: f"{v}.y")
        return struct(
            xmin=f"array_min({xs})", ymin=f"array_min({ys})", xmax=f"array_max({xs})", ymax=f"array_max({ys})"
        )

    return case((f"size({vertices(g)}) > 0", let(vertices(g), of_vertices)))


def point_box(g: str) -> str:
    """Box of a single point, in a layer marked as points."""
    p = only_point(g)
    return struct(xmin=f"{p}.x", ymin=f"{p}.y", xmax=f"{p}.x", ymax=f"{p}.y")


def is_box(g: str) -> str:
    """Is the geometry a single axis-parallel rectangle?"""

    def check(r: str) -> str:
        p = [f"get({r}, {i})" for i in range(5)]

        def same(axis: str, i: int, j: int) -> str:
            return f"{p[i]}.{axis} = {p[j]}.{axis}"

        upright = " and ".join([same("x", 0, 1), same("y", 1, 2), same("x", 2, 3), same("y", 3, 4)])
        flat = " and ".join([same("y", 0, 1), same("x", 1, 2), same("y", 2, 3), same("x", 3, 4)])
        closed = f"{same('x', 0, 4)} and {same('y', 0, 4)} and {p[0]}.x != {p[2]}.x and {p[0]}.y != {p[2]}.y"
        return f"(size({r}) = 5 and {closed} and ({upright} or {flat}))"

    ring = f"get(get({g}.parts, 0), 0)"
    return f"({g}.type = '{POLYGON}' and size(get({g}.parts, 0)) = 1 and {let(ring, check)})"


def vertex_count(g: str) -> str:
    return case((f"{g}.type is not null", f"size({vertices(g)})"))


# --- text forms ----------------------------------------------------------------------------


def to_wkt(g: str, digits: int = 6) -> str:
    """Well-known text with coordinates rounded to ``digits`` decimals."""

    def number(c: str) -> str:
        # + 0 turns a rounded negative zero into zero
        return f"format_string('%.{digits}f', round({c}, {digits}) + 0.0D)"

    def listed(items: str) -> str:
        return f"concat('(', array_join({items}, ', '), ')')"

    def seq(ring: str) -> str:
        return listed(each("transform", ring, lambda p: f"concat({number(p + '.x')}, ' ', {number(p + '.y')})"))

    ring_texts = each("transform", rings(g), seq)
    part_texts = each("transform", f"{g}.parts", lambda part: listed(each("transform", part, seq)))
    body = case(
        (f"{g}.type in ('{POINT}', '{LINE}')", f"get({ring_texts}, 0)"),
        (f"{g}.type = '{POLYGON}'", f"get({part_texts}, 0)"),
        (f"{g}.type in ('{MULTI[POINT]}', '{MULTI[LINE]}')", listed(ring_texts)),
        default=listed(part_texts),
    )
    return case((f"{g}.type is not null", f"concat(upper({g}.type), ' ', {body})"))


def to_geojson(g: str) -> str:
    """GeoJSON geometry object as text; the JSON text ``null`` for a missing geometry."""

    def pair(p: str) -> str:
        return f"array({p}.x, {p}.y)"

    def seq(ring: str) -> str:
        return each("transform", ring, pair)

    def obj(coords: str) -> str:
        return f"to_json({struct(type=f'{g}.type', coordinates=coords)})"

    first = f"get({g}.parts, 0)"
    body = case(
        (f"{g}.type = '{POINT}'", obj(pair(single_point(g)))),
        (f"{g}.type = '{LINE}'", obj(seq(f"get({first}, 0)"))),
        (f"{g}.type = '{POLYGON}'", obj(each("transform", first, seq))),
        (
            f"{g}.type = '{MULTI[POINT]}'",
            obj(each("transform", f"{g}.parts", lambda part: pair(f"get(get({part}, 0), 0)"))),
        ),
        (
            f"{g}.type = '{MULTI[LINE]}'",
            obj(each("transform", f"{g}.parts", lambda part: seq(f"get({part}, 0)"))),
        ),
        (
            f"{g}.type = '{MULTI[POLYGON]}'",
            obj(each("transform", f"{g}.parts", lambda part: each("transform", part, seq))),
        ),
    )
    return f"coalesce({body}, 'null')"


def from_geojson(type_: str, coordinates: str) -> str:
    """Geometry from a GeoJSON type name and the raw JSON text of its coordinates.

    Unknown types and coordinates that do not parse give null.
    """

    def p(c: str) -> str:
        return xy(f"get({c}, 0)", f"get({c}, 1)")

    def seq(c: str) -> str:
        return each("transform", c, p)

    def parsed(depth: int) -> str:
        ddl = "array<" * depth + "double" + ">" * depth
        return f"from_json({coordinates}, '{ddl}')"

    parts = case(
        (f"{type_} = '{POINT}'", let(parsed(1), lambda c: f"array(array(array({p(c)})))")),
        (f"{type_} = '{LINE}'", f"array(array({seq(parsed(2))}))"),
        (f"{type_} = '{POLYGON}'", f"array({each('transform', parsed(3), seq)})"),
        (f"{type_} = '{MULTI[POINT]}'", each("transform", parsed(2), lambda c: f"array(array({p(c)}))")),
        (f"{type_} = '{MULTI[LINE]}'", each("transform", parsed(3), lambda c: f"array({seq(c)})")),
        (f"{type_} = '{MULTI[POLYGON]}'", each("transform", parsed(4), lambda c: each("transform", c, seq))),
    )

    def whole(ps: str) -> str:
        broken = each("exists", f"flatten(flatten({ps}))", lambda v: f"({v}.x is null or {v}.y is null)")
        return case((f"{ps} is not null and size(flatten(flatten({ps}))) > 0 and not {broken}", make_geom(type_, ps)))

    return let(parts, whole)



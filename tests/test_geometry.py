"""Measures, text forms and edits on hand-made geometries."""

import json
import math

import pytest
from pyspark.sql import functions as F

import shapes as S
from geoflow.functions import geometry as G
from geoflow.functions import measures as M
from geoflow.operators import edit


def value(spark, geom, expression):
    return S.layer(spark, [geom]).select(F.expr(expression).alias("v")).first().v


def test_area_length_centroid(spark):
    with_hole = S.polygon(S.SQUARE, S.HOLE)
    assert value(spark, with_hole, M.area("geom")) == pytest.approx(96)
    assert value(spark, with_hole, M.length("geom")) == pytest.approx(48)
    assert value(spark, S.polygon(S.C_SHAPE), M.area("geom")) == pytest.approx(52)
    c = value(spark, S.polygon(S.C_SHAPE), M.centroid_xy("geom"))
    assert (c.x, c.y) == pytest.approx(((20 * 5 * 2 + 12 * 1) / 52, 5))
    two = S.multipolygon([S.SQUARE], [[(20, 0), (22, 0), (22, 2), (20, 2), (20, 0)]])
    assert value(spark, two, M.area("geom")) == pytest.approx(104)
    c = value(spark, two, M.centroid_xy("geom"))
    assert (c.x, c.y) == pytest.approx(((100 * 5 + 4 * 21) / 104, (100 * 5 + 4 * 1) / 104))
    flat = S.polygon([(0, 0), (4, 0), (0, 0), (0, 0)])
    assert value(spark, flat, M.centroid_xy("geom")).x == pytest.approx(2)


def test_null_and_empty(spark):
    df = S.layer(spark, [None, S.point(1, 2)])
    row = df.selectExpr(f"{M.area('geom')} a", f"{G.to_wkt('geom')} w", f"{G.bbox('geom')} b", "id").where("id = 0").first()
    assert row.a is None and row.w is None and row.b is None
    assert edit.centroid(df.limit(0)).count() == 0


def test_text_forms(spark):
    assert value(spark, S.polygon(S.SQUARE, S.HOLE), G.to_wkt("geom", 0)).startswith("POLYGON ((0 0, 10 0")
    assert value(spark, S.multipoint((1, 2), (-0.0, 4)), G.to_wkt("geom", 1)) == "MULTIPOINT ((1.0 2.0), (0.0 4.0))"
    for geom in (S.point(1.5, 2), S.line((0, 0), (1, 2)), S.polygon(S.SQUARE, S.HOLE), S.multipoint((1, 2), (3, 4)),
                 S.multipolygon([S.SQUARE], [S.HOLE[::-1]])):
        text = value(spark, geom, G.to_geojson("geom"))
        parsed = json.loads(text)
        assert parsed["type"] == geom["type"]
        back = spark.createDataFrame([(parsed["type"], json.dumps(parsed["coordinates"]))], "t string, c string").selectExpr(
            f"{G.from_geojson('t', 'c')} g"
        )
        assert back.first().g.asDict(recursive=True) == geom


def test_orient_and_snap(spark):
    clockwise = S.polygon(S.SQUARE[::-1], S.HOLE[::-1])
    rings = edit.orient(S.layer(spark, [clockwise])).selectExpr(
        f"transform(geom.parts[0], r -> {M.ring_area('r')}) a"
    ).first().a
    assert rings == [100.0, -4.0]
    snapped = edit.snap_to_grid(S.layer(spark, [S.line((0.1, 0.1), (0.2, 0.05), (0.74, 0.5), (1.25, -0.25))]), 0.5)
    assert snapped.selectExpr(G.to_wkt("geom", 1)).first()[0] == "LINESTRING (0.0 0.0, 0.5 0.5, 1.5 0.0)"


def test_densify(spark):
    dense = edit.densify(S.layer(spark, [S.line((0, 0), (10, 0), (10, 1))]), 4.0)
    assert dense.selectExpr(f"{G.to_wkt('geom', 2)} w").first().w == (
        "LINESTRING (0.00 0.00, 3.33 0.00, 6.67 0.00, 10.00 0.00, 10.00 1.00)"
    )


def textbook(points, tolerance):
    if len(points) < 3:
        return points
    (ax, ay), (bx, by) = points[0], points[-1]

    def away(p):
        dx, dy = bx - ax, by - ay
        t = max(0, min(1, ((p[0] - ax) * dx + (p[1] - ay) * dy) / (dx * dx + dy * dy))) if dx or dy else 0
        return math.hypot(p[0] - ax - t * dx, p[1] - ay - t * dy)

    far = max(range(1, len(points) - 1), key=lambda i: away(points[i]))
    if away(points[far]) <= tolerance:
        return [points[0], points[-1]]
    return textbook(points[: far + 1], tolerance)[:-1] + textbook(points[far:], tolerance)


def test_simplify_like_the_textbook(spark):
    lines = [[(i, ((k * i * 7) % 11) / 10) for i in range(40)] for k in range(1, 20)]
    simple = edit.simplify(S.layer(spark, [S.line(*p) for p in lines]), 0.45).orderBy("id").collect()
    for row, points in zip(simple, lines, strict=True):
        assert [(p.x, p.y) for p in row.geom.parts[0][0]] == textbook(points, 0.45)
    ring = S.polygon(S.SQUARE, S.HOLE)
    kept = edit.simplify(S.layer(spark, [ring]), 100.0).first().geom
    assert [len(r) for r in kept.parts[0]] == [5, 5]


def test_validate(spark):
    cases = {
        "fine": (S.polygon(S.SQUARE, S.HOLE), None),
        "bow-tie": (S.polygon([(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]), "self crossing"),
        "open": (S.polygon([(0, 0), (1, 0), (1, 1), (0, 1)]), "unclosed ring"),
        "repeat": (S.polygon([(0, 0), (1, 0), (1, 0), (1, 1), (0, 1), (0, 0)]), "repeated vertex"),
        "nan": (S.point(float("nan"), 1), "bad coordinate"),
        "null": (None, "null geometry"),
        "spike": (S.polygon([(0, 0), (4, 0), (2, 0), (2, 2), (0, 0)]), "self crossing"),
        "clockwise": (S.polygon(S.SQUARE[::-1]), None),
    }
    df = S.layer(spark, {k: g for k, (g, _) in cases.items()})
    found = {r.id: r.problem for r in edit.validate(df).collect()}
    assert found == {k: p for k, (_, p) in cases.items()}
    repaired = {r.id: r for r in edit.validate(df, repair=True).selectExpr("*", f"{M.area('geom')} a").collect()}
    assert repaired["open"].a == 1 and repaired["open"].reject_reason is None
    assert repaired["repeat"].a == 1 and repaired["bow-tie"].reject_reason == "self crossing"

"""Predicates, overlay, dissolve, clip and buffer on hand-made cases and against JTS."""

import math
import random

import pytest
from pyspark.sql import functions as F

import shapes as S
from geoflow.functions import geometry as G
from geoflow.functions import measures as M
from geoflow.functions import predicates as P
from geoflow.operators import edges, nearest, spatial

CHECKED = [p for p in P.PREDICATES if p != "dwithin"]
JTS_NAMES = {"covered_by": "coveredBy"}


def holding(spark, a, b):
    pairs = S.layer(spark, [a]).selectExpr("geom a").crossJoin(S.layer(spark, [b]).selectExpr("geom b"))
    rel = P.relation(pairs, "a", "b").selectExpr(*[f"{P.HOLDS[p]} {p}" for p in CHECKED]).first().asDict()
    lean = P.intersection_test(pairs, "a", "b").first()["_hit"]
    assert lean == rel["intersects"]
    return {p for p, held in rel.items() if held}


CASES = [
    (S.box(0, 0, 1, 1), S.box(1, 0, 2, 1), {"intersects", "touches"}),
    (S.box(0, 0, 1, 1), S.box(1, 1, 2, 2), {"intersects", "touches"}),
    (S.box(0, 0, 4, 4), S.box(2, 2, 6, 6), {"intersects", "overlaps"}),
    (S.box(0, 0, 10, 10), S.box(2, 2, 3, 3), {"intersects", "contains", "covers", "contains_properly"}),
    (S.box(0, 0, 10, 10), S.box(0, 2, 3, 3), {"intersects", "contains", "covers"}),
    (S.point(5, 0), S.box(0, 0, 10, 10), {"intersects", "touches", "covered_by"}),
    (S.point(0, 0), S.box(0, 0, 10, 10), {"intersects", "touches", "covered_by"}),
    (S.point(5, 5), S.box(0, 0, 10, 10), {"intersects", "within", "covered_by"}),
    (S.line((0, 0), (10, 10)), S.line((0, 10), (10, 0)), {"intersects", "crosses"}),
    (S.line((0, 0), (5, 5)), S.line((5, 5), (10, 0)), {"intersects", "touches"}),
    (S.line((0, 0), (5, 0)), S.line((3, 0), (9, 0)), {"intersects", "overlaps"}),
    (S.line((-1, 5), (11, 5)), S.box(0, 0, 10, 10), {"intersects", "crosses"}),
    (S.line((0, 0), (10, 0)), S.box(0, 0, 10, 10), {"intersects", "touches", "covered_by"}),
    (S.line((1, 1), (9, 9)), S.box(0, 0, 10, 10), {"intersects", "within", "covered_by"}),
    (S.polygon(S.C_SHAPE), S.box(4, 3, 9, 7), set()),
    (S.polygon(S.SQUARE, S.HOLE), S.box(4.5, 4.5, 5.5, 5.5), set()),
    (S.polygon(S.SQUARE, S.HOLE), S.polygon(S.HOLE[::-1]), {"intersects", "touches"}),
    (S.polygon(S.SQUARE), S.polygon(S.SQUARE[::-1]), {"intersects", "within", "contains", "covers", "covered_by"}),
    (S.multipoint((5, 5), (50, 50)), S.box(0, 0, 10, 10), {"intersects", "crosses"}),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_hand_made(spark, case):
    a, b, expected = CASES[case]
    assert holding(spark, a, b) == expected


def star(rng, cx, cy, r, n, lattice=None):
    """A simple polygon: vertices by increasing angle around a centre."""
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    ring = [(cx + rng.uniform(0.3, 1) * r * math.cos(t), cy + rng.uniform(0.3, 1) * r * math.sin(t)) for t in angles]
    if lattice:
        ring = [(round(x / lattice) * lattice, round(y / lattice) * lattice) for x, y in ring]
    return S.polygon([*ring, ring[0]])


@pytest.fixture(scope="module")
def random_layers(spark):
    rng = random.Random(7)
    jts = S.Jts(spark)

    def valid(make):
        while True:
            g = make()
            if jts.read(g).isValid():
                return g

    def some(n, lattice):
        out = []
        for _ in range(n):
            if rng.random() < 0.3:
                pts = [(rng.uniform(0, 10), rng.uniform(0, 10)) for _ in range(rng.randint(2, 4))]
                pts = [(round(x), round(y)) for x, y in pts] if lattice else pts
                g = S.line(*pts)
                out.append(g if jts.read(g).isSimple() and jts.read(g).getLength() > 0 else S.line((0, 0), (1, 1)))
            else:
                out.append(valid(lambda: star(rng, rng.uniform(0, 10), rng.uniform(0, 10), 3, rng.randint(4, 9), lattice)))
        return out

    return some(40, None) + some(20, 1.0)


@pytest.mark.parametrize("strategy", ["broadcast_right", "shuffle"])
def test_predicates_like_jts(spark, random_layers, strategy):
    jts = S.Jts(spark)
    read = [jts.read(g) for g in random_layers]
    layer = S.layer(spark, random_layers)
    for predicate in CHECKED:
        if predicate == "contains_properly" or (strategy == "shuffle" and predicate != "within"):
            continue
        found = spatial.matching_pairs(layer, layer, "id", "id", predicate, strategy=strategy).select("_lid", "_rid")
        got = [tuple(r) for r in found.collect()]
        assert len(got) == len(set(got))
        name = JTS_NAMES.get(predicate, predicate)
        want = {(i, j) for i, a in enumerate(read) for j, b in enumerate(read) if getattr(a, name)(b)}
        assert set(got) == want, predicate


def test_overlay_like_jts(spark, random_layers):
    jts = S.Jts(spark)
    areas = [g for g in random_layers if g["type"] == "Polygon"]
    read = [jts.read(g) for g in areas]
    layer = S.layer(spark, areas)
    shapes = edges.overlay_areas(layer, layer, "id", "id", "_lid < _rid").selectExpr("_lid", "_rid", f"{M.area('geom')} a")
    sizes = edges.overlay_measures(layer, layer, "id", "id", "_lid < _rid")
    got = {(r._lid, r._rid): r.a for r in shapes.collect()}
    measured = {(r._lid, r._rid): r.area for r in sizes.collect()}
    for i, a in enumerate(read):
        for j in range(i + 1, len(read)):
            want = a.intersection(read[j]).getArea()
            assert got.get((i, j), 0) == pytest.approx(want, abs=1e-6)
            assert measured.get((i, j), 0) == pytest.approx(want, abs=1e-6)


def test_clip_splits_the_input(spark, random_layers):
    jts = S.Jts(spark)
    mask = S.layer(spark, [S.box(0, 0, 5, 5), S.box(5, 0, 10, 5), S.box(0, 5, 5, 12)])
    whole = jts.read(S.polygon([(0, 0), (10, 0), (10, 5), (5, 5), (5, 12), (0, 12), (0, 0)]))
    layer = S.layer(spark, random_layers)
    # lines are one row for each stretch
    parts = edges.clip(layer, mask, "id", "id").groupBy("id", "port").agg(F.expr(f"sum({M.area('geom')}) a"), F.expr(f"sum({M.length('geom')}) l"))
    got = {(r.id, r.port): r for r in parts.collect()}
    for i, g in enumerate(random_layers):
        shape = jts.read(g)
        inside, outside = shape.intersection(whole), shape.difference(whole)
        for port, want in (("inside", inside), ("outside", outside)):
            row = got.get((i, port))
            if g["type"] == "Polygon":
                assert (row.a if row else 0) == pytest.approx(want.getArea(), abs=1e-6)
            else:
                assert (row.l if row else 0) == pytest.approx(want.getLength(), abs=1e-6)


def test_dissolve_like_jts(spark, random_layers):
    jts = S.Jts(spark)
    areas = [g for g in random_layers if g["type"] == "Polygon"]
    layer = S.layer(spark, areas).withColumn("grp", F.expr("if(id % 3 = 0, null, id % 3)"))
    parts = edges.dissolve(layer, ["grp"], "id").selectExpr("grp", f"{M.area('geom')} a", f"{M.length('geom')} l").collect()
    sizes = {r.grp: r for r in edges.dissolve_measures(layer, ["grp"], "id").collect()}
    for grp in (None, 1, 2):
        union = None
        for i, g in enumerate(areas):
            if (i % 3 or None) == grp:
                shape = jts.read(g)
                union = shape if union is None else union.union(shape)
        mine = [r for r in parts if r.grp == grp]
        assert sum(r.a for r in mine) == pytest.approx(union.getArea(), abs=1e-6)
        assert sum(r.l for r in mine) == pytest.approx(union.getLength(), abs=1e-5)
        assert sizes[grp].area == pytest.approx(union.getArea(), abs=1e-6)


def test_dissolve_shared_edge_corner_and_hole(spark):
    ring = [S.box(0, 0, 3, 1), S.box(0, 2, 3, 3), S.box(0, 1, 1, 2), S.box(2, 1, 3, 2)]
    parts = edges.dissolve(S.layer(spark, ring).withColumn("g", F.lit(1)), ["g"], "id").collect()
    assert len(parts) == 1 and len(parts[0].geom.parts[0]) == 2
    corner = [S.box(0, 0, 1, 1), S.box(1, 1, 2, 2)]
    assert edges.dissolve(S.layer(spark, corner).withColumn("g", F.lit(1)), ["g"], "id").count() == 2


def test_split_lines(spark):
    cross = [S.line((0, 0), (10, 10)), S.line((0, 10), (10, 0)), S.line((20, 0), (21, 0))]
    pieces = edges.split_lines(S.layer(spark, cross), "id").selectExpr("id", f"{G.to_wkt('geom', 1)} w").collect()
    assert sorted((r.id, r.w) for r in pieces) == [
        (0, "LINESTRING (0.0 0.0, 5.0 5.0)"),
        (0, "LINESTRING (5.0 5.0, 10.0 10.0)"),
        (1, "LINESTRING (0.0 10.0, 5.0 5.0)"),
        (1, "LINESTRING (5.0 5.0, 10.0 0.0)"),
        (2, "LINESTRING (20.0 0.0, 21.0 0.0)"),
    ]


@pytest.mark.parametrize("other", [S.point(1, 1), S.multipoint((0, 0), (1, 1)), S.line((0, 0), (5, 5)), S.box(0, 0, 5, 5)])
def test_layers_of_mixed_families_lose_no_rows_unseen(spark, other):
    def raises(made, wanted):
        with pytest.raises(Exception, match=f"takes {wanted} only, the layer holds a {other['type']}"):
            made().collect()

    if other["type"] != "Polygon":
        areas = S.layer(spark, [S.box(0, 0, 3, 3), other, S.box(1, 1, 4, 4)]).withColumn("g", F.lit(1))
        plain = S.layer(spark, [S.box(0, 0, 3, 3)])
        raises(lambda: edges.dissolve(areas, ["g"], "id"), "areas")
        raises(lambda: edges.dissolve_measures(areas, ["g"], "id"), "areas")
        raises(lambda: edges.overlay_areas(areas, plain, "id", "id"), "areas")
        raises(lambda: edges.overlay_measures(plain, areas, "id", "id"), "areas")
    if other["type"] != "LineString":
        raises(lambda: edges.split_lines(S.layer(spark, [S.line((0, 0), (4, 4)), other]), "id"), "lines")


def test_null_geometries_have_no_part(spark):
    areas = S.layer(spark, [S.box(0, 0, 3, 3), None, S.box(1, 1, 4, 4)]).withColumn("g", F.lit(1))
    assert edges.dissolve(areas, ["g"], "id").count() == 1 and edges.overlay_areas(areas, areas, "id", "id", "_lid < _rid").count() == 1
    assert edges.split_lines(S.layer(spark, [S.line((0, 0), (4, 4)), None]), "id").count() == 1
    places = S.layer(spark, [S.point(0, 0), None])
    assert nearest.neighbors(places, places.withColumnRenamed("id", "cid"), "id", "cid").count() == 1


def test_buffer_like_jts(spark):
    jts = S.Jts(spark)
    geoms = [S.point(0, 0), S.line((0, 0), (4, 0), (4, 3)), S.polygon(S.SQUARE, S.HOLE), S.polygon(S.C_SHAPE),
             S.multipoint((0, 0), (0.5, 0), (9, 9)), None]
    grown = edges.buffer(S.layer(spark, geoms), 0.5, "id").selectExpr("id", f"{M.area('geom')} a").orderBy("id").collect()
    assert grown[-1].a is None
    for row, g in zip(grown[:-1], geoms, strict=False):
        want = jts.read(g).buffer(0.5, 16).getArea()
        assert row.a == pytest.approx(want, rel=2e-3)


def test_buffer_in_metres(spark):
    lyon = S.layer(spark, [S.point(4.835659, 45.764043)])
    ring = edges.buffer(lyon, 0.3, "id", unit="km")
    assert ring.schema["geom"].metadata["srid"] == 4326
    box = ring.selectExpr(f"{G.bbox('geom')} b").first().b
    assert (box.ymax - box.ymin) / 2 * 111_150 == pytest.approx(300, rel=0.02)

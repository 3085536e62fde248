"""Joins by location: the quick tests say what the general ones say, and pairs are not dealt out again."""

import random

import pytest
from pyspark.sql import functions as F

import shapes as S
from geoflow.functions import predicates as P
from geoflow.operators import spatial
from geoflow.operators.spatial import point_layer


def first_line(plan, word):
    lines = plan.splitlines()
    return next((i for i, line in enumerate(lines) if word in line), len(lines))


@pytest.mark.parametrize("predicate", ["intersects", "crosses", "within"])
def test_pairs_are_not_shuffled(spark, predicate):
    """Only the inputs are dealt out: pairs can be far more than rows."""
    areas = S.layer(spark, [S.box(i, 0, i + 2, 2) for i in range(20)])
    lines = S.layer(spark, [S.line((i, 1), (i + 1.5, 3)) for i in range(20)])
    for left, right in ((areas, areas), (lines, areas)):
        plan = spatial.matching_pairs(left, right, "id", "id", predicate)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" in plan
        assert first_line(plan, "Join") < first_line(plan, "Repartition")


def test_kept_sides_do_not_shuffle_pairs(spark):
    """The pairs of a left join are not joined with the left side again, of 200 x 200 pairs only rows without one are."""
    sites = point_layer(spark.range(200).selectExpr("id", "0.5D x", "0.5D y"), "x", "y")
    areas = S.layer(spark, [S.box(0, 0, 1, 1)] * 200)
    for how in ("left", "right"):
        joined = spatial.spatial_join(sites, areas, "id", "id", how=how)
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert "Join LeftOuter" not in plan and "Join LeftAnti" in plan and "Join LeftSemi" in plan
        assert joined.count() == 200 * 200


@pytest.mark.parametrize("how", ["left", "right"])
def test_rows_without_a_pair_are_kept(spark, how):
    """Null geometries, repeated rows and null ids come out as often as they went in."""
    shapes = [S.box(0, 0, 1, 1), S.box(0, 0, 1, 1), None, None, S.box(9, 9, 10, 10), S.box(0.5, 0.5, 2, 2)]
    one = S.layer(spark, shapes).selectExpr("nullif(id % 2, 0) a", "geom")
    two = S.layer(spark, [S.box(0.2, 0.2, 0.4, 0.4), None, S.box(0.1, 0.1, 3, 3)]).selectExpr("id b", "geom")
    left, right = (one, two) if how == "left" else (two, one)
    rows = spatial.spatial_join(left, right, left.columns[0], right.columns[0], how=how).selectExpr("a", "b", "geom.type t").collect()
    box = "Polygon"
    want = [(None, 0, box), (None, 2, box), (1, 0, box), (1, 2, box), (None, None, None), (1, None, None), (None, None, box), (1, 2, box)]
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))


def shapes_of(rng):
    """Shapes on a coarse lattice, so that many touch, and some a hair away from it."""
    def c():
        return rng.randint(0, 6) + rng.choice([0, 0, 0, 1e-13, -1e-13, 1e-10, 0.3])
    def quad():
        x, y, r = c(), c(), rng.choice([1, 2, 0.5])
        return S.polygon([(x + r, y), (x, y + r), (x - r, y), (x, y - r), (x + r, y)][:: rng.choice([1, -1])])
    made = []
    for _ in range(25):
        x, y = c(), c()
        made += [
            S.box(x, y, x + rng.choice([1, 2, 3]), y + rng.choice([1, 2])), S.line((c(), c()), (c() + 7, c())), S.line((x, c()), (x, c() + 7)),
            quad(), S.polygon([(x, y), (x + 2, y), (x, y + 3), (x, y)]),
        ]
    return made


def test_quick_tests_agree(spark):
    rng = random.Random(11)
    one, two = shapes_of(rng), shapes_of(rng)
    names = sorted(set(P.PREDICATES) - {"dwithin"})
    def rows(shapes, p):
        return spatial.plain_shapes(S.layer(spark, shapes).selectExpr(f"id _{p}id", f"geom _{p}g"), p)
    pairs = rows(one, "l").crossJoin(rows(two, "r")).repartition(8).selectExpr("*", "null no")
    found = pairs.selectExpr(
        "_lid", "_rid",
        f"explode(array({P.intersection_hit('_lg', '_rg', '_lbox', '_rbox', '_ledge', '_redge', '_lquad', '_rquad')})) hit",
        *[f"{P.relation_test(n, '_lg', '_rg', '_lbox', '_rbox', '_ledge', '_redge')} {n}" for n in ("intersects", "crosses", "within", "covered_by", "touches")],
        f"{P.relation_test('covers', '_lg', '_rg', '_lbox', '_rbox', '_ledge', '_redge')} covers",
    )
    plain = P.relation(pairs.select("_lid", "_rid", "_lg", "_rg", F.lit(1).alias("one")), "_lg", "_rg").selectExpr(
        "_lid l", "_rid r", *[f"{P.HOLDS[n]} g_{n}" for n in names]
    )
    both = found.join(plain, (F.col("_lid") == F.col("l")) & (F.col("_rid") == F.col("r"))).collect()
    assert len(both) == len(one) * len(two)
    for row in both:
        got = [row.hit, *[row[n] for n in ("intersects", "crosses", "within", "covered_by", "touches", "covers")]]
        want = [row.g_intersects, *[row[f"g_{n}"] for n in ("intersects", "crosses", "within", "covered_by", "touches", "covers")]]
        assert got == want, (one[row.l], two[row.r])


def test_points_by_boxes(spark):
    edge = [0.0, 1.0, 0.5, 1e-13, -1e-13, 5e-12, -5e-12, 1 - 1e-13, 1 + 1e-13, 1.5]
    points = [(x, y) for x in edge for y in edge]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, x double, y double").selectExpr("*", "named_struct('x', x, 'y', y) p")
    area = S.layer(spark, [S.box(0, 0, 1, 1)]).selectExpr("geom g")
    pairs = rows.crossJoin(area).selectExpr("*", f"{P.plain_box('g')} b")
    for n in ("intersects", "within", "covered_by", "touches"):
        differ = pairs.where(f"({P.point_holds(n, 'p', 'g', 'b')}) != ({P.point_holds(n, 'p', 'g')})")
        assert differ.count() == 0, n


def test_gap_of_an_edge_and_a_box(spark):
    """The very numbers of the general way, so that equal distances stay equal."""
    rng = random.Random(4)
    made = [(S.line((rng.uniform(3, 9), rng.uniform(-5, 9)), (rng.uniform(3, 9), rng.uniform(-5, 9))), S.box(0, 0, rng.uniform(1, 2.9), rng.uniform(1, 3))) for _ in range(300)]
    made += [(S.line((4, i), (4, i + 1)), S.box(0, 0, 3, 3)) for i in range(-3, 5)]
    pairs = S.layer(spark, [a for a, _ in made]).selectExpr("id", "geom a").join(S.layer(spark, [b for _, b in made]).selectExpr("id", "geom b"), "id")
    found = pairs.selectExpr("*", f"{P.plain_edge('a')} e").selectExpr(f"{P.edge_box_gap('e', 'b')} quick", f"{P.gap('a', 'b')} general")
    assert found.where("quick = general").count() == len(made)


def test_neighbors_do_not_deal_out_pairs(spark):
    from geoflow.operators import nearest

    lines = S.layer(spark, [S.line((i, 0), (i + 1, 2)) for i in range(6)], "a")
    areas = S.layer(spark, [S.box(i, 3, i + 1, 4) for i in range(6)], "b")
    found = nearest.neighbors(lines, areas, "a", "b", 2)
    lines_of_plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    d = next(i for i, line in enumerate(lines_of_plan) if "Generate explode" in line)
    join = next(i for i, line in enumerate(lines_of_plan) if i > d and "Join" in line)
    assert not any("Repartition" in line for line in lines_of_plan[:join])
    assert {(r.a, r.b, r.distance) for r in found.where("rank = 1").collect()} == {(i, min(i, 5), 1.0) for i in range(6)}

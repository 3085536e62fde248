"""Overlay and split: pairs are not dealt out, segments meet in generated code, places are sorted once."""

import random

from pyspark.sql import functions as F

import shapes as S
from geoflow.functions import measures as M
from geoflow.functions import predicates as P
from geoflow.operators import edges
from geoflow.operators.gridjoin import estimated_bytes


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_overlay_pairs_are_not_shuffled(spark):
    areas = S.layer(spark, [S.box(i, 0, i + 2, 2) for i in range(8)] + [S.polygon([(0, 0), (3, 1), (1, 3), (0, 0)])])
    pairs = edges.overlay_areas(areas, areas, "id", "id", "_lid < _rid")
    lines = optimized(pairs).splitlines()
    joins = [i for i, line in enumerate(lines) if "Join Inner" in line]
    assert len(joins) == 3 and not any("Repartition" in line for line in lines[: joins[0]])
    # neither rings nor Python for two rectangles
    assert "ArrowEvalPython" not in "".join(lines[: joins[0]])
    sizes = {(r._lid, r._rid): round(r.a, 9) for r in pairs.selectExpr("_lid", "_rid", f"{M.area('geom')} a").collect()}
    assert {p: a for p, a in sizes.items() if p[1] < 8} == {(i, i + 1): 2.0 for i in range(7)}
    # boxes with the triangle, which is last
    assert {p for p in sizes if p[1] == 8} == {(0, 8), (1, 8), (2, 8)} and round(sum(sizes[i, 8] for i in (0, 2)), 6) == round(sizes[0, 8] + sizes[2, 8], 6)


def test_segments_meet_in_generated_code(spark):
    segments = spark.range(30).selectExpr("id _row", "double(id % 7) x1", "double(id % 5) y1", "double(id % 3) + 4 x2", "double(id % 4) y2")
    plan = optimized(edges.meetings(segments, segments, ["_row"], "l__row != r__row", most=True)).splitlines()
    above = plan[: next(i for i, line in enumerate(plan) if "Join Inner" in line)]
    assert above and not any("lambdafunction" in line for line in above)
    # the start of a line is a place like the others: no join finds the first piece
    split = optimized(edges.split_lines(S.layer(spark, [S.line((0, 0), (2, 2)), S.line((0, 2), (2, 0))]), "id"))
    assert "Join LeftOuter" not in split


def test_meeting_steps_are_meeting_params(spark):
    rng = random.Random(9)
    def c():
        return float(rng.randint(0, 4)) + rng.choice([0, 0, 1e-13, 1e-10, 0.25])
    rows = [(i, *(c() for _ in range(8))) for i in range(2000)] + [(i, 0.0, c(), 4.0, *(c() for _ in range(5))) for i in range(2000, 2100)]
    rows += [(i, 0.0, 0.0, 4.0, 2.0, 2 * t, t, 2 * u, u) for i in range(2100, 2200) for t, u in [(c(), c())]]
    pairs = spark.createDataFrame(rows, "i int, l_x1 double, l_y1 double, l_x2 double, l_y2 double, r_x1 double, r_y1 double, r_x2 double, r_y2 double")
    segment = {p: f"named_struct({', '.join(f'{chr(39)}{n}{chr(39)}, {p}_{n}' for n in ('x1', 'y1', 'x2', 'y2'))})" for p in "lr"}
    old = pairs.selectExpr("i", f"get(transform(array({segment['l']}), s -> {P.meeting_params('s', 'array(' + segment['r'] + ')')}), 0) want")
    new = pairs
    for step in P.meeting_steps("l_", "r_"):
        new = new.selectExpr("*", *[f"{v} {n}" for n, v in step.items()])
    both = new.selectExpr("i", "array_sort(filter(array(_ta, _tb), t -> t is not null)) got").join(old, "i")
    assert both.where("size(want) > 0").count() > 400 and both.where("size(want) = 2").count() > 5
    assert both.where(F.col("got") != F.col("want")).count() == 0


def test_measures_of_short_rings(spark):
    """The sums without lambdas are those of the parts, in the same order."""
    rng = random.Random(2)
    made = []
    for _ in range(200):
        v = [(rng.uniform(-9, 9), rng.uniform(-9, 9)) for _ in range(4)]
        made += [S.polygon([*v, v[0]]), S.line(*v[:2])]
    layer = S.layer(spark, made)
    ring = layer.where("geom.type = 'Polygon'").selectExpr(f"{M.area('geom')} a", f"abs({M.ring_area('geom.parts[0][0]')}) b")
    assert ring.where("a != b").count() == 0
    twice = layer.selectExpr("geom", "named_struct('type', concat('Multi', geom.type), 'parts', concat(geom.parts, geom.parts)) two")
    lengths = twice.selectExpr(f"{M.length('geom')} a", f"{M.length('two')} b").where("abs(2 * a - b) > 1e-12 * b")
    assert lengths.count() == 0


def test_edges_are_not_broadcast_by_file_sizes(spark, monkeypatch):
    """Estimates of edges are those of the files their areas came from, far too low to broadcast by."""
    guarded, seen = edges.guarded, []
    monkeypatch.setattr(edges, "guarded", lambda side: seen.append(side) or guarded(side))
    box = "named_struct('type', 'Polygon', 'parts', array(array(array({}))))".format(
        ", ".join(f"named_struct('x', double({x}), 'y', double({y}))" for x, y in (("id", 0), ("id + 1", 0), ("id + 1", 1), ("id", 1), ("id", 0)))
    )
    areas = spark.range(50).selectExpr("id", "id % 2 g", f"{box} geom")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        edges.union_edges(areas, ["g"])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(int(estimated_bytes(seen[0])) + 1))
        side = guarded(seen[0])
        plan = seen[0].withColumnRenamed("way", "w").join(side, "_row")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)

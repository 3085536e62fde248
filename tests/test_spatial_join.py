"""The cell join: every pair once, whatever the sizes, the skew and the strategy."""

import random

import pytest
from pyspark.sql import functions as F

import shapes as S
from geoflow.functions.crs import reproject, reproject_geom, SUPPORTED, check_srid
from geoflow.functions.geometry import single_point
from geoflow.functions import measures as M
from geoflow.operators import edges, gridjoin, lineage, nearest, spatial
from geoflow.operators.spatial import point_layer


def boxes(rng, n, biggest):
    out = []
    for _ in range(n):
        w = biggest ** rng.uniform(-1, 1)
        h = biggest ** rng.uniform(-1, 1)
        x, y = rng.uniform(-50, 50), rng.uniform(-50, 50)
        out.append((x, y, x + w, y + h))
    return out


def meeting(a, b):
    return a[0] <= b[2] and b[0] <= a[2] and a[1] <= b[3] and b[1] <= a[3]


@pytest.mark.parametrize("strategy", ["broadcast_left", "broadcast_right", "shuffle"])
def test_boxes_of_all_sizes(spark, strategy, monkeypatch):
    rng = random.Random(3)
    left, right = boxes(rng, 150, 30.0), boxes(rng, 150, 200.0)
    left += [(0.0, 0.0, 0.0, 0.0)] * 60  # a hot place
    # tiny limits make nearly every cell a hot one
    found = spatial.matching_pairs(
        S.layer(spark, [S.box(*b) for b in left]), S.layer(spark, [S.box(*b) for b in right]), "id", "id", strategy=strategy
    )
    got = [(r._lid, r._rid) for r in found.select("_lid", "_rid").collect()]
    want = {(i, j) for i, a in enumerate(left) for j, b in enumerate(right) if meeting(a, b) and a[0] < a[2]}
    assert len(got) == len(set(got))
    assert {p for p in got if left[p[0]][0] < left[p[0]][2]} == want


def test_hot_cells_split_both_sides(spark, monkeypatch):
    sites = point_layer(spark.range(300).selectExpr("id site", "0.5D + id % 3 x", "0.5D y"), "x", "y")
    plots = S.layer(spark, [S.box(0, 0, 3, 1)] * 40, "plot")
    joined = spatial.spatial_join(sites, plots, "site", "plot", "within", strategy="shuffle")
    assert joined.count() == 300 * 40
    assert joined.select("site", "plot").distinct().count() == 300 * 40


def test_join_types_and_suffixes(spark):
    points = point_layer(spark.createDataFrame([(1, 0.5, 0.5, "a"), (2, 9.0, 9.0, "b")], "id int, x double, y double, tag string"), "x", "y")
    areas = S.layer(spark, [S.box(0, 0, 1, 1), S.box(20, 20, 21, 21)])
    left = spatial.spatial_join(points, areas, "id", "id", how="left_outer").orderBy("id_left").collect()
    assert [(r.id_left, r.id_right, r.geom.type) for r in left] == [(1, 0, "Point"), (2, None, "Point")]
    right = spatial.spatial_join(points, areas, "id", "id", how="right").orderBy("id_right").collect()
    assert [(r.id_left, r.id_right, r.geom.type) for r in right] == [(1, 0, "Polygon"), (None, 1, "Polygon")]
    with pytest.raises(ValueError, match="unknown join type"):
        spatial.spatial_join(points, areas, "id", "id", how="outer")
    with pytest.raises(ValueError, match="unknown predicate"):
        spatial.spatial_join(points, areas, "id", "id", "near")
    with pytest.raises(ValueError, match="distance"):
        spatial.spatial_join(points, areas, "id", "id", "dwithin")


def test_dwithin_between_shapes(spark):
    lines = S.layer(spark, [S.line((0, 0), (10, 0)), S.line((0, 5), (10, 5))])
    areas = S.layer(spark, [S.box(3, 1, 4, 2), S.box(20, 20, 21, 21), S.box(3, -1, 4, 1)])
    near = spatial.matching_pairs(lines, areas, "id", "id", "dwithin", distance=3.0).select("_lid", "_rid").collect()
    assert sorted(map(tuple, near)) == [(0, 0), (0, 2), (1, 0)]


def test_null_geometries_do_not_match(spark):
    a = S.layer(spark, [None, S.box(0, 0, 1, 1)])
    assert spatial.matching_pairs(a, a, "id", "id").count() == 1
    related = {r.id: r.port for r in spatial.spatial_relate(a, a, "id", "id").collect()}
    assert related == {0: "unrelated", 1: "related"}


def test_right_side_is_reprojected(spark):
    area = S.layer(spark, [S.box(4, 45, 5, 46)])
    site = point_layer(spark.createDataFrame([(7, 4.8, 45.7)], "id int, x double, y double"), "x", "y")
    assert spatial.spatial_join(area, reproject(site, 2154), "id", "id", "contains").count() == 1


def test_mixed_layer_marked_as_points_fails(spark):
    points = point_layer(spark.createDataFrame([(1, 0.5, 0.5)], "id bigint, x double, y double"), "x", "y").select("id", "geom")
    mixed = points.union(S.layer(spark, [S.line((0, 0), (1, 1))]))
    areas = S.layer(spark, [S.box(0, 0, 1, 1)])
    with pytest.raises(Exception, match="marked as points"):
        spatial.matching_pairs(mixed, areas, "id", "id").collect()
    with pytest.raises(Exception, match="marked as points"):
        reproject(mixed, 2154).collect()


# --- projections ---------------------------------------------------------------------------


def moved(spark, x, y, source, target):
    df = S.layer(spark, [S.point(x, y)], srid=source).selectExpr(f"{reproject_geom('geom', source, target)} geom")
    p = df.selectExpr(f"{single_point('geom')} p").first().p
    return p.x, p.y


def test_projection_origins(spark):
    assert moved(spark, 3.0, 46.5, 4326, 2154) == pytest.approx((700000, 6600000), abs=1e-6)
    assert moved(spark, 3.0, 45.0, 4326, 3945) == pytest.approx((1700000, 4200000), abs=1e-6)
    assert moved(spark, 3.0, 46.0, 4326, 3946) == pytest.approx((1700000, 5200000), abs=1e-6)
    assert moved(spark, 3.0, 0.0, 4326, 32631) == pytest.approx((500000, 0), abs=1e-6)


def test_known_point(spark):
    lyon = (4.835659, 45.764043)
    assert moved(spark, *lyon, 4326, 2154) == pytest.approx((842663.362, 6519929.067), abs=1e-3)
    assert moved(spark, *lyon, 4326, 3945) == pytest.approx((1842787.671, 4286527.918), abs=1e-3)
    assert moved(spark, *lyon, 4326, 3946) == pytest.approx((1842775.811, 5175421.132), abs=1e-3)


def test_there_and_back(spark):
    for code in SUPPORTED:
        there = moved(spark, 5.1, 44.9, 4326, code)
        assert moved(spark, *there, code, 4326) == pytest.approx((5.1, 44.9), abs=1e-11), code
    with pytest.raises(ValueError, match="unsupported"):
        check_srid(27700)


# --- nearest -------------------------------------------------------------------------------


def brute(base, candidates, k, limit=float("inf")):
    out = set()
    for i, (x, y) in enumerate(base):
        ranked = sorted((((x - a) ** 2 + (y - b) ** 2) ** 0.5, j) for j, (a, b) in enumerate(candidates))
        out |= {(i, r + 1, j) for r, (d, j) in enumerate(ranked[:k]) if d <= limit}
    return out


@pytest.mark.parametrize("k,limit", [(1, None), (4, None), (3, 0.8)])
def test_neighbors_like_brute_force(spark, monkeypatch, k, limit):
    rng = random.Random(11)
    monkeypatch.setattr(nearest, "LEAF_POINTS", 8)
    monkeypatch.setattr(nearest, "SPLIT", 3)
    # a third in one place, a dense city, the rest anywhere
    places = [(2.0, 2.0)] * 60 + [(5 + rng.gauss(0, 0.01), 5 + rng.gauss(0, 0.01)) for _ in range(60)]
    places += [(rng.uniform(-10, 10), rng.uniform(-10, 10)) for _ in range(60)]
    base = [(rng.uniform(-12, 12), rng.uniform(-12, 12)) for _ in range(80)] + [(2.0, 2.0), (5.0, 5.0)]

    def points(rows):
        df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(rows)], "id bigint, x double, y double")
        return point_layer(df, "x", "y")

    found = nearest.neighbors(points(base), points(places).withColumnRenamed("id", "cid"), "id", "cid", k, limit)
    got = {(r.id, r["rank"], r.cid) for r in found.collect()}
    assert got == brute(base, places, k, limit if limit is not None else float("inf"))


def shapes_of_all_kinds(rng, n):
    """Points, lines, areas with holes, several of a kind, some of them alike, null and empty ones."""
    out = []
    for i in range(n):
        x, y, w = rng.uniform(-10, 10), rng.uniform(-10, 10), 10 ** rng.uniform(-2, 0.7)
        ring = [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]
        hole = [(x + 0.2 * w, y + 0.2 * w), (x + 0.2 * w, y + 0.8 * w), (x + 0.8 * w, y + 0.8 * w), (x + 0.8 * w, y + 0.2 * w), (x + 0.2 * w, y + 0.2 * w)]
        far = [(a + 7, b - 3) for a, b in ring]
        out.append([
            S.point(x, y), S.multipoint((x, y), (x + w, y + w)), S.line((x, y), (x + w, y), (x, y + w)), S.polygon(ring),
            S.polygon(ring, hole), S.multipolygon([ring], [far]), S.line((3, 3), (4, 4)), None, {"type": "LineString", "parts": []},
        ][i % 9])
    return out


@pytest.mark.parametrize("k,limit", [(1, None), (3, None), (4, 1.5)])
def test_neighbors_of_all_kinds_like_jts(spark, monkeypatch, k, limit):
    rng = random.Random(5)
    monkeypatch.setattr(nearest, "LEAF_POINTS", 6)
    monkeypatch.setattr(nearest, "SPLIT", 3)
    base, others = shapes_of_all_kinds(rng, 45), shapes_of_all_kinds(rng, 90)
    jts = S.Jts(spark)
    read = [[jts.read(g) if g and g["parts"] else None for g in layer] for layer in (base, others)]
    want = set()
    for i, g in enumerate(read[0]):
        ranked = sorted((round(g.distance(h), 9), j) for j, h in enumerate(read[1]) if h is not None) if g is not None else []
        want |= {(i, r + 1, j, d) for r, (d, j) in enumerate(ranked[:k]) if limit is None or d <= limit}
    found = nearest.neighbors(S.layer(spark, base), S.layer(spark, others).withColumnRenamed("id", "cid"), "id", "cid", k, limit)
    assert {(r.id, r["rank"], r.cid, round(r.distance, 9)) for r in found.collect()} == want


def test_neighbors_of_one_middle(spark, monkeypatch):
    """Different areas around one place can't be told apart by tiles; chunks hold them all."""
    monkeypatch.setattr(nearest, "LEAF_POINTS", 4)
    monkeypatch.setattr(nearest, "SPLIT", 2)
    monkeypatch.setattr(nearest, "MAX_LEVELS", 3)
    rings = S.layer(spark, [S.box(-w, -w, w, w) for w in range(1, 41)]).withColumnRenamed("id", "cid")
    found = nearest.neighbors(S.layer(spark, [S.point(50, 0), S.point(0, 0)]), rings, "id", "cid", 2).collect()
    assert sorted((r.id, r["rank"], r.cid, r.distance) for r in found) == [(0, 1, 39, 10.0), (0, 2, 38, 11.0), (1, 1, 0, 0.0), (1, 2, 1, 0.0)]


def test_neighbors_of_nothing(spark):
    base = point_layer(spark.createDataFrame([(1, 0.0, 0.0)], "id bigint, x double, y double"), "x", "y")
    assert nearest.neighbors(base, base.withColumnRenamed("id", "cid").limit(0), "id", "cid").count() == 0


# --- plans ---------------------------------------------------------------------------------


def test_plans_have_no_cross_joins(spark):
    import __spark_entry__ as entry_points

    for key in ("sjoin_within", "sjoin_intersects", "zonal_stats", "flow_zone_report", "spatial_relate", "sjoin_left"):
        plan = entry_points.queries()[key](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, key
        assert "Python" not in plan and "Pandas" not in plan, key


def test_filters_reach_the_scan(spark):
    from geoflow.operators.filters import filter_rows
    from geoflow.plans.layers import table

    df = filter_rows(table(spark, "/root/testdata/sf0.001", "customer"), "c_mktsegment", "equals", "BUILDING").select("c_custkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(c_mktsegment,BUILDING)" in plan and "c_acctbal" not in plan


def test_small_sides_are_measured(spark):
    small = spark.createDataFrame([(1,)], "a int").where("a = 1")
    assert gridjoin.estimated_bytes(spark.range(10)) == 80
    assert not gridjoin.is_small(small.join(spark.range(10**9), F.col("a") == F.col("id")))


def test_null_and_repeated_ids_give_the_same_rows_by_every_strategy(spark):
    points = point_layer(spark.createDataFrame([(1, 0.5), (None, 0.6), (1, 0.5), (2, 9.0)], "id int, x double").withColumn("y", F.lit(0.5)), "x", "y")
    areas = S.layer(spark, [S.box(0, 0, 1, 1), S.box(0, 0, 2, 1)]).selectExpr("nullif(id, 0) id", "geom")
    for how, n in (("inner", 6), ("left", 7), ("right", 6)):
        got = [
            sorted(map(repr, spatial.spatial_join(points, areas, "id", "id", "within", how, strategy=s).select("id_left", "id_right").collect()))
            for s in ("broadcast_left", "broadcast_right", "shuffle")
        ]
        assert len(got[0]) == n and got[0] == got[1] == got[2]
    assert spatial.spatial_relate(points, areas, "id", "id", "within").where("port = 'related'").count() == 3


# --- ids are only columns -------------------------------------------------------------------


def from_one(spark, geoms):
    """Layer with ids 1, 2, 3..."""
    made = S.layer(spark, geoms)
    return made.withColumn("id", F.col("id") + 1)


@pytest.mark.parametrize("ids", [(1, 2), (None, None), (1, 1), (None, 2)])
def test_overlay_operators_do_not_depend_on_ids(spark, ids):
    squares = from_one(spark, [S.box(0, 0, 2, 2), S.box(1, 1, 3, 3)]).withColumn("id", F.array(*[F.lit(i).cast("int") for i in ids])[F.col("id") - 1])
    squares = squares.withColumn("g", F.lit("one"))
    assert [round(r.a, 9) for r in edges.dissolve(squares, ["g"], "id").selectExpr(f"{M.area('geom')} a").collect()] == [7.0]
    assert [(round(r.area, 9), round(r.perimeter, 9)) for r in edges.dissolve_measures(squares, ["g"], "id").collect()] == [(7.0, 12.0)]
    mask = from_one(spark, [S.box(0, 0, 1.5, 9), S.box(1.5, 0, 2.5, 9)]).withColumn("id", F.lit(None).cast("int"))
    clipped = edges.clip(squares, mask, "id", "id").selectExpr("id", "port", f"round({M.area('geom')}, 9) a").collect()
    assert sorted(((r.id, r.port, r.a) for r in clipped), key=repr) == sorted([(ids[0], "inside", 4.0), (ids[1], "inside", 3.0), (ids[1], "outside", 1.0)], key=repr)
    measured = edges.clip_measures(squares, mask, "id", "id").collect()
    assert sorted(((r.id, r.port, round(r.area, 9)) for r in measured), key=repr) == sorted(((r.id, r.port, r.a) for r in clipped), key=repr)
    crossing = from_one(spark, [S.line((0, 0), (2, 2)), S.line((0, 2), (2, 0))]).withColumn("id", F.array(*[F.lit(i).cast("int") for i in ids])[F.col("id") - 1])
    assert sorted((r.id for r in edges.split_lines(crossing, "id").collect()), key=repr) == sorted([ids[0]] * 2 + [ids[1]] * 2, key=repr)
    grown = edges.buffer(squares, 0.5, "id").selectExpr(f"{M.area('geom')} a").collect()
    assert len(grown) == 2 and all(8.7 < r.a < 8.8 for r in grown)
    base = from_one(spark, [S.point(0, 0), S.point(5, 5), S.point(9, 9), S.point(1, 1)]).selectExpr("element_at(array(1, 1, null, null), int(id)) id", "geom")
    near = nearest.neighbors(base, from_one(spark, [S.point(0, 1), S.point(9, 8)]), "id", "id", 1).collect()
    assert sorted((round(r.distance, 9) for r in near)) == [1.0, 1.0, 1.0, 5.0]


def pieces_of(df):
    return sorted((r.id, r.part, r.piece, [(round(p.x, 9), round(p.y, 9)) for p in r.geom.parts[0][0]]) for r in df.collect())


def test_lines_are_broken_where_they_meet_and_keep_their_shape(spark):
    lines = [
        S.line((0, 0), (4, 0), (4, 2), (2, 2), (2, -2)),  # crosses itself at (2, 0)
        S.line((-1, 5), (0, 5), (0, 5), (3, 6)),  # meets nothing, a repeated vertex
        S.line((10, 0), (11, 0), (11, 1), (10, 1), (10, 0)),  # closed, touched at a vertex by the next
        S.line((11, 1), (12, 2)),
        S.line((7, 7), (7, 7)),  # no length
        None,
    ]
    got = pieces_of(edges.split_lines(from_one(spark, lines).withColumn("name", F.concat(F.lit("n"), "id")), "id"))
    assert got == [
        (1, 0, 1, [(0, 0), (2, 0)]),
        (1, 0, 2, [(2, 0), (4, 0), (4, 2), (2, 2), (2, 0)]),
        (1, 0, 3, [(2, 0), (2, -2)]),
        (2, 0, 1, [(-1, 5), (0, 5), (3, 6)]),
        (3, 0, 1, [(10, 0), (11, 0), (11, 1)]),
        (3, 0, 2, [(11, 1), (10, 1), (10, 0)]),
        (4, 0, 1, [(11, 1), (12, 2)]),
        (5, 0, 1, [(7, 7), (7, 7)]),
    ]
    several = from_one(spark, [S.line((0, 0), (1, 0))]).withColumn("geom", F.expr(
        "named_struct('type', 'MultiLineString', 'parts', array(geom.parts[0], array(array(named_struct('x', 0.5D, 'y', -1D), named_struct('x', 0.5D, 'y', 1D)))))"
    ))
    assert [(p, n) for _, p, n, _ in pieces_of(edges.split_lines(several, "id"))] == [(0, 1), (0, 2), (1, 1), (1, 2)]
    overlap = from_one(spark, [S.line((0, 0), (4, 0)), S.line((1, 0), (2, 0), (2, 3))])
    assert [c for _, _, _, c in pieces_of(edges.split_lines(overlap, "id"))] == [[(0, 0), (1, 0)], [(1, 0), (2, 0)], [(2, 0), (4, 0)], [(1, 0), (2, 0)], [(2, 0), (2, 3)]]
    assert edges.split_lines(from_one(spark, lines).where("id > 99"), "id").collect() == []


def test_clipped_lines_keep_their_shape_and_attributes(spark):
    mask = from_one(spark, [S.box(0, 0, 2, 4), S.box(2, 0, 4, 4)])
    lines = from_one(spark, [S.line((-1, 1), (1, 1), (3, 1), (3, 3), (5, 3), (5, 1), (3.5, 1)), S.line((0, 0), (0, 4)), S.line((8, 8), (9, 9), (9, 8)), S.line((1, 1), (1, 1))])
    got = edges.clip(lines.withColumn("name", F.concat(F.lit("n"), "id")), mask, "id", "id")
    rows = sorted((r.id, r.name, r.port, [(round(p.x, 9), round(p.y, 9)) for p in r.geom.parts[0][0]]) for r in got.collect())
    assert rows == [
        (1, "n1", "inside", [(0, 1), (1, 1), (3, 1), (3, 3), (4, 3)]),
        (1, "n1", "inside", [(4, 1), (3.5, 1)]),
        (1, "n1", "outside", [(-1, 1), (0, 1)]),
        (1, "n1", "outside", [(4, 3), (5, 3), (5, 1), (4, 1)]),
        (2, "n2", "inside", [(0, 0), (0, 4)]),
        (3, "n3", "outside", [(8, 8), (9, 9), (9, 8)]),
    ]
    lengths = edges.clip_measures(lines, mask, "id", "id").collect()
    assert sorted((r.id, r.port, round(r.length, 9)) for r in lengths)[:2] == [(1, "inside", 6.5), (1, "outside", 5.0)]


def test_rounds_delete_what_was_read(spark, tmp_path):
    from pathlib import Path

    rounds = lineage.Rounds(spark, "trial")
    first = rounds.keep(spark.range(5).toDF("a"))
    path = rounds.paths[0].removeprefix("file:")
    assert first.count() == 5 and Path(path).exists()
    second = rounds.keep(first.selectExpr("a + 1 a"))
    assert not Path(path).exists() and second.count() == 5

"""Text comparison, routing, key joins, counters, profiles, user code."""

import datetime

import pytest
from pyspark.sql import functions as F

from geoflow.functions import text as X
from geoflow.operators import code, fields, filters, joins, preview, profile, routing
from geoflow.operators.points import points_from_xy


def test_filter_semantics(spark):
    df = spark.createDataFrame(
        [(1, "nan", True, 1.0), (2, None, False, 1.5), (3, "A+b", None, None)], "id int, s string, b boolean, d double"
    )

    def ids(field, op, value):
        return sorted(r.id for r in filters.filter_rows(df, field, op, value).collect())

    assert ids("s", "equals", "nan") == [1]
    assert ids("s", "neq", "nan") == [2, 3]
    assert ids("b", "=", True) == [1]
    assert ids("d", "eq", 1.0) == [1]
    assert ids("d", "contains", "5$") == [2]
    assert ids("s", "like", "a.B") == [3]
    with pytest.raises(ValueError, match="not found"):
        filters.filter_rows(df, "zz", "equals", 1)
    with pytest.raises(ValueError, match="unknown operator"):
        filters.filter_rows(df, "s", "between", 1)


def test_parse_coord(spark):
    texts = ["650 000,5", "4.83", "", "abc", None, "1 234", "1e3", "NaN", "1,2.5", "-.5"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.v for r in df.select("i", X.parse_coord("t").alias("v")).orderBy("i").collect()]
    assert got == [650000.5, 4.83, None, None, None, 1234.0, 1000.0, None, None, -0.5]


def test_names():
    assert X.find_xy_columns(["CODE", "X", "Y", "ADRESSE"]) == ("X", "Y")
    assert X.find_xy_columns(["y", "Coord X", "LATITUDE", "Long"]) == ("Long", "LATITUDE")
    assert X.find_xy_columns(["a"]) == (None, None)
    assert X.normalize_name(" Coord. X--y ") == "coord_x_y"


def test_points_find_columns_and_system(spark):
    lambert = spark.createDataFrame([(650000, 6860000), (651000, 6861000)], "X int, Y int")
    assert points_from_xy(lambert).schema["geom"].metadata["srid"] == 2154
    degrees = spark.createDataFrame([(1, "4,835659", "45.764043"), (2, "x", "45.758")], "id int, X string, Y string")
    layer = points_from_xy(degrees)
    assert layer.count() == 1 and layer.schema["geom"].metadata["srid"] == 4326
    with pytest.raises(ValueError, match="no coordinate columns"):
        points_from_xy(spark.range(1))


@pytest.mark.parametrize(
    "xs,expected",
    [([181.0, 179.0], 4326), ([100.0], 4326), ([2e6], 3857), ([-2e6, -3e6], 3857), ([1e6, 1e6 + 2], 3857), ([], 4326), ([1e6], 4326)],
)
def test_infer_crs_at_the_limits(spark, xs, expected):
    df = spark.createDataFrame([(x, 0.0) for x in xs], "x double, y double")
    assert profile.infer_crs(df, "x", "y").first().srid == expected


def test_null_keys_match(spark):
    a = spark.createDataFrame([(None, 1), (2, 2)], "k int, v int")
    b = spark.createDataFrame([(None, 5), (3, 6)], "k int, v int")

    def rows(how):
        return sorted(map(repr, map(tuple, joins.join_keys(a, b, ["k"], how).collect())))

    assert joins.join_keys(a, b, ["k"]).columns == ["k", "v_x", "v_y"]
    assert rows("inner") == ["(None, 1, 5)"]
    assert rows("left_outer") == ["(2, 2, None)", "(None, 1, 5)"]
    assert rows("right") == ["(3, None, 6)", "(None, 1, 5)"]
    assert rows("outer") == ["(2, 2, None)", "(3, None, 6)", "(None, 1, 5)"]
    with pytest.raises(ValueError, match="unknown join type"):
        joins.join_keys(a, b, ["k"], "cross")


def test_ports_partition_the_input(spark):
    df = spark.range(30).withColumn("v", F.expr("if(id % 4 = 0, null, id % 3)"))
    for routed in (
        routing.tester(df, F.col("v") > 1),
        routing.switch(df, [F.col("v") == 0, F.col("v") >= 0]),
        routing.duplicate_filter(df, ["v"], "id"),
    ):
        ports = [r.port for r in routed.select("port").distinct().collect()]
        assert sum(routing.take_port(routed, p).count() for p in ports) == 30
    unique = routing.take_port(routing.duplicate_filter(df, ["v"], "id"), "unique")
    assert sorted(r.id for r in unique.collect()) == [0, 1, 2, 3]


@pytest.mark.parametrize("kind", ["bigint", "string", "double", "timestamp", "date", "decimal(10,2)"])
def test_counter_by_any_type(spark, kind):
    # one group holds most of the rows
    value = {"string": "lpad(id * 7 % 5000, 6, '0')", "timestamp": "timestamp_seconds(id * 7 % 5000)",
             "date": "date_add(date'2020-01-01', int(id * 7 % 5000))"}.get(kind, f"cast(id * 7 % 5000 as {kind})")
    df = spark.range(5000).selectExpr("if(id % 10 = 0, 'a', 'b') g", f"{value} v")
    got = fields.add_counter(df, "n", "v", partition_by=["g"])
    from pyspark.sql import Window

    wrong = got.withColumn("want", F.row_number().over(Window.partitionBy("g").orderBy("v"))).where("n <> want")
    assert got.count() == 5000 and wrong.count() == 0


def test_fields(spark):
    df = spark.createDataFrame([(1, "a")], "x int, s string")
    out = fields.edit_fields(df, [{"op": "create", "name": "y", "expr": "x + 1"}, {"op": "rename", "from": "y", "to": "z"}])
    assert out.columns == ["x", "s", "z"]
    with pytest.raises(ValueError, match="unknown field operation"):
        fields.edit_fields(df, [{"op": "merge"}])
    assert fields.map_values(df, "s", {}).first().s == "a"
    lists = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id int, l array<string>")
    assert fields.explode_list(lists, "l").count() == 4


def test_steps_are_counted_without_an_extra_pass(spark):
    steps = profile.StepCounts()
    df = steps.watch(spark.range(10), "read")
    df = steps.watch(df.where("id < 4"), "filtered")
    df.write.format("noop").mode("overwrite").save()
    assert steps.result() == {"read": 10, "filtered": 4}


def test_user_code(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 0.0)], "id int, v double")
    done = code.run_item(df, lambda r: {"w": 1 / r["v"]}, "w double")
    good, bad = routing.split_rejected(done)
    assert good.first().w == 0.5 and "ZeroDivisionError" in bad.first().reject_reason
    assert code.run_sql(df, "select count(*) n from gdf", "id").first().n == 2
    with pytest.raises(ValueError, match="__row_id__"):
        code.run_sql(df.withColumn("geom", F.lit(None)), "select 1 a from items", "id", keep_geometry=True)


def test_pages(spark):
    df = spark.range(120)
    assert preview.page_rows(df, "id", None).count() == 120
    assert [r.id for r in preview.page_rows(df, "id", 50, page=3).collect()] == list(range(100, 120))
    assert preview.preview_rows(df, "id").agg(F.max("total")).first()[0] == 120


def test_row_wise_operators_take_streams(spark, tmp_path):
    from geoflow.functions.crs import reproject
    from geoflow.operators.spatial import point_layer

    schema = "c_custkey bigint, c_mktsegment string"
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.range(10).selectExpr("id c_custkey", "if(id < 4, 'A', 'B') c_mktsegment").write.parquet(source)
    stream = filters.filter_rows(spark.readStream.schema(schema).parquet(source), "c_mktsegment", "equals", "A")
    layer = reproject(point_layer(stream, "c_custkey", "45"), 2154)
    layer.writeStream.format("parquet").option("path", target).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(target).count() == 4


def test_duplicate_filter_has_one_unique_row_for_each_key(spark):
    from geoflow.operators import routing

    rows = spark.createDataFrame([(1, 5), (2, 5), (1, 5), (1, 7), (3, None), (3, None), (None, 1), (None, 1)], "k int, v int")
    got = routing.duplicate_filter(rows, ["k"], "v").collect()
    assert len(got) == 8 and sorted((r.k or 0, r.v) for r in got if r.port == "unique") == [(0, 1), (1, 5), (2, 5), (3, None)]


def test_code_sql_leaves_the_views_of_the_session(spark):
    spark.range(3).createOrReplaceTempView("items")
    spark.range(4).createOrReplaceTempView("gdf")
    layer = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    got = code.run_sql(layer, "with t as (select * from items) select t.v, gdf.__row_id__ from t join gdf on t.k = gdf.k -- which rows\norder by 1;", "k")
    assert [tuple(r) for r in got.collect()] == [("a", 1), ("b", 2)]
    assert (spark.table("items").count(), spark.table("gdf").count()) == (3, 4)
    spark.catalog.dropTempView("items")
    spark.catalog.dropTempView("gdf")


def test_code_item_sees_integers_beside_nulls(spark):
    layer = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "k int, v bigint")
    got = code.run_item(layer, lambda item: {"kind": type(item["v"]).__name__, "twice": 2 * item["v"]}, "kind string, twice bigint").collect()
    assert [(r.kind, r.twice, r.reject_reason is None) for r in sorted(got)] == [("int", 10, True), (None, None, False), ("int", 14, True)]
    wrong = code.run_item(layer, lambda item: {"twice": "no number"}, "twice bigint").collect()
    assert all(r.twice is None and r.reject_reason for r in wrong)


@pytest.mark.parametrize("range_rows,most", [(1_000_000, 65_536), (10, 65_536), (10, 100)])
def test_counter_by_any_number_of_ranges(spark, monkeypatch, range_rows, most):
    monkeypatch.setattr(fields, "RANGE_ROWS", range_rows)
    monkeypatch.setattr(fields, "MAX_RANGES", most)
    df = spark.range(3000).selectExpr("if(id = 7, null, id * 7919 % 10007) v", "if(id % 3 = 0, null, id % 2) g")
    got = fields.add_counter(fields.add_counter(df, "n", "v"), "m", "v", 10, 2, ["g"]).collect()
    place = sorted(got, key=lambda r: (r.v is not None, r.v))
    assert [r.n for r in place] == list(range(1, 3001))
    for g in (None, 0, 1):
        assert [r.m for r in place if r.g == g] == [10 + 2 * i for i in range(sum(r.g == g for r in got))]
    assert fields.add_counter(df.limit(0), "n", "v").count() == 0

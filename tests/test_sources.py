"""Files: what is written comes back, and odd inputs are handled."""

import io
import json
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import shapes as S
from geoflow.functions import geometry as G
from geoflow.functions import measures as M
from geoflow.functions.crs import SUPPORTED
from geoflow.operators.filters import filter_rows
from geoflow.operators.points import points_from_xy
from geoflow.plans.files import workbook_bytes
from geoflow.sources import csv_ranges, delimited, dxf, geojson, geojson_ranges, gpkg, inventory, jdbc, kml, prj, shapefile, sinks, wkb, workbook

LIGHTS = """id;commune;type_equipement;latitude;longitude;puissance_w
EP-001;Lyon;LED;45.764043;4.835659;120
EP-002;Lyon;Sodium;45.758000;4.828000;150
EP-003;Lyon;LED;45.770100;4.850200;100
EP-004;Paris;LED;48.856613;2.352222;90
EP-005;Paris;Halogene;48.873792;2.295028;200
EP-006;Marseille;LED;43.296482;5.369780;110
EP-007;Toulouse;Sodium;43.604652;1.444209;140
EP-008;Lyon;LED;45.748500;4.846700;95
EP-009;Bordeaux;LED;44.837789;-0.579180;105
EP-010;Nantes;Sodium;47.218371;-1.553621;130
EP-011;Lyon;LED;45.760000;4.840000;115
EP-012;Strasbourg;LED;48.573405;7.752111;100
"""


@pytest.fixture
def lights(tmp_path):
    path = tmp_path / "lights.csv"
    path.write_bytes(b"\xef\xbb\xbf" + LIGHTS.encode())
    return str(path)


def test_street_light_flow(spark, lights, tmp_path):
    df = delimited.read_csv(spark, lights)
    assert df.columns[0] == "id" and df.count() == 12
    assert dict(df.dtypes)["puissance_w"] == "int" and dict(df.dtypes)["latitude"] == "double"
    assert filter_rows(df, "type_equipement", "equals", "LED").count() == 8
    flow = df.transform(filter_rows, "commune", "equals", "Lyon").transform(points_from_xy)
    target = str(tmp_path / "lyon")
    geojson.write_geojson(flow, target, layout="document")
    (part,) = Path(target).glob("part-*")
    document = json.loads(part.read_text())
    assert document["type"] == "FeatureCollection" and len(document["features"]) == 5
    back = geojson.read_geojson(spark, target, layout="document")
    assert {r.id for r in back.collect()} == {"EP-001", "EP-002", "EP-003", "EP-008", "EP-011"}
    assert geojson.check_geojson(spark, target, "document").first().valid


def test_csv_details(spark, tmp_path):
    latin = tmp_path / "latin.csv"
    latin.write_bytes("nom|ville\nRené|Orléans\n".encode("latin-1"))
    assert delimited.read_csv(spark, str(latin)).first().nom == "René"
    bare = tmp_path / "bare.csv"
    bare.write_text("1,a\n2,b\n")
    assert delimited.read_csv(spark, str(bare), header=False).count() == 2
    profile = delimited.profile_files(spark, str(tmp_path)).collect()
    assert {Path(r.file).name: (r.separator, r.utf8) for r in profile} == {"latin.csv": ("|", False), "bare.csv": (",", True)}
    with pytest.raises(ValueError, match="different separators"):
        delimited.read_csv(spark, str(tmp_path))


def test_geojson_lines_inside_a_collection(spark, tmp_path):
    path = tmp_path / "layer.geojson"
    path.write_text(
        '{\n"type": "FeatureCollection",\n"name": "layer",\n'
        '"crs": { "type": "name", "properties": { "name": "urn:ogc:def:crs:EPSG::2154" } },\n"features": [\n'
        '{ "type": "Feature", "properties": { "id": 1, "v": "a" }, "geometry": { "type": "Point", "coordinates": [ 1.0, 2.0 ] } },\n'
        '{ "type": "Feature", "properties": { "id": 2, "v": null }, "geometry": null },\n'
        '{ "type": "Feature", "properties": { "id": 3 }, "geometry": { "type": "Point", "coordinates": ["x"] } },\n'
        '{ "type": "Feature", "properties": { "id": 4 }, "geometry": { "type": "GeometryCollection", "geometries": ['
        '{ "type": "Point", "coordinates": [5, 6] }, { "type": "LineString", "coordinates": [[0, 0], [1, 1]] }] } }\n]\n}\n'
    )
    with pytest.raises(Exception, match="unreadable geometry"):
        geojson.read_geojson(spark, str(path)).collect()
    layer = geojson.read_geojson(spark, str(path), keep_rejected=True)
    assert layer.schema["geom"].metadata["srid"] == 2154
    rows = sorted((r.id, r.geom.type if r.geom else None) for r in layer.where("reject_reason is null").collect())
    assert rows == [(1, "Point"), (2, None), (4, "LineString"), (4, "Point")]
    kept = geojson.read_geojson(spark, str(path), "id:bigint", keep_rejected=True).where("reject_reason is not null")
    assert [r.id for r in kept.collect()] == [3]
    assert geojson.read_geojson(spark, str(path), layout="document", keep_rejected=True).count() == 5


@pytest.mark.parametrize(
    "cut",
    ['{"type":"Feature","properties":{"id":2},"geometry":{"type":"Point","coordinates":[', '{"properties":{"tags":[', '"geometry":{"type":"Point",',
     '{"type":"Feature","properties":{"id":2},"geo'],
)
def test_geojson_cut_lines_are_reported(spark, tmp_path, cut):
    path = tmp_path / "cut.geojson"
    path.write_text((FEATURE % (1, 1)) + "\n" + cut)
    rows = geojson.read_geojson(spark, str(path), "id:bigint", keep_rejected=True).collect()
    assert sorted((r.id, r.reject_reason) for r in rows if r.id == 1) == [(1, None)]
    assert [r.reject_reason for r in rows if r.id is None] == ["unreadable line"]
    check = geojson.check_geojson(spark, str(path)).first()
    assert (check.feature_count, check.valid) == (1, False)
    with pytest.raises(Exception, match="unreadable line"):
        geojson.read_geojson(spark, str(path), "id:bigint").collect()


def test_empty_layer_document(spark, tmp_path):
    target = str(tmp_path / "none")
    geojson.write_geojson(S.layer(spark, [S.point(1, 2)]).limit(0), target, layout="document")
    assert not geojson.check_geojson(spark, target, "document").first().valid


MIXED = [S.point(1, 2), S.line((0, 0), (1, 2), (3, 3)), S.polygon(S.SQUARE, S.HOLE),
         S.multipolygon([S.SQUARE, S.HOLE], [[(20, 0), (30, 0), (30, 10), (20, 0)]]), S.multipoint((1, 2), (3, 4)), None]


def mixed(spark):
    return S.layer(spark, MIXED).selectExpr(
        "id", "geom", "if(id = 1, null, concat('é', id)) a_very_long_name", "id * 1.5D v", "id > 2 flag", "date'2024-02-29' d"
    )


def summary(df):
    return sorted(map(repr, map(tuple, df.selectExpr("id", "round(" + M.area("geom") + ", 9) a", f"{G.vertex_count('geom')} n", "v", "flag").collect())))


def test_shapefile_round_trip(spark, tmp_path):
    df = mixed(spark)
    path = str(tmp_path / "shp")
    shapefile.write_shapefile(df.repartition(2), path)
    back = shapefile.read_shapefile(spark, path, records_per_task=1)
    assert "a_very_lon" in back.columns and dict(back.dtypes)["d"] == "date"
    # a null shape loses nothing but its geometry
    assert summary(back) == summary(df)
    assert {r.a_very_lon for r in back.collect()} == {"é0", None, "é2", "é3", "é4", "é5"}


def test_shapefile_archive_and_missing_index(spark, tmp_path):
    folder = tmp_path / "plain"
    shapefile.write_shapefile(S.layer(spark, [S.polygon(S.SQUARE, S.HOLE), S.box(0, 0, 1, 1)]).coalesce(1), str(folder))
    (shp,) = folder.glob("*.shp")
    archive = tmp_path / "set.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in folder.glob("part-*"):
            z.write(f, f"data/areas{f.suffix}")
        z.writestr("data/other.shp", b"incomplete")
    zipped = shapefile.read_shapefile(spark, str(archive), layer="areas")
    assert zipped.agg(F.sum(F.expr(M.area("geom")))).first()[0] == 97
    bare = tmp_path / "bare"
    bare.mkdir()
    for ext in (".shp", ".dbf"):
        (bare / f"x{ext}").write_bytes(shp.with_suffix(ext).read_bytes())
    assert shapefile.read_shapefile(spark, str(bare / "x.shp")).count() == 2
    with pytest.raises(Exception, match="no complete shapefile"):
        empty = tmp_path / "empty.zip"
        zipfile.ZipFile(empty, "w").close()
        shapefile.read_shapefile(spark, str(empty)).count()


def test_gpkg_round_trip(spark, tmp_path):
    df = mixed(spark)
    path = str(tmp_path / "gpkg")
    gpkg.write_gpkg(df.repartition(2), path, layer="things")
    back = gpkg.read_gpkg(spark, path, "things", rows_per_task=2)
    assert summary(back) == summary(df)
    assert back.schema["geom"].metadata["srid"] == 4326
    with pytest.raises(ValueError, match="no layer"):
        gpkg.read_gpkg(spark, path, "nothing")


def test_overwrite_replaces(spark, tmp_path):
    for fmt in ("shapefile", "gpkg"):
        path = str(tmp_path / fmt)
        sinks.write_layer(S.layer(spark, [S.point(1, 1)]), path, fmt)
        sinks.write_layer(S.layer(spark, [S.point(2, 2), S.point(3, 3)]), path, fmt, mode="overwrite")
        reader = shapefile.read_shapefile if fmt == "shapefile" else gpkg.read_gpkg
        assert reader(spark, path).count() == 2
    with pytest.raises(ValueError, match="unknown format"):
        sinks.write_layer(S.layer(spark, []), str(tmp_path / "x"), "dwg")


def test_wkb(spark):
    for geom in MIXED:
        assert wkb.decode(wkb.encode(geom)) == geom
    jts = S.Jts(spark)
    writer = spark._jvm.org.locationtech.jts.io.WKBWriter(2, 1)
    for geom in MIXED[:-1]:
        assert bytes(writer.write(jts.read(geom))) != b"" and wkb.decode(bytes(writer.write(jts.read(geom)))) == geom
    df = S.layer(spark, MIXED).withColumn("b", jdbc.to_wkb("geom")).withColumn("again", jdbc.from_wkb("b"))
    assert df.where("not (geom <=> again)").count() == 0


def test_gpkg_after_wkb_was_used(spark, tmp_path):
    layer = S.layer(spark, MIXED[:1])
    assert layer.select(jdbc.from_wkb(jdbc.to_wkb("geom")).alias("g")).where("g is null").count() == 0
    gpkg.write_gpkg(layer, str(tmp_path / "after"))
    assert gpkg.read_gpkg(spark, str(tmp_path / "after")).count() == 1


def test_jdbc_options():
    made = jdbc.read_options("jdbc:x", "t", "id", 1, 100, 8, fetchsize="1000")
    assert made["numPartitions"] == "8" and made["lowerBound"] == "1" and made["fetchsize"] == "1000"
    with pytest.raises(ValueError, match="bounds"):
        jdbc.read_options("jdbc:x", "t", "id")


KML = """<?xml version="1.0"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document>
<Placemark><name>p</name><Point><coordinates>4.8,45.7,100</coordinates></Point></Placemark>
<Folder><Placemark><name>l</name><LineString><coordinates>
 0,0 1,1
 2,0 </coordinates></LineString></Placemark></Folder>
<Placemark><name>a</name><ExtendedData><Data name="k"><value>7</value></Data></ExtendedData><Polygon>
<outerBoundaryIs><LinearRing><coordinates>0,0 10,0 10,10 0,10 0,0</coordinates></LinearRing></outerBoundaryIs>
<innerBoundaryIs><LinearRing><coordinates>4,4 4,6 6,6 6,4 4,4</coordinates></LinearRing></innerBoundaryIs></Polygon></Placemark>
</Document></kml>"""


def test_kml_and_kmz(spark, tmp_path):
    plain = tmp_path / "a.kml"
    plain.write_text(KML)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("doc.kml", KML)
    files = spark.createDataFrame([("a.kmz", bytearray(out.getvalue()))], "path string, content binary")
    for layer in (kml.read_kml(spark, str(plain)), kml.parse_kml_files(files)):
        rows = {r["name"]: r for r in layer.selectExpr("*", f"{M.area('geom')} a", f"{G.vertex_count('geom')} n").collect()}
        assert rows["a"].a == 96 and rows["a"].data == {"k": "7"} and rows["l"].n == 3
        assert rows["p"].geom.parts[0][0][0].x == 4.8


def test_workbooks(spark):
    content = workbook_bytes(["nom", "lon", "lat"], [["a & b", 4.8, 45.7], ["c", None, 1]], sheet="S")
    files = spark.createDataFrame([("x.xlsx", bytearray(content))], "path string, content binary")
    rows = workbook.parse_workbooks(files, {"nom": "string", "lon": "double", "lat": "double", "missing": "int"}).collect()
    assert [(r.row_number, r.nom, r.lon, r.lat, r.missing) for r in rows] == [(1, "a & b", 4.8, 45.7, None), (2, "c", None, 1.0, None)]
    with pytest.raises(Exception, match="no sheet"):
        workbook.parse_workbooks(files, {"nom": "string"}, sheet="T").collect()


def test_dxf(spark):
    text = "\n".join(
        ["0", "SECTION", "2", "HEADER", "9", "$X", "0", "ENDSEC", "0", "SECTION", "2", "ENTITIES",
         "0", "CIRCLE", "8", "C", "10", "1", "20", "2", "40", "3",
         "0", "LWPOLYLINE", "8", "P", "70", "0", "10", "0", "20", "0", "10", "1", "20", "1",
         "0", "POINT", "8", "C", "10", "7", "20", "8", "0", "TEXT", "8", "C", "0", "ENDSEC", "0", "EOF"]
    )
    files = spark.createDataFrame([("d.dxf", bytearray(text.encode()))], "path string, content binary")
    rows = {r.entity: r for r in dxf.parse_dxf_files(files).selectExpr("*", f"{M.area('geom')} a").collect()}
    assert set(rows) == {"CIRCLE", "LWPOLYLINE", "POINT"}
    assert rows["CIRCLE"].a == pytest.approx(28.23, abs=0.01) and rows["LWPOLYLINE"].geom.type == "LineString"
    assert dxf.parse_dxf_files(files, layers="P , Q").count() == 1


def test_dxf_curves_and_rejected_entities(spark):
    def drawing(*codes):
        return "\n".join(["0", "SECTION", "2", "ENTITIES", *map(str, codes), "0", "ENDSEC", "0", "EOF"]).encode()

    good = drawing(
        # a left-hand and a right-hand half circle, open; a circle of two vertices; an old polyline
        0, "LWPOLYLINE", 5, "open", 70, 0, 10, 0, 20, 0, 42, 1, 10, 2, 20, 0, 42, -1, 10, 4, 20, 0,
        0, "LWPOLYLINE", 5, "round", 70, 1, 10, 0, 20, 0, 42, 1, 10, 2, 20, 0, 42, 1,
        0, "POLYLINE", 5, "old", 66, 1, 10, 0, 20, 0, 0, "VERTEX", 10, 1, 20, 1, 0, "VERTEX", 10, 2, 20, 5, 0, "SEQEND",
        0, "ARC", 5, "arc", 10, 0, 20, 0, 40, 2, 50, 350, 51, 10,
    )
    files = spark.createDataFrame([("good", bytearray(good)), ("none", None), ("empty", bytearray())], "path string, content binary")
    rows = {r.handle: [(round(p.x, 6), round(p.y, 6)) for p in r.geom.parts[0][0]] for r in dxf.parse_dxf_files(files).collect()}
    assert len(rows["open"]) == 65 and rows["open"][16] == (1, -1) and rows["open"][32] == (2, 0) and rows["open"][48] == (3, 1)
    assert len(rows["round"]) == 65 and rows["round"][0] == rows["round"][-1] and rows["round"][48] == (1, 1)
    assert rows["old"] == [(1, 1), (2, 5)]
    assert rows["arc"][0][1] == -rows["arc"][-1][1] and all(x > 1.96 for x, _ in rows["arc"])
    bad = drawing(
        0, "TEXT", 5, "a", 8, "L", 0, "POINT", 5, "b", 8, "L", 10, "x", 20, 1, 0, "LINE", 5, "c", 10, 1, 20, 1,
        0, "LWPOLYLINE", 5, "d", 10, 1, 20, 1, 0, "POINT", 5, "e", 10, 1, 20, 1,
    )
    files = spark.createDataFrame([("bad", bytearray(bad))], "path string, content binary")
    reasons = {r.handle: r.reject_reason for r in dxf.parse_dxf_files(files, keep_rejected=True).collect()}
    assert reasons["a"] == "TEXT is not read" and "x" in reasons["b"] and reasons["c"] == "group 11 is missing"
    assert reasons["d"] == "fewer than two vertices" and reasons["e"] is None
    with pytest.raises(Exception, match="bad: POINT of layer L"):
        dxf.parse_dxf_files(files).collect()


def test_kml_folders(spark, tmp_path):
    def mark(name):
        return f"<Placemark id='{name}'><name>{name}</name><Point><coordinates>1,2</coordinates></Point></Placemark>"

    body = (
        f"<kml><Document><Style><name>s</name></Style><name>doc</name>{mark('a')}<Folder/><Folder>{mark('b')}<name>late</name>{mark('c')}"
        f"<Folder><name><![CDATA[x & y]]></name>{mark('d')}</Folder>{mark('e')}</Folder>{mark('f')}</Document></kml>"
    )
    files = spark.createDataFrame([("a.kml", bytearray(body.encode())), ("none", None)], "path string, content binary")
    layers = {r.name: r.layer for r in kml.parse_kml_files(files).collect()}
    assert layers == {"a": "doc", "b": "doc", "c": "late", "d": "x & y", "e": "late", "f": "doc"}
    (tmp_path / "a.kml").write_text(body)
    assert [r.name for r in kml.read_kml(spark, str(tmp_path), layer="x & y").collect()] == ["d"]
    assert kml.read_kml(spark, str(tmp_path)).count() == 6


def test_inventory(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n")
    (tmp_path / "b.json").write_text('{"type": "FeatureCollection", "features": [' + "1," * 50_000 + "1]}")
    (tmp_path / "c.json").write_text('{"a": 1}')
    with zipfile.ZipFile(tmp_path / "d.zip", "w") as z:
        for ext in ("shp", "shx", "dbf"):
            z.writestr(f"layer.{ext}", b"")
    with zipfile.ZipFile(tmp_path / "e.zip", "w") as z:
        z.writestr("pl.prj", b"")
        z.writestr("pl.cpg", b"")
    found = {r.file_type: r.files for r in inventory.inventory(spark, str(tmp_path)).collect()}
    assert found == {"csv": 1, "geojson": 1, "shapefile": 1, None: 2}


def test_csv_quotes_and_line_breaks_come_back(spark, tmp_path):
    from geoflow.sources import delimited

    rows = [(1, 'a "b"; c'), (2, "two\nlines, and a comma"), (3, "plain"), (4, "  a "), (5, " \t"), (6, "\n x\\")]
    path = str(tmp_path / "quoted")
    delimited.write_csv(spark.createDataFrame(rows, "id int, t string"), path)
    back = delimited.read_csv(spark, path, ",", "utf-8", schema="id int, t string", multiline=True)
    assert sorted(map(tuple, back.collect())) == rows


@pytest.mark.parametrize("format", ["shapefile", "gpkg"])
def test_write_layer_modes(spark, tmp_path, format):
    from geoflow.operators.spatial import point_layer
    from geoflow.sources import sinks

    layer = point_layer(spark.createDataFrame([(1, 0.5, 0.5)], "id int, x double, y double"), "x", "y").select("id", "geom")
    path = str(tmp_path / format)
    sinks.write_layer(layer, path, format)
    before = sorted(p.name for p in (tmp_path / format).iterdir())
    with pytest.raises(FileExistsError):
        sinks.write_layer(layer, path, format)
    sinks.write_layer(layer, path, format, mode="ignore")
    assert sorted(p.name for p in (tmp_path / format).iterdir()) == before


FEATURE = '{"type":"Feature","properties":{"id":%d},"geometry":{"type":"Point","coordinates":[%d,2]}}'


def test_geojson_of_any_layout(spark, tmp_path):
    one = '{"type":"FeatureCollection","features":[%s,%s]}' % (FEATURE % (1, 1), FEATURE % (2, 2))
    (tmp_path / "one.json").write_text(one)
    (tmp_path / "pretty.json").write_text(json.dumps(json.loads(one.replace('"id":', '"id":1')), indent=2))
    (tmp_path / "lines.json").write_text("\n".join([FEATURE % (3, 3), (FEATURE % (4, 4))[:-9], FEATURE % (5, 5)]))
    (tmp_path / "head.json").write_text(
        '{"type":"FeatureCollection","features":[%s,\n%s]}' % (FEATURE % (6, 6), FEATURE % (7, 7))
    )
    (tmp_path / "broken.json").write_text(one[:-40])
    rows = geojson.read_geojson(spark, str(tmp_path), keep_rejected=True).collect()
    assert sorted(r.id for r in rows if r.id is not None) == [1, 2, 3, 5, 6, 7, 11, 12]
    assert sorted(r.reject_reason for r in rows if r.reject_reason) == ["unreadable document", "unreadable line"]
    with pytest.raises(Exception, match="unreadable"):
        geojson.read_geojson(spark, str(tmp_path)).collect()
    assert geojson.read_geojson(spark, str(tmp_path / "one.json"), layout="lines").count() == 2
    check = geojson.check_geojson(spark, str(tmp_path / "lines.json")).first()
    assert (check.feature_count, check.valid) == (2, False)


def test_geojson_keeps_the_coordinate_system(spark, tmp_path):
    layer = S.layer(spark, [S.point(700000, 6600000), S.line((1, 2), (3, 4))]).repartition(2)
    layer = layer.withMetadata("geom", {"srid": 2154})
    for layout in ("lines", "document"):
        target = str(tmp_path / layout)
        geojson.write_geojson(layer, target, layout=layout)
        for read_as in (None, layout):
            back = geojson.read_geojson(spark, target, layout=read_as)
            assert back.schema["geom"].metadata["srid"] == 2154 and back.count() == 2
    other = layer.withMetadata("geom", {"srid": 3857})
    geojson.write_geojson(other, str(tmp_path / "lines"), mode="append")
    with pytest.raises(ValueError, match="different coordinate systems"):
        geojson.read_geojson(spark, str(tmp_path / "lines"))


@pytest.mark.parametrize("srid", SUPPORTED)
def test_prj_text_comes_back(srid):
    assert prj.srid_of_prj(prj.prj_text(srid)) == srid


def test_prj_of_other_programs():
    lambert = prj.prj_text(2154).replace('44.0', "x").replace('49.0', "44").replace("x", "49")
    assert prj.srid_of_prj(lambert) == 2154
    assert prj.srid_of_prj('PROJCS["any",GEOGCS["a",DATUM["b"]],AUTHORITY["EPSG","3946"]]') == 3946
    with pytest.raises(ValueError, match="give srid"):
        prj.srid_of_prj(prj.prj_text(32631).replace("3.0", "15.0"))


def test_shapefile_keeps_the_coordinate_system(spark, tmp_path):
    layer = S.layer(spark, [S.point(700000, 6600000)]).withMetadata("geom", {"srid": 2154})
    shapefile.write_shapefile(layer, str(tmp_path / "a"))
    assert shapefile.read_shapefile(spark, str(tmp_path / "a")).schema["geom"].metadata["srid"] == 2154
    assert shapefile.read_shapefile(spark, str(tmp_path / "a"), srid=3857).schema["geom"].metadata["srid"] == 3857
    shapefile.write_shapefile(layer.withMetadata("geom", {"srid": 3857}), str(tmp_path / "a"))
    with pytest.raises(ValueError, match="different coordinate systems"):
        shapefile.read_shapefile(spark, str(tmp_path / "a"))


def test_shapefile_does_not_cut_text(spark, tmp_path):
    layer = S.layer(spark, [S.point(1, 2)]).withColumn("t", F.repeat(F.lit("é"), 127))
    shapefile.write_shapefile(layer, str(tmp_path / "fits"))
    assert shapefile.read_shapefile(spark, str(tmp_path / "fits")).first().t == "é" * 127
    with pytest.raises(Exception, match="do not fit"):
        shapefile.write_shapefile(layer.withColumn("t", F.repeat(F.lit("é"), 128)), str(tmp_path / "long"))


def test_kml_keeps_every_member(spark):
    body = (
        "<kml><Placemark><name>a</name><MultiGeometry><Point><coordinates>1,2</coordinates></Point>"
        "<LineString><coordinates>0,0 1,1</coordinates></LineString><Polygon><outerBoundaryIs><LinearRing><coordinates>"
        "0,0 1,0 1,1 0,0</coordinates></LinearRing></outerBoundaryIs></Polygon></MultiGeometry></Placemark>"
        "<Placemark><name>b</name></Placemark></kml>"
    )
    layer = kml.parse_kml_files(spark.createDataFrame([("a.kml", body.encode())], "path string, content binary"))
    rows = sorted((r.name, r.geom.type if r.geom else None) for r in layer.collect())
    assert rows == [("a", "MultiLineString"), ("a", "MultiPoint"), ("a", "MultiPolygon"), ("b", None)]


def test_csv_files_of_both_encodings(spark, tmp_path):
    (tmp_path / "latin.csv").write_bytes("id,ville\n1,Orléans\n2,Évry\n".encode("latin-1"))
    (tmp_path / "utf8.csv").write_bytes("id,ville\nx3,Nîmes\n".encode())
    rows = delimited.read_csv(spark, str(tmp_path)).collect()
    assert sorted((r.id, r.ville) for r in rows) == [("1", "Orléans"), ("2", "Évry"), ("x3", "Nîmes")]
    typed = delimited.read_csv(spark, str(tmp_path), schema="id string, ville string")
    assert typed.where("ville = 'Orléans'").count() == 1


def _odd_collection(n):
    texts = ["plain", "br}ace{", 'qu"ote', "back\\", '\\"', "[x]", '"features":[', 'é}"]}', "", None]
    shapes_ = [
        lambda i: None,
        lambda i: {"type": "Point", "coordinates": [i / 7, i]},
        lambda i: {"type": "LineString", "coordinates": [[i, 0], [1, 2], [3, 4]]},
        lambda i: {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [i, 1]}, {"type": "Point", "coordinates": [0, 0]}]},
    ]
    feature = lambda i: {
        "type": "Feature", "properties": {"id": i, "t": texts[i % 10], "o": {"a": [{"b": 1}, {}]}}, "geometry": shapes_[i % 4](i),
    }
    other = {"type": "Feature", "properties": {"id": -1}, "geometry": None}
    crs = {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::2154"}}
    return {"type": "FeatureCollection", "crs": crs, "before": [other], "features": [feature(i) for i in range(n)], "after": [other, []]}


@pytest.fixture
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_geojson_documents_in_byte_ranges(spark, tmp_path, small_ranges):
    folder = tmp_path / "a b%41"
    folder.mkdir()
    document = _odd_collection(150)
    (folder / "indented.json").write_text(json.dumps(document, indent=1, ensure_ascii=False) + "\n", encoding="utf-8")
    (folder / "one_line.json").write_bytes(b"\xef\xbb\xbf" + json.dumps(document).encode())
    (folder / "empty.json").write_text('{"type":"FeatureCollection","features":[' + " " * 9000 + "]}")
    (folder / "single.json").write_text(json.dumps({"type": "Feature", "properties": {"id": 7}, "geometry": None, "more": "x" * 9000}))
    known = {Path(d.path).name: d for d in geojson_ranges.documents(spark, str(folder))}
    assert len(known["indented.json"].ranges) > 10 and known["indented.json"].crs == known["one_line.json"].crs is not None
    assert [known[n].collection for n in ("indented.json", "one_line.json", "empty.json", "single.json")] == [True, True, True, False]
    want = geojson.parse_documents(
        spark.createDataFrame([(json.dumps(document),)] * 2, "doc string"), "doc", "id:bigint,t:string", [], 2154
    ).drop("reject_reason").collect()
    want = sorted(repr(r) for r in want) + ["single"]
    for layout, ddl in (("ranges", "id:bigint,t:string"), ("document", "id:bigint,t:string"), ("document", None)):
        layer = geojson.read_geojson(spark, str(folder), ddl, layout=layout)
        assert layer.schema["geom"].metadata["srid"] == 2154
        got = layer.select("id", "t", "geom").collect()
        assert sorted("single" if r.id == 7 and r.t is None and r.geom is None else repr(r) for r in got) == sorted(want)


def test_geojson_ranges_of_broken_documents(spark, tmp_path, small_ranges):
    good = json.dumps(_odd_collection(60))
    cases = {
        "cut": good[: len(good) // 2], "no_brace": good[:-1], "twice": good + good, "closed_early": "}" + good, "text": "no json" * 900,
        "broken": good.replace('"id": 33,', '"id" 33,'),
    }
    for name, text in cases.items():
        path = tmp_path / f"{name}.json"
        path.write_text(text)
        layer = geojson.read_geojson(spark, str(path), "id:bigint", layout="ranges", keep_rejected=True)
        reasons = [r.reject_reason for r in layer.collect() if r.reject_reason]
        assert reasons == (["unreadable feature"] if name == "broken" else ["unreadable document"] if name != "twice" else []), name
        if name == "broken":
            assert layer.where("reject_reason is null").select("id").distinct().count() == 59
            with pytest.raises(Exception, match="unreadable feature"):
                geojson.read_geojson(spark, str(path), "id:bigint", layout="ranges").count()


def test_csv_in_byte_ranges(spark, tmp_path, small_ranges):
    import csv as python_csv

    values = ["plain", "a\nb", "a\r\n,;b", 'say "so"', '"', '""\n""', "", "\n\n\n", 'x" , "y', "é\nü", "x" * 900 + "\n" + "y" * 900]
    rows = [(str(i), values[i % 11], values[(i * 7) % 11], i / 4) for i in range(300)]
    folder = tmp_path / "a b"
    folder.mkdir()
    for name, end, encoding in (("unix.csv", "\n", "utf-8"), ("windows.csv", "\r\n", "utf-8"), ("latin.csv", "\n", "latin-1")):
        with open(folder / name, "w", newline="", encoding=encoding) as file:
            writer = python_csv.writer(file, lineterminator=end)
            writer.writerows([("id", "a\nb", "b", "n"), *rows])
    known = csv_ranges.files(spark, str(folder), ",")
    assert all(len(f.ranges) > 5 and not f.open for f in known) and any(v for f in known for v in f.ranges.values())
    ranged = delimited.read_csv(spark, str(folder), multiline=True)
    assert ranged.columns == ["id", "a\nb", "b", "n"] and dict(ranged.dtypes)["n"] == "double" and dict(ranged.dtypes)["id"] == "int"
    got = sorted(tuple(r) for r in ranged.fillna("").collect())
    assert got == sorted([(int(i), a, b, n) for i, a, b, n in rows] * 3)
    for layout in ("ranges", True):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1m" if layout is True else "3000")
        typed = delimited.read_csv(spark, str(folder), schema="id string, a string, b string, n double", multiline=layout)
        assert sorted(tuple(r) for r in typed.fillna("").collect()) == sorted(rows * 3)


def test_csv_ranges_of_odd_files(spark, tmp_path, small_ranges):
    lines = ['k;v', '1;ab"c', '2;"x"y', '3;"q;""r"""', ';', '', '4;"two', 'lines"', '5;"" ', "6"]
    cases = {"odd": "\n".join(lines), "one": "k;v\n", "none": "", "open": "k;v\n1;\"never\nends\n" + "2;x\n" * 2000}
    for name, text in cases.items():
        path = tmp_path / f"{name}.csv"
        path.write_text(text)
        read = [delimited.read_csv(spark, str(path), ";", "utf-8", schema="k string, v string", multiline=m).collect() for m in ("ranges", True)]
        assert sorted(map(repr, read[0])) == sorted(map(repr, read[1])), name
    with pytest.raises(ValueError, match="unknown multiline"):
        delimited.read_csv(spark, str(tmp_path), multiline="lines")


@pytest.mark.parametrize("delimiter", [",", "||"])
def test_lines_end_inside_quotes_as_a_reader_of_single_characters_says(delimiter):
    import random

    def brute(line, inside):
        state, i = ("quoted" if inside else "begin"), 0
        while i < len(line):
            if state == "quoted" and line[i : i + 2] == '""':
                i += 2
            elif state == "quoted":
                state, i = ("value" if line[i] == '"' else "quoted"), i + 1
            elif line.startswith(delimiter, i):
                state, i = "begin", i + len(delimiter)
            else:
                state, i = ("quoted" if state == "begin" and line[i] == '"' else "value"), i + 1
        return int(state == "quoted")

    kind, rng = csv_ranges._Lines(delimiter), random.Random(5)
    for _ in range(5000):
        line = "".join(rng.choices(['"', "a", delimiter, "\r", "|"], k=rng.randrange(12)))
        for inside in (0, 1):
            assert kind.ends_inside(line.encode(), inside) == brute(line, inside), (line, inside)

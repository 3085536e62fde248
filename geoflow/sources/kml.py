"""KML and KMZ: placemarks with points, lines, polygons and multi-geometries."""

from __future__ import annotations

import html
import io
import itertools
import re
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.layer import GEOM, describe
from ..functions.sql import case, each

BATCH_ROWS = 4096

_RING = "struct<LinearRing:struct<coordinates:string>>"
_POINT, _LINE = "struct<coordinates:string>", "struct<coordinates:string>"
_POLYGON = f"struct<outerBoundaryIs:{_RING},innerBoundaryIs:array<{_RING}>>"
PLACEMARK_DDL = (
    "name string, description string,"
    "ExtendedData struct<Data:array<struct<_name:string,value:string>>>,"
    f"Point {_POINT}, LineString {_LINE}, Polygon {_POLYGON},"
    f"MultiGeometry struct<Point:array<{_POINT}>,LineString:array<{_LINE}>,Polygon:array<{_POLYGON}>>"
)


def _vertices(text: str) -> str:
    """Vertices of a coordinate list ``x,y[,z] x,y[,z] ...``."""
    tuples = f"filter(split(trim({text}), '\\\\s+'), t -> t != '')"
    return each(
        "transform",
        tuples,
        lambda t: G.xy(f"try_cast(get(split({t}, ','), 0) as double)", f"try_cast(get(split({t}, ','), 1) as double)"),
    )


def _polygon_rings(p: str) -> str:
    inner = each("transform", f"{p}.innerBoundaryIs", lambda b: _vertices(f"{b}.LinearRing.coordinates"))
    return f"concat(array({_vertices(f'{p}.outerBoundaryIs.LinearRing.coordinates')}), coalesce({inner}, array()))"


def placemark_geometries() -> str:
    """Geometries of a placemark: one, or one for each kind of member that a multi-geometry has."""
    multi = "MultiGeometry"
    single = case(
        ("Point.coordinates is not null", f"named_struct('type', 'Point', 'parts', array(array({_vertices('Point.coordinates')})))"),
        ("LineString.coordinates is not null", G.line(_vertices("LineString.coordinates"))),
        ("Polygon.outerBoundaryIs is not null", G.polygon(_polygon_rings("Polygon"))),
    )

    def members(kind: str, parts: Callable[[str], str]) -> str:
        made = G.make_geom(f"'Multi{kind}'", each("transform", f"{multi}.{kind}", parts))
        return case((f"size({multi}.{kind}) > 0", made))

    def sequence(m: str) -> str:
        return f"array({_vertices(m + '.coordinates')})"

    kinds = [members("Polygon", _polygon_rings), members("LineString", sequence), members("Point", sequence)]
    return f"filter(array({', '.join([single, *kinds])}), g -> g.type is not null)"


def placemarks_to_layer(placemarks: DataFrame, keep: list[str], geom: str = GEOM) -> DataFrame:
    """``name``, ``description``, ``data`` (map of the extended data) and the geometry.

    A multi-geometry of several kinds of members becomes one row for each kind.
    """
    data = F.expr(
        "map_from_entries(transform(ExtendedData.Data, d -> named_struct('key', d._name, 'value', d.value)))"
    )
    shaped = placemarks.select(*keep, "name", "description", data.alias("data"), F.explode_outer(F.expr(placemark_geometries())).alias(geom))
    return describe(shaped, geom, srid=4326)


def read_kml(spark: SparkSession, path: str, geom: str = GEOM, layer: str | None = None) -> DataFrame:
    """Placemarks of ``.kml`` files through the XML reader; those of one ``layer`` by :func:`parse_kml_files`, a task a file."""
    if layer is not None:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        return parse_kml_files(files, geom, layer).drop("path", "layer")
    rows = spark.read.format("xml").option("rowTag", "Placemark").schema(PLACEMARK_DDL).load(path)
    return placemarks_to_layer(rows, [], geom)


_TOKENS = re.compile(
    r"<(?P<empty>Document|Folder)\b[^>]*/>|<(?P<open>Document|Folder)\b[^>]*>|</(?P<close>Document|Folder)\s*>"
    r"|<Style\b.*?</Style\s*>|<Placemark\b[^>]*/>|(?P<mark><Placemark\b.*?</Placemark\s*>)|<name\b[^>]*>(?P<name>.*?)</name\s*>",
    re.DOTALL,
)


def _plain(text: str) -> str:
    text = text.strip()
    return text[9:-3] if text.startswith("<![CDATA[") and text.endswith("]]>") else html.unescape(text)


def _fragments(content: bytes) -> Iterator[tuple[str | None, str]]:
    """(name of the innermost folder or document that has one, text) of the placemarks in a KML file or a zipped one."""
    if content[:2] == b"PK":
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            texts = [archive.read(n).decode("utf-8", "replace") for n in archive.namelist() if n.lower().endswith(".kml")]
    else:
        texts = [content.decode("utf-8", "replace")]
    for text in texts:
        names: list[str | None] = []
        for found in _TOKENS.finditer(text):
            if found["open"]:
                names.append(None)
            elif found["close"]:
                del names[-1:]
            elif found["mark"]:
                yield next((n for n in reversed(names) if n is not None), None), found["mark"]
            elif found["name"] is not None and names and names[-1] is None:
                names[-1] = _plain(found["name"])


def parse_kml_files(files: DataFrame, geom: str = GEOM, layer: str | None = None) -> DataFrame:
    """Placemarks of KML or KMZ files given as ``path, content`` rows, with the name of their folder in ``layer``.

    ``layer`` keeps the placemarks of folders of one name; those in folders without a name belong to the folder or
    document around it.
    """

    def fragments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                if content is None:
                    continue
                found = ((path, *f) for f in _fragments(bytes(content)) if layer is None or f[0] == layer)
                while part := list(itertools.islice(found, BATCH_ROWS)):
                    yield pd.DataFrame(part, columns=["path", "layer", "fragment"])

    texts = files.select("path", "content").mapInPandas(fragments, "path string, layer string, fragment string")
    parsed = texts.select("path", "layer", F.from_xml("fragment", PLACEMARK_DDL, {"rowTag": "Placemark"}).alias("p"))
    return placemarks_to_layer(parsed.select("path", "layer", "p.*"), ["path", "layer"], geom)

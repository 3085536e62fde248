"""Small layers from Python coordinates, and the JTS library on the driver as an oracle."""

from __future__ import annotations

from geoflow.functions.geometry import GEOM_DDL
from geoflow.functions.layer import describe

SQUARE = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]
HOLE = [(4, 4), (4, 6), (6, 6), (6, 4), (4, 4)]
C_SHAPE = [(0, 0), (10, 0), (10, 2), (2, 2), (2, 8), (10, 8), (10, 10), (0, 10), (0, 0)]


def box(x0, y0, x1, y1):
    return polygon([(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)])


def _points(ring):
    return [{"x": float(x), "y": float(y)} for x, y in ring]


def polygon(*rings):
    return {"type": "Polygon", "parts": [[_points(r) for r in rings]]}


def multipolygon(*polygons):
    return {"type": "MultiPolygon", "parts": [[_points(r) for r in p] for p in polygons]}


def line(*points):
    return {"type": "LineString", "parts": [[_points(points)]]}


def point(x, y):
    return {"type": "Point", "parts": [[_points([(x, y)])]]}


def multipoint(*points):
    return {"type": "MultiPoint", "parts": [[_points([p])] for p in points]}


def layer(spark, geoms, id_="id", srid=4326):
    """Layer with ids 0, 1, 2... from a list, or with the keys of a dict."""
    items = geoms.items() if isinstance(geoms, dict) else enumerate(geoms)
    kind = "string" if isinstance(geoms, dict) else "bigint"
    return describe(spark.createDataFrame(list(items), f"{id_} {kind}, geom {GEOM_DDL}"), srid=srid)


class Jts:
    """Geometry operations of the JTS jar that ships with Spark."""

    def __init__(self, spark):
        self.jvm = spark._jvm
        self.reader = self.jvm.org.locationtech.jts.io.WKTReader()

    def read(self, geom):
        def ring(r):
            return "(" + ", ".join(f"{p['x']!r} {p['y']!r}" for p in r) + ")"

        def part(p):
            return "(" + ", ".join(ring(r) for r in p) + ")"

        name = geom["type"].upper()
        if name in ("POINT", "LINESTRING"):
            body = ring(geom["parts"][0][0])
        elif name == "POLYGON":
            body = part(geom["parts"][0])
        elif name in ("MULTIPOINT", "MULTILINESTRING"):
            body = "(" + ", ".join(ring(p[0]) for p in geom["parts"]) + ")"
        else:
            body = "(" + ", ".join(part(p) for p in geom["parts"]) + ")"
        return self.reader.read(f"{name} {body}")

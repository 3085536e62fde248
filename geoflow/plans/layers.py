"""Layers derived from the plain tables by formula, written so that any SQL engine gets the same numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.layer import describe
from ..operators.spatial import point_layer

# The text of each layer is shared by Spark and the oracle.
LON = "-4.5e0 + ({id}*7919 % 12000)/CAST(1000 AS DOUBLE)"
LAT = "42.5e0 + ({id}*104729 % 8000)/CAST(1000 AS DOUBLE)"

SITES = f"""select c_custkey site_id, {LON.format(id='c_custkey')} lon, {LAT.format(id='c_custkey')} lat,
       c_nationkey, c_mktsegment, c_acctbal from customer"""
DEPOTS = """select s_suppkey depot_id,
       -4.5e0 + (s_suppkey*6101 % 12000)/CAST(1000 AS DOUBLE) lon,
       42.5e0 + (s_suppkey*3571 % 8000)/CAST(1000 AS DOUBLE) lat, s_acctbal from supplier"""
ZONES = """select n_nationkey zone_id, n_name, n_regionkey,
       -4.5e0 + 2.4e0*(n_nationkey % 5) xmin, 42.5e0 + 1.6e0*CAST(floor(n_nationkey/5) AS INT) ymin,
       -4.5e0 + 2.4e0*(n_nationkey % 5 + 1) xmax, 42.5e0 + 1.6e0*(CAST(floor(n_nationkey/5) AS INT)+1) ymax
       from nation"""
PARCELS = f"""select p_partkey parcel_id, p_brand, {LON.format(id='p_partkey')} cx, {LAT.format(id='p_partkey')} cy,
       p_size/CAST(1000 AS DOUBLE) half from part"""
PIXELS = """select l_orderkey % 400 r, l_partkey % 600 c, round(avg(l_quantity),6) v
       from lineitem group by l_orderkey % 400, l_partkey % 600"""
ROUTES = f"""select o.o_orderkey route_id, s.lon x1, s.lat y1, d.lon x2, d.lat y2
       from orders o join ({SITES}) s on s.site_id = o.o_custkey
       join ({DEPOTS}) d on d.depot_id = o.o_orderkey % (select count(*) from supplier)"""
MOVES = f"""select user_id, event_id, value, {LON.format(id='event_id')} lon, {LAT.format(id='event_id')} lat
       from events"""
# short lines, two vertices each
STREETS = f"""select o_orderkey street_id, {LON.format(id='o_orderkey')} x1, {LAT.format(id='o_orderkey')} y1,
       {LON.format(id='o_orderkey')} + ((o_orderkey*31 % 81) - 40)/CAST(1000 AS DOUBLE) x2,
       {LAT.format(id='o_orderkey')} + ((o_orderkey*17 % 61) - 30)/CAST(1000 AS DOUBLE) y2 from orders"""
# lattice squares that share edges and corners, from customer numbers
PLOTS = """select c_custkey plot_id, c_mktsegment, c_nationkey,
       (c_custkey % 60)*0.125e0 xmin, CAST(floor(c_custkey/60) AS INT)*0.125e0 ymin,
       (c_custkey % 60 + 1)*0.125e0 xmax, (CAST(floor(c_custkey/60) AS INT) + 1)*0.125e0 ymax from customer"""
# right triangles
WEDGES = f"""select p_partkey wedge_id, p_size, {LON.format(id='p_partkey')} cx, {LAT.format(id='p_partkey')} cy,
       p_size/CAST(1000 AS DOUBLE) leg from part"""

# lines of four vertices that cross themselves, none of whose edges is parallel to an axis
PATHS = f"""select c_custkey path_id, c_mktsegment,
       {LON.format(id='c_custkey')} + (c_custkey*7907 % 9973)/CAST(10000000 AS DOUBLE) x,
       {LAT.format(id='c_custkey')} + (c_custkey*6007 % 9967)/CAST(10000000 AS DOUBLE) y,
       ((c_custkey*31 % 37) + 5)/CAST(100 AS DOUBLE) a, ((c_custkey*17 % 29) + 4)/CAST(100 AS DOUBLE) b from customer"""

_NEEDS = {
    "paths": ["customer"],
    "plots": ["customer"], "wedges": ["part"], "sites": ["customer"], "depots": ["supplier"], "zones": ["nation"], "parcels": ["part"], "pixels": ["lineitem"],
    "routes": ["orders", "customer", "supplier"], "moves": ["events"], "streets": ["orders"],
}
LAYER_SQL = {
    "sites": SITES, "depots": DEPOTS, "zones": ZONES, "parcels": PARCELS, "pixels": PIXELS, "routes": ROUTES,
    "moves": MOVES, "streets": STREETS, "plots": PLOTS, "wedges": WEDGES, "paths": PATHS,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def layer_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The layer as plain columns, without geometry."""
    views = {t: table(spark, sf_dir, t) for t in _NEEDS[name]}
    text = LAYER_SQL[name]
    for t in views:
        text = text.replace(f"from {t}", f"from {{{t}}}").replace(f"join {t}", f"join {{{t}}}")
    return spark.sql(text, **views)


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return point_layer(layer_table(spark, sf_dir, "sites"), "lon", "lat")


def depots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return point_layer(layer_table(spark, sf_dir, "depots"), "lon", "lat")


def moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return point_layer(layer_table(spark, sf_dir, "moves"), "lon", "lat")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = layer_table(spark, sf_dir, "zones")
    return describe(df.withColumn("geom", F.expr(G.rectangle("xmin", "ymin", "xmax", "ymax"))), srid=4326)


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = layer_table(spark, sf_dir, "parcels")
    box = G.rectangle("cx - half", "cy - half", "cx + half", "cy + half")
    return describe(df.withColumn("geom", F.expr(box)), srid=4326)


def two_point_lines(df: DataFrame) -> DataFrame:
    return describe(df.withColumn("geom", F.expr(G.line([G.xy("x1", "y1"), G.xy("x2", "y2")]))), srid=4326)


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_point_lines(layer_table(spark, sf_dir, "routes"))


def streets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_point_lines(layer_table(spark, sf_dir, "streets"))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raster cells with the coordinates of their centres over the extent of the zones."""
    df = layer_table(spark, sf_dir, "pixels")
    return point_layer(df, "(-4.5e0 + (c + 0.5e0)*0.02e0)", "(42.5e0 + (r + 0.5e0)*0.02e0)")


def plots(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = layer_table(spark, sf_dir, "plots")
    return describe(df.withColumn("geom", F.expr(G.rectangle("xmin", "ymin", "xmax", "ymax"))), srid=4326)


def wedges(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = layer_table(spark, sf_dir, "wedges")
    ring = ", ".join([G.xy("cx", "cy"), G.xy("cx + leg", "cy"), G.xy("cx", "cy + 2 * leg"), G.xy("cx", "cy")])
    return describe(df.withColumn("geom", F.expr(G.polygon(f"array(array({ring}))"))), srid=4326)


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = layer_table(spark, sf_dir, "paths")
    corners = [G.xy("x", "y"), G.xy("x + a", "y + b"), G.xy("x + 0.9D * a", "y"), G.xy("x + 0.1D * a", "y + 0.95D * b")]
    return describe(df.withColumn("geom", F.expr(G.line(corners))), srid=4326)


def turned(layer: DataFrame) -> DataFrame:
    """The layer turned by 45 degrees and stretched by the root of 2, so that no edge is parallel to an axis."""
    moved = G.map_vertices("geom", [lambda v: G.xy(f"{v}.x - {v}.y", f"{v}.x + {v}.y")])
    return describe(layer.withColumn("geom", F.expr(moved)), srid=4326)

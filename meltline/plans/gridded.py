"""Queries on scenes, points, boxes, polygons and grids."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..config import Config
from ..functions import grid, scalars
from ..operators import spatial
from ..sources import readers
from . import domain as d
from .registry import query, rounded

SCENES = """items AS (SELECT o_orderkey % 3000 AS abs_orbit, o_orderdate AS datetime, o_orderkey, CAST(o_custkey % 175 AS INT) AS rel_orbit, CASE WHEN o_orderkey % 2 = 0 THEN 'ascending' ELSE 'descending' END AS orbit_state,
  CAST(o_custkey % 90 AS DOUBLE) AS "left", CAST(o_custkey % 90 + 5 AS DOUBLE) AS "right", CAST(o_custkey % 70 AS DOUBLE) AS bottom, CAST(o_custkey % 70 + 4 AS DOUBLE) AS top FROM orders)"""


def _items(spark, sf_dir):
    o, c = d.table(spark, sf_dir, "orders"), F.col("o_custkey")
    return o.select(
        (F.col("o_orderkey") % 3000).alias("abs_orbit"), F.col("o_orderdate").alias("datetime"), "o_orderkey", (c % 175).cast("int").alias("rel_orbit"),
        F.when(F.col("o_orderkey") % 2 == 0, "ascending").otherwise("descending").alias("orbit_state"), (c % 90).cast("double").alias("left"),
        (c % 90 + 5).cast("double").alias("right"), (c % 70).cast("double").alias("bottom"), (c % 70 + 4).cast("double").alias("top"),
    )


@query("s01_search_scenes", "WITH " + SCENES + """ SELECT abs_orbit, o_orderkey, datetime FROM items WHERE "left" <= 30 AND "right" >= 10 AND bottom <= 40 AND top >= 20 AND datetime >= TIMESTAMP '1996-01-01' AND datetime < TIMESTAMP '1998-01-01'""")
def search_scenes(spark, sf_dir):
    return readers.search_scenes(_items(spark, sf_dir), (10, 20, 30, 40), "1996-01-01", "1997-12-31").select("abs_orbit", "o_orderkey", "datetime")


@query("a01_first_scenes", "WITH " + SCENES + " SELECT abs_orbit, datetime, o_orderkey, rel_orbit, orbit_state FROM items QUALIFY row_number() OVER (PARTITION BY abs_orbit ORDER BY datetime, o_orderkey) = 1")
def first_scenes(spark, sf_dir):
    return readers.first_scenes(_items(spark, sf_dir)).select("abs_orbit", "datetime", "o_orderkey", "rel_orbit", "orbit_state")


@query("s02_mosaic", """WITH o AS (SELECT l_orderkey % 500 AS abs_orbit, CAST(l_suppkey % 10 AS INT) AS y, CAST(l_partkey % 10 AS INT) AS x, l_shipdate AS time, CASE WHEN l_quantity > 5 THEN l_extendedprice END AS vv, CASE WHEN l_quantity > 10 THEN l_tax END AS vh FROM lineitem)
  SELECT abs_orbit, y, x, min(time) AS time, arg_min(vv, {'t': time, 'v': vv}) FILTER (WHERE vv IS NOT NULL) AS vv, arg_min(vh, {'t': time, 'v': vh}) FILTER (WHERE vh IS NOT NULL) AS vh FROM o GROUP BY 1, 2, 3""")
def mosaic(spark, sf_dir):
    line = d.table(spark, sf_dir, "lineitem")
    rows = line.select(
        (F.col("l_orderkey") % 500).alias("abs_orbit"), (F.col("l_suppkey") % 10).cast("int").alias("y"), (F.col("l_partkey") % 10).cast("int").alias("x"), F.col("l_shipdate").alias("time"),
        F.when(F.col("l_quantity") > 5, F.col("l_extendedprice")).otherwise(-32768.0).alias("vv"), F.when(F.col("l_quantity") > 10, F.col("l_tax")).otherwise(float("nan")).alias("vh"),
    )
    return readers.mosaic(rows)


@query("s03_observations", "SELECT user_id, count(*) AS n, min(wy) AS wy, CAST(max(dowy) AS INT) AS dowy FROM (SELECT user_id, CAST(year(ts) + (month(ts) >= 10)::INT AS INT) AS wy, date_diff('day', make_date(year(ts) + (month(ts) >= 10)::INT - 1, 10, 1), ts::DATE) + 1 AS dowy FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21') GROUP BY 1")
def observations(spark, sf_dir):
    """S-03 over the events: a closed range of days that reaches the scan."""
    from ..functions.dates import day_of_water_year, water_year

    rows = d.table(spark, sf_dir, "events").where("ts >= TIMESTAMP_NTZ '2024-01-05' AND ts < TIMESTAMP_NTZ '2024-01-21'")
    return rows.groupBy("user_id").agg(F.count("*").alias("n"), F.min(water_year("ts")).alias("wy"), F.max(day_of_water_year("ts")).alias("dowy"))


BOXES = """boxes AS (SELECT CAST(s_suppkey AS INT) AS id, CAST(s_suppkey % 10 AS DOUBLE) * 3 AS "left", CAST(s_suppkey % 10 AS DOUBLE) * 3 + 2 AS "right", CAST(s_suppkey // 10 % 10 AS DOUBLE) * 2 AS bottom, CAST(s_suppkey // 10 % 10 AS DOUBLE) * 2 + 1.5 AS top FROM supplier),
pts AS (SELECT CAST(c_custkey % 97 AS DOUBLE) / 3 AS lon, CAST(c_custkey % 89 AS DOUBLE) / 4 AS lat FROM customer WHERE c_custkey % 10 = 0)"""


def _boxes(spark, sf_dir):
    s = F.col("s_suppkey")
    a, b = (s % 10).cast("double") * 3, (F.floor(s / 10) % 10).cast("double") * 2
    return d.table(spark, sf_dir, "supplier").select(s.cast("int").alias("id"), a.alias("left"), b.alias("bottom"), (a + 2).alias("right"), (b + 1.5).alias("top"))


@query("j10_boxes_with_points", "WITH " + BOXES + """ SELECT id FROM boxes b WHERE EXISTS (SELECT 1 FROM pts WHERE lon > "left" AND lon < "right" AND lat > bottom AND lat < top)""")
def boxes_with_points(spark, sf_dir):
    c = F.col("c_custkey")
    points = d.table(spark, sf_dir, "customer").select(((c % 97).cast("double") / 3).alias("lon"), ((c % 89).cast("double") / 4).alias("lat"))
    return spatial.boxes_with_points(_boxes(spark, sf_dir), points, 2.0).select("id")


@query("j12_boxes_without_boxes", "WITH " + BOXES + """ SELECT a.id FROM boxes a WHERE NOT EXISTS (SELECT 1 FROM (VALUES (2.0::DOUBLE, 3.0::DOUBLE, 8.0::DOUBLE, 9.0::DOUBLE), (20.0, 0.0, 21.0, 30.0)) AS o(l, b, r, t) WHERE a."left" <= r AND a."right" >= l AND a.bottom <= t AND a.top >= b)""")
def boxes_without_boxes(spark, sf_dir):
    others = spark.createDataFrame([(2.0, 3.0, 8.0, 9.0), (20.0, 0.0, 21.0, 30.0)], "left double, bottom double, right double, top double")
    return spatial.boxes_without_boxes(_boxes(spark, sf_dir), others, 2.0).select("id")


def _points(spark, sf_dir):
    p = F.col("p_partkey")
    return d.table(spark, sf_dir, "part").select(p.alias("id"), ((p % 101).cast("double") / 10).alias("lon"), ((p % 73).cast("double") / 10).alias("lat"), F.col("p_size").alias("v"))


POINTS = "pts AS (SELECT p_partkey AS id, CAST(p_partkey % 101 AS DOUBLE) / 10 AS lon, CAST(p_partkey % 73 AS DOUBLE) / 10 AS lat, p_size AS v FROM part)"
#: A concave polygon whose edges run between the points, and a box inside its bay.
POLYGONS = [(1, [(1.05, 1.05), (9.05, 1.05), (9.05, 6.05), (6.05, 6.05), (6.05, 3.05), (4.05, 3.05), (4.05, 6.05), (1.05, 6.05)]), (2, [(4.55, 3.55), (5.55, 3.55), (5.55, 5.55), (4.55, 5.55)])]
INSIDE = """inside AS (SELECT *, CASE WHEN lon > 1.05 AND lon < 9.05 AND lat > 1.05 AND lat < 6.05 AND NOT (lon > 4.05 AND lon < 6.05 AND lat > 3.05) THEN 1::BIGINT WHEN lon > 4.55 AND lon < 5.55 AND lat > 3.55 AND lat < 5.55 THEN 2::BIGINT END AS polygon_id FROM pts)"""


@query("j15_j16_in_polygons", "WITH " + POINTS + "," + INSIDE + " SELECT id, polygon_id FROM inside WHERE polygon_id IS NOT NULL")
def in_polygons(spark, sf_dir):
    return spatial.in_polygons(_points(spark, sf_dir), POLYGONS).select("id", "polygon_id")


@query("a35_zonal_mean", "WITH " + POINTS + "," + INSIDE + " SELECT polygon_id, round(avg(v), 6) AS mean_v FROM inside WHERE polygon_id IS NOT NULL GROUP BY 1")
def zonal_mean(spark, sf_dir):
    return rounded(spatial.zonal_mean(_points(spark, sf_dir), POLYGONS, "v"))


@query("f13_clip_box", "WITH " + POINTS + " SELECT id FROM pts WHERE lon BETWEEN 2 AND 4 AND lat BETWEEN 1 AND 3.5")
def clip_box(spark, sf_dir):
    return spatial.clipped(_points(spark, sf_dir), 2, 1, 4, 3.5).select("id")


@query("j16_enum_codes", "SELECT CAST(row_number() OVER (ORDER BY c_mktsegment) - 1 AS INT) AS code, c_mktsegment FROM (SELECT DISTINCT c_mktsegment FROM customer)")
def enum_codes(spark, sf_dir):
    return spatial.enum_codes(d.table(spark, sf_dir, "customer"), "c_mktsegment")


@query("j17_class_fractions", """WITH f AS (SELECT p_partkey % 20 AS tile, p_size % 9 AS class, count(*) AS n FROM part GROUP BY 1, 2)
  SELECT tile, class, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY tile), 6) AS frac, round(100 * sum(CASE WHEN class IN (1, 2, 3, 5, 6, 7) THEN n ELSE 0 END) OVER (PARTITION BY tile) / sum(n) OVER (PARTITION BY tile), 6) AS percent FROM f""")
def class_fractions(spark, sf_dir):
    """J-17, E-33."""
    cells = d.table(spark, sf_dir, "part").select((F.col("p_partkey") % 20).alias("tile"), (F.col("p_size") % 9).alias("class"))
    got = spatial.class_fractions(cells).withColumn("percent", scalars.valid_percent("unique", "frac"))
    return rounded(got.select("tile", "percent", F.explode(F.arrays_zip("unique", "frac")).alias("z")).select("tile", F.col("z.unique").alias("class"), F.col("z.frac").alias("frac"), "percent"))


@query("j18_within_radius", """WITH c AS (SELECT s_suppkey AS station, CAST(s_suppkey * 37 % 1000 AS DOUBLE) AS cx, CAST(s_suppkey * 91 % 1000 AS DOUBLE) AS cy FROM supplier), p AS (SELECT p_partkey AS id, CAST(p_partkey * 17 % 1009 AS DOUBLE) AS px, CAST(p_partkey * 29 % 997 AS DOUBLE) AS py FROM part)
  SELECT station, id, round(sqrt((px - cx) * (px - cx) + (py - cy) * (py - cy)), 6) AS dist_m FROM c JOIN p ON (px - cx) * (px - cx) + (py - cy) * (py - cy) <= 50.0 * 50.0""")
def within_radius(spark, sf_dir):
    s, p = F.col("s_suppkey"), F.col("p_partkey")
    centres = d.table(spark, sf_dir, "supplier").select(s.alias("station"), (s * 37 % 1000).cast("double").alias("cx"), (s * 91 % 1000).cast("double").alias("cy"))
    points = d.table(spark, sf_dir, "part").select(p.alias("id"), (p * 17 % 1009).cast("double").alias("px"), (p * 29 % 997).cast("double").alias("py"))
    return spatial.within_radius(centres, points, 50.0, digits=6).select("station", "id", "dist_m")


@query("j04_j07_nearest_cell", "WITH " + POINTS + " SELECT id, CAST(round_even((7.3 - lat) / 0.35::DOUBLE - 0.5, 0) AS INT) AS y, CAST(round_even((lon - 0.0) / 0.35::DOUBLE - 0.5, 0) AS INT) AS x FROM pts")
def nearest_cell(spark, sf_dir):
    return spatial.nearest_cell(_points(spark, sf_dir), 7.3, 0.0, 0.35).select("id", "y", "x")


#: A grid of 50 columns from the parts.
GRID = "g AS (SELECT CAST(p_partkey // 50 AS INT) AS y, CAST(p_partkey % 50 AS INT) AS x, p_size % 7 AS value, CAST(p_retailprice AS DOUBLE) AS dem FROM part)"


def _grid(spark, sf_dir):
    k = F.col("p_partkey")
    return d.table(spark, sf_dir, "part").select(F.floor(k / 50).cast("int").alias("y"), (k % 50).cast("int").alias("x"), (F.col("p_size") % 7).alias("value"), F.col("p_retailprice").cast("double").alias("dem"))


@query("j06_resampled_mode", "WITH " + GRID + " SELECT CAST(y4 AS INT) AS y, CAST(x4 AS INT) AS x, value FROM (SELECT y // 4 AS y4, x // 4 AS x4, value, row_number() OVER (PARTITION BY y // 4, x // 4 ORDER BY count(*) DESC, value) AS k FROM g GROUP BY 1, 2, 3) WHERE k = 1")
def resampled_mode(spark, sf_dir):
    return spatial.resampled_mode(_grid(spark, sf_dir), 4).select("y", "x", "value")


@query("j05_resampled_bilinear", "WITH " + GRID + """, t AS (SELECT CAST(ty AS INT) AS ty, CAST(tx AS INT) AS tx, ty * 1.5::DOUBLE + 0.25 AS sy, tx * 1.5::DOUBLE + 0.5 AS sx FROM range(0, 20) AS a(ty) CROSS JOIN range(0, 34) AS b(tx)),
  w AS (SELECT ty, tx, dem, (1 - abs(g.y - sy)) * (1 - abs(g.x - sx)) AS w FROM t JOIN g ON abs(g.y - sy) < 1 AND abs(g.x - sx) < 1)
  SELECT t.ty, t.tx, round(v, 6) AS value FROM t LEFT JOIN (SELECT ty, tx, sum(w * dem) / sum(w) AS v FROM w GROUP BY 1, 2) q ON q.ty = t.ty AND q.tx = t.tx""")
def resampled_bilinear(spark, sf_dir):
    """The template covers every row of the grid, and 20 rows at least."""
    last = _grid(spark, sf_dir).agg(F.max("y")).first()[0] or 0
    rows = max(20, math.ceil((last + 0.75) / 1.5))
    cells = spark.range(rows * 34).select((F.col("id") / 34).cast("int").alias("ty"), (F.col("id") % 34).cast("int").alias("tx"))
    cells = cells.withColumns({"sy": F.col("ty") * 1.5 + 0.25, "sx": F.col("tx") * 1.5 + 0.5})
    return rounded(spatial.resampled_bilinear(cells, _grid(spark, sf_dir).select("y", "x", F.col("dem").alias("value"))))


@query("e29_terrain", "WITH " + GRID + """, n AS (SELECT a.y, a.x, count(*) AS n, sum(b.dem * (b.x - a.x) * (2 - abs(b.y - a.y))) / 800 AS gx, sum(b.dem * (a.y - b.y) * (2 - abs(b.x - a.x))) / 800 AS gy
    FROM g a JOIN g b ON abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 GROUP BY 1, 2)
  SELECT y, x, round(CASE WHEN n = 9 THEN degrees(atan(sqrt(gx * gx + gy * gy))) END, 4) AS slope FROM n""")
def terrain(spark, sf_dir):
    got = spatial.terrain(_grid(spark, sf_dir), 100.0)
    return got.select("y", "x", F.round("slope", 4).alias("slope"))


@query("grid_tiles", "SELECT count(*) AS n, max(r) AS max_row, max(c) AS max_col FROM (SELECT CAST(i // 245 AS INT) AS r, CAST(i % 245 AS INT) AS c FROM range(0, 23520) AS t(i))")
def grid_tiles(spark, sf_dir):
    """The global tile grid."""
    return grid.tiles(spark, Config()).agg(F.count("*").alias("n"), F.max("row").alias("max_row"), F.max("col").alias("max_col"))


@query("e27_coordinates", "SELECT p_partkey, round(81.099 - (CAST(p_partkey // 50 AS INT) + 0.5) * 0.00072::DOUBLE, 6) AS original_lat, round(-179.999 + (p_partkey % 50 + 0.5) * 0.00072::DOUBLE, 6) AS original_lon FROM part")
def coordinates(spark, sf_dir):
    from ..operators.mart import with_coordinates

    k = F.col("p_partkey")
    cells = d.table(spark, sf_dir, "part").select("p_partkey", F.floor(k / 50).cast("int").alias("y"), (k % 50).cast("int").alias("x"))
    return rounded(with_coordinates(cells, 81.099, -179.999, 0.00072).select("p_partkey", "original_lat", "original_lon"))

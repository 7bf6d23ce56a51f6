"""Queries on the tile catalogue and the result log."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, scalars
from ..operators import catalog, stats
from . import domain as d
from .registry import query, rounded

W = "WITH " + d.TILES
LAST = """,
last AS (SELECT * FROM results QUALIFY row_number() OVER (PARTITION BY "row", col ORDER BY sequence DESC) = 1),
cat AS (SELECT coalesce(t."row", l."row") AS "row", coalesce(t.col, l.col) AS col, percent_valid_snow_pixels, success, start_time, sequence, total_time
  FROM (SELECT * FROM tiles WHERE "row" <> 3) t FULL JOIN (SELECT * FROM last WHERE col <> 5) l ON t."row" = l."row" AND t.col = l.col)"""


def _catalogue(spark, sf_dir):
    return catalog.catalogue(d.tiles(spark, sf_dir), d.results(spark, sf_dir))


@query("j08_catalogue", W + LAST + " SELECT * FROM cat")
def catalogue(spark, sf_dir):
    """J-08 with W-11: full outer join of tiles and their last results."""
    return _catalogue(spark, sf_dir)


@query("w11_keep_last", W + ' SELECT * FROM results QUALIFY row_number() OVER (PARTITION BY "row", col ORDER BY sequence DESC) = 1')
def keep_last(spark, sf_dir):
    return catalog.keep_last(d.results(spark, sf_dir), "sequence")


@query("w12_keep_last_started", W + ' SELECT * FROM results QUALIFY row_number() OVER (PARTITION BY "row", col, success ORDER BY start_time DESC NULLS FIRST, sequence DESC) = 1')
def keep_last_started(spark, sf_dir):
    return catalog.keep_last_started(d.results(spark, sf_dir))


@query("w13_keep_first", W + ' SELECT * FROM results QUALIFY row_number() OVER (PARTITION BY "row", col ORDER BY sequence) = 1')
def keep_first(spark, sf_dir):
    return catalog.keep_first(d.results(spark, sf_dir), "sequence")


@query("w14_distinct_tiles", W + ' SELECT DISTINCT "row", col FROM results')
def distinct_tiles(spark, sf_dir):
    return catalog.distinct_tiles(d.results(spark, sf_dir))


def _status(which: str, condition: str):
    @query(f"f07_{which}", W + LAST + f' SELECT "row", col, percent_valid_snow_pixels FROM cat WHERE {condition}')
    def run(spark, sf_dir):
        return catalog.select(_catalogue(spark, sf_dir), which).select("row", "col", "percent_valid_snow_pixels")

    return run


for _which, _condition in (("all", "true"), ("processed", "success"), ("failed", "NOT success"), ("unprocessed", "success IS NULL"), ("unprocessed_and_failed", "success IS NULL OR NOT success")):
    _status(_which, _condition)


@query("f07_j11_weather_stations", W + LAST + ' SELECT "row", col FROM cat WHERE (success IS NULL OR NOT success) AND ("row", col) IN (SELECT CAST(s_suppkey % 50 AS INT), CAST(s_suppkey % 40 AS INT) FROM supplier)')
def station_tiles(spark, sf_dir):
    s = d.table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 50).cast("int").alias("row"), (F.col("s_suppkey") % 40).cast("int").alias("col"))
    return catalog.select(_catalogue(spark, sf_dir), "unprocessed_and_failed_weather_stations", s).select("row", "col")


@query("o02_o03_top_tiles", W + ' SELECT * FROM tiles ORDER BY percent_valid_snow_pixels DESC NULLS LAST, "row", col LIMIT 25')
def top_tiles(spark, sf_dir):
    return catalog.page(d.tiles(spark, sf_dir), how_many=25)


@query("o04_page", W + ' SELECT * FROM tiles ORDER BY percent_valid_snow_pixels DESC NULLS LAST, "row", col LIMIT 16 OFFSET 32')
def page(spark, sf_dir):
    return catalog.page(d.tiles(spark, sf_dir), batch=2, size=16)


@query("o05_batches", W + ' SELECT *, CAST((row_number() OVER (ORDER BY percent_valid_snow_pixels DESC NULLS LAST, "row", col) - 1) // 10 AS BIGINT) AS batch FROM tiles')
def batches(spark, sf_dir):
    return catalog.batches(d.tiles(spark, sf_dir))


@query("o07_sorted_log", W + " SELECT sequence, start_time FROM results ORDER BY start_time, sequence")
def sorted_log(spark, sf_dir):
    return catalog.sorted_log(d.results(spark, sf_dir).select("sequence", "start_time"))


@query("a24_batch_info", W + " SELECT count(*) AS total, CAST(ceil(count(*) / 16) AS BIGINT) AS batches FROM tiles")
def batch_info(spark, sf_dir):
    return catalog.batch_info(d.tiles(spark, sf_dir), 16).select("total", "batches")


@query("a23_result_statistics", W + " SELECT count(*) AS total, count(*) FILTER (WHERE success) AS successes, count(*) FILTER (WHERE success IS DISTINCT FROM true) AS failures, round(100.0::DOUBLE * count(*) FILTER (WHERE success) / count(*), 6) AS success_rate FROM results")
def result_statistics(spark, sf_dir):
    return rounded(catalog.result_statistics(d.results(spark, sf_dir)))


@query("a22_volume", "SELECT CAST(sum(l_linenumber) AS BIGINT) AS scenes, round(sum(l_linenumber) * 0.0156::DOUBLE, 6) AS gigabytes FROM lineitem")
def volume(spark, sf_dir):
    """A-22, E-32."""
    printed = F.concat(F.lit("{'time': "), F.col("l_linenumber").cast("string"), F.lit(", 'latitude': 2048}"))
    return rounded(catalog.volume(d.table(spark, sf_dir, "lineitem").select(printed.alias("s1_rtc_ds_dims"))))


@query("j09_missing_files", W + """ SELECT "row", col, printf('tile_%03d_%03d.parquet', "row", col) AS filename FROM tiles WHERE "row" % 3 <> 0""")
def missing_files(spark, sf_dir):
    """J-09, E-31, S-17, U-06."""
    tiles = d.tiles(spark, sf_dir)
    there = tiles.where("row % 3 = 0").select(scalars.tile_name("row", "col").alias("filename"))
    return catalog.missing_files(tiles, there).select("row", "col", "filename")


@query("j20_common_tiles", W + ' SELECT DISTINCT "row", col FROM results WHERE success AND sequence % 2 = 0 INTERSECT SELECT "row", col FROM results WHERE success AND sequence % 2 = 1')
def common(spark, sf_dir):
    """J-20, U-04."""
    r = d.results(spark, sf_dir)
    return catalog.common(r.where("sequence % 2 = 0"), r.where("sequence % 2 = 1"))


@query("j22_percent_of", W + ' SELECT max(percent_valid_snow_pixels) AS percent_valid_snow_pixels FROM tiles WHERE "row" = 7 AND col = 27')
def percent_of(spark, sf_dir):
    return catalog.percent_of(d.tiles(spark, sf_dir), 7, 27)


@query("j14_left_join", W + ' SELECT t."row", t.col, count(r.sequence) AS n FROM tiles t LEFT JOIN (SELECT * FROM results WHERE success) r ON t."row" = r."row" AND t.col = r.col GROUP BY 1, 2')
def left_join(spark, sf_dir):
    return catalog.counted_results(d.tiles(spark, sf_dir), d.results(spark, sf_dir).where("success"))


@query("u02_consolidated", W + ' SELECT * FROM results WHERE sequence % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY "row", col, success ORDER BY start_time DESC NULLS FIRST, sequence DESC) = 1')
def consolidated(spark, sf_dir):
    """U-02, U-03, W-12."""
    r = d.results(spark, sf_dir)
    return catalog.consolidated(r.where("NOT sequence % 3 <=> 2"), r.where("sequence % 3 = 2"))


@query("u05_not_completed", W + ' SELECT * FROM tiles t WHERE NOT EXISTS (SELECT 1 FROM results r WHERE success AND total_time > 400000 AND r."row" = t."row" AND r.col = t.col)')
def not_completed(spark, sf_dir):
    return catalog.not_completed(d.tiles(spark, sf_dir), d.results(spark, sf_dir).where("success AND total_time > 400000"))


@query("f08_percent_threshold", W + ' SELECT * FROM tiles WHERE percent_valid_snow_pixels > 5000')
def percent_threshold(spark, sf_dir):
    return catalog.over_threshold(d.tiles(spark, sf_dir), 5000)


@query("e28_unix_seconds", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(epoch_us(o_orderdate) AS DOUBLE) / 1e6 END AS start FROM orders")
def unix_seconds(spark, sf_dir):
    t = F.col("o_orderdate")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.date_format(t, "yyyy-MM-dd HH:mm:ss")).when(F.col("o_orderkey") % 3 == 1, dates.micros(t).cast("double").__truediv__(1e6).cast("string")).otherwise("nan?")
    return d.table(spark, sf_dir, "orders").select("o_orderkey", dates.unix_seconds(text).alias("start"))


@query("a36_histogram", W + """ , e AS (SELECT min(total_time) AS lo, max(total_time) AS hi FROM results)
  SELECT CAST(least(floor((total_time - lo) / ((hi - lo) / 20)), 19) AS INT) AS bin, count(*) AS n FROM results, e GROUP BY 1""")
def histogram(spark, sf_dir):
    return stats.histogram(d.results(spark, sf_dir), "total_time", 20)


@query("a34_value_counts", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def value_counts(spark, sf_dir):
    return stats.value_counts(d.table(spark, sf_dir, "orders"), "o_orderpriority")


@query("t02_latest_results", "SELECT user_id, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def event_totals(spark, sf_dir):
    """Batch side of the streaming result log."""
    e = d.table(spark, sf_dir, "events")
    return e.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("t04_tumbling_windows", """SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total, CAST(sum(CAST(props->>'$.k' AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY 1, 2""")
def tumbling(spark, sf_dir):
    e = d.table(spark, sf_dir, "events")
    got = e.groupBy(F.window(F.col("ts"), "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), F.sum(F.get_json_object("props", "$.k").cast("long")).alias("k"))
    return got.select(F.col("w.start").alias("window_start"), "event_type", "n", "total", "k")

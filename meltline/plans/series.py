"""Queries on station series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stations, stats
from . import domain as d
from .registry import query, rounded

W = "WITH " + d.SWE
STATION, YEAR = "PARTITION BY station ORDER BY date", "PARTITION BY station, wy ORDER BY date"
PCT = ", ".join(f"max(CASE WHEN swe >= {p}::DOUBLE * top THEN dowy END) AS dowy_{round(p * 100)}" for p in stations.PERCENTS)
TIMING = f""", tops AS (SELECT *, max(swe) OVER (PARTITION BY station, wy) AS top FROM swe),
times AS (SELECT station, wy, max(swe) AS max_swe, CAST(max({{'v': swe, 'd': dowy}}) FILTER (WHERE swe IS NOT NULL)['d'] AS BIGINT) AS dowy_max, {PCT} FROM tops GROUP BY 1, 2)"""


@query("w02_jump_mask", W + f""" SELECT station, date, round(CASE WHEN coalesce(abs(l1 - l2) < 0.2 AND abs(n1 - swe) < 0.2, false) THEN swe END, 6) AS swe FROM
  (SELECT *, lag(swe, 1) OVER w AS l1, lag(swe, 2) OVER w AS l2, lead(swe) OVER w AS n1, row_number() OVER w AS i FROM swe WINDOW w AS ({STATION})) WHERE i > 1""")
def jump_mask(spark, sf_dir):
    """W-02, J-19, E-18."""
    return rounded(stations.jump_mask(d.swe(spark, sf_dir)).select("station", "date", "swe"))


@query("w03_rolling_mask", W + f""" SELECT station, date, round(CASE WHEN count(*) OVER w = 20 AND count(swe) OVER w >= 15 THEN swe END, 6) AS swe FROM swe WINDOW w AS ({STATION} ROWS BETWEEN 10 PRECEDING AND 9 FOLLOWING)""")
def rolling_mask(spark, sf_dir):
    return rounded(stations.rolling_mask(d.swe(spark, sf_dir), 20, 15).select("station", "date", "swe"))


@query("w04_seasonal_mask", W + f""", deep AS (SELECT *, count(*) OVER w >= 25 AND sum(CASE WHEN swe >= 0.15 THEN 1 ELSE 0 END) OVER w >= 25 AS ok FROM swe WINDOW w AS ({YEAR} ROWS BETWEEN 30 PRECEDING AND 29 FOLLOWING))
  SELECT station, date, round(CASE WHEN bool_or(ok) OVER (PARTITION BY station, wy) THEN swe END, 6) AS swe FROM deep""")
def seasonal_mask(spark, sf_dir):
    return rounded(stations.seasonal_mask(d.swe(spark, sf_dir), days=25, swe=0.15).select("station", "date", "swe"))


COMPLETE = f""", g AS (SELECT station, wy, date, swe, CASE WHEN swe IS NOT NULL THEN date_diff('day', max(CASE WHEN swe IS NOT NULL THEN date END) OVER ({YEAR} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), date) END AS gap FROM swe),
comp AS (SELECT station, wy, count(*) FILTER (WHERE swe IS NULL AND month(date) IN (11, 12, 1, 2, 3)) AS missing_winter, CAST(max(gap) AS INT) AS longest_gap, count(swe) AS n_valid,
  arg_min(swe, date) FILTER (WHERE swe IS NOT NULL) AS first_valid, arg_max(swe, date) FILTER (WHERE swe IS NOT NULL) AS last_valid FROM g GROUP BY 1, 2)"""


@query("w05_w10_completeness", W + COMPLETE + " SELECT station, wy, missing_winter, longest_gap, n_valid, round(first_valid, 6) AS first_valid, round(last_valid, 6) AS last_valid FROM comp")
def completeness(spark, sf_dir):
    """W-05, W-10, E-21, X-05."""
    return rounded(stations.completeness(d.swe(spark, sf_dir)))


@query("w05_complete_mask", W + COMPLETE + """ SELECT s.station, s.date, round(CASE WHEN NOT (missing_winter > 140 OR coalesce(longest_gap, 0) > 25 OR n_valid = 0 OR coalesce(first_valid > 0.4, false) OR coalesce(last_valid > 0.4, false)) THEN s.swe END, 6) AS swe FROM swe s JOIN comp USING (station, wy)""")
def complete_mask(spark, sf_dir):
    return rounded(stations.complete_mask(d.swe(spark, sf_dir), 140, 25, 0.4).select("station", "date", "swe"))


@query("a20_w06_w07_timing", W + TIMING + " SELECT station, wy, round(max_swe, 6) AS max_swe, dowy_max, " + ", ".join(f"dowy_{round(p * 100)}" for p in stations.PERCENTS) + " FROM times")
def timing(spark, sf_dir):
    """A-20, W-06, W-07."""
    got = rounded(stations.timing(d.swe(spark, sf_dir)))
    return got.withColumns({c: F.col(c).cast("long") for c in got.columns if c.startswith("dowy")})


@query("w09_first_peak", W + " SELECT station, wy, arg_min(date, {'v': -swe, 'd': date}) FILTER (WHERE swe IS NOT NULL) AS date_max FROM swe GROUP BY 1, 2")
def first_peak(spark, sf_dir):
    return stations.first_peak(d.swe(spark, sf_dir))


@query("f11_time_slice", W + " SELECT station, date, round(swe, 6) AS swe FROM swe WHERE date BETWEEN DATE '1997-10-01' AND DATE '1998-09-30'")
def time_slice(spark, sf_dir):
    return rounded(stations.time_slice(d.swe(spark, sf_dir), "1997-10-01", "1998-09-30").select("station", "date", "swe"))


PIXELS = """pix AS (SELECT CAST(l_suppkey % 5 AS INT) AS station, CAST(l_partkey % 1000 AS DOUBLE) AS dist_m, CAST(year(l_shipdate) AS INT) AS water_year, CASE WHEN l_quantity > 3 THEN CAST(dayofyear(l_shipdate) AS INT) ELSE -9999 END AS runoff_onset,
  CASE WHEN l_partkey % 17 <> 0 THEN l_discount * 500 END AS fcf, CASE WHEN l_orderkey % 13 <> 0 THEN CAST(l_orderkey % 9 + 1 AS INT) * 10 END AS worldcover FROM lineitem)"""
BUFFER = PIXELS + """, buf AS (SELECT station, water_year, r AS buffer_radius, c AS fcf_limit, median(CASE WHEN ok AND runoff_onset > 0 THEN runoff_onset END) AS onset,
  CAST(count(CASE WHEN ok AND runoff_onset > 0 THEN 1 END) AS DOUBLE) / nullif(count(fcf), 0) AS frac_valid, avg(CASE WHEN fcf <= c THEN fcf END) AS mean_fcf
  FROM (SELECT *, fcf <= c AND worldcover IS DISTINCT FROM 80 AND worldcover IS DISTINCT FROM 50 AS ok FROM pix JOIN (SELECT r::DOUBLE AS r, c::DOUBLE AS c FROM unnest([100, 300, 500]) AS a(r) CROSS JOIN unnest([10, 30]) AS b(c)) ON dist_m <= r) GROUP BY 1, 2, 3, 4)"""


def _pixels(spark, sf_dir):
    line = d.table(spark, sf_dir, "lineitem")
    return line.select(
        (F.col("l_suppkey") % 5).cast("int").alias("station"), (F.col("l_partkey") % 1000).cast("double").alias("dist_m"), F.year("l_shipdate").alias("water_year"),
        F.when(F.col("l_quantity") > 3, F.dayofyear("l_shipdate")).otherwise(-9999).alias("runoff_onset"), F.when(F.col("l_partkey") % 17 != 0, F.col("l_discount") * 500).alias("fcf"),
        F.when(F.col("l_orderkey") % 13 != 0, (F.col("l_orderkey") % 9 + 1).cast("int") * 10).alias("worldcover"),
    )


def _buffers(spark, sf_dir):
    return stations.buffer_statistics(_pixels(spark, sf_dir), (100, 300, 500), (10, 30))


@query("a21_buffer_statistics", "WITH " + BUFFER + " SELECT station, water_year, buffer_radius, fcf_limit, onset, round(frac_valid, 6) AS frac_valid, round(mean_fcf, 6) AS mean_fcf FROM buf")
def buffer_statistics(spark, sf_dir):
    """A-21, J-25, F-09, F-10."""
    return rounded(_buffers(spark, sf_dir))


def _differences(spark, sf_dir):
    return stations.differences(_buffers(spark, sf_dir), stations.timing(d.swe(spark, sf_dir)))


DIFFS = W + "," + BUFFER + TIMING + ", diffs AS (SELECT b.station, wy, buffer_radius, fcf_limit, onset, frac_valid, mean_fcf, " + ", ".join(f"onset - dowy_{c} AS diff_{c}" for c in ("max", "99", "95", "90", "50")) + " FROM buf b JOIN times t ON t.station = b.station AND t.wy = b.water_year)"


@query("e24_differences", DIFFS + " SELECT * REPLACE (round(frac_valid, 6) AS frac_valid, round(mean_fcf, 6) AS mean_fcf) FROM diffs")
def differences(spark, sf_dir):
    return rounded(_differences(spark, sf_dir))


@query("o06_a32_worst_stations", DIFFS + " SELECT station, median(abs(diff_max)) AS difference FROM diffs WHERE buffer_radius = 300 AND fcf_limit = 30 GROUP BY 1 HAVING median(abs(diff_max)) IS NOT NULL ORDER BY 2 DESC, 1 LIMIT 3")
def worst(spark, sf_dir):
    """O-06, A-32, F-12."""
    return stations.worst(_differences(spark, sf_dir).where("buffer_radius = 300 AND fcf_limit = 30"), "diff_max", 3)


@query("a33_counts", "WITH " + PIXELS + " SELECT station, count(fcf) AS n_fcf, count(worldcover) AS n_worldcover FROM pix GROUP BY 1")
def counts(spark, sf_dir):
    return stats.counts(_pixels(spark, sf_dir), ("station",), ("fcf", "worldcover"))


@query("a31_scene_medians", "SELECT l_shipdate AS time, median(l_extendedprice) AS vv FROM lineitem GROUP BY 1")
def scene_medians(spark, sf_dir):
    rows = d.table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias("time"), F.col("l_extendedprice").alias("vv"))
    return stats.group_medians(rows, "vv", ("time",)).select("time", F.col("median").alias("vv"))


@query("clean_series")
def clean(spark, sf_dir):
    """The whole cleaning chain, W-02 to W-05; its steps have SQL of their own."""
    return rounded(stations.clean(d.swe(spark, sf_dir)))

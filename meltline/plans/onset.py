"""Queries from observations to melt onsets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import masks, onset, quality, stats
from . import domain as d
from .registry import query, rounded

W = "WITH "
ONSET = d.MASKED + """,
minima AS (SELECT pixel, water_year, orbit, 'vv' AS polarization, arg_min(time, {'v': vv, 't': time}) FILTER (WHERE vv IS NOT NULL) AS t FROM masked GROUP BY ALL
  UNION ALL SELECT pixel, water_year, orbit, 'vh', arg_min(time, {'v': vh, 't': time}) FILTER (WHERE vh IS NOT NULL) FROM masked GROUP BY ALL),
onsets AS (SELECT pixel, water_year, coalesce(CAST(floor(median(epoch_us(t)) / 86400000000) AS BIGINT) - date_diff('day', DATE '1970-01-01', make_date(water_year - 1, 10, 1)) + 1, -9999) AS runoff_onset FROM minima GROUP BY 1, 2)"""


@query("onset_dowy", W + ONSET + " SELECT pixel, water_year, CAST(runoff_onset AS INT) AS runoff_onset FROM onsets")
def onset_dowy(spark, sf_dir):
    """J-01, F-03, A-06, A-07, A-08, E-04: observations to onset days."""
    return onset.melt_onset(d.masked_obs(spark, sf_dir)).withColumn("runoff_onset", F.col("runoff_onset").cast("int"))


@query("e02_e03_water_years", """SELECT o_orderkey, CAST(year(t) + (month(t) >= 10)::INT AS INT) AS wy_n, CAST(year(t) - (month(t) < 4)::INT AS INT) AS wy_s,
  CAST(date_diff('day', make_date(year(t) + (month(t) >= 10)::INT - 1, 10, 1), t::DATE) + 1 AS INT) AS dowy_n, CAST(date_diff('day', make_date(year(t) - (month(t) < 4)::INT, 4, 1), t::DATE) + 1 AS INT) AS dowy_s,
  CAST(dayofyear(t) AS INT) AS doy FROM (SELECT o_orderkey, o_orderdate AS t FROM orders)""")
def water_years(spark, sf_dir):
    """E-02, E-03, E-05 in both hemispheres."""
    t = F.col("o_orderdate")
    return d.table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.water_year(t).alias("wy_n"), dates.water_year(t, "southern").alias("wy_s"), dates.day_of_water_year(t).alias("dowy_n"),
        dates.day_of_water_year(t, "southern").alias("dowy_s"), F.dayofyear(t).alias("doy"),
    )


@query("e01_hemisphere", "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN 'northern' ELSE 'southern' END AS by_lat, CASE WHEN 32600 + c_custkey % 200 < 32700 THEN 'northern' ELSE 'southern' END AS by_zone FROM customer")
def hemispheres(spark, sf_dir):
    return d.table(spark, sf_dir, "customer").select("c_custkey", dates.hemisphere("c_acctbal").alias("by_lat"), dates.hemisphere_of_zone(32600 + F.col("c_custkey") % 200).alias("by_zone"))


@query("e07_e10_snow_window", W + d.PHENOLOGY + """ SELECT pixel, water_year, ws AS "search_window_start_DOWY", we AS "search_window_end_DOWY", wl AS search_window_length, seasonal AS binary_seasonal_snow_cover_presence FROM win""")
def snow_window(spark, sf_dir):
    return d.window(spark, sf_dir)


@query("f01_keep_years", W + d.OBS + " SELECT water_year, count(*) AS n, min(dowy) AS lo, max(dowy) AS hi FROM obs WHERE water_year IN (1996, 1998, 2000) GROUP BY 1")
def keep_years(spark, sf_dir):
    return masks.keep_years(d.obs(spark, sf_dir), [1996, 1998, 2000]).groupBy("water_year").agg(F.count("*").alias("n"), F.min("dowy").cast("long").alias("lo"), F.max("dowy").cast("long").alias("hi"))


@query("f02_equator_mask", W + d.OBS + " SELECT pixel, count(*) AS n, count(CASE WHEN latitude >= 0 THEN vv END) AS north FROM obs GROUP BY 1")
def equator_mask(spark, sf_dir):
    return masks.equator_mask(d.obs(spark, sf_dir), 1.5).groupBy("pixel").agg(F.count("*").alias("n"), F.count("vv").alias("north"))


@query("f03_noise_mask", W + d.MASKED + " SELECT pixel, water_year, count(*) AS n, count(vv) AS n_vv, count(vh) AS n_vh FROM noise GROUP BY 1, 2")
def noise_mask(spark, sf_dir):
    got = masks.noise_mask(d.obs(spark, sf_dir), threshold=d.THRESHOLD, until=d.UNTIL)
    return got.groupBy("pixel", "water_year").agg(F.count("*").alias("n"), F.count("vv").alias("n_vv"), F.count("vh").alias("n_vh"))


@query("j01_seasonal_mask", W + d.MASKED + " SELECT pixel, orbit, l_orderkey, l_partkey, vv, vh, wl AS search_window_length FROM masked WHERE water_year < 2000")
def seasonal_mask(spark, sf_dir):
    """J-01, J-02: equi-join on pixel and year with an interval on the day; rows stay."""
    return d.masked_obs(spark, sf_dir).select("pixel", "orbit", "l_orderkey", "l_partkey", "vv", "vh", "search_window_length")


@query("j03_all_masks", W + d.OBS + "," + d.PHENOLOGY + """ SELECT o.pixel, o.water_year, count(*) AS n,
  count(CASE WHEN latitude >= 0 AND o.pixel % 3 = 0 AND coalesce(dowy BETWEEN ws AND we AND seasonal, false) THEN vv END) AS n_vv
  FROM obs o LEFT JOIN win w ON o.pixel = w.pixel AND o.water_year = w.water_year WHERE o.water_year BETWEEN 1996 AND 1999 GROUP BY 1, 2""")
def all_masks(spark, sf_dir):
    inside = d.table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("pixel"))
    got = masks.all_masks(d.obs(spark, sf_dir), d.window(spark, sf_dir), range(1996, 2000), 0.5, inside)
    return got.groupBy("pixel", "water_year").agg(F.count("*").alias("n"), F.count("vv").alias("n_vv"))


@query("a02_orbit_counts", W + d.MASKED + " SELECT pixel, water_year, orbit, count(vv) AS count_vv, count(vh) AS count_vh FROM masked GROUP BY 1, 2, 3")
def orbit_counts(spark, sf_dir):
    return quality.orbit_counts(d.masked_obs(spark, sf_dir), ("vv", "vh"))


LITERAL = """,
seq AS (SELECT pixel, water_year, orbit, dowy, vv, ws, we, wl, row_number() OVER (PARTITION BY pixel, water_year, orbit ORDER BY time, l_orderkey, l_partkey) AS i, count(*) OVER (PARTITION BY pixel, water_year, orbit) AS m, count(vv) OVER (PARTITION BY pixel, water_year, orbit) AS c FROM masked),
edged AS (SELECT pixel, water_year, orbit, i, CASE WHEN vv IS NULL THEN dowy::DOUBLE END AS g FROM seq
  UNION ALL SELECT pixel, water_year, orbit, 0, max(ws) FROM seq GROUP BY 1, 2, 3 UNION ALL SELECT pixel, water_year, orbit, max(m) + 1, max(we) FROM seq GROUP BY 1, 2, 3),
gaps AS (SELECT pixel, water_year, orbit, max(s) AS max_gap FROM (SELECT pixel, water_year, orbit, g - lag(g) OVER (PARTITION BY pixel, water_year, orbit ORDER BY i) AS s FROM edged) GROUP BY 1, 2, 3)"""


@query("a04_max_gap", W + d.MASKED + LITERAL + " SELECT pixel, water_year, orbit, round(max_gap, 6) AS max_gap FROM gaps")
def max_gap(spark, sf_dir):
    """A-04, W-01, U-01, literal form."""
    return rounded(quality.max_gap(d.masked_obs(spark, sf_dir), order=d.ORDER))


@query("a04_max_gap_documented", W + d.MASKED + """,
valid AS (SELECT pixel, water_year, orbit, dowy::DOUBLE AS g FROM masked WHERE vv IS NOT NULL UNION ALL SELECT DISTINCT pixel, water_year, orbit, ws FROM masked UNION ALL SELECT DISTINCT pixel, water_year, orbit, we FROM masked)
SELECT m.pixel, m.water_year, m.orbit, round(max(s), 6) AS max_gap FROM (SELECT DISTINCT pixel, water_year, orbit FROM masked) m LEFT JOIN
  (SELECT pixel, water_year, orbit, g - lag(g) OVER (PARTITION BY pixel, water_year, orbit ORDER BY g) AS s FROM valid WHERE g IS NOT NULL) USING (pixel, water_year, orbit) GROUP BY 1, 2, 3""")
def max_gap_documented(spark, sf_dir):
    return rounded(quality.max_gap(d.masked_obs(spark, sf_dir), order=d.ORDER, mode="documented"))


@query("a03_filter_orbits", W + d.MASKED + LITERAL + """,
good AS (SELECT s.pixel, s.water_year, s.orbit, coalesce(max(c) >= 0.5 * max(wl) / 30 AND max(max_gap) <= 60 AND max(c) > 0, false) AS ok FROM seq s JOIN gaps USING (pixel, water_year, orbit) GROUP BY 1, 2, 3)
SELECT m.pixel, m.water_year, m.orbit, m.l_orderkey, m.l_partkey, CASE WHEN ok THEN vv END AS vv FROM masked m JOIN good USING (pixel, water_year, orbit) WHERE CASE WHEN ok THEN vv END IS NOT NULL""")
def filter_orbits(spark, sf_dir):
    got = quality.filter_orbits(d.masked_obs(spark, sf_dir), 0.5, 60, ("vv",), order=d.ORDER)
    return got.where("vv IS NOT NULL").select("pixel", "water_year", "orbit", "l_orderkey", "l_partkey", "vv")


@query("a05_temporal_resolution", W + d.MASKED + " SELECT pixel, water_year, round(max(wl) / nullif(count(vv), 0), 6) AS temporal_resolution FROM masked GROUP BY 1, 2")
def temporal_resolution(spark, sf_dir):
    return rounded(quality.temporal_resolution(d.masked_obs(spark, sf_dir)))


@query("a06_orbit_minima", W + ONSET + " SELECT pixel, water_year, orbit, polarization, t AS onset_time FROM minima")
def orbit_minima(spark, sf_dir):
    """A-06, R-02."""
    return onset.orbit_minima(d.masked_obs(spark, sf_dir))


@query("a07_median_time", W + ONSET + " SELECT pixel, water_year, make_timestamp(CAST(floor(median(epoch_us(t))) AS BIGINT)) AS onset_time FROM minima GROUP BY 1, 2")
def median_time(spark, sf_dir):
    return onset.median_time(onset.orbit_minima(d.masked_obs(spark, sf_dir)))


@query("e05_onset_doy", W + ONSET + " SELECT pixel, water_year, CAST(dayofyear(make_timestamp(CAST(floor(median(epoch_us(t))) AS BIGINT))) AS INT) AS runoff_onset FROM minima GROUP BY 1, 2")
def onset_doy(spark, sf_dir):
    return onset.melt_onset(d.masked_obs(spark, sf_dir), returned="doy")


@query("a08_onset_constituents", W + ONSET + """ SELECT pixel, water_year, orbit, polarization,
  CAST(coalesce(date_diff('day', make_date(water_year - 1, 10, 1), t::DATE) + 1, -9999) AS INT) AS runoff_onset FROM minima""")
def constituents(spark, sf_dir):
    return onset.melt_onset(d.masked_obs(spark, sf_dir), constituents=True).withColumn("runoff_onset", F.col("runoff_onset").cast("int"))


MEDIAN = """,
med AS (SELECT pixel, median(runoff_onset) AS m, count(*) AS n FROM onsets WHERE runoff_onset > 0 GROUP BY 1),
mad AS (SELECT o.pixel, median(abs(runoff_onset - m)) AS mad FROM onsets o JOIN med USING (pixel) WHERE runoff_onset > 0 GROUP BY 1),
tr AS (SELECT pixel, water_year, max(wl) / nullif(count(vv), 0) AS temporal_resolution FROM masked GROUP BY 1, 2)"""


@query("a09_median_and_mad", W + ONSET + MEDIAN + """ SELECT p.pixel, CASE WHEN n >= 3 THEN round(m, 6) END AS median, CASE WHEN n >= 3 THEN round(mad, 6) END AS mad
  FROM (SELECT DISTINCT pixel FROM onsets) p LEFT JOIN med USING (pixel) LEFT JOIN mad USING (pixel)""")
def median_and_mad(spark, sf_dir):
    return rounded(stats.median_and_mad(onset.melt_onset(d.masked_obs(spark, sf_dir)), "runoff_onset", 3))


@query("a10_median_with_min_obs", W + d.MASKED + """, tr AS (SELECT pixel, water_year, max(wl) / nullif(count(vv), 0) AS v FROM masked GROUP BY 1, 2)
  SELECT pixel, CASE WHEN count(CASE WHEN v > 0 THEN 1 END) >= 3 THEN round(median(CASE WHEN v > 0 THEN v END), 6) END AS median FROM tr GROUP BY 1""")
def median_with_min_obs(spark, sf_dir):
    return rounded(stats.median_with_min_obs(quality.temporal_resolution(d.masked_obs(spark, sf_dir)), "temporal_resolution", 3))


@query("a11_assembled", W + ONSET + MEDIAN + """, trs AS (SELECT pixel, CASE WHEN count(CASE WHEN temporal_resolution > 0 THEN 1 END) >= 3 THEN median(CASE WHEN temporal_resolution > 0 THEN temporal_resolution END) END AS trm FROM tr GROUP BY 1)
  SELECT p.pixel, CAST(y AS INT) AS water_year, round_even(CASE WHEN runoff_onset > 0 THEN runoff_onset END::DOUBLE, 0) AS runoff_onset, round(temporal_resolution, 6) AS temporal_resolution,
  CASE WHEN n >= 3 THEN round_even(m, 0) END AS runoff_onset_median, CASE WHEN n >= 3 THEN round(mad, 6) END AS runoff_onset_mad, round(trm, 6) AS temporal_resolution_median
  FROM (SELECT DISTINCT pixel FROM onsets) p CROSS JOIN range(1994, 2004) AS r(y) LEFT JOIN onsets o ON o.pixel = p.pixel AND o.water_year = y LEFT JOIN tr ON tr.pixel = p.pixel AND tr.water_year = y
  LEFT JOIN med ON med.pixel = p.pixel LEFT JOIN mad ON mad.pixel = p.pixel LEFT JOIN trs ON trs.pixel = p.pixel""")
def assembled(spark, sf_dir):
    """A-11, R-09."""
    rows = d.masked_obs(spark, sf_dir)
    yearly, resolution = onset.melt_onset(rows), quality.temporal_resolution(rows)
    got = stats.assembled(yearly, stats.median_and_mad(yearly, "runoff_onset", 3), resolution, stats.median_with_min_obs(resolution, "temporal_resolution", 3), range(1994, 2004))
    return rounded(got)


TILE_STATS = W + d.MASKED + """, tr AS (SELECT pixel % 7 AS tile, water_year, pixel, max(wl) / nullif(count(vv), 0) AS v FROM masked GROUP BY ALL),
  st AS (SELECT tile, water_year, median(v) AS tr, count(v) AS pix_ct FROM tr GROUP BY 1, 2)"""


def _tile_stats(spark, sf_dir):
    resolution = quality.temporal_resolution(d.masked_obs(spark, sf_dir))
    return stats.tile_statistics(resolution.withColumn("tile", F.col("pixel") % 7), d.YEARS)


@query("a12_tile_statistics", TILE_STATS + " SELECT tile" + "".join(f", round(max(tr) FILTER (WHERE water_year = {y}), 3) AS tr_{y}, coalesce(max(pix_ct) FILTER (WHERE water_year = {y}), 0) AS pix_ct_{y}" for y in d.YEARS) + " FROM st GROUP BY 1")
def tile_statistics(spark, sf_dir):
    return _tile_stats(spark, sf_dir)


@query("a19_weighted_resolution", TILE_STATS + """, l AS (SELECT water_year, round(tr, 3) AS tr, pix_ct FROM st WHERE water_year BETWEEN 1995 AND 2002 AND tr IS NOT NULL)
  SELECT water_year, round(sum(tr * pix_ct) / nullif(sum(pix_ct), 0), 6) AS temporal_resolution FROM l GROUP BY 1 UNION ALL SELECT NULL, round(sum(tr * pix_ct) / nullif(sum(pix_ct), 0), 6) FROM l""")
def weighted_resolution(spark, sf_dir):
    """A-19, R-04."""
    return rounded(stats.weighted_resolution(stats.long_statistics(_tile_stats(spark, sf_dir), d.YEARS)))


@query("w15_lapse_rates", W + d.CELLS + """ SELECT CAST(original_lat < 0 AS INT) AS south, round(regr_slope(runoff_onset_median, dem), 6) AS slope, round(regr_intercept(runoff_onset_median, dem), 6) AS intercept FROM cells GROUP BY 1""")
def lapse_rates(spark, sf_dir):
    rows = d.cells(spark, sf_dir).withColumn("south", (F.col("original_lat") < 0).cast("int"))
    return rounded(stats.lapse_rates(rows, "runoff_onset_median", "dem", ("south",)))

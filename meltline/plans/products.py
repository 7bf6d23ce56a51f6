"""Queries on mart, codecs and version comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, scalars
from ..operators import mart, onset, qa, stats
from . import domain as d
from .onset import MEDIAN, ONSET
from .registry import query, rounded

W = "WITH " + d.CELLS
BINS = """,
bins AS (SELECT *, CAST(-80 + (ceil((original_lat + 80) / 20) - 1) * 20 AS INT) AS lat_bin, CAST((ceil(dem / 1000) - 1) * 1000 AS INT) AS dem_bin,
  CASE WHEN chili > 0.767 THEN 'warm' WHEN chili < 0.448 THEN 'cool' ELSE 'neutral' END AS chili_class
  FROM cells WHERE runoff_onset_median IS NOT NULL AND original_lat > -80 AND original_lat <= 80 AND dem > 0 AND dem <= 8000)"""
LAT, DEM = (-80, 80, 20), (0, 8000, 1000)


def _bins(spark, sf_dir):
    return mart.binned(d.cells(spark, sf_dir).na.drop(subset=["runoff_onset_median"]), LAT, DEM)


@query("r07_binned", W + BINS + " SELECT pixel, lat_bin, dem_bin, lat_bin + 10.0::DOUBLE AS lat_centre FROM bins")
def binned(spark, sf_dir):
    """R-07, R-08, F-05, F-06."""
    return _bins(spark, sf_dir).select("pixel", "lat_bin", "dem_bin", scalars.bin_centre("lat_bin", 20.0).alias("lat_centre"))


def _stat_sql(columns, by=""):
    parts = [f"SELECT lat_bin, dem_bin{by}, '{s}' AS statistic, '{c}' AS variable, round(CAST({f}({c}) AS DOUBLE), 6) AS value FROM bins GROUP BY ALL" for c in columns for s, f in (("mean", "avg"), ("median", "median"), ("count", "count"))]
    return " UNION ALL ".join(parts)


@query("a13_bin_statistics", W + BINS + ", st AS (" + _stat_sql(("runoff_onset_median", "runoff_onset_mad")) + """)
  SELECT la::INT AS lat_bin, de::INT AS dem_bin, k.statistic, k.variable, st.value FROM range(-80, 80, 20) AS a(la) CROSS JOIN range(0, 8000, 1000) AS b(de) CROSS JOIN (SELECT DISTINCT statistic, variable FROM st) k
  LEFT JOIN st ON st.lat_bin = la AND st.dem_bin = de AND st.statistic = k.statistic AND st.variable = k.variable""")
def bin_statistics(spark, sf_dir):
    """A-13, A-17, J-23, J-24: every bin, empty ones too."""
    return rounded(mart.dense(mart.bin_statistics(_bins(spark, sf_dir)), LAT, DEM))


@query("a14_class_statistics", W + BINS + " " + _stat_sql(("runoff_onset_median",), ", chili_class"))
def class_statistics(spark, sf_dir):
    """A-14, E-17."""
    rows = _bins(spark, sf_dir).withColumn("chili_class", scalars.chili_class("chili"))
    return rounded(mart.bin_statistics(rows, ("runoff_onset_median",), ("chili_class",)))


@query("a18_class_contrast", W + BINS + ", st AS (" + _stat_sql(("runoff_onset_median",), ", chili_class") + """),
  wide AS (SELECT lat_bin, dem_bin, statistic, max(value) FILTER (WHERE chili_class = 'cool') AS cool, max(value) FILTER (WHERE chili_class = 'neutral') AS neutral, max(value) FILTER (WHERE chili_class = 'warm') AS warm FROM st GROUP BY 1, 2, 3)
  SELECT *, round(CASE WHEN statistic = 'count' THEN warm ELSE warm - cool END, 3) AS difference, round(CASE WHEN statistic = 'count' THEN warm ELSE warm / nullif(cool, 0) END, 3) AS ratio FROM wide""")
def class_contrast(spark, sf_dir):
    """A-18, R-06, E-25."""
    got = rounded(mart.class_contrast(_bins(spark, sf_dir)))
    return got.withColumns({c: F.round(c, 3) for c in ("difference", "ratio")})


def _corr(a, b):
    return f"CASE WHEN min({a}) FILTER (WHERE {b} IS NOT NULL) <> max({a}) FILTER (WHERE {b} IS NOT NULL) AND min({b}) FILTER (WHERE {a} IS NOT NULL) <> max({b}) FILTER (WHERE {a} IS NOT NULL) THEN round(corr({a}, {b}), 6) END"


@query("a15_bin_correlations", W + BINS + f" SELECT lat_bin, dem_bin, {_corr('runoff_onset_median', 'chili')} AS corr_chili, {_corr('runoff_onset_median', 'forest_cover_fraction')} AS corr_forest_cover_fraction FROM bins GROUP BY 1, 2")
def bin_correlations(spark, sf_dir):
    return rounded(mart.bin_correlations(_bins(spark, sf_dir), "runoff_onset_median", ("chili", "forest_cover_fraction")))


PAIRS = [("dem", "chili"), ("dem", "original_lat"), ("dem", "runoff_onset_median"), ("chili", "original_lat"), ("chili", "runoff_onset_median"), ("original_lat", "runoff_onset_median")]


@query("a16_correlation_matrix", W + " " + " UNION ALL ".join(f"SELECT '{a}' AS first, '{b}' AS second, {_corr(a, b)} AS correlation FROM cells" for a, b in PAIRS))
def correlation_matrix(spark, sf_dir):
    return rounded(mart.correlation_matrix(d.cells(spark, sf_dir), ("dem", "chili", "original_lat", "runoff_onset_median")))


@query("r05_elevation_columns", W + BINS + ", st AS (" + _stat_sql(("runoff_onset_median",)) + ") SELECT la::INT AS lat_bin, " + ", ".join(f'max(value) FILTER (WHERE dem_bin = {e}) AS "{e}"' for e in range(0, 8000, 1000))
       + " FROM range(-80, 80, 20) AS a(la) LEFT JOIN (SELECT * FROM st WHERE statistic = 'median') s ON s.lat_bin = la GROUP BY 1 ORDER BY 1 DESC")
def elevation_columns(spark, sf_dir):
    """R-05, O-08."""
    medians = mart.bin_statistics(_bins(spark, sf_dir), ("runoff_onset_median",)).where("statistic = 'median'")
    return rounded(mart.elevation_columns(medians, range(0, 8000, 1000), LAT))


@query("r01_years_wide", "WITH " + ONSET + " SELECT pixel, " + ", ".join(f'CAST(max(runoff_onset) FILTER (WHERE water_year = {y}) AS INT) AS "runoff_onset_WY{y}"' for y in d.YEARS) + " FROM onsets GROUP BY 1")
def years_wide(spark, sf_dir):
    """R-01, E-26."""
    got = mart.years_wide(onset.melt_onset(d.masked_obs(spark, sf_dir)), d.YEARS)
    return got.withColumns({f"runoff_onset_WY{y}": F.col(f"runoff_onset_WY{y}").cast("int") for y in d.YEARS})


@query("e15_e16_mart", W + """ SELECT pixel, CAST(round_even(dem, 0) AS INT) AS dem, CAST(coalesce(round_even(forest_cover_fraction, 0), -9999) AS INT) AS forest_cover_fraction, CAST(round_even(runoff_onset_median, 0) AS INT) AS runoff_onset_median,
  round_even(chili, 4) AS chili, round_even(runoff_onset_mad, 2) AS runoff_onset_mad FROM cells WHERE runoff_onset_median IS NOT NULL""")
def typed_mart(spark, sf_dir):
    """E-13, E-15, E-16, F-05."""
    got = mart.mart(d.cells(spark, sf_dir), ())
    out = got.withColumns({c: F.col(c).cast("int") for c in ("dem", "forest_cover_fraction", "runoff_onset_median")})
    return out.select("pixel", "dem", "forest_cover_fraction", "runoff_onset_median", F.round(F.col("chili").cast("double"), 4).alias("chili"), F.round(F.col("runoff_onset_mad").cast("double"), 2).alias("runoff_onset_mad"))


@query("e14_codec", "SELECT p_partkey, CAST(coalesce(round_even(v / 0.1, 0), -9999) AS INT) AS raw, round(CAST(round_even(v / 0.1, 0) AS INT) * 0.1::DOUBLE, 6) AS value FROM (SELECT p_partkey, CASE WHEN p_size % 9 <> 0 THEN p_retailprice / 8 END AS v FROM part)")
def codec(spark, sf_dir):
    rows = d.table(spark, sf_dir, "part").select("p_partkey", scalars.encode(F.when(F.col("p_size") % 9 != 0, F.col("p_retailprice") / 8), 0.1).alias("raw"))
    return rounded(rows.select("p_partkey", F.col("raw").cast("int").alias("raw"), scalars.decode("raw", 0.1).alias("value")))


@query("e19_decibel", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_discount > 0 THEN round(10 * log10(l_discount), 6) END AS db FROM lineitem")
def decibel(spark, sf_dir):
    return rounded(d.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", scalars.decibel("l_discount").alias("db")))


@query("e20_date_of", "SELECT s_suppkey, y, CAST(make_date(y::INT - 1, 10, 1) + CAST(s_suppkey % 366 AS INT) AS DATE) AS date FROM supplier CROSS JOIN range(1996, 2000) AS r(y)")
def date_of(spark, sf_dir):
    years = spark.range(1996, 2000).withColumnRenamed("id", "y")
    return d.table(spark, sf_dir, "supplier").crossJoin(F.broadcast(years)).select("s_suppkey", "y", dates.date_of(F.col("y"), F.col("s_suppkey") % 366 + 1).alias("date"))


@query("e22_time_of_day", "SELECT o_orderstatus, CASE o_orderstatus WHEN 'O' THEN 'evening' WHEN 'F' THEN 'morning' END AS time_of_day, count(*) AS n FROM orders GROUP BY ALL")
def time_of_day(spark, sf_dir):
    state = F.when(F.col("o_orderstatus") == "O", "ascending").when(F.col("o_orderstatus") == "F", "descending").otherwise("other")
    return d.table(spark, sf_dir, "orders").groupBy("o_orderstatus", scalars.time_of_day(state).alias("time_of_day")).agg(F.count("*").alias("n"))


@query("e23_anomaly", "WITH " + ONSET + MEDIAN + " SELECT o.pixel, water_year, round(runoff_onset - m, 6) AS anomaly FROM onsets o JOIN med USING (pixel) WHERE runoff_onset > 0")
def anomaly(spark, sf_dir):
    """E-23, F-15."""
    yearly = onset.melt_onset(d.masked_obs(spark, sf_dir)).where("runoff_onset > 0")
    return rounded(yearly.join(stats.median_with_min_obs(yearly, "runoff_onset", 1), "pixel").select("pixel", "water_year", (F.col("runoff_onset") - F.col("median")).alias("anomaly")))


# Two versions of a yearly product: the second one differs by a rule.
VERSIONS = """ver AS (SELECT pixel % 5 AS tile, pixel, water_year, CASE WHEN runoff_onset > 0 THEN runoff_onset::DOUBLE END AS a, CASE WHEN pixel % 11 <> 0 AND runoff_onset > 0 THEN runoff_onset::DOUBLE + CASE WHEN pixel % 3 = 0 THEN 0.5::DOUBLE ELSE 0 END END AS b FROM onsets)"""


def _versions(spark, sf_dir):
    x = F.when(F.col("runoff_onset") > 0, F.col("runoff_onset").cast("double"))
    rows = onset.melt_onset(d.masked_obs(spark, sf_dir)).select((F.col("pixel") % 5).alias("tile"), "pixel", "water_year", x.alias("runoff_onset"))
    other = F.when(F.col("pixel") % 11 != 0, F.col("runoff_onset") + F.when(F.col("pixel") % 3 == 0, 0.5).otherwise(0.0))
    return rows, rows.withColumn("runoff_onset", other)


_TENTHS = ", ".join(f"round(quantile_cont(a, {i / 10}), 6) AS p{i * 10:02d}" for i in range(11))


@query("a25_profile", "WITH " + ONSET + "," + VERSIONS + f""" SELECT count(*) FILTER (WHERE a IS NULL) AS n_missing, count(a) AS n_valid, min(a) AS min, max(a) AS max, round(avg(a), 6) AS mean, median(a) AS median,
  (SELECT a FROM ver WHERE a IS NOT NULL GROUP BY a ORDER BY count(*) DESC, a LIMIT 1) AS mode, round(stddev_pop(a), 6) AS std, count(DISTINCT a) AS n_unique, {_TENTHS} FROM ver""")
def profile(spark, sf_dir):
    return rounded(qa.profile(_versions(spark, sf_dir)[0], "runoff_onset"))


@query("w08_precision", "WITH " + ONSET + "," + VERSIONS + " SELECT min(x - l) AS precision FROM (SELECT x, lag(x) OVER (ORDER BY x) AS l FROM (SELECT DISTINCT b AS x FROM ver WHERE b IS NOT NULL))")
def precision(spark, sf_dir):
    return qa.precision(_versions(spark, sf_dir)[1], "runoff_onset")


@query("a26_differences", "WITH " + ONSET + "," + VERSIONS + """, df AS (SELECT abs(a - b) AS d FROM ver WHERE a IS NOT NULL AND b IS NOT NULL)
  SELECT count(*) AS n, min(d) AS min_diff, max(d) AS max_diff, round(avg(d), 6) AS mean_diff, median(d) AS median_diff, (SELECT d FROM df GROUP BY d ORDER BY count(*) DESC, d LIMIT 1) AS mode_diff, count(*) FILTER (WHERE d > 1e-6) AS n_over FROM df""")
def version_differences(spark, sf_dir):
    """A-26, J-21."""
    return rounded(qa.differences(qa.paired(*_versions(spark, sf_dir), "runoff_onset")))


@query("a27_out_of_range", "WITH " + ONSET + "," + VERSIONS + " SELECT count(*) FILTER (WHERE a NOT BETWEEN 60 AND 120) AS n_out, (SELECT a FROM ver WHERE a NOT BETWEEN 60 AND 120 GROUP BY a ORDER BY count(*) DESC, a LIMIT 1) AS mode_out FROM ver")
def out_of_range(spark, sf_dir):
    return qa.out_of_range(_versions(spark, sf_dir)[0], "runoff_onset", 60, 120)


_METRICS = {"n_missing": "count(*) FILTER (WHERE {v} IS NULL)", "n_valid": "count({v})", "min": "min({v})", "max": "max({v})", "mean": "avg({v})", "median": "median({v})", "std": "stddev_pop({v})", "n_unique": "count(DISTINCT {v})"}
_METRICS |= {"mode": "(SELECT {v} FROM ver WHERE {v} IS NOT NULL GROUP BY {v} ORDER BY count(*) DESC, {v} LIMIT 1)"} | {f"p{i * 10:02d}": f"quantile_cont({{v}}, {i / 10})" for i in range(11)}


@query("a28_comparison", "WITH " + ONSET + "," + VERSIONS + ", c AS (" + " UNION ".join(f"SELECT '{m}' AS metric, CAST({s.format(v='a')} AS DOUBLE) AS target, CAST({s.format(v='b')} AS DOUBLE) AS reference FROM ver" for m, s in _METRICS.items())
       + ") SELECT metric, round(target, 6) AS target, round(reference, 6) AS reference, CASE WHEN target IS NULL OR reference IS NULL THEN target IS NULL AND reference IS NULL ELSE abs(target - reference) <= 1e-6 END AS match FROM c")
def comparison(spark, sf_dir):
    return rounded(qa.comparison(*_versions(spark, sf_dir), "runoff_onset"))


@query("a29_rederived", "WITH " + ONSET + "," + VERSIONS + """, s AS (SELECT pixel, median(a) AS m, median(b) AS mb FROM ver GROUP BY 1), t AS (SELECT v.pixel, median(abs(a - m)) AS mad, median(abs(b - mb)) AS madb FROM ver v JOIN s USING (pixel) GROUP BY 1)
  SELECT round(max(abs(m - mb)), 6) AS median_max_diff, count(*) FILTER (WHERE abs(m - mb) > 1e-6) AS median_n_over, round(max(abs(mad - madb)), 6) AS mad_max_diff, count(*) FILTER (WHERE abs(mad - madb) > 1e-6) AS mad_n_over FROM s JOIN t USING (pixel)""")
def rederived(spark, sf_dir):
    a, b = _versions(spark, sf_dir)
    stored = stats.median_and_mad(b, "runoff_onset", 1, ("tile", "pixel")).withColumnsRenamed({"median": "runoff_onset_median", "mad": "runoff_onset_mad"})
    return rounded(qa.rederived(a, stored))


@query("a30_validated")
def validated(spark, sf_dir):
    """A-30, O-09: over a sample of tiles, which SQL would draw otherwise."""
    return rounded(qa.validated(*_versions(spark, sf_dir), ["runoff_onset"], 3))


@query("a37_summary", W + " " + " UNION ALL ".join(f"SELECT '{c}' AS variable, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(max({c}), 6) AS max FROM cells" for c in ("dem", "chili", "forest_cover_fraction")))
def summary(spark, sf_dir):
    return rounded(stats.summary(d.cells(spark, sf_dir), ("dem", "chili", "forest_cover_fraction")).drop("approx_median"))

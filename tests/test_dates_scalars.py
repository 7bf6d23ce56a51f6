import datetime as dt

import pytest
from pyspark.sql import functions as F

from meltline.functions import dates, scalars


def rows(spark, values, schema="x string"):
    return spark.createDataFrame([(v,) for v in values], schema)


def test_water_years_at_their_edges(spark):
    days = ["2019-09-30", "2019-10-01", "2020-02-29", "2020-03-31", "2020-04-01", "2020-09-30"]
    t = F.col("x").cast("timestamp_ntz")
    got = rows(spark, days).select(dates.water_year(t), dates.day_of_water_year(t), dates.water_year(t, "southern"), dates.day_of_water_year(t, "southern")).collect()
    assert [tuple(r) for r in got] == [(2019, 365, 2019, 183), (2020, 1, 2019, 184), (2020, 152, 2019, 335), (2020, 183, 2019, 366), (2020, 184, 2020, 1), (2020, 366, 2020, 183)]


def test_day_in_cuts_to_days_and_fills(spark):
    got = rows(spark, ["2020-01-01 23:59:59", None]).select(dates.day_in(F.col("x").cast("timestamp_ntz"), F.lit(2020)).alias("d")).collect()
    assert [r.d for r in got] == [93, -9999]
    with pytest.raises(ValueError):
        dates.year_start(F.lit(2020), "eastern")


def test_date_of_inverts_day(spark):
    got = spark.range(1, 367).select(dates.date_of(F.lit(2020), F.col("id")).alias("d"), "id").select(F.col("id") == dates.day_of_water_year(F.col("d").cast("timestamp_ntz"))).distinct().collect()
    assert [r[0] for r in got] == [True]


def test_unix_seconds(spark):
    got = rows(spark, ["1700000000.5", "2023-11-14 22:13:20", "2023-11-14T22:13:20", "x", "", None]).select(dates.unix_seconds("x").alias("s")).collect()
    assert [r.s for r in got] == [1700000000.5, 1700000000.0, 1700000000.0, None, None, None]


def test_median_time_truncates_fractions(spark):
    got = rows(spark, [0.5, -0.5], "x double").select(dates.of_micros("x").alias("t")).collect()
    assert [r.t for r in got] == [dt.datetime(1970, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999)]


def test_bins_are_closed_on_the_right(spark):
    got = rows(spark, [0.0, 1.0, 100.0, 100.5, 9000.0, 9000.1, None], "x double").select(scalars.bin_left("x", 0, 9000, 100).alias("b")).collect()
    assert [r.b for r in got] == [None, 0, 0, 100, 8900, None, None]


def test_codec(spark):
    got = rows(spark, [0.05, 0.15, 0.25, 3276.8, float("nan"), None, -0.1], "x double").select(scalars.encode("x", 0.1).alias("e")).collect()
    assert [r.e for r in got] == [0, 1, 2, -9999, -9999, -9999, -1]  # 0.15 / 0.1 is below 1.5
    back = rows(spark, [-9999, 0, 25], "x smallint").select(scalars.decode("x", 0.1).alias("d")).collect()
    assert [r.d for r in back] == [None, 0.0, 2.5]


def test_whole_is_half_even_and_safe(spark):
    got = rows(spark, [2.5, 3.5, 40000.0, float("inf"), float("nan"), None], "x double").select(scalars.whole("x").alias("w")).collect()
    assert [r.w for r in got] == [2, 4, -9999, -9999, -9999, -9999]


def test_chili_edges(spark):
    got = rows(spark, [0.447, 0.448, 0.767, 0.768, None], "x double").select(scalars.chili_class("x").alias("c")).collect()
    assert [r.c for r in got] == ["cool", "neutral", "neutral", "warm", "neutral"]


def test_correlation_of_constants_is_missing(spark):
    d = spark.createDataFrame([(1, 1.0, 5.0), (1, 2.0, 5.0), (2, 1.0, 2.0), (2, 2.0, 4.0), (2, 3.0, None), (3, 1.0, 1.0)], "k int, a double, b double")
    got = {r.k: r.c for r in d.groupBy("k").agg(scalars.correlation("a", "b").alias("c")).collect()}
    assert got[1] is None and got[3] is None and abs(got[2] - 1) < 1e-12


def test_small_expressions(spark):
    d = spark.createDataFrame([([4, 1, 3, 9], [0.1, 0.25, 0.25, 0.4], "{'time': 586, 'x': 2}", "a/global_config_v9.txt", " NaN ")], "u array<int>, f array<double>, d string, p string, t string")
    got = d.select(scalars.valid_percent("u", "f"), scalars.dims("d")["time"], scalars.config_version("p"), scalars.blank_to_null("t"), scalars.tile_name(F.lit(3), F.lit(41)), scalars.decibel(F.lit(0.1)), scalars.decibel(F.lit(0.0))).first()
    assert tuple(got) == (50.0, 586, "v9", None, "tile_003_041.parquet", -10.0, None)

"""Statistics over years and tiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import positive

PIXEL = ("pixel",)


def median_with_min_obs(df: DataFrame, value: str, min_count: int, keys: Sequence[str] = PIXEL, name: str = "median") -> DataFrame:
    """Median of the positive values, missing where there are fewer than min_count."""
    x = positive(value)
    return df.groupBy(*keys).agg(F.when(F.count(x) >= min_count, F.median(x)).alias(name))


def median_and_mad(df: DataFrame, value: str, min_count: int = 1, keys: Sequence[str] = PIXEL) -> DataFrame:
    """Median of the positive values and median absolute deviation from it, missing with fewer than min_count values.

    One shuffle: a pixel's few years are gathered, and the deviations are sorted inside the row.
    """
    x = positive(F.col(value).cast("double"))
    got = df.groupBy(*keys).agg(F.median(x).alias("median"), F.array_agg(x).alias("_x"))
    off = F.array_sort(F.transform("_x", lambda v: F.abs(v - F.col("median"))))
    n = F.size("_x")
    low, high = F.get(off, F.floor((n - 1) / 2).cast("int")), F.get(off, F.floor(n / 2).cast("int"))
    enough = n >= min_count
    return got.select(*keys, F.when(enough, F.col("median")).alias("median"), F.when(enough, (low + high) / 2).alias("mad"))


def assembled(onset: DataFrame, summary: DataFrame, resolution: DataFrame, resolution_summary: DataFrame, years: Sequence[int], keys: Sequence[str] = PIXEL) -> DataFrame:
    """One row for each pixel and wanted year: onset and its median rounded half to even, MAD and resolutions as they are."""
    spark = onset.sparkSession
    wanted = summary.select(*keys).crossJoin(F.broadcast(spark.createDataFrame([(y,) for y in years], "water_year int")))
    out = wanted.join(onset.select(*keys, "water_year", F.rint(positive("runoff_onset")).alias("runoff_onset")), [*keys, "water_year"], "left")
    out = out.join(resolution, [*keys, "water_year"], "left")
    out = out.join(summary.select(*keys, F.rint("median").alias("runoff_onset_median"), F.col("mad").alias("runoff_onset_mad")), list(keys), "left")
    return out.join(resolution_summary.select(*keys, F.col("median").alias("temporal_resolution_median")), list(keys), "left")


def tile_statistics(resolution: DataFrame, years: Sequence[int], keys: Sequence[str] = ("tile",)) -> DataFrame:
    """Median resolution and number of pixels with one, by tile and year, as columns tr_<year> and pix_ct_<year>."""
    aggs = [F.round(F.median("temporal_resolution"), 3).alias("tr"), F.count("temporal_resolution").alias("pix_ct")]
    wide = resolution.groupBy(*keys).pivot("water_year", list(years)).agg(*aggs)
    return wide.select(*keys, *[F.col(f"{y}_tr").alias(f"tr_{y}") for y in years], *[F.coalesce(f"{y}_pix_ct", F.lit(0)).alias(f"pix_ct_{y}") for y in years])


def long_statistics(wide: DataFrame, years: Sequence[int], keys: Sequence[str] = ("tile",)) -> DataFrame:
    """Columns tr_<year> and pix_ct_<year> as rows."""
    parts = ", ".join(f"{y}, tr_{y}, pix_ct_{y}" for y in years)
    return wide.select(*keys, F.expr(f"stack({len(years)}, {parts}) AS (water_year, tr, pix_ct)"))


def weighted_resolution(long: DataFrame) -> DataFrame:
    """Mean resolution weighted by pixels, of each year and over all (water_year null); null where all weights are 0."""
    both = long.where("tr IS NOT NULL AND pix_ct IS NOT NULL")
    mean = F.try_divide(F.sum(F.col("tr") * F.col("pix_ct")), F.sum("pix_ct").cast("double")).alias("temporal_resolution")
    return both.rollup("water_year").agg(mean)


def counts(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Values that aren't missing, by group."""
    return df.groupBy(*keys).agg(*[F.count(c).alias(f"n_{c}") for c in columns])


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct values with their number of rows."""
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def group_medians(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """Median of the values of each group, and their number."""
    return df.groupBy(*keys).agg(F.median(value).alias("median"), F.count(value).alias("n"))


def log_histogram(df: DataFrame, value: str, bins: int = 100) -> DataFrame:
    """As histogram, over the logarithms of the positive values."""
    return histogram(df.where(F.col(value) > 0).select(F.log10(value).alias(value)), value, bins)


def histogram(df: DataFrame, value: str, bins: int = 100) -> DataFrame:
    """Rows in each of so many equal bins between the least and the largest value; the last one is closed."""
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    k = F.least(F.floor(F.try_divide(F.col(value) - F.col("lo"), (F.col("hi") - F.col("lo")) / bins)), F.lit(bins - 1))
    return df.where(F.col(value).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(F.coalesce(k, F.lit(0)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, least, largest and approximate median of each column, one row a column."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "variable", "value")
    return long.groupBy("variable").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.percentile_approx("value", 0.5).alias("approx_median"),
    )


def lapse_rates(df: DataFrame, y: str, x: str, keys: Sequence[str] = ()) -> DataFrame:
    """Slope and intercept of y over x; null where x doesn't vary."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    slope = F.try_divide(F.covar_pop(x, y), F.var_pop(x))
    out = both.groupBy(*keys).agg(slope.alias("slope"), F.avg(x).alias("_x"), F.avg(y).alias("_y"))
    return out.select(*keys, "slope", (F.col("_y") - F.col("slope") * F.col("_x")).alias("intercept"))

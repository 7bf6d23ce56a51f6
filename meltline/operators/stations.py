"""Snow-water series of weather stations: cleaning, seasonal tests, timing of the maximum, and comparison with onsets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import ratio

STATION, YEAR = ("station",), ("station", "wy")
PERCENTS = (0.99, 0.95, 0.9, 0.5)


def _series(keys: Sequence[str] = STATION) -> Window:
    return Window.partitionBy(*keys).orderBy("date")


def dense_days(series: DataFrame, keys: Sequence[str] = STATION) -> DataFrame:
    """One row for each day between a station's first and last, missing values where there was none."""
    days = series.groupBy(*keys).agg(F.min("date").alias("a"), F.max("date").alias("b"))
    days = days.select(*keys, F.explode(F.sequence("a", "b")).alias("date"))
    return days.join(series, [*keys, "date"], "left")


def jump_mask(series: DataFrame, limit: float = 0.2) -> DataFrame:
    """Keeps a value if the steps before the day before it and after it are below limit; a station's first day goes."""
    w = _series()
    calm = (F.abs(F.lag("swe", 1).over(w) - F.lag("swe", 2).over(w)) < limit) & (F.abs(F.lead("swe", 1).over(w) - F.col("swe")) < limit)
    out = series.withColumns({"_first": F.row_number().over(w) == 1, "_calm": F.coalesce(calm, F.lit(False))})
    return out.where("NOT _first").withColumn("swe", F.when(F.col("_calm"), F.col("swe"))).drop("_first", "_calm")


def rolling_mask(series: DataFrame, width: int = 20, least: int = 10) -> DataFrame:
    """Keeps a value if a centred window of width days is whole and holds at least so many values."""
    w = _series().rowsBetween(-(width // 2), width - width // 2 - 1)
    good = (F.count("*").over(w) == width) & (F.count("swe").over(w) >= least)
    return series.withColumn("_good", good).withColumn("swe", F.when(F.col("_good"), F.col("swe"))).drop("_good")


def seasonal_mask(series: DataFrame, width: int = 60, days: int = 55, swe: float = 0.05) -> DataFrame:
    """Keeps a station's water year if a centred window holds at least so many days of snow."""
    w = _series(YEAR).rowsBetween(-(width // 2), width - width // 2 - 1)
    deep = F.sum(F.coalesce((F.col("swe") >= swe).cast("int"), F.lit(0))).over(w)
    out = series.withColumn("_deep", (F.count("*").over(w) >= days) & (deep >= days))
    out = out.withColumn("_any", F.max("_deep").over(Window.partitionBy(*YEAR)))
    return out.withColumn("swe", F.when(F.col("_any"), F.col("swe"))).drop("_deep", "_any")


def completeness(series: DataFrame, months: Sequence[int] = (11, 12, 1, 2, 3)) -> DataFrame:
    """By station and year: missing winter days, longest gap between valid days, first and last valid value."""
    w = _series(YEAR).rowsBetween(Window.unboundedPreceding, -1)
    valid = F.when(F.col("swe").isNotNull(), F.col("date"))
    gap = F.date_diff(valid, F.max(valid).over(w))
    at = F.when(F.col("swe").isNotNull(), F.struct("date", "swe"))
    return series.withColumn("_gap", gap).groupBy(*YEAR).agg(
        F.count_if(F.col("swe").isNull() & F.month("date").isin(list(months))).alias("missing_winter"),
        F.max("_gap").alias("longest_gap"), F.count("swe").alias("n_valid"), F.min(at)["swe"].alias("first_valid"), F.max(at)["swe"].alias("last_valid"),
    )


def complete_mask(series: DataFrame, max_missing: int = 30, max_gap: int = 10, edge: float = 0.1) -> DataFrame:
    """Blanks station years with too many missing winter days or too long a gap, without values, or not ending in bare ground."""
    bad = (F.col("missing_winter") > max_missing) | (F.coalesce("longest_gap", F.lit(0)) > max_gap) | (F.col("n_valid") == 0)
    bad = bad | F.coalesce(F.col("first_valid") > edge, F.lit(False)) | F.coalesce(F.col("last_valid") > edge, F.lit(False))
    marks = completeness(series).select(*YEAR, bad.alias("_bad"))
    return series.join(marks, list(YEAR), "left").withColumn("swe", F.when(~F.col("_bad"), F.col("swe"))).drop("_bad")


def clean(series: DataFrame) -> DataFrame:
    """Negative values go, then jumps, sparse stretches, incomplete years and years without seasonal snow."""
    start = series.withColumn("swe", F.when(F.col("swe") >= 0, F.col("swe")))
    return seasonal_mask(complete_mask(rolling_mask(jump_mask(start))))


def timing(series: DataFrame, percents: Sequence[float] = PERCENTS) -> DataFrame:
    """By station and year: the largest value, the latest day of it, and the last day with each share of it; days above 0 only."""
    top = F.max("swe").over(Window.partitionBy(*YEAR))
    rows = series.withColumn("_top", top)
    days = [F.max(F.when(F.col("swe") >= F.lit(p) * F.col("_top"), F.col("dowy"))).alias(f"dowy_{round(p * 100)}") for p in percents]
    latest = F.max(F.when(F.col("swe").isNotNull(), F.struct("swe", "dowy")))["dowy"].alias("dowy_max")
    got = rows.groupBy(*YEAR).agg(F.max("swe").alias("max_swe"), latest, *days)
    return got.select(*YEAR, "max_swe", *[F.when(F.col(c) > 0, F.col(c)).alias(c) for c in got.columns[3:]])


def first_peak(series: DataFrame) -> DataFrame:
    """Earliest date of the largest value."""
    return series.groupBy(*YEAR).agg(F.min(F.when(F.col("swe").isNotNull(), F.struct((-F.col("swe")).alias("v"), "date")))["date"].alias("date_max"))


def good_cover(c: Column | str) -> Column:
    """Neither water (80) nor built-up (50); a missing class stays."""
    col = F.col(c) if isinstance(c, str) else c
    return ~col.eqNullSafe(80) & ~col.eqNullSafe(50)


def buffer_statistics(pixels: DataFrame, radii: Sequence[float], covers: Sequence[float]) -> DataFrame:
    """By station, year, radius and forest limit: median onset and valid share of good pixels, and mean forest cover.

    The limits are a small parameter table; each pixel row meets the limits it satisfies, once. The mean forest cover
    is over all land cover, as the median and the share are not.
    """
    spark = pixels.sparkSession
    limits = spark.createDataFrame([(float(r), float(c)) for r in radii for c in covers], "buffer_radius double, fcf_limit double")
    near = pixels.join(F.broadcast(limits), F.col("dist_m") <= F.col("buffer_radius"))
    wooded = F.col("fcf") <= F.col("fcf_limit")
    good = wooded & good_cover("worldcover")
    onset = F.when(good & (F.col("runoff_onset") > 0), F.col("runoff_onset"))
    return near.groupBy("station", "water_year", "buffer_radius", "fcf_limit").agg(
        F.median(onset).alias("onset"), ratio(F.count(onset), F.nullif(F.count("fcf"), F.lit(0))).alias("frac_valid"), F.avg(F.when(wooded, F.col("fcf"))).alias("mean_fcf")
    )


def differences(onsets: DataFrame, times: DataFrame) -> DataFrame:
    """Onset less station timing; null where either is missing."""
    both = onsets.withColumnRenamed("water_year", "wy").join(times, list(YEAR))
    days = [c for c in times.columns if c.startswith("dowy_")]
    return both.select(*[c for c in onsets.columns if c != "water_year"], "wy", *[(F.col("onset") - F.col(c)).alias(f"diff_{c[5:]}") for c in days])


def worst(found: DataFrame, column: str, n: int = 30) -> DataFrame:
    """The n stations with the largest median absolute difference over years."""
    got = found.groupBy("station").agg(F.median(F.abs(column)).alias("difference")).na.drop(subset=["difference"])
    return got.orderBy(F.desc("difference"), "station").limit(n)


def time_slice(series: DataFrame, start: str, end: str, date: str = "date") -> DataFrame:
    """Rows between two dates, both included; the range reaches the scan."""
    return series.where(F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date")))

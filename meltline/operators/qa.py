"""Comparison of two versions of a product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stats import median_and_mad

CELL = ("tile", "pixel", "water_year")
TENTHS = tuple(i / 10 for i in range(11))
RANGES = {"runoff_onset": (1, 366), "runoff_onset_median": (1, 366), "runoff_onset_mad": (0, 100), "temporal_resolution": (0.1, 100), "temporal_resolution_median": (0.1, 100)}


def profile(rows: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Missing and valid counts, extremes, mean, median, mode (least of ties), population deviation, distinct values, tenths."""
    x = F.col(value).cast("double")
    got = rows.groupBy(*keys).agg(
        F.count_if(x.isNull()).alias("n_missing"), F.count(x).alias("n_valid"), F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"), F.median(x).alias("median"),
        F.mode(x, True).alias("mode"), F.stddev_pop(x).alias("std"), F.count_distinct(x).alias("n_unique"), F.percentile(x, F.array(*map(F.lit, TENTHS))).alias("_p"),
    )
    return got.select(*got.columns[:-1], *[F.get("_p", i).alias(f"p{i * 10:02d}") for i in range(11)])


def precision(rows: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Smallest step between neighbouring distinct values."""
    seen = rows.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("x")).distinct()
    if keys:
        steps = seen.withColumn("d", F.col("x") - F.lag("x").over(Window.partitionBy(*keys).orderBy("x")))
        return steps.groupBy(*keys).agg(F.min("d").alias("precision"))
    # Without keys: sorted runs by range, each knowing the largest value of the runs before it, instead of one task.
    runs = seen.repartitionByRange(F.col("x")).withColumn("run", F.spark_partition_id())
    steps = runs.withColumn("d", F.col("x") - F.lag("x").over(Window.partitionBy("run").orderBy("x")))
    ends = steps.groupBy("run").agg(F.min("x").alias("a"), F.max("x").alias("b"), F.min("d").alias("d"))  # one row a partition
    gaps = ends.withColumn("g", F.col("a") - F.lag("b").over(Window.orderBy("a")))
    return gaps.agg(F.least(F.min("d"), F.min("g")).alias("precision"))


def paired(a: DataFrame, b: DataFrame, value: str, keys: Sequence[str] = CELL) -> DataFrame:
    """Cells valid in both versions."""
    both = a.select(*keys, F.col(value).alias("a")).join(b.select(*keys, F.col(value).alias("b")), list(keys))
    return both.where("a IS NOT NULL AND b IS NOT NULL")


def differences(pairs: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    off = F.abs(F.col("a").cast("double") - F.col("b").cast("double"))
    return pairs.withColumn("d", off).agg(
        F.count("d").alias("n"), F.min("d").alias("min_diff"), F.max("d").alias("max_diff"), F.avg("d").alias("mean_diff"), F.median("d").alias("median_diff"),
        F.mode("d", True).alias("mode_diff"), F.count_if(F.col("d") > tolerance).alias("n_over"),
    )


def out_of_range(rows: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """Values outside [low, high] and the most frequent of them (least of ties)."""
    out: Column = ~F.col(value).between(low, high)
    return rows.agg(F.count_if(out).alias("n_out"), F.mode(F.when(out, F.col(value).cast("double")), True).alias("mode_out"))


def comparison(a: DataFrame, b: DataFrame, value: str, tolerance: float = 1e-6) -> DataFrame:
    """metric, target, reference, match for every metric of the two profiles; two missing values match."""
    names = [c for c in profile(a, value).columns]
    long = lambda d, n: profile(d, value).select(*[F.col(c).cast("double") for c in names]).unpivot([], names, "metric", n)
    match = F.when(F.col("target").isNull() | F.col("reference").isNull(), F.col("target").isNull() & F.col("reference").isNull())
    return long(a, "target").join(long(b, "reference"), "metric").withColumn("match", match.otherwise(F.abs(F.col("target") - F.col("reference")) <= tolerance))


def rederived(yearly: DataFrame, stored: DataFrame, tolerance: float = 1e-6, keys: Sequence[str] = ("tile", "pixel")) -> DataFrame:
    """Stored median and deviation against those of the yearly values, where both are there; no least number of years."""
    again = median_and_mad(yearly, "runoff_onset", 1, keys)
    both = stored.join(again, list(keys))
    aggs = []
    for name, old, new in (("median", "runoff_onset_median", "median"), ("mad", "runoff_onset_mad", "mad")):
        off = F.abs(F.col(old) - F.col(new))
        aggs += [F.max(off).alias(f"{name}_max_diff"), F.count_if(off > tolerance).alias(f"{name}_n_over")]
    return both.agg(*aggs)


def sampled(tiles: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n tiles at random, the same ones for a seed whatever the partitioning."""
    return tiles.orderBy(F.xxhash64(*tiles.columns, F.lit(seed)), *tiles.columns).limit(n)


def validated(a: DataFrame, b: DataFrame, values: Sequence[str], n_tiles: int = 10, tolerance: float = 1e-6, seed: int = 42) -> DataFrame:
    """Differences of each value over a sample of the tiles that both versions hold."""
    chosen = sampled(a.select("tile").intersect(b.select("tile")), n_tiles, seed)
    a, b = (d.join(F.broadcast(chosen), "tile", "left_semi") for d in (a, b))
    out = None
    for v in values:
        row = differences(paired(a, b, v), tolerance).select(F.lit(v).alias("variable"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def report(found: DataFrame) -> DataFrame:
    """Each row as a JSON document."""
    return found.select(F.to_json(F.struct(*found.columns), {"ignoreNullFields": "false"}).alias("value"))

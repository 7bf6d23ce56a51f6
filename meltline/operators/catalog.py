"""Tile catalogue, result log, batches and their bookkeeping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ID = ("row", "col")
PERCENT = "percent_valid_snow_pixels"
WHICH = ("all", "processed", "failed", "unprocessed", "unprocessed_and_failed", "unprocessed_and_failed_weather_stations")


def _one(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def keep_last(results: DataFrame, sequence: str, keys: Sequence[str] = ID) -> DataFrame:
    """The last row of each key by a sequence column (files have no order of their own)."""
    return _one(results, keys, F.desc_nulls_last(sequence))


def keep_first(results: DataFrame, sequence: str, keys: Sequence[str] = ID) -> DataFrame:
    return _one(results, keys, F.asc_nulls_last(sequence))


def keep_last_started(results: DataFrame, start: str = "start_time", tie: str = "sequence", keys: Sequence[str] = (*ID, "success")) -> DataFrame:
    """The row with the latest start of each key; one without a start counts as latest."""
    return _one(results, keys, F.desc_nulls_first(start), F.desc_nulls_last(tie))


def distinct_tiles(df: DataFrame) -> DataFrame:
    return df.select(*ID).distinct()


def catalogue(tiles: DataFrame, results: DataFrame, sequence: str = "sequence") -> DataFrame:
    """Tiles and the last result of each, full outer; the percentage comes from the tiles."""
    last = keep_last(results, sequence).drop(PERCENT)
    return tiles.join(last, list(ID), "full")


def ranked(tiles: DataFrame) -> DataFrame:
    """By percentage, largest first, missing last; ties by row and column."""
    return tiles.orderBy(F.desc_nulls_last(PERCENT), *ID)


def select(tiles: DataFrame, which: str = "all", stations: DataFrame | None = None) -> DataFrame:
    """Tiles of a status. success is true, false, or missing (unprocessed); the last kind needs tiles with stations."""
    if which not in WHICH:
        raise ValueError(f"unknown kind of tiles {which!r}")
    ok = F.col("success") if "success" in tiles.columns else F.lit(None).cast("boolean")
    found = {"all": F.lit(True), "processed": ok, "failed": ~ok, "unprocessed": ok.isNull()}.get(which, ok.isNull() | ~ok)
    out = tiles.where(found)
    if which.endswith("weather_stations"):
        if stations is None:
            raise ValueError("tiles with stations are needed")
        out = out.join(stations.select(*ID), list(ID), "left_semi")
    return out


def page(tiles: DataFrame, how_many: int = 0, batch: int = -1, size: int = 256) -> DataFrame:
    """The first how_many tiles (0: all) of the ranking, and of those one batch (-1: all)."""
    out = ranked(tiles)
    out = out.limit(how_many) if how_many > 0 else out
    return ranked(out).offset(batch * size).limit(size) if batch >= 0 else out


def batch_info(tiles: DataFrame, size: int = 256) -> DataFrame:
    """Number of tiles and batches, and the batch numbers."""
    n = tiles.agg(F.count("*").alias("total"))
    n = n.withColumn("batches", F.ceil(F.col("total") / size))
    return n.withColumn("indices", F.when(F.col("batches") > 0, F.sequence(F.lit(0).cast("long"), F.col("batches") - 1)).otherwise(F.array().cast("array<bigint>")))


def batches(tiles: DataFrame, size: int = 10) -> DataFrame:
    """The catalogue's ranking cut into batches; a catalogue holds some ten thousand tiles at most, so one sort does."""
    return tiles.withColumn("batch", F.floor((F.row_number().over(Window.orderBy(F.desc_nulls_last(PERCENT), *ID)) - 1) / size))


def sorted_log(results: DataFrame, start: str = "start_time", tie: str = "sequence") -> DataFrame:
    """The log by start, missing first; ties by sequence."""
    return results.orderBy(start, tie)


def over_threshold(tiles: DataFrame, percent: float = 0.001) -> DataFrame:
    """Tiles with more than a percentage; those without one go."""
    return tiles.where(F.col(PERCENT) > percent)


def counted_results(tiles: DataFrame, results: DataFrame) -> DataFrame:
    """Every tile with its number of results, 0 where it has none."""
    n = results.groupBy(*ID).agg(F.count("*").alias("n"))
    return tiles.select(*ID).join(n, list(ID), "left").na.fill(0, ["n"])


def missing_files(tiles: DataFrame, existing: DataFrame) -> DataFrame:
    """Tiles whose file isn't there yet."""
    from ..functions.scalars import tile_name

    return tiles.withColumn("filename", tile_name("row", "col")).join(existing.select("filename"), "filename", "left_anti")


def not_completed(batch: DataFrame, completed: DataFrame) -> DataFrame:
    return batch.join(completed.select(*ID), list(ID), "left_anti")


def common(a: DataFrame, b: DataFrame) -> DataFrame:
    """Tiles processed in both."""
    return a.where("success").select(*ID).intersect(b.where("success").select(*ID))


def percent_of(tiles: DataFrame, row: int, col: int) -> DataFrame:
    return tiles.where((F.col("row") == row) & (F.col("col") == col)).agg(F.first(PERCENT, ignorenulls=True).alias(PERCENT))


def consolidated(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new result rows, the last started of each tile and status."""
    return keep_last_started(existing.unionByName(new, allowMissingColumns=True))


def result_statistics(results: DataFrame) -> DataFrame:
    """Totals of a result log; a missing status counts as failure."""
    good = F.count_if("success")
    return results.agg(
        F.count("*").alias("total"), good.alias("successes"), F.count_if(~F.col("success").eqNullSafe(True)).alias("failures"),
        F.try_divide(100.0 * good, F.count("*").cast("double")).alias("success_rate"),
    )


def volume(results: DataFrame, gb_per_scene: float = 0.0156) -> DataFrame:
    """Scenes and gigabytes over all results, from the printed dimension sizes."""
    from ..functions.scalars import dims

    n = F.sum(dims("s1_rtc_ds_dims")["time"])
    return results.agg(n.alias("scenes"), (n * gb_per_scene).alias("gigabytes"))

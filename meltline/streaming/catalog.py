"""Streaming forms of the result log and of the process-until-done loop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def latest_results(results: DataFrame, time: str = "start_time", delay: str = "1 day") -> DataFrame:
    """Results of a stream without repeated (row, col, start) within the watermark."""
    return results.withWatermark(time, delay).dropDuplicatesWithinWatermark(["row", "col", time])


def windowed(events: DataFrame, time: str, width: str, value: str, keys: tuple[str, ...] = (), delay: str = "1 day") -> DataFrame:
    """Count and sum by tumbling window; late rows within the delay still count."""
    return (
        events.withWatermark(time, delay)
        .groupBy(F.window(time, width).alias("w"), *keys)
        .agg(F.count("*").alias("n"), F.sum(value).alias("total"))
        .select(F.col("w.start").alias("window_start"), *keys, "n", "total")
    )


def drained(spark: SparkSession, folder: str, schema: StructType, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Everything that is in a folder now, run through a streaming transformation and written once; reads the result."""
    stream = spark.readStream.schema(schema).parquet(folder)
    query = transform(stream).writeStream.outputMode(mode).format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(out)


def until_done(todo: Callable[[], DataFrame], work: Callable[[DataFrame], None], most: int = 100) -> int:
    """Works on what is left until nothing is, or a round leaves as much as it found. Returns the rounds."""
    left = None
    for n in range(most):
        batch = todo()
        now = batch.count()
        if not now or now == left:
            return n
        left = now
        work(batch)
    return most

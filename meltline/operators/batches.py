"""Work on tiles with retries, and batches that end after a time."""

from __future__ import annotations

import time
import traceback
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor, TimeoutError, wait

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tiles whose outcomes leave a task together.
TOGETHER = 1000
OUTCOME = "start_time double, total_time double, attempts int, success boolean, error_messages string"


def told(e: Exception, places: dict) -> str:
    """The text of traceback.format_exc(limit=-1), stripped; the place an exception comes from is put in words once."""
    if e.__cause__ or e.__context__ or isinstance(e, (SyntaxError, NameError, AttributeError, ImportError, BaseExceptionGroup)):
        return traceback.format_exc(limit=-1).strip()
    last = e.__traceback__
    while last.tb_next:
        last = last.tb_next
    at = last.tb_frame.f_code, last.tb_lasti
    if at not in places:
        if len(places) == TOGETHER:
            places.clear()
        places[at] = "Traceback (most recent call last):\n" + "".join(traceback.format_tb(last))
    return (places[at] + "".join(traceback.format_exception_only(e))).strip()


def attempted(tiles: DataFrame, work: Callable[[dict], dict], fields: str, retries: int = 0, keys: Sequence[str] = ("row", "col")) -> DataFrame:
    """Every tile with the fields that work gives for it, start and duration in seconds, attempts, success and errors.

    An exception is an attempt; after the last one the fields are null, success is false and error_messages holds the
    text of each. A task that is lost with its executor is run again by Spark, whatever the retries.
    """

    def frame(rows: list[dict]) -> pd.DataFrame:
        """Whole numbers beside missing ones stay whole."""
        held = {n: pd.Series([r[n] for r in rows], dtype=object) for n in names}
        plain = {n: s.infer_objects() for n, s in held.items()}
        return pd.DataFrame({n: held[n] if s.dtype.kind == "f" and any(isinstance(v, (int, np.integer)) for v in held[n]) else s for n, s in plain.items()})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places = {}
        for batch in batches:
            rows = []
            for tile in batch.to_dict("records"):
                start, errors, got = time.time(), [], {}
                while len(errors) <= retries:
                    try:
                        got = work(dict(tile))
                        break
                    except Exception as e:  # noqa: BLE001
                        errors.append(told(e, places))
                done = len(errors) <= retries
                own = {"start_time": start, "total_time": time.time() - start, "attempts": len(errors) + done, "success": done, "error_messages": "\n".join(errors) or None}
                rows.append({**dict.fromkeys(names), **tile, **got, **own})
                if len(rows) == TOGETHER:
                    yield frame(rows)
                    rows = []
            if rows:
                yield frame(rows)

    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in tiles.schema.fields]
    schema = ", ".join([*columns, fields, OUTCOME])
    names = tiles.sparkSession.createDataFrame([], schema).columns
    tasks = 4 * tiles.sparkSession.sparkContext.defaultParallelism  # a number, since small tiles would be put into few tasks, however long their work
    return tiles.repartition(tasks, *[F.col(k) for k in keys]).mapInPandas(run, schema)


def within(batch: DataFrame, seconds: float, done: Callable[[DataFrame, int], None], path: str, keys: Sequence[str], by: Column | None = None, pieces: int = 16) -> DataFrame:
    """Tiles of a batch for which done(part, number) hasn't ended in time, or has failed, with the reason in error_messages.

    The batch is cut into pieces by a hash of its keys (or by a number from 0 on, null for 0), which run as separate jobs at once, so that what has been done by then
    counts; done should write what it makes into a folder of the piece's own, since jobs that write into one folder at
    once remove each other's files. After so many seconds the jobs that still run are cancelled. path is a
    folder for the batch itself, which is written once, so that all pieces and the rest are cut from the same rows.
    """
    spark, tag = batch.sparkSession, f"batch-{uuid.uuid4().hex}"
    place = F.pmod(F.xxhash64(*keys), F.lit(pieces)).cast("int") if by is None else F.coalesce(by, F.lit(0))
    batch.withColumn("_piece", place).write.mode("overwrite").partitionBy("_piece").parquet(path)
    rows = spark.read.schema(batch.withColumn("_piece", F.lit(0)).schema).parquet(path)

    def one(k: int) -> None:
        spark.sparkContext.addJobTag(tag)
        done(rows.where(F.col("_piece") == k).drop("_piece"), k)

    pool = ThreadPoolExecutor(pieces)
    runs = {pool.submit(one, k): k for k in range(pieces)}
    late = wait(runs, seconds).not_done
    if late:
        spark.sparkContext.cancelJobsWithTag(tag)
    pool.shutdown(wait=False, cancel_futures=True)
    reasons = []
    for f, k in runs.items():
        error = TimeoutError(f"not done in {seconds} s") if f in late else f.exception()
        if error is not None:
            reasons.append((k, f"{type(error).__name__}: {error}"[:1000]))
    failed = spark.createDataFrame(reasons, "_piece int, error_messages string")
    return rows.join(F.broadcast(failed), "_piece").drop("_piece").withColumn("success", F.lit(False))

"""Helpers shared by the corpus operators: shared-folder tables, Arrow slices, word hashing, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words kept in one worker's hash cache before it is emptied.
WORD_CACHE = 1 << 17
#: Bytes of text handled at once inside a Python worker.
SLICE_BYTES = 4 << 20
#: Ids up to which a table of them is broadcast; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: A-Z to lower case, every other ASCII byte outside 0-9 and a-z to a space; bytes of longer characters stay.
ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share. A folder of our own is set only in local mode, where none is named."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="meltline-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """df written as a table in the shared folder and read back: lineage ends there, and lost executors cost nothing."""
    path = f"{shared_dir(df.sparkSession)}/meltline/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(ids: DataFrame, tag: str, most: int = BROADCAST_IDS) -> DataFrame:
    """A stored table of distinct ids, marked for broadcast where it has at most so many rows."""
    made = stored(ids.distinct(), tag)
    return F.broadcast(made) if made.count() <= most else made


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Arrow batches of few rows, since one text may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return pc.cast(batch.column(batch.schema.get_field_index(column)), pa.binary()).to_pylist()


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Runs of rows with at most limit bytes of text (or one row), with their texts as bytes."""
    for batch in batches:
        got, start, size = texts(batch, column), 0, 0
        for i, t in enumerate(got):
            size += len(t or b"")
            if size > limit and i > start:
                yield batch.slice(start, i - start), got[start:i]
                start, size = i, len(t or b"")
        if start < len(got):
            yield batch.slice(start), got[start:]


def gathered(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[list[tuple[pa.RecordBatch, list]]]:
    """Slices put together until they hold limit bytes of text."""
    some, size = [], 0
    for batch, got in slices(batches, limit=limit):
        some.append((batch, got))
        size += sum(map(len, filter(None, got)))
        if size >= limit:
            yield some
            some, size = [], 0
    if some:
        yield some


_HELD: list = []


def holding(cache: dict) -> dict:
    """Registers a cache of this worker process, which release() empties."""
    _HELD.append(cache)
    return cache


def release(*but: dict) -> None:
    """Empties the caches of this worker process, but for some, and gives back Arrow's spare memory: workers are used
    again by later stages."""
    pa.default_memory_pool().release_unused()
    for cache in _HELD:
        if cache and not any(cache is b for b in but):
            cache.clear()


class WordHash(dict):
    """Word to 64-bit hash; emptied when it holds WORD_CACHE words, and by release()."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lists(values: np.ndarray, counts: Iterable[int], kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from concatenated values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def mapped(df: DataFrame, f: Callable, schema: str) -> DataFrame:
    """mapInArrow with small batches."""
    small_batches(df.sparkSession)
    return df.mapInArrow(f, schema)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id that each id of an edge table reaches.

    Alternates large-star and small-star steps, each stored in the shared folder, until the edges form stars around
    the smallest ids. All state stays distributed; edges of a hub are reduced to its minimum before they are joined.
    """
    spark = edges.sparkSession
    found = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges"
    )
    mark = lambda e: e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
    was = mark(found)
    while was[0]:
        both = found.unionByName(found.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large.where("u <> v"), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(least, "u")
        small = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        found = stored(small.distinct(), "small-star")
        now = mark(found)
        if now == was:
            break
        was = now
    ids = found.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component")
    roots = found.select(F.col("v").alias("id")).distinct()
    return ids.unionByName(roots.select("id", F.col("id").alias("component")))

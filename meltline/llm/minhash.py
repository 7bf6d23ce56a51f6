"""Near duplicates by one-permutation MinHash.

Each text becomes a set of word shingles. One hash splits the set over BINS bins, the smallest value of each bin is
kept, and an empty bin copies the value of a full one chosen by its own sequence of hashes (optimal densification).
Bands of ROWS bins give bucket keys. Texts with equal sets are one class, so only different sets meet in buckets.

Each task first makes stars of the members of a bucket that it holds itself, so a bucket sends one row a task into the
shuffle; there the smallest id becomes the centre of a star. The candidates are the stars' edges, so their number is
linear in the buckets. They are confirmed on full sets. Members that are still in different components are not given
up: those outside a bucket's largest component are first tried against the PROBES most central members of the bucket.
What is left goes through an exact prefix-filtered join over full sets: shingles ordered by rarity, prefixes that
linked sets must share, and bounds on size and position. No link inside a bucket is lost, nothing is capped.
A pair at the threshold of 0.8 shares no bucket with probability (1 - 0.8**8)**64 = 8e-6, at 0.85 with 1e-9.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, WordHash, components, counted, holding, lists, mapped, mixed, release, slices, stored

BINS, ROWS = 512, 8
BANDS = BINS // ROWS
#: Central members that are tried first, and bucket keys that a task groups at once.
PROBES, CHUNK = 8, 1 << 20
_WORDS = holding(WordHash())
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of one text; a shorter text is one shingle of all its words."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    take = min(size, n)
    out = np.full(n - take + 1, take, np.uint64)
    for j in range(take):
        out = mixed((out + words[j : n - take + 1 + j]) * _STEP)
    return np.unique(out)


def sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    release(_WORDS)
    parts = [(t or b"").translate(LOWER).split() for t in texts]
    hashed = _WORDS.of([w for p in parts for w in p])
    ends = np.cumsum([0, *map(len, parts)])
    return [_shingles(hashed[a:b], size) for a, b in zip(ends, ends[1:])]


def _choices(attempt: int) -> np.ndarray:
    """The bin that each empty bin looks at in its attempt-th try."""
    return (mixed((np.arange(BINS, dtype=np.uint64) + np.uint64(attempt * BINS)) * _STEP + _STEP) % np.uint64(BINS)).astype(np.int64)


def bands(found: list[np.ndarray]) -> np.ndarray:
    """Bucket keys, one row per set that isn't empty."""
    shift = np.uint64(64 - (BINS - 1).bit_length())
    least, full = np.zeros((len(found), BINS), np.uint64), np.zeros((len(found), BINS), bool)
    for k, s in enumerate(found):
        at = (s >> shift).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        least[k, at[first]], full[k, at[first]] = s[first], True
    row, col = np.nonzero(~full)
    attempt = 0
    while len(row):
        attempt += 1
        source = _choices(attempt)[col]
        hit = full[row, source]
        least[row[hit], col[hit]] = least[row[hit], source[hit]]
        row, col = row[~hit], col[~hit]
    keys = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(found), 0)
    cut = least.reshape(len(found), BANDS, ROWS)
    for j in range(ROWS):
        keys = mixed((keys + cut[:, :, j]) * _STEP)
    return keys


def _signatures(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, got in slices(batches):
            found = sets(got, size)
            some = [s for s in found if len(s)]
            keys = bands(some)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")),
                    pa.array([len(s) for s in found], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in found], pa.binary()),
                    lists(keys.reshape(-1).view(np.int64), [BANDS if len(s) else 0 for s in found], pa.int64()),
                ],
                ["doc_id", "n_shingles", "set_id", "bands"],
            )

    return run


def _full_sets(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, got in slices(batches):
            found = sets(got, size)
            joined = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), lists(joined.view(np.int64), [len(s) for s in found], pa.int64())],
                ["id", "shingles"],
            )

    return run


def _stars(local: bool):
    """Of the bucket rows of a task: members with their local centre (local), or centres with their number of members."""

    def grouped(ids: list[np.ndarray], keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        k, r = np.concatenate(keys), np.repeat(np.concatenate(ids), BANDS)
        order = np.lexsort((r, k))
        k, r = k[order], r[order]
        new = np.r_[True, k[1:] != k[:-1]]
        first = np.flatnonzero(new)
        n = np.diff(np.r_[first, len(k)])
        key, rep, other = (k[~new], r[~new], np.repeat(r[first], n)[~new]) if local else (k[first], r[first], n)
        for i in range(0, len(key), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[i : i + 100_000].astype(np.int64)) for x in (key, rep, other)], ["key", "rep", "centre" if local else "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, keys, size = [], [], 0
        for batch in batches:
            if batch.num_rows:
                ids.append(batch.column(0).to_numpy(zero_copy_only=False))
                keys.append(batch.column(1).flatten().to_numpy())
                size += len(keys[-1])
            if size >= CHUNK:
                yield from grouped(ids, keys)
                ids, keys, size = [], [], 0
        if size:
            yield from grouped(ids, keys)

    return run


def near_duplicates(docs: DataFrame, size: int = 2, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept, for every row of docs.

    Two texts are linked when 100 * |intersection| >= percent * |union| of their sets of size-word shingles. Texts
    that are null, empty or without words have no shingles and are linked with nothing. Rows that repeat a doc_id are
    one node. A row without doc_id is linked with nothing: its component_id is null, and it is kept. An empty table gives an empty result; other columns of docs aren't read.
    """
    docs = docs.select("doc_id", "text")
    signed = stored(
        mapped(docs, _signatures(size), "doc_id long, n_shingles long, set_id binary, bands array<long>"), "signatures"
    )
    classes = stored(
        signed.where("set_id IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_id").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
        ),
        "classes",
    )
    keyed = classes.select("rep", "bands")
    own = Window.partitionBy("key")  # at most one row of each task
    centres = keyed.mapInArrow(_stars(False), "key long, rep long, n long")
    centres = centres.withColumns({"centre": F.min("rep").over(own), "m": F.sum("n").over(own)}).where("m > 1").select("key", "rep", "centre")
    near = stored(keyed.mapInArrow(_stars(True), "key long, rep long, centre long").unionByName(centres), "buckets")
    edges = near.where("rep <> centre").select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b"))
    edges = stored(edges.distinct(), "edges")
    full = _sets_of(docs, edges, size)
    linked = 100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))
    measured = _measured(_fitting(edges, classes.select("rep", "n"), percent), full)
    links = measured.where(linked).select("a", "b")
    label = components(links)
    apart = measured.withColumn("d", 1 - F.col("common") / (F.col("na") + F.col("nb") - F.col("common")))
    apart = apart.select(F.col("a").alias("rep"), "d").unionByName(apart.select(F.col("b").alias("rep"), "d")).groupBy("rep").agg(F.min("d").alias("d"))
    members = near.select("key", "rep")
    left = _unsettled(members, label)
    if not left.isEmpty():
        known = left.join(apart, "rep", "left").join(classes.select("rep", "n"), "rep")
        central = Window.partitionBy("key").orderBy(F.asc_nulls_last("d"), "rep")
        central = known.withColumn("k", F.row_number().over(central)).where(F.col("k") <= PROBES)
        tried = stored(_across(known, central, percent).distinct(), "probes")
        links = links.unionByName(_measured(tried, full).where(linked).select("a", "b"))
        label = components(links)
        left = _unsettled(members, label)
        rest = left.groupBy("rep").agg(F.max("outside").alias("outside"), F.min("comp").alias("comp"))
        pairs = stored(_prefix_join(rest, full, percent).distinct(), "remainder")
        links = links.unionByName(_measured(pairs, full).where(linked).select("a", "b"))
        label = components(links)
    own = classes.join(label, F.col("rep") == F.col("id"), "left").select("set_id", F.coalesce("component", "rep").alias("found"))
    return signed.select("doc_id", "n_shingles", "set_id").join(own, "set_id", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id")).alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _sets_of(docs: DataFrame, edges: DataFrame, size: int) -> DataFrame:
    """Full sets of the ends of edges. Few ids are broadcast, so that texts stay where they are; many are shuffled."""
    ends = counted(edges.select(F.col("a").alias("doc_id")).unionByName(edges.select(F.col("b").alias("doc_id"))), "ends")
    return stored(mapped(docs.join(ends, "doc_id", "left_semi"), _full_sets(size), "id long, shingles array<long>"), "sets")


def _unsettled(members: DataFrame, label: DataFrame) -> DataFrame:
    """Bucket rows with their component, of buckets with more than one; outside: not in the bucket's largest one."""
    named = members.join(label, F.col("rep") == F.col("id"), "left").select("key", "rep", F.coalesce("component", "rep").alias("comp"))
    per = named.groupBy("key", "comp").agg(F.count("*").alias("m")).groupBy("key").agg(F.max(F.struct("m", "comp"))["comp"].alias("main"), F.count("*").alias("parts"))
    return stored(named.join(per.where("parts > 1").select("key", "main"), "key").withColumn("outside", F.col("comp") != F.col("main")), "unsettled")


def _pair(x: str = "x", y: str = "y") -> list:
    low = F.col(x) < F.col(y)
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), F.when(low, F.col("nx")).otherwise(F.col("ny")).alias("na"), F.when(low, F.col("ny")).otherwise(F.col("nx")).alias("nb")]


def _across(some: DataFrame, others: DataFrame, percent: int) -> DataFrame:
    """Pairs of outside members of some with members of others in the same bucket and another component."""
    x = some.where("outside").select("key", F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("comp").alias("cx"))
    y = others.select("key", F.col("rep").alias("y"), F.col("n").alias("ny"), F.col("comp").alias("cy"))
    could = 100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")
    return x.join(y, "key").where((F.col("cx") != F.col("cy")) & could).select(*_pair())


def _prefix_join(rest: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs of an outside set with a set of another component that may be linked, by prefixes and positions."""
    sets = rest.join(full.withColumnRenamed("id", "rep"), "rep").withColumn("n", F.size("shingles").cast("long"))
    tokens = stored(sets.select("rep", F.explode("shingles").alias("token")), "tokens")
    ranked = tokens.join(tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "token", "left")
    ordered = ranked.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(1)).alias("df"), "token"))).alias("order"))
    prefix = F.slice("order", F.lit(1), (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int"))
    held = ordered.join(sets.select("rep", "n", "outside", "comp"), "rep").select("rep", "n", "outside", "comp", F.posexplode(prefix).alias("at", "t")).where("t.df > 1")
    held = stored(held.select("rep", "n", "outside", "comp", "at", "t.token"), "prefixes")
    x = held.where("outside").select("token", F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("comp").alias("cx"), F.col("at").alias("ax"))
    y = held.select("token", F.col("rep").alias("y"), F.col("n").alias("ny"), F.col("comp").alias("cy"), F.col("at").alias("ay"))
    could = (100 + percent) * F.least(F.col("nx") - F.col("ax"), F.col("ny") - F.col("ay")) >= percent * (F.col("nx") + F.col("ny"))
    return x.join(y, "token").where((F.col("cx") != F.col("cy")) & could).select(*_pair())


def _fitting(edges: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Edges with the sizes of both sets, where these allow a link."""
    near = edges.join(sizes.select(F.col("rep").alias("a"), F.col("n").alias("na")), "a")
    near = near.join(sizes.select(F.col("rep").alias("b"), F.col("n").alias("nb")), "b")
    return near.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))


def _measured(near: DataFrame, full: DataFrame) -> DataFrame:
    """Pairs with the size of their sets' intersection."""
    left = near.join(full.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    both = left.join(full.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
    return stored(both.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("common")), "measured")

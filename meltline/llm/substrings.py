"""Removal of passages that repeat from earlier documents, with a count-min prefilter.

A window is SIZE consecutive words. Every window holds a smallest gram of GRAM words (by hash), and equal windows hold
the same one, so the number of documents with a window is at most the number with its gram. Each partition counts the
grams of its documents in a count-min sketch; the merged sketch overestimates, so a window whose gram is estimated in
one document only can't repeat. A second pass emits the other windows, packed by gram, and they
alone are grouped, exactly, by gram and window hash (128 bits): the rows of a gram come sorted by doc_id and are
settled as they stream by. Grams with more than HOT rows are grouped window by window instead: partial minima, then a
broadcast of them where they are few, else a join over salted keys. Only texts that lose words are shuffled. Grams are about a twentieth of the windows, so the sketch stays small; its width
follows the bytes of text up to 2**MOST_BITS cells a row, beyond which it lets more windows through but loses none.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHash, counted, holding, mapped, mixed, release, slices, stored

SIZE, GRAM = 50, 10
#: Rows of the sketch, its least and largest width (as powers of two), and cells of a chunk that is merged by itself.
DEPTH, LEAST_BITS, MOST_BITS, CHUNK = 2, 16, 26, 1 << 20
#: Windows of a packed row, rows from which a gram is hot, parts of a hot key, and rows of a table that is broadcast.
PACK, HOT, SALTS, FEW = 64, 4096, 32, 1_000_000
_WORDS = holding(WordHash())
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03))


def _hashed(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts, and where each text begins and ends among them."""
    release(_WORDS)
    parts = [(t or b"").split() for t in texts]
    return _WORDS.of([w for p in parts for w in p]), np.cumsum([0, *map(len, parts)])


def _rolled(words: np.ndarray, size: int, odd: np.uint64) -> np.ndarray:
    """A hash of each run of size words: sum of word * odd**place modulo 2**64, brought to place 0 and mixed."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = np.full(len(words), odd)
    power[0] = 1
    power = np.multiply.accumulate(power)
    inverse = np.full(n, np.uint64(pow(int(odd), -1, 1 << 64)))
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    total = np.r_[np.uint64(0), np.add.accumulate(mixed(words ^ odd) * power)]
    return mixed((total[size:] - total[:-size]) * inverse)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of width values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def _windows(words: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every window inside one text: its place among all words, its text's number, its smallest gram."""
    if len(words) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    gram = _least(_rolled(words, min(GRAM, size), _ODD[0]), size - min(GRAM, size) + 1)
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    at = np.flatnonzero(text[: len(words) - size + 1] == text[size - 1 :])
    return at, text[at], gram[at]


def _cells(grams: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(mixed(grams + np.uint64((r + 1) * int(_ODD[1]) % (1 << 64))) >> np.uint64(64 - bits)).astype(np.int64) for r in range(DEPTH)]


def _sketch(size: int, bits: int):
    """Count-min cells of a partition, up to 2 (more isn't needed), in compressed chunks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((DEPTH, 1 << bits), np.uint8)
        for _, got in slices(batches):
            words, ends = _hashed(got)
            _, text, gram = _windows(words, ends, size)
            once = gram[np.unique(mixed(gram + text.astype(np.uint64) * _ODD[0]), return_index=True)[1]]
            for r, cell in enumerate(_cells(once, bits)):
                cell, n = np.unique(cell, return_counts=True)
                counts[r, cell] = np.minimum(2, counts[r, cell] + np.minimum(n, 2))
        for r in range(DEPTH):
            for k in range(0, 1 << bits, CHUNK):
                part = counts[r, k : k + CHUNK]
                if part.any():
                    yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([k], pa.int64()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], ["r", "k", "cells"])

    return run


def _sum(parts: pa.Table) -> np.ndarray:
    total = None
    for cells in parts.column("cells").to_pylist():
        part = np.frombuffer(zlib.decompress(cells), np.uint8)
        total = part if total is None else np.minimum(2, total + part)
    return total


def _chunk(key: tuple, cells: np.ndarray) -> pa.Table:
    packed = zlib.compress(cells.tobytes(), 1)
    return pa.table({"r": pa.array([key[0].as_py()], pa.int32()), "k": pa.array([key[1].as_py()], pa.int64()), "cells": pa.array([packed], pa.binary())})


def _summed(key: tuple, parts: pa.Table) -> pa.Table:
    return _chunk(key, _sum(parts))


def _merged(key: tuple, parts: pa.Table) -> pa.Table:
    return _chunk(key, np.packbits(_sum(parts) >= 2))


def _repeated(docs: DataFrame, size: int) -> Broadcast:
    """For each row of the merged sketch a bit a cell: whether two documents or more fell into it."""
    text_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, int(text_bytes // 32).bit_length()))
    made = mapped(docs.select("text"), _sketch(size, bits), "r int, k long, cells binary")
    salted = made.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(16)))
    first = salted.groupBy("r", "k", "salt").applyInArrow(_summed, "r int, k long, cells binary")
    full = np.zeros((DEPTH, 1 << bits >> 3), np.uint8)
    for r in first.groupBy("r", "k").applyInArrow(_merged, "r int, k long, cells binary").toLocalIterator():
        part = np.frombuffer(zlib.decompress(r[2]), np.uint8)
        full[r[0], r[1] >> 3 : (r[1] >> 3) + len(part)] = part
    return docs.sparkSession.sparkContext.broadcast((bits, full))


def _suspects(size: int, sketch: Broadcast):
    """The windows that the sketch can't rule out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, full = sketch.value
        for batch, got in slices(batches):
            words, ends = _hashed(got)
            at, text, gram = _windows(words, ends, size)
            often = np.ones(len(gram), bool)
            for r, cell in enumerate(_cells(gram, bits)):
                often &= (full[r, cell >> 3] >> (7 - (cell & 7)) & 1).astype(bool)
            at, text, gram = at[often], text[often], gram[often]
            if len(at):
                ids, keys = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("doc_id", "key"))
                hashes = _rolled(words, size, _ODD[1])[at]
                run = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (np.diff(text) != 0) | (gram[1:] != gram[:-1])])
                inside = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
                first = np.flatnonzero(inside % PACK == 0)
                packed = [hashes[a:b].tobytes() for a, b in zip(first.tolist(), [*first[1:].tolist(), len(at)])]
                for k in range(0, len(first), 20_000):
                    cut = first[k : k + 20_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(gram[cut].view(np.int64)), pa.array(ids[text[cut]]), pa.array(keys[text[cut]]), pa.array((at - ends[text])[cut].astype(np.int32)), pa.array(packed[k : k + 20_000], pa.binary())],
                        ["gram", "doc_id", "key", "at", "windows"],
                    )

    return run


def _settled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of window starts that an earlier document has, from rows sorted by gram and doc_id."""
    gram, first = None, {}
    for batch in batches:
        docs, keys, spans = [], [], []
        for g, doc, key, at, windows in zip(*(batch.column(k).to_pylist() for k in range(5))):
            if g != gram:
                gram, first = g, {}
            see, out = first.setdefault, []
            for k, h in enumerate(np.frombuffer(windows, np.int64).tolist(), at):
                if see(h, doc) < doc:
                    if out and out[-1] == k:
                        out[-1] = k + 1
                    else:
                        out += (k, k + 1)
            if out:
                docs.append(doc)
                keys.append(key)
                spans.append(out)
        if docs:
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(keys, pa.int64()), pa.array(spans, pa.list_(pa.int32()))], ["doc_id", "key", "spans"])


def _unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        windows = [np.frombuffer(w, np.int64) for w in batch.column(4).to_pylist()]
        n = np.array([len(w) for w in windows], np.int64)
        if len(n):
            places = np.repeat(batch.column(3).to_numpy(), n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            gram, doc, key = (np.repeat(batch.column(k).to_numpy(), n) for k in (0, 1, 2))
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(np.concatenate(windows)), pa.array(doc), pa.array(key), pa.array(places.astype(np.int32))], ["gram", "window", "doc_id", "key", "at"])


def _repeats(rows: DataFrame, hot_rows: int = HOT) -> DataFrame:
    """doc_id, key and spans of window starts that a document with a smaller doc_id has too."""
    hot = counted(rows.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > hot_rows).select("gram"), "hot-grams", FEW)
    light = rows.join(hot, "gram", "left_anti").repartition("gram").sortWithinPartitions("gram", "doc_id")
    spans = light.mapInArrow(_settled, "doc_id long, key long, spans array<int>")
    each = rows.join(hot, "gram", "left_semi").mapInArrow(_unpacked, "gram long, window long, doc_id long, key long, at int")
    least = stored(each.groupBy("gram", "window").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last"), "least")
    if least.count() <= FEW:
        later = each.join(F.broadcast(least), ["gram", "window"])
    else:
        salts = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        later = each.withColumn("salt", F.pmod(F.xxhash64("doc_id", "at"), F.lit(SALTS)).cast("int")).join(salts, ["gram", "window", "salt"])
    return spans.unionByName(later.where("doc_id > first").select("doc_id", "key", F.array("at", F.col("at") + 1).alias("spans")))


def _with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """docs with the spans of each; where few rows have any, only their texts are shuffled."""
    if spans.count() > FEW:
        return docs.join(spans, ["doc_id", "key"], "left")
    hit = F.broadcast(spans.select("doc_id", "key"))
    touched = docs.join(hit, ["doc_id", "key"], "left_semi").join(spans, ["doc_id", "key"])
    return touched.unionByName(docs.join(hit, ["doc_id", "key"], "left_anti").withColumn("spans", F.lit(None).cast("array<int>")))


def _cut(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, got in slices(batches):
            out: dict[str, list] = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept_text": []}
            spans = batch.column(batch.schema.get_field_index("spans")).to_pylist()
            for t, hit in zip(got, spans):
                words = (t or b"").split()
                kept = words
                if hit:
                    step = np.zeros(len(words) + 1, np.int64)
                    at = np.array(hit, np.int64)
                    np.add.at(step, at[::2], 1)
                    np.add.at(step, at[1::2] + size - 1, -1)
                    keep = np.cumsum(step[:-1]) == 0
                    kept = [w for w, k in zip(words, keep.tolist()) if k]
                joined = b" ".join(kept)
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(kept))
                out["kept_sha256"].append(hashlib.sha256(joined).hexdigest())
                out["kept_text"].append(joined.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["kept_sha256"], pa.string()), pa.array(out["kept_text"], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return run


def deduplicated(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text for every row of docs.

    Each word is removed that is covered by a window of size words whose words also start in a document with a smaller
    doc_id. Windows are judged on the input. Repeats inside one document, or between rows with the same doc_id, remove
    nothing; rows with the same doc_id and different texts are judged apart. A row without doc_id stays as it is and
    removes nothing; texts that are null or shorter than a window stay as they are. An empty table gives an empty
    result; other columns aren't read.
    """
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    known = docs.where("doc_id IS NOT NULL")
    sketch = _repeated(known, size)
    rows = stored(mapped(known, _suspects(size, sketch), "gram long, doc_id long, key long, at int, windows binary"), "windows")
    spans = stored(_repeats(rows).groupBy("doc_id", "key").agg(F.flatten(F.collect_list("spans")).alias("spans")), "spans")
    return mapped(_with_spans(docs, spans), _cut(size), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")

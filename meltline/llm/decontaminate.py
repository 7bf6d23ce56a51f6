"""Benchmark decontamination by a prefix-filtered containment join.

A window is WINDOW consecutive words of an item (all of a shorter item). It occurs in a document when all its shingles
do, in place; so its rarest shingle alone is a sufficient prefix of its shingles ordered by rarity. The order uses the
shingles' counts over all documents. Each document position that holds a prefix shingle gives candidates; they are cut
by length and position (the window must lie inside the document) and verified word by word.

The benchmark is joined in blocks of at most BLOCK words. The index of a block, bounded by BLOCK, is broadcast and meets
all documents; where there are several blocks, what each one finds is written before the next one is built, so that the
driver holds one at a time, and is put together by numbers that the document rows got once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, lists, mapped, release, slices, stored

#: Words of a window, and benchmark words in a block.
WINDOW, BLOCK = 10, 1_000_000


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(ALNUM).split()


class Index:
    """The windows of one block of items, each under its rarest shingle of two words (one, for a one-word item)."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        self.base = len(self.vocabulary) + 1
        found: dict[tuple[int, ...], set[int]] = {}
        self.items = [k for k, ws in items if ws]
        for n, ws in enumerate(ws for _, ws in items if ws):
            ids = [self.vocabulary[w] for w in ws]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1):
                found.setdefault(tuple(ids[i : i + size]), set()).add(n)
        self.windows = list(found.items())

    def codes(self, ids: np.ndarray) -> np.ndarray:
        """Shingle codes of a run of word ids, -1 where a word isn't in the vocabulary."""
        a, b = ids[:-1], ids[1:]
        return np.where((a >= 0) & (b >= 0), a * self.base + b, -1)

    def shingles(self) -> np.ndarray:
        pairs = {a * self.base + b for w, _ in self.windows for a, b in zip(w, w[1:])}
        return np.array(sorted(pairs), np.int64)

    def order(self, count: dict[int, int]) -> None:
        """Keeps each window under its rarest shingle; ties go to the first."""
        rows = []
        for k, (w, _) in enumerate(self.windows):
            if len(w) == 1:
                rows.append((-1 - w[0], 0, k))
                continue
            pairs = [a * self.base + b for a, b in zip(w, w[1:])]
            at = min(range(len(pairs)), key=lambda i: (count.get(pairs[i], 0), i))
            rows.append((pairs[at], at, k))
        rows.sort()
        self.keys = np.array(sorted({r[0] for r in rows}), np.int64)
        self.first = np.searchsorted([r[0] for r in rows], self.keys) if rows else np.zeros(0, np.int64)
        self.many = np.diff(np.r_[self.first, len(rows)]) if rows else np.zeros(0, np.int64)
        self.at = np.array([r[1] for r in rows], np.int64)
        self.window = np.array([r[2] for r in rows], np.int64)
        self.length = np.array([len(w) for w, _ in self.windows], np.int64)
        width = int(self.length.max()) if self.windows else 1
        self.content = np.full((len(self.windows), width), -2, np.int64)
        for k, (w, _) in enumerate(self.windows):
            self.content[k, : len(w)] = w

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and window number of every occurrence in a document's word ids."""
        keys = np.concatenate([self.codes(ids), np.where(ids >= 0, -1 - ids, np.iinfo(np.int64).max)])
        spot = np.concatenate([np.arange(max(0, len(ids) - 1)), np.arange(len(ids))])
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        k = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[k] == keys)
        many = self.many[k[hit]]
        row = np.repeat(self.first[k[hit]], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        start = np.repeat(spot[hit], many) - self.at[row]
        window = self.window[row]
        fits = (start >= 0) & (start + self.length[window] <= len(ids))
        start, window = start[fits], window[fits]
        padded = np.r_[ids, np.full(self.content.shape[1], -3)]
        good = np.ones(len(start), bool)
        for j in range(self.content.shape[1]):
            good &= (padded[start + j] == self.content[window, j]) | (j >= self.length[window])
        return start[good], window[good]


def _ids(index: Index, texts: list[bytes | None]) -> Iterator[np.ndarray]:
    """Word ids of each text, -1 for a word that no item has."""
    release()
    number = index.vocabulary.get
    for t in texts:
        ws = words(t)
        yield np.fromiter((number(w, -1) for w in ws), np.int64, len(ws))


def _counts(shared: Broadcast):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        wanted = index.shingles()
        total = np.zeros(len(wanted) + 1, np.int64)
        for _, got in slices(batches):
            for ids in _ids(index, got):
                codes = index.codes(ids)
                codes = codes[codes >= 0]
                k = np.minimum(np.searchsorted(wanted, codes), max(0, len(wanted) - 1))
                if len(wanted):
                    total += np.bincount(k[wanted[k] == codes], minlength=len(total))
        some = np.flatnonzero(total[: len(wanted)])
        yield pa.RecordBatch.from_arrays([pa.array(wanted[some]), pa.array(total[some])], ["shingle", "n"])

    return run


def _search(shared: Broadcast):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch, got in slices(batches):
            n_words, spans, span_counts, items = [], [], [], []
            for ids in _ids(index, got):
                start, window = index.find(ids)
                hit = np.zeros(len(ids) + 1, np.int64)
                np.add.at(hit, start, 1)
                np.add.at(hit, start + index.length[window], -1)
                covered = np.r_[0, (np.cumsum(hit)[: len(ids)] > 0).astype(np.int8), 0]
                edges = np.flatnonzero(np.diff(covered))
                n_words.append(len(ids))
                spans.append(edges)
                span_counts.append(len(edges))
                items.append(sorted({index.items[i] for w in np.unique(window) for i in index.windows[w][1]}))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(batch.schema.get_field_index(c)) for c in ("row", "doc_id")),
                    pa.array(n_words, pa.int64()),
                    lists(np.concatenate([np.zeros(0, np.int64), *spans]), span_counts, pa.int64()),
                    pa.array(items, pa.list_(pa.string())),
                ],
                ["row", "doc_id", "n_words", "spans", "items"],
            )

    return run


def _result(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals per document, from the spans and items of all blocks."""
    for batch in batches:
        out: dict[str, list] = {"n_hit": [], "n_items": [], "items_sha256": []}
        for spans, items in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            end = hit = 0
            for a, b in sorted((s[i], s[i + 1]) for s in spans for i in range(0, len(s), 2)):
                hit += max(0, b - max(a, end))
                end = max(end, b)
            names = sorted({x for y in items for x in y})
            out["n_hit"].append(hit)
            out["n_items"].append(len(names))
            out["items_sha256"].append(sha256(",".join(names).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(out["n_hit"], pa.int64()), pa.array(out["n_items"], pa.int64()), pa.array(out["items_sha256"], pa.string()), pa.array([x > 0 for x in out["n_hit"]])],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def _finished(search: Callable) -> Callable:
    """The totals right after the search of the only block, in the same Python worker."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def single(b: pa.RecordBatch) -> pa.RecordBatch:
            each = pa.array(np.arange(b.num_rows + 1, dtype=np.int32))
            return pa.RecordBatch.from_arrays([b.column(1), b.column(2), *(pa.ListArray.from_arrays(each, b.column(k)) for k in (3, 4))], ["doc_id", "n_words", "spans", "items"])

        return _result(map(single, search(batches)))

    return run


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Runs of items with at most BLOCK words, or one item, fetched one block at a time in the order of item_id."""
    block, size = [], 0
    for r in benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("binary")).orderBy("item_id", "text").toLocalIterator():
        ws = words(None if r[1] is None else bytes(r[1]))
        if block and size + len(ws) > BLOCK:
            yield block
            block, size = [], 0
        block.append((r[0], ws))
        size += len(ws)
    if block:
        yield block


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of docs.

    Null and empty texts have no words and no hits, and such items no windows. Items with equal texts are all counted;
    rows that repeat an item_id are one item; a null item_id is an empty one. Without items nothing is hit. Documents
    are judged row by row, repeated ones and those without doc_id too; only doc_id and text, item_id and text are read.
    """
    sc = docs.sparkSession.sparkContext
    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    schema = "row long, doc_id long, n_words long, spans array<long>, items array<string>"
    out = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    blocks = _blocks(benchmark)
    items, after = next(blocks, []), next(blocks, None)
    if after is None:
        return mapped(rows, _finished(_search(sc.broadcast(_ordered(items, docs, window)))), out)
    rows, parts = stored(rows, "rows"), []
    for items in chain([items, after], blocks):
        shared = sc.broadcast(_ordered(items, rows, window))
        parts.append(stored(mapped(rows, _search(shared), schema), "block"))
        shared.destroy()
    every = reduce(DataFrame.unionByName, parts)
    found = every.groupBy("row", "doc_id", "n_words").agg(F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items"))
    return mapped(found.select("doc_id", "n_words", "spans", "items"), _result, out)


def _ordered(items: list[tuple[str, list[bytes]]], docs: DataFrame, window: int) -> Index:
    """The index of a block, its windows under the shingles that are rarest in docs."""
    index = Index(items, window)
    shared = docs.sparkSession.sparkContext.broadcast(index)
    count = mapped(docs.select("text"), _counts(shared), "shingle long, n long").groupBy("shingle").agg(F.sum("n"))
    index.order({r[0]: r[1] for r in count.collect()} if index.items else {})  # at most as many rows as the block has shingles
    shared.destroy()
    return index

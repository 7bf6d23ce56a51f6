"""Quality classifier: a generalised additive model with pairwise interactions.

Features of the text are cut into quantile bins. Cyclic boosting visits the features in turn, fits a tree of a few
leaves to the gradient of the log loss over the bins of one feature, and adds a small step of it to that feature's
lookup table. The strongest interactions of what is left are then boosted as tables of two features. A score is the
logistic function of a sum of table entries: vectorised additions per bin, no trees at scoring time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, release, slices, stored

#: Labelled rows to fit on at most, taken by a hash of doc_id.
SAMPLE = 20_000
BINS, PAIR_BINS, ROUNDS, PAIR_ROUNDS, PAIRS, LEAVES, RATE = 24, 8, 120, 40, 6, 4, 0.15

FEATURES = (
    "log_words", "log_bytes", "mean_word", "long_words", "distinct_words", "repeated_next", "top_word", "distinct_lines", "mean_line",
    "upper", "digits", "non_ascii", "spaces", "commas_stops", "pipes_tabs", "marks", "exclaims", "brackets_quotes", "letter_entropy",
    "worded", "capital_words", "top_mark_words", "hex_words", "words_per_line",
)


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256)
    out[[ord(c) for c in chars]] = 1
    return out


_SETS = np.stack([
    _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("0123456789"), np.r_[np.zeros(128), np.ones(128)], _table(" \t\n\r\v\f"), _table(",."),
    _table("|\t"), _table("#$%&*+=<>@^_~\\/`"), _table("!?"), _table("()[]{}\"';:"),
])
_LETTERS = np.array([*range(97, 123)])


def features(text: bytes | None) -> list[float]:
    """The FEATURES of one text; of an empty one all are 0."""
    text = text or b""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, size = len(words), len(text)
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = (_SETS @ count) / size
    lengths = np.fromiter(map(len, words), np.int64, n)
    seen = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    letters = count[_LETTERS] + count[_LETTERS - 32]
    p = letters[letters > 0] / max(1, letters.sum())
    same = sum(map(bytes.__eq__, words[1:], words)) / max(1, n - 1)
    return [
        np.log1p(n), np.log1p(size), lengths.mean(), (lengths > 15).mean(), len(seen) / n, same, max(seen.values()) / n,
        len(set(lines)) / max(1, len(lines)), np.log1p(size / max(1, len(lines))), *share, float(-(p * np.log(p)).sum()),
        sum(map(bytes.isalpha, words)) / n, sum(map(bytes.istitle, words)) / n,
        sum(1 for w in words if not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in b".,") / n,
        sum(1 for w in words if len(w) > 20 and any(48 <= c <= 57 for c in w)) / n, np.log1p(n / max(1, len(lines))),
    ]


class Additive:
    """The model: bin edges, a lookup table per feature and per chosen pair of features, and an intercept."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> Additive:
        n, k = x.shape
        inner = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, j], inner)) if n else np.zeros(0) for j in range(k)]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        rate = np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3)
        self.intercept = float(np.log(rate / (1 - rate)))
        if not n or y.min() == y.max():
            return self
        bins = self._bins(x)
        f = np.full(n, self.intercept)
        for _ in range(ROUNDS):
            for j in range(k):
                p = 1 / (1 + np.exp(-f))
                step = self._tree(bins[j], y - p, p * (1 - p), len(self.tables[j]))
                self.tables[j] += step
                f += step[bins[j]]
        coarse = [self._coarse(j)[bins[j]] for j in range(k)]
        p = 1 / (1 + np.exp(-f))
        gain = {(a, b): self._gain(coarse[a] * PAIR_BINS + coarse[b], y - p, p * (1 - p)) for a in range(k) for b in range(a + 1, k)}
        self.pairs = sorted(gain, key=lambda ab: (-gain[ab], ab))[:PAIRS]
        self.pair_tables = [np.zeros(PAIR_BINS**2) for _ in self.pairs]
        for _ in range(PAIR_ROUNDS):
            for (a, b), t in zip(self.pairs, self.pair_tables):
                p = 1 / (1 + np.exp(-f))
                cell = coarse[a] * PAIR_BINS + coarse[b]
                g, h = (np.bincount(cell, v, PAIR_BINS**2) for v in (y - p, p * (1 - p)))
                step = self._quadrants(g.reshape(PAIR_BINS, -1), h.reshape(PAIR_BINS, -1)).reshape(-1)
                t += step
                f += step[cell]
        return self

    def _bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]

    def _coarse(self, j: int) -> np.ndarray:
        size = len(self.tables[j])
        return np.arange(size) * PAIR_BINS // max(size, PAIR_BINS)

    @staticmethod
    def _gain(cell: np.ndarray, g: np.ndarray, h: np.ndarray) -> float:
        return float((np.bincount(cell, g, PAIR_BINS**2) ** 2 / (np.bincount(cell, h, PAIR_BINS**2) + 5)).sum())

    @staticmethod
    def _tree(bins: np.ndarray, g: np.ndarray, h: np.ndarray, size: int) -> np.ndarray:
        """A step for each bin: the leaves of a tree over the ordered bins, split where it gains most."""
        g, h = np.r_[0, np.cumsum(np.bincount(bins, g, size))], np.r_[0, np.cumsum(np.bincount(bins, h, size))]
        worth = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1)
        leaves = [(0, size)]
        for _ in range(LEAVES - 1):
            best = (1e-9, 0, 0)
            for k, (a, b) in enumerate(leaves):
                if b - a > 1:
                    cuts = np.arange(a + 1, b)
                    gains = worth(a, cuts) + worth(cuts, b) - worth(a, b)
                    i = int(gains.argmax())
                    best = max(best, (float(gains[i]), k, int(cuts[i])))
            if not best[2]:
                break
            a, b = leaves.pop(best[1])
            leaves += [(a, best[2]), (best[2], b)]
        out = np.zeros(size)
        for a, b in leaves:
            out[a:b] = RATE * (g[b] - g[a]) / (h[b] - h[a] + 1)
        return out

    @staticmethod
    def _quadrants(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """A step for each cell of a pair: the best split of the one feature by the best split of the other."""
        gs, hs = (np.pad(v, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for v in (g, h))
        m, best, at = len(g), -1.0, (1, 1)
        for i in range(1, m):
            for j in range(1, m):
                score = 0.0
                for a, b in ((0, i), (i, m)):
                    for c, d in ((0, j), (j, m)):
                        s = gs[b, d] - gs[a, d] - gs[b, c] + gs[a, c]
                        score += s * s / (hs[b, d] - hs[a, d] - hs[b, c] + hs[a, c] + 5)
                if score > best:
                    best, at = score, (i, j)
        out = np.zeros_like(g)
        for a, b in ((0, at[0]), (at[0], m)):
            for c, d in ((0, at[1]), (at[1], m)):
                out[a:b, c:d] = RATE * g[a:b, c:d].sum() / (h[a:b, c:d].sum() + 5)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        bins = self._bins(x)
        f = np.full(len(x), self.intercept)
        for b, t in zip(bins, self.tables):
            f += t[b]
        for (a, b), t in zip(self.pairs, self.pair_tables):
            f += t[self._coarse(a)[bins[a]] * PAIR_BINS + self._coarse(b)[bins[b]]]
        return 1 / (1 + np.exp(-f))


def featured(docs: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """doc_id, other columns asked for, and the features of each row's text."""
    kept = ["doc_id", *also]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch, got in slices(batches):
            x = np.array([features(t) for t in got], np.float32).reshape(len(got), len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept), *(pa.array(x[:, j]) for j in range(x.shape[1]))], [*kept, *FEATURES]
            )

    schema = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept] + [f"{c} float" for c in FEATURES]
    return mapped(docs.select(*kept, "text"), run, ", ".join(schema))


def held_out(doc_id: str = "doc_id"):
    """True for rows that are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fitted(rows: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Additive:
    """The model for labels.quality, from at most sample labelled rows that aren't held out."""
    known = labels.select("doc_id", F.col("quality").alias("y")).where(F.col("y").isin(0, 1) & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    got = rows.join(F.broadcast(known), "doc_id").orderBy(F.xxhash64("doc_id"), *FEATURES).limit(sample).toPandas()
    return Additive().fit(got[list(FEATURES)].to_numpy(np.float32), got["y"].to_numpy(np.float64))


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, also: Sequence[str] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs, and the columns named in also.

    score estimates the chance that the text is of quality 1; it depends on the text alone. Empty and null texts have
    all features 0 and get a score like any other. Without labelled rows every score is 0.5; with labels of one kind it
    is their rate. predicted is 1 from a score of 0.5 on. A doc_id labelled twice counts once, with its higher label. Other columns aren't read.
    """
    rows = stored(featured(docs, also), "features")
    kept = ["doc_id", *also]
    model = fitted(rows, labels, sample)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(len(kept) + j).to_numpy(zero_copy_only=False) for j in range(len(FEATURES))], 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(model.score(x))], [*kept, "score"])

    out = rows.mapInArrow(run, ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept) + ", score double")
    return out.select(*kept, held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

"""Exact duplicates with a heavy-hitter split.

Each partition keeps Misra-Gries counters of its digests. A digest that makes up more than 1/COUNTERS of all rows is
frequent in some partition, so the union of the counters holds every frequent digest. The candidates' true counts and
smallest ids are then counted exactly with map-side partial sums; these verified winners (at most LIST of them, a
proven bound) are broadcast, and their rows are settled where they lie. All other digests are grouped by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Counters of a partition; a digest is frequent from 1/SHARE of all rows on. LIST follows from the counters' error.
COUNTERS, SHARE = 8192, 2048
LIST = 4 * SHARE // 3 + 1


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def misra_gries(counts: dict, more: dict, size: int) -> dict:
    """Two summaries merged: sums, less the (size + 1)-th largest where more than size keys are left."""
    for key, n in more.items():
        counts[key] = counts.get(key, 0) + n
    if len(counts) > size:
        cut = sorted(counts.values(), reverse=True)[size]
        counts = {key: n - cut for key, n in counts.items() if n > cut}
    return counts


def _summary(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict = {}
    for batch in batches:
        got = batch.column(0).value_counts()
        counts = misra_gries(counts, dict(zip(got.field("values").to_pylist(), got.field("counts").to_pylist())), COUNTERS - 1)
    yield pa.RecordBatch.from_pydict({"digest": pa.array(list(counts), pa.binary()), "n": pa.array(counts.values(), pa.int64())})


def frequent(digests: DataFrame) -> DataFrame:
    """digest, keep_id, group_size of every digest with more than 1/SHARE of the rows, as a table of at most LIST rows."""
    total = digests.count()
    seen = digests.select("digest").mapInArrow(_summary, "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n"))
    # A sum falls short by at most total / COUNTERS, and all sums together are at most total: LIST bounds what is left.
    likely = seen.where(F.col("n") + total / COUNTERS > total / SHARE).where("n > 1").select("digest")
    exact = digests.join(F.broadcast(likely), "digest").groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return stored(exact.where(F.col("group_size") > total / SHARE), "frequent")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of docs, dropped ones too.

    Texts are equal when they are identical after each run of ASCII white space is made one space; null counts as
    empty, so null, empty texts and their copies form one group. The row with the smallest doc_id stays; rows that
    repeat both doc_id and text are all marked kept. An empty table gives an empty result; other columns aren't read.
    """
    hashed = docs.select("doc_id", F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"))
    digests = stored(hashed, "digests")
    winners = frequent(digests)
    hot = digests.join(F.broadcast(winners), "digest")
    rest = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    groups = rest.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    found = hot.unionByName(rest.join(groups, "digest"))
    return found.select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id") == F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


ORACLE = """
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""

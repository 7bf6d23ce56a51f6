"""Minimax contiguous partition of ordered atomic groups into shards, with DataFrame functions only.

Groups (equal texts, which are never parted) stand in the order of a 64-bit key of their text. The smallest feasible
capacity is found by binary search, each try being checked by a greedy walk, and the order is cut there. The walk runs
over cells: runs of neighbouring groups with their total. It starts with equal ranges of the key; a walk that may cut
anywhere in a cell and one that may cut only between cells bound the capacity and every cut from both sides. Only
cells that may hold a cut are split further, until they hold one group each. So the number of cells on the driver
depends on the number of shards and not on the data, and the cuts are those of the exact search over all groups.

A group larger than its fair share would set the capacity alone and leave shards empty. Such groups (fewer than there
are shards) get a shard each, and the search goes on over the others and the shards that are left.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Bits of the key that make the first cells, and bits by which a cell that may hold a cut is split.
FIRST_BITS, MORE_BITS = 14, 5
#: Parts of a shard for numbering its slots.
PARTS = 512
SIGN = 1 << 63

Cell = tuple[int, int, int, int]  # first key, bits of its width, size, groups


def _walk(cells: list[Cell], ends: list[int], capacity: int, shards: int, within: bool) -> tuple[list[int], bool]:
    """Greedy cuts as running sizes, and whether they reach the end. within: cells of several groups may be cut."""
    at, cuts = 0, []
    for _ in range(shards):
        k = bisect_right(ends, at + capacity)
        to = ends[k - 1] if k else 0
        if within and k < len(cells) and cells[k][3] > 1:
            to = at + capacity
        at = max(at, to)
        cuts.append(at)
    return cuts, at >= ends[-1]


def _capacity(cells: list[Cell], ends: list[int], shards: int, within: bool) -> int:
    low, high = -(-ends[-1] // shards), ends[-1]
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if _walk(cells, ends, middle, shards, within)[1] else (middle + 1, high)
    return low


def _totals(groups: DataFrame, bits: int) -> list[Cell]:
    """Cells of a width of so many bits."""
    cell = F.shiftrightunsigned(F.col("key").bitwiseXOR(F.lit(-SIGN)), bits)
    got = groups.groupBy(cell.alias("cell")).agg(F.sum("size"), F.count("*")).collect()
    return [((int(r[0]) % (1 << 64 - bits)) << bits, bits, int(r[1]), int(r[2])) for r in got]


def _split(groups: DataFrame, cells: list[Cell]) -> list[Cell]:
    out = []
    for bits in {c[1] for c in cells}:
        wanted = groups.sparkSession.createDataFrame([(_signed(c[0] >> bits),) for c in cells if c[1] == bits], "cell long")
        inside = groups.withColumn("cell", F.shiftrightunsigned(F.col("key").bitwiseXOR(F.lit(-SIGN)), bits))
        out += _totals(inside.join(F.broadcast(wanted), "cell", "left_semi"), max(0, bits - MORE_BITS))
    return out


def _signed(x: int) -> int:
    return x - 2 * SIGN if x >= SIGN else x


def cut_keys(groups: DataFrame, shards: int) -> list[int]:
    """The first keys of all shards but the first, for groups (key, size) with distinct keys and positive sizes."""
    cells = sorted(_totals(groups, 64 - FIRST_BITS))
    while cells:
        ends = list(accumulate(c[2] for c in cells))
        least, most = (_capacity(cells, ends, shards, within) for within in (True, False))
        low, high = _walk(cells, ends, least, shards, False)[0], _walk(cells, ends, most, shards, True)[0]
        unsure = set()
        for a, b in zip(low, high):
            k = bisect_right(ends, a)
            while k < len(cells) and ends[k] - cells[k][2] < b:
                if cells[k][3] > 1:
                    unsure.add(k)
                k += 1
        if not unsure:
            cuts = [c for c in _walk(cells, ends, most, shards, False)[0] if c < ends[-1]]
            return [cells[bisect_right(ends, c)][0] - SIGN for c in cuts]
        pieces = _split(groups, [cells[k] for k in sorted(unsure)])
        cells = sorted([c for k, c in enumerate(cells) if k not in unsure] + pieces)
    return []


def plan(groups: DataFrame, shards: int) -> tuple[dict[int, int], list[int]]:
    """Shards of the groups that get one each, by key, and the cut keys of the others."""
    alone: dict[int, int] = {}
    while True:
        rest = groups.where(~F.col("key").isin(list(alone))) if alone else groups
        total = rest.agg(F.sum("size")).first()[0]
        if not total:
            return alone, []
        left = shards - len(alone)
        large = rest.where(F.col("size") * left > int(total)).select("key").collect() if left > 1 else []
        if not large:
            return alone, cut_keys(rest, left)
        for r in sorted(large):
            alone[r[0]] = shards - 1 - len(alone)


def _shard(alone: dict[int, int], cuts: list[int]) -> Column:
    out = F.lit(0)
    for cut in cuts:
        out = out + (F.col("key") >= F.lit(cut)).cast("int")
    for key, shard in alone.items():
        out = F.when(F.col("key") == F.lit(key), F.lit(shard)).otherwise(out)
    return out.cast("int")


def sharded(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of docs.

    size is the text's UTF-8 bytes plus 16; null counts as empty. Rows with equal texts share a shard. Sizes of the
    shards are as near to equal as whole groups allow in the order of the keys (law `bytes`); grown_shard is null.
    Slots count from 0 in each shard, without gaps; rows that repeat a doc_id get slots of their own. An empty table
    gives an empty result; other columns aren't read.
    """
    text = F.coalesce("text", F.lit(""))
    rows = stored(
        docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key")),
        "rows",
    )
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("size")), "groups")
    placed = rows.withColumn("shard", _shard(*plan(groups, shards))).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    first = counts.select("shard", "part", F.coalesce(before, F.lit(0)).alias("first"))  # at most shards * PARTS rows
    numbered = placed.withColumn("row", F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")))
    return numbered.join(F.broadcast(first), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("row") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )

"""The registered queries of this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, exact, licenses, minhash, pii, quality, shards, substrings, urls
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
#: The rank file of op2, and the key of op3's pseudonyms (a deployment brings its own).
RANKS, KEY = "byte_bpe_50k.tiktoken", "meltline-example-key"

QUERIES: dict[str, Query] = {
    "op1_minhash": lambda spark, d: minhash.near_duplicates(table(spark, d, "documents"), size=2, percent=80),
    "op2_bpe": lambda spark, d: bpe.tokenised(table(spark, d, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN),
    "op3_pii": lambda spark, d: pii.pseudonymised(table(spark, d, "documents"), KEY),
    "op4_shards": lambda spark, d: shards.sharded(table(spark, d, "documents"), 40),
    "op5_exact_dedup": lambda spark, d: exact.exact_duplicates(table(spark, d, "documents")),
    "op6_licenses": lambda spark, d: licenses.scanned(table(spark, d, "documents")).drop("detections"),
    "op7_substrings": lambda spark, d: substrings.deduplicated(table(spark, d, "documents"), 50).drop("kept_text"),
    "op8_urls": lambda spark, d: urls.filtered(table(spark, d, "pages")),
    "op9_quality": lambda spark, d: quality.scored(table(spark, d, "documents"), table(spark, d, "labels")),
    "op10_decontaminate": lambda spark, d: decontaminate.decontaminated(table(spark, d, "documents"), table(spark, d, "benchmark")),
}

ORACLES: dict[str, str] = {"op5_exact_dedup": exact.ORACLE, "op8_urls": urls.ORACLE}

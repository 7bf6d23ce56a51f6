from pathlib import Path

import brute
import corpus_pipeline
import pytest

from meltline.llm import quality

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="no test tables")


def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    good = {r.doc_id for r in quality.scored(docs, spark.read.parquet(f"{DATA}/labels.parquet")).collect() if r.predicted}
    left = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    kept = {r[0] for r in brute.exact_duplicates(left) if r[3]}
    left = [d for d in left if d[0] in kept]
    kept = {r[0] for r in brute.near_duplicates(left, 5) if r[3]}
    left = [d for d in left if d[0] in kept]
    leaked = {r[0] for r in brute.leaks(left, items) if r[5]}
    want = {i: brute.sha(t) for i, t in left if i not in leaked}
    got = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.run(spark, str(DATA)).collect()}
    assert got == want and len(want) > 50


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(DATA)).columns == docs.columns, name
        assert stage(spark, docs.where("false"), str(DATA)).count() == 0, name
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "bpe"]


def test_stages_judge_rows_and_not_doc_ids(spark):
    rows = [(3, "same text here"), (5, "unique text A"), (5, "same text here"), (5, "same text  here"), (None, "no id, own text"), (None, "same text here"), (8, "a b c d e f g h"), (8, "a b c d e f g h"), (9, None)]
    docs = spark.createDataFrame([(i, t, "x", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, row string, row_ long")
    exact_stage, near_stage = (dict(corpus_pipeline.STAGES)[n] for n in ("exact_dedup", "near_dedup"))
    left = exact_stage(spark, docs, str(DATA))
    assert left.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in left.collect()) == sorted([("None", "same text here"), ("5", "unique text A"), ("None", "no id, own text"), ("8", "a b c d e f g h"), ("9", "None")])
    near = near_stage(spark, docs, str(DATA))
    assert sorted(str(r.text) for r in near.collect()) == sorted(["same text here", "unique text A", "no id, own text", "a b c d e f g h", "None"])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(DATA)).columns == docs.columns, name
    assert dict(corpus_pipeline.STAGES)["bpe"](spark, docs, str(DATA)).count() == len(rows)

import time
import traceback

import pandas as pd
from pyspark.sql import functions as F

from meltline.operators import batches
from meltline.sources import ingest, readers, sinks


def test_retries_and_errors(spark):
    def work(tile):
        if tile["row"] == 1:
            raise KeyError("gone")
        return {"n": tile["row"] * 10}

    rows = batches.attempted(spark.range(3).select(F.col("id").cast("int").alias("row"), F.lit(0).alias("col")), work, "n int", retries=2).collect()
    got = {r.row: r for r in rows}
    assert (got[0].n, got[2].n, got[1].n) == (0, 20, None)
    assert [got[i].attempts for i in range(3)] == [1, 3, 1] and [got[i].success for i in range(3)] == [True, False, True]
    assert got[1].error_messages.count("KeyError: ") == 3 and got[0].error_messages is None


def test_outcomes_leave_in_batches(spark):
    class Tiles:
        schema, sparkSession = spark.range(0).withColumnRenamed("id", "tile").schema, spark

        def repartition(self, *_):
            return self

        def mapInPandas(self, run, schema):
            return run

    run = batches.attempted(Tiles(), lambda t: {"n": 1 / (t["tile"] % 2)}, "n double", keys=("tile",))
    got = list(run(iter([pd.DataFrame({"tile": range(2500)}), pd.DataFrame({"tile": range(10)})])))
    assert [len(f) for f in got] == [1000, 1000, 500, 10]
    assert [list(f["tile"]) for f in got] == [[*range(1000)], [*range(1000, 2000)], [*range(2000, 2500)], [*range(10)]]
    assert all(list(f["success"]) == [t % 2 == 1 for t in f["tile"]] for f in got)


def test_fields_beside_missing_ones(spark):
    big = 2**53 + 1

    def work(tile):
        if tile["row"] % 2:
            raise ValueError
        return {"n": big, "at": tile["at"], "text": "a", "ok": True, "x": tile["x"]}

    rows = spark.range(6).selectExpr("CAST(id AS int) AS row", "0 AS col", "CASE WHEN id > 2 THEN TIMESTAMP_NTZ '2020-01-01' END AS t", "TIMESTAMP_NTZ '2021-01-01' AS at", "CASE WHEN id > 2 THEN id + 0.5D END AS x")
    got = {r.row: r for r in batches.attempted(rows, work, "n long, text string, ok boolean").collect()}
    assert [got[i].n for i in range(6)] == [big, None] * 3 and [got[i].text for i in range(6)] == ["a", None] * 3 and [got[i].ok for i in range(6)] == [True, None] * 3
    assert [got[i].x for i in range(6)] == [None, None, None, 3.5, 4.5, 5.5] and [got[i].t is None for i in range(6)] == [True] * 3 + [False] * 3


def test_errors_are_told_as_python_does():
    def chained():
        try:
            raise KeyError("a")
        except KeyError as e:
            raise ValueError("b") from e

    def noted():
        e = ValueError("two\nlines")
        e.add_note("note")
        raise e

    places = {}
    for work in [lambda: 1 / 0, lambda: [][1] + {}[2], lambda: int("x"), lambda: pd.nothing, lambda: lost, chained, noted] * 2:  # noqa: F821
        try:
            work()
        except Exception as e:  # noqa: BLE001
            assert batches.told(e, places) == traceback.format_exc(limit=-1).strip()
    assert len(places) == 4


def test_batch_that_ends_in_time_leaves_nothing(spark, tmp_path):
    tiles = spark.range(20).withColumnRenamed("id", "tile")
    left = batches.within(tiles, 60, lambda part, k: part.write.parquet(f"{tmp_path}/out/{k}"), f"{tmp_path}/batch", ("tile",), pieces=3)
    assert left.count() == 0


def test_late_and_failed_pieces(spark, tmp_path):
    def done(part, k):
        if k == 1:
            raise RuntimeError("lost")
        if k == 2:
            part.mapInPandas(lambda b: (time.sleep(60), b)[1], part.schema).write.parquet(f"{tmp_path}/out/{k}")
        part.write.parquet(f"{tmp_path}/other/{k}")

    tiles = spark.range(30).withColumnRenamed("id", "tile")
    start = time.time()
    left = batches.within(tiles, 10, done, f"{tmp_path}/batch", ("tile",), by=(F.col("tile") % 3).cast("int"), pieces=3).collect()
    assert time.time() - start < 45
    assert {r.tile for r in left} == {i for i in range(30) if i % 3} and not any(r.success for r in left)
    assert {r.error_messages.split(":")[0] for r in left if r.tile % 3 == 1} == {"RuntimeError"}
    assert {r.error_messages.split(":")[0] for r in left if r.tile % 3 == 2} == {"TimeoutError"}


def test_pages_end_with_an_empty_one(spark):
    pages = {1: [1, 2], 2: [3]}
    assert list(ingest.paged(lambda n: pages.get(n, []))) == [1, 2, 3]
    none = ingest.landed(spark, lambda n: [], lambda r, n: [], lambda u: b"", "2024-01-01")
    assert none.count() == 0 and none.columns == ["run_id", "created_at", "artifact_name", "file_name", "csv_text"]


def test_store_metadata_and_empty_store(spark, tmp_path):
    sinks.create_store(spark, str(tmp_path), "tile_row int, tile_col int, y int, v smallint", {"v": {"scale": 0.5, "fill": -1, "description": "d"}})
    assert sinks.store_schema(spark, str(tmp_path))["v"].metadata == {"scale": 0.5, "fill": -1, "description": "d"}
    assert readers.store(spark, str(tmp_path)).count() == 0
    cells = spark.createDataFrame([(0, 0, 1, 2.5), (0, 1, 1, None)], "tile_row int, tile_col int, y int, v double")
    sinks.write_region(cells, str(tmp_path))
    assert {(r.tile_col, r.v) for r in readers.store(spark, str(tmp_path), decoded=False).collect()} == {(0, 5), (1, -1)}
    assert {(r.tile_col, r.v) for r in readers.store(spark, str(tmp_path)).collect()} == {(0, 2.5), (1, None)}

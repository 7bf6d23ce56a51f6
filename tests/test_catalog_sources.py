import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from meltline.config import Config, version_of
from meltline.functions import grid
from meltline.operators import catalog
from meltline.sources import readers, sinks
from meltline.streaming import catalog as streaming


def test_config_formats():
    text = "[METADATA]\nversion = v9\n[VALUES]\nresolution = 0.5\nbands = vv, vh\nstart_year = 2016\nbbox_left = -10\nbbox_bottom = 0\nbbox_right = 10\nbbox_top = 5\n"
    c = Config.parse(text)
    assert (c.version, c.bands, c.water_years[0], c.bbox, c.time_extent) == ("v9", ("vv", "vh"), 2016, (-10.0, 0.0, 10.0, 5.0), ("2015-10-01", "2025-03-31"))
    old = Config.parse("[VALUES]\nspatial_chunk_dim = 1024\n", "global_config_v2.txt")
    assert (old.version, old.chunk_read, old.chunk_process, old.chunk_write, old.min_consec_snow_days) == ("v2", 1024, 1024, 1024, 56)
    assert version_of("x.txt") == "" and c.as_dict()["resolution"] == 0.5


def test_grid(spark):
    assert grid.shape(Config()) == (96, 245)
    t = grid.tiles(spark, Config(resolution=1.0, chunk_write=4, bbox=(0.0, 0.0, 10.0, 6.0)))
    got = {(r.row, r.col): (r.left, r.bottom, r.right, r.top) for r in t.collect()}
    assert got[0, 0] == (0.0, 2.0, 4.0, 6.0) and got[1, 2] == (8.0, 0.0, 10.0, 2.0) and len(got) == 6
    assert grid.with_tile(spark.createDataFrame([(4095, 2048)], "y int, x int"), Config()).select("tile_row", "tile_col").first() == (1, 1)


def results(spark, rows):
    return spark.createDataFrame(rows, "row int, col int, success boolean, start_time double, sequence long")


def test_keep_last_and_status(spark):
    r = results(spark, [(1, 1, False, 1.0, 1), (1, 1, True, 2.0, 2), (1, 2, True, None, 3), (1, 2, True, 9.0, 4), (2, 1, None, 1.0, 5)])
    assert {(x.row, x.col): x.success for x in catalog.keep_last(r, "sequence").collect()} == {(1, 1): True, (1, 2): True, (2, 1): None}
    assert {(x.row, x.col, x.success): x.sequence for x in catalog.keep_last_started(r).collect()}[1, 2, True] == 3
    tiles = spark.createDataFrame([(1, 1, 5.0), (3, 3, None), (2, 1, 7.0)], "row int, col int, percent_valid_snow_pixels double")
    c = catalog.catalogue(tiles, r)
    assert c.count() == 4
    assert {(x.row, x.col) for x in catalog.select(c, "unprocessed").collect()} == {(3, 3), (2, 1)}
    assert catalog.select(tiles, "unprocessed").count() == 3 and catalog.select(tiles, "processed").count() == 0
    assert [(x.row, x.col) for x in catalog.ranked(tiles).collect()] == [(2, 1), (1, 1), (3, 3)]
    with pytest.raises(ValueError):
        catalog.select(c, "some")
    with pytest.raises(ValueError):
        catalog.select(c, "unprocessed_and_failed_weather_stations")
    info = catalog.batch_info(tiles, 2).first()
    assert (info.total, info.batches, info.indices) == (3, 2, [0, 1])
    assert catalog.batch_info(tiles.where("false"), 2).first().indices == []
    stats = catalog.result_statistics(r).first()
    assert (stats.total, stats.successes, stats.failures, stats.success_rate) == (5, 3, 2, 60.0)


def test_result_log_round_trip(spark, tmp_path):
    path = str(tmp_path / "log")
    schema = readers.RESULTS
    row = [1, 2, 0.5, "{'time': 586}", "nan", *[1.5] * 10, *[float("nan")] * 10, "2024-01-01T00:00:00", 12.5, True, "['a, \"b\"']"]
    sinks.create_log(spark, path, schema)
    sinks.create_log(spark, path, schema)
    for start in ("2024-01-01T00:00:00", "1700000000.25"):
        row[schema.fieldNames().index("start_time")] = start
        sinks.append_results(spark.createDataFrame([row], schema), path)
    got = readers.result_log(spark, path).orderBy("start_time").collect()
    assert [r.start_time for r in got] == [1700000000.25, 1704067200.0]
    assert got[0].runoff_onsets_dims is None and got[0].pix_ct_2015 is None and got[0].error_messages == "['a, \"b\"']" and got[0].success is True
    assert catalog.volume(readers.result_log(spark, path)).first().scenes == 1172


def test_geojson_round_trip(spark, tmp_path):
    tiles = spark.createDataFrame([(1, 2, 3.5, 0.0, 1.0, 2.0, 3.0), (1, 3, 9.0, 2.0, 1.0, 4.0, 3.0)], "row int, col int, percent_valid_snow_pixels double, left double, bottom double, right double, top double")
    sinks.write_geojson(tiles, str(tmp_path / "t"))
    got = readers.catalogue_geojson(spark, str(tmp_path / "t"))
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in tiles.orderBy(F.desc("col")).collect()]


def test_tiles_are_overwritten_one_by_one(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [(0, t, y, 2018, float(y)) for t in range(3) for y in range(4)]
    d = spark.createDataFrame(rows, "tile_row int, tile_col int, y int, water_year int, v double")
    sinks.write_tiles(sinks.encoded(d, {"v": 0.1}), path)
    again = d.where("tile_col = 1 AND y < 2").withColumn("v", F.lit(9.0))
    for _ in range(2):
        sinks.write_tiles(sinks.encoded(again, {"v": 0.1}), path)
    got = readers.product(spark, path, {"v": 0.1})
    assert {r.tile_col: (r.n, r.m) for r in got.groupBy("tile_col").agg(F.count("*").alias("n"), F.max("v").alias("m")).collect()} == {0: (4, 3.0), 1: (2, 9.0), 2: (4, 3.0)}
    assert readers.product(spark, path).schema["v"].dataType.simpleString() == "smallint"
    assert readers.listing(spark, path).count() == 3


def test_artifacts(spark):
    head = ",".join(readers.RESULTS.fieldNames())
    line = ",".join(["7", "8", "0.1", "", "", *["1.0"] * 20, "1700000000", "3.0", "true", ""])
    landing = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 9), "tile-result-1", f"{head}\r\n{line}\r\n"), (2, dt.datetime(2023, 1, 1), "tile-result-2", f"{head}\n{line}"), (3, dt.datetime(2024, 1, 9), "log", line)],
        "run_id long, created_at timestamp, artifact_name string, csv_text string",
    )
    got = readers.artifacts(landing, "2024-01-01").collect()
    assert [(r.run_id, r.row, r.col, r.success, r.tr_2015) for r in got] == [(1, 7, 8, True, 1.0)]


def test_job_matrix(spark):
    t = spark.createDataFrame([(2, 1), (1, 9)], "row int, col int")
    assert json.loads(sinks.job_matrix(t).first().value) == [{"row": 1, "col": 9}, {"row": 2, "col": 1}]
    assert sinks.job_matrix(t, "count").first().value == "2" and {r.value for r in sinks.job_matrix(t, "list").collect()} == {"2,1", "1,9"}
    with pytest.raises(ValueError):
        sinks.job_matrix(t, "xml")


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i % 3, i % 2, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i // 4), float(i)) for i in range(40)]
    d = spark.createDataFrame(rows, "row int, col int, start_time timestamp, v double")
    d.unionByName(d.limit(5)).repartition(2).write.parquet(str(tmp_path / "in"))
    got = streaming.drained(spark, str(tmp_path / "in"), d.schema, streaming.latest_results, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert got.count() == d.select("row", "col", "start_time").distinct().count()
    again = streaming.drained(spark, str(tmp_path / "in"), d.schema, streaming.latest_results, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert again.count() == got.count()


def test_until_done(spark):
    left = [5]
    rounds = streaming.until_done(lambda: spark.range(left[0]), lambda b: left.__setitem__(0, max(0, left[0] - 2)))
    assert rounds == 3 and left == [0]
    assert streaming.until_done(lambda: spark.range(4), lambda b: None) == 1


def test_consolidated_log_is_one_file_sorted_in_parts(spark, tmp_path, monkeypatch):
    """The log is one file in order, with one header, and no task sorts all of it."""
    frame, sorts = type(spark.range(0)), []
    within = frame.sortWithinPartitions
    monkeypatch.setattr(frame, "sortWithinPartitions", lambda df, *c, **k: (sorts.append(df), within(df, *c, **k))[1])
    path, k = f"{tmp_path}/log", F.col("id")
    made = spark.range(0, 20000, 1, 3).select(
        k.cast("int").alias("row"), F.lit(1).alias("col"), F.concat(F.lit('a, "b" '), k.cast("string")).alias("error_messages"), F.when(k % 5 != 0, F.format_string("%05d", k * 7919 % 1000)).alias("start_time")
    )
    rows = made.select(*[F.col(f.name) if f.name in made.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in readers.RESULTS])
    expected = [r.row for r in sorted(made.collect(), key=lambda r: (r.start_time or "", r.row))]
    with_adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    sinks.write_log(made.select("row"), path, ("row",))
    for _ in range(2):
        sinks.write_log(rows, path)
        assert len([*(tmp_path / "log").glob("*.csv")]) == 1
        got = readers.result_log(spark, path).orderBy("sequence").collect()
        assert [r.row for r in got] == expected and got[-1].error_messages == f'a, "b" {expected[-1]}'
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        counts = [r["count"] for r in sorts[-1].groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", with_adaptive)
    assert max(counts) < 10000
    sinks.write_log(rows.limit(0), path)
    assert readers.result_log(spark, path).count() == 0
    (lines,) = [f.read_text().splitlines() for f in (tmp_path / "log").glob("*.csv")]
    assert lines == [",".join(readers.RESULTS.fieldNames())]

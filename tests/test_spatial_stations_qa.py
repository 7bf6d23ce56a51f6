import datetime as dt

import pytest
from pyspark.sql import functions as F

from meltline.sources import readers
from meltline.operators import mart, qa, spatial, stations


def test_points_on_edges_are_not_inside_boxes(spark):
    boxes = spark.createDataFrame([(1, 0.0, 0.0, 2.0, 2.0), (2, 2.0, 0.0, 4.0, 2.0)], "id int, left double, bottom double, right double, top double")
    points = spark.createDataFrame([(2.0, 1.0), (1.0, 1.0), (1.5, 0.5)], "lon double, lat double")
    assert [r.id for r in spatial.boxes_with_points(boxes, points).collect()] == [1]
    assert [r.id for r in spatial.boxes_without_boxes(boxes, boxes.where("id = 1")).collect()] == []


def test_concave_polygon(spark):
    ring = [(0, 0), (4, 0), (4, 4), (3, 4), (3, 1), (1, 1), (1, 4), (0, 4)]
    points = spark.createDataFrame([(1, 0.5, 3.0), (2, 2.0, 3.0), (3, 3.5, 3.0), (4, 2.0, 0.5), (5, 9.0, 9.0)], "id int, lon double, lat double")
    assert {r.id: r.polygon_id for r in spatial.in_polygons(points, [(7, ring)]).collect()} == {1: 7, 3: 7, 4: 7}


def test_identity_resampling_and_missing_corners(spark):
    source = spark.createDataFrame([(y, x, float(10 * y + x)) for y in range(3) for x in range(3)], "y int, x int, value double")
    same = source.select(F.col("y").alias("ty"), F.col("x").alias("tx"), F.col("y").cast("double").alias("sy"), F.col("x").cast("double").alias("sx"))
    got = {(r.ty, r.tx): r.value for r in spatial.resampled_bilinear(same, source).collect()}
    assert got == {(r.y, r.x): r.value for r in source.collect()}
    half = spark.createDataFrame([(0, 0, 0.5, 0.5), (1, 1, 2.5, 2.5), (2, 2, 9.0, 9.0)], "ty int, tx int, sy double, sx double")
    assert {r.ty: r.value for r in spatial.resampled_bilinear(half, source).collect()} == {0: 5.5, 1: 22.0, 2: None}


def test_terrain_of_a_plane(spark):
    dem = spark.createDataFrame([(y, x, 10.0 * x) for y in range(4) for x in range(4)], "y int, x int, dem double")
    got = {(r.y, r.x): (r.slope, r.aspect) for r in spatial.terrain(dem, 10.0).collect()}
    assert got[1, 1][0] == pytest.approx(45) and got[1, 1][1] == pytest.approx(270) and got[0, 0] == (None, None)


def test_terrain_beside_missing_cells(spark):
    """Cells without a value, or left out, take slope and aspect from themselves and all around; flat ground has no aspect."""
    rows = [(y, x, None if (y, x) == (2, 2) else 1.0 * (x > 7)) for y in range(5) for x in range(12) if (y, x) != (2, 6)]
    got = {(r.y, r.x): (r.slope, r.aspect) for r in spatial.terrain(spark.createDataFrame(rows, "y int, x int, dem double"), 1.0).collect()}
    there = {k for k, v in got.items() if v[0] is not None}
    assert there == {(y, x) for y in (1, 2, 3) for x in (4, 8, 9, 10)}
    assert got[1, 4] == (0.0, None) and got[2, 8][1] == pytest.approx(270)


def test_radius_edge(spark):
    c = spark.createDataFrame([("a", 0.0, 0.0)], "station string, cx double, cy double")
    p = spark.createDataFrame([(1, 100.0, 0.0), (2, 101.0, 0.0), (3, -60.0, 80.0)], "id int, px double, py double")
    assert {r.id for r in spatial.within_radius(c, p, 100.0).collect()} == {1, 3}


def test_pairs_of_a_crowded_place(spark, monkeypatch):
    """All pairs, whatever lies in one place, made by more than one task, though few rows are joined."""
    monkeypatch.setattr(spatial, "TOGETHER", 3)
    centres = [(i, x, y) for i, (x, y) in enumerate([(0.0, 0.0)] * 7 + [(-30.0, 40.0), (1e6 + 0.1, -0.3), (None, 0.0)])]
    points = [(i, x, y) for i, (x, y) in enumerate([(0.0, 0.0)] * 20 + [(-50.0, 0.0), (50.0, 0.0), (30.0, 40.0), (30.1, 40.0), (0.0, -49.9), (1e6 + 50.1, -0.3), (1e6 - 49.9, -0.3), (None, 1.0)])]
    c = spark.createDataFrame(centres, "station int, cx double, cy double").coalesce(1)
    p = spark.createDataFrame(points, "id int, px double, py double").coalesce(1)
    d2 = lambda a, b: (b[1] - a[1]) * (b[1] - a[1]) + (b[2] - a[2]) * (b[2] - a[2])
    expected = sorted((a[0], b[0], *a[1:], *b[1:], round(d2(a, b) ** 0.5, 2)) for a in centres for b in points if a[1] is not None and b[1] is not None and d2(a, b) <= 2500)
    got = spatial.within_radius(c, p, 50.0, digits=2)
    assert sorted((r.station, r.id, r.cx, r.cy, r.px, r.py, r.dist_m) for r in got.collect()) == expected and len(expected) > 160
    assert spatial.within_radius(c, p, 50.0).select(F.spark_partition_id()).distinct().count() > 1


def series(spark, values, start=dt.date(2017, 10, 1), station="a"):
    rows = [(station, start + dt.timedelta(days=i), v, 2018, i + 1) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "station string, date date, swe double, wy int, dowy int")


def test_jump_mask_looks_around_the_day(spark):
    got = [r.swe for r in stations.jump_mask(series(spark, [0.0, 0.1, 0.1, 0.5, 0.5, 0.5, 0.5])).orderBy("date").collect()]
    assert got == [None, None, 0.5, None, 0.5, None]


def test_rolling_mask_blanks_edges(spark):
    got = [r.swe for r in stations.rolling_mask(series(spark, [1.0] * 30)).orderBy("date").collect()]
    assert [i for i, v in enumerate(got) if v is not None] == list(range(10, 21))


@pytest.mark.parametrize("days, kept", [(54, False), (55, True)])
def test_seasonal_needs_enough_days(spark, days, kept):
    d = series(spark, [0.0] * 40 + [0.05] * days + [0.0] * 40)
    assert (stations.seasonal_mask(d).where("swe IS NOT NULL").count() > 0) == kept


@pytest.mark.parametrize("gap, kept", [(9, True), (10, False)])
def test_gap_rule(spark, gap, kept):
    d = series(spark, [0.1] + [0.5] * 20 + [None] * gap + [0.5] * 20 + [0.1], dt.date(2018, 4, 1))
    assert (stations.complete_mask(d).where("swe IS NOT NULL").count() > 0) == kept
    assert stations.complete_mask(series(spark, [0.11, 0.0])).where("swe IS NOT NULL").count() == 0


def test_timing_takes_the_latest_day(spark):
    got = stations.timing(series(spark, [0.0, 0.5, 1.0, 0.9, 1.0, 0.95, 0.4])).first()
    assert (got.max_swe, got.dowy_max, got.dowy_99, got.dowy_95, got.dowy_90, got.dowy_50) == (1.0, 5, 5, 6, 6, 6)


def test_buffer_statistics(spark):
    rows = [("a", 2018, 50.0, 10, 5.0, 80), ("a", 2018, 50.0, 20, 5.0, None), ("a", 2018, 100.0, 40, 10.0, 30), ("a", 2018, 101.0, 99, 1.0, 30), ("a", 2018, 10.0, -9999, None, 30)]
    d = spark.createDataFrame(rows, "station string, water_year int, dist_m double, runoff_onset int, fcf double, worldcover int")
    got = {(r.buffer_radius, r.fcf_limit): (r.onset, round(r.frac_valid, 4), round(r.mean_fcf, 4)) for r in stations.buffer_statistics(d, [100], [6, 10]).collect()}
    assert got == {(100.0, 6.0): (20.0, 0.3333, 5.0), (100.0, 10.0): (30.0, 0.6667, 6.6667)}


def test_versions(spark):
    rows = [(1, p, y, float(v)) for p, y, v in ((1, 1, 10), (1, 2, 20), (2, 1, 367), (2, 2, 0))]
    a = spark.createDataFrame(rows, "tile int, pixel int, water_year int, runoff_onset double")
    b = a.withColumn("runoff_onset", F.when(F.col("pixel") == 1, F.col("runoff_onset") + 0.5))
    assert qa.differences(qa.paired(a, b, "runoff_onset")).first().max_diff == 0.5
    assert {r.match for r in qa.comparison(a, a, "runoff_onset").collect()} == {True}
    assert qa.comparison(a, b, "runoff_onset").where("NOT match").count() > 5
    assert tuple(qa.out_of_range(a, "runoff_onset", 1, 366).first()) == (2, 0.0)
    assert qa.precision(a, "runoff_onset").first().precision == 10.0 and qa.precision(a, "runoff_onset", ("pixel",)).count() == 2
    stored = spark.createDataFrame([(1, 1, 15.0, 5.0), (1, 2, 367.0, 1.0)], "tile int, pixel int, runoff_onset_median double, runoff_onset_mad double")
    assert tuple(qa.rederived(a, stored).first()) == (0.0, 0, 1.0, 1)
    assert qa.validated(a, b, ["runoff_onset"]).first().n == 2 and "variable" in qa.report(qa.validated(a, b, ["runoff_onset"])).first().value


def test_empty_bins_are_there(spark):
    cells = spark.createDataFrame([(10.0, 100.0, 5.0, 0.5), (10.0, 101.0, 7.0, 0.9), (-80.0, 50.0, 1.0, 0.1), (10.0, 0.0, 1.0, 0.1)], "original_lat double, dem double, runoff_onset_median double, chili double")
    bins = mart.binned(cells, (-80, 80, 40), (0, 300, 100))
    assert {(r.lat_bin, r.dem_bin) for r in bins.collect()} == {(0, 0), (0, 100)}
    dense = mart.dense(mart.bin_statistics(bins, ("runoff_onset_median",)), (-80, 80, 40), (0, 300, 100))
    assert dense.count() == 4 * 3 * 3 and dense.where("value IS NULL").count() == (12 - 2) * 3
    one = mart.bin_correlations(bins, "runoff_onset_median", ["chili"]).collect()
    assert {r.corr_chili for r in one} == {None}


def test_parts_and_holes(spark):
    box = lambda a, b: [(a, a), (b, a), (b, b), (a, b)]
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 5.0, 5.0), (4, 11.0, 11.0), (5, 21.0, 21.0), (6, None, 1.0)], "id int, lon double, lat double")
    got = spatial.in_polygons(points, [(2, box(0, 10)), (2, box(4, 6)), (2, box(20, 22)), (9, box(-50, 50))])
    assert {r.id: r.polygon_id for r in got.collect()} == {1: 2, 2: 9, 3: 9, 4: 9, 5: 2}


def test_layers_refuse_other_geometries(spark, tmp_path):
    import pytest

    (tmp_path / "a.json").write_text('{"features": [{"properties": {"k": 1}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]}')
    with pytest.raises(Exception, match="no polygon: Point"):
        readers.polygon_layer(spark, str(tmp_path), "k")


def test_utm_places(spark):
    from meltline.functions import crs

    # The equator on a central meridian, and a point whose place is known to a decimetre.
    d = spark.createDataFrame([(9.0, 0.0), (11.0, 47.5)], "lon double, lat double")
    e, n = crs.projected(F.col("lon"), F.col("lat"), 32)
    got = [tuple(r) for r in d.select(F.round(e, 3), F.round(n, 3)).collect()]
    assert got[0] == (500000.0, 0.0)
    # By the meridian: one degree of latitude is about 111 km there, the scale 0.9996 at the centre.
    assert abs(got[1][0] - 650_600) < 200 and abs(got[1][1] - 5_262_700) < 300


def test_reprojected_plane(spark):
    from meltline.functions import crs

    grid = spark.createDataFrame([(y, x, float(x)) for y in range(20) for x in range(20)], "y int, x int, value double")
    at = spark.createDataFrame([(0, i, 9.0 + 0.01 * (i + 3.25)) for i in range(5)], "ty int, tx int, lon double").withColumn("lat", F.lit(46.9))
    e, n = crs.projected(F.col("lon"), F.col("lat"), 32)
    got = spatial.reprojected(at.select("ty", "tx", e.alias("easting"), n.alias("northing")), grid, 32, 47.0, 9.0, 0.01)
    assert all(abs(r.value - (r.tx + 2.75)) < 1e-6 for r in got.collect())

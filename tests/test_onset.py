import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from meltline.operators import masks, onset, quality, stats

NTZ = "pixel int, water_year int, orbit int, time timestamp_ntz, dowy int, vv double, vh double, latitude double"


def day(n, year=2018):
    return dt.datetime(year - 1, 10, 1) + dt.timedelta(days=n - 1)


def obs(spark, values, start=30, end=50, length=None):
    """One series: (day of year, vv) pairs."""
    rows = [(1, 2018, 1, day(d), d, v, None, 1.0, float(start), float(end), float(end - start if length is None else length), True) for d, v in values]
    return spark.createDataFrame(rows, NTZ + ", search_window_start_DOWY double, search_window_end_DOWY double, search_window_length double, binary_seasonal_snow_cover_presence boolean")


@pytest.mark.parametrize(
    "valid, gap, accepted",
    [("NNVVNN", 12.0, True), ("xVVx", None, False), ("N.....N", 50.0, False)],
)
def test_gap_examples(spark, valid, gap, accepted):
    days = {"NNVVNN": [10, 22, 34, 46, 58, 70], "xVVx": [34, 46], "N.....N": [10, 60]}[valid]
    kinds = {"NNVVNN": "NNVVNN", "xVVx": "VV", "N.....N": "NN"}[valid]
    d = obs(spark, [(n, 1.0 if k == "V" else None) for n, k in zip(days, kinds)])
    assert quality.max_gap(d).first().max_gap == gap
    if "V" in kinds:
        kept = quality.filter_orbits(d, 0.1, 30).where("vv IS NOT NULL").count()
        assert (kept > 0) == accepted


def test_gap_with_negative_edges_is_accepted(spark):
    d = obs(spark, [(10, None), (34, 1.0), (60, None)])
    assert quality.max_gap(d).first().max_gap == -10.0
    assert quality.filter_orbits(d, 0.1, 30).where("vv IS NOT NULL").count() == 1


def test_documented_gap(spark):
    d = obs(spark, [(35, 1.0), (40, None), (45, 1.0)], 30, 50)
    assert quality.max_gap(d, mode="documented").first().max_gap == 10.0
    assert quality.max_gap(obs(spark, [(35, None)]), mode="documented").first().max_gap == 20.0
    with pytest.raises(ValueError):
        quality.max_gap(d, mode="other")


def test_gap_against_a_loop(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for pixel in range(60):
        start, end = rng.randint(1, 50), rng.randint(60, 120)
        days = sorted(rng.sample(range(1, 150), rng.randint(1, 8)))
        values = [(n, rng.choice([None, None, 0.5])) for n in days]
        g = [start, *[n if v is None else None for n, v in values], end]
        steps = [b - a for a, b in itertools.pairwise(g) if a is not None and b is not None]
        want[pixel] = float(max(steps)) if steps else None
        rows += [(pixel, 2018, 1, day(n), n, v, None, 1.0, float(start), float(end), float(end - start), True) for n, v in values]
    d = spark.createDataFrame(rows, obs(spark, [(1, None)]).schema)
    assert {r.pixel: r.max_gap for r in quality.max_gap(d).collect()} == want


def test_snow_window(spark):
    d = spark.createDataFrame([(1, 2018, 10.0, 340.0, 56.0), (2, 2018, 10.0, 360.0, 55.0), (3, 2018, 10.0, None, 60.0), (4, 2018, 10.0, 100.0, None)], "pixel int, water_year int, SAD_DOWY double, SDD_DOWY double, max_consec_snow_days double")
    got = {r.pixel: tuple(r)[2:] for r in masks.snow_window(d).collect()}
    assert got == {1: (38.0, 356.0, 318.0, True), 2: (37.5, 366.0, 328.5, False), 3: (40.0, 366.0, 326.0, True), 4: (None, 116.0, None, False)}


def test_noise_threshold_depends_on_the_date(spark):
    rows = [(1, 2018, 1, dt.datetime(2018, 3, 13), 1, 0.0005, 0.0, 0.0), (1, 2018, 1, dt.datetime(2018, 3, 14), 1, 0.0005, 0.0, 0.0)]
    got = masks.noise_mask(spark.createDataFrame(rows, NTZ)).orderBy("time").collect()
    assert [(r.vv, r.vh) for r in got] == [(None, None), (0.0005, None)]


def test_masks_keep_rows(spark):
    rows = [(p, y, 1, day(40), 40, 1.0, 2.0, lat) for p, y, lat in ((1, 2018, 0.0), (2, 2018, -0.1), (1, 2019, 0.0))]
    d = spark.createDataFrame(rows, NTZ)
    window = spark.createDataFrame([(1, 2018, 40.0, 40.0, 0.0, True), (2, 2018, 41.0, 60.0, 19.0, True)], "pixel int, water_year int, search_window_start_DOWY double, search_window_end_DOWY double, search_window_length double, binary_seasonal_snow_cover_presence boolean")
    assert [r.vv for r in masks.seasonal_mask(d, window).orderBy("water_year", "pixel").collect()] == [1.0, None, None]
    assert [r.vv for r in masks.equator_mask(d, 0.5).orderBy("pixel", "water_year").collect()] == [1.0, 1.0, None]
    assert [r.vv for r in masks.equator_mask(d, -0.5).orderBy("pixel", "water_year").collect()] == [None, None, 1.0]
    assert masks.equator_mask(d, 40.0) is d
    assert masks.all_masks(d, window, [2018], 40.0, d.where("pixel = 1")).count() == 2


def test_ties_take_the_earliest_and_even_counts_the_floor(spark):
    rows = [(1, 2018, 1, day(20), 20, 0.5, None, 1.0), (1, 2018, 1, day(10), 10, 0.5, None, 1.0), (1, 2018, 2, day(13), 13, 0.1, None, 1.0), (2, 2018, 1, day(5), 5, None, None, 1.0)]
    d = spark.createDataFrame(rows, NTZ)
    assert {(r.pixel, r.orbit, r.polarization): r.onset_time for r in onset.orbit_minima(d).collect()}[1, 1, "vv"] == day(10)
    got = {r.pixel: r.runoff_onset for r in onset.melt_onset(d).collect()}
    assert got == {1: 11, 2: -9999}
    assert {r.pixel: r.runoff_onset for r in onset.melt_onset(d, returned="doy").collect()} == {1: 284, 2: None}
    with pytest.raises(ValueError):
        onset.melt_onset(d, returned="week")


def test_order_of_rows_does_not_matter(spark):
    rng = random.Random(1)
    rows = [(p, 2018, o, day(n), n, rng.randint(1, 4) / 4, None, 1.0) for p in range(5) for o in range(3) for n in rng.sample(range(1, 300), 9)]
    a = onset.melt_onset(spark.createDataFrame(rows, NTZ)).orderBy("pixel").collect()
    rng.shuffle(rows)
    assert a == onset.melt_onset(spark.createDataFrame(rows, NTZ)).orderBy("pixel").collect()


def test_median_and_mad_need_enough_years(spark):
    d = spark.createDataFrame([(1, v) for v in (10, 20, -9999)] + [(2, v) for v in (10, 20, 40)] + [(3, v) for v in (1, 2, 3, 4)] + [(4, -9999)], "pixel int, v int")
    got = {r.pixel: (r.median, r["mad"]) for r in stats.median_and_mad(d, "v", 3).collect()}
    assert got == {1: (None, None), 2: (20.0, 10.0), 3: (2.5, 1.0), 4: (None, None)}


def test_temporal_resolution(spark):
    got = quality.temporal_resolution(obs(spark, [(35, 1.0), (40, 1.0), (45, None)])).first()
    assert got.temporal_resolution == 10.0
    assert quality.temporal_resolution(obs(spark, [(35, None)])).first().temporal_resolution is None


def test_weighted_resolution(spark):
    d = spark.createDataFrame([(1, 2015, 2.0, 10), (2, 2015, 4.0, 30), (1, 2016, None, 5), (2, 2016, 6.0, 0)], "tile int, water_year int, tr double, pix_ct long")
    got = {r.water_year: r.temporal_resolution for r in stats.weighted_resolution(d).collect()}
    assert got == {2015: 3.5, 2016: None, None: 3.5}


def test_pipeline_on_a_cube_against_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    rows, want = [], {}
    for p in range(16):
        per_orbit = []
        for o in range(3):
            days, v = np.sort(rng.choice(np.arange(1, 300), 12, False)), np.round(rng.random(12) + 0.01, 2)
            inside = (days >= 60) & (days <= 250)
            rows += [(p, 2018, o, day(int(n)), int(n), float(x), None, 1.0) for n, x in zip(days, v)]
            if inside.any():
                per_orbit.append(int(days[inside][np.argmin(v[inside])]))
        want[p] = int(np.floor(np.median(per_orbit)))
    d = spark.createDataFrame(rows, NTZ)
    window = spark.createDataFrame([(p, 2018, 60.0, 250.0, 190.0, True) for p in range(16)], "pixel int, water_year int, search_window_start_DOWY double, search_window_end_DOWY double, search_window_length double, binary_seasonal_snow_cover_presence boolean")
    got = onset.melt_onset(masks.noise_mask(masks.seasonal_mask(d, window), threshold=-1.0))
    assert {r.pixel: r.runoff_onset for r in got.select("pixel", F.col("runoff_onset").cast("int").alias("runoff_onset")).collect()} == want

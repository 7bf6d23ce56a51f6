import numpy as np
import pytest

from meltline.sources import rasters

GRID = np.arange(45 * 37).reshape(45, 37)


def read(data, **how):
    out = np.full(GRID.shape, -1.0)
    for y, x, _, _, v in rasters.cells(data, **how):
        out[y, x] = v
    return out


@pytest.mark.parametrize("kind", ["u1", "i2", "u2", "i4", "f4", "f8"])
@pytest.mark.parametrize("block", [None, 16])
@pytest.mark.parametrize("predictor", [1, 2, 3])
def test_round_trip(kind, block, predictor):
    if predictor == (2 if kind[0] == "f" else 3):
        return
    grid = (GRID % 251).astype(kind) / (1 if kind[0] != "f" else 8)
    assert (read(rasters.encoded(grid.astype(kind), 10.0, 50.0, 0.5, block=block, predictor=predictor, deflate=predictor > 1)) == grid).all()


def test_nodata_and_places():
    data = rasters.encoded((GRID % 5).astype("i2"), 10.0, 50.0, 0.5, nodata=3)
    got = read(data, nodata=4)
    assert np.isnan(got[GRID % 5 >= 3]).all() and (got[GRID % 5 < 3] == (GRID % 5)[GRID % 5 < 3]).all()
    y, x, lon, lat, _ = next(rasters.cells(data))
    assert (y[38], x[38], lon[38], lat[38]) == (1, 1, 10.75, 49.25)


@pytest.mark.parametrize("data", [b"", b"PK\3\4 no raster", b"II\0\0\0\0\0\0"])
def test_other_files_are_an_error(data):
    with pytest.raises(ValueError):
        list(rasters.cells(data))


def test_scan_of_a_folder(spark, tmp_path):
    """Two files side by side in a folder of years; one year is read, cells of a box only."""
    for year in (2020, 2021):
        (tmp_path / f"year={year}").mkdir()
        for side in (0, 1):
            (tmp_path / f"year={year}" / f"{side}.tif").write_bytes(rasters.encoded((GRID + side + year).astype("f4"), 10.0 + side * 18.5, 50.0, 0.5, nodata=2021, block=16))
    rows = rasters.geotiff(spark, str(tmp_path), where="year = 2021", within=(28.0, 49.0, 29.0, 50.0), scale=2.0).collect()
    want = {(0, y, x): GRID[y, x] + 2021 for y in (0, 1) for x in (36,)} | {(1, y, x): GRID[y, x] + 2022 for y in (0, 1) for x in (0,)}
    got = {(int(r.path.split("/")[-1][0]), r.y, r.x): r.value for r in rows}
    assert got == {k: 2.0 * v for k, v in want.items()}
    assert rasters.geotiff(spark, str(tmp_path)).where("value IS NULL").count() == 3  # nodata: 2021 is in all files but the last


def test_one_grid_of_all_files(spark, tmp_path):
    for side in (0, 1):
        (tmp_path / f"{side}.tif").write_bytes(rasters.encoded(GRID.astype("f8"), side * 37.0, 45.0, 1.0))
    scanned = rasters.geotiff(spark, str(tmp_path))
    grid = {(r.y, r.x): r.value for r in rasters.on_grid(scanned, 45.0, 0.0, 1.0).collect()}
    assert len(grid) == 2 * GRID.size and grid[3, 37 + 5] == GRID[3, 5]
    template = spark.createDataFrame([(0, 0, 1.0, 44.0), (0, 1, 100.0, 44.0)], "ty int, tx int, lon double, lat double")
    got = {r.tx: r.value for r in rasters.elevation(scanned, template, 45.0, 0.0, 1.0).collect()}
    assert got == {0: (GRID[0, 0] + GRID[0, 1] + GRID[1, 0] + GRID[1, 1]) / 4, 1: None}
    modes = rasters.land_cover(scanned, 45.0, 0.0, 1.0, 3).collect()
    assert len(modes) == 15 * 25 and {(r.y, r.x): r.value for r in modes}[0, 0] == 0.0

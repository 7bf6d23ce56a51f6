import json

from meltline.operators import spatial
from meltline.sources import readers


def test_scene_items_and_search(spark, tmp_path):
    item = lambda i, t, box, orbit: {"id": i, "collection": "c", "bbox": box, "properties": {"datetime": t, "sat:absolute_orbit": orbit, "sat:relative_orbit": 7, "sat:orbit_state": "ascending"}}
    features = [item("a", "2018-01-01T10:00:00Z", [0, 0, 1, 1], 5), item("b", "2018-01-01T09:59:00.5+00:00", [0, 0, 1, 1], 5), item("c", "2018-02-01T00:00:00Z", [5, 5, 6, 6], 6), item("d", "2019-01-01T00:00:00Z", [0, 0, 1, 1], 7)]
    (tmp_path / "items.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    items = readers.scene_items(spark, str(tmp_path))
    found = readers.search_scenes(items, (1, 1, 2, 2), "2018-01-01", "2018-12-31", "c")
    assert {r.id for r in found.collect()} == {"a", "b"}
    assert [r.id for r in readers.first_scenes(found).collect()] == ["b"]


def test_polygon_layer(spark, tmp_path):
    ring = lambda x: [[x, 0.0], [x + 1, 0.0], [x + 1, 1.0], [x, 1.0], [x, 0.0]]
    layer = {"features": [{"properties": {"ID": i, "name": "n"}, "geometry": {"type": "Polygon", "coordinates": [ring(float(i))]}} for i in (3, 1, 8)]}
    (tmp_path / "layer.json").write_text(json.dumps(layer))
    polygons = readers.polygon_layer(spark, str(tmp_path / "layer.json"), "ID", (0.0, 0.0, 3.5, 1.0))
    assert [i for i, _ in polygons] == [1, 3]
    points = spark.createDataFrame([(1, 1.5, 0.5), (2, 3.5, 0.5), (3, 8.5, 0.5)], "id int, lon double, lat double")
    assert {r.id: r.polygon_id for r in spatial.in_polygons(points, polygons).collect()} == {1: 1, 2: 3}


def test_mosaic_takes_the_first_valid_value(spark):
    import datetime as dt

    rows = [(5, 0, 0, dt.datetime(2018, 1, 1, 1), -32768.0, 2.0), (5, 0, 0, dt.datetime(2018, 1, 1), float("nan"), 1.0), (5, 0, 0, dt.datetime(2018, 1, 1, 2), 3.0, None)]
    d = spark.createDataFrame(rows, "abs_orbit int, y int, x int, time timestamp_ntz, vv double, vh double")
    assert tuple(readers.mosaic(d).first())[3:] == (dt.datetime(2018, 1, 1), 3.0, 1.0)

"""Queries that write with the package's sinks into the shared folder and read back with its sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import crs, dates
from ..operators import batches, qa, spatial, stats
from ..sources import ingest, rasters, readers, sinks
from ..sources.shared import scratch
from ..streaming import catalog as streaming
from . import domain as d
from .gridded import GRID
from .registry import query, rounded

RESULTS = """r AS (SELECT CAST(o_custkey % 50 AS INT) AS "row", CAST(o_custkey % 40 AS INT) AS col, o_totalprice AS total_time, o_orderkey, o_orderdate,
  CASE o_orderstatus WHEN 'O' THEN true WHEN 'F' THEN false END AS success, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS tr_2015 FROM orders)"""


def _results(spark, sf_dir):
    """Result rows as they are logged: nan texts and numbers, starts in both spellings."""
    o, k = d.table(spark, sf_dir, "orders"), F.col("o_orderkey")
    own = {
        "row": (F.col("o_custkey") % 50).cast("int"), "col": (F.col("o_custkey") % 40).cast("int"), "percent_valid_snow_pixels": F.lit(None).cast("double"),
        "s1_rtc_ds_dims": F.concat(F.lit("{'time': "), k.cast("string"), F.lit("}")), "runoff_onsets_dims": F.lit("nan"), "tr_2015": F.when(k % 5 != 0, F.col("o_totalprice")).otherwise(float("nan")),
        "start_time": F.when(k % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).otherwise(F.unix_timestamp("o_orderdate").cast("string")),
        "total_time": F.col("o_totalprice"), "success": F.when(F.col("o_orderstatus") == "O", True).when(F.col("o_orderstatus") == "F", False), "error_messages": F.lit("['a, \"b\"']"),
    }
    return o.select(*[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in readers.RESULTS])


@query("s06_k05_result_log", "WITH " + RESULTS + """ SELECT "row", col, o_orderkey AS scenes, round(tr_2015, 6) AS tr_2015, round(total_time, 6) AS total_time, success, CAST(epoch(o_orderdate) AS DOUBLE) AS start_time, NULL::VARCHAR AS runoff_onsets_dims, '[''a, "b"'']' AS error_messages FROM r""")
def result_log(spark, sf_dir):
    """S-06, S-07, S-15, K-05, K-06: an empty log is made, rows are added, and the log is read."""
    from ..functions.scalars import dims

    path = scratch(spark, "log")
    sinks.create_log(spark, path, readers.RESULTS)
    sinks.append_results(_results(spark, sf_dir), path)
    got = readers.result_log(spark, path, recursive=True)
    return rounded(got.select("row", "col", dims("s1_rtc_ds_dims")["time"].cast("long").alias("scenes"), "tr_2015", "total_time", "success", "start_time", "runoff_onsets_dims", "error_messages"))


@query("k10_consolidated_log", "WITH " + RESULTS + """ SELECT "row", col, success, round(total_time, 6) AS total_time FROM r""")
def written_log(spark, sf_dir):
    """K-10: the log is overwritten by its consolidated form."""
    path = scratch(spark, "log")
    for _ in range(2):
        sinks.write_log(_results(spark, sf_dir), path)
    return rounded(readers.result_log(spark, path).select("row", "col", "success", "total_time"))


TILES = d.TILES + """, t AS (SELECT *, CAST(col AS DOUBLE) AS "left", CAST("row" AS DOUBLE) / 2 AS bottom, CAST(col AS DOUBLE) + 1 AS "right", CAST("row" AS DOUBLE) / 2 + 0.5 AS top FROM tiles)"""


def _tiles(spark, sf_dir):
    low, side = F.col("row").cast("double") / 2, F.col("col").cast("double")
    return d.tiles(spark, sf_dir).withColumns({"left": side, "bottom": low, "right": side + 1, "top": low + 0.5})


@query("s05_k08_geojson", "WITH " + TILES + """ SELECT "row", col, percent_valid_snow_pixels, "left", bottom, "right", top FROM t""")
def geojson(spark, sf_dir):
    """S-05, K-08: the catalogue is written as a feature collection and read back with its bounds."""
    path = scratch(spark, "tiles")
    sinks.write_geojson(_tiles(spark, sf_dir), path)
    return readers.catalogue_geojson(spark, path)


STORE = """c AS (SELECT CAST(p_partkey % 7 AS INT) AS tile_row, CAST(p_partkey % 5 AS INT) AS tile_col, p_partkey AS y, CAST(p_size AS DOUBLE) / 10 AS v FROM part)"""


def _stored(spark, sf_dir):
    k = F.col("p_partkey")
    cells = d.table(spark, sf_dir, "part").select((k % 7).cast("int").alias("tile_row"), (k % 5).cast("int").alias("tile_col"), k.alias("y"), (F.col("p_size") / 10.0).alias("v"))
    path = scratch(spark, "store")
    sinks.write_tiles(sinks.encoded(cells, {"v": 0.1}), path)
    again = cells.where("tile_row = 3").withColumn("v", F.col("v") + 100)
    for _ in range(2):
        sinks.write_tiles(sinks.encoded(again, {"v": 0.1}), path)
    return path


@query("k03_k04_store", "WITH " + STORE + " SELECT tile_row, tile_col, y, round(v + CASE WHEN tile_row = 3 THEN 100 ELSE 0 END, 6) AS v FROM c")
def store(spark, sf_dir):
    """K-02 (codec), K-03, K-04, S-04, S-09: tiles are written, some are written again, and the store is read."""
    return rounded(readers.product(spark, _stored(spark, sf_dir), {"v": 0.1}).select("tile_row", "tile_col", "y", "v"))


@query("s17_listing", "WITH " + STORE + " SELECT DISTINCT tile_row, tile_col FROM c")
def listing(spark, sf_dir):
    """S-17, O-10: one file a tile."""
    part = lambda n: F.regexp_extract("path", f"{n}=([0-9]+)", 1).cast("int").alias(n)
    return readers.listing(spark, _stored(spark, sf_dir)).orderBy("path").select(part("tile_row"), part("tile_col"))


@query("s16_artifacts", "WITH " + RESULTS + """ SELECT o_orderkey AS run_id, "row", col, success, round(total_time, 6) AS total_time FROM r WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderkey % 3 > 0""")
def artifacts(spark, sf_dir):
    """S-16, F-14, U-03: recent artifacts of a matching name, a header and a line each."""
    o, names = d.table(spark, sf_dir, "orders"), readers.RESULTS.fieldNames()
    ok = F.when(F.col("o_orderstatus") == "O", "true").when(F.col("o_orderstatus") == "F", "false").otherwise("")
    own = {"row": (F.col("o_custkey") % 50).cast("string"), "col": (F.col("o_custkey") % 40).cast("string"), "total_time": F.col("o_totalprice").cast("decimal(20,2)").cast("string"), "success": ok}
    line = F.concat_ws(",", *[own.get(n, F.lit("")) for n in names])
    text = F.concat(F.lit(",".join(names) + "\r\n"), line, F.lit("\r\n"))
    landed = o.select(F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").cast("timestamp").alias("created_at"), F.when(F.col("o_orderkey") % 3 > 0, "tile-result-x").otherwise("log").alias("artifact_name"), text.alias("csv_text"))
    return rounded(readers.artifacts(landed, "1997-01-01").select("run_id", "row", "col", "success", "total_time"))


@query("s19_k09_reports", "SELECT o_orderpriority AS variable, count(*) AS n FROM orders GROUP BY 1")
def reports(spark, sf_dir):
    """S-19, K-09: reports are written as JSON documents and read back."""
    path = scratch(spark, "reports")
    qa.report(stats.value_counts(d.table(spark, sf_dir, "orders"), "o_orderpriority").withColumnRenamed("o_orderpriority", "variable")).write.text(path)
    return spark.read.schema("variable string, n long").json(path)


@query("k11_job_matrix", "WITH " + d.TILES + """ SELECT printf('%d,%d', "row", col) AS value FROM tiles""")
def job_matrix(spark, sf_dir):
    return sinks.job_matrix(d.tiles(spark, sf_dir), "list")


def _instant(c):
    """A time without zone as an instant, read as UTC; event times of streams must be instants."""
    return F.timestamp_micros(dates.micros(F.col(c)))


def _without_zone(c):
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(c).cast("timestamp_ntz")).alias(c)


@query("t02_stream_of_results", "SELECT DISTINCT CAST(user_id % 50 AS INT) AS \"row\", CAST(event_id % 5 AS INT) AS col, ts AS start_time FROM events")
def stream_of_results(spark, sf_dir):
    """T-02: results appended twice, streamed without repetitions."""
    path = scratch(spark, "stream")
    e = d.table(spark, sf_dir, "events").select((F.col("user_id") % 50).cast("int").alias("row"), (F.col("event_id") % 5).cast("int").alias("col"), _instant("ts").alias("start_time"))
    e.unionByName(e).write.parquet(f"{path}/in")
    got = streaming.drained(spark, f"{path}/in", e.schema, streaming.latest_results, f"{path}/out", f"{path}/checkpoint")
    return got.select("row", "col", _without_zone("start_time"))


@query("t04_stream_windows", """WITH w AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2)
  SELECT * FROM w WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)""")
def stream_windows(spark, sf_dir):
    """T-04: the windows that the watermark has closed."""
    path = scratch(spark, "stream")
    e = d.table(spark, sf_dir, "events").select(_instant("ts").alias("ts"), "event_type", "value")
    e.write.parquet(f"{path}/in")
    got = streaming.drained(spark, f"{path}/in", e.schema, lambda s: streaming.windowed(s, "ts", "1 day", "value", ("event_type",)), f"{path}/out", f"{path}/checkpoint")
    return got.select(_without_zone("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


LAYER = """{"type": "FeatureCollection", "features": [
{"type": "Feature", "properties": {"code": 1}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0.05, 0.05], [2.05, 0.05], [2.05, 2.05], [0.05, 2.05], [0.05, 0.05]]], [[[6.05, 4.05], [8.05, 4.05], [8.05, 6.05], [6.05, 6.05], [6.05, 4.05]]]]}},
{"type": "Feature", "properties": {"code": 2}, "geometry": {"type": "Polygon", "coordinates": [[[3.05, 1.05], [5.55, 1.05], [5.55, 3.55], [3.05, 3.55], [3.05, 1.05]], [[4.05, 2.05], [4.55, 2.05], [4.55, 2.55], [4.05, 2.55], [4.05, 2.05]]]}},
{"type": "Feature", "properties": {"code": 3}, "geometry": null}]}"""


@query("s08_s13_polygon_layer", """WITH pts AS (SELECT p_partkey AS id, CAST(p_partkey % 101 AS DOUBLE) / 10 AS lon, CAST(p_partkey % 73 AS DOUBLE) / 10 AS lat FROM part)
  SELECT id, polygon_id FROM (SELECT id, CASE WHEN lon BETWEEN 0.05 AND 2.05 AND lat BETWEEN 0.05 AND 2.05 OR lon BETWEEN 6.05 AND 8.05 AND lat BETWEEN 4.05 AND 6.05 THEN 1::BIGINT
    WHEN lon BETWEEN 3.05 AND 5.55 AND lat BETWEEN 1.05 AND 3.55 AND NOT (lon BETWEEN 4.05 AND 4.55 AND lat BETWEEN 2.05 AND 2.55) THEN 2::BIGINT END AS polygon_id FROM pts) WHERE polygon_id IS NOT NULL""")
def polygon_layer(spark, sf_dir):
    """S-08, S-13, J-15, J-16: a feature of two parts, and one with a hole."""
    path, p = scratch(spark, "layer"), F.col("p_partkey")
    spark.createDataFrame([(LAYER,)], "value string").coalesce(1).write.text(path)
    points = d.table(spark, sf_dir, "part").select(p.alias("id"), ((p % 101).cast("double") / 10).alias("lon"), ((p % 73).cast("double") / 10).alias("lat"))
    return spatial.in_layer(points, readers.feature_layer(spark, path, "code"), 1.0).select("id", "polygon_id")


@query("j05_utm_round_trip", "SELECT p_partkey AS id, CAST(p_partkey % 600 AS DOUBLE) / 100 + 6 AS lon, CAST(p_partkey % 160 AS DOUBLE) / 2 AS lat, CAST(32 AS INT) AS zone FROM part")
def utm_round_trip(spark, sf_dir):
    """J-05, S-02: degrees to metres of a UTM zone and back."""
    p = F.col("p_partkey")
    points = d.table(spark, sf_dir, "part").select(p.alias("id"), ((p % 600).cast("double") / 100 + 6).alias("lon0"), ((p % 160).cast("double") / 2).alias("lat0"))
    easting, northing = crs.projected(F.col("lon0"), F.col("lat0"), 32)
    there = points.withColumns({"easting": easting, "northing": northing})
    lon, lat = crs.geographic(F.col("easting"), F.col("northing"), 32)
    return rounded(there.select("id", lon.alias("lon"), lat.alias("lat"), crs.zone_of(F.col("lon0")).alias("zone")))


@query("a36_log_histogram", """WITH v AS (SELECT log10(o_totalprice) AS x FROM orders WHERE o_totalprice > 0), e AS (SELECT min(x) AS lo, max(x) AS hi FROM v)
  SELECT CAST(least(floor((x - lo) / ((hi - lo) / 20)), 19) AS INT) AS bin, count(*) AS n FROM v, e GROUP BY 1""")
def log_histogram(spark, sf_dir):
    return stats.log_histogram(d.table(spark, sf_dir, "orders"), "o_totalprice", 20)


@query("k01_created_store", "WITH " + STORE + ", s AS (SELECT * FROM c WHERE tile_row <> 2) SELECT tile_row, tile_col, y, round(v, 6) AS v FROM s")
def created_store(spark, sf_dir):
    """K-01, K-02, S-04: an empty store is made, the tiles of all rows but one are written (a missing tile is missing cells), and it is read."""
    path, k = scratch(spark, "created"), F.col("p_partkey")
    sinks.create_store(spark, path, "tile_row int, tile_col int, y long, v smallint", {"v": {"scale": 0.1, "fill": -9999, "description": "size"}})
    empty = readers.store(spark, path)
    cells = d.table(spark, sf_dir, "part").select((k % 7).cast("int").alias("tile_row"), (k % 5).cast("int").alias("tile_col"), k.alias("y"), (F.col("p_size") / 10.0).alias("v"))
    sinks.write_region(cells.where("tile_row <> 2"), path)
    return rounded(empty.unionByName(readers.store(spark, path)))


@query("s14_k07_cube", "SELECT l_suppkey AS station, l_shipdate AS time, count(*) AS n FROM lineitem GROUP BY 1, 2")
def cube(spark, sf_dir):
    """S-14, K-07: the cube of stations and days is written without geometries and read back."""
    path = scratch(spark, "cube")
    rows = d.table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("station"), F.col("l_shipdate").alias("time")).agg(F.count("*").alias("n"))
    sinks.write_cube(rows.withColumn("geometry", F.lit("POINT (0 0)")), path)
    return readers.product(spark, path)


RASTER = """g AS (SELECT CAST(p_partkey // 50 AS INT) AS y, CAST(p_partkey % 50 AS INT) AS x, CASE WHEN p_size <> 7 THEN CAST(p_size AS DOUBLE) / 2 END AS value FROM part)"""


def _raster_files(spark, sf_dir):
    """The parts as GeoTIFF files of 64 rows, in tiles of 16 cells; sizes of 7 are missing, and so are cells without a part."""
    import numpy as np
    import pandas as pd

    k = F.col("p_partkey")
    cells = d.table(spark, sf_dir, "part").select(F.floor(k / 3200).cast("long").alias("part"), F.floor(k / 50).cast("long").alias("y"), (k % 50).alias("x"), F.col("p_size").cast("int").alias("v"))

    def file(rows):
        first = int(rows["part"].iloc[0]) * 64
        grid = np.full((64, 50), 7, np.int16)
        grid[rows["y"] - first, rows["x"]] = rows["v"]
        return pd.DataFrame({"path": [f"{first:08d}.tif"], "content": [rasters.encoded(grid, 0.0, -float(first), 1.0, nodata=7, block=16, predictor=2)]})

    return cells.groupBy("part").applyInPandas(file, "path string, content binary")


@query("s10_geotiff_scan", "WITH " + RASTER + " SELECT y, x, value, x + 0.5::DOUBLE AS lon, -(y + 0.5::DOUBLE) AS lat FROM g WHERE value IS NOT NULL")
def geotiff_scan(spark, sf_dir):
    """S-10: files of 64 rows of the grid are scanned, scaled, and put on one grid by their places on the ground."""
    got = rasters.decoded(_raster_files(spark, sf_dir), scale=0.5).where("value IS NOT NULL")
    return spatial.nearest_cell(got, 0.0, 0.0, 1.0).select("y", "x", "value", "lon", "lat")


@query("s11_elevation", "WITH " + RASTER + """, m AS (SELECT CAST(max(y) AS INT) AS m FROM g), t AS (SELECT CAST(ty AS INT) AS ty, CAST(tx AS INT) AS tx, ty * 2 + 0.5::DOUBLE AS sy, tx * 2 + 0.25::DOUBLE AS sx FROM (SELECT unnest(range(0, (SELECT m FROM m) // 2 + 1)) AS ty) a CROSS JOIN range(0, 25) AS b(tx)),
  w AS (SELECT ty, tx, value, (1 - abs(g.y - sy)) * (1 - abs(g.x - sx)) AS w FROM t JOIN g ON g.y IN (ty * 2, ty * 2 + 1) AND g.x IN (tx * 2, tx * 2 + 1) WHERE value IS NOT NULL)
  SELECT t.ty, t.tx, round(v, 6) AS value FROM t LEFT JOIN (SELECT ty, tx, sum(w * value) / sum(w) AS v FROM w GROUP BY 1, 2) q ON q.ty = t.ty AND q.tx = t.tx""")
def elevation(spark, sf_dir):
    """S-11, J-05: a scan by the cells of a template of half its resolution, bilinear."""
    files = _raster_files(spark, sf_dir)
    k = F.col("p_partkey")
    rows = d.table(spark, sf_dir, "part").select(F.floor(k / 100).alias("ty"))
    last = rows.agg(F.max("ty")).first()[0] or 0
    at = F.col("id")
    template = spark.range((last + 1) * 25).select(F.floor(at / 25).cast("int").alias("ty"), (at % 25).cast("int").alias("tx"))
    template = template.withColumns({"lat": -(F.col("ty") * 2 + 1.0), "lon": F.col("tx") * 2 + 0.75})
    return rounded(rasters.elevation(rasters.decoded(files, scale=0.5), template, 0.0, 0.0, 1.0))


@query("s12_land_cover", "WITH " + RASTER + " SELECT CAST(y3 AS INT) AS y, CAST(x3 AS INT) AS x, value FROM (SELECT y // 3 AS y3, x // 3 AS x3, value, row_number() OVER (PARTITION BY y // 3, x // 3 ORDER BY count(*) DESC, value) AS k FROM g WHERE value IS NOT NULL GROUP BY 1, 2, 3) WHERE k = 1")
def land_cover(spark, sf_dir):
    """S-12: the most frequent class of nine scanned cells."""
    return rasters.land_cover(rasters.decoded(_raster_files(spark, sf_dir), scale=0.5), 0.0, 0.0, 1.0, 3).select("y", "x", "value")


@query("x09_attempted", """SELECT o_orderkey AS tile, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice * 2 END AS twice, o_orderkey % 7 <> 0 AS success,
  CAST(CASE WHEN o_orderkey % 7 = 0 THEN 3 WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END AS INT) AS attempts FROM orders""")
def attempted(spark, sf_dir):
    """X-09: work that fails always for some tiles, once for others, with two retries."""
    seen = set()

    def work(tile):
        key = tile["tile"]
        if key % 7 == 0 or key % 5 == 0 and key not in seen:
            seen.add(key)
            raise ValueError(f"tile {key}")
        return {"twice": tile["price"] * 2}

    tiles = d.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("tile"), F.col("o_totalprice").alias("price"))
    return batches.attempted(tiles, work, "twice double", retries=2, keys=("tile",)).select("tile", "twice", "success", "attempts")


@query("t03_batch_with_timeout", "SELECT o_orderkey AS tile, o_orderkey % 4 <> 0 AS success FROM orders")
def batch_with_timeout(spark, sf_dir):
    """T-03: tiles of a batch, one piece of which fails; each tile ends as done or as failed."""
    path, out = scratch(spark, "batch"), scratch(spark, "done")
    tiles = d.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("tile"), (F.col("o_orderkey") % 4).alias("lane"))

    def done(part, k):
        part.withColumn("success", F.when(F.col("lane") == 0, F.raise_error(F.lit("lane 0")).cast("boolean")).otherwise(True)).write.mode("overwrite").parquet(f"{out}/piece={k}")

    failed = batches.within(tiles, 1600, done, path, ("lane",), by=F.col("lane").cast("int"), pieces=4)
    return failed.select("tile", "success").unionByName(spark.read.schema("tile long, lane long, success boolean").parquet(out).select("tile", "success"))


@query("s16_paged_ingest", """SELECT run, 'tile-result-' || (run % 3) AS artifact_name, CAST(run % 50 AS INT) AS "row" FROM (SELECT unnest(range(1, 251)) AS run) WHERE run % 10 >= 2""")
def paged_ingest(spark, sf_dir):
    """S-16: pages of runs, a page of artifacts each, archives unpacked by tasks; the service is a function here."""
    import io
    import zipfile

    def runs(page):
        return [{"id": r, "created_at": f"2024-01-{r % 10 + 1:02d}T00:00:00Z"} for r in range(page * 100 - 99, min(page * 100, 250) + 1)]

    def artifacts(run, page):
        return [{"name": n, "archive_download_url": f"{run}"} for n in (f"tile-result-{run % 3}", "logs")] if page == 1 else []

    def download(url):
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as z:
            z.writestr("result.csv", f"row\n{int(url) % 50}\n")
            z.writestr("notes.txt", "none")
        return held.getvalue()

    got = ingest.landed(spark, runs, artifacts, download, "2024-01-03")
    return got.select(F.col("run_id").alias("run"), "artifact_name", F.split("csv_text", "\n")[1].cast("int").alias("row"))


@query("e29_aspect", "WITH " + GRID + """, n AS (SELECT a.y, a.x, count(*) AS n, sum(b.dem * (b.x - a.x) * (2 - abs(b.y - a.y))) / 800 AS gx, sum(b.dem * (a.y - b.y) * (2 - abs(b.x - a.x))) / 800 AS gy
    FROM g a JOIN g b ON abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 GROUP BY 1, 2),
  d AS (SELECT y, x, CASE WHEN n = 9 AND sqrt(gx * gx + gy * gy) > 1e-9 THEN degrees(atan2(-gx, -gy)) END AS a FROM n)
  SELECT y, x, round(sin(radians(a)), 4) AS east, round(cos(radians(a)), 4) AS north FROM d""")
def aspect(spark, sf_dir):
    """E-29: the direction downhill as its east and north parts, which have no seam at north."""
    from .gridded import _grid

    got = spatial.terrain(_grid(spark, sf_dir), 100.0)
    a = F.radians(F.col("aspect"))
    return got.select("y", "x", (F.round(F.sin(a), 4) + F.lit(0.0)).alias("east"), (F.round(F.cos(a), 4) + F.lit(0.0)).alias("north"))

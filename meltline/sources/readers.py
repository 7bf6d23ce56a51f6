"""Readers. Schemas are explicit, NaN and fill values become null where data come in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import day_of_water_year, unix_seconds, water_year
from ..functions.scalars import blank_to_null, decode

YEARS = range(2015, 2025)
RESULTS = T.StructType(
    [T.StructField("row", T.IntegerType()), T.StructField("col", T.IntegerType()), T.StructField("percent_valid_snow_pixels", T.DoubleType())]
    + [T.StructField(c, T.StringType()) for c in ("s1_rtc_ds_dims", "runoff_onsets_dims")]
    + [T.StructField(f"tr_{y}", T.DoubleType()) for y in YEARS]
    + [T.StructField(f"pix_ct_{y}", T.DoubleType()) for y in YEARS]
    + [T.StructField("start_time", T.StringType()), T.StructField("total_time", T.DoubleType()), T.StructField("success", T.BooleanType()), T.StructField("error_messages", T.StringType())]
)


def search_scenes(items: DataFrame, bbox: tuple[float, float, float, float], start: str, end: str, collection: str | None = None) -> DataFrame:
    """Items whose box meets bbox, in a closed range of times; the predicates reach the scan."""
    left, bottom, right, top = bbox
    meet = (F.col("left") <= right) & (F.col("right") >= left) & (F.col("bottom") <= top) & (F.col("top") >= bottom)
    last = F.lit(end).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    out = items.where(meet & (F.col("datetime") >= F.lit(start).cast("timestamp_ntz")) & (F.col("datetime") < last))
    return out.where(F.col("collection") == collection) if collection else out


def first_scenes(items: DataFrame) -> DataFrame:
    """The first record of each absolute orbit by time, its values as they are."""
    cols = [c for c in items.columns if c not in ("abs_orbit", "datetime")]
    first = items.groupBy("abs_orbit").agg(F.min(F.struct("datetime", *cols)).alias("s"))
    return first.select("abs_orbit", "s.datetime", *[f"s.{c}" for c in cols])


def mosaic(obs: DataFrame, bands: Sequence[str] = ("vv", "vh"), nodata: float = -32768, keys: Sequence[str] = ("abs_orbit", "y", "x")) -> DataFrame:
    """One value for each cell and absolute orbit: the first valid one by time."""
    valid = [F.when(~F.isnan(b) & (F.col(b) != nodata), F.col(b)) for b in bands]
    firsts = [F.min(F.when(v.isNotNull(), F.struct(F.col("time").alias("t"), v.alias("v"))))["v"].alias(b) for b, v in zip(bands, valid)]
    return obs.groupBy(*keys).agg(F.min("time").alias("time"), *firsts)


def observations(spark: SparkSession, path: str, bands: Sequence[str], start: str, end: str, hemisphere: str = "northern", nodata: float = -32768) -> DataFrame:
    """Radar observations between two dates (both included), with water year and day of it; missing values are null."""
    rows = spark.read.parquet(path)
    last = F.lit(end).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    rows = rows.where((F.col("time") >= F.lit(start).cast("timestamp_ntz")) & (F.col("time") < last))
    rows = rows.withColumns({b: F.when(~F.isnan(b) & (F.col(b) != nodata), F.col(b)) for b in bands})
    rows = rows.withColumns({"water_year": water_year("time", hemisphere), "dowy": day_of_water_year("time", hemisphere)})
    return rows.drop(*[b for b in ("vv", "vh") if b not in bands])


def product(spark: SparkSession, path: str, scales: dict[str, float] | None = None, fill: int = -9999) -> DataFrame:
    """A stored product, decoded; without scales as it is stored."""
    rows = spark.read.parquet(path)
    return rows.withColumns({c: decode(c, s, 0.0, fill) for c, s in scales.items()}) if scales else rows


def store(spark: SparkSession, path: str, decoded: bool = True) -> DataFrame:
    """The cells of a store that sinks.create_store made, as its schema says; without decoding as they are stored."""
    from .sinks import store_schema

    schema = store_schema(spark, path)
    rows = spark.read.schema(schema).parquet(f"{path}/cells")
    one = lambda f: decode(f.name, f.metadata["scale"], f.metadata.get("offset", 0.0), f.metadata.get("fill", -9999)) if decoded and "scale" in f.metadata else F.col(f"`{f.name}`")
    return rows.select(*[one(f).alias(f.name) for f in schema.fields])


def catalogue_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Tiles of a GeoJSON feature collection with the bounds of their rings, largest percentage first."""
    schema = (
        "features array<struct<properties: struct<tile: string, row: int, col: int, percent_valid_snow_pixels: double>, "
        "geometry: struct<type: string, coordinates: array<array<array<double>>>>>>"
    )
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    ring = F.flatten("f.geometry.coordinates")
    axis = lambda i: F.transform(ring, lambda p: p[i])
    out = rows.select(
        "f.properties.row", "f.properties.col", "f.properties.percent_valid_snow_pixels", F.array_min(axis(0)).alias("left"), F.array_min(axis(1)).alias("bottom"),
        F.array_max(axis(0)).alias("right"), F.array_max(axis(1)).alias("top"),
    )
    return out.orderBy(F.desc_nulls_last("percent_valid_snow_pixels"), "row", "col")


def result_log(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Tile results from CSV files with a header; starts are seconds since 1970, blank and nan text is null."""
    reader = spark.read.schema(RESULTS).option("header", True).option("mode", "PERMISSIVE").option("escape", '"')
    rows = reader.option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.csv").csv(path)
    texts = {c: blank_to_null(c) for c in ("s1_rtc_ds_dims", "runoff_onsets_dims", "error_messages")}
    return rows.withColumns({**texts, "start_time": unix_seconds(blank_to_null("start_time")), "sequence": F.monotonically_increasing_id()})


def artifacts(landing: DataFrame, cutoff: str, name_part: str = "tile-result") -> DataFrame:
    """Result rows of landed artifacts (run_id, created_at, artifact_name, csv_text): recent ones of a matching name."""
    kept = landing.where((F.col("created_at") >= F.lit(cutoff).cast("timestamp")) & F.col("artifact_name").contains(name_part))
    lines = kept.select("run_id", "artifact_name", F.posexplode(F.split(F.regexp_replace("csv_text", "\r", ""), "\n")).alias("line", "text"))
    rows = lines.where("line > 0 AND text <> ''")
    parsed = F.from_csv("text", RESULTS.simpleString()[7:-1].replace(":", " ").replace(",", ", "), {"escape": '"'})
    return rows.withColumn("r", parsed).select("run_id", "artifact_name", "line", "r.*")


def listing(spark: SparkSession, folder: str, glob: str = "*.parquet") -> DataFrame:
    """File names of a folder as a relation."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("filename"), "modificationTime", "length")


def reports(spark: SparkSession, folder: str) -> DataFrame:
    """Validation reports of a folder, by path."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(folder)
    return rows.withColumn("path", F.input_file_name()).orderBy("path")


ITEM = (
    "features array<struct<id: string, collection: string, bbox: array<double>, properties: struct<datetime: string, `sat:absolute_orbit`: int, "
    "`sat:relative_orbit`: int, `sat:orbit_state`: string>>>"
)


def scene_items(spark: SparkSession, path: str) -> DataFrame:
    """Scene records from item collections (JSON): id, collection, bounds, time and orbits, one row an item."""
    rows = spark.read.schema(ITEM).option("multiLine", True).option("recursiveFileLookup", True).json(path).select(F.explode("features").alias("f"))
    side = lambda i: F.get("f.bbox", i)
    return rows.select(
        "f.id", "f.collection", F.to_timestamp_ntz(F.regexp_replace("f.properties.datetime", r"(Z|\+00:00)$", "")).alias("datetime"),
        F.col("f.properties.`sat:absolute_orbit`").alias("abs_orbit"), F.col("f.properties.`sat:relative_orbit`").alias("rel_orbit"), F.col("f.properties.`sat:orbit_state`").alias("orbit_state"),
        side(0).alias("left"), side(1).alias("bottom"), side(2).alias("right"), side(3).alias("top"),
    )


def feature_layer(spark: SparkSession, path: str, key: str, within: tuple[float, float, float, float] | None = None) -> DataFrame:
    """id and rings (of all parts, holes too) of the polygons and multipolygons of GeoJSON files, by an integer property;
    those whose box meets a box. Features without a geometry go; other geometries are an error."""
    schema = f"features array<struct<properties: struct<`{key}`: bigint>, geometry: struct<type: string, coordinates: string>>>"
    rows = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(path).select(F.explode("features").alias("f"))
    kind, places = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    one, many = F.from_json(places, "array<array<array<double>>>"), F.flatten(F.from_json(places, "array<array<array<array<double>>>>"))
    wrong = F.raise_error(F.concat(F.lit("no polygon: "), kind)).cast("array<array<array<double>>>")
    rings = F.when(kind == "Polygon", one).when(kind == "MultiPolygon", many).when(kind.isNotNull(), wrong)
    out = rows.select(F.col(f"f.properties.`{key}`").alias("id"), rings.alias("rings")).where("rings IS NOT NULL")
    if within:
        left, bottom, right, top = within
        axis = lambda f, i: f(F.transform(F.flatten("rings"), lambda p: p[i]))
        out = out.where((axis(F.array_min, 0) <= right) & (axis(F.array_max, 0) >= left) & (axis(F.array_min, 1) <= top) & (axis(F.array_max, 1) >= bottom))
    return out


def polygon_layer(spark: SparkSession, path: str, key: str, within: tuple[float, float, float, float] | None = None) -> list[tuple[int, list[tuple[float, float]]]]:
    """The rings of a small layer as a parameter, (id, ring) each; a feature's parts and holes share its id."""
    rows = feature_layer(spark, path, key, within).orderBy("id").collect()
    return [(r.id, [tuple(p) for p in ring]) for r in rows for ring in r.rings]

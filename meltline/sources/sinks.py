"""Writers. A region is a partition that can be written again without touching others."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import blank_to_null, encode
from .shared import scratch

TILE = ("tile_row", "tile_col")


def write_tiles(df: DataFrame, path: str, keys: Sequence[str] = TILE) -> None:
    """Overwrites the tiles that df holds, and only those; compressed with zstd, sorted inside a tile for pruning."""
    inner = [c for c in ("y", "x", "water_year") if c in df.columns]
    placed = df.repartition(*keys).sortWithinPartitions(*keys, *inner)
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*keys).parquet(path)


def encoded(df: DataFrame, scales: dict[str, float]) -> DataFrame:
    """Columns as stored 16-bit integers."""
    return df.withColumns({c: encode(c, s) for c, s in scales.items()})


def create_log(spark, path: str, schema) -> None:
    """An empty log with a header, where there is none yet."""
    try:
        spark.read.format("binaryFile").load(path).limit(1).count()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        spark.createDataFrame([], schema).coalesce(1).write.option("header", True).csv(path)


def append_results(rows: DataFrame, path: str, header: bool = True) -> None:
    """Adds result rows to a CSV log; nan spellings and missing values are written as nothing."""
    texts = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "string"]
    numbers = [f.name for f in rows.schema.fields if f.dataType.simpleString() in ("double", "float")]
    clean = rows.withColumns({**{c: blank_to_null(c) for c in texts}, **{c: F.when(~F.isnan(c), F.col(c)) for c in numbers}})
    clean.write.mode("append").option("header", header).option("nullValue", "").option("emptyValue", "").option("escape", '"').csv(path)


def write_log(rows: DataFrame, path: str, order: Sequence[str] = ("start_time",)) -> None:
    """The consolidated log as one sorted file with a header; rows of equal order stay as they came.

    Tasks sort and write a range of the order each; the driver then strings these files together, a buffer at a time,
    beside the old log, which is replaced once the new one is whole.
    """
    spark, parts = rows.sparkSession, scratch(rows.sparkSession, "log-parts")
    form = lambda df, at, header: df.write.option("header", header).option("nullValue", "").option("escape", '"').option("compression", "none").csv(at)
    form(spark.createDataFrame([], rows.schema).coalesce(1), f"{parts}/head", True)
    keys = [*order, "_came"]
    placed = rows.withColumn("_came", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    form(placed.drop("_came"), f"{parts}/rows", False)
    hadoop = spark._jvm.org.apache.hadoop
    at, conf = hadoop.fs.Path, spark._jsparkSession.sessionState().newHadoopConf()
    source, target = at(parts).getFileSystem(conf), at(path).getFileSystem(conf)
    if target.exists(at(path)) and target.getFileStatus(at(path)).isFile():
        target.delete(at(path), False)
    old = list(target.listStatus(at(path))) if target.exists(at(path)) else []
    name = f"part-00000-{uuid.uuid4().hex}.csv"
    out = target.create(at(f"{path}/.{name}"))
    try:
        for part in ("head", "rows"):
            files = [f.getPath() for f in source.listStatus(at(f"{parts}/{part}")) if f.getPath().getName().startswith("part-")]
            for f in sorted(files, key=lambda f: int(f.getName().split("-")[1])):
                held = source.open(f)
                hadoop.io.IOUtils.copyBytes(held, out, 1 << 20, False)
                held.close()
    finally:
        out.close()
    if not target.rename(at(f"{path}/.{name}"), at(f"{path}/{name}")):
        raise OSError(f"{path}/.{name} can't be renamed")
    for f in old:
        target.delete(f.getPath(), True)
    source.delete(at(parts), True)
    spark.catalog.refreshByPath(path)


def geojson_features(tiles: DataFrame) -> DataFrame:
    """One GeoJSON feature a row."""
    corner = lambda x, y: F.array(F.col(x), F.col(y))
    ring = F.array(corner("left", "bottom"), corner("right", "bottom"), corner("right", "top"), corner("left", "top"), corner("left", "bottom"))
    properties = F.struct(*[c for c in tiles.columns if c not in ("left", "bottom", "right", "top")])
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    return tiles.select(F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), geometry.alias("geometry"))).alias("value"))


def write_geojson(tiles: DataFrame, path: str) -> None:
    """A feature collection, its features in text lines between head and foot."""
    whole = geojson_features(tiles).agg(F.array_join(F.array_sort(F.collect_list("value")), ",\n").alias("f"))  # a catalogue's tiles
    whole.select(F.concat(F.lit('{"type": "FeatureCollection", "features": [\n'), "f", F.lit("\n]}")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def job_matrix(tiles: DataFrame, form: str = "json") -> DataFrame:
    """Tile ids for a job matrix: json (one compact document), list (a line a tile) or count."""
    if form == "count":
        return tiles.agg(F.count("*").cast("string").alias("value"))
    if form == "list":
        return tiles.select(F.format_string("%d,%d", "row", "col").alias("value"))
    if form == "json":
        return tiles.agg(F.to_json(F.array_sort(F.collect_list(F.struct("row", "col")))).alias("value"))
    raise ValueError(f"unknown form {form!r}")


def create_store(spark, path: str, schema: str, variables: dict[str, dict], keys: Sequence[str] = TILE) -> None:
    """An empty store: no cells yet, which stands for the fill value everywhere, and what is known of each variable
    (scale, offset, fill, units, description) as metadata of its column. Replaces what is there."""
    made = spark.createDataFrame([], schema)
    described = made.select(*[F.col(f"`{c}`").alias(c, metadata=variables.get(c, {})) for c in made.columns])
    described.coalesce(1).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/schema")
    described.where("false").write.mode("overwrite").option("compression", "zstd").partitionBy(*keys).parquet(f"{path}/cells")


def store_schema(spark, path: str):
    """The schema of a store, with the metadata of its columns."""
    return spark.read.parquet(f"{path}/schema").schema


def write_region(df: DataFrame, path: str, keys: Sequence[str] = TILE) -> None:
    """Overwrites the tiles that df holds in a store, as its schema encodes them."""
    schema = store_schema(df.sparkSession, path)
    one = lambda f: encode(f.name, f.metadata["scale"], f.metadata.get("offset", 0.0), f.metadata.get("fill", -9999)) if "scale" in f.metadata else F.col(f"`{f.name}`")
    write_tiles(df.select(*[one(f).cast(f.dataType).alias(f.name) for f in schema.fields]), f"{path}/cells", keys)


def write_cube(df: DataFrame, path: str, keys: Sequence[str] = ("station",)) -> None:
    """A cube of stations and times as a sorted table, without geometries, which belong to the stations' own table."""
    kept = df.drop("geometry")
    kept.repartition(*keys).sortWithinPartitions(*keys, *[c for c in ("time", "water_year") if c in kept.columns]).write.mode("overwrite").option("compression", "zstd").parquet(path)

"""The global grid as integer arithmetic: rows grow southward, columns eastward."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config


def shape(config: Config) -> tuple[int, int]:
    """Tiles down and across."""
    left, bottom, right, top = config.bbox
    side = config.resolution * config.chunk_write
    return math.ceil((top - bottom) / side), math.ceil((right - left) / side)


def tiles(spark: SparkSession, config: Config) -> DataFrame:
    """row, col and bounds of every tile; tiles at the edges are short."""
    rows, cols = shape(config)
    left, bottom, right, top = config.bbox
    side = config.resolution * config.chunk_write
    every = spark.range(rows * cols).select((F.col("id") / cols).cast("int").alias("row"), (F.col("id") % cols).cast("int").alias("col"))
    return every.select(
        "row", "col", (F.lit(left) + F.col("col") * side).alias("left"), F.greatest(F.lit(top) - (F.col("row") + 1) * side, F.lit(bottom)).alias("bottom"),
        F.least(F.lit(left) + (F.col("col") + 1) * side, F.lit(right)).alias("right"), (F.lit(top) - F.col("row") * side).alias("top"),
    )


def with_tile(cells: DataFrame, config: Config) -> DataFrame:
    """Tile of each grid cell (y, x)."""
    return cells.withColumns({"tile_row": (F.col("y") / config.chunk_write).cast("int"), "tile_col": (F.col("x") / config.chunk_write).cast("int")})

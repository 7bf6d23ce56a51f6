"""The flat analysis mart and its statistics by latitude and elevation bins."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import INT32, bin_left, chili_class, correlation, ratio, whole

LATITUDE, ELEVATION = (-80, 80, 1), (0, 9000, 100)
SHORTS = ("dem", "aspect", "slope", "snow_classification", "esa_worldcover", "forest_cover_fraction", "GMBA_V2_ID", "continent", "runoff_onset_median")


def years_wide(onset: DataFrame, years: Sequence[int], keys: Sequence[str] = ("pixel",)) -> DataFrame:
    """Yearly onsets as columns runoff_onset_WY<year>."""
    wide = onset.groupBy(*keys).pivot("water_year", list(years)).agg(F.first("runoff_onset"))
    return wide.withColumnsRenamed({str(y): f"runoff_onset_WY{y}" for y in years})


def with_coordinates(cells: DataFrame, top: float, left: float, resolution: float) -> DataFrame:
    """Latitude and longitude of each cell's centre, from its integer place."""
    return cells.withColumns({"original_lat": F.lit(top) - (F.col("y") + 0.5) * resolution, "original_lon": F.lit(left) + (F.col("x") + 0.5) * resolution})


def mart(cells: DataFrame, years: Sequence[int]) -> DataFrame:
    """Typed mart rows of cells with a median; whole columns hold -9999 where missing, rounded half to even."""
    out = cells.where(F.col("runoff_onset_median").isNotNull())
    typed = {c: whole(c) for c in (*SHORTS, *(f"runoff_onset_WY{y}" for y in years)) if c in cells.columns}
    typed |= {"PFAF_ID": whole("PFAF_ID", INT32, "int")} if "PFAF_ID" in cells.columns else {}
    typed |= {c: F.bround(c, 4).cast("float") for c in ("original_lat", "original_lon", "chili") if c in cells.columns}
    typed |= {"runoff_onset_mad": F.bround("runoff_onset_mad", 2).cast("float")} if "runoff_onset_mad" in cells.columns else {}
    return out.withColumns(typed)


def binned(rows: DataFrame, latitude: tuple = LATITUDE, elevation: tuple = ELEVATION, lat: str = "original_lat", dem: str = "dem") -> DataFrame:
    """Rows with lat_bin and dem_bin (left edges of right-closed bins); rows outside all bins go."""
    return rows.withColumns({"lat_bin": bin_left(lat, *latitude), "dem_bin": bin_left(dem, *elevation)}).na.drop(subset=["lat_bin", "dem_bin"])


def domain(spark, latitude: tuple = LATITUDE, elevation: tuple = ELEVATION) -> DataFrame:
    """All bins; their number is fixed by the parameters."""
    lats = spark.range(latitude[0], latitude[1], latitude[2]).select(F.col("id").cast("int").alias("lat_bin"))
    dems = spark.range(elevation[0], elevation[1], elevation[2]).select(F.col("id").cast("int").alias("dem_bin"))
    return lats.crossJoin(F.broadcast(dems))


def bin_statistics(bins: DataFrame, columns: Sequence[str] = ("runoff_onset_median", "runoff_onset_mad"), by: Sequence[str] = ()) -> DataFrame:
    """Mean, median and count of each column by bin (and class), one row for each column and statistic."""
    aggs = [f(c).alias(f"{n}__{c}") for c in columns for n, f in (("mean", F.avg), ("median", F.median), ("count", F.count))]
    wide = bins.groupBy("lat_bin", "dem_bin", *by).agg(*aggs)
    parts = ", ".join(f"'{n}', '{c}', cast(`{n}__{c}` AS double)" for c in columns for n in ("mean", "median", "count"))
    return wide.select("lat_bin", "dem_bin", *by, F.expr(f"stack({3 * len(columns)}, {parts}) AS (statistic, variable, value)"))


def dense(statistics: DataFrame, latitude: tuple = LATITUDE, elevation: tuple = ELEVATION) -> DataFrame:
    """Every bin for every statistic, null where there are no rows."""
    kinds = statistics.select("statistic", "variable").distinct()
    every = domain(statistics.sparkSession, latitude, elevation).crossJoin(F.broadcast(kinds))
    return every.join(statistics, ["lat_bin", "dem_bin", "statistic", "variable"], "left")


def class_contrast(bins: DataFrame, column: str = "runoff_onset_median", chili: str = "chili") -> DataFrame:
    """Statistics of warm and cool slopes side by side, with difference and ratio; the ratio's place of a count is the warm count."""
    rows = bin_statistics(bins.withColumn("chili_class", chili_class(chili)), (column,), ("chili_class",))
    wide = rows.groupBy("lat_bin", "dem_bin", "statistic").pivot("chili_class", ["cool", "neutral", "warm"]).agg(F.first("value"))
    counted = F.col("statistic") == "count"
    return wide.withColumns({
        "difference": F.when(counted, F.col("warm")).otherwise(F.col("warm") - F.col("cool")),
        "ratio": F.when(counted, F.col("warm")).otherwise(ratio("warm", "cool")),
    })


def bin_correlations(bins: DataFrame, column: str, others: Sequence[str], keys: Sequence[str] = ("lat_bin", "dem_bin")) -> DataFrame:
    return bins.groupBy(*keys).agg(*[correlation(column, o).alias(f"corr_{o}") for o in others])


def correlation_matrix(rows: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """All pairs of columns in one pass, one row a pair (first column before second)."""
    pairs = list(combinations(columns, 2))
    wide = rows.groupBy(*keys).agg(*[correlation(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    parts = ", ".join(f"'{a}', '{b}', c{i}" for i, (a, b) in enumerate(pairs))
    return wide.select(*keys, F.expr(f"stack({len(pairs)}, {parts}) AS (first, second, correlation)"))


def elevation_columns(statistics: DataFrame, elevations: Sequence[int], latitude: tuple = LATITUDE) -> DataFrame:
    """Bins as a table of latitudes by elevations, all latitudes, highest first."""
    wide = statistics.groupBy("lat_bin").pivot("dem_bin", list(elevations)).agg(F.first("value"))
    lats = statistics.sparkSession.range(*latitude).select(F.col("id").cast("int").alias("lat_bin"))
    return lats.join(wide, "lat_bin", "left").orderBy(F.desc("lat_bin"))

"""Sampling quality of each pixel, water year and orbit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import masked

SERIES = ("pixel", "water_year", "orbit")
ORDER = ("time",)


def orbit_counts(obs: DataFrame, bands: Sequence[str] = ("vv",), keys: Sequence[str] = SERIES) -> DataFrame:
    """Valid values of each band."""
    return obs.groupBy(*keys).agg(*[F.count(b).alias(f"count_{b}") for b in bands])


def _steps(band: str, keys: Sequence[str], order: Sequence[str], mode: str) -> tuple[Column, Column]:
    """The step into each row, and the step from the last row to the end of the search window."""
    start, end = F.col("search_window_start_DOWY"), F.col("search_window_end_DOWY")
    by_time = Window.partitionBy(*keys).orderBy(*order)
    last = F.lead(F.lit(1)).over(by_time).isNull()
    if mode == "literal":
        day = F.when(F.col(band).isNull(), F.col("dowy"))
        before = F.when(F.row_number().over(by_time) == 1, start).otherwise(F.lag(day).over(by_time))
        return day - before, F.when(last, end - day)
    if mode == "documented":
        day = F.when(F.col(band).isNotNull(), F.col("dowy"))
        before = F.last(day, ignorenulls=True).over(by_time.rowsBetween(Window.unboundedPreceding, -1))
        latest = F.coalesce(day, before)
        return day - F.coalesce(before, start), F.when(last, end - F.coalesce(latest, start))
    raise ValueError(f"unknown gap mode {mode!r}")


def max_gap(obs: DataFrame, band: str = "vv", keys: Sequence[str] = SERIES, order: Sequence[str] = ORDER, mode: str = "literal") -> DataFrame:
    """Largest gap in days of each series, the edges of the search window included.

    literal: between neighbouring blanked acquisitions (or an edge and a blanked neighbour), missing where no blanked
    ones touch. documented: between neighbouring valid acquisitions (or an edge and one). Blanked rows must be there.
    """
    step, edge = _steps(band, keys, order, mode)
    return obs.withColumn("_gap", F.greatest(step, edge)).groupBy(*keys).agg(F.max("_gap").cast("double").alias("max_gap"))


def filter_orbits(
    obs: DataFrame, min_monthly: float = 1, max_days_gap: float = 30, bands: Sequence[str] = ("vv",), keys: Sequence[str] = SERIES,
    order: Sequence[str] = ORDER, mode: str = "literal",
) -> DataFrame:
    """Blanks the bands of series with too few values for the window's length, too long a gap, or no value at all.

    One sort of the series serves gaps and counts. A missing length or gap rejects the series.
    """
    out = obs
    for b in bands:
        step, edge = _steps(b, keys, order, mode)
        out = out.withColumn(f"_gap_{b}", F.greatest(step, edge))
    whole = Window.partitionBy(*keys)
    marks = {}
    for b in bands:
        count, gap = F.count(b).over(whole), F.max(f"_gap_{b}").over(whole)
        good = (count >= F.lit(float(min_monthly)) * F.col("search_window_length") / 30) & (gap <= max_days_gap) & (count > 0)
        marks[f"_good_{b}"] = F.coalesce(good, F.lit(False))
    out = out.withColumns(marks)
    return out.withColumns({b: masked(b, F.col(f"_good_{b}")) for b in bands}).drop(*[f"_gap_{b}" for b in bands], *marks)


def temporal_resolution(obs: DataFrame, band: str = "vv", keys: Sequence[str] = ("pixel", "water_year")) -> DataFrame:
    """Days of the search window per valid value, over all orbits; missing where there is none."""
    found = obs.groupBy(*keys).agg(F.count(band).alias("n"), F.max("search_window_length").alias("length"))
    return found.select(*keys, F.try_divide("length", F.nullif(F.col("n"), F.lit(0)).cast("double")).alias("temporal_resolution"))

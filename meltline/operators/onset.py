"""Melt onset: the time of least backscatter of each orbit, and its median over orbits and polarizations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_in, micros, of_micros

KEYS = ("pixel", "water_year")


def orbit_minima(obs: DataFrame, bands: Sequence[str] = ("vv", "vh"), keys: Sequence[str] = (*KEYS, "orbit")) -> DataFrame:
    """Time of the smallest value of each band in each orbit; of ties the earliest, null without values.

    All bands are reduced in one aggregate before they become rows, so the shuffle carries one partial row per series.
    """
    least = [F.min(F.when(F.col(b).isNotNull(), F.struct(F.col(b).alias("v"), F.col("time").alias("t")))).alias(b) for b in bands]
    found = obs.groupBy(*keys).agg(*least).select(*keys, *[F.col(f"{b}.t").alias(b) for b in bands])
    return found.unpivot(list(keys), list(bands), "polarization", "onset_time")


def median_time(minima: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Median of the times, skipping missing ones; of an even number the mean of the middle two."""
    return minima.groupBy(*keys).agg(of_micros(F.median(micros("onset_time"))).alias("onset_time"))


def melt_onset(
    obs: DataFrame, bands: Sequence[str] = ("vv", "vh"), hemisphere: str = "northern", returned: str = "dowy", constituents: bool = False,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """runoff_onset of each pixel and water year as day of water year (dowy), of year (doy) or time (datetime64).

    With constituents it is given for each orbit and polarization instead. Missing days are -9999, cut to whole days.
    """
    if returned not in ("dowy", "doy", "datetime64"):
        raise ValueError(f"unknown date format {returned!r}")
    found = orbit_minima(obs, bands, (*keys, "orbit"))
    if not constituents:
        found = median_time(found, keys)
    time = F.col("onset_time")
    value = {"dowy": day_in(time, F.col("water_year"), hemisphere), "doy": F.dayofyear(time), "datetime64": time}[returned]
    return found.withColumn("runoff_onset", value).drop("onset_time")

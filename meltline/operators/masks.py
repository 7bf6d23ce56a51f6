"""Search windows and masks. A mask blanks values and keeps rows; later operators rely on the blanked rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import masked

PIXEL = ("pixel",)
WINDOW = ("search_window_start_DOWY", "search_window_end_DOWY", "search_window_length", "binary_seasonal_snow_cover_presence")


def snow_window(phenology: DataFrame, extend: int = 16, min_consec: int = 56, last_day: int = 366) -> DataFrame:
    """Search window of each pixel and water year from SAD_DOWY, SDD_DOWY and max_consec_snow_days.

    It starts half the longest snow period after the snow appears, and ends extend days after it is gone, on last_day
    at the latest and also where that day is unknown. Snow is seasonal from min_consec days on.
    """
    start = F.col("SAD_DOWY") + F.col("max_consec_snow_days") / 2
    end = F.least(F.col("SDD_DOWY") + extend, F.lit(last_day))
    made = phenology.withColumns({WINDOW[0]: start.cast("double"), WINDOW[1]: end.cast("double")})
    made = made.withColumn(WINDOW[2], F.col(WINDOW[1]) - F.col(WINDOW[0]))
    made = made.withColumn(WINDOW[3], F.coalesce(F.col("max_consec_snow_days") >= min_consec, F.lit(False)))
    return made.drop("SAD_DOWY", "SDD_DOWY", "max_consec_snow_days")


def keep_years(obs: DataFrame, years: Sequence[int]) -> DataFrame:
    return obs.where(F.col("water_year").isin(list(years)))


def _blank(obs: DataFrame, bands: Sequence[str], keep: Column) -> DataFrame:
    return obs.withColumns({b: masked(b, keep) for b in bands})


def equator_mask(obs: DataFrame, centre_latitude: float, bands: Sequence[str] = ("vv", "vh"), near: float = 3.0) -> DataFrame:
    """Near the equator, blanks what lies in the other hemisphere than the centre."""
    if abs(centre_latitude) >= near:
        return obs
    return _blank(obs, bands, F.col("latitude") >= 0 if centre_latitude >= 0 else F.col("latitude") < 0)


def noise_mask(obs: DataFrame, bands: Sequence[str] = ("vv", "vh"), threshold: float = 0.001, until: str = "2018-03-14") -> DataFrame:
    """Keeps values above the threshold before a date, positive ones from then on."""
    floor = F.when(F.col("time") < F.lit(until).cast("timestamp_ntz"), F.lit(threshold)).otherwise(F.lit(0.0))
    return obs.withColumns({b: masked(b, F.col(b) > floor) for b in bands})


def seasonal_mask(obs: DataFrame, window: DataFrame, bands: Sequence[str] = ("vv", "vh"), keys: Sequence[str] = PIXEL) -> DataFrame:
    """Blanks values outside the pixel's search window of the water year and where snow isn't seasonal.

    An equi-join on pixel and year; a year without a window is blanked as a whole. Adds the window's columns.
    """
    joined = obs.join(window.select(*keys, "water_year", *WINDOW), [*keys, "water_year"], "left")
    inside = F.col("dowy").between(F.col(WINDOW[0]), F.col(WINDOW[1])) & F.col(WINDOW[3])
    return _blank(joined, bands, F.coalesce(inside, F.lit(False)))


def polygon_mask(obs: DataFrame, inside: DataFrame, bands: Sequence[str] = ("vv", "vh"), keys: Sequence[str] = PIXEL) -> DataFrame:
    """Blanks pixels that aren't among the keys of inside."""
    flagged = obs.join(inside.select(*keys).distinct().withColumn("_inside", F.lit(True)), list(keys), "left")
    return _blank(flagged, bands, F.col("_inside").isNotNull()).drop("_inside")


def all_masks(
    obs: DataFrame, window: DataFrame, years: Sequence[int], centre_latitude: float, inside: DataFrame | None = None,
    bands: Sequence[str] = ("vv", "vh"), keys: Sequence[str] = PIXEL,
) -> DataFrame:
    """Years, equator, polygons and search window, in this order."""
    steps = [lambda d: keep_years(d, years), lambda d: equator_mask(d, centre_latitude, bands)]
    steps += [lambda d: polygon_mask(d, inside, bands, keys)] if inside is not None else []
    steps += [lambda d: seasonal_mask(d, window, bands, keys)]
    return reduce(lambda d, f: f(d), steps, obs)

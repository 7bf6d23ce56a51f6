"""Water years, days of water year and times, as column expressions.

A northern water year starts on 1 October of the year before, a southern one on 1 April of the same year.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NODATA = -9999


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hemisphere(latitude: Column | str) -> Column:
    """northern from the equator on."""
    return F.when(_col(latitude) >= 0, "northern").when(_col(latitude) < 0, "southern")


def hemisphere_of_zone(epsg: Column | str) -> Column:
    """From the EPSG code of a UTM zone: below 32700 north."""
    return F.when(_col(epsg) < 32700, "northern").when(_col(epsg) >= 32700, "southern")


def _south(h: Column | str) -> Column:
    if isinstance(h, str) and h not in ("northern", "southern"):
        raise ValueError(f"unknown hemisphere {h!r}")
    return F.lit(h == "southern") if isinstance(h, str) else h == "southern"


def water_year(time: Column | str, hemi: Column | str = "northern") -> Column:
    t = _col(time)
    north = F.year(t) + (F.month(t) >= 10).cast("int")
    south = F.year(t) - (F.month(t) < 4).cast("int")
    return F.when(_south(hemi), south).otherwise(north) if not isinstance(hemi, str) else (south if hemi == "southern" else north)


def year_start(year: Column | str, hemi: Column | str = "northern") -> Column:
    """First day of a water year."""
    y = _col(year).cast("int")
    north, south = F.make_date(y - 1, F.lit(10), F.lit(1)), F.make_date(y, F.lit(4), F.lit(1))
    _south(hemi)
    return F.when(_south(hemi), south).otherwise(north) if not isinstance(hemi, str) else (south if hemi == "southern" else north)


def day_of_water_year(time: Column | str, hemi: Column | str = "northern") -> Column:
    """1 on the first day."""
    return F.date_diff(F.to_date(_col(time)), year_start(water_year(time, hemi), hemi)) + 1


def day_in(time: Column | str, year: Column | str, hemi: Column | str = "northern", fill: int | None = NODATA) -> Column:
    """Day of a given water year, cut to whole days; fill where there is no time."""
    day = (F.date_diff(F.to_date(_col(time)), year_start(year, hemi)) + 1).cast("smallint")
    return day if fill is None else F.coalesce(day, F.lit(fill).cast("smallint"))


def date_of(year: Column | str, day: Column | str, hemi: Column | str = "northern") -> Column:
    """Calendar date of a day of water year."""
    return F.date_add(year_start(year, hemi), (_col(day) - 1).cast("int"))


def micros(time: Column | str) -> Column:
    """Microseconds since 1970 of a zoneless time (in a UTC session)."""
    return F.unix_micros(_col(time).cast("timestamp"))


def of_micros(value: Column | str) -> Column:
    """The zoneless time of a (possibly fractional) number of microseconds, cut to whole ones."""
    return F.timestamp_micros(F.floor(_col(value)).cast("long")).cast("timestamp_ntz")


def unix_seconds(text: Column | str) -> Column:
    """Seconds since 1970 from text that holds either seconds or an ISO time; null for anything else."""
    t = _col(text)
    return F.coalesce(t.try_cast("double"), F.unix_micros(t.try_cast("timestamp")) / 1e6)

"""Codecs, rounding, classes and bins as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import NODATA, _col

INT16, INT32 = (-(1 << 15), (1 << 15) - 1), (-(1 << 31), (1 << 31) - 1)


def missing(c: Column | str) -> Column:
    """NaN as null; apply it where data come in."""
    return F.when(~F.isnan(_col(c)), _col(c))


def positive(c: Column | str) -> Column:
    """Values above 0, which also drops the fill value."""
    return F.when(_col(c) > 0, _col(c))


def masked(c: Column | str, condition: Column) -> Column:
    """The value where the condition holds, else null; the row stays."""
    return F.when(condition, _col(c))


def half_even(c: Column | str, digits: int = 0) -> Column:
    return F.bround(_col(c), digits)


def decode(raw: Column | str, scale: float = 1.0, offset: float = 0.0, fill: int = NODATA) -> Column:
    """Stored integers to values."""
    return F.when(_col(raw) != fill, _col(raw) * F.lit(scale) + F.lit(offset))


def encode(value: Column | str, scale: float = 1.0, offset: float = 0.0, fill: int = NODATA) -> Column:
    """Values to stored 16-bit integers, half to even; out of range and missing give the fill value."""
    return whole((missing(_col(value).cast("double")) - F.lit(offset)) / F.lit(scale), INT16, "smallint", fill)


def whole(value: Column | str, limits: tuple[int, int] = INT16, kind: str = "smallint", fill: int = NODATA) -> Column:
    """Rounded half to even and cast; missing, infinite and out-of-range values give the fill value."""
    x = F.rint(_col(value).cast("double"))
    return F.when(~F.isnan(x) & x.between(*limits), x).otherwise(F.lit(fill)).cast(kind)


def chili_class(c: Column | str, low: float = 0.448, high: float = 0.767) -> Column:
    """warm above high, cool below low, else (missing too) neutral."""
    return F.when(_col(c) > high, "warm").when(_col(c) < low, "cool").otherwise("neutral")


def decibel(c: Column | str) -> Column:
    return F.when(_col(c) > 0, 10 * F.log10(_col(c)))


def time_of_day(orbit_state: Column | str) -> Column:
    """ascending orbits pass in the evening, descending ones in the morning."""
    return F.when(_col(orbit_state) == "ascending", "evening").when(_col(orbit_state) == "descending", "morning")


def bin_left(c: Column | str, low: float, high: float, width: float) -> Column:
    """Left edge of the bin (left, left + width] that holds a value; null outside (low, high]."""
    x = _col(c).cast("double")
    left = F.lit(low) + (F.ceil((x - low) / width) - 1) * width
    return F.when((x > low) & (x <= high), left.cast("int"))


def bin_centre(left: Column | str, width: float) -> Column:
    return _col(left) + F.lit(width / 2)


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, null where b is 0 or missing."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))


def correlation(a: Column | str, b: Column | str) -> Column:
    """Pearson correlation of an aggregate over rows with both values; null where one of them doesn't vary."""
    both = _col(a).isNotNull() & _col(b).isNotNull()
    x, y = F.when(both, _col(a).cast("double")), F.when(both, _col(b).cast("double"))
    varies = (F.min(x) != F.max(x)) & (F.min(y) != F.max(y))
    return F.when(varies, F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))


def valid_percent(classes: Column | str, fractions: Column | str, valid: Sequence[int] = (1, 2, 3, 5, 6, 7)) -> Column:
    """Percent of a tile in valid classes, from parallel arrays of classes and fractions."""
    chosen = F.zip_with(_col(classes), _col(fractions), lambda k, f: F.when(k.isin(*valid), f).otherwise(F.lit(0.0)))
    return F.aggregate(chosen, F.lit(0.0), lambda a, x: a + x) * 100


def tile_name(row: Column | str, col: Column | str) -> Column:
    return F.format_string("tile_%03d_%03d.parquet", _col(row), _col(col))


def dims(text: Column | str) -> Column:
    """A printed dictionary of dimension sizes as a map."""
    return F.from_json(F.translate(_col(text), "'", '"'), "map<string,int>")


def config_version(path: Column | str) -> Column:
    """The version in a configuration's file name, with its v."""
    return F.nullif(F.regexp_extract(_col(path), r"global_config_(v[^./]+)", 1), F.lit(""))


def blank_to_null(c: Column | str) -> Column:
    """Text with empty, nan and none spellings as null."""
    t = F.trim(_col(c))
    return F.when(~F.lower(t).isin("", "nan", "none", "null"), t)

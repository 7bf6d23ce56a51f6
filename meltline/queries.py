"""The registered queries and their SQL equivalents."""

from __future__ import annotations

from .plans import catalogue, gridded, onset, products, series, stores
from .plans.registry import ORACLES, QUERIES, Query

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES", "Query", "catalogue", "gridded", "onset", "products", "series", "stores"]

#: Melt onset day of each pixel and water year.
FLAGSHIP: Query = QUERIES["onset_dowy"]

"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under a name, with SQL that gives the same rows."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def r6(c: Column | str) -> Column:
    """Rounded for comparison, with negative zero as zero."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), 6) + F.lit(0.0)


def rounded(df: DataFrame) -> DataFrame:
    """All doubles of a result rounded."""
    return df.withColumns({f.name: r6(F.col(f"`{f.name}`")) for f in df.schema.fields if f.dataType.simpleString() in ("double", "float")})

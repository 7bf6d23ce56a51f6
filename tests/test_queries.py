import pytest

duckdb = pytest.importorskip("duckdb")
from pathlib import Path  # noqa: E402

from meltline.plans.registry import ORACLES, QUERIES  # noqa: E402
from meltline import queries  # noqa: E402

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        c.sql(f"create view {f.stem} as select * from '{f}'")
    return c


def text(v):
    import math

    import pandas as pd

    if v is None or (isinstance(v, float) and math.isnan(v)) or v is pd.NaT or v is pd.NA:
        return "null"
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if isinstance(v, bool) or "bool" in str(type(v)):
        return str(bool(v))
    if isinstance(v, (int, float)) or hasattr(v, "item"):
        return f"{float(v) + 0.0:.5f}".replace("-0.00000", "0.00000")
    return str(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    a, b = QUERIES[name](spark, str(DATA)).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(a.columns) == sorted(b.columns)
    order = sorted(a.columns)
    rows = lambda d: sorted(tuple(map(text, r)) for r in d[order].astype(object).itertuples(index=False))
    assert rows(a) == rows(b)


def test_queries_without_sql_run(spark):
    assert queries.FLAGSHIP(spark, str(DATA)).count() > 0
    for name in sorted(set(QUERIES) - set(ORACLES)):
        QUERIES[name](spark, str(DATA)).collect()

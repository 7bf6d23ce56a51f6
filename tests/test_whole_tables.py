"""Queries whose registered SQL leaves out part of a table, against the same SQL without that bound."""

import duckdb
import pytest

from meltline.plans.registry import ORACLES, QUERIES

from .test_queries import DATA, pytestmark, text  # noqa: F401


def same(spark, name, cut, instead, sf="sf0.001"):
    """The query has the rows of its SQL with instead in place of cut, which may be gone already."""
    data, c = DATA.parent / sf, duckdb.connect()
    for f in data.glob("*.parquet"):
        c.sql(f"create view {f.stem} as select * from '{f}'")
    a, b = QUERIES[name](spark, str(data)).toPandas(), c.sql(ORACLES[name].replace(cut, instead)).df()
    rows = lambda d: sorted(tuple(map(text, r)) for r in d[sorted(b.columns)].astype(object).itertuples(index=False))
    assert rows(a) == rows(b)
    return len(b)


def test_boxes_with_all_points(spark):
    assert same(spark, "j10_boxes_with_points", "WHERE c_custkey % 10 = 0", "", "sf0.01") == 100


def test_template_reaches_the_last_row(spark):
    assert same(spark, "j05_resampled_bilinear", "range(0, 20)", "range(0, 27)", "sf0.01") == 27 * 34


def test_log_is_consolidated_whole(spark):
    assert same(spark, "u02_consolidated", "WHERE sequence % 3 <> 0", "") > 0


def test_masked_rows_of_all_years_stay(spark):
    assert same(spark, "j01_seasonal_mask", "WHERE water_year < 2000", "") == 6000


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if n == "j08_catalogue" or n.startswith("f07_")))
def test_catalogue_holds_every_tile_and_result(spark, name):
    cut, instead = '(SELECT * FROM tiles WHERE "row" <> 3) t FULL JOIN (SELECT * FROM last WHERE col <> 5) l', "tiles t FULL JOIN last l"
    assert same(spark, name, cut, instead) > 0


def test_results_without_a_sequence_are_consolidated(spark, tmp_path):
    c = duckdb.connect()
    c.execute(f"copy (select * from '{DATA}/customer.parquet') to '{tmp_path}/customer.parquet' (format parquet)")
    first = "row_number() OVER (PARTITION BY o_custkey % 50, o_custkey % 40, o_orderstatus ORDER BY o_orderkey) = 1"
    c.execute(f"copy (select * replace (CASE WHEN {first} THEN NULL ELSE o_orderkey END AS o_orderkey) from '{DATA}/orders.parquet') to '{tmp_path}/orders.parquet' (format parquet)")
    assert same(spark, "u02_consolidated", "WHERE sequence % 3 <> 0", "", str(tmp_path)) > 0

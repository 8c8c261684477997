"""Pair statistics and top neighbours of every fold, not only of the first."""
import duckdb
import pytest

import __spark_entry__ as E
from cinerank.sources.views import TABLES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["joi8_item_gram_candidates", "joi9_user_gram_candidates", "agg25_signed_overlap", "win1_top5_neighbours"])
def test_all_folds_match_oracle_and_hold_fold_1(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    got = E.queries()[f"{name}_folds"](spark, SF)
    rows = sorted(tuple(r) for r in got.collect())
    expected = con.execute(f"select {', '.join(got.columns)} from ({E.oracle_sql()[f'{name}_folds']})").fetchall()
    assert {r[0] for r in rows} == {1, 2, 3, 4, 5}
    assert rows == [pytest.approx(r, abs=2e-6) for r in sorted(expected)]
    first = con.execute(f"select {', '.join(got.columns[1:])} from ({E.oracle_sql()[name]})").fetchall()
    assert [r[1:] for r in rows if r[0] == 1] == [pytest.approx(r, abs=2e-6) for r in sorted(first)]
    assert E.queries()[name](spark, SF).count() == len(first)

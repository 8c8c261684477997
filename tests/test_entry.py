"""Driver contract and oracle parity on the smallest data set."""
import duckdb
import pytest

import __spark_entry__ as E
from cinerank.sources.views import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    rows = E.entry(spark).collect()
    assert [r.k for r in sorted(rows, key=lambda r: r.k)] == [2, 5, 10, 20]


def test_oracles_are_subset_of_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind == "f":
            df[c] = df[c].round(6)
        df[c] = df[c].astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", ["agg4_mean_by_genre", "agg10_active_users", "job2_item_item_pears_fold1",
                                  "job11_content_rmse", "agg17_knn_confusion", "sim10_tfidf_next_doc",
                                  "job25_per_user_holdout", "job8_like_dislike_fold1",
                                  "job6_item_item_tfidf_hybrid", "job13_knn_fold_mean",
                                  "src6_folksonomy_ragged", "job8_like_dislike_as_written"])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    a = _norm(E.queries()[name](spark, SF).toPandas())
    b = _norm(con.execute(E.oracle_sql()[name]).fetchdf())
    assert a.equals(b)

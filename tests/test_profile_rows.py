"""User profiles of all folds: one row for each user, whatever its ratings; scores as by one profile for each fold."""
import math

import pytest
from pyspark.sql import functions as F

from cinerank.operators import content as cb


@pytest.fixture
def tables(spark):
    ratings = [(u * i % 5 + 1, u, i, float(1 + (u * 7 + i * 3) % 9 / 2)) for u in (1, 2, 3) for i in range(1, 30) if (u + i) % u == 0]
    ratings += [(2, 4, 5, None), (None, 5, None, 2.0), (None, None, 5, 3.0), (1, 6, 77, 4.0)]
    weights = [(i, x, float(1 + x % 2)) for i in range(1, 30) for x in {i % 4 + 1, i % 7 + 10, 10 ** 10 + i % 3}]
    return (spark.createDataFrame(ratings, "fold int, user_id bigint, item_id bigint, score double"),
            spark.createDataFrame(weights, "item_id bigint, idx bigint, weight double"), ratings, weights)


def plain(ratings, weights, fold, user):
    seen = {}
    for f, u, i, s in ratings:
        if u == user and f is not None and f != fold:
            for j, x, _ in weights:
                if j == i:
                    seen.setdefault(x, []).append(s)
    return {x: sum(v for v in s if v is not None) / len(s) if any(v is not None for v in s) else None for x, s in seen.items()}


def test_a_user_is_one_row_and_its_weights_are_those_of_each_fold(spark, tables):
    folds, iprof, ratings, weights = tables
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # a user's ratings go over several batches
    try:
        rows = cb.user_profiles_by_fold(folds, iprof).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert sorted(r["user_id"] for r in rows) == [1, 2, 3, 4]
    for r in rows:
        for f in range(1, 6):
            found = {x: w for x, w in zip(r["idx"], r["w"][f - 1], strict=True) if w is not None}
            assert found == {x: w for x, w in plain(ratings, weights, f, r["user_id"]).items() if w is not None}


def test_scores_equal_those_of_one_profile_for_each_fold(spark, tables):
    folds, iprof, ratings, weights = tables
    found = {(r["user_id"], r["item_id"]): r["pred_raw"] for r in cb.content_scores_by_fold(
        folds, cb.user_profiles_by_fold(folds, iprof), iprof, chunk=4).select("user_id", "item_id", F.col("pred_raw")).collect()}
    assert len(found) == len(ratings)
    for f, u, i, _ in ratings:
        mine = {x: w for x, w in plain(ratings, weights, f, u).items() if w is not None} if f is not None else {}
        other = {x: w for j, x, w in weights if j == i}
        den = math.sqrt(sum(w * w for w in mine.values())) * math.sqrt(sum(w * w for w in other.values()))
        cos = sum(w * mine.get(x, 0.0) for x, w in other.items()) / den if den else 0.0
        assert found[u, i] == pytest.approx(cos, abs=1e-12)

"""Rows are dealt to blocks of targets as packed columns; fold-1 queries and registered measures use the same product."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinerank.operators import block_product as bp
from cinerank.operators import knn
from cinerank.operators import neighbours as nb
from cinerank.operators.similarity import BLOCK_FORMS, SIMILARITIES, register_similarity
from cinerank.plans import q_binary, q_cf

FOLDS = (1, 2, 3)


def ratings(spark, seed=3, users=40, items=30, density=0.4):
    rng = random.Random(seed)
    rows = [(rng.choice(FOLDS), u, i, rng.choice([0.5, 1.0, 2.5, 4.0, 5.0])) for u in range(users) for i in range(items) if rng.random() < density]
    return spark.createDataFrame(rows, "fold int, user_id bigint, item_id bigint, score double")


def block_rows(r):
    return r.select("fold", "user_id", "item_id", F.col("score").alias("v"), F.lit(0.25).alias("b"), F.lit(-0.5).alias("cp"))


def test_many_rows_travel_in_one_record(spark):
    r = block_rows(ratings(spark, users=200, items=100))
    n = r.count()
    dealt, tasks = bp.deal_blocks(r, "item_id", "user_id", FOLDS, target_rows=n // 4, neighbour_rows=n // 2)
    assert tasks >= 4
    records = dealt.collect()
    sent = [x for x in records if x.side == bp.NEIGHBOUR]
    assert n <= sum(x.n for x in sent) <= n * tasks
    assert len(records) < n  # one by one they were n rows for every block
    assert sum(len(x.cols) for x in sent) == 28 * sum(x.n for x in sent)


def test_packed_columns_come_back():
    rng = np.random.default_rng(1)
    cols = {"c": np.array([-5, 3, 3, 2**60]), "e": np.array([7, -1, 0, 2**62]), "v": np.array([0.5, np.nan, -1.0, 4.0]), "fold": np.array([1, 2, -1, 5], np.int32)}
    back = bp._unpacked(bp.NEIGHBOUR, 4, bp._packed(bp.NEIGHBOUR, cols))
    assert all(np.array_equal(back[k], x, equal_nan=k == "v") for k, x in cols.items())
    st = {"e": np.array([4, 9]), "st": rng.random((2, 6))}
    back = bp._unpacked(bp.STATS_N, 2, bp._packed(bp.STATS_N, st))
    assert np.array_equal(back["st"], st["st"]) and np.array_equal(back["e"], st["e"])


def test_blocks_of_neighbours_meet_in_the_targets_task(spark):
    r = block_rows(ratings(spark))
    key = lambda d: {(x.c, x.e): x for x in d.collect()}
    one = key(bp.best_neighbours(r, "item_id", "user_id", FOLDS, "jac", 3))
    many = bp.best_neighbours(r, "item_id", "user_id", FOLDS, "jac", 3, target_rows=100, neighbour_rows=30)
    plan = many._jdf.queryExecution().toString()
    assert "collect_list" not in plan  # the lists of best neighbours are not shuffled
    assert key(many) == one


def test_rows_without_a_key_or_fold_are_on_no_side(spark):
    r = ratings(spark, users=12, items=10)
    odd = spark.createDataFrame([(2, 4, None, 5.0), (None, 5, 3, 1.0), (None, None, 3, 1.0)], r.schema)
    want = {tuple(x) for x in bp.gram_entries(block_rows(r), "item_id", "user_id", FOLDS).collect()}
    assert {tuple(x) for x in bp.gram_entries(block_rows(r.unionByName(odd)), "item_id", "user_id", FOLDS).collect()} == want


@pytest.mark.parametrize("blocks", [{}, {"target_rows": 100, "neighbour_rows": 40, "heavy": 6, "limit": 60}])
@pytest.mark.parametrize("leaky", [False, True])
def test_like_dislike_of_one_fold(spark, leaky, blocks):
    labels = ratings(spark).select("fold", "user_id", "item_id", F.when(F.col("score") >= 3, 1).otherwise(-1).alias("label"))
    test = labels.where("fold = 1")
    train = (labels if leaky else labels.where("fold <> 1")).withColumn("fold", F.lit(1))
    for as_written in (False, True):
        want = {(x.user_id, x.item_id): x.pred for x in knn.like_dislike_scores(train, test, as_written=as_written).collect()}
        got = {(x.user_id, x.item_id): x.pred for x in knn.like_dislike_folds(labels, (1,), as_written, leaky=leaky, **blocks).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-9 for k in want)


def test_registered_measures_need_no_pairs(spark):
    r = ratings(spark)
    register_similarity("dice_pairs", q_cf.dice)
    register_similarity("dice_sums", q_cf.dice, (("co",), q_cf.dice_of_sums, True))
    try:
        preds = [{(x.fold, x.user_id, x.item_id, x.k): x.pred for x in nb.predict_folds(r, "item", kind, (1, 3), FOLDS).collect()} for kind in ("dice_pairs", "dice_sums")]
        assert preds[0].keys() == preds[1].keys() and all(abs(preds[0][k] - preds[1][k]) < 1e-6 for k in preds[0])
        assert "dice_pairs" not in BLOCK_FORMS
    finally:
        for kind in ("dice_pairs", "dice_sums"):
            SIMILARITIES.pop(kind)
            BLOCK_FORMS.pop(kind, None)
    labels = r.select("fold", "user_id", "item_id", F.when(F.col("score") >= 3, 1).otherwise(-1).alias("label"))
    value = (lambda dot, a, b: F.when(a + b == 0, F.lit(0.0)).otherwise((a + b - 2 * dot) / (a + b)), False)
    knn.DISTANCES["plain"], knn.DISTANCES["sums"] = value, (*value, (("dot",), q_binary.share_of_sums, False))
    try:
        a, b = (sorted(tuple(x) for x in knn.knn_classify_folds(labels, 4, d, FOLDS).select("fold", "user_id", "item_id", "label", "pred").collect()) for d in ("plain", "sums"))
        assert a == b
    finally:
        del knn.DISTANCES["plain"], knn.DISTANCES["sums"]


def test_a_handful_of_cells_filters_the_rows_first(spark):
    r = ratings(spark)
    train, cells = r.where("fold <> 1").withColumn("fold", F.lit(1)), r.where("fold = 1").orderBy("user_id", "item_id").limit(4)
    cells = spark.createDataFrame(cells.collect() + [(1, 999, 2, 3.0), (1, 3, 999, 3.0)], r.schema)
    for mode in ("item", "user"):
        for kind in ("pears", "jac"):
            def preds(d):
                return {(x.user_id, x.item_id, x.k): x.pred for x in d.collect()}
            want = preds(nb._predict_registered(train, cells, mode, kind, [2, 5], ["fold"], None, 0.5))
            got = preds(nb.predict(train, cells, mode, kind, (2, 5), requested_only=True))
            assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("blocks", [{}, {"target_rows": 100, "neighbour_rows": 40, "heavy": 6, "limit": 60}])
def test_rows_without_a_score_count_but_add_nothing(spark, blocks):
    r = ratings(spark).withColumn("score", F.when((F.col("user_id") + F.col("item_id")) % 7 != 0, F.col("score")))
    train, test = r.where("fold <> 1").withColumn("fold", F.lit(1)), r.where("fold = 1")
    for kind in ("pears", "cos", "jac"):
        def preds(d):
            return {(x.user_id, x.item_id, x.k): (x.score, x.pred) for x in d.collect()}
        want = preds(nb.predict(train, test, "item", kind, (3,)))
        got = preds(nb._predict_blocks(r, "item", kind, (3,), (1,), **blocks))
        assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-6 for k in want)

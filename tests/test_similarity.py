"""Pair similarity: hand-computed fixtures and the heavy/light equivalence."""
import math

from pyspark.sql import functions as F

from cinerank.operators.similarity import pair_stats, similarity


def _vals(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, user_id bigint, v double")


def _pairs(spark, rows):
    return spark.createDataFrame(rows, "a bigint, b bigint")


def test_zero_norm_gives_minus_one(spark):
    # item 1 rated 4,4,4 (centred norm 0), item 2 rated 3,5,4
    v = _vals(spark, [(1, 10, 4.0), (1, 11, 4.0), (1, 12, 4.0), (2, 10, 3.0), (2, 11, 5.0), (2, 12, 4.0)])
    s = similarity(v, _pairs(spark, [(1, 2)]), "pears", "item_id", "user_id").collect()[0]
    assert float(s.sim) == -1.0 and s.zero_norm


def test_cosine_hand_computed(spark):
    v = _vals(spark, [(1, 10, 1.0), (1, 11, 2.0), (2, 10, 3.0), (2, 12, 4.0)])
    s = similarity(v, _pairs(spark, [(1, 2)]), "cos", "item_id", "user_id").collect()[0]
    # dot over common user 10 = 3; norms over all entries: 5 and 25
    assert abs(float(s.sim) - 3 / math.sqrt(5 * 25)) < 1e-9


def test_no_common_raters_is_zero_not_dropped(spark):
    v = _vals(spark, [(1, 10, 1.0), (2, 11, 2.0)])
    s = similarity(v, _pairs(spark, [(1, 2)]), "cos", "item_id", "user_id").collect()
    assert len(s) == 1 and float(s[0].sim) == 0.0


def test_jaccard(spark):
    v = _vals(spark, [(1, 10, 1.0), (1, 11, 1.0), (1, 12, 1.0), (2, 11, 5.0), (2, 12, 5.0), (2, 13, 5.0)])
    s = similarity(v, _pairs(spark, [(1, 2)]), "jac", "item_id", "user_id").collect()[0]
    assert abs(float(s.sim) - 2 / 4) < 1e-9


def test_heavy_and_light_paths_agree(spark):
    rows = [(i, u, float((i * 7 + u * 3) % 9 + 1) / 2) for i in range(1, 9) for u in range(1, 13) if (i + u) % 3]
    v = _vals(spark, rows)
    pairs = _pairs(spark, [(a, b) for a in range(1, 9) for b in range(a + 1, 9)])
    light = {(r.a, r.b): (round(r.dot, 9), r.co) for r in
             pair_stats(v, pairs, "item_id", "user_id", "v", heavy_degree=10 ** 9).collect()}
    heavy = {(r.a, r.b): (round(r.dot, 9), r.co) for r in
             pair_stats(v, pairs, "item_id", "user_id", "v", heavy_degree=0).collect()}
    mixed = {(r.a, r.b): (round(r.dot, 9), r.co) for r in
             pair_stats(v, pairs, "item_id", "user_id", "v", heavy_degree=5).collect()}
    assert light == heavy == mixed and len(light) == 28


def test_item_item_on_transpose_equals_user_user(spark):
    rows = [(i, u, float((i * 5 + u) % 7 + 1)) for i in range(1, 6) for u in range(1, 7) if (i * u) % 4]
    v = _vals(spark, rows)
    t = v.select(F.col("user_id").alias("item_id"), F.col("item_id").alias("user_id"), "v")
    pairs = _pairs(spark, [(a, b) for a in range(1, 7) for b in range(a + 1, 7)])
    uu = {(r.a, r.b): r.sim for r in similarity(v, pairs, "cos", "user_id", "item_id").collect()}
    ii = {(r.a, r.b): r.sim for r in similarity(t, pairs, "cos", "item_id", "user_id").collect()}
    assert uu == ii

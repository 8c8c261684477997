"""Invariants of the random and ordered splits."""
from pyspark.sql import functions as F

from cinerank.operators import split as sp
from cinerank.operators.ranking import global_rank

SF = "/root/testdata/sf0.001"


def _ratings(spark):
    from cinerank.sources import views
    return views.ratings(spark, SF)


def test_balanced_folds_sizes_disjoint_complete(spark):
    r = _ratings(spark)
    f = sp.balanced_folds(r, k=5)
    sizes = [x.n for x in f.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1 and sum(sizes) == r.count()
    assert f.select("user_id", "item_id").distinct().count() == r.count()


def test_user_sample_keeps_whole_users(spark):
    r = _ratings(spark)
    s = sp.user_sample(r, 0.3)
    per_user = r.groupBy("user_id").count().join(s.groupBy("user_id").count().withColumnRenamed("count", "c2"),
                                                 "user_id")
    assert per_user.where(F.col("count") != F.col("c2")).count() == 0 and per_user.count() > 0


def test_global_rank_matches_row_number(spark):
    df = spark.range(0, 1000).withColumn("k", (F.col("id") * 7919) % 1000)
    g = global_rank(df, ["k"], "idx", num_partitions=7)
    got = sorted((r.k, r.idx) for r in g.collect())
    assert got == [(k, k + 1) for k in range(1000)]


def test_per_user_holdout_first_positions(spark):
    r = _ratings(spark)
    h = sp.per_user_holdout(r, 1, 2)
    per_user = h.where(F.col("split") == "test").groupBy("user_id").count()
    assert per_user.where(F.col("count") > 2).count() == 0

"""The blocks of ALS follow the ratings, not the cluster."""
from pyspark import SparkContext

from cinerank.operators import factor as fa


def test_blocks_follow_the_ratings(spark, monkeypatch):
    r = spark.createDataFrame([(u, i, float(1 + (u * i) % 5)) for u in range(20) for i in range(12) if (u + i) % 3], "user_id bigint, item_id bigint, score double")
    monkeypatch.setattr(SparkContext, "defaultParallelism", property(lambda _: 9))
    model = fa.als_model(r, rank=2, max_iter=1)
    assert model.userFactors.rdd.getNumPartitions() == fa.als_blocks(r.count()) == 4
    assert fa.als_blocks(200_000_000) == 4 and fa.als_blocks(10 ** 9) == 20

"""Profiles of users from packed item features equal the plain join, and no row for a rating and a feature is shuffled."""
import random

import pytest
from pyspark.sql import functions as F

from cinerank.operators import content as cb
from cinerank.plans import q_content


@pytest.mark.parametrize("variant", ["A", "B"])
@pytest.mark.parametrize("part", [[], ["fold"]])
def test_packed_profiles_equal_the_join(spark, variant, part):
    rng = random.Random(7)
    scores = [0.5, 1.0, 2.5, 4.0, None]
    rows = [(rng.choice([1, 2, None]), rng.choice([None, *range(9)]), rng.choice([None, *range(12)]), rng.choice(scores)) for _ in range(300)]
    rows += [(1, 99, 3, None), (1, 98, None, 2.0), (1, 97, 77, 2.0)]  # no score; no item; an item without features
    ratings = spark.createDataFrame(rows + rows[:40], "fold int, user_id bigint, item_id bigint, score double")
    feats = [(rng.choice([None, *range(12)]), rng.choice([None, *range(20)]), 1.0) for _ in range(90)]
    prof = spark.createDataFrame(feats, "item_id bigint, idx bigint, weight double")
    show = lambda d: sorted((tuple(x) for x in d.collect()), key=str)
    want = cb._user_profiles_by_join(ratings, prof, variant, part)
    got = cb.user_profiles(ratings, prof, variant, part)
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert show(got) == show(want)


def test_a_user_over_many_batches(spark):
    ratings = spark.range(25_000).select((F.col("id") % 2).alias("user_id"), (F.col("id") % 50).alias("item_id"), F.lit(1.5).alias("score"))
    prof = spark.range(50).select(F.col("id").alias("item_id"), (F.col("id") % 3).alias("idx"), F.lit(1.0).alias("weight"))
    for variant in "AB":
        got = {(x.user_id, x.idx): x.weight for x in cb.user_profiles(ratings, prof, variant).collect()}
        want = {(x.user_id, x.idx): x.weight for x in cb._user_profiles_by_join(ratings, prof, variant, []).collect()}
        assert got == want and len(got) == 6


def test_no_row_for_a_rating_and_a_feature(spark):
    ratings = spark.range(2000).select((F.col("id") % 40).alias("user_id"), (F.col("id") % 50).alias("item_id"), F.lit(1.5).alias("score"))
    prof = spark.range(1500).select((F.col("id") % 50).alias("item_id"), F.col("id").alias("idx"), F.lit(1.0).alias("weight"))
    plan = cb._user_profiles_packed(ratings, prof, "A", ["user_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [user_id" not in plan and "MapInArrow" in plan


def test_a_bucket_of_profiles_fits_a_task():
    """A user of 40 ratings has about 930 features at sf0.1, each with an index and five weights."""
    for ratings in (600_000, 36_000_000, 216_000_000):
        users = ratings / q_content.profile_buckets(ratings) / 40
        assert users * 930 * 6 * 8 < 100e6
    assert q_content.profile_buckets(0) == 16

"""Neighbourhood prediction fixtures (FIXTURES.md part C)."""
import pytest

from cinerank.operators import neighbours as nb
from cinerank.operators.neighbours import predict

from conftest import ratings_df


def _preds(spark, train, test, **kw):
    out = predict(ratings_df(spark, train), ratings_df(spark, test), **kw).collect()
    return {(r.user_id, r.item_id, r.k): r.pred for r in out}


def test_cold_item_uses_zero_mean_then_clamps(spark):
    train = [(1, 1, 10, 1.0), (1, 1, 11, 1.0), (1, 2, 10, 1.0)]
    test = [(1, 1, 99, 3.0)]  # item 99 never rated in train -> item mean 0.0
    p = _preds(spark, train, test, ks=(2,))
    # b = user mean 1 + 0.0 - mu 1 = 0 -> neighbours: sims -1 (zero norm of cold item) -> den -2
    assert 1.0 <= p[(1, 99, 2)] <= 5.0


def test_tie_break_prefers_lower_id(spark):
    from pyspark.sql import functions as F
    from cinerank.operators.similarity import SIMILARITIES, register_similarity

    def equal(values, pairs, entity, context, part=()):
        return pairs.select(*part, "a", "b", F.lit(0.5).cast("decimal(18,9)").alias("sim"),
                            F.lit(False).alias("zero_norm"))
    register_similarity("equal", equal)
    try:
        # user 1 rated neighbours 21 (score 1) and 20 (score 5); both tie at 0.5
        train = [(1, 1, 21, 1.0), (1, 1, 20, 5.0), (1, 2, 10, 3.0), (1, 2, 20, 3.0), (1, 2, 21, 3.0)]
        test = [(1, 1, 10, 3.0)]
        p = _preds(spark, train, test, kind="equal", ks=(1,))
        mu = sum(r[3] for r in train) / len(train)
        u1 = 3.0
        i10, i20 = 3.0, 4.0
        b = u1 + i10 - mu
        expected = b + (5.0 - (u1 + i20 - mu))  # neighbour 20 (lower id) wins the tie
        assert abs(p[(1, 10, 1)] - min(max(expected, 1.0), 5.0)) < 1e-9
    finally:
        SIMILARITIES.pop("equal")


def test_signed_denominator_zero_gives_baseline(spark):
    from pyspark.sql import functions as F
    from cinerank.operators import neighbours as nb
    from cinerank.operators.similarity import SIMILARITIES, register_similarity

    def fixed(values, pairs, entity, context, part=()):
        # +0.5 for pair (10, 20), -0.5 for (10, 30)
        return pairs.select(*part, "a", "b",
                            F.when(F.col("b") == 20, 0.5).otherwise(-0.5).cast("decimal(18,9)").alias("sim"),
                            F.lit(False).alias("zero_norm"))
    register_similarity("fixed", fixed)
    try:
        train = [(1, 1, 20, 5.0), (1, 1, 30, 1.0), (1, 2, 10, 3.0)]
        test = [(1, 1, 10, 2.0)]
        out = nb.predict(ratings_df(spark, train), ratings_df(spark, test), kind="fixed", ks=(2,)).collect()[0]
        mu = (5 + 1 + 3) / 3
        b = 3.0 + 3.0 - mu  # user 1 mean 3, item 10 mean 3
        assert abs(out.pred - min(max(b, 1.0), 5.0)) < 1e-9
    finally:
        SIMILARITIES.pop("fixed")


def test_user_user_uses_absolute_denominator(spark):
    train = [(1, 2, 10, 5.0), (1, 2, 11, 1.0), (1, 1, 11, 1.0), (1, 3, 10, 2.0), (1, 3, 11, 5.0), (1, 1, 12, 5.0)]
    test = [(1, 1, 10, 4.0)]
    p = _preds(spark, train, test, mode="user", kind="cos", ks=(5,))
    assert 1.0 <= p[(1, 10, 5)] <= 5.0


@pytest.mark.parametrize("kind", ["cos", "pears", "jac"])
@pytest.mark.parametrize("mode", ["item", "user"])
def test_predict_folds_equals_fold_sides(spark, mode, kind):
    """One join for all folds gives what a train side per fold gives; user 0 is a hot context."""
    from pyspark.sql import functions as F
    cells = {(u, i) for u in range(8) for i in range(12) if u == 0 or (u * 7 + i * 5) % 3 == 0}
    rows = [((u * 3 + i) % 3 + 1, u, i, float((u * i + u + 2 * i) % 5 + 1)) for u, i in sorted(cells)]
    folds = spark.createDataFrame(rows, "fold int, user_id bigint, item_id bigint, score double")
    train, test = nb.fold_sides(folds, n_folds=3)
    cols = ["fold", "user_id", "item_id", "k", F.round("pred", 6).alias("pred")]
    old = nb.predict(train, test, mode=mode, kind=kind, ks=(2, 5), heavy_degree=4).select(*cols).collect()
    new = nb.predict_folds(folds, mode=mode, kind=kind, ks=(2, 5), folds=(1, 2, 3)).select(*cols).collect()
    assert sorted(old) == sorted(new)
    one = nb.predict_folds(folds, mode=mode, kind=kind, ks=(2, 5), folds=(2,)).select(*cols).collect()
    assert sorted(one) == sorted(r for r in old if r.fold == 2)


def test_unknown_similarity_raises(spark):
    t = spark.createDataFrame([(1, 1, 1, 3.0)], "fold int, user_id bigint, item_id bigint, score double")
    with pytest.raises(ValueError):
        nb.predict_folds(t, kind="nope")

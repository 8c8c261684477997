"""Factorisation invariants."""
import math

import numpy as np
from pyspark.sql import functions as F

from cinerank.operators import factor as fa
from cinerank.operators.evaluate import error_metrics


def _ratings(spark):
    from cinerank.sources import views
    return views.ratings(spark, "/root/testdata/sf0.001").select("user_id", "item_id", "score")


def test_svd_full_rank_reproduces_input(spark):
    cells = [(u, i, float((u * 3 + i * 5) % 9 + 1) / 2) for u in range(1, 5) for i in range(1, 4)]
    r = spark.createDataFrame(cells, "user_id bigint, item_id bigint, score double")
    us, v, sigma = fa.truncated_svd(r, k=3, iters=4)
    p = fa.svd_predict(r, us, v, bound=False).collect()
    assert max(abs(x.pred - x.score) for x in p) < 1e-6
    m = np.array([c[2] for c in cells]).reshape(4, 3)
    assert np.allclose(sigma[0], np.linalg.svd(m, compute_uv=False))
    assert all(abs(sum(c * c for c in x.m[0]) - 1) < 1e-9 for x in fa.unit_rows(us).collect())


def test_svd_of_every_fold_is_that_of_its_training_rows(spark):
    rng = np.random.default_rng(3)
    cells = [(u, i, float(rng.integers(1, 11)) / 2, int(rng.integers(1, 4))) for u in range(12) for i in range(7)]
    folds = spark.createDataFrame(cells, "user_id bigint, item_id bigint, score double, fold int")
    x, off = fa.centred_by_fold(folds, 3)
    us, v, sigma = fa.truncated_svd(x, k=7, iters=2)
    got = {(r.fold, r.user_id, r.item_id): r.pred for r in
           fa.svd_predict(folds, us, v, off, group=F.col("fold") - 1, bound=False).collect()}
    for f in (1, 2, 3):
        m = np.zeros((12, 7))
        mean = {i: np.mean([s for _, j, s, g in cells if j == i and g != f]) for i in range(7)}
        for u, i, s, g in cells:
            if g != f:
                m[u, i] = s - mean[i]
        assert np.allclose(sigma[f - 1], np.linalg.svd(m, compute_uv=False))
        for u, i, s, g in cells:
            if g == f:  # full rank: a test cell of the matrix is 0, so the mean comes back
                assert abs(got[(f, u, i)] - mean[i]) < 1e-6


def test_svd_below_full_rank_is_the_truncated_one(spark):
    """Noise: the singular values about the cut lie close together, so a few plain steps don't find the subspace."""
    rng = np.random.default_rng(11)
    cells = [(u, i, float(rng.integers(1, 11)) / 2, int(rng.integers(1, 3))) for u in range(90) for i in range(70) if rng.random() < 0.3]
    folds = spark.createDataFrame(cells, "user_id bigint, item_id bigint, score double, fold int")
    x, off = fa.centred_by_fold(folds, 2)
    us, v, sigma = fa.truncated_svd(x, k=5)
    got = {(r.fold, r.user_id, r.item_id): r.pred for r in
           fa.svd_predict(folds, us, v, group=F.col("fold") - 1, bound=False).collect()}
    mean = [{r.item_id: r.off[f] for r in off.collect()} for f in (0, 1)]
    for f in (1, 2):
        m = np.zeros((90, 70))
        for u, i, s, g in cells:
            if g != f:
                m[u, i] = s - mean[f - 1][i]
        a, b, c = np.linalg.svd(m)
        assert b[4] / b[5] < 1.1
        assert np.allclose(sigma[f - 1], b[:5], rtol=1e-6)
        best = a[:, :5] * b[:5] @ c[:5]
        assert max(abs(best[u, i] - got[(g, u, i)]) for u, i, _, g in cells if g == f) < 1e-3


def test_svd_min_values_leaves_out_thin_rows(spark):
    r = spark.createDataFrame([(1, 1, 2.0), (1, 2, 3.0), (2, 1, 4.0), (2, 2, 1.0), (3, 1, 5.0)],
                              "user_id bigint, item_id bigint, score double")
    us, _, _ = fa.truncated_svd(r, k=2, iters=1, min_values=2)
    assert sorted(x.user_id for x in us.collect()) == [1, 2]


def test_als_train_error_falls_and_beats_mean(spark):
    r = _ratings(spark)
    mu = r.agg(F.avg("score")).first()[0]
    base = math.sqrt(r.select(F.avg((F.col("score") - mu) ** 2)).first()[0])
    rm = []
    for it in (1, 5):
        uf, itf = fa.als_factors(fa.als_model(r, max_iter=it))
        s = fa.score_cells(r, uf, itf, bound=False).withColumn("g", F.lit(1))
        rm.append(error_metrics(s, ("g",)).first().rmse)
    assert rm[1] < rm[0] and rm[1] < base


def test_block_sgd_equals_one_rating_at_a_time(spark):
    """With one block the update order is that of the hash; with three, sub-epochs do (b, b + s) for s = 0, 1, 2."""
    rng = np.random.default_rng(5)
    cells = {(int(rng.integers(0, 9)), int(rng.integers(0, 6))): float(rng.integers(1, 11)) / 2 for _ in range(40)}
    r = spark.createDataFrame([(u, i, s) for (u, i), s in cells.items()], "user_id bigint, item_id bigint, score double")
    for blocks in (1, 3):
        seed, k = 42, 4
        start = fa._init_factors(r.select("user_id").distinct(), "user_id", k, seed, 1).collect()
        p = {x.id: np.array(x.vec) for x in start}
        q = {x.id: np.array(x.vec) for x in fa._init_factors(r.select("item_id").distinct(), "item_id", k, seed, 2).collect()}
        h = r.select("*", F.expr(f"pmod(xxhash64({seed}, user_id), {blocks})").alias("ub"),
                     F.expr(f"pmod(xxhash64({seed + 1}, item_id), {blocks})").alias("ib"),
                     F.xxhash64(F.lit(seed + 2), "user_id", "item_id").alias("o")).collect()
        for _ in range(2):
            for x in sorted(h, key=lambda x: ((x.ib - x.ub) % blocks, x.ub, x.o)):
                e = x.score - p[x.user_id] @ q[x.item_id]
                p[x.user_id] = p[x.user_id] + 0.01 * (e * q[x.item_id] - 0.1 * p[x.user_id])
                q[x.item_id] = q[x.item_id] + 0.01 * (e * p[x.user_id] - 0.1 * q[x.item_id])
        gp, gq = fa.epoch_factors(fa.sgd_factors(r, blocks, rank=k, epochs=2, seed=seed, cut_every=2), 2)
        assert all(np.allclose(p[x.user_id], x.p) for x in gp.collect()) and gp.count() == len(p)
        assert all(np.allclose(q[x.item_id], x.q) for x in gq.collect()) and gq.count() == len(q)


def test_als_keeps_ids_beyond_int_range(spark):
    r = _ratings(spark)
    big = r.select((F.col("user_id") + F.lit(10 ** 12)).alias("user_id"), "item_id", "score")
    uf, itf = fa.als_factors(fa.als_model(big, max_iter=2))
    assert uf.agg(F.min("user_id")).first()[0] >= 10 ** 12
    assert uf.count() == r.select("user_id").distinct().count()


def test_sgd_splits_a_hot_user_and_does_not_follow_the_cores(spark):
    rng = np.random.default_rng(8)
    cells = {(0, i): 3.0 for i in range(60)} | {(int(rng.integers(1, 40)), int(rng.integers(0, 60))): float(rng.integers(1, 11)) / 2 for _ in range(150)}
    rows = [(u, i, s) for (u, i), s in sorted(cells.items())]
    r = spark.createDataFrame(rows, "user_id bigint, item_id bigint, score double")
    ids = fa._parts(r, "user_id", 20, 4, 42).collect()
    assert sorted(x.part for x in ids if x.user_id == 0) == [0, 1, 2] and all(x.parts == 1 for x in ids if x.user_id)
    got = []
    for parts in (1, 7):  # another number of tasks, the same grid
        f = fa.sgd_factors(r.repartition(parts), 4, rank=3, epochs=2, most=20)
        assert f.groupBy("epoch", "kind", "id").count().where("count > 1").count() == 0
        got.append({(x.epoch, x.kind, x.id): x.vec for x in f.collect()})
    assert got[0].keys() == got[1].keys() and all(np.allclose(got[0][k], got[1][k]) for k in got[0])
    assert fa.sgd_grid(480_000) == fa.sgd_grid(480_000) == 2 and fa.sgd_grid(10 ** 9) == 64


def test_saved_factor_model(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel

    from cinerank.operators.factor_model import FactorEstimator, FactorModel
    r = _ratings(spark)
    est = FactorEstimator(rank=3, maxIter=2, bounded=False)
    est.write().save(f"file://{tmp_path}/est")
    again = FactorEstimator.load(f"file://{tmp_path}/est")
    assert again.getOrDefault("rank") == 3 and again.getMaxIter() == 2 and again.getOrDefault("bounded") is False
    model = again.fit(r)
    model.set(model.fallback, 2.5)
    model.write().overwrite().save(f"file://{tmp_path}/model")
    loaded = FactorModel.load(f"file://{tmp_path}/model")
    cells = r.select("user_id", "item_id").unionByName(spark.createDataFrame([(-5, -6)], "user_id bigint, item_id bigint"))
    a, b = ({(x.user_id, x.item_id): x.pred for x in m.transform(cells).collect()} for m in (model, loaded))
    assert a == b and b[-5, -6] == 2.5 and loaded.uid == model.uid
    fitted = Pipeline(stages=[est]).fit(r)
    fitted.write().save(f"file://{tmp_path}/pipe")
    assert PipelineModel.load(f"file://{tmp_path}/pipe").transform(r).count() == r.count()


def test_svd_leaves_only_its_result(spark):
    import os

    from cinerank.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).removeprefix("file:") + "/tables"
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    us, v, _ = fa.truncated_svd(_ratings(spark), k=2)
    left = {n.rsplit("-", 1)[0] for n in set(os.listdir(base)) - before}
    assert left <= {"svd_us", "svd_v", "svd_items"} and us.count() and v.count()

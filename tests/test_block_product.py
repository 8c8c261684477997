"""The block-sparse product against plain loops: hot contexts, several blocks, strips and dense products."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinerank.operators import block_product as bp
from cinerank.operators import content as cb
from cinerank.operators import neighbours as nb
from cinerank.operators import text as tx

FOLDS = (1, 2, 3)


def rows_of(seed, users=40, items=30, density=0.3, hot=True):
    rng = random.Random(seed)
    cells = {(u, i) for u in range(users) for i in range(items) if rng.random() < density}
    if hot:
        cells |= {(0, i) for i in range(items)} | {(u, 0) for u in range(users)}
    return [(rng.choice(FOLDS), u, i, rng.choice([0.5, 1.0, 2.5, 4.0, 5.0])) for u, i in sorted(cells)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0.0, 0.0) for r in rows], "fold int, user_id bigint, item_id bigint, v double, b double, cp double")


def vectors(rows, fold, entity):
    out = {}
    for f, u, i, v in rows:
        if f != fold:
            e, c = (i, u) if entity == "item_id" else (u, i)
            out.setdefault(e, {})[c] = v
    return out


def half_up(x):
    return int(math.copysign(math.floor(abs(x) * 1e9 + 0.5), x)) if x else 0


def measure_plain(name, a, b):
    common = a.keys() & b.keys()
    if name == "jac":
        return half_up(len(common) / (len(a) + len(b) - len(common))) if a or b else 0
    if name == "signed":
        return half_up(sum(a[c] * b[c] for c in common) / (len(a) + len(b) - len(common))) if a or b else 0
    ma = sum(a.values()) / len(a) if a and name == "pears" else 0.0
    mb = sum(b.values()) / len(b) if b and name == "pears" else 0.0
    qa, qb = sum((x - ma) ** 2 for x in a.values()), sum((x - mb) ** 2 for x in b.values())
    if name == "euc_distance":
        return half_up(math.sqrt(max(0.0, qa + qb - 2 * sum(a[c] * b[c] for c in common))))
    if qa <= 1e-12 or qb <= 1e-12:
        return -bp.NANO
    x = sum((a[c] - ma) * (b[c] - mb) for c in common) / math.sqrt(qa * qb)
    return half_up(1 - x if name == "cos_distance" else x)


@pytest.mark.parametrize(("name", "entity", "heavy", "limit", "blocks"), [
    ("cos", "item_id", 512, 1_000_000, {}), ("cos", "item_id", 5, 50, {"target_rows": 60, "neighbour_rows": 150}), ("pears", "user_id", 512, 40, {"target_rows": 90}),
    ("pears", "item_id", 8, 1000, {"neighbour_rows": 100}), ("jac", "user_id", 1, 10, {}), ("cos_distance", "item_id", 12, 100, {}), ("euc_distance", "user_id", 512, 100, {"target_rows": 50})])
def test_best_neighbours_brute(spark, name, entity, heavy, limit, blocks):
    rows = rows_of(heavy + limit)
    context = "user_id" if entity == "item_id" else "item_id"
    got = {(r.c, r.e): r for r in bp.best_neighbours(frame(spark, rows), entity, context, FOLDS, name, 4, "value", heavy, limit, **blocks).collect()}
    assert len(got) == len(rows)
    sign = -1 if bp.MEASURES[name][2] else 1
    for f in FOLDS:
        vec = vectors(rows, f, entity)
        for fold, u, i, v in rows:
            if fold != f:
                continue
            e, c = (i, u) if entity == "item_id" else (u, i)
            cand = [(n, vec[n][c]) for n in vec if n != e and c in vec[n]]
            expected = sorted((sign * measure_plain(name, vec.get(e, {}), vec[n]), n, d) for n, d in cand)[:4]
            top = [tuple(x) for x in got[c, e].top]
            assert len(top) == len(expected) and got[c, e].fold == f and got[c, e].v == v
            for a, b in zip(top, expected):  # sums in another order may differ in the last of nine places
                assert abs(a[0] - b[0]) <= 1 and (a[1:] == b[1:] or abs(a[0] - b[0]) == 1 or any(abs(a[0] - x[0]) <= 1 and x[1] == a[1] for x in expected))


@pytest.mark.parametrize(("heavy", "limit", "blocks"), [(512, 1_000_000, {}), (3, 40, {"target_rows": 80, "neighbour_rows": 120})])
def test_totals_and_gram_brute(spark, heavy, limit, blocks):
    rows = rows_of(7)
    got = {(r.c, r.e): (r.n, r.total) for r in bp.neighbour_totals(frame(spark, rows), "user_id", "item_id", FOLDS, "signed", heavy, limit, **blocks).collect()}
    gram = {(r.fold, r.a, r.b): (r.dot, r.co, r.n_a, r.n_b, r.sq_a, r.sq_b) for r in bp.gram_entries(frame(spark, rows), "user_id", "item_id", FOLDS, heavy, limit, **blocks).collect()}
    asked = {}
    for f in FOLDS:
        vec = vectors(rows, f, "user_id")
        for fold, u, i, _ in rows:
            if fold != f:
                continue
            others = [n for n in vec if n != u and i in vec[n]]
            total = sum(measure_plain("signed", vec.get(u, {}), vec[n]) * vec[n][i] for n in others) / bp.NANO
            assert got[i, u][0] == len(others) and got[i, u][1] == pytest.approx(total)
            for n in others:
                a, b = vec.get(min(u, n), {}), vec.get(max(u, n), {})
                common = a.keys() & b.keys()
                asked[f, min(u, n), max(u, n)] = (sum(a[c] * b[c] for c in common), len(common), len(a), len(b), sum(x * x for x in a.values()), sum(x * x for x in b.values()))
    assert gram.keys() == asked.keys()
    assert all(gram[k] == pytest.approx(asked[k]) for k in asked)


def test_blocks_give_the_same_predictions_as_the_candidate_join(spark):
    rows = rows_of(11, 60, 50, 0.2)
    r = spark.createDataFrame(rows, "fold int, user_id bigint, item_id bigint, score double")
    for mode in ("item", "user"):
        for kind in ("cos", "pears", "jac"):
            train = r.select(F.explode(F.filter(F.array(*[F.lit(f) for f in FOLDS]), lambda f: f != F.col("fold"))).alias("fold"), "user_id", "item_id", "score")
            old = {(x.fold, x.user_id, x.item_id, x.k): x.pred for x in nb.predict(train, r, mode, kind, ks=(1, 3)).collect()}
            for blocks in ({}, {"target_rows": 100, "neighbour_rows": 200, "heavy": 6, "limit": 200}):
                new = {(x.fold, x.user_id, x.item_id, x.k): x.pred for x in nb._predict_blocks(r, mode, kind, (1, 3), FOLDS, **blocks).collect()}
                assert new.keys() == old.keys() and sum(abs(new[k] - old[k]) > 1e-6 for k in old) <= 0.01 * len(old)


def test_profiles_blend_in_the_blocks_as_by_pairs(spark):
    """A feature that all have, entities without a profile, and profiles of entities without ratings."""
    rng = random.Random(3)
    rows = rows_of(11, 40, 30, 0.25)
    r = spark.createDataFrame(rows, "fold int, user_id bigint, item_id bigint, score double")
    for mode, entity in (("item", "item_id"), ("user", "user_id")):
        named = [(e, f, rng.choice([0.5, 1.0, 2.0])) for e in range(50) if e % 7 for f in ["all", *rng.sample("abcdefghij", 3)]]
        numbers = spark.createDataFrame([(e, ord(f[0]), w) for e, f, w in named if f != "all"] + [(e, 7, w) for e, f, w in named if f == "all"], f"{entity} bigint, idx int, weight double")
        by_name = spark.createDataFrame(named, "doc bigint, term string, weight double")
        dots = bp.Profiles(by_name, "doc", "term", "weight", "dot", lambda pairs, w=by_name: tx.tfidf_similarity(w, pairs))
        for kind, content in (("cos", dots), ("pears", cb.profile_similarity(numbers, entity, "cos")), ("jac", cb.profile_similarity(numbers, entity, "jac"))):
            old = {(x.fold, x.user_id, x.item_id, x.k): x.pred for x in nb.predict_folds(r, mode, kind, (1, 3), FOLDS, content.pairs, 0.3).collect()}
            for blocks in ({}, {"target_rows": 100, "neighbour_rows": 200, "heavy": 6, "limit": 50}):
                new = {(x.fold, x.user_id, x.item_id, x.k): x.pred for x in nb._predict_blocks(r, mode, kind, (1, 3), FOLDS, profiles=content, p=0.3, **blocks).collect()}
                assert new.keys() == old.keys() and sum(abs(new[k] - old[k]) > 1e-6 for k in old) <= 0.01 * len(old)


def test_distances_do_not_blend(spark):
    d = frame(spark, [(1, 1, 1, 2.0)])
    prof = cb.profile_similarity(spark.createDataFrame([(1, 1, 1.0)], "item_id bigint, idx int, weight double"), "item_id")
    with pytest.raises(ValueError):
        bp.best_neighbours(d, "item_id", "user_id", FOLDS, "euc_distance", 3, profiles=prof)


def test_a_hot_context_makes_far_fewer_rows_than_its_square(spark):
    """One user with 4,000 items, one of every three rows: rows that travel, and neighbours looked at, stay far below 4,000 squared."""
    rng = random.Random(5)
    m = 4000
    rows = [(rng.choice(FOLDS), 0, i, rng.choice([1.0, 3.0, 5.0])) for i in range(m)]
    rows += [(rng.choice(FOLDS), u, i, rng.choice([1.0, 3.0, 5.0])) for u in range(1, 400) for i in rng.sample(range(m), 20)]
    d = frame(spark, rows)
    dealt, tasks = bp.deal_blocks(d, "item_id", "user_id", FOLDS)
    assert dealt.count() <= len(rows) * (tasks + 2) + 2 * m * tasks
    looked = []
    plain = np.searchsorted

    got = bp.best_neighbours(d, "item_id", "user_id", FOLDS, "pears", 20, "value")
    assert got.select(F.sum(F.size("top"))).first()[0] <= 20 * len(rows) < m * m / 50
    block_rows = [r for r in dealt.toArrow().to_batches()]
    block = bp.Block(next(bp._groups(iter(block_rows))), FOLDS, "pears", 512)

    class Counting:
        def __call__(self, a, v, *rest):
            if np.ndim(v) and a is not block.nc and len(np.atleast_1d(v)) >= 80:
                looked.append(len(v))
            return plain(a, v, *rest)

    a, z = next(block.strips(1_000_000))
    keys, sums = block.product(a, z, 1_000_000)
    value = block.values(keys, sums, int(block.te[a]))
    bp.np.searchsorted = Counting()
    try:
        x, _, _ = block.best(a, z, 1_000_000, 20, keys, value)
    finally:
        bp.np.searchsorted = plain
    hot = len(block.heavy_rows(a, z))
    assert hot and sum(n for n in looked if n <= 640) < hot * m / 10


def test_empty_and_single_rows(spark):
    d = frame(spark, [(1, 1, 1, 2.0)])
    assert [(r.c, r.e, r.top) for r in bp.best_neighbours(d, "item_id", "user_id", FOLDS, "cos", 3).collect()] == [(1, 1, [])]
    assert bp.best_neighbours(d.limit(0), "item_id", "user_id", FOLDS, "cos", 3).count() == 0
    assert bp.gram_entries(d, "item_id", "user_id", FOLDS).count() == 0

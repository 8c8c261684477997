"""What a task of the block product holds, and what is sent to it."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinerank.operators import block_product as bp

FOLDS = (1, 2, 3)


def rows_of(spark, users=60, items=40):
    rng = random.Random(5)
    rows = [(rng.choice(FOLDS), u, i, rng.choice([0.5, 1.0, 2.5, 4.0, 5.0]), 0.0, 0.0) for u in range(users) for i in range(items) if rng.random() < 0.4]
    return spark.createDataFrame(rows, "fold int, user_id bigint, item_id bigint, v double, b double, cp double")


def test_best_lists_are_cut_while_blocks_come(monkeypatch):
    monkeypatch.setattr(bp, "KEPT_ROWS", 100)
    rng, kept, found = np.random.default_rng(2), bp._Kept(250, 3), []
    for _ in range(40):
        x = np.repeat(np.arange(250), 2)
        part = (x, rng.integers(0, 50, 500), rng.integers(0, 10**12, 500), rng.random(500))
        kept.add(*part)
        found.append(part)
        assert max(kept.size) <= 3 * 100  # never more than the lists themselves
    want = bp._best(*[np.concatenate(c) for c in zip(*found, strict=True)], 3)
    got = [np.concatenate(c) for c in zip(*[kept.best(r) for r in range(3)], strict=True)]
    assert all(np.array_equal(a, b) for a, b in zip(want, got, strict=True))


def test_squeezed_records_hold_the_same_and_one_fold_needs_its_train_rows_only(spark):
    r = rows_of(spark)
    args = (r, "item_id", "user_id", (1,))
    plain, _ = bp.deal_blocks(*args, target_rows=200, neighbour_rows=100)
    small, _ = bp.deal_blocks(*args, target_rows=200, neighbour_rows=100, squeeze=True, train_only=True)

    def columns(dealt, squeezed):
        out = []
        for x in dealt.where(F.col("side") == bp.NEIGHBOUR).collect():
            c = (bp._loose if squeezed else bp._unpacked)(x.side, x.n, bytes(x.cols))
            out += [(x.p, x.q, *row) for row in zip(*[v.tolist() for v in c.values()], strict=True)]
        return out
    a, b = columns(plain, False), columns(small, True)
    assert {y[:1] + y[2:] for y in b} == {y[:1] + y[2:] for y in a if y[5] != 1} and len(b) < len(a)


@pytest.mark.parametrize("values", [[0.5, np.nan, -1.0, 4.0], list(np.random.default_rng(4).random(70_000))])
def test_squeezed_columns_come_back(values):
    n = len(values)
    rng = np.random.default_rng(1)
    for side in (bp.PROFILE_N, bp.NEIGHBOUR, bp.STATS_T):
        cols = {"c": np.sort(rng.integers(-9, 2**60, n)), "e": rng.integers(-2**62, 2**62, n), "v": np.array(values), "fold": np.full(n, -1, np.int32), "st": rng.random((n, 8))}
        back = bp._loose(side, n, bp._squeezed(side, cols))
        assert list(back) == list(bp.FIELDS[side]) and all(np.array_equal(x, cols[k], equal_nan=k == "v") for k, x in back.items())


def test_measures_are_worked_out_a_slice_at_a_time(monkeypatch):
    monkeypatch.setattr(bp, "SLICE", 7)
    sizes = []

    def co(sums, a, b):
        sizes.append(len(a.n))
        return bp._jac(sums, a, b)
    rng = np.random.default_rng(3)
    e, c = (x.ravel() for x in np.meshgrid(np.arange(9), np.arange(6)))
    n = len(e)
    st = {"e": np.arange(9), "st": np.ones((9, 4))}
    row = {"c": c, "e": e, "v": rng.random(n), "fold": np.full(n, 2, np.int32)}
    pair = bp.Pair(0, {bp.STATS_T: [st], bp.STATS_N: [st], bp.TARGET: [row | {"b": np.zeros(n), "cp": np.zeros(n)}], bp.NEIGHBOUR: [row]})
    block = bp.Block(pair, (1,), (("co",), co, True), 512)
    keys, sums = block.product(0, n, 1000)
    whole = bp._jac(sums, block.t_stats.at(keys // 9), block.n_stats.at(keys % 9))
    assert np.array_equal(block.values(keys, sums, 0), whole) and max(sizes) <= 7 < len(keys)


@pytest.mark.parametrize("kind", ["cos", "jac", "dot"])
def test_profiles_are_looked_up_where_their_lists_are_long(spark, kind):
    """Features that nearly every entity has: a target's few candidates are looked up, not all lists added."""
    rng = random.Random(1)
    base = [(1 + u % 3, u, u // 2, float(1 + u % 5), 0.0, 0.0) for u in range(60)] + [(1 + (u + 1) % 3, u, (u + 7) % 60 // 2, 2.5, 0.0, 0.0) for u in range(60)]
    r = spark.createDataFrame(sorted(set((u, i) + (f, v, b, c) for f, u, i, v, b, c in base)), "user_id bigint, item_id bigint, fold int, v double, b double, cp double")
    r = r.dropDuplicates(["user_id", "item_id"]).localCheckpoint()
    prof = {(u, f): rng.choice([0.5, 1.0, 2.0]) for u in range(60) for f in range(12) if rng.random() < 0.9}
    described = spark.createDataFrame([(u, f, w) for (u, f), w in prof.items()], "user_id bigint, idx bigint, weight double")
    profiles = bp.Profiles(described, "user_id", "idx", "weight", kind, None)
    top = lambda: {(x.c, x.e): [(t.nbr, t.o) for t in x.top] for x in bp.best_neighbours(r, "user_id", "item_id", FOLDS, "jac", 3, profiles=profiles).collect()}
    got = top()
    train = {(x.user_id, x.item_id): x.fold for x in r.collect()}
    for (item, user), found in got.items():
        f = train[user, item]
        rated = lambda u: {i for (w, i), g in train.items() if w == u and g != f}  # noqa: B023, E731
        for nbr, o in found:
            a, b = ({k[1]: w for k, w in prof.items() if k[0] == u} for u in (user, nbr))
            dot = sum(w * b[k] for k, w in a.items() if k in b)
            csim = dot if kind == "dot" else len(a.keys() & b.keys()) / len(a.keys() | b.keys()) if kind == "jac" else dot / np.sqrt(sum(w * w for w in a.values()) * sum(w * w for w in b.values()))
            co, either = len(rated(user) & rated(nbr)), len(rated(user) | rated(nbr))
            assert abs(-o / 1e9 - (0.5 * csim + 0.5 * (co / either if either else 0.0))) < 1e-8
    assert got

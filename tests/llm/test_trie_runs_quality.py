"""Prefix trie, periodic runs and kernel quality scores against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinerank.llm import kernel_quality, periodic, prefix_trie

DOCS = "doc_id bigint, text string, row string, runs int, collapsed string, stats int, score double, label int, n bigint, h int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y", 2, 0.5, 1, 7, 3) for i, t in rows], DOCS)


# ---- periodic runs

def runs_brute(w, exponent=4, least=6):
    best = {}
    for q in range(1, len(w) // exponent + 1):
        x = 0
        while x + q < len(w):
            y = x
            while y + q < len(w) and w[y] == w[y + q]:
                y += 1
            if y > x and y - x + q >= max(least, exponent * q):
                best.setdefault((x, y - x + q), q)
            x = y + 1
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def collapsed_brute(w, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in drop)


def periodic_texts(seed, count):
    rng, out = random.Random(seed), []
    for _ in range(count):
        n, pool = rng.randrange(0, 700), rng.choice([1, 2, 3, 5, 40, 1000])
        w = [str(rng.randrange(pool)) for _ in range(n)]
        for _ in range(rng.randrange(3) if n else 0):
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // rng.choice([3, 4, 5, 6, 9])))
            for i in range(a, min(n, a + rng.randrange(3 * p, 8 * p + 2))):
                w[i] = w[a + (i - a) % p]
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("short", [1, 2, 16])
def test_runs_of_texts_brute(short):
    texts = periodic_texts(short, 150)
    for t, (runs, left) in zip(texts, periodic.runs_of_texts(texts, short=short)):
        w = t.split()
        assert runs == runs_brute(w) and left == collapsed_brute(w, runs)


def test_runs_at_the_least_length():
    for q in (1, 2, 3, 16, 17, 31, 32, 33, 64, 65, 200):
        block = [f"b{i}" for i in range(q)]
        for n in (4 * q - 1, 4 * q, 4 * q + 1, 4 * q + q // 2):
            w = ["x", "y", *(block[i % q] for i in range(n)), "z"]
            assert periodic.runs_of_texts([" ".join(w)])[0][0] == ([(2, n, q)] if n >= max(6, 4 * q) else [])


def test_long_run_and_many_equal_words():
    assert periodic.runs_of_texts(["a " * 200_000])[0] == ([(0, 200_000, 1)], "a")
    rng = random.Random(4)
    block = " ".join(str(rng.randrange(9)) for _ in range(900))
    runs, left = periodic.runs_of_texts([" ".join([block] * 60)])[0]
    assert (0, 54_000, 900) in runs and len(left.split()) <= 900


def planted_brute(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return [x.decode() for x in w]


def test_periodic_digest_brute(spark):
    rng = random.Random(9)
    texts = [None, "", " \n\t", "one", "a a a a a a", "nbsp stays joined \x1c x\x0by\x0cz", "x" * 9000 + " end", *periodic_texts(3, 60)]
    texts += [" ".join(str(rng.randrange(10_000)) for _ in range(rng.randrange(1, 3000))) for _ in range(120)]
    rows = [*enumerate(texts), (3, "a a a a a a"), (None, "b b b b b b b"), (-20, "q " * 50)]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows if i is not None) > 5
    expected = []
    for i, t in rows:
        w = planted_brute(i, t)
        runs = runs_brute(w)
        top = min(((-n, s, q) for s, n, q in runs), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        expected.append((i, len(runs), top and top[1], top and -top[0], top and top[2], top and -1000 * top[0] // top[2],
                         hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed_brute(w, runs).encode()).hexdigest()))
    got = [tuple(r) for r in periodic.periodic_digest(docs_of(spark, rows)).collect()]
    order = lambda r: (r[0] is None, str(r))
    assert sorted(got, key=order) == sorted(expected, key=order)
    assert any(e[4] and e[4] > 16 for e in expected)


def test_collapse_runs_keeps_rows(spark):
    d = docs_of(spark, [(1, "go on " * 8), (1, None)])
    got = periodic.collapse_runs(d).select("row.*", F.col("runs").alias("found"), F.col("collapsed").alias("left")).collect()
    assert sorted((r.left, r.row, len(r.found)) for r in got) == [("", "x", 0), ("go on", "x", 1)]
    assert periodic.periodic_digest(d.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.collapse_runs(d, exponent=3)


# ---- prefix trie

def trie_brute(rows, rebuild):
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        convs[c] = own.get(base, [])[:h] + turns[h:]
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, ids in members.items():
        below = [x for x in members if x[:len(node)] == node]
        kids = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(y[:len(x)] == x and len(y) == len(x) + 1 for y in below)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        ends = ",".join(map(str, sorted(c for c in ids if len(convs[c]) == len(node))))
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 5) for r in rows],
                                 "conv_id bigint, turn bigint, role string, text string, path string, sizes int, key string, n int").repartition(5)


def trie_rows(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


def random_conversations(seed, count, pool, longest):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-150, 400), count):
        for t in range(rng.randrange(1, longest)):
            rows.append((c, t if t else None, rng.choice(["user", None, ""]), rng.choice([None, "", "é", *(f"t{k}" for k in range(pool))])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk", [1, 2, 7, 1 << 16])
def test_trie_brute(spark, chunk):
    rows = random_conversations(chunk, 90, 1, 7)
    rows += [(500 + k, t, "user", "same text") for k in range(30) for t in range(3)] + [(None, 0, "user", "nobody's"), (500, 1, "user", "same text")]
    d = conversations_of(spark, rows)
    assert trie_rows(prefix_trie.prefix_trie(d, chunk, 2)) == trie_brute(rows, False)
    assert trie_rows(prefix_trie.trie_digest(d, chunk, 2)) == trie_brute(rows, True)


def test_trie_long_empty_and_turnless(spark):
    rows = [(c, t, "user", f"t{t}") for c in (0, 1) for t in range(400)] + [(c, t, "user", "a") for c in range(700, 760) for t in range(1)]
    d = conversations_of(spark, rows)
    assert any(zlib.crc32(str(c).encode()) % 6 and c % 100 for c in range(700, 760))
    assert trie_rows(prefix_trie.trie_digest(d, 16, 5)) == trie_brute(rows, True)
    lone = [(c, 0, "user", "a") for c in range(1, 40)]  # no base: those with h > 0 have no turn left
    assert trie_rows(prefix_trie.trie_digest(conversations_of(spark, lone), 4, 3)) == trie_brute(lone, True)
    assert prefix_trie.trie_digest(d.limit(0)).count() == 0


def test_range_minima():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 5, 200)
    table = prefix_trie.RangeMin(x)
    lo = rng.integers(0, 200, 300)
    hi = np.array([rng.integers(a, 200) for a in lo])
    assert (table.least(lo, hi) == [x[a:b + 1].min() for a, b in zip(lo, hi)]).all()
    at = np.arange(200)
    for right in (False, True):
        for a, far in zip(at, table.extent(at, x, right)):
            k = 0
            while 0 <= a + (k + 1) * (1 if right else -1) < 200 and x[a + (k + 1) * (1 if right else -1)] >= x[a]:
                k += 1
            assert k == far


# ---- quality

def quality_docs(spark, n=300):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        w = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(20, 300))]
        bad = i % 3 == 0
        if bad:
            w = [[x.upper() + "!!" for x in w], [x + "***" for x in w], [x for x in w[:40] for _ in range(7)]][i // 3 % 3]
        rows.append((i, " ".join(w)))
        labels.append((i, int(not bad)))
    return rows, labels


def test_quality_scores(spark):
    rows, labels = quality_docs(spark)
    rows += [(None, None), (5000, ""), (5001, "x" * 200_000), (7, rows[7][1])]
    labels += [(None, 1), (3, None), (4, 7), (9999, 0), (6, 1)]
    d, lab = docs_of(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int")
    got = kernel_quality.quality_score_digest(d, lab).toPandas()
    assert len(got) == len(rows) and got.score.between(0, 1).all()
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(300)}
    seen = got[got.doc_id < 300].drop_duplicates("doc_id").set_index("doc_id")
    assert all(bool(seen.held_out[i]) == h for i, h in held.items())
    right = [int(seen.predicted[i]) == int(i % 3 != 0) for i, h in held.items() if h]
    assert sum(right) >= 0.97 * len(right)
    assert ((got.score >= 0.7) == (got.predicted == 1)).all()
    again = kernel_quality.score_quality(d, lab.select("doc_id", F.col("quality").alias("label"))).select("row.*", F.col("score").alias("s"))
    assert set(again.columns) == {*d.columns, "s"} and again.count() == len(rows)


def test_quality_held_out_on_the_tables(spark):
    d, lab = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = kernel_quality.quality_score_digest(d, lab).join(lab, "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.quality).mean() >= 0.97


def test_quality_without_both_classes(spark):
    rows, labels = quality_docs(spark, 30)
    d = docs_of(spark, rows)
    for some in ([], [(1, 1), (2, 1)], [(i, 1) for i, _ in labels]):
        lab = spark.createDataFrame(some, "doc_id bigint, quality int")
        scores = {round(r.score, 6) for r in kernel_quality.quality_score_digest(d, lab).collect()}
        assert len(scores) == 1 and 0 < min(scores) < 1
    assert kernel_quality.quality_score_digest(d.limit(0), spark.createDataFrame(labels, "doc_id bigint, quality int")).count() == 0


def test_normal_equations_add_up(spark):
    rng = np.random.default_rng(3)
    x, y, fold = rng.normal(size=(500, kernel_quality.STATISTICS)), rng.integers(0, 2, 500).astype(float), rng.integers(0, 3, 500)
    df = spark.createDataFrame([(a.tolist(), float(b), int(f)) for a, b, f in zip(x, y, fold)], "stats array<double>, label double, fold int").repartition(23)
    f = kernel_quality.Fourier.draw(x.mean(0), x.std(0), 12, 4.0, 1)
    for fan_in in (2, 100):
        sums = kernel_quality.normal_equations(df, f, 3, fan_in)
        for k, (zz, zy, yy, n) in enumerate(sums):
            z, t = f(x[fold == k]), y[fold == k]
            assert np.allclose(zz, z.T @ z) and np.allclose(zy, z.T @ t) and np.isclose(yy, t @ t) and np.isclose(n, len(t))


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(40, 6))
    z = kernel_quality.Fourier.draw(np.zeros(6), np.ones(6), 20_000, 2.0, 3)(x)[:, :-1]
    near = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * 2.0 ** 2))
    assert np.abs(z @ z.T - near).max() < 0.05


def test_pool_adjacent_is_isotonic_regression():
    rng = random.Random(6)
    for _ in range(30):
        n = rng.randrange(1, 25)
        weight = [rng.randrange(1, 5) for _ in range(n)]
        total = [rng.randrange(0, w + 1) for w in weight]
        x, y = kernel_quality.pool_adjacent(list(range(n)), weight, total)
        for i in range(n):  # the greatest over beginnings of the least over ends of the mean
            level = max(min(sum(total[a:b]) / sum(weight[a:b]) for b in range(i + 1, n + 1)) for a in range(i + 1))
            assert np.isclose(np.interp(i, x, y), level)

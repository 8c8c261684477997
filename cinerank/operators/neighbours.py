"""Neighbourhood collaborative filtering (JOB-1..JOB-7).

All folds run in one job: the train side of fold f is every rating whose
fold differs from f, produced by a generator (``explode``) rather than a
join, and ``fold`` is carried as a key through every join and aggregate.

Plan per (fold, test cell (u, i)):
  candidates  test (u, i) x train rows of u (item-item) or of i (user-user)
  similarity  demand-driven, only for the distinct candidate pairs
  ranking     row_number <= max(k)  (Spark plans a map-side WindowGroupLimit)
  prefixes    one ranking, every k via explode(filter(ks, k >= rn))
  prediction  baseline + sum(s * dev) / sum(s or |s|), clamped to [1, 5]
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cinerank.functions.scalar import clamp, dec
from cinerank.operators.block_product import Measure, Profiles, best_neighbours
from cinerank.operators.similarity import (BLOCK_FORMS, DEFAULT_HEAVY_DEGREE, ZERO_NORM_SIM, candidate_stats, fold_candidates, fold_stats,
                                           is_builtin, similarity)
from cinerank.session import materialize

U, I = "user_id", "item_id"
DEFAULT_KS = (2, 5, 10, 20)
DEFAULT_P = 0.5


def fold_sides(folds: DataFrame, n_folds: int = 5, only: int | None = None,
               cols: Sequence[str] = (U, I, "score")):
    """(train, test) with a ``fold`` key; train of fold f = rows with fold <> f."""
    cols = list(cols)
    if only is not None:
        test = folds.where(F.col("fold") == only).select("fold", *cols)
        train = folds.where(F.col("fold") != only).select(F.lit(only).alias("fold"), *cols)
        return train, test
    test = folds.select("fold", *cols)
    others = F.filter(F.array(*[F.lit(f) for f in range(1, n_folds + 1)]), lambda f: f != F.col("fold"))
    train = folds.select(F.explode(others).alias("fold"), *cols)
    return train, test


def baseline_means(train: DataFrame, part: Sequence[str] = ("fold",)):
    """JOB-1/AGG-1..3: global, user and item means per part."""
    part = list(part)
    mu = train.groupBy(*part).agg(F.avg("score").alias("mu"))
    um = train.groupBy(*part, U).agg(F.avg("score").alias("u_mean"))
    im = train.groupBy(*part, I).agg(F.avg("score").alias("i_mean"))
    return mu, um, im


def with_baseline(df: DataFrame, mu: DataFrame, um: DataFrame, im: DataFrame,
                  part: Sequence[str], name: str = "b") -> DataFrame:
    """b = user mean + item mean - mu; a missing mean counts as 0.0 (PRJ-5).

    ``mu`` has one row per part (bounded by the fold count) and is broadcast;
    the user/item means grow with the data, so AQE decides at run time."""
    part = list(part)
    out = (df.join(F.broadcast(mu), part, "left").join(um, part + [U], "left")
           .join(im, part + [I], "left"))
    b = (F.coalesce("u_mean", F.lit(0.0)) + F.coalesce("i_mean", F.lit(0.0))) - F.coalesce("mu", F.lit(0.0))
    return out.withColumn(name, b).drop("mu", "u_mean", "i_mean")


def blend(sims: DataFrame, content, p: float, kind: str) -> DataFrame:
    """SIM-11: p * content + (1 - p) * cf. Cosine sentinels (-1 from a zero norm)
    are not blended; Jaccard always is. ``content`` is a function
    pairs(a, b) -> (a, b, csim) evaluated for the requested pairs only;
    a pair it does not return counts as 0.0."""
    if content is None:
        return sims
    # requested pairs only, written once (the content similarity reads them twice)
    c = content(materialize(sims.select("a", "b").distinct(), "blend_pairs"))
    c = c.select("a", "b", F.col("csim").cast("double").alias("csim"))
    j = sims.join(c, ["a", "b"], "left")
    mixed = F.lit(p) * F.coalesce("csim", F.lit(0.0)) + F.lit(1.0 - p) * F.col("sim").cast("double")
    sim = F.when(F.col("zero_norm"), F.col("sim")).otherwise(dec(mixed))
    return j.withColumn("sim", sim).drop("csim")


def predict(train: DataFrame, test: DataFrame, mode: str = "item", kind: str = "pears",
            ks: Sequence[int] = DEFAULT_KS, part: Sequence[str] = ("fold",),
            content=None, p: float = DEFAULT_P, heavy_degree: int = DEFAULT_HEAVY_DEGREE,
            requested_only: bool = False) -> DataFrame:
    """Neighbourhood predictions for every test cell and every k.

    ``requested_only``: for a handful of test cells. Similarities are worked out for the candidate pairs of these cells
    alone, not by a join of all co-rated rows; the predictions are the same.

    train/test: (part, user_id, item_id, score). Returns
    (part, user_id, item_id, score, k, pred).

    The train rows with their means, deviation and similarity value are
    written once (several branches read them). Each entity's norm and count
    is attached to train and test rows *before* the candidate join, and the
    co-rating dots are left-joined straight onto the candidates, so the
    candidate rows are built once; distinct candidate pairs are only formed
    when heavy contexts or a content blend need them."""
    part = list(part)
    ks = sorted(set(int(k) for k in ks))
    target, ctx = (I, U) if mode == "item" else (U, I)
    if requested_only and is_builtin(kind):
        return _predict_requested(train, test, mode, kind, ks, part, content, p)
    if not is_builtin(kind):
        return _predict_registered(train, test, mode, kind, ks, part, content, p)
    mu, um, im = baseline_means(train, part)
    means = (train.select(*part, U, I, "score").join(F.broadcast(mu), part, "left")
             .join(um, part + [U], "left").join(im, part + [I], "left"))
    b = (F.coalesce("u_mean", F.lit(0.0)) + F.coalesce("i_mean", F.lit(0.0))) - F.coalesce("mu", F.lit(0.0))
    centre = {"item": "i_mean", "user": "u_mean"}[mode]
    v = F.col("score") - F.col(centre) if kind == "pears" else F.col("score")
    tr_all = materialize(means.select(*part, U, I, (F.col("score") - b).alias("dev"), v.alias("v")), "cf_train")

    j = candidate_stats(test.select(*part, U, I), tr_all, target, ctx, "v", part, keep=["dev"],
                        heavy_degree=heavy_degree)
    dot, co = F.coalesce("dot", F.lit(0.0)), F.coalesce("co", F.lit(0))
    if kind == "jac":
        union = F.col("n_t") + F.col("n_n") - co
        sim = dec(F.when(union == 0, F.lit(0.0)).otherwise(co / union))
        zero = F.lit(False)
    else:
        zero = (F.col("sq_t") == 0) | (F.col("sq_n") == 0)
        sim = F.when(zero, F.lit(ZERO_NORM_SIM).cast("decimal(18,9)")).otherwise(
            dec(dot / F.sqrt(F.col("sq_t") * F.col("sq_n"))))
    scored = j.select(*part, U, I, "nbr", "dev", "a", "b", sim.alias("sim"), zero.alias("zero_norm"))
    if content is not None:
        scored = blend(scored, content, p, kind)
    return _rank_and_predict(scored.select(*part, U, I, "nbr", "dev", "sim"), test, mu, um, im,
                             mode, ks, part)


def predict_folds(ratings: DataFrame, mode: str = "item", kind: str = "pears", ks: Sequence[int] = DEFAULT_KS,
                  folds: Sequence[int] = (1, 2, 3, 4, 5), content=None, p: float = DEFAULT_P) -> DataFrame:
    """``predict`` for every fold of ``folds`` at once: fold f is tested against all rows outside f.

    ratings: (fold, user_id, item_id, score), unique per (user_id, item_id). Every row is written once, with its
    train means and deviation for each fold as arrays. Built-in similarities, alone or blended with ``Profiles``, are a block
    product, as are similarities registered with their form for it; with any other function as ``content`` pairs are joined once for all folds (``fold_candidates``).
    The centred cosine is worked out from plain sums: sum(xy) - mx sum(y) - my sum(x) + co mx my."""
    if is_builtin(kind) and (content is None or isinstance(content, Profiles)):
        return _predict_blocks(ratings, mode, kind, sorted({int(k) for k in ks}), [int(f) for f in folds], profiles=content, p=p)
    if kind in BLOCK_FORMS and content is None:
        return _predict_blocks(ratings, mode, BLOCK_FORMS[kind], sorted({int(k) for k in ks}), [int(f) for f in folds])
    folds = [int(f) for f in folds]
    ks = sorted(set(int(k) for k in ks))
    target, ctx = (I, U) if mode == "item" else (U, I)
    if not is_builtin(kind):
        others = F.filter(F.array(*[F.lit(f) for f in folds]), lambda f: f != F.col("fold"))
        train = ratings.select(F.explode(others).alias("fold"), U, I, "score")
        return _predict_registered(train, ratings.where(F.col("fold").isin(*folds)), mode, kind, ks, ["fold"], content, p)
    r = ratings.select("fold", U, I, F.col("score").cast("double").alias("score"))
    mu = [float(x or 0.0) for x in r.agg(*[F.avg(F.when(F.col("fold") != f, F.col("score"))) for f in folds]).first()]
    r = r.join(fold_stats(r, U, folds, "score", "u"), U).join(fold_stats(r, I, folds, "score", "i"), I)

    def mean(prefix, k):
        n = F.get(f"{prefix}n", F.lit(k))
        return F.coalesce(F.when(n > 0, F.get(f"{prefix}s", F.lit(k)) / n), F.lit(0.0))
    base_of = [mean("u", k) + mean("i", k) - F.lit(m) for k, m in enumerate(mu)]
    e = "i" if mode == "item" else "u"
    means = [mean(e, k) if kind == "pears" else F.lit(0.0) for k in range(len(folds))]

    def norm(k):
        q, s, n = F.get(f"{e}q", F.lit(k)), F.get(f"{e}s", F.lit(k)), F.get(f"{e}n", F.lit(k))
        if kind != "pears":
            return q
        # equal values only: no spread, but for rounding
        return F.when(q * n - s * s <= 1e-12 * q * n, F.lit(0.0)).otherwise(q - s * s / n)
    own = F.coalesce(*[F.when(F.col("fold") == f, b) for f, b in zip(folds, base_of, strict=True)])
    base = materialize(r.select("fold", U, I, "score", F.col("score").alias("v"), own.alias("b0"), F.array(*[F.col("score") - b for b in base_of]).alias("dev"),
                                F.col(f"{e}n").alias("n"), F.array(*[norm(k) for k in range(len(folds))]).alias("q"), F.array(*means).alias("m")), "cf_rows")
    measures = {"cos": ("dot",), "jac": ("co",), "pears": ("dot", "co", "s_a", "s_b")}[kind]
    j = fold_candidates(base, target, ctx, folds, measures, by_fold=["dev"])
    if kind == "jac":
        union = F.col("n_t") + F.col("n_n") - F.col("co")
        sim, zero = dec(F.when(union == 0, F.lit(0.0)).otherwise(F.col("co") / union)), F.lit(False)
    else:
        d = F.col("dot")
        if kind == "pears":
            d = d - F.col("m_t") * F.col("s_n") - F.col("m_n") * F.col("s_t") + F.col("co") * F.col("m_t") * F.col("m_n")
        zero = (F.col("q_t") == 0) | (F.col("q_n") == 0)
        sim = F.when(zero, F.lit(ZERO_NORM_SIM).cast("decimal(18,9)")).otherwise(dec(d / F.sqrt(F.col("q_t") * F.col("q_n"))))
    scored = j.select("fold", U, I, "nbr", "dev", "a", "b", sim.alias("sim"), zero.alias("zero_norm"))
    if content is not None:
        scored = blend(scored, content, p, kind)
    test = base.where(F.col("fold").isin(*folds)).select("fold", U, I, "score", F.col("b0").alias("b"))
    return _top_k(scored.select("fold", U, I, "nbr", "dev", "sim"), test, mode, ks, ["fold"])


def _predict_blocks(ratings: DataFrame, mode: str, kind: Measure | str, ks: Sequence[int], folds: Sequence[int], **blocks) -> DataFrame:
    """``predict_folds`` by a block-sparse product: each test row gets its best neighbours as one short array."""
    target, ctx = (I, U) if mode == "item" else (U, I)
    r = ratings.select("fold", U, I, F.col("score").cast("double").alias("v"))
    mu = [float(x or 0.0) for x in r.agg(*[F.avg(F.when(F.col("fold") != f, F.col("v"))) for f in folds]).first()]

    def own(prefix):
        """The mean outside the row's own fold; 0.0 if there is none."""
        mean = [F.when(F.get(f"{prefix}n", F.lit(k)) > 0, F.get(f"{prefix}s", F.lit(k)) / F.get(f"{prefix}n", F.lit(k))) for k in range(len(folds))]
        return F.coalesce(*[F.when(F.col("fold") == f, m) for f, m in zip(folds, mean, strict=True)], F.lit(0.0))

    m = F.coalesce(*[F.when(F.col("fold") == f, F.lit(x)) for f, x in zip(folds, mu, strict=True)], F.lit(0.0))
    c = "u" if mode == "item" else "i"
    known = r.where("v is not null")
    rows = r.dropna(subset=[U, I]).join(fold_stats(known, U, folds, "v", "u"), U, "left").select("fold", U, I, "v", own("u").alias("_u"))  # its mean goes on, not the sums
    rows = rows.join(fold_stats(known, I, folds, "v", "i"), I, "left").select("fold", U, I, "v", "_u", own("i").alias("_i"))
    rows = materialize(rows.select("fold", U, I, "v", (F.col("_u") + F.col("_i") - m).alias("b"), (F.col(f"_{c}") - m).alias("cp")), "cf_rows")
    top = best_neighbours(rows, target, ctx, folds, kind, ks[-1], **blocks).withColumnsRenamed({"e": target, "c": ctx, "v": "score"})
    den = "-x.o" if mode == "item" else "abs(x.o)"
    sums = ", ".join(f"""struct({k} as k, if(exists(slice(top, 1, {k}), x -> x.d is not null),
                                    aggregate(slice(top, 1, {k}), 0D, (s, x) -> s + coalesce(-x.o / 1e9D * (x.d - cp), 0D)), null) as num,
                                    aggregate(slice(top, 1, {k}), 0L, (s, x) -> s + {den}) / 1e9D as den)""" for k in ks)
    out = top.select("fold", U, I, "score", "b", F.explode(F.expr(f"array({sums})")).alias("p"))
    return out.select("fold", U, I, "score", "p.k", clamp(F.when(F.col("p.den") != 0, F.col("b") + F.col("p.num") / F.col("p.den")).otherwise(F.col("b"))).alias("pred"))


def _rank_and_predict(scored, test, mu, um, im, mode, ks, part):
    return _top_k(scored, with_baseline(test.select(*part, U, I, "score"), mu, um, im, part, "b"), mode, ks, part)


def _top_k(scored, base, mode, ks, part):
    w = Window.partitionBy(*part, U, I).orderBy(F.col("sim").desc(), F.col("nbr").asc())
    top = scored.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= ks[-1])
    ks_arr = F.array(*[F.lit(k) for k in ks])
    per_k = top.withColumn("k", F.explode(F.filter(ks_arr, lambda k: k >= F.col("rn"))))
    den = F.sum(F.col("sim")) if mode == "item" else F.sum(F.abs(F.col("sim")))
    agg = (per_k.groupBy(*part, U, I, "k")
           .agg(F.sum(F.col("sim").cast("double") * F.col("dev")).alias("num"), den.alias("den")))
    grid = base.withColumn("k", F.explode(ks_arr))
    out = grid.join(agg, part + [U, I, "k"], "left")
    raw = F.when(F.col("den").isNotNull() & (F.col("den") != 0),
                 F.col("b") + F.col("num") / F.col("den").cast("double")).otherwise(F.col("b"))
    return out.select(*part, U, I, "score", "k", clamp(raw).alias("pred"))


def _predict_requested(train, test, mode, kind, ks, part, content, p):
    """``_predict_registered`` for a handful of cells: only the train rows of their contexts are candidates, and means and
    similarities are worked out from the rows of the users and items that occur there. What these are is written first, so
    that Spark knows their size and filters the train rows where they are read."""
    target, ctx = (I, U) if mode == "item" else (U, I)
    train = train.select(*part, U, I, "score")
    cells = test.select(*part, U, I)
    near = materialize(train.join(cells.select(*part, ctx).distinct(), part + [ctx], "left_semi").unionByName(cells.withColumn("score", F.lit(None).cast("double"))), "near_rows")

    def rows_of(key):
        return train.join(near.select(*part, key).distinct(), part + [key], "left_semi")
    mu = train.groupBy(*part).agg(F.avg("score").alias("mu"))
    um, im = (rows_of(key).groupBy(*part, key).agg(F.avg("score").alias(name)) for key, name in ((U, "u_mean"), (I, "i_mean")))
    mine = train.join(cells.select(*part, ctx).distinct(), part + [ctx], "left_semi")
    return _predict_pairs(mine, rows_of(target), test, (mu, um, im), mode, kind, ks, part, content, p)


def _predict_registered(train, test, mode, kind, ks, part, content, p):
    """Path for similarities added with ``register_similarity`` (UDF-2)."""
    return _predict_pairs(train, train, test, baseline_means(train, part), mode, kind, ks, part, content, p)


def _predict_pairs(train, rows, test, means, mode, kind, ks, part, content, p):
    """Predictions through the distinct candidate pairs; their similarities come from ``rows``."""
    target, ctx = (I, U) if mode == "item" else (U, I)
    mu, um, im = means
    tr = with_baseline(train.select(*part, U, I, "score"), mu, um, im, part, "b_n")
    tr = tr.select(*part, F.col(ctx), F.col(target).alias("nbr"), (F.col("score") - F.col("b_n")).alias("dev"))
    cand = (test.select(*part, U, I).join(tr, part + [ctx]).where(F.col("nbr") != F.col(target))
            .withColumn("a", F.least(target, "nbr")).withColumn("b", F.greatest(target, "nbr")))
    values = rows.select(*part, U, I, F.col("score").alias("v"))
    sims = similarity(values, cand.select(*part, "a", "b").distinct(), kind, target, ctx, part)
    sims = blend(sims, content, p, kind).select(*part, "a", "b", "sim")
    scored = cand.join(sims, part + ["a", "b"]).select(*part, U, I, "nbr", "dev", "sim")
    return _rank_and_predict(scored, test, mu, um, im, mode, ks, part)

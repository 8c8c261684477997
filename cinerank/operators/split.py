"""Folds, hold-outs and samples (JOB-21..JOB-25, WIN-4, WIN-5, SRT-2).

Randomness is a seeded hash of the row key (60 bits of its MD5, which any SQL
engine can repeat), so a split is reproducible, needs no shuffle and survives
recomputation after an executor loss (``rand()`` would not). Positions in an order use the
distributed global rank, never a single-task window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.operators.ranking import global_rank

U, I = "user_id", "item_id"
_HASH_BITS = 60


def key_hash(seed: int, *cols) -> F.Column:
    """Pseudo-uniform whole number below 2^60: the first 15 hex digits of the MD5 of 'seed|col|col...'."""
    key = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")


def _below(fraction: float, seed: int, *cols) -> F.Column:
    """True for about ``fraction`` of the keys; the whole hash is compared, so small fractions hold too."""
    return key_hash(seed, *cols) < F.lit(int(fraction * (1 << _HASH_BITS)))


def hash_folds(ratings: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """JOB-21: shuffled k-fold by hashing (user, item); near-equal sizes."""
    return ratings.withColumn("fold", (F.pmod(key_hash(seed, U, I), F.lit(k)) + 1).cast("int"))


def balanced_folds(ratings: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """JOB-21, sizes equal within 1: rank rows by their seeded hash (global
    rank, no single-task window) and deal ranks round-robin into k folds."""
    h = ratings.withColumn("_h", key_hash(seed, U, I))
    r = global_rank(h, ["_h", U, I], "_r", start=0)
    return r.withColumn("fold", (F.pmod(F.col("_r"), F.lit(k)) + 1).cast("int")).drop("_h", "_r")


def holdout(ratings: DataFrame, test_fraction: float = 0.25, seed: int = 42) -> DataFrame:
    """JOB-22: random hold-out; adds ``split`` = 'train' / 'test'."""
    return ratings.withColumn("split", F.when(_below(test_fraction, seed, U, I), "test").otherwise("train"))


def bernoulli_sample(ratings: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """JOB-23: keep each row with probability ``fraction`` (reproducible)."""
    return ratings.where(_below(fraction, seed, U, I))


def user_sample(ratings: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """JOB-24: cluster sample - every rating of each chosen user, none of the others."""
    return ratings.where(_below(fraction, seed, U))


def positions(ratings: DataFrame, order=("ts", I)) -> DataFrame:
    """WIN-4 helper: 1-based position of each row within its user in ``order``,
    from one global rank over (user, order) minus the user's first rank."""
    g = global_rank(ratings, [U, *order], "_g")
    first = g.groupBy(U).agg(F.min("_g").alias("_first"))
    return g.join(first, U).withColumn("pos", F.col("_g") - F.col("_first") + 1).drop("_first")


def per_user_holdout(ratings: DataFrame, start: int, stop: int, max_test: int = 0,
                     order=("ts", I), file_order=("ts", U, I)) -> DataFrame:
    """JOB-25 / WIN-4: a row is test when its per-user position (in input
    order) is in [start, stop], until ``max_test`` test rows were taken in
    input order (``max_test <= 0``: no cap). Adds ``split``."""
    p = positions(ratings, order)
    chosen = (F.col("pos") >= start) & (F.col("pos") <= stop)
    if max_test > 0:
        c = global_rank(p.where(chosen).select(U, I, *[x for x in file_order if x not in (U, I)]),
                        list(file_order), "_t")
        p = p.join(c.select(U, I, "_t"), [U, I], "left")
        chosen = chosen & F.col("_t").isNotNull() & (F.col("_t") <= max_test)
    return p.withColumn("split", F.when(chosen, "test").otherwise("base")).drop("_g", "_t")


def block_folds(ratings: DataFrame, k: int = 5, order=("ts", U, I)) -> DataFrame:
    """WIN-5: contiguous blocks of ceil(N / k) rows in ``order`` form folds 1..k."""
    g = global_rank(ratings, list(order), "_r", start=0)
    n = -(-g.count() // k)  # block size ceil(N / k): one number to the driver
    return g.withColumn("fold", (F.floor(F.col("_r") / F.lit(n)) + 1).cast("int")).drop("_r")

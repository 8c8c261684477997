"""Split and sample queries (JOB-21..25, WIN-4, WIN-5, SRT-2, AGG-24)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinerank.operators import split as sp
from cinerank.plans.oracle_views import with_views
from cinerank.plans.registry import query
from cinerank.sources import views


@query("job21_modulo_fold_sizes", with_views("folds") + "select fold, count(*) as n from folds group by fold")
def job21_modulo_fold_sizes(spark, sf_dir):
    """JOB-21 (oracle form): sizes of the deterministic modulo folds."""
    return views.folds(spark, sf_dir).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


def _h(*cols: str, seed: int = 42) -> str:
    """The splits' hash in SQL: 60 bits of the MD5 of 'seed|col|col...'."""
    key = ", ".join(["'" + str(seed) + "'", *[f"cast({c} as varchar)" for c in cols]])
    return f"cast('0x' || substr(md5(concat_ws('|', {key})), 1, 15) as bigint)"


_BALANCED = ("balanced", f"select user_id, item_id, cast((row_number() over (order by {_h('user_id', 'item_id')}, user_id, item_id) - 1) "
                         "% 5 + 1 as integer) as fold from ratings")


@query("job21_hash_folds", with_views("ratings")
       + f"select user_id, item_id, cast({_h('user_id', 'item_id')} % 5 + 1 as integer) as fold from ratings")
def job21_hash_folds(spark, sf_dir):
    """JOB-21: shuffled k-fold by seeded hash."""
    return sp.hash_folds(views.ratings(spark, sf_dir)).select("user_id", "item_id", "fold")


@query("job21_balanced_folds", with_views("ratings", extra=[_BALANCED]) + "select user_id, item_id, fold from balanced")
def job21_balanced_folds(spark, sf_dir):
    """JOB-21: rows dealt to the folds in hash order."""
    return sp.balanced_folds(views.ratings(spark, sf_dir)).select("user_id", "item_id", "fold")


@query("job21_balanced_fold_sizes", with_views("ratings", extra=[_BALANCED]) + "select fold, count(*) as n from balanced group by fold")
def job21_balanced_fold_sizes(spark, sf_dir):
    """JOB-21: hash-ordered folds whose sizes differ by at most one."""
    f = sp.balanced_folds(views.ratings(spark, sf_dir))
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query("job22_holdout", with_views("ratings") + f"select user_id, item_id, case when {_h('user_id', 'item_id')} < {int(0.25 * (1 << 60))} "
       "then 'test' else 'train' end as split from ratings")
def job22_holdout(spark, sf_dir):
    """JOB-22: 75/25 hold-out by seeded hash."""
    return sp.holdout(views.ratings(spark, sf_dir)).select("user_id", "item_id", "split")


@query("job23_bernoulli_sample", with_views("ratings")
       + f"select user_id, item_id, score from ratings where {_h('user_id', 'item_id')} < {int(0.1 * (1 << 60))}")
def job23_bernoulli_sample(spark, sf_dir):
    """JOB-23: row-level sample, fraction 0.1 (sampling is the feature)."""
    return sp.bernoulli_sample(views.ratings(spark, sf_dir), 0.1).select("user_id", "item_id", "score")


@query("agg24_user_sample_counts", with_views("ratings", extra=[
    ("s", f"select user_id from ratings where {_h('user_id')} < {int(0.3 * (1 << 60))}")])
       + "select b.u as users_before, b.n as rows_before, a.u as users_after, a.n as rows_after "
         "from (select count(distinct user_id) as u, count(*) as n from ratings) b, "
         "(select count(distinct user_id) as u, count(*) as n from s) a")
def agg24_user_sample_counts(spark, sf_dir):
    """JOB-24 / AGG-24: distinct users and rows before and after a 30% user sample."""
    r = views.ratings(spark, sf_dir)
    s = sp.user_sample(r, 0.3)
    both = (r.select("user_id", F.lit(True).alias("_b")).unionByName(s.select("user_id", F.lit(False).alias("_b"))))
    return both.agg(F.countDistinct(F.when(F.col("_b"), F.col("user_id"))).alias("users_before"),
                    F.sum(F.when(F.col("_b"), 1).otherwise(0)).cast("bigint").alias("rows_before"),
                    F.countDistinct(F.when(~F.col("_b"), F.col("user_id"))).alias("users_after"),
                    F.sum(F.when(F.col("_b"), 0).otherwise(1)).cast("bigint").alias("rows_after"))


_POS = ("pos", "select *, row_number() over (partition by user_id order by ts, item_id) as pos from ratings")


@query("win4_user_positions", with_views("ratings", extra=[_POS]) + "select user_id, item_id, pos from pos")
def win4_user_positions(spark, sf_dir):
    """WIN-4: position of each rating within its user in input (time) order."""
    return sp.positions(views.ratings(spark, sf_dir)).select("user_id", "item_id", "pos")


@query("job25_per_user_holdout", with_views("ratings", extra=[_POS])
       + "select user_id, item_id, case when pos between 1 and 10 then 'test' else 'base' end as split from pos")
def job25_per_user_holdout(spark, sf_dir):
    """JOB-25: first 10 ratings of each user are test (ua style)."""
    h = sp.per_user_holdout(views.ratings(spark, sf_dir), 1, 10, 0)
    return h.select("user_id", "item_id", "split")


@query("win5_block_folds", with_views("ratings", extra=[
    ("g", "select *, row_number() over (order by ts, user_id, item_id) - 1 as r, "
          "ceil(count(*) over () / 5.0) as n from ratings")])
       + "select user_id, item_id, cast(floor(r / n) + 1 as integer) as fold from g")
def win5_block_folds(spark, sf_dir):
    """WIN-5: contiguous blocks of ceil(N/5) rows in input order."""
    return sp.block_folds(views.ratings(spark, sf_dir)).select("user_id", "item_id", "fold")


@query("srt2_sorted_test_split", with_views("folds")
       + "select user_id, item_id, score from folds where fold = 1 order by user_id, item_id")
def srt2_sorted_test_split(spark, sf_dir):
    """SRT-2: the fold-1 test split sorted numerically by (user, item)."""
    f = views.folds(spark, sf_dir).where(F.col("fold") == 1)
    return f.select("user_id", "item_id", "score").orderBy("user_id", "item_id")

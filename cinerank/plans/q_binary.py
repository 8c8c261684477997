"""Binary like/dislike queries (PRJ-1, SIM-7, SIM-12, JOB-8, JOB-13, AGG-17..19, AGG-25, UDF-3)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from cinerank.functions.scalar import BINARY_THRESHOLDS, binarise, dec, r6, r6_dec
from cinerank.operators import knn
from cinerank.operators import neighbours as nb
from cinerank.operators.block_product import gram_entries, nano
from cinerank.operators.evaluate import confusion, fold_mean, precision_recall_f1, rounded
from cinerank.plans.oracle_views import with_views
from cinerank.plans.registry import query
from cinerank.session import materialize
from cinerank.sources import views


def binary_folds(spark, sf_dir):
    f = views.folds(spark, sf_dir)
    return f.select("user_id", "item_id", binarise("score").alias("label"), "fold")


_BIN = ("binfolds", "select user_id, item_id, case when score >= 3.0 then 1 else -1 end as label, fold from folds")


@query("prj1_ratings_binary", with_views("ratings_binary") + "select user_id, item_id, label from ratings_binary")
def prj1_ratings_binary(spark, sf_dir):
    """PRJ-1 / SNK-5 content: score >= 3.0 -> 1 else -1."""
    return views.ratings_binary(spark, sf_dir).select("user_id", "item_id", "label")


@query("prj1_threshold_counts", with_views("ratings", extra=[
    ("th", "select unnest([2.0, 2.5, 3.0, 3.5, 4.0]) as threshold")])
       + "select th.threshold, cast(sum(case when r.score >= th.threshold then 1 else 0 end) as bigint) as n_like, "
         "cast(sum(case when r.score >= th.threshold then 0 else 1 end) as bigint) as n_dislike "
         "from ratings r cross join th group by th.threshold")
def prj1_threshold_counts(spark, sf_dir):
    """PRJ-1 over every offered threshold: likes and dislikes per threshold."""
    r = views.ratings(spark, sf_dir)
    t = r.select("score", F.explode(F.array(*[F.lit(float(x)) for x in BINARY_THRESHOLDS])).alias("threshold"))
    like = F.when(F.col("score") >= F.col("threshold"), 1).otherwise(0)
    return t.groupBy("threshold").agg(F.sum(like).cast("bigint").alias("n_like"),
                                      F.sum(1 - like).cast("bigint").alias("n_dislike"))


_LD_CTES = [
    _BIN,
    ("train", "select user_id, item_id, label from binfolds where fold <> 1"),
    ("test", "select user_id, item_id, label from binfolds where fold = 1"),
    ("st", "select user_id as e, count(*) as n from train group by 1"),
    ("dots", "select x.user_id as a, y.user_id as b, sum(cast(x.label as double) * y.label) as dot, count(*) as co "
             "from train x join train y on x.item_id = y.item_id and x.user_id < y.user_id group by 1, 2"),
    ("cand", "select te.user_id, te.item_id, tr.user_id as nbr, tr.label as lv, least(te.user_id, tr.user_id) as a, "
             "greatest(te.user_id, tr.user_id) as b from test te join train tr on tr.item_id = te.item_id "
             "and tr.user_id <> te.user_id"),
    ("s", "select cand.*, coalesce(d.dot, 0.0) as dot, coalesce(d.co, 0) as co, "
          "coalesce(sa.n, 0) + coalesce(sb.n, 0) - coalesce(d.co, 0) as un from cand "
          "left join st sa on sa.e = cand.a left join st sb on sb.e = cand.b "
          "left join dots d on d.a = cand.a and d.b = cand.b"),
    ("s2", "select *, cast(case when un = 0 then 0.0 else dot / un end as decimal(18,9)) as sim from s"),
]


@query("agg25_signed_overlap", with_views("folds", extra=_LD_CTES)
       + "select distinct a, b, cast((co + dot) / 2 as bigint) as agree, cast((co - dot) / 2 as bigint) as disagree, "
         "un as n_union, cast(round(sim, 6) as double) + 0.0 as sim from s2")
def agg25_signed_overlap(spark, sf_dir):
    """AGG-25 / SIM-7: per requested user pair, agreements (LL+DD), disagreements
    (LD+DL), union of rated items and the signed similarity (fold 1 train)."""
    return _signed_overlap(spark, sf_dir, (1,)).drop("fold")


@query("agg25_signed_overlap_folds", with_views("folds", extra=[
    _BIN,
    ("train", "select f.fold, r.user_id, r.item_id, r.label from binfolds r "
              "join (select unnest([1,2,3,4,5]) as fold) f on r.fold <> f.fold"),
    ("pairs", "select distinct te.fold, least(te.user_id, tr.user_id) as a, greatest(te.user_id, tr.user_id) as b from binfolds te "
              "join train tr on tr.fold = te.fold and tr.item_id = te.item_id and tr.user_id <> te.user_id"),
    ("st", "select fold, user_id as e, count(*) as n from train group by 1, 2"),
    ("dots", "select x.fold, x.user_id as a, y.user_id as b, sum(case when x.label = y.label then 1 else 0 end) as agree, "
             "sum(case when x.label = y.label then 0 else 1 end) as disagree from train x "
             "join train y on x.fold = y.fold and x.item_id = y.item_id and x.user_id < y.user_id group by 1, 2, 3"),
    ("s", "select p.fold, p.a, p.b, coalesce(d.agree, 0) as agree, coalesce(d.disagree, 0) as disagree, "
          "coalesce(sa.n, 0) + coalesce(sb.n, 0) - coalesce(d.agree + d.disagree, 0) as un from pairs p "
          "left join st sa on sa.fold = p.fold and sa.e = p.a left join st sb on sb.fold = p.fold and sb.e = p.b "
          "left join dots d on d.fold = p.fold and d.a = p.a and d.b = p.b")])
       + "select fold, a, b, cast(agree as bigint) as agree, cast(disagree as bigint) as disagree, cast(un as bigint) as n_union, "
         "cast(round(cast(case when un = 0 then 0.0 else cast(agree - disagree as double) / un end as decimal(18,9)), 6) as double) + 0.0 as sim from s")
def agg25_signed_overlap_folds(spark, sf_dir):
    """AGG-25 / SIM-7: the same for the requested user pairs of every fold."""
    return _signed_overlap(spark, sf_dir, range(1, views.N_FOLDS + 1))


def _signed_overlap(spark, sf_dir, folds):
    none = F.lit(None).cast("double")
    rows = binary_folds(spark, sf_dir).select("fold", "user_id", "item_id", F.col("label").cast("double").alias("v"), none.alias("b"), none.alias("cp"))
    g = gram_entries(materialize(rows, "labels"), "user_id", "item_id", folds)
    union = F.col("n_a") + F.col("n_b") - F.col("co")
    sim = dec(F.when(union == 0, F.lit(0.0)).otherwise(F.col("dot") / union))
    return g.select("fold", "a", "b", ((F.col("co") + F.col("dot")) / 2).cast("bigint").alias("agree"), ((F.col("co") - F.col("dot")) / 2).cast("bigint").alias("disagree"),
                    union.alias("n_union"), r6_dec(sim).alias("sim"))


@query("job8_like_dislike_fold1", with_views("folds", extra=_LD_CTES + [
    ("agg", "select user_id, item_id, avg(lv * sim) as pred from s2 group by 1, 2")])
       + "select te.user_id, te.item_id, te.label, round(coalesce(cast(agg.pred as double), 0.0), 6) + 0.0 as pred "
         "from test te left join agg on agg.user_id = te.user_id and agg.item_id = te.item_id")
def job8_like_dislike_fold1(spark, sf_dir):
    """JOB-8 / SNK-11 content: signed-similarity score next to the true label, fold 1
    (train-only matrix, SURVEY D13; intended bracket, D14)."""
    return _ld_variant(spark, sf_dir, False, False)


def _knn_preds(spark, sf_dir, distance="cos"):
    return knn.knn_classify_folds(binary_folds(spark, sf_dir), k=10, distance=distance)


def _knn_sql(distance="cos"):
    if distance == "euc":
        dist = ("cast(sqrt(greatest(coalesce(sa.sq, 0.0) + coalesce(sb.sq, 0.0) - 2 * coalesce(dd.dot, 0.0), 0.0)) "
                "as decimal(18,9))")
    elif distance == "share":
        norms = "(coalesce(sa.sq, 0.0) + coalesce(sb.sq, 0.0))"
        dist = f"cast(case when {norms} = 0 then 0.0 else ({norms} - 2 * coalesce(dd.dot, 0.0)) / {norms} end as decimal(18,9))"
    else:
        dist = ("cast(case when coalesce(sa.sq, 0.0) = 0 or coalesce(sb.sq, 0.0) = 0 then -1.0 else "
                "1 - coalesce(dd.dot, 0.0) / sqrt(sa.sq * sb.sq) end as decimal(18,9))")
    return with_views("folds", extra=[
        _BIN,
        ("train", "select f.fold, r.user_id, r.item_id, r.label from binfolds r "
                  "join (select unnest([1,2,3,4,5]) as fold) f on r.fold <> f.fold"),
        ("test", "select fold, user_id, item_id, label from binfolds"),
        ("st", "select fold, item_id as e, count(*) as n, sum(cast(label as double) * label) as sq "
               "from train group by 1, 2"),
        ("dots", "select x.fold, x.item_id as a, y.item_id as b, sum(cast(x.label as double) * y.label) as dot "
                 "from train x join train y on x.fold = y.fold and x.user_id = y.user_id and x.item_id < y.item_id "
                 "group by 1, 2, 3"),
        ("cand", "select te.fold, te.user_id, te.item_id, tr.item_id as nbr, tr.label as lv, "
                 "least(te.item_id, tr.item_id) as a, greatest(te.item_id, tr.item_id) as b from test te "
                 "join train tr on tr.fold = te.fold and tr.user_id = te.user_id and tr.item_id <> te.item_id"),
        ("d", f"select cand.*, {dist} as dist from cand left join st sa on sa.fold = cand.fold and sa.e = cand.a "
              "left join st sb on sb.fold = cand.fold and sb.e = cand.b left join dots dd on dd.fold = cand.fold "
              "and dd.a = cand.a and dd.b = cand.b"),
        ("ranked", "select *, row_number() over (partition by fold, user_id, item_id order by dist, nbr) as rn from d"),
        ("votes", "select fold, user_id, item_id, sum(case when lv = 1 then 1 else 0 end) as likes, "
                  "sum(case when lv = 1 then 0 else 1 end) as dislikes from ranked where rn <= 10 group by 1, 2, 3"),
        ("pred", "select te.fold, te.label, case when coalesce(v.likes, 0) > coalesce(v.dislikes, 0) then 1 else -1 "
                 "end as pred from test te left join votes v on v.fold = te.fold and v.user_id = te.user_id "
                 "and v.item_id = te.item_id"),
        ("conf", "select fold, cast(sum(case when pred = 1 and label = 1 then 1 else 0 end) as bigint) as tp, "
                 "cast(sum(case when pred = 1 and label <> 1 then 1 else 0 end) as bigint) as fp, "
                 "cast(sum(case when pred <> 1 and label <> 1 then 1 else 0 end) as bigint) as tn, "
                 "cast(sum(case when pred <> 1 and label = 1 then 1 else 0 end) as bigint) as fn "
                 "from pred group by fold"),
        ("prf", "select *, case when tp + fp > 0 then tp / (tp + fp) end as precision, "
                "case when tp + fn > 0 then tp / (tp + fn) end as recall from conf"),
        ("prf1", "select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) "
                 "end as f1 from prf"),
    ])


@query("agg17_knn_confusion", _knn_sql() + "select fold, tp, fp, tn, fn from conf")
def agg17_knn_confusion(spark, sf_dir):
    """AGG-17 / AGG-19 / WIN-3 / SIM-12: confusion counts of the k-NN classifier per fold."""
    return confusion(_knn_preds(spark, sf_dir), ("fold",))


@query("job13_knn_fold_mean", _knn_sql() + "select round(avg(precision), 6) as precision, "
       "round(avg(recall), 6) as recall, round(avg(f1), 6) as f1 from prf1")
def job13_knn_fold_mean(spark, sf_dir):
    """JOB-13 / AGG-18 / AGG-16: precision, recall and F1 averaged over folds (k = 10)."""
    prf = precision_recall_f1(confusion(_knn_preds(spark, sf_dir), ("fold",)))
    m = fold_mean(prf, (), ("precision", "recall", "f1"))
    return rounded(m, ["precision", "recall", "f1"])


@query("job13_knn_euclidean", _knn_sql("euc") + "select round(avg(precision), 6) as precision, "
       "round(avg(recall), 6) as recall, round(avg(f1), 6) as f1 from prf1")
def job13_knn_euclidean(spark, sf_dir):
    """UDF-3 / D12: the same classifier with a real Euclidean distance."""
    prf = precision_recall_f1(confusion(_knn_preds(spark, sf_dir, "euc"), ("fold",)))
    m = fold_mean(prf, (), ("precision", "recall", "f1"))
    return rounded(m, ["precision", "recall", "f1"])


def share_of_sums(sums, a, b):
    """The same distance of a pair's sums, in billionths, for the block product."""
    both = a.q + b.q
    return nano(np.divide(both - 2 * sums["dot"], both, out=np.zeros_like(both), where=both != 0))


@query("udf3_custom_distance", _knn_sql("share") + "select fold, tp, fp, tn, fn from conf")
def udf3_custom_distance(spark, sf_dir):
    """UDF-3: the classifier with a distance registered by the caller: the squared distance as a share of both norms."""
    knn.DISTANCES["share"] = (lambda dot, a, b: F.when(a + b == 0, F.lit(0.0)).otherwise((a + b - 2 * dot) / (a + b)), False,
                              (("dot",), share_of_sums, False))
    return confusion(_knn_preds(spark, sf_dir, "share"), ("fold",))


def _ld_variant_sql(leaky: bool, as_written: bool) -> str:
    ctes = list(_LD_CTES)
    if leaky:
        ctes[1] = ("train", "select user_id, item_id, label from binfolds")
    if as_written:
        ctes[4] = ("dots", "select x.user_id as a, y.user_id as b, sum(cast(x.label as double) * y.label) as dot, "
                           "count(*) as co, sum(case when x.label = -1 and y.label = 1 then 1 else 0 end) as dl_ab, "
                           "sum(case when y.label = -1 and x.label = 1 then 1 else 0 end) as dl_ba from train x "
                           "join train y on x.item_id = y.item_id and x.user_id < y.user_id group by 1, 2")
        ctes[6] = ("s", "select cand.*, coalesce(d.dot, 0.0) + 2 * coalesce(case when cand.user_id = cand.a "
                        "then d.dl_ab else d.dl_ba end, 0) as dot, coalesce(d.co, 0) as co, "
                        "coalesce(sa.n, 0) + coalesce(sb.n, 0) - coalesce(d.co, 0) as un from cand "
                        "left join st sa on sa.e = cand.a left join st sb on sb.e = cand.b "
                        "left join dots d on d.a = cand.a and d.b = cand.b")
    return with_views("folds", extra=ctes + [
        ("agg", "select user_id, item_id, avg(lv * sim) as pred from s2 group by 1, 2")]) + (
        "select te.user_id, te.item_id, te.label, round(coalesce(cast(agg.pred as double), 0.0), 6) + 0.0 as pred "
        "from test te left join agg on agg.user_id = te.user_id and agg.item_id = te.item_id")


def _ld_variant(spark, sf_dir, leaky, as_written):
    s = knn.like_dislike_folds(binary_folds(spark, sf_dir), (1,), as_written, leaky=leaky)
    mean = F.when(F.col("n") > 0, F.round(F.col("total") * 1e9) / (F.col("n") * 1e9)).otherwise(F.lit(0.0))  # one division of whole numbers
    return s.select("user_id", "item_id", "label", r6(mean).alias("pred"))


@query("job8_like_dislike_as_written", _ld_variant_sql(False, True))
def job8_like_dislike_as_written(spark, sf_dir):
    """JOB-8 / SIM-7 with the reference's bracket as written."""
    return _ld_variant(spark, sf_dir, False, True)


@query("job8_like_dislike_leaky", _ld_variant_sql(True, True))
def job8_like_dislike_leaky(spark, sf_dir):
    """JOB-8 in full reference parity: matrix from all ratings incl. the test rows
    (SURVEY D13) and the bracket as written (D14)."""
    return _ld_variant(spark, sf_dir, True, True)


def _ld_folds_sql(as_written: bool, leaky: bool = False) -> str:
    sides = ("select f.fold, r.user_id, r.item_id, r.label from binfolds r join (select unnest([1,2,3,4,5]) as fold) f on "
             + ("true" if leaky else "r.fold <> f.fold"))
    dl = " + 2 * (case when te.user_id < tr.user_id then coalesce(d.dl_ab, 0) else coalesce(d.dl_ba, 0) end)" if as_written else ""
    return with_views("folds", extra=[
        _BIN, ("train", sides),
        ("st", "select fold, user_id as e, count(*) as n from train group by 1, 2"),
        ("dots", "select x.fold, x.user_id as a, y.user_id as b, sum(cast(x.label as double) * y.label) as dot, count(*) as co, "
                 "sum(case when x.label = -1 and y.label = 1 then 1 else 0 end) as dl_ab, sum(case when y.label = -1 and x.label = 1 then 1 else 0 end) as dl_ba "
                 "from train x join train y on x.fold = y.fold and x.item_id = y.item_id and x.user_id < y.user_id group by 1, 2, 3"),
        ("s", "select te.fold, te.user_id, te.item_id, tr.label as lv, coalesce(sa.n, 0) + coalesce(sb.n, 0) - coalesce(d.co, 0) as un, "
              f"coalesce(d.dot, 0.0){dl} as num from binfolds te join train tr on tr.fold = te.fold and tr.item_id = te.item_id and tr.user_id <> te.user_id "
              "left join st sa on sa.fold = te.fold and sa.e = te.user_id left join st sb on sb.fold = te.fold and sb.e = tr.user_id "
              "left join dots d on d.fold = te.fold and d.a = least(te.user_id, tr.user_id) and d.b = greatest(te.user_id, tr.user_id)"),
        # in whole billionths: the mean is then rounded to six places exactly, halves away from zero
        ("agg", "select fold, user_id, item_id, count(*) as n, sum(lv * cast(cast(case when un = 0 then 0.0 else num / un end as decimal(18,9)) * 1000000000 as bigint)) as total "
                "from s group by 1, 2, 3"),
    ]) + ("select te.fold, te.user_id, te.item_id, te.label, coalesce(sign(agg.total) * ((2 * abs(agg.total) + 1000 * agg.n) // (2000 * agg.n)) / 1000000, 0.0) + 0.0 as pred from binfolds te "
          "left join agg on agg.fold = te.fold and agg.user_id = te.user_id and agg.item_id = te.item_id")


def _ld_folds(spark, sf_dir, as_written):
    s = knn.like_dislike_folds(binary_folds(spark, sf_dir), range(1, views.N_FOLDS + 1), as_written)
    pred = F.expr("coalesce(sign(total) * ((2 * abs(total) + 1000 * n) div (2000 * n)) / 1000000, 0D) + 0D")
    return s.withColumn("total", F.round(F.col("total") * 1e9).cast("long")).select("fold", "user_id", "item_id", "label", pred.alias("pred"))


@query("job8_like_dislike_folds", _ld_folds_sql(False))
def job8_like_dislike_folds(spark, sf_dir):
    """JOB-8 / SIM-7: signed-similarity score next to the true label, for every rating through the folds without it."""
    return _ld_folds(spark, sf_dir, False)


@query("job8_like_dislike_as_written_folds", _ld_folds_sql(True))
def job8_like_dislike_as_written_folds(spark, sf_dir):
    """The same with the reference's bracket as written."""
    return _ld_folds(spark, sf_dir, True)

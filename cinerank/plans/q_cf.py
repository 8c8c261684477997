"""Neighbourhood CF queries (JOB-1..JOB-4, SIM-1..SIM-6) and their oracles."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from cinerank.functions.scalar import dec, r6
from cinerank.operators import neighbours as nb
from cinerank.operators.block_product import nano
from cinerank.operators.evaluate import error_metrics, fold_mean, rounded
from cinerank.operators.similarity import pair_stats, register_similarity
from cinerank.plans.oracle_views import with_views
from cinerank.plans.registry import query
from cinerank.sources import views

METRICS = ["rmse", "mae", "sqrt_mae"]


def cf_metrics(spark, sf_dir, mode, kind, only=None, ks=nb.DEFAULT_KS, content=None,
               p=nb.DEFAULT_P, mean_over_folds=False):
    folds = views.folds(spark, sf_dir)
    c = content(spark, sf_dir) if content is not None else None
    preds = nb.predict_folds(folds, mode=mode, kind=kind, ks=ks, folds=range(1, 6) if only is None else (only,), content=c, p=p)
    m = error_metrics(preds, ("fold", "k"))
    if mean_over_folds:
        return rounded(fold_mean(m, ("k",)), METRICS)
    return rounded(m, METRICS)


def cf_sql(mode: str, kind: str, only: int | None = None, ks=nb.DEFAULT_KS,
           content_cte: list[tuple[str, str]] | None = None, content_views=(),
           p: float = nb.DEFAULT_P, mean_over_folds: bool = False, pre_ctes=(),
           cells_k: int | None = None) -> str:
    """Brute-force oracle: the full co-rating self join (every pair), then the
    same ranking and prediction rules."""
    T, C = ("item_id", "user_id") if mode == "item" else ("user_id", "item_id")
    if only is not None:
        train = f"select {only} as fold, user_id, item_id, score from folds where fold <> {only}"
        test = f"select fold, user_id, item_id, score from folds where fold = {only}"
    else:
        train = ("select f.fold, r.user_id, r.item_id, r.score from folds r "
                 "join (select unnest([1,2,3,4,5]) as fold) f on r.fold <> f.fold")
        test = "select fold, user_id, item_id, score from folds"
    if kind == "pears":
        mean_tab, mean_col = ("im", "i_mean") if mode == "item" else ("um", "u_mean")
        vals = (f"select t.fold, t.{T} as e, t.{C} as c, t.score - m.{mean_col} as v "
                f"from train t join {mean_tab} m on m.fold = t.fold and m.{T} = t.{T}")
    else:
        vals = f"select fold, {T} as e, {C} as c, score as v from train"
    if kind == "jac":
        co = "coalesce(d.co, 0)"
        un = f"(coalesce(sa.n, 0) + coalesce(sb.n, 0) - {co})"
        simx = f"cast(case when {un} = 0 then 0.0 else {co} / {un} end as decimal(18,9))"
        zero = "false"
    elif kind == "dice":
        both = "(coalesce(sa.n, 0) + coalesce(sb.n, 0))"
        simx = f"cast(case when {both} = 0 then 0.0 else 2 * coalesce(d.co, 0) / {both} end as decimal(18,9))"
        zero = "false"
    else:
        zero = "(coalesce(sa.sq, 0.0) = 0 or coalesce(sb.sq, 0.0) = 0)"
        simx = (f"cast(case when {zero} then -1.0 else coalesce(d.dot, 0.0) / sqrt(sa.sq * sb.sq) end "
                f"as decimal(18,9))")
    if mode == "item":
        cand = ("select te.fold, te.user_id, te.item_id, trb.item_id as nbr, trb.dev from test te "
                "join trb on te.fold = trb.fold and te.user_id = trb.user_id and trb.item_id <> te.item_id")
        tgt = "item_id"
        den = "sum(r.sim)"
    else:
        cand = ("select te.fold, te.user_id, te.item_id, trb.user_id as nbr, trb.dev from test te "
                "join trb on te.fold = trb.fold and te.item_id = trb.item_id and trb.user_id <> te.user_id")
        tgt = "user_id"
        den = "sum(abs(r.sim))"
    blend_join, sim_final = "", "sim0"
    if content_cte:
        blend_join = "left join content ct on ct.a = s.a and ct.b = s.b"
        sim_final = (f"case when s.zero_norm then s.sim0 else cast({p} * coalesce(cast(ct.csim as double), 0.0) "
                     f"+ {1.0 - p} * cast(s.sim0 as double) as decimal(18,9)) end")
    ks_list = ", ".join(str(k) for k in sorted(ks))
    ctes = [
        *pre_ctes,
        ("train", train), ("test", test),
        ("mu", "select fold, avg(score) as mu from train group by fold"),
        ("um", "select fold, user_id, avg(score) as u_mean from train group by fold, user_id"),
        ("im", "select fold, item_id, avg(score) as i_mean from train group by fold, item_id"),
        ("vals", vals),
        ("st", "select fold, e, count(*) as n, sum(v * v) as sq from vals group by fold, e"),
        ("dots", "select x.fold, x.e as a, y.e as b, sum(x.v * y.v) as dot, count(*) as co from vals x "
                 "join vals y on x.fold = y.fold and x.c = y.c and x.e < y.e group by 1, 2, 3"),
        ("trb", "select tr.fold, tr.user_id, tr.item_id, tr.score - ((coalesce(um.u_mean, 0.0) "
                "+ coalesce(im.i_mean, 0.0)) - coalesce(mu.mu, 0.0)) as dev from train tr "
                "left join mu on mu.fold = tr.fold left join um on um.fold = tr.fold and um.user_id = tr.user_id "
                "left join im on im.fold = tr.fold and im.item_id = tr.item_id"),
        ("cand", cand),
        ("s", f"select cand.*, least(cand.{tgt}, cand.nbr) as a, greatest(cand.{tgt}, cand.nbr) as b, "
              f"{simx} as sim0, {zero} as zero_norm from cand "
              f"left join st sa on sa.fold = cand.fold and sa.e = least(cand.{tgt}, cand.nbr) "
              f"left join st sb on sb.fold = cand.fold and sb.e = greatest(cand.{tgt}, cand.nbr) "
              f"left join dots d on d.fold = cand.fold and d.a = least(cand.{tgt}, cand.nbr) "
              f"and d.b = greatest(cand.{tgt}, cand.nbr)"),
        *(content_cte or []),
        ("sims", f"select s.fold, s.user_id, s.item_id, s.nbr, s.dev, {sim_final} as sim from s {blend_join}"),
        ("ranked", "select *, row_number() over (partition by fold, user_id, item_id "
                   "order by sim desc, nbr asc) as rn from sims"),
        ("ks", f"select unnest([{ks_list}]) as k"),
        ("agg", f"select r.fold, r.user_id, r.item_id, ks.k, sum(cast(r.sim as double) * r.dev) as num, "
                f"{den} as den from ranked r join ks on r.rn <= ks.k group by 1, 2, 3, 4"),
        ("base", "select te.fold, te.user_id, te.item_id, te.score, ks.k, (coalesce(um.u_mean, 0.0) "
                 "+ coalesce(im.i_mean, 0.0)) - coalesce(mu.mu, 0.0) as b from test te cross join ks "
                 "left join mu on mu.fold = te.fold left join um on um.fold = te.fold and um.user_id = te.user_id "
                 "left join im on im.fold = te.fold and im.item_id = te.item_id"),
        ("pred", "select base.fold, base.user_id, base.item_id, base.k, base.score, least(greatest(case when agg.den is not null and "
                 "agg.den <> 0 then base.b + agg.num / cast(agg.den as double) else base.b end, 1.0), 5.0) "
                 "as pred from base left join agg on agg.fold = base.fold and agg.user_id = base.user_id "
                 "and agg.item_id = base.item_id and agg.k = base.k"),
        ("m", "select fold, k, sqrt(avg((pred - score) * (pred - score))) as rmse, avg(abs(pred - score)) as mae, "
              "count(*) as n from pred group by fold, k"),
    ]
    head = with_views("folds", *content_views, extra=ctes)
    if cells_k is not None:
        return head + (f"select user_id, item_id, round(pred, 6) + 0.0 as pred from pred "
                       f"where k = {int(cells_k)}")
    if mean_over_folds:
        return head + ("select k, round(avg(rmse), 6) as rmse, round(avg(mae), 6) as mae, "
                       "round(avg(sqrt(mae)), 6) as sqrt_mae from m group by k")
    return head + ("select fold, k, round(rmse, 6) as rmse, round(mae, 6) as mae, "
                   "round(sqrt(mae), 6) as sqrt_mae, n from m")


# --- minimum slice: entry query -------------------------------------------------

@query("job2_item_item_pears_fold1", cf_sql("item", "pears", only=1))
def job2_item_item_pears_fold1(spark, sf_dir):
    """JOB-2 fold 1: item-item, item-centred cosine, k in {2,5,10,20} (JOI-11 neighbour rows,
    WIN-2 one ranking for every k, AGG-15 / SCL-2 rmse, mae, sqrt(mae))."""
    return cf_metrics(spark, sf_dir, "item", "pears", only=1)


@query("job2_item_item_cos", cf_sql("item", "cos"))
def job2_item_item_cos(spark, sf_dir):
    """SIM-1 / JOB-2 / UDF-2: raw cosine picked by name from the similarity registry,
    all five folds in one job (AGG-15, WIN-2)."""
    return cf_metrics(spark, sf_dir, "item", "cos")


@query("agg16_item_item_pears_fold_mean", cf_sql("item", "pears", mean_over_folds=True))
def agg16_item_item_pears_fold_mean(spark, sf_dir):
    """SIM-2 / JOB-2 / AGG-16: centred cosine, metrics averaged over folds."""
    return cf_metrics(spark, sf_dir, "item", "pears", mean_over_folds=True)


@query("job2_item_item_jac", cf_sql("item", "jac"))
def job2_item_item_jac(spark, sf_dir):
    """SIM-3: Jaccard of rater sets, all folds."""
    return cf_metrics(spark, sf_dir, "item", "jac")


@query("job4_item_item_jac_top10", cf_sql("item", "jac", ks=(2, 5, 10), mean_over_folds=True))
def job4_item_item_jac_top10(spark, sf_dir):
    """JOB-4: Jaccard item-item at top 2, 5 and 10, averaged over the folds."""
    return cf_metrics(spark, sf_dir, "item", "jac", ks=(2, 5, 10), mean_over_folds=True)


@query("job3_user_user_cos", cf_sql("user", "cos"))
def job3_user_user_cos(spark, sf_dir):
    """SIM-4 / JOB-3: user-user raw cosine, |s| denominator."""
    return cf_metrics(spark, sf_dir, "user", "cos")


@query("job3_user_user_pears", cf_sql("user", "pears"))
def job3_user_user_pears(spark, sf_dir):
    """SIM-5: user-user cosine of user-mean-centred rows."""
    return cf_metrics(spark, sf_dir, "user", "pears")


@query("job3_user_user_jac", cf_sql("user", "jac", mean_over_folds=True))
def job3_user_user_jac(spark, sf_dir):
    """SIM-6: user-user Jaccard of rated-item sets, fold mean."""
    return cf_metrics(spark, sf_dir, "user", "jac", mean_over_folds=True)


def dice(values, pairs, entity, context, part=()):
    """A similarity that the library lacks, as a user would write it: twice the common raters over both items' raters."""
    both = F.col("n_a") + F.col("n_b")
    sim = F.when(both == 0, F.lit(0.0)).otherwise(2 * F.col("co") / both)
    stats = pair_stats(values, pairs, entity, context, "v", part)
    return stats.select(*part, "a", "b", dec(sim).alias("sim"), F.lit(False).alias("zero_norm"))


def dice_of_sums(sums, a, b):
    """The same of a pair's sums, in billionths, for the block product."""
    both = a.n + b.n
    return nano(np.divide(2 * sums["co"], both, out=np.zeros_like(both), where=both != 0))


@query("udf2_custom_similarity", cf_sql("item", "dice", only=1))
def udf2_custom_similarity(spark, sf_dir):
    """UDF-2: item-item prediction of fold 1 with a similarity registered by the caller (Dice)."""
    register_similarity("dice", dice, (("co",), dice_of_sums, True))
    return cf_metrics(spark, sf_dir, "item", "dice", only=1)


@query("udf2_custom_similarity_folds", cf_sql("item", "dice"))
def udf2_custom_similarity_folds(spark, sf_dir):
    """UDF-2: the same for every fold."""
    register_similarity("dice", dice, (("co",), dice_of_sums, True))
    return cf_metrics(spark, sf_dir, "item", "dice")


def fold1_predictions(spark, sf_dir, mode="item", kind="pears"):
    """SNK-1 content: fold-1 predictions for the largest k."""
    preds = nb.predict_folds(views.folds(spark, sf_dir), mode=mode, kind=kind, folds=(1,))
    kmax = max(nb.DEFAULT_KS)
    return preds.where(F.col("k") == kmax).select("user_id", "item_id", r6("pred").alias("pred"))

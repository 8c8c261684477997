"""Content-based queries (JOB-5, JOB-7, JOB-9..12, SIM-8/9, WIN-7, SRT-1, FLT-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinerank.functions.scalar import r6
from cinerank.operators import content as cb
from cinerank.operators import neighbours as nb
from cinerank.operators.evaluate import fold_mean, rounded
from cinerank.plans.oracle_views import with_views
from cinerank.plans.q_cf import cf_metrics, cf_sql
from cinerank.plans.q_prep import FOLK_VIEWS, folk_ctes, item_tags
from cinerank.plans.registry import query
from cinerank.session import bucketed, materialize, staged
from cinerank.sources import views


def content_tables(spark, sf_dir):
    """(vocab, item profiles, features), staged once per session."""
    def feats():
        return cb.feature_values(views.movies(spark, sf_dir), views.people(spark, sf_dir), item_tags(spark, sf_dir))

    features = staged(spark, f"features:{sf_dir}", feats)

    def vocab():
        return cb.vocabulary(features, item_tags(spark, sf_dir))

    voc = staged(spark, f"vocab:{sf_dir}", vocab)
    iprof = staged(spark, f"iprof:{sf_dir}", lambda: cb.item_profiles(features, voc)[0])
    return voc, iprof, features


_CONTENT_CTES = [
    ("tagged", "select item_id, user_id, tag from surviving where item_id in (select item_id from kept)"),
    ("feat", "select * from (select item_id, 'year' as kind, year as value from movies "
             "union select item_id, kind, trim(person) as value from people "
             "union select item_id, 'genre' as kind, trim(g) as value from movies, "
             "unnest(string_split(genres, '|')) as t(g) "
             "union select item_id, 'tag' as kind, tag as value from tagged) x where length(value) > 0"),
    ("vocab", "select kind, value, row_number() over (order by kind_rank, value) as idx from ("
              "select distinct kind, value, case kind when 'year' then 1 when 'director' then 2 "
              "when 'actor' then 3 when 'genre' then 4 else 5 end as kind_rank from feat "
              "where kind in ('genre', 'tag') or item_id in (select item_id from tagged)) v"),
    ("iprof", "select distinct f.item_id, v.idx, 1.0 as weight from feat f join vocab v "
              "on v.kind = f.kind and v.value = f.value"),
]


CONTENT_VIEWS = FOLK_VIEWS + ("people", "folds")


def content_ctes(*extra):
    return folk_ctes() + _CONTENT_CTES + list(extra)


def _content_sql(*extra):
    return with_views(*CONTENT_VIEWS, extra=content_ctes(*extra))


@query("win7_vocabulary", (_content_sql()) + "select kind, value, idx from vocab")
def win7_vocabulary(spark, sf_dir):
    """WIN-7 / SET-2 / SET-3 / SNK-7: vocabulary with a running index from 1."""
    voc, _, _ = content_tables(spark, sf_dir)
    return voc.select("kind", "value", "idx")


@query("srt1_sorted_values", (_content_sql())
       + "select kind, value, row_number() over (partition by kind order by value) as pos from vocab")
def srt1_sorted_values(spark, sf_dir):
    """SRT-1: sorted distinct values per kind (position within kind from the global index)."""
    voc, _, _ = content_tables(spark, sf_dir)
    first = voc.groupBy("kind").agg(F.min("idx").alias("_first"))
    return voc.join(F.broadcast(first), "kind").select(  # one row per kind (5)
        "kind", "value", (F.col("idx") - F.col("_first") + 1).alias("pos"))


@query("job9_item_profiles", (_content_sql()) + "select item_id, idx, weight from iprof")
def job9_item_profiles(spark, sf_dir):
    """JOB-9: one-hot item profiles over year, directors, actors, genres, tags."""
    _, iprof, _ = content_tables(spark, sf_dir)
    return iprof.select("item_id", "idx", "weight")


@query("flt4_vocab_rejects", (_content_sql())
       + "select f.kind, count(*) as n_rejects from feat f anti join vocab v on v.kind = f.kind "
         "and v.value = f.value group by f.kind")
def flt4_vocab_rejects(spark, sf_dir):
    """FLT-4: feature values missing from the vocabulary, counted per kind."""
    voc, _, features = content_tables(spark, sf_dir)
    _, rejects = cb.item_profiles(features, voc)
    return rejects.groupBy("kind").agg(F.count(F.lit(1)).alias("n_rejects"))


@query("job10_user_profiles_a", (_content_sql(
    ("n", "select user_id, count(*) as n from ratings group by user_id"),
    ("s", "select r.user_id, p.idx, sum(r.score) as s from ratings r join iprof p on p.item_id = r.item_id "
          "group by 1, 2")))
       + "select s.user_id, s.idx, round(s.s / n.n, 6) as weight from s join n on n.user_id = s.user_id")
def job10_user_profiles_a(spark, sf_dir):
    """JOB-10 / AGG-20 / JOI-12: sum of scores / number of items rated."""
    _, iprof, _ = content_tables(spark, sf_dir)
    up = cb.user_profiles(views.ratings(spark, sf_dir), iprof, "A")
    return up.select("user_id", "idx", r6("weight").alias("weight"))


@query("job10_user_profiles_b", (_content_sql())
       + "select r.user_id, p.idx, round(avg(r.score), 6) as weight from ratings r "
         "join iprof p on p.item_id = r.item_id group by 1, 2")
def job10_user_profiles_b(spark, sf_dir):
    """JOB-10 / AGG-21: mean score over rated items having the feature."""
    _, iprof, _ = content_tables(spark, sf_dir)
    up = cb.user_profiles(views.ratings(spark, sf_dir), iprof, "B")
    return up.select("user_id", "idx", r6("weight").alias("weight"))


def _cb_scores(spark, sf_dir, only=None):
    folds = views.folds(spark, sf_dir)
    cells = folds if only is None else folds.where(F.col("fold") == only)
    return cb.content_scores_by_fold(cells, *profile_store(spark, sf_dir))


def profile_buckets(ratings: int) -> int:
    """As many buckets as the ratings need: a task sorts and reads the profiles of about 60,000, some 60 kB for a user of 40."""
    return max(16, -(-ratings // 60_000))


def profile_store(spark, sf_dir):
    """SNK-8 / SRC-12: user and item profiles and their norms, stored once per session in buckets of the keys they are joined by."""
    _, iprof, _ = content_tables(spark, sf_dir)
    n = profile_buckets(views.folds(spark, sf_dir).count())
    items = bucketed(spark, f"item_profiles:{sf_dir}", lambda: iprof, ("item_id",), n)
    users = bucketed(spark, f"user_profiles:{sf_dir}", lambda: cb.user_profiles_by_fold(views.folds(spark, sf_dir), items, views.N_FOLDS, n),
                     ("user_id",), n, dealt=True)
    norms = [bucketed(spark, f"norms{k}:{sf_dir}", lambda k=k: cb.profile_norms(users, items)[k], (key,), n) for k, key in enumerate(("user_id", "item_id"))]
    return users, items, views.N_FOLDS, norms, n


def _cb_preview(spark, sf_dir, n=20):
    """The first ``n`` fold-1 cells in (user, item) order, scored: profiles are built for their users only."""
    _, iprof, _ = content_tables(spark, sf_dir)
    train, test = nb.fold_sides(views.folds(spark, sf_dir), only=1)
    cells = materialize(test.orderBy("user_id", "item_id").limit(n), "preview_cells")
    mine = train.join(F.broadcast(cells.select("user_id").distinct()), "user_id", "left_semi")  # n rows at most
    return cb.content_scores(cells, cb.user_profiles(mine, iprof, "B", part=["fold"]), iprof, part=["fold"])


_CB_CTES = [
    ("train", "select f.fold, r.user_id, r.item_id, r.score from folds r "
              "join (select unnest([1,2,3,4,5]) as fold) f on r.fold <> f.fold"),
    ("test", "select fold, user_id, item_id, score from folds"),
    ("up", "select t.fold, t.user_id, p.idx, avg(t.score) as weight from train t "
           "join iprof p on p.item_id = t.item_id group by 1, 2, 3"),
    ("tp", "select te.fold, te.user_id, te.item_id, p.idx, p.weight from test te "
           "join iprof p on p.item_id = te.item_id"),
    ("dots", "select tp.fold, tp.user_id, tp.item_id, sum(up.weight * tp.weight) as num from tp "
             "join up on up.fold = tp.fold and up.user_id = tp.user_id and up.idx = tp.idx group by 1, 2, 3"),
    ("un", "select fold, user_id, sqrt(sum(weight * weight)) as u_norm from up group by 1, 2"),
    ("inn", "select item_id, sqrt(sum(weight * weight)) as i_norm from iprof group by 1"),
    ("sc", "select te.fold, te.user_id, te.item_id, te.score, case when coalesce(un.u_norm, 0.0) * "
           "coalesce(inn.i_norm, 0.0) = 0 then 0.0 else coalesce(d.num, 0.0) / (un.u_norm * inn.i_norm) end "
           "as cos from test te left join dots d on d.fold = te.fold and d.user_id = te.user_id and "
           "d.item_id = te.item_id left join un on un.fold = te.fold and un.user_id = te.user_id "
           "left join inn on inn.item_id = te.item_id"),
    ("scored", "select *, (cos - 0.0) / 1.0 * 4.0 + 1.0 as pred from sc"),
    ("m", "select fold, sqrt(avg((pred - score) * (pred - score))) as rmse, count(*) as n "
          "from scored group by fold"),
]


@query("job11_content_rmse", (_content_sql(*_CB_CTES))
       + "select fold, round(rmse, 6) as rmse, n from m")
def job11_content_rmse(spark, sf_dir):
    """JOB-11 / JOI-13 / PRJ-3: cosine(user, item profile) -> 4 cos + 1 -> RMSE per fold."""
    s = _cb_scores(spark, sf_dir)
    e = F.col("pred") - F.col("score")
    m = s.groupBy("fold").agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.count(F.lit(1)).alias("n"))
    return rounded(m, ["rmse"])


@query("agg16_content_rmse_mean", (_content_sql(*_CB_CTES))
       + "select round(avg(rmse), 6) as rmse from m")
def agg16_content_rmse_mean(spark, sf_dir):
    """AGG-16 for JOB-11: true mean over the five folds."""
    s = _cb_scores(spark, sf_dir)
    e = F.col("pred") - F.col("score")
    m = s.groupBy("fold").agg(F.sqrt(F.avg(e * e)).alias("rmse"))
    return rounded(fold_mean(m, (), ("rmse",)), ["rmse"])


@query("job12_content_preview", (_content_sql(*_CB_CTES))
       + "select user_id, item_id, round(cos, 6) as pred_raw, round(pred, 6) as pred from scored "
         "where fold = 1 order by user_id, item_id limit 20")
def job12_content_preview(spark, sf_dir):
    """JOB-12 / SRT-3 / SNK-3: first 20 fold-1 scores (raw and rescaled) in (user, item) order."""
    s = _cb_preview(spark, sf_dir)
    return (s.orderBy("user_id", "item_id")
            .select("user_id", "item_id", r6("pred_raw").alias("pred_raw"), r6("pred").alias("pred")))


# --- hybrids ------------------------------------------------------------------

def _item_profile_sim(kind):
    def content(spark, sf_dir):
        _, iprof, _ = content_tables(spark, sf_dir)
        return cb.profile_similarity(iprof, "item_id", kind)
    return content


def _user_profile_jac(spark, sf_dir):
    return _user_profile_sim(spark, sf_dir, "jac")


def _user_profile_sim(spark, sf_dir, kind="cos"):
    _, iprof, _ = content_tables(spark, sf_dir)
    up = staged(spark, f"uprofA:{sf_dir}", lambda: cb.user_profiles(views.ratings(spark, sf_dir), iprof, "A"))
    return cb.profile_similarity(up, "user_id", kind)


_ICOS = ("content", "select x.item_id as a, y.item_id as b, sum(x.weight * y.weight) / sqrt(max(nx.sq) * "
                    "max(ny.sq)) as csim from iprof x join iprof y on x.idx = y.idx and x.item_id < y.item_id "
                    "join (select item_id, sum(weight * weight) as sq from iprof group by 1) nx on nx.item_id = "
                    "x.item_id join (select item_id, sum(weight * weight) as sq from iprof group by 1) ny on "
                    "ny.item_id = y.item_id group by 1, 2")
_IJAC = ("content", "select x.item_id as a, y.item_id as b, count(*) / (max(nx.n) + max(ny.n) - count(*)) as csim "
                    "from iprof x join iprof y on x.idx = y.idx and x.item_id < y.item_id "
                    "join (select item_id, count(*) as n from iprof group by 1) nx on nx.item_id = x.item_id "
                    "join (select item_id, count(*) as n from iprof group by 1) ny on ny.item_id = y.item_id "
                    "group by 1, 2")
_UPROF_A = [("upn", "select user_id, count(*) as n from ratings group by user_id"),
            ("ups", "select r.user_id, p.idx, sum(r.score) as s from ratings r join iprof p "
                    "on p.item_id = r.item_id group by 1, 2"),
            ("upa", "select ups.user_id, ups.idx, ups.s / upn.n as weight from ups join upn "
                    "on upn.user_id = ups.user_id")]
_UCOS = ("content", "select x.user_id as a, y.user_id as b, sum(x.weight * y.weight) / sqrt(max(nx.sq) * "
                    "max(ny.sq)) as csim from upa x join upa y on x.idx = y.idx and x.user_id < y.user_id "
                    "join (select user_id, sum(weight * weight) as sq from upa group by 1) nx on nx.user_id = "
                    "x.user_id join (select user_id, sum(weight * weight) as sq from upa group by 1) ny on "
                    "ny.user_id = y.user_id group by 1, 2")
_UJAC = ("content", "select x.user_id as a, y.user_id as b, count(*) / (max(nx.n) + max(ny.n) - count(*)) as csim "
                    "from upa x join upa y on x.idx = y.idx and x.user_id < y.user_id "
                    "join (select user_id, count(*) as n from upa group by 1) nx on nx.user_id = x.user_id "
                    "join (select user_id, count(*) as n from upa group by 1) ny on ny.user_id = y.user_id "
                    "group by 1, 2")


def _hybrid_sql(mode, kind, content_ctes_):
    return cf_sql(mode, kind, content_cte=[content_ctes_[-1]], content_views=CONTENT_VIEWS,
                  pre_ctes=content_ctes(*content_ctes_[:-1]))


@query("job5_item_item_hybrid_cos", _hybrid_sql("item", "cos", [_ICOS]))
def job5_item_item_hybrid_cos(spark, sf_dir):
    """JOB-5 / SIM-8 / SIM-11 / JOI-10: item-item cosine blended with item-profile cosine
    (profile Gram entries for the candidate pairs only, p = 0.5)."""
    return cf_metrics(spark, sf_dir, "item", "cos", content=_item_profile_sim("cos"))


@query("job5_item_item_hybrid_jac", _hybrid_sql("item", "jac", [_IJAC]))
def job5_item_item_hybrid_jac(spark, sf_dir):
    """JOB-5 / SIM-9: item-item Jaccard blended with profile Jaccard."""
    return cf_metrics(spark, sf_dir, "item", "jac", content=_item_profile_sim("jac"))


@query("job7_user_user_hybrid", _hybrid_sql("user", "pears", _UPROF_A + [_UCOS]))
def job7_user_user_hybrid(spark, sf_dir):
    """JOB-7 / JOI-10: user-user centred cosine blended with user-profile cosine (variant A, D4: the Gram)."""
    return cf_metrics(spark, sf_dir, "user", "pears", content=_user_profile_sim)


@query("job7_user_user_hybrid_jac", _hybrid_sql("user", "jac", _UPROF_A + [_UJAC]))
def job7_user_user_hybrid_jac(spark, sf_dir):
    """JOB-7 / SIM-9: user-user Jaccard blended with the Jaccard of the user profiles."""
    return cf_metrics(spark, sf_dir, "user", "jac", content=_user_profile_jac)

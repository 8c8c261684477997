"""Preparation queries: folksonomy, dataset filter, support filter, JSON, sets."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinerank.functions.scalar import normalise_title
from cinerank.operators import prep
from cinerank.plans.oracle_views import with_views
from cinerank.plans.registry import query
from cinerank.session import staged
from cinerank.sources import views


def build_folksonomy(spark, sf_dir, **kw):
    r = views.ratings(spark, sf_dir)
    return prep.folksonomy(views.tags(spark, sf_dir), views.tags(spark, sf_dir, big=True),
                           views.movies(spark, sf_dir), r.select("user_id"), **kw)


def item_tags(spark, sf_dir):
    """The surviving (item_id, user_id, tag) rows of kept items, and the item side they come from, written once per session."""
    def build():
        return build_folksonomy(spark, sf_dir, once=lambda rows, name: staged(spark, f"{name}:{sf_dir}", lambda: rows)).item_tags
    return staged(spark, f"item_tags:{sf_dir}", build)


_FOLK_CTES = [
    ("item_side", "select item_id, user_id, tag from tags union "
                  "select item_id, user_id, tag from tags_big where item_id in (select item_id from movies)"),
    ("user_side", "select user_id, tag from tags union select user_id, tag from tags_big "
                  "where user_id in (select user_id from ratings)"),
    ("active", "select user_id, count(*) as n_tags from user_side group by user_id having count(*) >= 4"),
    ("tag_counts", "select tag, count(*) as n from item_side group by tag having count(*) >= 4"),
    ("surviving", "select * from item_side where tag in (select tag from tag_counts)"),
    ("kept", "select item_id, count(*) as n_pairs from surviving group by item_id having count(*) >= {t}"),
]


def folk_ctes(item_threshold=4):
    return [(n, s.replace("{t}", str(item_threshold))) for n, s in _FOLK_CTES]


FOLK_VIEWS = ("tags", "tags_big", "movies", "ratings")


def _folk_sql(item_threshold=4):
    return with_views(*FOLK_VIEWS, extra=folk_ctes(item_threshold))


@query("set1_tag_union", with_views("tags", "tags_big")
       + "select user_id, item_id, tag from tags union select user_id, item_id, tag from tags_big")
def set1_tag_union(spark, sf_dir):
    """SET-1: two tag sources, set semantics."""
    return prep.tag_union(views.tags(spark, sf_dir), views.tags(spark, sf_dir, big=True))


@query("agg10_active_users", _folk_sql() + "select user_id, n_tags from active")
def agg10_active_users(spark, sf_dir):
    """AGG-10 / JOI-14: users with >= 4 distinct tags (both sources, big one restricted)."""
    return build_folksonomy(spark, sf_dir).active_users


@query("agg11_tag_frequency", _folk_sql() + "select tag, n from tag_counts")
def agg11_tag_frequency(spark, sf_dir):
    """AGG-11: tags applied >= 4 times over distinct (item, user, tag)."""
    return build_folksonomy(spark, sf_dir).tag_counts


@query("agg12_tagged_items", _folk_sql() + "select item_id, user_id, tag from surviving "
       "where item_id in (select item_id from kept)")
def agg12_tagged_items(spark, sf_dir):
    """AGG-12: items with >= 4 surviving (user, tag) pairs, long format."""
    return build_folksonomy(spark, sf_dir).item_tags


@query("agg12_tagged_items_t20", _folk_sql(20) + "select item_id, count(*) as n_pairs from surviving "
       "where item_id in (select item_id from kept) group by item_id")
def agg12_tagged_items_t20(spark, sf_dir):
    """AGG-12 with a higher item threshold (20) so the filter bites."""
    f = build_folksonomy(spark, sf_dir, item_threshold=20)
    return f.item_tags.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_pairs"))


@query("job26_folksonomy_report", _folk_sql() + "select (select count(distinct item_id) from movies) as total, "
       "(select count(*) from kept) as kept, (select count(distinct item_id) from movies) - "
       "(select count(*) from kept) as filtered")
def job26_folksonomy_report(spark, sf_dir):
    """JOB-26 / AGG-24: catalogue size, kept items, filtered."""
    return build_folksonomy(spark, sf_dir).report


def _filtered(spark, sf_dir):
    f = build_folksonomy(spark, sf_dir)
    return prep.dataset_filter(views.ratings(spark, sf_dir), f.active_users, f.item_tags)


_FILTER_SQL = _folk_sql() + ", fr as (select * from ratings where user_id in (select user_id from active) " \
    "and item_id in (select item_id from kept))\n"


@query("job27_dataset_filter", _FILTER_SQL + "select user_id, item_id, score from fr")
def job27_dataset_filter(spark, sf_dir):
    """JOB-27 / JOI-1: ratings of active users on tagged items."""
    kept, _ = _filtered(spark, sf_dir)
    return kept.select("user_id", "item_id", "score")


@query("agg24_filter_report", _FILTER_SQL + "select (select count(*) from ratings) as total, "
       "(select count(*) from fr) as kept, (select count(*) from ratings) - (select count(*) from fr) as filtered")
def agg24_filter_report(spark, sf_dir):
    """AGG-24: total / kept / filtered counters of the dataset filter."""
    _, report = _filtered(spark, sf_dir)
    return report


@query("flt5_min_support", with_views("ratings")
       + "select user_id, item_id, score from ratings where user_id in (select user_id from ratings "
         "group by user_id having count(*) >= 10) and item_id in (select item_id from ratings "
         "group by item_id having count(*) >= 10)")
def flt5_min_support(spark, sf_dir):
    """FLT-5: users and items with at least 10 ratings each."""
    r = prep.min_support(views.ratings(spark, sf_dir), 10, 10)
    return r.select("user_id", "item_id", "score")


@query("set4_train_complement", with_views("folds")
       + "select user_id, item_id, score from folds where fold <> 1")
def set4_train_complement(spark, sf_dir):
    """SET-4: train of fold 1 = all ratings minus the fold-1 test rows (anti join)."""
    f = views.folds(spark, sf_dir)
    return prep.complement(f, f.where(F.col("fold") == 1)).select("user_id", "item_id", "score")


@query("set5_user_tag_overlap", with_views("tags", "tags_big", extra=[
    ("a", "select distinct user_id, tag from tags"), ("b", "select distinct user_id, tag from tags_big")])
       + "select coalesce(a.user_id, b.user_id) as user_id, count(a.tag) as n_a, count(b.tag) as n_b, "
         "count(case when a.tag is not null and b.tag is not null then 1 end) as n_both, count(*) as n_union "
         "from a full outer join b on a.user_id = b.user_id and a.tag = b.tag group by 1")
def set5_user_tag_overlap(spark, sf_dir):
    """SET-5 / AGG-14 join form: per user |A|, |B|, |A and B|, |A or B| of tag sets."""
    return prep.set_overlap(views.tags(spark, sf_dir), views.tags(spark, sf_dir, big=True), "user_id", "tag")


PROPS_SCHEMA = T.StructType([T.StructField("k", T.IntegerType())])


def _events_json(spark, sf_dir):
    ev = views.table(spark, sf_dir, "events")
    return prep.flatten_json(prep.skip_empty_key(ev, "props"), ["event_id", "user_id"], "props", PROPS_SCHEMA)


@query("job28_flatten_json", "select event_id, user_id, "
       "case when try_cast(json_extract(props, '$.k') as integer) is not null "
       "then cast(json_extract(props, '$.k') as integer) end as k, "
       "try_cast(json_extract(props, '$.k') as integer) is not null as ok "
       "from events where props is not null and length(trim(props)) > 0")
def job28_flatten_json(spark, sf_dir):
    """JOB-28 / PRJ-6 / SCL-8 / FLT-2: JSON props to named columns, ids kept on error."""
    flat, _ = _events_json(spark, sf_dir)
    return flat


@query("job28_flatten_report", "select count(*) as total, "
       "count(try_cast(json_extract(props, '$.k') as integer)) as ok, "
       "count(*) - count(try_cast(json_extract(props, '$.k') as integer)) as errors "
       "from events where props is not null and length(trim(props)) > 0")
def job28_flatten_report(spark, sf_dir):
    """JOB-28 / SNK-10 companion: number of documents and parse errors (D19: a count)."""
    _, report = _events_json(spark, sf_dir)
    return report


_NORM_SQL = ("trim(regexp_replace(trim(regexp_replace(title, '\\s*\\(\\d{4}\\)\\s*$', '')), "
             "',\\s*The$', ''))")


@query("prj7_normalise_title", with_views("movies")
       + f"select item_id, {_NORM_SQL} as norm_title from movies")
def prj7_normalise_title(spark, sf_dir):
    """PRJ-7: strip a trailing (YYYY) and ', The'."""
    m = views.movies(spark, sf_dir)
    return m.select("item_id", normalise_title("title").alias("norm_title"))


@query("joi16_title_match", with_views("movies", extra=[
    ("ta", f"select {_NORM_SQL} as t from movies where year < '1985'"),
    ("tb", f"select distinct {_NORM_SQL} as t from movies where year >= '1985'")])
       + "select count(tb.t) as matched, count(*) as total from ta left join tb on ta.t = tb.t")
def joi16_title_match(spark, sf_dir):
    """JOI-16: titles of the older catalogue (before 1985) found in the newer one."""
    m = views.movies(spark, sf_dir)
    return prep.match_titles(m.where(F.col("year") < "1985"), m.where(F.col("year") >= "1985"))

"""Descriptive statistics queries (AGG-1..9, JOI-2..5, PRJ-4/5, JOB-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinerank.functions.scalar import r6
from cinerank.operators import stats
from cinerank.plans.oracle_views import with_views
from cinerank.plans.registry import query
from cinerank.sources import views


@query("job1_ratings_dedup", with_views("ratings")
       + "select user_id, item_id, score, cast(ts as varchar) as ts from ratings")
def job1_ratings_dedup(spark, sf_dir):
    """JOB-1 / WIN-6: ratings after last-write-wins per (user, item)."""
    r = views.ratings(spark, sf_dir)
    return r.select("user_id", "item_id", "score", F.col("ts").cast("string").alias("ts"))


@query("agg1_global_mean", with_views("ratings")
       + "select round(avg(score), 6) as mu, count(*) as n from ratings")
def agg1_global_mean(spark, sf_dir):
    g = stats.global_mean(views.ratings(spark, sf_dir))
    return g.select(r6("mu").alias("mu"), "n")


@query("agg2_user_mean", with_views("ratings")
       + "select user_id, round(avg(score), 6) as mean, count(*) as n from ratings group by user_id")
def agg2_user_mean(spark, sf_dir):
    m = stats.user_means(views.ratings(spark, sf_dir))
    return m.select("user_id", r6("mean").alias("mean"), "n")


@query("agg3_item_mean", with_views("ratings")
       + "select item_id, round(avg(score), 6) as mean, count(*) as n from ratings group by item_id")
def agg3_item_mean(spark, sf_dir):
    m = stats.item_means(views.ratings(spark, sf_dir))
    return m.select("item_id", r6("mean").alias("mean"), "n")


_GENRES_SQL = ("select distinct item_id, trim(g) as genre from movies, "
               "unnest(string_split(genres, '|')) as t(g) where length(trim(g)) > 0")


@query("agg4_mean_by_genre", with_views("ratings", "movies", extra=[("ig", _GENRES_SQL)])
       + "select ig.genre, round(sum(r.score) / count(*), 6) as mean, count(*) as n "
         "from ratings r join ig on ig.item_id = r.item_id group by ig.genre")
def agg4_mean_by_genre(spark, sf_dir):
    """AGG-4 / JOI-2 / SRC-4 / PRJ-8."""
    m = stats.mean_by_genre(views.ratings(spark, sf_dir), views.movies(spark, sf_dir))
    return m.select("genre", r6("mean").alias("mean"), "n")


@query("agg5_mean_by_year", with_views("ratings", "movies")
       + "select m.year, round(sum(r.score) / count(*), 6) as mean, count(*) as n "
         "from ratings r join movies m on m.item_id = r.item_id group by m.year")
def agg5_mean_by_year(spark, sf_dir):
    """AGG-5 / JOI-3 (year kept as a string)."""
    m = stats.mean_by_attribute(views.ratings(spark, sf_dir), views.movies(spark, sf_dir), "year")
    return m.select("year", r6("mean").alias("mean"), "n")


@query("agg6_mean_by_country", with_views("ratings", "movies")
       + "select m.country, round(sum(r.score) / count(*), 6) as mean, count(*) as n "
         "from ratings r join movies m on m.item_id = r.item_id group by m.country")
def agg6_mean_by_country(spark, sf_dir):
    """AGG-6 / JOI-4: the country field is used whole."""
    m = stats.mean_by_attribute(views.ratings(spark, sf_dir), views.movies(spark, sf_dir), "country")
    return m.select("country", r6("mean").alias("mean"), "n")


_UM = ("um", "select u.*, coalesce(m.mean, 0.0) as mean from users u left join "
             "(select user_id, avg(score) as mean from ratings group by user_id) m on m.user_id = u.user_id")


@query("joi5_user_means_all", with_views("ratings", "users", extra=[_UM])
       + "select user_id, round(mean, 6) as mean from um")
def joi5_user_means_all(spark, sf_dir):
    """JOI-5 / PRJ-5: all users, 0.0 for users without ratings."""
    m = stats.user_means_all(views.ratings(spark, sf_dir), views.users(spark, sf_dir))
    return m.select("user_id", r6("mean").alias("mean"))


@query("agg7_mean_by_gender", with_views("ratings", "users", extra=[_UM])
       + "select case when gender = 'M' then 'M' else 'F' end as gender, round(avg(mean), 6) as mean, "
         "count(*) as n_users from um group by 1")
def agg7_mean_by_gender(spark, sf_dir):
    m = stats.mean_of_user_means(views.ratings(spark, sf_dir), views.users(spark, sf_dir), "gender")
    return m.select("gender", r6("mean").alias("mean"), "n_users")


@query("agg8_mean_by_age_bucket", with_views("ratings", "users", extra=[_UM])
       + "select * from (select case when age <= 18 then 18 when age <= 24 then 24 when age <= 34 then 34 "
         "when age <= 44 then 44 when age <= 49 then 49 when age <= 55 then 55 when age <= 100 then 100 end "
         "as age, round(avg(mean), 6) as mean, count(*) as n_users from um group by 1) x where age is not null")
def agg8_mean_by_age_bucket(spark, sf_dir):
    """AGG-8 / PRJ-4."""
    m = stats.mean_of_user_means(views.ratings(spark, sf_dir), views.users(spark, sf_dir), "age")
    return m.select("age", r6("mean").alias("mean"), "n_users")


@query("agg9_mean_by_occupation", with_views("ratings", "users", extra=[_UM])
       + "select occupation, round(avg(mean), 6) as mean, count(*) as n_users from um group by occupation")
def agg9_mean_by_occupation(spark, sf_dir):
    m = stats.mean_of_user_means(views.ratings(spark, sf_dir), views.users(spark, sf_dir), "occupation")
    return m.select("occupation", r6("mean").alias("mean"), "n_users")


@query("prj4_age_bucket", with_views("users")
       + "select user_id, age, case when age <= 18 then 18 when age <= 24 then 24 when age <= 34 then 34 "
         "when age <= 44 then 44 when age <= 49 then 49 when age <= 55 then 55 when age <= 100 then 100 end "
         "as bucket from users")
def prj4_age_bucket(spark, sf_dir):
    from cinerank.functions.scalar import age_bucket
    u = views.users(spark, sf_dir)
    return u.select("user_id", "age", age_bucket("age").alias("bucket"))


@query("win8_item_centred", with_views("ratings")
       + "select user_id, item_id, round(score - avg(score) over (partition by item_id), 6) as centred "
         "from ratings")
def win8_item_centred(spark, sf_dir):
    """WIN-8: item-mean-centred scores (aggregate + join form)."""
    from cinerank.operators.similarity import centre_by_join
    r = views.ratings(spark, sf_dir).select("user_id", "item_id", F.col("score").alias("v"))
    c = centre_by_join(r, "item_id", "v")
    return c.select("user_id", "item_id", r6("v").alias("centred"))

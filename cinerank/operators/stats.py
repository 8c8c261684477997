"""Descriptive rating statistics (AGG-1..AGG-9, JOI-2..JOI-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.functions.scalar import age_bucket, trimmed_split

U, I = "user_id", "item_id"


def global_mean(ratings: DataFrame) -> DataFrame:
    """AGG-1."""
    return ratings.agg(F.avg("score").alias("mu"), F.count(F.lit(1)).alias("n"))


def user_means(ratings: DataFrame) -> DataFrame:
    """AGG-2."""
    return ratings.groupBy(U).agg(F.avg("score").alias("mean"), F.count(F.lit(1)).alias("n"))


def item_means(ratings: DataFrame) -> DataFrame:
    """AGG-3."""
    return ratings.groupBy(I).agg(F.avg("score").alias("mean"), F.count(F.lit(1)).alias("n"))


def _item_sums(ratings: DataFrame) -> DataFrame:
    # Pre-aggregate per item so the attribute join carries one row per item,
    # not one per rating (sums of half-stars are exact, so no drift).
    return ratings.groupBy(I).agg(F.sum("score").alias("_s"), F.count(F.lit(1)).alias("_n"))


def mean_by_attribute(ratings: DataFrame, attrs: DataFrame, attr: str) -> DataFrame:
    """AGG-5/AGG-6 (JOI-3/JOI-4): mean rating per item attribute value (inner join)."""
    j = _item_sums(ratings).join(attrs.select(I, attr), I)
    return (j.groupBy(attr).agg((F.sum("_s") / F.sum("_n")).alias("mean"),
                                F.sum("_n").alias("n")))


def item_genres(movies: DataFrame, col: str = "genres", sep: str = "\\|") -> DataFrame:
    """SRC-4 / PRJ-8: one row per (item, genre), elements trimmed, set semantics."""
    return (movies.select(I, F.explode(F.array_distinct(trimmed_split(col, sep))).alias("genre"))
            .where(F.length("genre") > 0))


def mean_by_genre(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """AGG-4 (JOI-2): a rating counts once for each genre of its item."""
    return mean_by_attribute(ratings, item_genres(movies), "genre")


def user_means_all(ratings: DataFrame, users: DataFrame) -> DataFrame:
    """JOI-5 / PRJ-5: every user with their mean rating, 0.0 when they rated nothing."""
    m = ratings.groupBy(U).agg(F.avg("score").alias("mean"))
    return users.join(m, U, "left").withColumn("mean", F.coalesce("mean", F.lit(0.0)))


def mean_of_user_means(ratings: DataFrame, users: DataFrame, by: str) -> DataFrame:
    """AGG-7/8/9: average of per-user means grouped by a demographic column.

    ``by`` = 'gender' (anything not 'M' counts as 'F'), 'age' (bucketed by
    PRJ-4, users above the last bucket dropped) or 'occupation'."""
    um = user_means_all(ratings, users)
    if by == "gender":
        key = F.when(F.col("gender") == "M", "M").otherwise("F")
    elif by == "age":
        key = age_bucket("age")
    else:
        key = F.col(by)
    return (um.select(key.alias(by), "mean").where(F.col(by).isNotNull())
            .groupBy(by).agg(F.avg("mean").alias("mean"), F.count(F.lit(1)).alias("n_users")))

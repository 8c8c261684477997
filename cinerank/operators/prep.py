"""Data preparation: tag curation, dataset filtering, support filters, JSON
flattening, title matching (JOB-26..28, JOI-1, JOI-14, JOI-16, AGG-10..12,
AGG-24, SET-1, SET-4, SET-5, FLT-2, FLT-5, PRJ-6, PRJ-7).

Everything stays in long format: a tagged item is a set of (item, user, tag)
rows, never one collected array per item, so a heavily tagged item is spread
over tasks like any other key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinerank.functions.scalar import normalise_title

U, I = "user_id", "item_id"

# Fixed thresholds of the tag curation (distinct tags per active user,
# applications per kept tag, surviving (user, tag) pairs per kept item).
USER_TAG_THRESHOLD = 4
TAG_THRESHOLD = 4
ITEM_THRESHOLD = 4


@dataclass
class Folksonomy:
    item_tags: DataFrame      # (item_id, user_id, tag) surviving rows of kept items
    active_users: DataFrame   # (user_id, n_tags)
    tag_counts: DataFrame     # (tag, n) frequent tags
    report: DataFrame         # (total, kept, filtered)


def _report(total: DataFrame, kept: DataFrame) -> DataFrame:
    """AGG-24: (total, kept, filtered) as one aggregate over a flagged union."""
    flags = (total.select(F.lit(1).alias("_t"), F.lit(0).alias("_k"))
             .unionByName(kept.select(F.lit(0).alias("_t"), F.lit(1).alias("_k"))))
    return (flags.agg(F.sum("_t").cast("bigint").alias("total"), F.sum("_k").cast("bigint").alias("kept"))
            .select("total", "kept", (F.col("total") - F.col("kept")).alias("filtered")))


def tag_union(small: DataFrame, big: DataFrame) -> DataFrame:
    """SET-1: union of two tag sources with set semantics."""
    return small.select(U, I, "tag").unionByName(big.select(U, I, "tag")).distinct()


def folksonomy(small: DataFrame, big: DataFrame, catalogue: DataFrame, dataset_users: DataFrame,
               user_threshold: int = USER_TAG_THRESHOLD, tag_threshold: int = TAG_THRESHOLD,
               item_threshold: int = ITEM_THRESHOLD, once: Callable[[DataFrame, str], DataFrame] | None = None) -> Folksonomy:
    """JOB-26. The big source is restricted independently on its two sides
    (JOI-14): items must be in the catalogue for the item side, users must be
    dataset users for the user side. ``once`` (of a table and a name) writes the distinct rows of the item side, which
    the counts and the surviving rows are read from."""
    big_items = big.join(catalogue.select(I).distinct(), I, "left_semi")
    big_users = big.join(dataset_users.select(U).distinct(), U, "left_semi")
    item_side = small.select(I, U, "tag").unionByName(big_items.select(I, U, "tag")).distinct()
    if once is not None:
        item_side = once(item_side, "item_side")
    user_side = small.select(U, "tag").unionByName(big_users.select(U, "tag")).distinct()

    active = (user_side.groupBy(U).agg(F.count(F.lit(1)).alias("n_tags"))
              .where(F.col("n_tags") >= user_threshold))
    tag_counts = (item_side.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
                  .where(F.col("n") >= tag_threshold))
    surviving = item_side.join(tag_counts.select("tag"), "tag", "left_semi")
    kept_items = (surviving.groupBy(I).agg(F.count(F.lit(1)).alias("n_pairs"))
                  .where(F.col("n_pairs") >= item_threshold))
    item_tags = surviving.join(kept_items.select(I), I, "left_semi").select(I, U, "tag")
    report = _report(catalogue.select(I).distinct(), kept_items)
    return Folksonomy(item_tags, active, tag_counts, report)


def dataset_filter(ratings: DataFrame, active_users: DataFrame, tagged_items: DataFrame):
    """JOB-27 / JOI-1: keep ratings of active users on tagged items, plus report.

    Both filters are semi joins; Catalyst broadcasts a side only when its
    statistics put it under the broadcast threshold."""
    kept = (ratings.join(active_users.select(U).distinct(), U, "left_semi")
            .join(tagged_items.select(I).distinct(), I, "left_semi"))
    return kept, _report(ratings, kept)


def min_support(ratings: DataFrame, min_user: int = 1, min_item: int = 1) -> DataFrame:
    """FLT-5: keep rows whose user and item each have at least m ratings.

    Counts are aggregates joined back (not a window), so a hot user/item is
    combined map-side instead of sorted in one task."""
    uc = ratings.groupBy(U).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_user)
    ic = ratings.groupBy(I).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_item)
    return ratings.join(uc.select(U), U, "left_semi").join(ic.select(I), I, "left_semi")


def complement(all_rows: DataFrame, part: DataFrame, keys=(U, I)) -> DataFrame:
    """SET-4: rows of ``all_rows`` not in ``part`` (train = all - test)."""
    return all_rows.join(part.select(*keys), list(keys), "left_anti")


def set_overlap(a: DataFrame, b: DataFrame, group: str, member: str) -> DataFrame:
    """SET-5 (join form): per group |A|, |B|, |A & B|, |A | B| over distinct members."""
    da = a.select(group, member).distinct().withColumn("_ia", F.lit(1))
    db = b.select(group, member).distinct().withColumn("_ib", F.lit(1))
    j = da.join(db, [group, member], "full")
    return (j.groupBy(group)
            .agg(F.sum(F.coalesce("_ia", F.lit(0))).cast("bigint").alias("n_a"),
                 F.sum(F.coalesce("_ib", F.lit(0))).cast("bigint").alias("n_b"),
                 F.sum(F.when(F.col("_ia").isNotNull() & F.col("_ib").isNotNull(), 1).otherwise(0))
                 .cast("bigint").alias("n_both"),
                 F.count(F.lit(1)).alias("n_union")))


def flatten_json(docs: DataFrame, id_cols, body: str, schema: T.StructType, required=None):
    """JOB-28 / PRJ-6 / SCL-8: parse a JSON document into named fields; a row
    that fails to parse or misses a required field keeps only its ids.
    Returns (flat rows, report(total, ok, errors))."""
    required = list(required or [f.name for f in schema.fields])
    parsed = docs.withColumn("_j", F.from_json(F.col(body), schema))
    ok = F.col("_j").isNotNull()
    for f in required:
        ok = ok & F.col(f"_j.{f}").isNotNull()
    fields = [F.when(ok, F.col(f"_j.{f.name}")).alias(f.name) for f in schema.fields]
    flat = parsed.select(*id_cols, *fields, ok.alias("ok"))
    report = flat.agg(F.count(F.lit(1)).alias("total"),
                      F.sum(F.when(F.col("ok"), 1).otherwise(0)).cast("bigint").alias("ok"),
                      F.sum(F.when(F.col("ok"), 0).otherwise(1)).cast("bigint").alias("errors"))
    return flat, report


def skip_empty_key(df: DataFrame, key: str) -> DataFrame:
    """FLT-2: drop rows whose external key is null or empty."""
    return df.where(F.col(key).isNotNull() & (F.length(F.trim(F.col(key))) > 0))


def match_titles(a: DataFrame, b: DataFrame, title: str = "title") -> DataFrame:
    """JOI-16: normalise titles (PRJ-7) and count how many titles of ``a``
    occur in ``b``: one row (matched, total)."""
    na = a.select(normalise_title(title).alias("_t"))
    nb = b.select(normalise_title(title).alias("_t")).distinct()
    j = na.join(nb.withColumn("_hit", F.lit(1)), "_t", "left")
    return j.agg(F.sum(F.coalesce("_hit", F.lit(0))).cast("bigint").alias("matched"),
                 F.count(F.lit(1)).alias("total"))

"""Recommender views derived from the driver's star-schema tables.

The mapping (customer = user, part = item, a line item = one rating event)
is fixed by FIXTURES.md part B; ``cinerank.plans.oracle_views`` holds the
same definitions as SQL text for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.session import staged

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

N_FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating event per line item; a (user, item) cell may repeat."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("user_id"),
                    F.col("l_partkey").alias("item_id"),
                    (F.ceil(F.col("l_quantity") / 5).cast("double") / 2).alias("score"),
                    F.col("l_shipdate").alias("ts"),
                    "l_orderkey", "l_linenumber", "l_quantity"))


def last_write_wins(raw: DataFrame, keys=("user_id", "item_id"),
                    order=("ts", "l_orderkey", "l_linenumber", "l_quantity"),
                    values=("score", "ts")) -> DataFrame:
    """WIN-6: keep the latest row per cell.

    ``max(struct(order..., values...))`` is a declarative aggregate, so Spark
    combines map-side before the shuffle; a hot cell never reaches one task
    with all its rows (unlike a ``row_number`` window)."""
    fields = list(dict.fromkeys(list(order) + list(values)))
    latest = F.max(F.struct(*[F.col(c) for c in fields])).alias("_latest")
    return (raw.groupBy(*keys).agg(latest)
            .select(*keys, *[F.col(f"_latest.{v}").alias(v) for v in values]))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-1 ingest: deduplicated ratings (user_id, item_id, score, ts), staged once."""
    return staged(spark, f"ratings:{sf_dir}", lambda: last_write_wins(ratings_raw(spark, sf_dir)))


def fold_of(user: Column, item: Column, n_folds: int = N_FOLDS) -> Column:
    """Deterministic modulo fold 1..n used for oracle-checkable runs."""
    return (F.pmod(user * 31 + item * 17, F.lit(n_folds)) + 1).cast("int")


def folds(spark: SparkSession, sf_dir: str, n_folds: int = N_FOLDS) -> DataFrame:
    """Ratings with a modulo fold 1..n, staged partitioned by fold (fold = f
    and fold <> f prune directories)."""
    def build():
        r = ratings(spark, sf_dir)
        return r.withColumn("fold", fold_of(F.col("user_id"), F.col("item_id"), n_folds))
    return staged(spark, f"folds{n_folds}:{sf_dir}", build, partition_by=["fold"])


def ratings_binary(spark: SparkSession, sf_dir: str, threshold: float = 3.0) -> DataFrame:
    from cinerank.functions.scalar import binarise
    r = ratings(spark, sf_dir)
    return r.select("user_id", "item_id", binarise(F.col("score"), threshold).alias("label"), "ts")


def tags(spark: SparkSession, sf_dir: str, big: bool = False) -> DataFrame:
    """Tag applications (user_id, item_id, tag); ``big`` selects the larger source."""
    return staged(spark, f"tags{int(big)}:{sf_dir}", lambda: _tags(spark, sf_dir, big))


def _tags(spark: SparkSession, sf_dir: str, big: bool) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == ("A" if big else "R"))
    o = table(spark, sf_dir, "orders")
    p = table(spark, sf_dir, "part")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .join(p, p.p_partkey == li.l_partkey)
            .select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
                    F.concat_ws(" ", "p_name", F.col("p_size").cast("string"),
                                "o_orderpriority").alias("tag"))
            .distinct())


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movies: item_id, title, genres ('|'-joined), year (string), country."""
    p = table(spark, sf_dir, "part")
    year = (F.lit(1950) + F.pmod(F.col("p_partkey"), F.lit(70))).cast("string")
    return p.select(F.col("p_partkey").alias("item_id"),
                    F.concat(F.col("p_name"), F.lit(" ("), year, F.lit(")")).alias("title"),
                    F.concat(F.col("p_type"), F.lit("|"),
                             F.regexp_replace("p_name", " ", "|")).alias("genres"),
                    year.alias("year"), F.col("p_brand").alias("country"))


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directors / actors per item: item_id, person, kind."""
    return staged(spark, f"people:{sf_dir}", lambda: _people(spark, sf_dir))


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier")
    return (li.join(s, s.s_suppkey == li.l_suppkey)
            .select(F.col("l_partkey").alias("item_id"), F.col("s_name").alias("person"),
                    F.when(F.pmod(F.col("l_suppkey"), F.lit(5)) == 0, "director")
                    .otherwise("actor").alias("kind"))
            .distinct())


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("user_id"),
                    (F.lit(10) + F.pmod(F.col("c_custkey") * 7, F.lit(95))).cast("int").alias("age"),
                    F.when(F.pmod(F.col("c_custkey"), F.lit(2)) == 0, "M").otherwise("F").alias("gender"),
                    F.col("c_mktsegment").alias("occupation"))


def documents_en(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English documents."""
    return table(spark, sf_dir, "documents").where(F.col("lang") == "en").select("doc_id", "text")

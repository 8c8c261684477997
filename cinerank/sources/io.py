"""Readers (SRC-1..SRC-12) and writers (SNK-1..SNK-12) for the delimited
layouts of the reference, always with an explicit schema (never inferred).

Malformed lines are read in PERMISSIVE mode and then filtered (FLT-1), the
number of rejects stays available as a count. Ragged folksonomy rows are
written in bounded chunks (at most ``chunk`` tags per line, several lines per
item) so no item's tags are ever collected into one task; the reader
accepts any number of lines per item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinerank.functions.scalar import trimmed_split

U, I = "user_id", "item_id"

RATINGS = T.StructType([T.StructField(U, T.LongType()), T.StructField(I, T.LongType()),
                        T.StructField("score", T.DoubleType()), T.StructField("ts", T.LongType())])
RATINGS_BINARY = T.StructType([T.StructField(U, T.LongType()), T.StructField(I, T.LongType()),
                               T.StructField("label", T.IntegerType()), T.StructField("ts", T.LongType())])
TAGS = T.StructType([T.StructField(U, T.LongType()), T.StructField(I, T.LongType()),
                     T.StructField("tag", T.StringType()), T.StructField("ts", T.LongType())])
MOVIES = T.StructType([T.StructField(I, T.LongType()), T.StructField("title", T.StringType()),
                       T.StructField("genres", T.StringType())])
USERS = T.StructType([T.StructField(U, T.LongType()), T.StructField("age", T.IntegerType()),
                      T.StructField("gender", T.StringType()), T.StructField("occupation", T.StringType()),
                      T.StructField("zip", T.StringType())])
LINKS = T.StructType([T.StructField(I, T.LongType()), T.StructField("imdb_id", T.StringType()),
                      T.StructField("tmdb_id", T.StringType())])


def _csv(spark: SparkSession, path: str, schema: T.StructType, sep: str, header: bool = False,
         encoding: str = "UTF-8", corrupt: str | None = None) -> DataFrame:
    r = (spark.read.schema(schema if corrupt is None else
                           T.StructType(schema.fields + [T.StructField(corrupt, T.StringType())]))
         .option("sep", sep).option("header", header).option("encoding", encoding)
         .option("mode", "PERMISSIVE").option("quote", '"').option("escape", '"'))
    if corrupt:
        r = r.option("columnNameOfCorruptRecord", corrupt)
    return r.csv(path)


def read_ratings(spark: SparkSession, path: str, sep: str = "\t", binary: bool = False) -> DataFrame:
    """SRC-1 / SRC-2 / SRC-11 / FLT-1: positional ratings; lines without user, item and value dropped."""
    return _csv(spark, path, RATINGS_BINARY if binary else RATINGS, sep).where(_complete(binary))


def count_rejects(spark: SparkSession, path: str, sep: str = "\t", binary: bool = False) -> DataFrame:
    """FLT-1: one row (rejects): the lines that ``read_ratings`` drops."""
    df = _csv(spark, path, RATINGS_BINARY if binary else RATINGS, sep)
    return df.agg(F.count(F.when(~_complete(binary), 1)).alias("rejects"))


def _complete(binary: bool):
    return F.col(U).isNotNull() & F.col(I).isNotNull() & F.col("label" if binary else "score").isNotNull()


def read_tags(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """SRC-3: header, comma, Latin-1; quoted commas inside a tag are kept."""
    return _csv(spark, path, TAGS, ",", header=True, encoding=encoding).where(F.col(U).isNotNull())


def read_movies(spark: SparkSession, path: str) -> DataFrame:
    """SRC-4: id, title (quoted commas allowed), genres split on '|' and trimmed."""
    df = _csv(spark, path, MOVIES, ",", header=True)
    return df.withColumn("genre_list", trimmed_split("genres", "\\|"))


def read_metadata(spark: SparkSession, path: str, schema: T.StructType):
    """SRC-5: header TSV; returns (good rows, reject count DataFrame)."""
    df = _csv(spark, path, schema, "\t", header=True, corrupt="_corrupt").cache()
    bad = df.where(F.col("_corrupt").isNotNull())
    return df.where(F.col("_corrupt").isNull()).drop("_corrupt"), bad.agg(F.count(F.lit(1)).alias("rejects"))


def read_ragged(spark: SparkSession, path: str, key: str = I, value: str = "tag") -> DataFrame:
    """SRC-6: lines 'id<TAB>v1<TAB>v2...' to long format (id, value)."""
    parts = spark.read.text(path).select(F.split("value", "\t").alias("p"))
    return (parts.select(F.element_at("p", 1).cast("bigint").alias(key),
                         F.explode(F.slice("p", F.lit(2), F.greatest(F.size("p") - 1, F.lit(0)))).alias(value))
            .where(F.col(key).isNotNull() & (F.length(value) > 0)))


def read_list(spark: SparkSession, path: str, name: str, cast: str = "bigint") -> DataFrame:
    """SRC-7: one value per line."""
    v = spark.read.text(path).select(F.trim("value").alias(name)).where(F.length(name) > 0)
    return v.select(F.col(name).cast(cast).alias(name))


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """SRC-8: 'id|age|gender|occupation|zip'."""
    return _csv(spark, path, USERS, "|").where(F.col(U).isNotNull())


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """SRC-9: item, imdb id kept as a string (leading zeros), tmdb id."""
    return _csv(spark, path, LINKS, ",", header=True)


def read_json_docs(spark: SparkSession, path: str, schema: T.StructType, id_cols=("event_id",)) -> DataFrame:
    """SRC-10: one JSON document per line, parsed with an explicit schema."""
    full = T.StructType([T.StructField(c, T.LongType()) for c in id_cols] + schema.fields)
    return spark.read.schema(full).option("mode", "PERMISSIVE").json(path)


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """SRC-12: stored sparse profiles (row, idx, weight) triples."""
    return spark.read.parquet(path)


# --- writers -----------------------------------------------------------------

def write_delimited(df: DataFrame, path: str, sep: str = "\t", header: bool = False) -> None:
    """SNK-1/2/3/5/9/10/11: delimited text (one part file per task)."""
    df.write.mode("overwrite").option("sep", sep).option("header", header).option("quote", '"').option("escape", '"').csv(path)


def write_folds(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """SNK-4: one directory per fold (fold = n is the test side, fold <> n the train side)."""
    df.write.mode("overwrite").partitionBy("fold").format(fmt).save(path)


def write_ragged(df: DataFrame, path: str, key: str = I, value: str = "tag", chunk: int = 256) -> None:
    """SNK-6: 'id<TAB>v...' lines; an id with many values is spread over several
    lines of about ``chunk`` values (hash-assigned), never one collected row."""
    n = df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / F.lit(float(chunk))).alias("_nc"))
    c = df.join(n, key).withColumn("_c", F.pmod(F.xxhash64(*[F.col(x) for x in df.columns]), F.col("_nc")))
    lines = (c.groupBy(key, "_c").agg(F.sort_array(F.collect_list(value)).alias("_v"))
             .select(F.concat_ws("\t", F.col(key).cast("string"), F.array_join("_v", "\t")).alias("value")))
    lines.write.mode("overwrite").text(path)


def write_list(df: DataFrame, path: str, col: str) -> None:
    """SNK-6 (active users) / SNK-7 (vocabulary files): one value per line."""
    df.select(F.col(col).cast("string").alias("value")).write.mode("overwrite").text(path)


def write_profiles(df: DataFrame, path: str, row: str, partitions: int | None = None) -> None:
    """SNK-8: profile triples as parquet, range-clustered by row id so readers
    of a row range skip files by min/max statistics."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, row).sortWithinPartitions(row, "idx").write.mode("overwrite").parquet(path)


def write_json_docs(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)

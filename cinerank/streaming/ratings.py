"""Incremental rating statistics over rating files that keep arriving.

The reference only processes finite files; this is the same AGG-2/AGG-3
computation (per-user / per-item mean and count) maintained by Structured
Streaming over the SRC-1 layout, so a growing ratings folder does not need a
full recomputation. State is one row per key; the checkpoint goes below the
shared checkpoint folder so a restarted query resumes exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.session import scratch_path
from cinerank.sources.io import RATINGS


def rating_stream(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """SRC-1 as a stream: headerless delimited ratings, explicit schema."""
    return (spark.readStream.schema(RATINGS).option("sep", sep).option("mode", "PERMISSIVE").csv(path)
            .where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull() & F.col("score").isNotNull()))


def running_means(stream: DataFrame, key: str = "item_id") -> DataFrame:
    """Per-key mean and count, updated as new rating files arrive."""
    return stream.groupBy(key).agg(F.avg("score").alias("mean"), F.count(F.lit(1)).alias("n"))


def start_running_means(spark: SparkSession, path: str, key: str = "item_id", table: str = "running_means",
                        sep: str = "\t", available_now: bool = True):
    """Start the query; each micro-batch overwrites a parquet table below the
    checkpoint folder with the complete current result (nothing is kept in the
    driver). Returns (query, output path)."""
    out = scratch_path(spark, f"stream-out-{table}")

    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    q = (running_means(rating_stream(spark, path, sep), key).writeStream.outputMode("complete")
         .foreachBatch(write).option("checkpointLocation", scratch_path(spark, f"stream-{table}")))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="10 seconds")
    return q.start(), out

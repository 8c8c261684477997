"""Global ranking without a single-partition window (GLOBAL-RANK, WIN-5, WIN-7).

``row_number()`` over an unpartitioned window moves every row into one task.
Instead: range-partition on the order key, sort within partitions, number
rows with ``monotonically_increasing_id`` (partition id in the high bits,
position in the low 33 bits), write that once with a reliable checkpoint so
ids are stable under recomputation, and add per-partition offsets computed
from the partition counts (one row per partition, so the tiny window and its
broadcast are bounded by the partition count, not the data).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinerank.session import ensure_checkpoint_dir

_POS_BITS = 33


def global_rank(df: DataFrame, order: Sequence[Column | str], name: str = "idx",
                start: int = 1, num_partitions: int | None = None) -> DataFrame:
    """Dense 0/1-based position of every row in ``order`` (ties broken arbitrarily
    but consistently). Adds column ``name`` (bigint)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
         .withColumn("_mid", F.monotonically_increasing_id()))
    s = s.checkpoint(eager=True)
    s = (s.withColumn("_pid", F.shiftrightunsigned("_mid", _POS_BITS))
         .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))))
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    offs = counts.select("_pid", F.coalesce(
        F.sum("_c").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"))
    out = s.join(F.broadcast(offs), "_pid")
    return out.withColumn(name, (F.col("_off") + F.col("_pos") + F.lit(start)).cast("bigint")) \
              .drop("_mid", "_pid", "_pos", "_off")


def top_k(df: DataFrame, part: Sequence[str], order: Sequence[Column], k: int,
          name: str = "rn") -> DataFrame:
    """WIN-1/WIN-3: first k rows per group. ``row_number() <= k`` lets Spark
    plan a partial WindowGroupLimit before the shuffle (map-side top-k)."""
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.session import materialize, scratch_path  # noqa: F401  (re-used by the operators)

WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(c):
    """A-Z lowered, every other character kept. ``lower`` is only used where it means the same."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def packed(df: DataFrame, *more) -> DataFrame:
    """All columns as one struct ``row``, plus ``more``: working columns can't clash with the caller's."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *more)


def hash128(*cols):
    """Two independent 64-bit hashes of the same columns: a 128-bit key without a digest's cost."""
    return F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge list as rows (node, root); root is the smallest node.

    Alternating large-star and small-star steps: each step is one aggregate and one join on the node, so a
    node with a third of all edges is combined map-side and its join can be split. The edge list only shrinks
    towards stars. Each round is cut with a reliable checkpoint. Nodes without an edge are not returned;
    null ends and self loops are ignored."""
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    before = None
    while True:
        e = _star(_star(e, large=True), large=False).distinct().checkpoint()
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1000000007)).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _star(e: DataFrame, large: bool) -> DataFrame:
    """Rows (u, v) with u > v. Large star: each larger neighbour of a node moves to the node's smallest
    neighbour. Small star: so does each smaller neighbour, and the node itself."""
    if large:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = e.select(F.col("v").alias("u"), F.col("u").alias("w")).join(m, "u").select(F.col("w").alias("u"), F.col("m").alias("v"))
    else:
        m = e.groupBy("u").agg(F.min("v").alias("m"))
        out = e.join(m, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("s")).select("s.*")
    return out.where("u <> v")


def split_buckets(rows: DataFrame, key: str, member: str, own: str, block: int) -> DataFrame:
    """Adds (bi, bj, blk) to the rows of buckets that can hold a pair: two rows at least, one of them ``own``.

    A bucket of up to ``block`` rows is one group (0, 0). A larger one is cut into blocks by the member's hash
    and every pair of blocks is a group of its own, so each pair of members meets in exactly one group of at
    most about two blocks, however large the bucket is.

    ``rows`` are never broadcast: where a function in a task made many of each row, Spark still sizes them by what they were
    made from, and would send a table of hundreds of MB through the driver."""
    size = rows.groupBy(key).agg(F.count("*").alias("_n"), F.max(own).alias("_o")).where("_n > 1 and _o")
    size = size.select(F.col(key), F.ceil(F.col("_n") / block).cast("int").alias("nb"))
    r = rows.hint("merge").join(size, key).withColumn("blk", F.pmod(F.xxhash64(F.lit(7), member), "nb").cast("int"))
    r = r.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    return r.withColumn("bi", F.least("blk", "j")).withColumn("bj", F.greatest("blk", "j")).drop("nb", "j")


def deal(rows: DataFrame, *by: str) -> DataFrame:
    return rows.repartition(*by).sortWithinPartitions(*by)


def groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """The runs of equal ``by`` values with at least two rows, from sorted batches; a run may span batches."""
    rest: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if rest is not None:
            t = pa.concat_tables([rest, t])
        if t.num_rows == 0:
            continue
        cut = _cuts(t, by)
        yield from _runs(t, cut[:-1])
        rest = t.slice(int(cut[-2]))
    if rest is not None and rest.num_rows:
        yield from _runs(rest, _cuts(rest, by))


def _cuts(t: pa.Table, by: list[str]) -> np.ndarray:
    change = np.zeros(t.num_rows - 1, bool)
    for c in by:
        v = t.column(c).to_numpy(zero_copy_only=False)
        change |= v[1:] != v[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [t.num_rows]])


def _runs(t: pa.Table, cut: np.ndarray) -> Iterator[pa.Table]:
    size = np.diff(cut)
    for k in np.flatnonzero(size > 1):
        yield t.slice(int(cut[k]), int(size[k])).combine_chunks()


def spanning(linked: np.ndarray) -> np.ndarray:
    """For a symmetric boolean link matrix: the smallest index reachable from each row."""
    label = np.arange(len(linked))
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label)))
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new

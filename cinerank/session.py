"""Session construction and the shared scratch location.

On a cluster the operator of the cluster names a shared folder in
``spark.checkpoint.dir``; lineage cuts and round-trip tables go below it.
A local folder is only created when nothing is configured (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults that suit both local tests and a cluster; a cluster's own
# spark-defaults win because ``getOrCreate`` keeps existing settings.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # only takes effect when this call starts the JVM (local runs, tests)
    "spark.driver.memory": "8g",
}


def get_session(master: str | None = None, app: str = "cinerank",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="cinerank-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


_STAGED: dict[tuple[str, str], str] = {}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(spark: SparkSession, key: str, build, partition_by=None):
    """Write ``build()`` once per session as parquet below the checkpoint folder
    and return a DataFrame reading it back.

    This cuts lineage (a lost executor re-reads files instead of recomputing
    joins), gives later stages file statistics for AQE, and keeps predicate
    pushdown / column pruning on the staged table."""
    memo = (spark.sparkContext.applicationId, key)
    path = _STAGED.get(memo)
    if path is None:
        path = scratch_path(spark, key.replace("/", "_").replace(":", "_"))
        w = build().write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        _STAGED[memo] = path
    return spark.read.parquet(path)


def materialize(df, name: str = "tmp", clear: bool = False):
    """Write an intermediate that several branches of one plan read (so it is
    computed once) to a fresh path below the checkpoint folder; returns the
    DataFrame reading it back (lineage cut, file statistics for AQE).
    ``clear``: the job's shuffle files go when it ends, not with the driver's next collection of garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    if clear:
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if clear and before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        elif clear:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.parquet(path)


def discard(*tables) -> None:
    """Delete the files of intermediates that ``materialize`` wrote, once nothing will read them again."""
    for df in tables:
        spark = df.sparkSession
        base = os.path.join(ensure_checkpoint_dir(spark), "tables")
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
            if str(path.getParent().toUri().getPath()) == str(spark._jvm.org.apache.hadoop.fs.Path(base).toUri().getPath()):
                fs.delete(path, True)


def bucketed(spark: SparkSession, key: str, build, by: tuple[str, ...], buckets: int = 16, dealt: bool = False):
    """Write ``build()`` once per session as a table bucketed and sorted by ``by``, with its files below the checkpoint
    folder, and return a DataFrame reading it: a join or aggregate on exactly these columns needs no exchange of it.
    ``dealt``: its partitions are the buckets already."""
    memo = (spark.sparkContext.applicationId, key)
    name = _STAGED.get(memo)
    if name is None:
        name = f"store_{uuid.uuid4().hex[:12]}"
        df = build() if dealt else build().repartition(buckets, *by)
        df.write.bucketBy(buckets, *by).sortBy(*by).option("path", scratch_path(spark, name)).option("compression", "zstd").saveAsTable(name)
        _STAGED[memo] = name
    return spark.table(name)

"""The streaming item means equal the batch item means on the same files."""
from pyspark.sql import functions as F

from cinerank.operators.stats import item_means
from cinerank.session import scratch_path
from cinerank.sources import io, views
from cinerank.streaming.ratings import start_running_means


def test_stream_means_match_batch(spark):
    r = views.ratings(spark, "/root/testdata/sf0.001").select(
        "user_id", "item_id", "score", F.lit(0).cast("long").alias("ts"))
    path = scratch_path(spark, "stream-in")
    io.write_delimited(r, path)
    q, out = start_running_means(spark, path, table="t_item_means")
    q.awaitTermination(120)
    got = {x.item_id: (round(x.mean, 9), x.n) for x in spark.read.parquet(out).collect()}
    want = {x.item_id: (round(x.mean, 9), x.n) for x in item_means(r).collect()}
    assert got == want and len(got) > 0

"""The bucketed profile store: content scores read it without an exchange."""
import re

from pyspark.sql import functions as F

from cinerank.operators import content as cb
from cinerank.plans import q_content
from cinerank.sources import views

SF = "/root/testdata/sf0.001"


def exchanges_over_stores(plan: str) -> list[str]:
    """The exchanges between each scan of a store and the first join or aggregate over it."""
    lines, found = [re.sub(r"\*\(\d+\) ", "", x) for x in plan.splitlines()], []
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    for n, line in enumerate(lines):
        if "store_" in line and "Scan" in line:
            at = depth(line)
            for up in reversed(lines[:n]):
                if depth(up) < at:
                    at = depth(up)
                    if re.search("Exchange", up):
                        found.append(up)
                    if re.search("Join|Aggregate", up):
                        break
    return found


def test_scores_read_profiles_where_they_lie(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        scored = cb.content_scores_by_fold(views.folds(spark, SF), *q_content.profile_store(spark, SF))
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert plan.count("store_") >= 4 and exchanges_over_stores(plan) == []
        _, iprof, _ = q_content.content_tables(spark, SF)
        plain = cb.content_scores_by_fold(views.folds(spark, SF), cb.user_profiles_by_fold(views.folds(spark, SF), iprof), iprof)
        assert plan.count("Exchange hashpartitioning") + 4 <= plain._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        both = scored.join(plain.select("user_id", "item_id", F.col("pred").alias("other")), ["user_id", "item_id"])
        assert both.where("abs(pred - other) > 1e-12").count() == 0 and both.count() == plain.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[0])
        spark.conf.set("spark.sql.adaptive.enabled", old[1])

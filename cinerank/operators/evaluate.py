"""Error and classification metrics (AGG-15..AGG-19)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.functions.scalar import r6


def error_metrics(preds: DataFrame, group: Sequence[str] = ("fold", "k"),
                  pred: str = "pred", truth: str = "score") -> DataFrame:
    """AGG-15: rmse, mae and the reported sqrt(mean |e|), per group."""
    e = F.col(pred) - F.col(truth)
    return (preds.groupBy(*group)
            .agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                 F.count(F.lit(1)).alias("n"))
            .select(*group, "rmse", "mae", F.sqrt("mae").alias("sqrt_mae"), "n"))


def fold_mean(metrics: DataFrame, by: Sequence[str] = ("k",),
              cols: Sequence[str] = ("rmse", "mae", "sqrt_mae")) -> DataFrame:
    """AGG-16: mean of per-fold metrics."""
    return metrics.groupBy(*by).agg(*[F.avg(c).alias(c) for c in cols])


def rounded(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Round reported doubles to 6 places (order-independent comparison)."""
    return df.select(*[r6(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def confusion(preds: DataFrame, group: Sequence[str] = ("fold",), pred: str = "pred",
              truth: str = "label", positive: int = 1) -> DataFrame:
    """AGG-17: TP / FP / TN / FN counts."""
    p = F.col(pred) == positive
    t = F.col(truth) == positive

    def cnt(c):
        return F.sum(F.when(c, 1).otherwise(0)).cast("bigint")

    return preds.groupBy(*group).agg(cnt(p & t).alias("tp"), cnt(p & ~t).alias("fp"),
                                     cnt(~p & ~t).alias("tn"), cnt(~p & t).alias("fn"))


def precision_recall_f1(conf: DataFrame) -> DataFrame:
    """AGG-18: zero denominators give null instead of raising."""
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    prec = F.when(tp + fp > 0, tp / (tp + fp))
    rec = F.when(tp + fn > 0, tp / (tp + fn))
    out = conf.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
    return out.withColumn("f1", f1)

"""Binary like/dislike jobs: signed user similarity scoring (JOB-8, SIM-7,
AGG-25) and the k-NN like/dislike classifier (JOB-13, SIM-12, WIN-3, AGG-19).

Labels are +1 / -1, so for two label vectors the dot product over common
items is LL + DD - LD - DL, the common count is |LL|+|DD|+|LD|+|DL| and the
union of rated items is n_u + n_v - common: one pass of the demand-driven
pair statistics gives every count the measures need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cinerank.functions.scalar import dec
from cinerank.operators.block_product import Measure, best_neighbours, neighbour_totals
from cinerank.operators.similarity import candidate_stats, fold_candidates, fold_stats
from cinerank.session import materialize

U, I = "user_id", "item_id"
DEFAULT_K = 10


def signed_similarity(stats: DataFrame, part: Sequence[str] = ()) -> DataFrame:
    """SIM-7 (intended form): (LL + DD - LD - DL) / |items of u or v|."""
    union = F.col("n_a") + F.col("n_b") - F.col("co")
    sim = F.when(union == 0, F.lit(0.0)).otherwise(F.col("dot") / union)
    return stats.select(*part, "a", "b", dec(sim).alias("sim"))


def like_dislike_scores(train: DataFrame, test: DataFrame, part: Sequence[str] = ("fold",),
                        as_written: bool = False) -> DataFrame:
    """JOB-8: score of test cell (u, i) = mean over raters v != u of i of
    label(v, i) * sim(u, v); 0.0 when nobody else rated i.

    ``as_written`` (SURVEY D14): the reference's bracket, LL + DD - LD + DL, i.e.
    dot + 2 DL with DL = |D_u and L_v| = (co - S_u + S_v - dot) / 4 from the label
    sums over common items. For the reference's leaky matrix (D13) pass the
    full ratings as ``train``.
    train/test: (part, user_id, item_id, label). Returns (part, u, i, label, pred)."""
    part = list(part)
    tr = materialize(train.select(*part, U, I, F.col("label").cast("double").alias("v"),
                                  F.col("label").alias("lv")), "ld_train")
    j = candidate_stats(test.select(*part, U, I), tr, U, I, "v", part, keep=["lv"])
    union = F.col("n_t") + F.col("n_n") - F.col("co")
    num = F.col("dot")
    if as_written:
        num = num + 2 * (F.col("co") - F.col("s_t") + F.col("s_n") - F.col("dot")) / 4
    sim = dec(F.when(union == 0, F.lit(0.0)).otherwise(num / union))
    agg = (j.withColumn("sim", sim).groupBy(*part, U, I)
           .agg(F.avg(F.col("lv") * F.col("sim")).alias("pred")))
    return (test.select(*part, U, I, "label").join(agg, part + [U, I], "left")
            .withColumn("pred", F.coalesce(F.col("pred").cast("double"), F.lit(0.0))))


#: UDF-3: distance name -> (function of the columns dot, squared norm, squared norm; whether zero norms are special).
#: Add an entry to use a distance of your own; an unknown name raises. A third part, the same as a ``block_product.Measure``,
#: lets ``knn_classify_folds`` do without rows of pairs.
DISTANCES = {
    "cos": (lambda dot, a, b: F.when((a == 0) | (b == 0), F.lit(-1.0)).otherwise(1 - dot / F.sqrt(a * b)), True),
    "euc": (lambda dot, a, b: F.sqrt(F.greatest(a + b - 2 * dot, F.lit(0.0))), False),
}


BUILTINS = dict(DISTANCES)


def knn_classify(train: DataFrame, test: DataFrame, k: int = DEFAULT_K, distance: str = "cos",
                 part: Sequence[str] = ("fold",), zero_norm: str = "keep") -> DataFrame:
    """JOB-13: classify test cell (u, i) by majority vote of u's labels on the k
    items nearest to i (ties in distance by ascending item id; a vote tie is
    a dislike).

    distance 'cos' = 1 - cosine of the item label columns (a zero norm gives
    -1.0, which sorts first as in the reference; ``zero_norm='drop'`` drops
    such neighbours instead); 'euc' = Euclidean distance of the columns.
    Returns (part, user_id, item_id, label, pred)."""
    part = list(part)
    _distance(distance)
    tr = materialize(train.select(*part, U, I, F.col("label").cast("double").alias("v"),
                                  F.col("label").alias("lv")), "knn_train")
    j = candidate_stats(test.select(*part, U, I), tr, I, U, "v", part, keep=["lv"])
    return _vote(j, test, k, distance, part, zero_norm)


def knn_classify_folds(labels: DataFrame, k: int = DEFAULT_K, distance: str = "cos", folds: Sequence[int] = (1, 2, 3, 4, 5),
                       zero_norm: str = "keep") -> DataFrame:
    """``knn_classify`` for every fold of ``folds`` at once, over rows (fold, user_id, item_id, label): every row is
    written once and pairs are joined once for all folds (``fold_candidates``)."""
    folds = [int(f) for f in folds]
    own = _distance(distance)
    measure = f"{distance}_distance" if own is BUILTINS.get(distance) else own[2] if len(own) > 2 else None
    if measure is not None and zero_norm == "keep":
        return _knn_blocks(labels, k, measure, folds)
    r = labels.select("fold", U, I, "label", F.col("label").cast("double").alias("v"))
    r = r.join(fold_stats(r, I, folds, "v", "i"), I)
    base = materialize(r.select("fold", U, I, "label", "v", F.col("label").alias("lv"), F.col("in").alias("n"), F.col("iq").alias("q"),
                                F.array(*[F.lit(0.0) for _ in folds]).alias("m")), "knn_rows")
    j = fold_candidates(base, I, U, folds, ("dot",), keep=["lv"]).withColumnsRenamed({"q_t": "sq_t", "q_n": "sq_n"})
    return _vote(j, base.where(F.col("fold").isin(*folds)), k, distance, ["fold"], zero_norm)


def _knn_blocks(labels: DataFrame, k: int, measure: Measure | str, folds: Sequence[int], **blocks) -> DataFrame:
    """``knn_classify_folds`` by a block-sparse product: each test row gets its k nearest rows as one short array."""
    none = F.lit(0.0)
    rows = materialize(labels.select("fold", U, I, F.col("label").cast("double").alias("v"), none.alias("b"), none.alias("cp")), "knn_rows")
    top = best_neighbours(rows, I, U, folds, measure, k, "value", **blocks)
    likes = F.size(F.filter("top", lambda x: x["d"] == 1))
    pred = F.when(likes > F.size("top") - likes, 1).otherwise(-1).cast("int")
    return top.select("fold", F.col("c").alias(U), F.col("e").alias(I), F.col("v").cast("int").alias("label"), pred.alias("pred"))


def like_dislike_folds(labels: DataFrame, folds: Sequence[int] = (1, 2, 3, 4, 5), as_written: bool = False, **blocks) -> DataFrame:
    """``like_dislike_scores`` for every fold of ``folds`` at once, over rows (fold, user_id, item_id, label): the sums over
    all raters are made where the similarities are, so no candidate leaves its task. With ``leaky=True`` all rows are train
    rows of every fold (D13)."""
    none = F.lit(None).cast("double")
    rows = materialize(labels.select("fold", U, I, F.col("label").cast("double").alias("v"), none.alias("b"), none.alias("cp")), "ld_rows")
    t = neighbour_totals(rows, U, I, folds, "signed_as_written" if as_written else "signed", **blocks)
    pred = F.when(F.col("n") > 0, F.col("total") / F.col("n")).otherwise(F.lit(0.0))
    return t.select("fold", F.col("e").alias(U), F.col("c").alias(I), F.col("v").cast("int").alias("label"), pred.alias("pred"), "total", "n")


def _distance(name: str):
    if name not in DISTANCES:
        raise ValueError(f"unknown distance {name!r}; known: {', '.join(sorted(DISTANCES))}")
    return DISTANCES[name]


def _vote(j: DataFrame, test: DataFrame, k: int, distance: str, part: list, zero_norm: str) -> DataFrame:
    zero = (F.col("sq_t") == 0) | (F.col("sq_n") == 0)
    value, has_zero = _distance(distance)[:2]
    d = dec(value(F.col("dot"), F.col("sq_t"), F.col("sq_n")))
    zero = zero if has_zero else F.lit(False)
    scored = j.select(*part, U, I, "nbr", "lv", d.alias("dist"), zero.alias("zero"))
    if zero_norm == "drop":
        scored = scored.where(~F.col("zero"))
    w = Window.partitionBy(*part, U, I).orderBy(F.col("dist").asc(), F.col("nbr").asc())
    top = scored.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
    votes = top.groupBy(*part, U, I).agg(
        F.sum(F.when(F.col("lv") == 1, 1).otherwise(0)).alias("likes"),
        F.sum(F.when(F.col("lv") == 1, 0).otherwise(1)).alias("dislikes"))
    out = test.select(*part, U, I, "label").join(votes, part + [U, I], "left")
    pred = F.when(F.coalesce("likes", F.lit(0)) > F.coalesce("dislikes", F.lit(0)), 1).otherwise(-1)
    return out.select(*part, U, I, "label", pred.cast("int").alias("pred"))

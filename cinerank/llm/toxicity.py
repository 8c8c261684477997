"""Toxicity scores: boosted trees over dense text features, calibrated by isotonic regression."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from cinerank.llm.common import materialize, packed

#: Common insults, as a start for small label tables; the rest of the lexicon is learned from the labels.
SEED_LEXICON = ("idiot idiots moron morons stupid dumb loser losers trash scum clown pathetic worthless disgusting "
                "bastard imbecile fool retard shut hate kill dummkopf idioten arschloch connard imbécile crétin estúpido tonto").split()
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton vous votre tú ti usted vosotros".split())
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", "+": "t"})

TOKEN = re.compile(r"[^\W\d_]+")
MASKED = re.compile(r"[^\W\d_]+[0-9@$!*+]+[^\W\d_]+")
CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
SHOUTED = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{3,}\b")
MARK = re.compile(r"[!?]")
PUNCT = re.compile(r"[.,;:\-\"'()]")
SYMBOL = re.compile(r"[#*$%&|<>@]")
LONG_RUN = re.compile(r"(\w)\1{2,}")
FEATURES = 15  # length of what features() returns


def token_keys(text: str) -> set[str]:
    """The distinct words of a text and their beginnings, as candidates for the lexicon."""
    words = set(TOKEN.findall(text.lower()))
    return words | {w[:k] + "*" for w in words for k in (4, 5, 6) if len(w) > k}


def features(text: str, weights: dict[str, float]) -> list[float]:
    """Densities of the lexicon, its second-person proximity, capitals, punctuation and obfuscation rates."""
    low = text.lower()
    words = TOKEN.findall(low)
    n, chars = max(len(words), 1), max(len(text), 1)
    memo: dict[str, float] = {}

    def weight(w: str) -> float:
        x = memo.get(w)
        if x is None:
            x = memo[w] = max(weights.get(w, 0.0), weights.get(w[:4] + "*", 0.0), weights.get(w[:5] + "*", 0.0), weights.get(w[:6] + "*", 0.0))
        return x

    at = [(i, weight(w)) for i, w in enumerate(words) if weight(w)]
    masked = [m.translate(LEET) for m in MASKED.findall(low)]
    hidden = sum(1 for m in masked if weight(m))
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    k = 0
    for i, _ in at:
        while k < len(you) and you[k] < i - 5:
            k += 1
        near += k < len(you) and you[k] <= i + 5
    total = sum(x for _, x in at)
    seed = sum(1 for w in words if w in _SEED)
    return [100.0 * seed / n, 100.0 * len(at) / n, math.log1p(len(at)), max((x for _, x in at), default=0.0), 100.0 * total / n,
            len({words[i] for i, _ in at}), near / max(len(at), 1), 100.0 * len(you) / n, len(CAPITAL.findall(text)) / chars,
            len(SHOUTED.findall(text)) / n, len(MARK.findall(text)) / n, len(PUNCT.findall(text)) / n,
            (len(masked) + 5.0 * hidden) / n, len(SYMBOL.findall(text)) / n + len(LONG_RUN.findall(low)) / n, math.log1p(len(words))]


_SEED = frozenset(SEED_LEXICON)


def with_features(docs: DataFrame, weights: dict[str, float], text_col: str = "text") -> DataFrame:
    """Rows (row, features array<double>): the packed row and its text's features. No shuffle; null text counts as "". """
    p = packed(docs)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [features(t.as_py() or "", weights) for t in b.column(0).field(at)]
            flat = pa.array(np.array(rows, float).reshape(-1))
            ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * FEATURES)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(ends, flat)], ["row", "features"])

    return p.mapInArrow(run, StructType([p.schema["row"], StructField("features", ArrayType(DoubleType()))]))


def learn_lexicon(train: DataFrame, size: int = 400, min_docs: int = 3) -> dict[str, float]:
    """Weights of up to ``size`` words or word beginnings by their smoothed log odds for label 1; rows (text, label)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t, y in zip(b.column(0), b.column(1), strict=True):
                keys = list(token_keys(t.as_py() or ""))
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([y.as_py()] * len(keys), pa.int32())], ["tok", "y"])

    n = train.agg(F.sum("label"), F.count("*")).first()
    pos, all_ = n[0] or 0, n[1]
    if not 0 < pos < all_:
        return dict.fromkeys(SEED_LEXICON, 3.0)
    counts = train.select("text", F.col("label").cast("int")).mapInArrow(run, "tok string, y int").groupBy("tok").agg(
        F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q"))
    odds = F.log((F.col("p") + 0.2) / (pos + 0.4)) - F.log((F.col("q") + 0.2) / (all_ - pos + 0.4))
    top = (counts.where(F.col("p") >= min_docs).withColumn("w", odds).where(F.col("w") > 2)
           .orderBy((F.col("w") * F.log1p("p")).desc(), "tok").limit(size).collect())
    # a beginning is only kept if it says more than one of its words alone
    return dict.fromkeys(SEED_LEXICON, 3.0) | {r.tok: float(r.w) for r in top}


@dataclass
class Model:
    weights: dict[str, float]
    trees: object | None
    calibration: object | None
    prior: float

    def score(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """Rows (row, score, predicted): the packed row, its score in 0..1 (never null), 1 from 0.5 on."""
        d = with_features(docs, self.weights, text_col)
        if self.trees is None:  # too few labels: the density of the seed lexicon alone
            d = d.select("row", F.least(F.lit(1.0), F.element_at("features", 1) / 4).alias("score"))
        else:
            d = self.calibration.transform(_margin(self.trees, d))
            d = d.select("row", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score"))).alias("score"))
        return d.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _margin(trees, d: DataFrame) -> DataFrame:
    d = trees.transform(d.withColumn("_vector", array_to_vector("features")))
    d = d.withColumn("margin", F.element_at(vector_to_array("rawPrediction"), 2))
    return d.drop("features", "_vector", "rawPrediction", "probability", "prediction")


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, min_rows: int = 40, seed: int = 11) -> Model:
    """Learns from at most ``max_rows`` labelled documents (``labels``: doc_id, label 0/1), taken by hash order.

    That bound keeps the training set small enough to be broadcast by id and to fit the trees in memory; all
    statistics over documents that the scores use come from these rows only. A third teaches the lexicon, so that
    the trees see honest densities; a quarter of the others calibrates the margins. Labels that are null or not
    0 or 1, null ids and labels without a document are ignored; if an id has several labels the largest counts.
    With fewer than ``min_rows`` labels or one class only, the seed lexicon's density is the score."""
    pick = (labels.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
            .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(max_rows))
    pick = materialize(pick.select("doc_id", "label", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(12)).alias("part")), "tox_labels")
    train = docs.select("doc_id", "text").join(F.broadcast(pick), "doc_id").select("text", "label", "part")
    train = materialize(train.repartition(8), "tox_train")
    n, pos = train.agg(F.count("*"), F.sum("label")).first()
    pos = pos or 0
    if n < min_rows or not 3 <= pos <= n - 3:
        return Model(dict.fromkeys(SEED_LEXICON, 3.0), None, None, pos / n if n else 0.0)
    weights = learn_lexicon(train.where("part < 4"))
    rest = with_features(train.where("part >= 4"), weights).select("features", F.col("row.label").cast("double").alias("label"), "row.part")
    rest = materialize(rest.coalesce(4), "tox_features").cache()
    fit_on, hold = rest.where("part < 10"), rest.where("part >= 10")
    if min(x.agg(F.sum("label")).first()[0] or 0 for x in (fit_on, hold)) < 1:
        fit_on = hold = rest
    trees = GBTClassifier(labelCol="label", featuresCol="_vector", maxIter=20, maxDepth=4, stepSize=0.2, minInstancesPerNode=2, seed=seed).fit(
        fit_on.withColumn("_vector", array_to_vector("features")))
    margins = _margin(trees, hold)
    cal = IsotonicRegression(labelCol="label", featuresCol="margin", predictionCol="score").fit(margins.select("margin", "label"))
    rest.unpersist()
    return Model(weights, trees, cal, pos / n)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train_labels(labels: DataFrame) -> DataFrame:
    """The labelled ids that may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return labels.where(~held_out()).select("doc_id", F.col("toxic").alias("label"))


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, train_labels(labels))
    d = model.score(docs.select("doc_id", "text")).select("row.doc_id", "score", "predicted")
    return d.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the model doesn't reject, with the columns of ``docs``. Rows with null text stay."""
    model = fit(docs, train_labels(labels))
    return model.score(docs).where("predicted = 0").select("row.*")

"""Quality scores: random Fourier features of document statistics, ridge by summed normal equations, isotonic calibration."""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from cinerank.llm.common import materialize, packed

UPPER, LOWER, LETTER, DIGIT, BLANK, END, BREAK, SHOUT, SYMBOL, OTHER = range(10)
_TABLE: list[np.ndarray] = []
STATISTICS = 20  # length of what statistics() returns


def _classes() -> np.ndarray:
    """The class of each of the first 65,536 code points; those beyond count as the last of them."""
    if not _TABLE:
        kind = {"Lu": UPPER, "Lt": UPPER, "Ll": LOWER, "Lo": LETTER, "Lm": LETTER, "Nd": DIGIT, "Zs": BLANK, "Cc": BLANK,
                "Sm": SYMBOL, "Sc": SYMBOL, "Sk": SYMBOL, "So": SYMBOL}
        t = np.array([kind.get(unicodedata.category(chr(c)), OTHER) for c in range(1 << 16)], np.uint8)
        for chars, c in ((".,;:'\"()-", END), ("!?", SHOUT), ("#*%&@_\\/", SYMBOL), ("\n", BREAK)):
            t[[ord(x) for x in chars]] = c
        _TABLE.append(t)
    return _TABLE[0]


def statistics(text: str) -> list[float]:
    """Shares of character classes, word and line lengths, repetition of words, neighbouring words and lines."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    count = np.bincount(_classes()[np.minimum(code, 0xFFFF)], minlength=10)
    words = text.split()
    n, chars, letters = len(words), max(len(text), 1), max(int(count[:3].sum()), 1)
    size = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in text.split("\n") if x.strip()]
    times = Counter(words)
    most = sum(k for _, k in times.most_common(3))
    again = sum(1 for a, b in zip(words, words[1:], strict=False) if a == b)
    pairs = len(set(zip(words, words[1:], strict=False)))
    m = max(n, 1)
    return [math.log1p(n), count[UPPER] / letters, count[LOWER] / letters, count[DIGIT] / chars, count[BLANK] / chars,
            count[END] / m, count[SHOUT] / m, count[SYMBOL] / m, count[OTHER] / m, letters / chars,
            float(size.mean()) if n else 0.0, float(size.std()) if n else 0.0, math.log1p(float(size.max())) if n else 0.0,
            len(times) / m, most / m, again / m, pairs / max(n - 1, 1), math.log1p(n / max(len(lines), 1)),
            len(set(lines)) / max(len(lines), 1), sum(1 for w in words if not any(map(str.isalnum, w))) / m]


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows (row, stats): the packed row and the statistics of its whole text; null counts as "". No shuffle."""
    p, at = packed(docs), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = np.array([statistics(t.as_py() or "") for t in b.column(0).field(at)], float).reshape(-1)
            ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * STATISTICS)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(ends, pa.array(flat))], ["row", "stats"])

    return p.mapInArrow(run, StructType([p.schema["row"], StructField("stats", ArrayType(DoubleType()))]))


@dataclass
class Fourier:
    """Cosines that approximate a Gaussian kernel of the given width over standardised statistics, and a constant."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    phase: np.ndarray

    @classmethod
    def draw(cls, mean: np.ndarray, scale: np.ndarray, size: int, width: float, seed: int) -> Fourier:
        rng = np.random.default_rng(seed)
        return cls(mean, scale, rng.normal(size=(len(mean), size)) / width, rng.uniform(0, 2 * np.pi, size))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        z = np.cos(x @ self.weights + self.phase) * math.sqrt(2 / len(self.phase))
        return np.hstack([z, np.ones((len(x), 1))])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, STATISTICS)


def normal_equations(train: DataFrame, fourier: Fourier, folds: int, fan_in: int = 16) -> list[tuple[np.ndarray, np.ndarray, float, float]]:
    """Per fold of ``train`` (stats, label, fold): Z'Z, Z'y, y'y and the number of rows.

    Each task adds up its own rows, a batch at a time, and the tasks' sums are added ``fan_in`` at a time by further tasks,
    so neither a task nor the driver holds more than a few sums, however many rows and tasks there are."""
    size = len(fourier.phase) + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            x, y, fold = _matrix(b.column(0)), b.column(1).to_numpy(), b.column(2).to_numpy()
            for begin in range(0, len(y), 4096):
                part = slice(begin, begin + 4096)
                z = np.hstack([fourier(x[part]), y[part, None]])
                for f in np.unique(fold[part]).tolist():
                    own = z[fold[part] == f]
                    total[f] = total.get(f, 0) + own.T @ own
        yield _rows(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for f, v in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                total[f] = total.get(f, 0) + np.frombuffer(v.as_py()).reshape(size + 1, size + 1)
        yield _rows(total)

    def _rows(total: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["fold", "sums"])

    kind = "fold int, sums binary"
    out = train.select("stats", "label", "fold").mapInArrow(sums, kind)
    out = materialize(out, "normal_equations")
    while (n := out.count()) > fan_in * folds:
        out = materialize(out.repartition(-(-n // (fan_in * folds))).mapInArrow(add, kind), "normal_equations")
    total: dict[int, np.ndarray] = {}
    for r in out.collect():
        total[r.fold] = total.get(r.fold, 0) + np.frombuffer(bytes(r.sums)).reshape(size + 1, size + 1)
    return [(v[:-1, :-1], v[:-1, -1], float(v[-1, -1]), float(v[size - 1, size - 1])) for _, v in sorted(total.items())]


def pool_adjacent(x: list[float], weight: list[float], total: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of total/weight on ascending x: the least and greatest x of each level, and the levels twice."""
    blocks: list[list[float]] = []  # from, to, weight, total
    for a, w, t in zip(x, weight, total, strict=True):
        blocks.append([a, a, w, t])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            _, hi, w, t = blocks.pop()
            blocks[-1][1] = hi
            blocks[-1][2] += w
            blocks[-1][3] += t
    return np.array([v for b in blocks for v in b[:2]]), np.array([b[3] / b[2] for b in blocks for _ in range(2)])


@dataclass
class Model:
    prior: float
    fourier: Fourier | None = None
    weights: np.ndarray | None = None
    x: np.ndarray | None = None
    y: np.ndarray | None = None

    def score(self, rows: DataFrame) -> DataFrame:
        """Rows (row, stats) to (row, score): calibrated, in 0..1 and never null."""
        if self.fourier is None:
            return rows.select("row", F.lit(self.prior).alias("score"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = _matrix(b.column(1))
                raw = np.concatenate([np.empty(0), *(self.fourier(x[k:k + 4096]) @ self.weights for k in range(0, len(x), 4096))])
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.interp(raw, self.x, self.y))], ["row", "score"])

        return rows.mapInArrow(run, StructType([rows.schema["row"], StructField("score", DoubleType())]))


def fit(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", size: int = 256, width: float = 4.0,
        ridges: tuple[float, ...] = (1e-5, 1e-4, 1e-3, 1e-2), folds: int = 4, steps: int = 1000, seed: int = 12) -> Model:
    """Learns from all labelled documents: ``rows`` (row, stats) and ``labels`` (``id_col``, label 0/1).

    Statistics meet labels, not texts. Sums by fold give the model without each fold, so the ridge (a share of the rows)
    with the least squared error on rows left out is chosen from sums alone, and the calibration also sees each row through
    the model that has not seen it. It pools left-out scores counted in steps of 1/``steps``, at most 3 x ``steps`` of them.
    Labels that are null or not 0 or 1, null ids and labels without a document are ignored; of several labels of an id the
    largest counts; repeated rows of an id count each. With one class only, or fewer labels than 10, every score is the
    smoothed share of label 1."""
    want = labels.where(F.col(id_col).isNotNull() & F.col("label").isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max("label").cast("double").alias("label"))
    train = rows.select(F.col(f"row.`{id_col}`").alias("id"), "stats").join(want, "id")
    train = train.select("stats", "label", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(folds)).cast("int").alias("fold"))
    train = materialize(train, "quality_train")
    at = [F.element_at("stats", k + 1) for k in range(STATISTICS)]
    first = train.agg(F.count("*").alias("n"), F.sum("label").alias("pos"), F.array(*map(F.avg, at)).alias("mean"), F.array(*map(F.stddev_pop, at)).alias("sd")).first()
    n, pos = first.n, first.pos or 0.0
    prior = (pos + 1) / (n + 2)
    if n < 10 or not 0 < pos < n:
        return Model(prior)
    sd = np.array(first.sd)
    fourier = Fourier.draw(np.array(first.mean), np.where(sd > 1e-9, sd, 1.0), size, width, seed)
    sums = normal_equations(train, fourier, folds)
    whole = [sum(s[k] for s in sums) for k in range(4)]

    def solve(ridge: float, left_out: int | None = None) -> np.ndarray:
        zz, zy, _, m = [a - (sums[left_out][k] if left_out is not None else 0) for k, a in enumerate(whole)]
        return np.linalg.solve(zz + ridge * max(m, 1.0) * np.eye(size + 1), zy)

    def error(ridge: float) -> float:
        return sum(w @ zz @ w - 2 * w @ zy + yy for k, (zz, zy, yy, _) in enumerate(sums) for w in [solve(ridge, k)])

    ridge = min(ridges, key=error)
    order = sorted(r.fold for r in train.select("fold").distinct().collect())
    left_out = {f: solve(ridge, k) if len(sums) > 1 else solve(ridge) for k, f in enumerate(order)}

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y, fold = _matrix(b.column(0)), b.column(1).to_numpy(), b.column(2).to_numpy()
            count: Counter = Counter()
            hits: Counter = Counter()
            for begin in range(0, len(y), 4096):
                z, part = fourier(x[begin:begin + 4096]), slice(begin, begin + 4096)
                for f, w in left_out.items():
                    own = fold[part] == f
                    step = np.clip(np.rint(z[own] @ w * steps), -steps, 2 * steps).astype(int).tolist()
                    count.update(step)
                    hits.update(s for s, v in zip(step, y[part][own], strict=True) if v)
            keys = sorted(count)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([count[k] for k in keys], pa.int64()), pa.array([hits[k] for k in keys], pa.int64())], ["step", "n", "hits"])

    steps_seen = train.select("stats", "label", "fold").mapInArrow(bins, "step int, n long, hits long").groupBy("step").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    seen = steps_seen.orderBy("step").collect()
    x, y = pool_adjacent([r.step / steps for r in seen], [r.n for r in seen], [r.hits for r in seen])
    return Model(prior, fourier, solve(ridge), x, y)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (row, score, predicted): each packed row of ``docs``, its score, and 1 if that reaches ``threshold``.

    ``labels`` has ``id_col`` and label. Only the text enters a score. The statistics of each text are computed once and
    written; every later pass reads those. Repeated rows, clashing names and an empty table need no care."""
    rows = materialize(with_statistics(docs, text_col), "quality_statistics")
    model = fit(rows, labels, id_col)
    return model.score(rows).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality_score_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from the labels of ids that are not held out."""
    learn = labels.where(~held_out()).select("doc_id", F.col("quality").alias("label"))
    kept = materialize(with_statistics(docs.select("doc_id", "text")).select(F.struct("row.doc_id").alias("row"), "stats"), "quality_statistics")
    d = fit(kept, learn).score(kept).select("row.doc_id", "score")
    return d.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))

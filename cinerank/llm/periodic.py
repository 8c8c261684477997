"""Runs of periodically repeated words, found with minimizers at several scales."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from cinerank.llm.common import packed

CHUNK = 1 << 20  # words that are searched at once; a longer text is a chunk of its own
BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []

RUN = ArrayType(StructType([StructField(c, LongType()) for c in ("start", "length", "period")]))
RUN_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS.clear()
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            x = np.full(max(n, CHUNK), base, np.uint64)
            x[0] = 1
            _POWERS.append(np.multiply.accumulate(x))
    return _POWERS


def seeds(total: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places m and lags d, scale/2 < d <= scale, of equal minimizers that follow each other.

    ``total`` are the prefix sums of the hashed words times powers of the base. Each window of scale/2 starts selects
    the one with the least hashed gram of ``scale`` words. In a run of such a period a gram only comes again after
    whole periods, and the windows at the run's begin and one period later select the same place of the period, so
    every run of at least four periods yields its period as a lag in its first scale/2 words."""
    n = len(total) - 1
    up, down = _powers(n + 1)
    width, bits = scale // 2, np.uint64(max(n - 1, 1).bit_length())
    low = _mix((total[scale:] - total[:-scale]) * down[:n - scale + 1])
    low = (low >> bits << bits) | np.arange(len(low), dtype=np.uint64)
    step = 1
    while step < width and len(low) > step:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    low = np.sort(low[np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))])
    at = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    lag = np.diff(at)
    same = (low[1:] >> bits == low[:-1] >> bits) & (lag > width) & (lag <= scale)
    m, d = at[:-1][same], lag[same]
    inside = m + 3 * d <= n
    m, d = m[inside], d[inside]
    # from the first such place of a run on, two more periods must follow
    again = (total[m + 2 * d] - total[m]) * up[d] == total[m + 3 * d] - total[m + d]
    m, d = m[again], d[again]
    order = np.lexsort((m, d))
    return m[order], d[order]


def stretch(w: np.ndarray, m: int, d: int) -> tuple[int, int]:
    """The longest range around m in which each word equals the one d words later; blocks grow, so long ones cost their length."""
    lo, hi, step = m, m, 64
    while lo > 0:
        b = max(0, lo - step)
        bad = np.flatnonzero(w[b:lo] != w[b + d:lo + d])
        if len(bad):
            lo = b + int(bad[-1]) + 1
            break
        lo, step = b, 2 * step
    step, last = 64, len(w) - d
    while hi < last:
        b = min(last, hi + step)
        bad = np.flatnonzero(w[hi:b] != w[hi + d:b + d])
        if len(bad):
            return lo, hi + int(bad[0])
        hi, step = b, 2 * step
    return lo, hi


def find_runs(w: np.ndarray, sizes: np.ndarray, exponent: int = 4, least: int = 6, short: int = 16) -> np.ndarray:
    """Rows (start, end, period), by start and period, of all runs in the texts that ``w`` joins.

    ``w`` holds word numbers, each text ended by a number that occurs nowhere else; ``sizes`` are the texts' words,
    in descending order, so that each scale reads only the texts that are long enough for it."""
    found = [np.empty((0, 3), np.int64)]
    longest = int(sizes[0]) // exponent if len(sizes) else 0
    ends = np.cumsum(sizes + 1)
    for q in range(1, min(short, longest) + 1):
        n = int(ends[np.searchsorted(-sizes, -exponent * q, side="right") - 1])
        same = np.flatnonzero(w[q:n] == w[:n - q])
        if not len(same):
            continue
        cut = np.flatnonzero(np.diff(same) != 1)
        begin, end = same[np.concatenate([[0], cut + 1])], same[np.concatenate([cut, [len(same) - 1]])] + 1 + q
        ok = end - begin >= max(least, exponent * q)
        found.append(np.stack([begin[ok], end[ok], np.full(ok.sum(), q)], 1))
    scale = 2 * short
    if scale // 2 < longest:
        total = np.zeros(len(w) + 1, np.uint64)
        np.cumsum(_mix(w.astype(np.uint64) * np.uint64(BASE)) * _powers(len(w) + 1)[0][:len(w)], out=total[1:])
    while scale // 2 < longest:
        n = int(ends[np.searchsorted(-sizes, -exponent * (scale // 2 + 1), side="right") - 1])
        done = (0, 0)  # lag, and where its last stretch ends
        for m, d in zip(*(x.tolist() for x in seeds(total[:n + 1], scale)), strict=True):
            if d == done[0] and m < done[1]:
                continue
            lo, hi = stretch(w[:n], m, d)
            done = d, hi
            if hi - lo + d >= max(least, exponent * d):
                found.append(np.array([[lo, hi + d, d]]))
        scale *= 2
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    # a run also shows at multiples of its period: the least one of equal ranges is its own
    first = np.concatenate([[True], (runs[1:, :2] != runs[:-1, :2]).any(1)])[:len(runs)]
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def runs_of_texts(texts: list[str], exponent: int = 4, least: int = 6, short: int = 16) -> list[tuple[list[tuple[int, int, int]], str]]:
    """For each text its runs (start, length, period) and the text without the words that a run repeats."""
    split = [t.encode().split() for t in texts]  # bytes are split at exactly the six ASCII white characters
    order = sorted(range(len(split)), key=lambda k: -len(split[k]))
    number: dict[bytes, int] = {}
    w = np.empty(sum(map(len, split)) + len(split), np.int64)
    sizes, at = np.array([len(split[k]) for k in order], np.int64), 0
    for r, k in enumerate(order):
        n = len(split[k])
        w[at:at + n] = [number.setdefault(x, len(number)) for x in split[k]]
        w[at + n] = -1 - r
        at += n + 1
    runs = find_runs(w, sizes, exponent, least, short)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    owner = np.searchsorted(begins, runs[:, 0], side="right") - 1
    out: list[tuple[list[tuple[int, int, int]], str]] = [([], b" ".join(x).decode()) for x in split]
    for r in np.unique(owner):
        k, own = order[r], runs[owner == r] - [begins[r], begins[r], 0]
        keep = np.ones(len(split[k]), bool)
        for a, b, q in own:
            keep[a + q:b] = False
        spans = [(a, b - a, q) for a, b, q in own.tolist()]
        out[k] = spans, b" ".join(x for x, y in zip(split[k], keep, strict=True) if y).decode()
    return out


def collapse_runs(docs: DataFrame, text_col: str = "text", exponent: int = 4, least: int = 6, short: int = 16) -> DataFrame:
    """Rows (row, runs, collapsed): the packed row, its runs of words and its text without what they repeat.

    A run is a longest stretch of at least ``exponent`` periods and ``least`` words in which words one period apart are
    equal, the period being its smallest. Periods up to ``short`` words are found by comparing the text with itself at
    that lag; longer ones at scales of twice, four times that and so on by equal minimizers one period apart, and every
    one of them is checked and extended word by word. Collapsing keeps a run's first period; words go if any run
    repeats them. Words are separated by ASCII white space. Null, empty and wordless texts have no runs and collapse to
    "". Each row is judged by itself: repeated rows, ids and clashing names don't matter, an empty table gives none.
    There is no shuffle; a task holds one batch of texts and the numbers of about a million words."""
    if exponent < 4:
        raise ValueError("minimizers find runs of four periods or more")
    p, at = packed(docs), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, column = b.column(0), b.column(0).field(at)
            begin, held, texts = 0, 0, []
            for k, t in enumerate(column):
                text = t.as_py() or ""
                if texts and held + len(text) > 6 * CHUNK:
                    yield _out(rows.slice(begin, len(texts)), texts)
                    begin, held, texts = k, 0, []
                texts.append(text)
                held += len(text)
            if texts:
                yield _out(rows.slice(begin, len(texts)), texts)

    def _out(rows: pa.Array, texts: list[str]) -> pa.RecordBatch:
        found = runs_of_texts(texts, exponent, least, short)
        runs = [[dict(zip(("start", "length", "period"), x, strict=True)) for x in r] for r, _ in found]
        return pa.RecordBatch.from_arrays([rows, pa.array(runs, RUN_ARROW), pa.array([c for _, c in found], pa.string())], ["row", "runs", "collapsed"])

    return p.mapInArrow(run, StructType([p.schema["row"], StructField("runs", RUN), StructField("collapsed", StringType())]))


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; where crc32(doc_id) is a multiple of 10, the text is made periodic from a place on that the
    crc gives: word i >= a becomes word a + (i - a) % p of the input. A null doc_id changes nothing."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    d = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words")).withColumn("n", F.size("words"))
    g = F.expr("h div 10")
    d = d.withColumn("a", F.when(F.col("n") > 0, g % F.col("n"))).withColumn("p", F.expr("1 + (n - a) div (3 + h div 10 % 8)"))
    changed = F.expr("array_join(transform(words, (x, i) -> case when i < a then x else words[int(a + (i - a) % p)] end), ' ')")
    return d.select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))


def periodic_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run with its exponent in thousandths, digests of all runs and of the collapsed text."""
    line = lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n"))
    top = F.array_min(F.transform("runs", lambda x: F.struct((-x["length"]).alias("neg"), x["start"].alias("start"), x["period"].alias("period"))))
    d = collapse_runs(planted(docs)).withColumn("top", top)
    length = -F.col("top.neg")
    return d.select("row.doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), length.alias("length"),
                    F.col("top.period").alias("period"), F.expr("1000 * -top.neg div top.period").alias("exponent_milli"),
                    F.sha2(F.concat_ws("", F.transform("runs", line)), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))

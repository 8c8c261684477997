"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import UPPER, components, deal, groups, materialize, packed, split_buckets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {ord(c): ord(c.lower()) for c in UPPER}


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash: a bit is 1 if it is set in over half of the shingles' XXH64 values; 0 without words."""
    import xxhash

    w = WORD.findall(_lower(text or ""))
    if not w:
        return 0
    if len(w) <= shingle:
        grams = [" ".join(w)]
    else:
        grams = map(" ".join, zip(*(w[i:] for i in range(shingle))))
    f = xxhash.xxh64_intdigest
    h = np.array([f(g, 42) for g in grams], "<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 4096):
        part = h[k:k + 4096]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def _lower(t: str) -> str:
    return t.lower() if t.isascii() else t.translate(LOWER)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """Rows (``id_col``, fp long) for every row; the long holds the 64 bits. Null and wordless texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, fp long").withColumnRenamed("id", id_col)


def _probes(segments: int, radius: int):
    """For distinct fingerprints: a table row per segment, and a probe row for each other value in the Hamming ball
    of ``radius`` around the segment. Of two values one bit apart only the one that lacks the bit probes."""
    width = 64 // segments
    mask = np.uint64((1 << width) - 1)

    def balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 4096):
                fp = whole.column(0).slice(k, 4096).to_numpy(zero_copy_only=False).view(np.uint64)
                keys, fps, own = [], [], []
                for s in range(segments):
                    seg = (fp >> np.uint64(s * width)) & mask
                    reach = [(seg, np.zeros(len(seg), np.int64), fp)]  # value, next bit to change, fingerprint
                    tag = np.uint64(s)
                    for r in range(radius + 1):
                        nxt = []
                        for v, at, f in reach:
                            keys.append((v * np.uint64(segments) + tag) if width < 62 else v)
                            fps.append(f)
                            own.append(np.full(len(f), r == 0))
                            if r < radius:
                                for bit in range(width):
                                    ok = (at <= bit) & (((v >> np.uint64(bit)) & np.uint64(1)) == 0 if radius == 1 else True)
                                    if ok.any():
                                        nxt.append((v[ok] ^ np.uint64(1 << bit), np.full(int(ok.sum()), bit + 1), f[ok]))
                        reach = nxt
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(fps).view(np.int64)), pa.array(np.concatenate(own))],
                    ["key", "fp", "own"])

    return balls


def fingerprint_links(distinct_fps: DataFrame, max_bits: int = 3, segments: int = 2, block: int = 4096) -> DataFrame:
    """Rows (a, b) that connect the same fingerprints as all links of up to ``max_bits`` differing bits.

    Multi-index hashing: two fingerprints within ``max_bits`` agree up to ``max_bits // segments`` bits in at
    least one segment, so the small ball around each segment value meets the other's table row. Whole distances
    are verified inside each bucket; a bucket gives a spanning forest of its links, never all their pairs."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, ["key", "bi", "bj"]):
            own = t.column("own").to_numpy(zero_copy_only=False)
            if not own.any():
                continue
            fp = t.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            root = _roots(fp, own, max_bits)
            pick = root != np.arange(len(root))
            if pick.any():
                yield pa.RecordBatch.from_arrays([pa.array(fp[pick].view(np.int64)), pa.array(fp[root[pick]].view(np.int64))], ["a", "b"])

    rows = distinct_fps.select("fp").mapInArrow(_probes(segments, max_bits // segments), "key long, fp long, own boolean")
    return deal(split_buckets(rows, "key", "fp", "own", block).select("key", "bi", "bj", "fp", "own"), "key", "bi", "bj").mapInArrow(verify, "a long, b long")


def _roots(fp: np.ndarray, own: np.ndarray, max_bits: int, strip: int = 256) -> np.ndarray:
    """The smallest place reachable from each over links of up to ``max_bits`` bits with an own end; distances are worked
    out a strip of rows at a time, so a bucket of two blocks takes a few megabytes, not its square."""
    n = len(fp)
    label = np.arange(n)
    while True:
        new = label.copy()
        for k in range(0, n, strip):
            part = slice(k, k + strip)
            near = np.bitwise_count(fp[part, None] ^ fp) <= max_bits
            near &= own[part, None] | own
            new[part] = np.minimum(label[part], np.where(near, label, n).min(axis=1))
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _rooted(fps: DataFrame, max_bits: int, segments: int, block: int) -> DataFrame:
    """Rows (fp, root) for the distinct fingerprints of ``fps``."""
    nodes = materialize(fps.select("fp").distinct(), "fp_nodes")
    comp = components(fingerprint_links(nodes, max_bits, segments, block))
    return nodes.join(comp, nodes.fp == comp.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 3, segments: int = 2, block: int = 4096) -> DataFrame:
    """Rows (``id_col``, fp long, component_id) for every row of ``docs``.

    component_id is the smallest id reachable over links of up to ``max_bits`` bits. Equal fingerprints are one
    node, so a group of copies costs one row per task and no pairs. Null ids take part but are never the
    smallest; a component of null ids only has a null component_id. Empty texts share fingerprint zero."""
    fps = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    first = fps.groupBy("fp").agg(F.min(id_col).alias("first_id"))
    rooted = first.join(_rooted(fps, max_bits, segments, block), "fp")
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    label = rooted.join(smallest, "root").select("fp", "component_id")
    return fps.join(label, "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3, segments: int = 2, block: int = 4096) -> DataFrame:
    """Exactly one row of ``docs`` per component: the one with the smallest id, null ids last, of equal ids the one whose
    text has the smallest hash; of rows that have the same id and text, the one with the smallest hash of all columns.

    So a document that is nobody's near copy stays, whatever its id, and of several rows with an id each may stay for its
    own component. Columns are those of ``docs``; they must have types that Spark can hash."""
    marked = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h")).alias("mark"), F.col(text_col).alias("text"))
    fps = materialize(fingerprints(marked, "mark", "text", shingle), "fingerprints")
    # one row per fingerprint, combined map-side, then one per component
    first = F.min(F.struct(F.col("mark.id").isNull().alias("none"), F.col("mark.id").alias("id"), F.col("mark.h").alias("h")))
    best = fps.groupBy("fp").agg(first.alias("best")).join(_rooted(fps, max_bits, segments, block), "fp")
    keep = best.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.id").alias("keep"), F.col("best.h").alias("keep_h"))
    whole = packed(docs, F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"))
    kept = whole.join(keep, F.col("id").eqNullSafe(F.col("keep")) & (F.col("h") == F.col("keep_h")))
    return kept.groupBy("id", "h").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")


def simhash_digest(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint as 16 hex digits, component_id."""
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

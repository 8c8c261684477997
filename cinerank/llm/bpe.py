"""Byte-level BPE encoding and decoding with a local rank file."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: A match of the split pattern never goes on from a letter, digit or full stop into a space or a line break.
SAFE = re.compile(r"(?<=[A-Za-z0-9.])(?=[ \n])")

_ENCODERS: dict = {}


def _encoder(data: bytes, pattern: str):
    key = (hashlib.sha256(data).digest(), pattern)
    if key not in _ENCODERS:
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        _ENCODERS[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[key]


def pieces(text: str, size: int) -> Iterator[str]:
    """``text`` cut at safe places, each piece the first that reaches ``size`` characters. Where no safe
    place follows, the rest is one piece: the ids are the same however the text is cut."""
    start = 0
    while len(text) - start > size:
        m = SAFE.search(text, start + size)
        if not m:
            break
        yield text[start:m.start()]
        start = m.start()
    yield text[start:]


def encode_ids(enc, text: str, size: int) -> list[int]:
    if len(text) <= size:
        return enc.encode_ordinary(text)
    out: list[int] = []
    for p in pieces(text, size):
        out += enc.encode_ordinary(p)
    return out


def rank_bytes(spark: SparkSession, path: str):
    """The rank file, read by Spark on the driver side (about 1 MB, fixed) and broadcast to the tasks."""
    if "://" in path:
        data = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    else:
        with open(path, "rb") as f:
            data = f.read()
    return spark.sparkContext.broadcast(data)


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           piece_chars: int = 65536) -> DataFrame:
    """Rows (``id_col``, ids array<int>) for every row of ``docs``; null text is empty and has no ids.

    No shuffle: each text is encoded where it is read. Texts above ``piece_chars`` characters are encoded
    piece by piece, cut only where no match of the pattern can span the cut. Null ids and repeated rows pass through."""
    data = rank_bytes(docs.sparkSession, rank_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(data.value, pattern)
        for b in batches:
            for k in range(0, b.num_rows, 256):
                c = b.slice(k, 256)
                ids = [np.array(encode_ids(enc, t or "", piece_chars), np.int32) for t in c.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([c.column(0), _lists(ids, pa.int32())], ["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows (``id_col``, data binary): the raw bytes that the ids stand for; null ids give empty bytes."""
    data = rank_bytes(tokens.sparkSession, rank_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(data.value, pattern)
        for b in batches:
            for k in range(0, b.num_rows, 256):
                c = b.slice(k, 256)
                out = [enc.decode_bytes(i or []) for i in c.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([c.column(0), pa.array(out, pa.binary())], ["id", "data"])

    kind = tokens.schema[id_col].dataType.simpleString()
    return tokens.select(id_col, ids_col).mapInArrow(run, f"id {kind}, data binary").withColumnRenamed("id", id_col)


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int32), kind))


def bpe_digest(docs: DataFrame, rank_file: str, pattern: str, piece_chars: int = 65536) -> DataFrame:
    """Per document: doc_id, n_tokens, SHA-256 of the ids (little-endian 32-bit) and of the decoded bytes.

    Encoding and decoding run in one pass over the texts, with the functions that ``encode`` and ``decode`` use."""
    data = rank_bytes(docs.sparkSession, rank_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(data.value, pattern)
        for b in batches:
            n, h, d = [], [], []
            for t in b.column(1).to_pylist():
                ids = encode_ids(enc, t or "", piece_chars)
                n.append(len(ids))
                h.append(hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
                d.append(hashlib.sha256(enc.decode_bytes(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(h, pa.string()), pa.array(d, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")

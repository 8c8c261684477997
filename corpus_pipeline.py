"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, mixing, byte-level BPE, each on what the last one kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Stages
define what they do with nulls, empty texts and repeated rows in their operators' docstrings."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cinerank.llm import bpe, line_dedup, mixing, simhash, toxicity
from cinerank.llm.common import materialize, table

#: Byte-level BPE ranks; a path that the driver can read.
RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity model rejects."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that an earlier document holds; every document stays, with its text cut and n_chars brought up to date."""
    from pyspark.sql import functions as F

    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: 3-word shingles, fingerprints up to 3 bits apart."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of domains below their target weight; rates are 1 at least, so no document is lost."""
    return mixing.mix(docs, table(spark, sf_dir, "labels"), mixing.TARGETS, keep_all=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the token ids and of the bytes they decode to, for every row."""
    return bpe.bpe_digest(docs, RANK_FILE, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: Boosted trees, fingerprints and fitted rates can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

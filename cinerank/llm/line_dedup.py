"""Line deduplication across documents (exploded line hashes, document counts, reassembly by position)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import WHITE, hash128, lower_ascii, materialize, packed


def line_key(line):
    """The line without white space ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lowered."""
    return lower_ascii(F.btrim(line, F.lit(WHITE)))


def dedup_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` with its text deduplicated, plus ``_n_lines`` and ``_n_dropped``; other columns are kept.

    A line whose key has at least ``min_chars`` code points and occurs in at least ``min_docs`` documents is
    dropped everywhere but in the smallest document id that holds it; that document keeps all its copies.

    Null or empty text is one empty line and comes back as "". Rows with a null id are returned unchanged in
    their lines and are not counted as documents. Rows that repeat an id count as one document; each row
    is cut by its own lines. Extra columns pass through; ``_n_lines`` and ``_n_dropped`` are replaced if there already.

    Lines are compared by a 128-bit hash of the key. Per key only the number of documents and the smallest id are
    kept, both combined map-side, so a line in a third of all documents costs one row per task; the join that
    brings the verdict back to the lines can be split by AQE on its line side. The text itself is shuffled
    once, to meet the positions that it loses."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    h1, h2 = hash128(line_key(F.col("_line")))
    rid = F.xxhash64(F.lit(3), text)
    lines = (docs.where(F.col(id_col).isNotNull())
             .select(F.col(id_col).alias("_doc"), rid.alias("_rid"), F.split(text, "\n", -1).alias("_all"))
             .select("_doc", "_rid", F.posexplode("_all").alias("_pos", "_line"))
             .where(F.length("_line") >= min_chars)
             .where(F.length(F.btrim("_line", F.lit(WHITE))) >= min_chars)
             .select("_doc", "_rid", "_pos", h1.alias("_h1"), h2.alias("_h2")))
    lines = materialize(lines, "lines")
    if min_docs <= 2:  # two documents at least: the smallest and the largest id differ
        shared = (lines.groupBy("_h1", "_h2").agg(F.min("_doc").alias("_first"), F.max("_doc").alias("_last"))
                  .where((F.col("_first") < F.col("_last")) if min_docs == 2 else F.lit(True)).drop("_last"))
    else:
        shared = (lines.groupBy("_h1", "_h2", "_doc").agg(F.lit(1).alias("_one"))
                  .groupBy("_h1", "_h2").agg(F.min("_doc").alias("_first"), F.count("*").alias("_n"))
                  .where(F.col("_n") >= min_docs).drop("_n"))
    drops = (lines.join(shared, ["_h1", "_h2"]).where(F.col("_doc") > F.col("_first"))
             .groupBy("_doc", "_rid").agg(F.sort_array(F.collect_set("_pos")).alias("_drop")))
    d = packed(docs, F.col(id_col).alias("_doc"), rid.alias("_rid")).join(drops, ["_doc", "_rid"], "left")
    whole = F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))  # taken from the row after the join: the text travels once
    d = d.withColumn("_lines", F.split(whole, "\n", -1))
    ends = F.array_append(F.col("_drop"), F.size("_lines"))  # the kept runs lie between the dropped positions
    after = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.element_at("_drop", i) + 1)
    runs = F.transform(ends, lambda p, i: F.slice(F.col("_lines"), after(i) + 1, p - after(i)))
    kept = F.when(F.col("_drop").isNull(), whole).otherwise(F.array_join(F.flatten(runs), "\n"))
    dropped = F.when(F.col("_drop").isNull(), F.lit(0)).otherwise(F.size("_drop")).cast("long")
    out = d.select("row", kept.alias("_kept"), F.size("_lines").cast("long").alias("_n"), dropped.alias("_m"))
    names = [c for c in docs.columns if c not in ("_n_lines", "_n_dropped")]
    cut = [F.col("_kept").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in names]
    return out.select(*cut, F.col("_n").alias("_n_lines"), F.col("_m").alias("_n_dropped"))


def line_dedup_digest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_lines before dropping, n_dropped, SHA-256 of the kept text."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
with l as (
  select doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from (select doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as pos
        from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents) s) t),
s as (select k, min(doc_id) as first_doc from l where length(k) >= 10 group by k having count(distinct doc_id) >= 2),
m as (select l.doc_id, l.pos, l.line, coalesce(l.doc_id > s.first_doc, false) as dropped from l left join s on l.k = s.k)
select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from m group by doc_id
"""

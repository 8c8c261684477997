"""Quality rules as a short-circuit cascade, in DataFrame functions only."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import WHITE, materialize

SPACE = r"[\x20\x09-\x0D]+"


def text_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus the word statistics of its whole texts; null text counts as empty.

    n_words, word_chars (code points in words), n_symbols (characters of ``#*$%&|<>``), n_lines (lines
    with a word), n_dup_lines (those equal to an earlier one), n_repeat_words (words inside 3-word windows found at
    least twice). All within the row: no shuffle. Windows are compared by a 64-bit hash; the positions are only
    worked out for texts in which some window repeats."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    body = F.btrim(text, F.lit(WHITE))
    d = docs.withColumn("_words", F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPACE, -1)))
    d = d.withColumn("n_words", F.size("_words").cast("long"))
    windows = F.transform("_words", lambda w, i: F.xxhash64(w, F.get(F.col("_words"), i + 1), F.get(F.col("_words"), i + 2)))
    d = d.withColumn("_win", F.when(F.col("n_words") >= 3, F.slice(windows, 1, F.greatest(F.size("_words") - 2, F.lit(0))))
                     .otherwise(F.array().cast("array<bigint>")))
    repeats = F.size(F.array_distinct("_win")) < F.size("_win")
    d = d.withColumn("_sorted", F.when(repeats, F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = F.filter("_sorted", lambda x, k: (x.h == F.get(F.col("_sorted"), k - 1).h) | (x.h == F.get(F.col("_sorted"), k + 1).h))
    covered = F.size(F.array_distinct(F.flatten(F.transform(same, lambda x: F.array(x.i, x.i + 1, x.i + 2)))))
    d = d.withColumn("n_repeat_words", F.when(F.col("_sorted").isNull(), F.lit(0)).otherwise(covered).cast("long"))
    d = d.withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
    d = d.withColumn("n_symbols", (F.size(F.split(text, r"[#*$%&|<>]", -1)) - 1).cast("long"))
    d = d.withColumn("_lines", F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != ""))
    d = d.withColumn("n_lines", F.size("_lines").cast("long"))
    d = d.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    return d.drop("_win", "_sorted")


@dataclass(frozen=True)
class Rule:
    """A name and a condition under which a document is rejected (over ``text_stats`` columns)."""

    name: str
    rejects: Column


def default_rules(max_symbols: float = 0.1, max_dup_lines: float = 0.5, word_len: tuple = (3, 10), max_words: int = 100_000,
                  max_ellipsis: float = 0.3, max_bullets: float = 0.9, min_letters: float = 0.5) -> list[Rule]:
    """The published heuristics for web text: symbols per word, duplicate and bullet lines, ellipses, word lengths, letters."""
    n, lines = F.col("n_words"), F.col("_lines")
    share = lambda pattern: F.size(F.filter(lines, lambda x: x.rlike(pattern))) / F.greatest(F.col("n_lines"), F.lit(1))
    return [
        Rule("symbols", F.col("n_symbols") > max_symbols * n),
        Rule("duplicate_lines", F.col("n_dup_lines") > max_dup_lines * F.col("n_lines")),
        Rule("word_length", (F.col("word_chars") < word_len[0] * n) | (F.col("word_chars") > word_len[1] * n)),
        Rule("too_long", n > max_words),
        Rule("ellipsis_lines", share(r"(\.\.\.|…)\s*$") > max_ellipsis),
        Rule("bullet_lines", share(r"^\s*[•‣▪*\-–]\s") > max_bullets),
        Rule("few_letters", F.length(F.regexp_replace(F.array_join("_words", ""), r"\P{L}+", "")) < min_letters * F.col("word_chars")),
    ]


def order_rules(docs: DataFrame, rules: list[Rule], sample_rows: int = 2000, seed: int = 5, text_col: str = "text") -> list[Rule]:
    """The rules by rejection per cost, both estimated on a sample of about ``sample_rows`` rows of ``docs``.

    The cost is the time one evaluation of the rule over the written sample takes, beyond reading it. The order
    changes how much work the cascade does, never its verdict."""
    n = docs.count()
    if n == 0:
        return rules
    part = materialize(text_stats(docs.select(text_col).sample(fraction=min(1.0, sample_rows / n), seed=seed), text_col), "rule_sample")

    def timed(c: Column) -> tuple[float, int]:
        began = time.perf_counter()
        hits = part.agg(F.sum(c.cast("int"))).first()[0] or 0
        return time.perf_counter() - began, hits

    timed(F.lit(True))
    idle = min(timed(F.size("_words") + F.size("_lines") < 0)[0] for _ in range(2))
    found = {}
    for r in rules:
        took, hits = min(timed(r.rejects) for _ in range(2))
        found[r.name] = (hits / max(took - idle, 1e-3), -took)
    return sorted(rules, key=lambda r: found[r.name], reverse=True)


def cascade(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """``stats`` plus rejected_by: the first rule that rejects the row, or null. Later rules aren't evaluated."""
    verdict = F.lit(None).cast("string")
    for r in reversed(rules):
        verdict = F.when(r.rejects, F.lit(r.name)).otherwise(verdict)
    return stats.withColumn("rejected_by", verdict)


def quality(docs: DataFrame, rules: list[Rule] | None = None, min_words: int = 50, max_repeat: int = 50,
            sample_rows: int = 2000, text_col: str = "text") -> DataFrame:
    """``docs`` plus the statistics, base_failed, kept and rejected_by ("base" for the base rules).

    base_failed: fewer than ``min_words`` words, or over ``max_repeat`` per cent of them in repeated windows.
    kept is never null: empty, null and wordless texts fail the base rules. Repeated rows are judged alike,
    other columns pass through; names beginning with "_" and those of the statistics are this operator's."""
    stats = text_stats(docs, text_col)
    stats = stats.withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words")))
    ordered = order_rules(docs, rules or default_rules(), sample_rows, text_col=text_col)
    out = cascade(stats, [Rule("base", F.col("base_failed")), *ordered])
    return out.withColumn("kept", F.col("rejected_by").isNull()).drop("_words", "_lines")


def quality_digest(docs: DataFrame) -> DataFrame:
    return quality(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL = r"""
with t as (select doc_id, coalesce(text, '') as text from documents),
w as (select doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from t),
n as (select *, len(words) as n_words, len(array_to_string(words, '')) as wc from w),
g as (select doc_id, n_words,
             list_transform(range(1, n_words - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) as grams from n),
e as (select doc_id, unnest(grams) as gram, generate_subscripts(grams, 1) as pos from g where n_words >= 3),
r as (select doc_id, pos from (select doc_id, pos, count(*) over (partition by doc_id, gram) as c from e) x where c > 1),
c as (select doc_id, count(distinct p) as n_repeat_words from (select doc_id, unnest([pos, pos + 1, pos + 2]) as p from r) y group by doc_id),
l as (select doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines, text from t),
s as (select n.doc_id, n.n_words, n.wc as word_chars,
             len(regexp_replace(l.text, '[^#*$%&|<>]+', '', 'g')) as n_symbols,
             len(l.lines) as n_lines, len(l.lines) - len(list_distinct(l.lines)) as n_dup_lines,
             coalesce(c.n_repeat_words, 0) as n_repeat_words,
             len(list_filter(l.lines, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) as n_ellipsis,
             len(list_filter(l.lines, lambda x: regexp_matches(x, '^\s*[•‣▪*\-–]\s'))) as n_bullets,
             len(regexp_replace(array_to_string(n.words, ''), '\P{L}+', '', 'g')) as letters
      from n join l on n.doc_id = l.doc_id left join c on n.doc_id = c.doc_id),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from s)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or n_symbols > 0.1 * n_words or n_dup_lines > 0.5 * n_lines
            or word_chars < 3 * n_words or word_chars > 10 * n_words or n_words > 100000
            or n_ellipsis > 0.3 * n_lines or n_bullets > 0.9 * n_lines or letters < 0.5 * word_chars) as kept
from b
"""

"""Mixing to target weights by soft domain membership, in DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import WHITE, hash128, materialize, packed

SPACE = r"[\x20\x09-\x0D]+"


@dataclass
class DomainModel:
    """Naive Bayes over a bounded vocabulary: ``words`` has rows (word, ll array<double>, one per domain)."""

    domains: list[str]
    prior: list[float]
    unknown: list[float]
    words: DataFrame


def words_of(text):
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPACE, -1))


def letters_of(text):
    """The lower-case runs of letters of a text: what the classifier reads."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), r"\P{L}+", -1)


def fit_domains(docs: DataFrame, labelled: DataFrame, domain_col: str = "lang", max_rows: int = 5000, vocabulary: int = 4000,
                max_domains: int = 64, seed: int = 31) -> DomainModel | None:
    """Learns word likelihoods per domain from the documents that the labelled table names.

    ``labelled`` has the column doc_id; the domain of a labelled document is its ``domain_col``. The domains, and how much
    of the labelled text is theirs, come from all labelled documents; the words from at most ``max_rows`` of them, the same
    number of each domain by hash order, and the ``vocabulary`` most frequent of those: both bounds keep the model small enough
    to broadcast, and no domain can be missing from it. Null domains and ids are ignored. None if nothing is labelled; more
    than ``max_domains`` domains raise."""
    ids = labelled.where("doc_id is not null").select("doc_id").distinct()
    held = docs.select("doc_id", F.col(domain_col).cast("string").alias("domain"), F.length("text").alias("size")).where("domain is not null").join(ids, "doc_id")
    held = materialize(held, "mix_labels")
    share = sorted((r.domain, float(r.n or 0) + 1.0) for r in held.groupBy("domain").agg(F.sum("size").alias("n")).limit(max_domains + 1).collect())
    if not share:
        return None
    if len(share) > max_domains:
        raise ValueError(f"more than {max_domains} domains")
    order = [F.xxhash64(F.lit(seed), "doc_id"), F.col("doc_id")]
    some = [held.where(F.col("domain") == d).select("doc_id").distinct().orderBy(*order).limit(max(1, max_rows // len(share))) for d, _ in share]
    pick = materialize(reduce(DataFrame.unionByName, some).distinct(), "mix_picked")
    rows = docs.select("doc_id", F.col(domain_col).cast("string").alias("domain"), F.col("text")).join(F.broadcast(pick), "doc_id")
    rows = rows.where("domain is not null").select("domain", F.explode(letters_of(F.col("text"))).alias("word")).where("word <> ''")
    counts = materialize(rows.groupBy("domain", "word").agg(F.count("*").alias("n")), "mix_counts")
    found = {r.domain: r.n for r in counts.groupBy("domain").agg(F.sum("n").alias("n")).collect()}
    total = [(d, found.get(d, 0)) for d, _ in share]
    top = counts.groupBy("word").agg(F.sum("n").alias("all")).orderBy(F.col("all").desc(), "word").limit(vocabulary).select("word")
    known = counts.join(F.broadcast(top), "word").groupBy("word").agg(*[
        F.sum(F.when(F.col("domain") == d, F.col("n")).otherwise(0)).alias(f"n{k}") for k, (d, _) in enumerate(total)])
    smooth = [math.log(n + 0.5 * vocabulary) for _, n in total]
    ll = F.array(*[F.log(F.col(f"n{k}") + 0.5) - F.lit(s) for k, s in enumerate(smooth)])
    whole = sum(n for _, n in share)
    return DomainModel([d for d, _ in share], [math.log(n / whole) for _, n in share], [math.log(0.5) - s for s in smooth],
                       materialize(known.select("word", ll.alias("ll")), "mix_model"))


def posteriors(docs: DataFrame, model: DomainModel, evidence: int = 20) -> DataFrame:
    """Rows (k1, k2, n_words, copies, p0 .. pK-1): a row for each distinct text, with its domain posteriors.

    The words meet the broadcast model where the text is read and are averaged map-side to one row per text and task, so
    no word is shuffled and a text with many copies costs one row per task. ``evidence`` bounds how many words
    the average counts for; without it a long text's posterior would be 0 or 1. A text without letters gets
    the prior."""
    k = range(len(model.domains))
    k1, k2 = hash128(F.coalesce("text", F.lit("")))
    d = docs.select(k1.alias("k1"), k2.alias("k2"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"),
                    letters_of(F.col("text")).alias("words"))
    d = d.select("k1", "k2", "n_words", F.posexplode("words").alias("pos", "word"))  # beside the generator only columns: all else would run per word
    d = d.join(F.broadcast(model.words), "word", "left")
    mean = [F.avg(F.when(F.col("word") != "", F.coalesce(F.get("ll", F.lit(i)), F.lit(model.unknown[i])))).alias(f"s{i}") for i in k]
    d = d.groupBy("k1", "k2").agg(F.max("n_words").alias("n_words"), F.sum((F.col("pos") == 0).cast("long")).alias("copies"), *mean)
    counted = F.least(F.col("n_words"), F.lit(evidence))
    d = d.select("k1", "k2", "n_words", "copies", *[(F.lit(model.prior[i]) + counted * F.coalesce(F.col(f"s{i}"), F.lit(0.0))).alias(f"s{i}") for i in k])
    d = d.withColumn("top", F.greatest(*[F.col(f"s{i}") for i in k], F.lit(float("-inf"))))
    d = d.select("k1", "k2", "n_words", "copies", *[F.exp(F.col(f"s{i}") - F.col("top")).alias(f"e{i}") for i in k])
    whole = sum((F.col(f"e{i}") for i in k), F.lit(0.0))
    return d.select("k1", "k2", "n_words", "copies", *[(F.col(f"e{i}") / whole).alias(f"p{i}") for i in k])


def fit_rates(post: DataFrame, targets: list[float], total_tokens: float | None = None, min_rate: float = 0.0,
              max_steps: int = 400, tolerance: float = 1e-4, cut_every: int = 10) -> DataFrame:
    """``post`` plus rate: nonnegative rates whose expected domain token totals come nearest the targets.

    Projected gradient on the least squares of the domains' relative errors: the sum over domains of
    (expected total - wanted total)^2 / present total, over rates of at least ``min_rate``, starting from 1. Each step is
    one aggregate to as many sums as there are domains; the rates themselves never leave Spark. The step length is 1 over
    the largest eigenvalue of the domains' Gram matrix, taken from one more aggregate. Every ``cut_every`` steps the
    rates are written. Stops when no domain's total moves by more than ``tolerance`` of the whole; raises if that takes
    more than ``max_steps`` steps. By default the totals add up to the tokens present."""
    k = range(len(targets))
    weight = F.col("n_words") * F.col("copies")
    sums = post.agg(F.sum(weight), *[F.sum(weight * F.col(f"p{i}")) for i in k],
                    *[F.sum(weight * F.col(f"p{i}") * F.col(f"p{j}")) for i in k for j in k]).first()
    whole, have = float(sums[0] or 0), [float(x or 0) for x in sums[1:1 + len(targets)]]
    state = post.withColumn("rate", F.lit(max(1.0, min_rate)))
    if whole == 0:
        return state
    wanted = [t / sum(targets) * (total_tokens or whole) for t in targets]
    safe = [max(h, 1e-9 * whole) for h in have]
    gram = [[float(sums[1 + len(targets) + i * len(targets) + j]) / math.sqrt(safe[i] * safe[j]) for j in k] for i in k]
    v = [1.0] * len(targets)
    top = 1.0
    for _ in range(100):  # power iteration on the small matrix
        v = [sum(gram[i][j] * v[j] for j in k) for i in k]
        top = math.sqrt(sum(x * x for x in v)) or 1.0
        v = [x / top for x in v]
    before = None
    for step in range(1, max_steps + 1):
        got = [float(x or 0) for x in state.agg(*[F.sum(weight * F.col("rate") * F.col(f"p{i}")) for i in k]).first()]
        if before and max(abs(a - b) for a, b in zip(got, before, strict=True)) <= tolerance * whole:
            return materialize(state, "mix_rates")
        before = got
        pull = [(got[i] - wanted[i]) / safe[i] / top for i in k]
        move = sum((F.col(f"p{i}") * F.lit(pull[i]) for i in k), F.lit(0.0))
        state = state.withColumn("rate", F.greatest(F.lit(float(min_rate)), F.col("rate") - move))
        if step % cut_every == 0:
            state = materialize(state, "mix_rates")
    raise RuntimeError(f"rates still move by more than {tolerance} of all tokens after {max_steps} steps")


def mix_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], domain_col: str = "lang", min_rate: float = 0.0,
              keep_all: bool = False, **kw) -> tuple[DataFrame, list[str]]:
    """Rows (k1, k2, n_words, copies, p0.., rate) for each distinct text, and the domains' names.

    Targets of domains that not one labelled document has are left out and the others scaled up; domains without a target
    get 0. ``keep_all`` asks for rates of 1 at least: the token total is raised until the domain that is most over its
    target is left as it is. Without any labelled document all rates are 1."""
    model = fit_domains(docs, labelled, domain_col, **kw)
    if model is None or not sum(targets.get(d, 0.0) for d in model.domains):
        k1, k2 = hash128(F.coalesce("text", F.lit("")))
        one = docs.select(k1.alias("k1"), k2.alias("k2"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
        one = one.groupBy("k1", "k2").agg(F.max("n_words").alias("n_words"), F.count("*").alias("copies"))
        return one.withColumn("p0", F.lit(1.0)).withColumn("rate", F.lit(1.0)), ["all"]
    post = materialize(posteriors(docs, model), "mix_posteriors")
    goal = [targets.get(d, 0.0) for d in model.domains]
    total = None
    if keep_all:
        k = range(len(goal))
        have = post.agg(*[F.sum(F.col("n_words") * F.col("copies") * F.col(f"p{i}")) for i in k]).first()
        total = max(((float(have[i] or 0)) / (goal[i] / sum(goal)) for i in k if goal[i]), default=None)
    return fit_rates(post, goal, total, max(min_rate, 1.0) if keep_all else min_rate), model.domains


def _with_rates(docs: DataFrame, rates: DataFrame, seed: int) -> DataFrame:
    """Rows (row, times, mix): the packed document, how often it comes out, and its text's rate and posteriors."""
    k1, k2 = hash128(F.coalesce("text", F.lit("")))
    r = rates.select("k1", "k2", F.struct([c for c in rates.columns if c not in ("k1", "k2")]).alias("mix"))
    d = packed(docs, k1.alias("k1"), k2.alias("k2"), F.col("doc_id").alias("id")).join(r, ["k1", "k2"], "left")
    u = F.pmod(F.xxhash64(F.lit(seed), "id", "k1"), F.lit(1 << 30)) / float(1 << 30)
    rate = F.col("mix.rate")
    return d.select("row", (F.floor(rate) + (u < rate - F.floor(rate)).cast("int")).cast("int").alias("times"), "mix")


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], seed: int = 41, **kw) -> DataFrame:
    """``docs`` with every row repeated floor(rate) times, and once more with the rate's fraction as its chance.

    The chance is a hash of id and text: the same rows come out in every run. Rows that repeat an id and text share their
    fate. Null text counts as empty (no tokens, prior posteriors). Columns are those of ``docs``."""
    rates, _ = mix_rates(docs, labelled, targets, **kw)
    d = _with_rates(docs, rates, seed).where("times > 0")
    return d.select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("i")).select("row.*")


TARGETS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


def mixing_digest(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, seed: int = 41) -> DataFrame:
    """doc_id, n_words, domain (the likeliest), posterior (its probability), rate, n_copies."""
    docs = docs.select("doc_id", "text", "lang")
    rates, names = mix_rates(docs, labelled, targets or TARGETS)
    k = range(len(names))
    best = F.greatest(*[F.col(f"p{i}") for i in k], F.lit(0.0))
    name = F.coalesce(*[F.when(F.col(f"p{i}") == best, F.lit(names[i])) for i in k])
    rates = rates.select("k1", "k2", "n_words", name.alias("domain"), best.alias("posterior"), "rate")
    return _with_rates(docs.select("doc_id", "text"), rates, seed).select(
        "row.doc_id", "mix.n_words", "mix.domain", "mix.posterior", "mix.rate", F.col("times").alias("n_copies"))

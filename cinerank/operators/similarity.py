"""Pair similarity over long-format (entity, context, value) tables.

Item-item similarity uses entity=item, context=user; user-user swaps them.
Everything is computed only for the pairs a caller asks for (the candidate
pairs of a prediction job), never for all pairs inside a user or an item:

* ``pair_stats`` splits contexts by degree: light contexts (bounded size)
  emit their co-rated pairs; heavy contexts are never paired up, instead
  each requested pair ``(a, b)`` is routed to the member with **fewer** rows
  and probes the other member's value by the unique key ``(other, context)``.
  No unbounded group is ever collected into one task or row.
* per-entity norms and counts are a plain map-side-combined aggregate.

All functions carry optional partition keys ``part`` (e.g. ``["fold"]``) so
several folds run in one job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.functions.scalar import dec

# Sentinel similarity when either vector has zero norm (fixed value).
ZERO_NORM_SIM = -1.0


def entity_stats(values: DataFrame, entity: str, value: str = "v",
                 part: Sequence[str] = ()) -> DataFrame:
    """AGG-13/AGG-14 parts: per entity row count ``n`` and squared norm ``sq``."""
    return (values.groupBy(*part, entity)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(value) * F.col(value)).alias("sq")))


# Contexts (e.g. users for item-item) with at most this many rows are "light":
# their co-rated pairs are emitted directly (at most D^2/2 per context, so at
# most D * rows overall). Heavier contexts never pair up their rows; their
# share of each requested pair's dot product comes from probing.
DEFAULT_HEAVY_DEGREE = 500


def co_dots(values: DataFrame, entity: str, context: str, value: str = "v",
            part: Sequence[str] = (), heavy_degree: int = DEFAULT_HEAVY_DEGREE,
            requests=None, adaptive: bool = False) -> DataFrame:
    """(part, a, b, dot, co) over common contexts, a < b.

    * every pair sharing a light context gets that context's contribution
      from a self join of the light contexts (bounded per context);
    * heavy contexts are never paired up: if any exist (checked with one
      tiny ``limit(1)`` probe of the degree table), ``requests()`` must give
      the distinct (part, a, b) pairs that need them; each is routed to its
      member with fewer rows and probes the other by (part, other, context).
    Pairs with no common context are absent (dot 0, co 0).

    ``adaptive`` (for an explicit, typically small, set of requested pairs):
    compare the light self-join size sum(deg * (deg - 1) / 2) with the probe
    cost sum(min(n_a, n_b)) over the requested pairs (two small aggregates)
    and probe every context when that is cheaper."""
    part = list(part)
    v = values.select(*part, F.col(entity).alias("_e"), F.col(context).alias("_c"),
                      F.col(value).alias("_v"))
    deg = v.groupBy(*part, "_c").agg(F.count(F.lit(1)).alias("_deg"))
    if adaptive and requests is not None:
        light_rows = deg.where(F.col("_deg") <= heavy_degree).agg(
            F.sum(F.col("_deg") * (F.col("_deg") - 1) / 2)).first()[0] or 0
        n = v.groupBy(*part, "_e").agg(F.count(F.lit(1)).alias("_n"))
        probe_rows = (requests().select(*part, "a", "b")
                      .join(n.select(*part, F.col("_e").alias("a"), F.col("_n").alias("_na")), part + ["a"])
                      .join(n.select(*part, F.col("_e").alias("b"), F.col("_n").alias("_nb")), part + ["b"])
                      .agg(F.sum(F.least("_na", "_nb"))).first()[0] or 0)
        if probe_rows < light_rows:
            heavy_degree = 0
    has_heavy = len(deg.where(F.col("_deg") > heavy_degree).limit(1).take(1)) > 0
    if has_heavy:
        vd = v.join(deg, part + ["_c"])
        light = vd.where(F.col("_deg") <= heavy_degree).drop("_deg")
        heavy = vd.where(F.col("_deg") > heavy_degree).drop("_deg")
    else:
        light, heavy = v, None

    lx = light.select(*part, "_c", F.col("_e").alias("a"), F.col("_v").alias("_va"))
    ly = light.select(*part, "_c", F.col("_e").alias("b"), F.col("_v").alias("_vb"))
    dots = (lx.join(ly, part + ["_c"]).where(F.col("a") < F.col("b"))
            .groupBy(*part, "a", "b")
            .agg(F.sum(F.col("_va") * F.col("_vb")).alias("dot"), F.count(F.lit(1)).alias("co"),
                 F.sum("_va").alias("sum_a"), F.sum("_vb").alias("sum_b")))
    if heavy is None:
        return dots
    if requests is None:
        raise ValueError("heavy contexts present: requested pairs are needed")
    st = v.groupBy(*part, "_e").agg(F.count(F.lit(1)).alias("_n"))
    pr = (requests().select(*part, "a", "b")
          .join(st.select(*part, F.col("_e").alias("a"), F.col("_n").alias("_na")), part + ["a"], "left")
          .join(st.select(*part, F.col("_e").alias("b"), F.col("_n").alias("_nb")), part + ["b"], "left"))
    a_small = F.coalesce("_na", F.lit(0)) <= F.coalesce("_nb", F.lit(0))
    route = pr.select(*part, "a", "b",
                      F.when(a_small, F.col("a")).otherwise(F.col("b")).alias("_x"),
                      F.when(a_small, F.col("b")).otherwise(F.col("a")).alias("_y"))
    hx = heavy.select(*part, F.col("_e").alias("_x"), "_c", F.col("_v").alias("_vx"))
    hy = heavy.select(*part, F.col("_e").alias("_y"), "_c", F.col("_v").alias("_vy"))
    a_is_x = F.col("_x") == F.col("a")
    heavy_dots = (route.join(hx, part + ["_x"]).join(hy, part + ["_y", "_c"])
                  .groupBy(*part, "a", "b")
                  .agg(F.sum(F.col("_vx") * F.col("_vy")).alias("dot"), F.count(F.lit(1)).alias("co"),
                       F.sum(F.when(a_is_x, F.col("_vx")).otherwise(F.col("_vy"))).alias("sum_a"),
                       F.sum(F.when(a_is_x, F.col("_vy")).otherwise(F.col("_vx"))).alias("sum_b")))
    return (dots.unionByName(heavy_dots).groupBy(*part, "a", "b")
            .agg(F.sum("dot").alias("dot"), F.sum("co").alias("co"),
                 F.sum("sum_a").alias("sum_a"), F.sum("sum_b").alias("sum_b")))


def pair_stats(values: DataFrame, pairs: DataFrame, entity: str, context: str,
               value: str = "v", part: Sequence[str] = (),
               heavy_degree: int = DEFAULT_HEAVY_DEGREE) -> DataFrame:
    """For each requested pair (part, a, b), a < b: dot, co (common contexts),
    n_a, n_b, sq_a, sq_b. ``values`` is unique per (part, entity, context)."""
    part = list(part)
    st = entity_stats(values, entity, value, part)
    sa = st.select(*part, F.col(entity).alias("a"), F.col("n").alias("n_a"), F.col("sq").alias("sq_a"))
    sb = st.select(*part, F.col(entity).alias("b"), F.col("n").alias("n_b"), F.col("sq").alias("sq_b"))
    dots = co_dots(values, entity, context, value, part, heavy_degree, requests=lambda: pairs, adaptive=True)
    p = (pairs.join(dots, part + ["a", "b"], "left")
         .join(sa, part + ["a"], "left").join(sb, part + ["b"], "left"))
    return p.select(*part, "a", "b", F.coalesce("dot", F.lit(0.0)).alias("dot"),
                    F.coalesce("co", F.lit(0)).alias("co"),
                    F.coalesce("n_a", F.lit(0)).alias("n_a"), F.coalesce("n_b", F.lit(0)).alias("n_b"),
                    F.coalesce("sq_a", F.lit(0.0)).alias("sq_a"), F.coalesce("sq_b", F.lit(0.0)).alias("sq_b"))


def candidate_stats(test: DataFrame, train: DataFrame, target: str, ctx: str, value: str = "v",
                    part: Sequence[str] = (), keep=(), heavy_degree: int = DEFAULT_HEAVY_DEGREE) -> DataFrame:
    """Candidate rows of a neighbourhood job with the pair statistics attached.

    For each test row (part, ctx, target) and each train row of the same
    (part, ctx) with another ``target`` value ``nbr``: the co-rating dot and
    count of (target, nbr) and both members' counts and squared norms
    (n_t, sq_t, n_n, sq_n), and the value sums over the common contexts of the
    target (s_t) and of the neighbour (s_n). ``train`` is (part, user_id, item_id, value, keep...)
    and should be materialised by the caller (several branches read it).

    Norms/counts are attached to the train and test rows before the
    candidate join; dots come from ``co_dots`` left-joined on (part, a, b), so
    the candidate rows are built once (distinct pairs only if heavy contexts
    exist)."""
    part = list(part)
    st = entity_stats(train, target, value, part).select(*part, F.col(target).alias("_k"), "n", "sq")
    tr = (train.join(st.withColumnRenamed("_k", target), part + [target])
          .select(*part, ctx, F.col(target).alias("nbr"), *keep, F.col("n").alias("n_n"),
                  F.col("sq").alias("sq_n")))
    te = (test.join(st.withColumnRenamed("_k", target), part + [target], "left")
          .select(*[c for c in test.columns], F.coalesce("n", F.lit(0)).alias("n_t"),
                  F.coalesce("sq", F.lit(0.0)).alias("sq_t")))
    cand = (te.join(tr, part + [ctx]).where(F.col("nbr") != F.col(target))
            .withColumn("a", F.least(target, "nbr")).withColumn("b", F.greatest(target, "nbr")))
    dots = co_dots(train, target, ctx, value, part, heavy_degree,
                   requests=lambda: cand.select(*part, "a", "b").distinct())
    t_is_a = F.col(target) == F.col("a")
    return (cand.join(dots, part + ["a", "b"], "left")
            .withColumn("dot", F.coalesce("dot", F.lit(0.0))).withColumn("co", F.coalesce("co", F.lit(0)))
            .withColumn("s_t", F.coalesce(F.when(t_is_a, F.col("sum_a")).otherwise(F.col("sum_b")), F.lit(0.0)))
            .withColumn("s_n", F.coalesce(F.when(t_is_a, F.col("sum_b")).otherwise(F.col("sum_a")), F.lit(0.0)))
            .drop("sum_a", "sum_b"))


def fold_stats(rows: DataFrame, key: str, folds: Sequence[int], value: str, prefix: str) -> DataFrame:
    """Per ``key`` the count, sum and squared sum of the train side of every fold, as arrays in the order of ``folds``.

    One aggregate over the rows: the train side of fold f is every row outside f, so no row is repeated per fold."""
    v = F.col(value).cast("double")

    def sums(x, zero):
        return F.array(*[F.sum(F.when(F.col("fold") != f, x).otherwise(zero)) for f in folds])
    return rows.groupBy(key).agg(sums(F.lit(1), F.lit(0)).alias(f"{prefix}n"), sums(v, F.lit(0.0)).alias(f"{prefix}s"),
                                 sums(v * v, F.lit(0.0)).alias(f"{prefix}q"))


def fold_dots(rows: DataFrame, target: str, ctx: str, folds: Sequence[int], measures: Sequence[str]) -> DataFrame:
    """(a, b, one array per measure): co-rating sums of every pair of ``target`` values, for the train side of every fold.

    One self join of the rows on the context, whatever the number of folds: a co-rated pair counts for fold f if neither
    of its rows is in f. Measures: dot, co (count), s_a and s_b (value sums of either side)."""
    if len(folds) == 1:
        rows = rows.where(F.col("fold") != folds[0])
    x = rows.select(ctx, F.col(target).alias("a"), F.col("v").alias("va"), F.col("fold").alias("fa"))
    y = rows.select(ctx, F.col(target).alias("b"), F.col("v").alias("vb"), F.col("fold").alias("fb"))
    term = {"dot": F.col("va") * F.col("vb"), "co": F.lit(1.0), "s_a": F.col("va"), "s_b": F.col("vb")}

    def per_fold(m):
        return F.array(*[F.sum(F.when((F.col("fa") != f) & (F.col("fb") != f), term[m]).otherwise(F.lit(0.0))) for f in folds])
    pairs = x.join(y, ctx).where(F.col("a") < F.col("b"))
    return pairs.groupBy("a", "b").agg(*[per_fold(m).alias(m) for m in measures])


def fold_candidates(base: DataFrame, target: str, ctx: str, folds: Sequence[int], measures: Sequence[str] = ("dot",),
                    by_fold: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Candidate rows of a neighbourhood job over several folds, with the pair statistics attached.

    ``base``: every row once, with fold, user_id, item_id, v, the arrays n, q and m of its ``target`` (train count,
    squared norm and mean per fold) and the columns named in ``by_fold`` (arrays per fold) and ``keep``. A row of
    fold f in ``folds`` meets the rows of its context that are not in f; each candidate picks fold f's entries.
    The co-rating rows of a context (at most half the square of its size) are no more than the order of its candidate
    rows, which an exact top-k needs anyway, so there is one plan for contexts of every size; AQE splits a hot one.
    Returns fold, user_id, item_id, nbr, a, b, n_t, q_t, m_t, n_n, q_n, m_n, measures (s_t and s_n for s_a, s_b), by_fold, keep."""
    at = F.array_position(F.array(*[F.lit(int(f)) for f in folds]), F.col("fold").cast("int")).cast("int")
    te = base.where(F.col("fold").isin(*folds)).withColumn("_at", at)
    te = te.select("fold", "user_id", "item_id", "_at", *[F.element_at(c, F.col("_at")).alias(f"{c}_t") for c in ("n", "q", "m")])
    tr = base.select(ctx, F.col(target).alias("nbr"), F.col("fold").alias("_nf"), "n", "q", "m", *by_fold, *keep)
    cand = te.join(tr, ctx).where((F.col("_nf") != F.col("fold")) & (F.col("nbr") != F.col(target)))
    cand = cand.select("fold", "user_id", "item_id", "nbr", "_at", F.least(target, "nbr").alias("a"), F.greatest(target, "nbr").alias("b"),
                       "n_t", "q_t", "m_t", *[F.element_at(c, F.col("_at")).alias(f"{c}_n") for c in ("n", "q", "m")],
                       *[F.element_at(c, F.col("_at")).alias(c) for c in by_fold], *keep)
    out = cand.join(fold_dots(base, target, ctx, folds, measures), ["a", "b"], "left")
    for m in measures:
        out = out.withColumn(m, F.coalesce(F.element_at(m, F.col("_at")), F.lit(0.0)))
    if "s_a" in measures:
        t_is_a = F.col(target) == F.col("a")
        out = out.withColumn("s_t", F.when(t_is_a, F.col("s_a")).otherwise(F.col("s_b")))
        out = out.withColumn("s_n", F.when(t_is_a, F.col("s_b")).otherwise(F.col("s_a"))).drop("s_a", "s_b")
    return out.drop("_at")


def cosine_from_stats(stats: DataFrame, part: Sequence[str] = ()) -> DataFrame:
    """Cosine with the zero-norm sentinel; rounded to DECIMAL(18,9)."""
    zero = (F.col("sq_a") == 0) | (F.col("sq_b") == 0)
    sim = F.when(zero, F.lit(ZERO_NORM_SIM)).otherwise(
        F.col("dot") / F.sqrt(F.col("sq_a") * F.col("sq_b")))
    return stats.select(*part, "a", "b", dec(sim).alias("sim"), zero.alias("zero_norm"))


def jaccard_from_stats(stats: DataFrame, part: Sequence[str] = ()) -> DataFrame:
    union = F.col("n_a") + F.col("n_b") - F.col("co")
    sim = F.when(union == 0, F.lit(0.0)).otherwise(F.col("co") / union)
    return stats.select(*part, "a", "b", dec(sim).alias("sim"), F.lit(False).alias("zero_norm"))


def centre_by_join(values: DataFrame, by: str, value: str = "v",
                   part: Sequence[str] = ()) -> DataFrame:
    """WIN-8: subtract the mean of ``value`` over ``by`` (per part). Aggregate +
    join rather than a window: the mean is combined map-side, so a hot group
    never sorts in one task."""
    m = values.groupBy(*part, by).agg(F.avg(value).alias("_m"))
    return values.join(m, list(part) + [by]).withColumn(value, F.col(value) - F.col("_m")).drop("_m")


# UDF-2: similarity by name -> function(values, pairs, entity, context, part) -> (part, a, b, sim, zero_norm)
def _cos(values, pairs, entity, context, part=()):
    return cosine_from_stats(pair_stats(values, pairs, entity, context, "v", part), part)


def _pears(values, pairs, entity, context, part=()):
    return _cos(centre_by_join(values, entity, "v", part), pairs, entity, context, part)


def _jac(values, pairs, entity, context, part=()):
    return jaccard_from_stats(pair_stats(values, pairs, entity, context, "v", part), part)


SIMILARITIES: dict[str, Callable] = {"cos": _cos, "pears": _pears, "jac": _jac}


BUILTINS = dict(SIMILARITIES)


def is_builtin(kind: str) -> bool:
    """Whether ``kind`` is a built-in similarity that nobody replaced; an unknown name raises."""
    if kind not in SIMILARITIES:
        raise ValueError(f"unknown similarity {kind!r}; known: {', '.join(sorted(SIMILARITIES))}")
    return SIMILARITIES[kind] is BUILTINS.get(kind)


#: the block product's form of a similarity that its caller registered (``block_product.Measure``)
BLOCK_FORMS: dict[str, tuple] = {}


def register_similarity(name: str, fn: Callable, measure: tuple | None = None) -> None:
    """Add a user similarity: fn(values, pairs, entity, context, part) -> (part, a, b, sim, zero_norm). ``measure`` is the same
    as a function of the sums of a pair (``block_product.Measure``); with it predictions need no rows of pairs."""
    SIMILARITIES[name] = fn
    BLOCK_FORMS.pop(name, None)
    if measure is not None:
        BLOCK_FORMS[name] = measure


def similarity(values: DataFrame, pairs: DataFrame, kind: str, entity: str, context: str,
               part: Sequence[str] = ()) -> DataFrame:
    """Dispatch by name. ``values`` must have columns (part, entity, context, v)."""
    return SIMILARITIES[kind](values, pairs, entity, context, part)

"""Matrix factorisation (JOB-14..JOB-20).

* ALS (Spark ML) is the default factoriser: its ``regParam`` is scaled by the
  number of ratings of each user/item (ALS-WR), the same per-rating weight
  decay the SGD update applies once per observed rating.
* Truncated SVD is a subspace iteration, repeated until it has converged, over
  tables of one row per item that hold a vector for every fold. A step sends an
  item's vectors once to each block of users, where a task multiplies by the
  block and by its transpose. Only 3k x 3k matrices reach the driver.
* Stratified block SGD runs the sequential update in parallel blocks.
* Scoring joins factor rows to the test cells and sums products (SCL-10).
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.functions.scalar import clamp, dot
from cinerank.operators.ranking import global_rank
from cinerank.session import discard, materialize, scratch_path

U, I = "user_id", "item_id"

# Fixed defaults of the reference factorisation.
SGD_RANK, SGD_LAMBDA, SGD_GAMMA, SGD_EPOCHS = 20, 0.1, 0.01, 100


def _dense_ids(train: DataFrame, col: str) -> DataFrame:
    """(col, dense int id) from the distributed global rank of the distinct ids."""
    return global_rank(train.select(col).distinct(), [col], "_id", start=0).select(col, F.col("_id").cast("int").alias("_id"))


def als_blocks(ratings: int, most: int = 50_000_000) -> int:
    """Blocks of users, and of items, in ALS. A sweep sends each factor once to every block that needs it, so their number
    follows the ratings, at most ``most`` in a block, and not the cores: the bytes sent grow with it, and the start vectors too depend on it."""
    return max(4, math.ceil(ratings / most))


def als_model(train: DataFrame, rank: int = SGD_RANK, reg: float = SGD_LAMBDA, max_iter: int = 10, seed: int = 42,
              blocks: int | None = None):
    """JOB-14 default: fit ALS on (user_id, item_id, score).

    ALS needs int ids, so users and items are always renumbered densely (global rank) and ``als_factors`` maps them
    back. ``blocks`` is the number of user and of item blocks, hence of tasks; by default it follows the ratings (``als_blocks``)."""
    from pyspark.ml.recommendation import ALS
    blocks = blocks or als_blocks(train.count())
    als = ALS(rank=rank, regParam=reg, maxIter=max_iter, seed=seed, userCol="u", itemCol="i", ratingCol="score",
              coldStartStrategy="nan", nonnegative=False, checkpointInterval=5, numUserBlocks=blocks, numItemBlocks=blocks)
    um, im = _dense_ids(train, U), _dense_ids(train, I)
    model = als.fit(train.join(um, U).join(im.withColumnRenamed("_id", "i"), I).select(F.col("_id").alias("u"), "i", "score"))
    model._id_maps = (um, im)
    return model


def als_factors(model):
    """SNK-12 content: factor tables (id, features array<double>) under the ids of the training rows."""
    um, im = model._id_maps
    uf = model.userFactors.select(F.col("id").alias("_id"), F.col("features").cast("array<double>").alias("p"))
    itf = model.itemFactors.select(F.col("id").alias("_id"), F.col("features").cast("array<double>").alias("q"))
    return uf.join(um, "_id").select(U, "p"), itf.join(im, "_id").select(I, "q")


def save_factors(user_factors: DataFrame, item_factors: DataFrame, path: str) -> None:
    """SNK-12: the two factor tables as Parquet below ``path``."""
    user_factors.select(U, "p").write.mode("overwrite").parquet(f"{path}/users")
    item_factors.select(I, "q").write.mode("overwrite").parquet(f"{path}/items")


def load_factors(spark: SparkSession, path: str):
    """The tables that ``save_factors`` wrote: (user_id, p) and (item_id, q)."""
    return spark.read.parquet(f"{path}/users"), spark.read.parquet(f"{path}/items")


def score_cells(cells: DataFrame, user_factors: DataFrame, item_factors: DataFrame,
                fallback: DataFrame | float | None = None, bound: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    """JOB-16 / JOB-17 / JOB-20: predicted value of each cell = p_u . q_i.

    Cells whose user or item has no factors get ``fallback`` (e.g. the train
    mean); ``bound`` clamps to [1, 5] (compute_errors) or not (the light form).
    ``by`` names further key columns of cells and factors, such as an epoch."""
    j = cells.join(user_factors, [*by, U], "left").join(item_factors, [*by, I], "left")
    raw = F.when(F.col("p").isNotNull() & F.col("q").isNotNull(), dot("p", "q"))
    if isinstance(fallback, DataFrame):
        fallback = fallback.first()["mu"]  # one number to the driver
    if fallback is not None:
        raw = F.coalesce(raw, F.lit(float(fallback)))
    pred = clamp(raw) if bound else raw
    return j.withColumn("pred", pred).drop("p", "q")


# --- truncated SVD by subspace iteration --------------------------------------
# A matrix table has a row for each entity: (entity, m), m = an array with a vector of k numbers for every group.


def centred_by_fold(folds: DataFrame, n_folds: int = 5) -> tuple[DataFrame, DataFrame]:
    """JOB-19: item-mean-centred training values for every fold at once.

    Returns rows (user_id, item_id, x), x[f - 1] = score less the item's mean over the other folds, null in the rating's
    own fold f (where it is a test cell), and the offsets (item_id, off array<double>). Means come from one aggregate
    by subtraction: whole sum less the fold's own."""
    ids = range(1, n_folds + 1)
    part = folds.groupBy(I).agg(F.sum("score").alias("s"), F.count("score").alias("c"),
                                *[F.sum(F.when(F.col("fold") == f, F.col("score"))).alias(f"s{f}") for f in ids],
                                *[F.count(F.when(F.col("fold") == f, F.col("score"))).alias(f"c{f}") for f in ids])
    off = part.select(I, F.array(*[F.when(F.col("c") > F.col(f"c{f}"), (F.col("s") - F.coalesce(f"s{f}", F.lit(0.0)))
                                          / (F.col("c") - F.col(f"c{f}"))) for f in ids]).alias("off"))
    off = materialize(off, "svd_offsets")
    x = F.transform("off", lambda o, k: F.when(F.col("fold") != k + 1, F.col("score") - o))
    return folds.join(off, I).select(U, I, x.alias("x")), off


def _random_start(items: DataFrame, groups: int, k: int, seed: int) -> DataFrame:
    """A reproducible test matrix with entries in [-1, 1): a hash of the item, the same for every group."""
    u = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: F.pmod(
        F.xxhash64(F.lit(seed), F.col(I), j), F.lit(2_000_001)) / F.lit(1_000_000.0) - F.lit(1.0))
    return items.select(I, F.array_repeat(u, groups).alias("m"))


def _times(values: DataFrame, mat: DataFrame, by: str, out: str, groups: int, k: int, width: int = 20) -> DataFrame:
    """For every group g: the sum over ``by`` of x[g] * m[g], as a matrix table of ``out``. One join of as many rows as
    there are ratings; the groups part only behind it, and their sums are combined before the shuffle. A value that is
    null in a group takes no part in it. (``width`` sums an aggregate: many more make code too long to compile, so
    longer vectors are summed in pieces.)"""
    pieces = -(-k // width)
    rows = values.join(mat, by).select(out, F.posexplode(F.arrays_zip("x", "m")).alias("g", "c"))
    rows = rows.select(out, "g", F.col("c.x").alias("x"),
                       F.posexplode(F.array(*[F.slice("c.m", p * width + 1, width) for p in range(pieces)])).alias("p", "v"))
    s = rows.groupBy(out, "g", "p").agg(*[F.sum(F.col("x") * F.get("v", F.lit(j))).alias(f"s{j}") for j in range(min(k, width))])
    v = F.array(*[F.coalesce(f"s{j}", F.lit(0.0)) for j in range(min(k, width))])
    # one row for each group and piece, so the list is as short as the number of these
    lists = s.select(out, F.struct("g", "p", v.alias("v")).alias("c")).groupBy(out).agg(F.sort_array(F.collect_list("c")).alias("l"))
    of_group = F.transform(F.sequence(F.lit(0), F.lit(groups - 1)),
                           lambda g: F.slice(F.flatten(F.slice(F.col("l.v"), g * pieces + 1, F.lit(pieces))), 1, k))
    return lists.select(out, of_group.alias("m"))


def _columns(values: DataFrame, groups: int, ratings: int, most_rows: int = 250_000, most: int = 20_000_000) -> tuple[DataFrame, int]:
    """The columns of each block of users, written once: rows (block, g, item_id, pos array<int>, x array<double>), the ratings
    that a block's users gave an item; ``pos`` is a user's place in its block. Returns them and the places of a block. A block
    has at most ``most_rows`` users and about ``most`` ratings, so the products of a task are bounded."""
    ids = materialize(global_rank(values.select(U).distinct().where(F.col(U).isNotNull()), [U], "_n", start=0), "svd_ids")
    n = ids.count()
    blocks = max(4, math.ceil(n / most_rows), math.ceil(ratings / most))
    ids = ids.select(U, F.pmod("_n", F.lit(blocks)).cast("int").alias("block"), F.floor(F.col("_n") / blocks).cast("int").alias("pos"))
    rows = values.where(F.col(I).isNotNull()).join(ids, U).select("block", I, "pos", F.posexplode("x").alias("g", "x"))
    cols = rows.groupBy("block", "g", I).agg(F.collect_list(F.struct("pos", F.coalesce("x", F.lit(0.0)).alias("x"))).alias("c"))
    cols = materialize(cols.select("block", "g", I, F.col("c.pos").alias("pos"), F.col("c.x").alias("x")), "svd_columns")
    discard(ids)
    return cols, -(-n // blocks)


def _strips(counts: np.ndarray, most: int = 65_536):
    """(first, end) of runs of rows with about ``most`` entries together, at least a row each."""
    part = (np.cumsum(counts) - counts) // most
    cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(counts)]])
    return zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)


def _runs(*keys: np.ndarray):
    """(first, end) of runs of rows that agree in all keys."""
    differ = np.zeros(len(keys[0]) - 1, bool)
    for k in keys:
        differ |= k[1:] != k[:-1]
    cuts = np.concatenate([[0], np.flatnonzero(differ) + 1, [len(keys[0])]])
    return zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)


def _block_products(batches, places: int, k: int):
    """transpose(A) (A m) for the rows A of each block and group: rows (item_id, g, block, v), from columns sorted by block
    and group that carry their item's vector v. A m has a row for each user of the block; the columns are kept for the way back."""
    import pyarrow as pa

    def finish(key, kept, z):
        for ids, pos, x, counts in kept:
            starts = np.cumsum(counts) - counts
            for lo, hi in _strips(counts):
                a, b = starts[lo], starts[lo] + counts[lo:hi].sum()
                h = np.add.reduceat(z[pos[a:b]] * x[a:b, None], starts[lo:hi] - a)
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(np.full(hi - lo, key[1], np.int32)), pa.array(np.full(hi - lo, key[0], np.int32)),
                                                  pa.ListArray.from_arrays(np.arange(hi - lo + 1, dtype=np.int32) * k, pa.array(h.ravel()))], [I, "g", "block", "v"])
    key, kept, z = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        block, g = (batch.column(c).to_numpy() for c in ("block", "g"))
        for first, end in _runs(block, g):
            if (block[first], g[first]) != key:
                if key is not None:
                    yield from finish(key, kept, z)
                key, kept, z = (block[first], g[first]), [], np.zeros((places, k))
            part = batch.slice(first, end - first)
            pos, x, v = (part.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("pos", "x", "v"))
            counts, v = part.column("pos").value_lengths().to_numpy().astype(np.int64), v.reshape(end - first, k)
            starts = np.cumsum(counts) - counts
            for lo, hi in _strips(counts):
                a, b = starts[lo], starts[lo] + counts[lo:hi].sum()
                order = np.argsort(pos[a:b], kind="stable")
                at = pos[a:b][order]
                heads = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                z[at[heads]] += np.add.reduceat(v[np.repeat(np.arange(lo, hi), counts[lo:hi])[order]] * x[a:b][order][:, None], heads)
            kept.append((part.column(I), pos.copy(), x.copy(), counts))
    if key is not None:
        yield from finish(key, kept, z)


def _step(cols: DataFrame, places: int, table: DataFrame, names: tuple[str, ...], groups: int, k: int, fn, to: tuple[str, ...]) -> DataFrame:
    """The table (item_id, *to) of the matrices ``fn`` makes of those in ``names`` and of h = transpose(A) A times the last.
    An item's vectors go once to each block and group with a rating of it, and come back once from each, to be added up
    beside the item's own row."""
    id_type = table.schema[I].dataType.simpleString()
    sent = cols.join(table.select(I, F.col(names[-1]).alias("m")), I).select("block", "g", I, "pos", "x", F.get("m", F.col("g")).alias("v"))
    sent = sent.repartition("block", "g").sortWithinPartitions("block", "g", I)
    back = sent.mapInArrow(lambda batches: _block_products(batches, places, k), f"{I} {id_type}, g int, block int, v array<double>")
    own = table.select(I, F.lit(0).alias("g"), F.lit(-1).alias("block"), F.flatten(F.concat(*names)).alias("v"))
    both = own.unionByName(back).repartition(I).sortWithinPartitions(I, "block", "g")

    def add(batches):  # an item's own row comes first; items that nothing came back for are left out
        import pyarrow as pa

        def matrices(x):
            n = len(x) // (groups * k)
            inner = pa.ListArray.from_arrays(np.arange(n * groups + 1, dtype=np.int32) * k, pa.array(np.ascontiguousarray(x).ravel()))
            return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * groups, inner)

        def out(ids, mats, h, got):
            mats = mats[got].reshape(-1, len(names), groups, k)
            made = fn(*[mats[:, j] for j in range(len(names))], h[got])
            return pa.RecordBatch.from_arrays([ids.filter(pa.array(got)), *[matrices(m.ravel()) for m in made]], [I, *to])
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            block, g, v = b.column("block").to_numpy(), b.column("g").to_numpy(), b.column("v")
            mine = block < 0
            ids, mats = b.column(I).filter(pa.array(mine)), v.filter(pa.array(mine)).flatten().to_numpy(zero_copy_only=False).reshape(mine.sum(), -1)
            seg = np.cumsum(mine) - 1
            h, got = np.zeros((len(ids), groups, k)), np.zeros(len(ids), bool)
            if held is not None:
                ids, seg = pa.concat_arrays([held[0], ids]), seg + 1
                mats, h, got = (np.concatenate([x, y]) for x, y in zip(held[1:], (mats, h, got), strict=True))
            vec = v.filter(pa.array(~mine)).flatten().to_numpy(zero_copy_only=False).reshape((~mine).sum(), k)
            seg, g, block = seg[~mine], g[~mine], block[~mine]
            for n in np.unique(block):  # an item has one row of a block and group
                w = block == n
                h[seg[w], g[w]] += vec[w]
            got[seg] = True
            if len(ids) > 1:
                yield out(ids.slice(0, len(ids) - 1), mats[:-1], h[:-1], got[:-1])
            held = ids.slice(len(ids) - 1), mats[-1:].copy(), h[-1:].copy(), got[-1:].copy()
        if held is not None:
            yield out(*held)
    return both.mapInArrow(add, ", ".join([f"{I} {id_type}", *[f"{n} array<array<double>>" for n in to]]))


def _arrays(batch, key: str) -> list[np.ndarray]:
    """The matrix columns of an Arrow batch, each rows x groups x k."""
    out = []
    for name in batch.schema.names:
        if name != key:
            rows = batch.column(name).flatten()
            out.append(rows.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(rows) // batch.num_rows, -1))
    return out


def _by_row(table: DataFrame, key: str, fn, names: tuple[str, ...] = ("m",)) -> DataFrame:
    """The key and the matrices that ``fn`` makes of the table's matrices (arrays rows x groups x k), in Arrow batches."""
    def run(batches):
        import pyarrow as pa

        def lists(x):
            n, g, k = x.shape
            inner = pa.ListArray.from_arrays(np.arange(n * g + 1, dtype=np.int32) * k, pa.array(np.ascontiguousarray(x).ravel()))
            return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * g, inner)
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(key), *[lists(x) for x in fn(*_arrays(b, key))]], [key, *names])
    schema = ", ".join([f"{key} {table.schema[key].dataType.simpleString()}", *[f"{n} array<array<double>>" for n in names]])
    return table.mapInArrow(run, schema)


def _sums(table: DataFrame, key: str, fn, shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all rows of ``fn`` of the matrices: summed in each partition, then by entry, whatever the number of rows."""
    def run(batches):
        import pyarrow as pa

        total = np.zeros(shape)
        for b in batches:
            if b.num_rows:
                total += fn(*_arrays(b, key))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["n", "x"])
    out = np.zeros(int(np.prod(shape)))
    for r in table.mapInArrow(run, "n bigint, x double").groupBy("n").agg(F.sum("x").alias("x")).collect():
        out[r["n"]] = r["x"]  # as many rows as ``shape`` has entries
    return out.reshape(shape)


def _inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """groups x k x k inner products of the columns of a and b."""
    return a.transpose(1, 2, 0) @ b.transpose(1, 0, 2)


def _apply(mat: DataFrame, key: str, small: np.ndarray) -> DataFrame:
    """Every vector times its group's small matrix: row by row, no shuffle."""
    return _by_row(mat, key, lambda m: [np.einsum("ngk,gkj->ngj", m, small, optimize=True)])


def _orthonormal(mat: DataFrame, key: str, groups: int, k: int) -> DataFrame:
    """The columns made orthonormal in every group; directions that the matrix lacks become zero. Done twice, since once
    leaves the error of nearly parallel columns."""
    for _ in range(2):
        small = np.zeros((groups, k, k))
        for g, gram in enumerate(_sums(mat, key, lambda m: _inner(m, m), (groups, k, k))):
            size = np.sqrt(np.maximum(np.diag(gram), 0))
            scale = np.where(size > 0, 1 / np.where(size > 0, size, 1), 0)
            lam, w = np.linalg.eigh(scale[:, None] * gram * scale)
            small[g] = scale[:, None] * w * np.where(lam > 1e-13 * k, 1 / np.sqrt(np.maximum(lam, 1e-300)), 0.0)
        mat = _apply(mat, key, small)
    return materialize(mat, "svd_basis")


def _filter(theta: np.ndarray, most: int = 16, ratio: float = 1e7) -> tuple[np.ndarray, int]:
    """Half width of [0, 2e] for each group, and the degree of the Chebyshev polynomial that damps the squared singular
    values in it and lifts those above. 2e is the smallest Ritz value, so only what the extra columns leave out is
    damped; the degree stops before the largest value drowns the others."""
    e = np.maximum(theta[:, -1] / 2, 1e-4 * theta[:, 0])
    e = np.where(e > 0, e, 1.0)
    lift = np.arccosh(np.maximum(theta[:, 0] / e - 1, 1 + 1e-9)).max()
    return e[:, None], int(np.clip(np.arccosh(ratio) / lift, 1, most))


def truncated_svd(values: DataFrame, k: int = 20, iters: int = 1, seed: int = 42, min_values: int = 1, tol: float = 1e-4,
                  max_rounds: int = 100):
    """JOB-18: rank-k SVD of one sparse rating matrix per group, all groups in the same jobs.

    values: (user_id, item_id, score), or (user_id, item_id, x array<double>) with a value or null for each group
    (``centred_by_fold``). Rows of users and items with fewer than ``min_values`` ratings are left out. Returns matrix
    tables us = U * Sigma (user_id, m) and v (item_id, m), so that the cell (u, i) of group g is us[g] . v[g], and the
    singular values of each group.

    Subspace iteration on 3k columns, cut to k at the end. A round finds the Ritz pairs and ends the work if, in every
    group, the residual of the first k is at most ``tol`` times the gap between the k-th and the next squared singular
    value: that bounds the sine of the angle to the true subspace (Davis-Kahan). A gap under 1e-6 of the largest counts as
    that, since vectors of equal singular values are arbitrary. Otherwise a Chebyshev polynomial of the matrix lifts the
    columns and the next round begins. At least ``iters`` rounds are done; after ``max_rounds`` it raises, so an
    unfinished result is never returned. A step (times the matrix and its transpose) is one written table; the time of
    each is the same however many went before."""
    r = values if "x" in values.columns else values.withColumn("x", F.array("score"))
    r = materialize(r.select(U, I, "x"), "svd_values")
    if min_values > 1:
        for key in (U, I):
            r = r.join(r.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") >= min_values).select(key), key)
        r = materialize(r.select(U, I, "x"), "svd_values")
    one = r.select(F.size("x")).first()
    groups = one[0] if one else 1
    items = materialize(r.select(I).distinct(), "svd_items")
    wide = max(k, min(3 * k, items.count()))

    cols, places = _columns(r, groups, r.count())
    y = _random_start(items, groups, wide, seed)
    for n in range(1, max_rounds + 1):
        basis = _orthonormal(y, I, groups, wide)
        t = materialize(_step(cols, places, basis, ("m",), groups, wide, lambda m, h: (m, h), ("m", "h")), "svd_step")
        discard(basis, *([y] if n > 1 else []))  # the step holds all that is still needed
        ritz = _sums(t, I, _inner, (groups, wide, wide))
        theta, w = np.linalg.eigh((ritz + ritz.transpose(0, 2, 1)) / 2)
        theta, w = np.clip(theta[:, ::-1], 0, None), w[:, :, ::-1]
        first, of_first = w[:, :, :k], theta[:, :k]
        off = np.sqrt(_sums(t, I, lambda m, h, a=first, b=of_first: ((np.einsum("ngk,gkj->ngj", h, a, optimize=True)
                            - b * np.einsum("ngk,gkj->ngj", m, a, optimize=True)) ** 2).sum((0, 2)), (groups,)))
        gap = theta[:, k - 1] - (theta[:, k] if wide > k else 0.0)
        if n >= iters and (off <= tol * np.maximum(gap, 1e-6 * theta[:, 0])).all():
            v = materialize(_apply(t.select(I, "m"), I, first), "svd_v")
            us = materialize(_times(r, v, I, U, groups, k), "svd_us")
            discard(t, r, cols)
            return us, v, np.sqrt(of_first).tolist()
        e, degree = _filter(theta)

        def begin(m, h, w=w, e=e):
            a, b = (np.einsum("ngk,gkj->ngj", x, w, optimize=True) for x in (m, h))
            return a, b / e[:, :, None].transpose(1, 0, 2) - a
        def go_on(p, m, h, e=e):
            return m, 2 * (h / e[:, :, None].transpose(1, 0, 2) - m) - p
        pair = materialize(_by_row(t, I, begin, ("p", "m")), "svd_pair")
        discard(t)
        for _ in range(degree - 1):
            last, pair = pair, materialize(_step(cols, places, pair, ("p", "m"), groups, wide, go_on, ("p", "m")), "svd_pair")
            discard(last)
        y = pair.select(I, "m")
    raise RuntimeError(f"SVD of rank {k}: not within {tol} after {max_rounds} rounds")


def unit_rows(mat: DataFrame) -> DataFrame:
    """The post-normalised rows of U * Sigma (or V): vectors of length 1, whose dot products are similarities."""
    length = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, c: a + c * c))
    return mat.withColumn("m", F.transform("m", lambda v: F.transform(v, lambda c: F.when(length(v) > 0, c / length(v)).otherwise(0.0))))


def svd_predict(cells: DataFrame, us: DataFrame, v: DataFrame, offset: DataFrame | None = None, group=None,
                bound: bool = True) -> DataFrame:
    """Reconstruct U Sigma V^T at the given cells only. ``group`` is the column with a cell's group (0 on; default 0),
    ``offset`` (item_id, off array<double>) is added back after centring (JOB-19). Users and items that the matrix
    lacks count as zero."""
    g = F.lit(0) if group is None else group
    out = cells.join(us.withColumnRenamed("m", "_a"), U, "left").join(v.withColumnRenamed("m", "_b"), I, "left")
    raw = F.coalesce(dot(F.get("_a", g), F.get("_b", g)), F.lit(0.0))
    if offset is not None:
        out = out.join(offset.withColumnRenamed("off", "_off"), I, "left")
        raw = raw + F.coalesce(F.get("_off", g), F.lit(0.0))
    return out.withColumn("pred", clamp(raw) if bound else raw).drop("_a", "_b", "_off")


# --- stratified block SGD (Gemulla et al., KDD 2011) --------------------------

def _init_factors(ids: DataFrame, key: str, k: int, seed: int, salt: int) -> DataFrame:
    """Deterministic 3 * U(0, 1) start vectors (the reference's initial scale)."""
    vec = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: F.pmod(
        F.xxhash64(F.lit(seed), F.lit(salt), F.col(key), j), F.lit(1_000_000)) / F.lit(1_000_000.0) * F.lit(3.0))
    return ids.select(F.col(key).alias("id"), vec.alias("vec"))


def _add_levels(rows):
    """The rows of one block in update order, with the step at which each can be done: one more than the last step that
    touched its user or its item. Rows of one step share neither, so doing a step at once gives what one by one gives."""
    rows = rows.sort_values(["_o", "user_id", "item_id"])
    last_u: dict[int, int] = {}
    last_i: dict[int, int] = {}
    level = np.empty(len(rows), np.int32)
    for n, (u, i) in enumerate(zip(rows["user_id"].tolist(), rows["item_id"].tolist(), strict=True)):
        level[n] = last_u[u] = last_i[i] = max(last_u.get(u, 0), last_i.get(i, 0)) + 1
    rows["level"] = level
    return rows.drop(columns="_o").sort_values("level", kind="stable")


def _pack_cell(rows):
    """The one row of a cell: places of users and items, scores, and where each step of independent ratings begins."""
    import pandas as pd

    rows = _add_levels(rows)
    level = rows["level"].to_numpy()
    cuts = np.concatenate([[0], np.flatnonzero(level[1:] != level[:-1]) + 1]).astype(np.int32)
    return pd.DataFrame({"key": rows["key"].iloc[:1], "stratum": rows["stratum"].iloc[:1], "u": [rows["user_id"].to_numpy(np.int32)],
                         "i": [rows["item_id"].to_numpy(np.int32)], "score": [rows["score"].to_numpy(float)], "cuts": [cuts]})


def _sgd_block(p, q, u, i, score, cuts, gamma: float, lam: float) -> None:
    """SGD over one block, in place: e = r - p.q; p += g (e q - l p); q += g (e p_new - l q), a step of independent ratings
    at a time. Only this block's ratings and the factors of its user and item block are in memory."""
    for a, b in zip(cuts, [*cuts[1:], len(u)], strict=True):
        x, y = p[u[a:b]], q[i[a:b]]
        e = (score[a:b] - np.einsum("nk,nk->n", x, y))[:, None]
        x = x + gamma * (e * y - lam * x)
        q[i[a:b]] = y + gamma * (e * x - lam * y)
        p[u[a:b]] = x


def _numbers(batch, name: str, row: int) -> np.ndarray:
    return np.array(batch.column(name)[row].values.to_numpy(zero_copy_only=False))


def sgd_grid(ratings: int, cell: int = 250_000) -> int:
    """Blocks of users, and of items, so that a cell of the grid has about ``cell`` ratings: a task holds one cell and the
    factors of its users and items. An epoch has as many sub-epochs as there are blocks, of as many tasks each."""
    return max(2, math.ceil(math.sqrt(ratings / cell)))


def _parts(train: DataFrame, key: str, most: int, blocks: int, seed: int) -> DataFrame:
    """Rows (``key``, part, parts, block, sid): each id once, or, with more than ``most`` ratings, once for each of as many
    parts as keep it below that, in blocks by hash. ``sid`` numbers them densely, block by block."""
    parts = train.where(F.col(key).isNotNull()).groupBy(key).agg(F.ceil(F.count("*") / most).cast("int").alias("parts"))
    parts = parts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    h = F.when(F.col("part") == 0, F.xxhash64(F.lit(seed), key)).otherwise(F.xxhash64(F.lit(seed), key, "part"))
    return materialize(global_rank(parts.withColumn("block", F.pmod(h, F.lit(blocks)).cast("int")), ["block", key, "part"], "sid", start=0), "sgd_ids")


class SgdFit(NamedTuple):
    """A fit on disk: ``table`` holds rows (epoch, kind, block, m), the vectors of a block end to end; ``names`` the rows
    (kind, id, part, parts, block, pos) that tell whose vector is at which place."""

    table: str
    names: DataFrame
    blocks: int
    rank: int
    epochs: int


_BLOCK = "kind string, block int, m array<double>"


def _unpack(blocks: DataFrame, rank: int, *more: str) -> DataFrame:
    """Rows (*more, kind, block, pos, vec) of block rows. What is no number becomes null."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for r in range(b.num_rows):
                m = _numbers(b, "m", r)
                for lo in range(0, len(m) // rank, 16_384):
                    v = m[lo * rank:(lo + 16_384) * rank]
                    n = len(v) // rank
                    yield pa.RecordBatch.from_arrays([*[pa.array([b.column(c)[r].as_py()] * n, b.schema.field(c).type) for c in (*more, "kind", "block")],
                                                      pa.array(np.arange(lo, lo + n, dtype=np.int64)),
                                                      pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * rank, pa.array(v, from_pandas=True))],
                                                     [*more, "kind", "block", "pos", "vec"])
    schema = ", ".join([*[f"{c} {blocks.schema[c].dataType.simpleString()}" for c in (*more, "kind", "block")], "pos bigint, vec array<double>"])
    return blocks.select(*more, "kind", "block", "m").mapInArrow(run, schema)


def _pack(rows: DataFrame) -> DataFrame:
    """Block rows of rows (kind, block, pos, vec): a block of the grid is what a task holds."""
    lists = rows.groupBy("kind", "block").agg(F.sort_array(F.collect_list(F.struct("pos", "vec"))).alias("l"))
    return lists.select("kind", "block", F.flatten("l.vec").alias("m"))


def sgd_fit(train: DataFrame, blocks: int, rank: int = SGD_RANK, lam: float = SGD_LAMBDA, gamma: float = SGD_GAMMA,
            epochs: int = SGD_EPOCHS, seed: int = 42, cut_every: int = 8, most: int | None = None) -> SgdFit:
    """JOB-14 SGD mode: distributed stratified SGD; the factors after every epoch, written below the checkpoint folder.

    Users and items are hashed into ``blocks`` blocks each (``sgd_grid``). A sub-epoch updates that many blocks
    (b, (b + s) mod blocks) at a time; they share no user and no item. The grid fixes the update order, so it is a
    parameter and never follows the cluster. A user or item with more than ``most`` ratings (by default the share of one
    block in an even grid) is dealt out as several, each with a copy of its factors; after each epoch the copies are
    replaced by their mean, so no block grows with a hot id. The ratings are written once, a row of arrays for each cell of
    the grid, with their steps in the update order; the factors of a block travel as one row too. Up to ``cut_every``
    sub-epochs form one job: every block's output feeds one reader only, so none is worked out twice."""
    spark = train.sparkSession
    train = train.select(U, I, F.col("score").cast("double").alias("score"))
    most = most or max(1, train.count() // blocks)
    ids = {}
    for kind, key, n in (("p", U, 0), ("q", I, 1)):
        of = _parts(train, key, most, blocks, seed + n)
        first = of.groupBy("block").agg(F.min("sid").alias("_first"))
        ids[kind] = of.join(first, "block").withColumn("pos", F.col("sid") - F.col("_first")).drop("_first")
    r = train.withColumn("_o", F.xxhash64(F.lit(seed + 2), U, I))
    for kind, key, other in (("p", U, I), ("q", I, U)):  # which part of a hot id a rating belongs to follows from the other id
        r = r.join(ids[kind].where("part = 0").select(key, "parts"), key).withColumn(f"_{kind}", F.pmod(F.xxhash64(F.lit(seed + 3), other), "parts").cast("int")).drop("parts")
    for kind, key in (("p", U), ("q", I)):
        r = r.join(ids[kind].select(key, F.col("part").alias(f"_{kind}"), F.col("pos").alias(f"{kind}_pos"), F.col("block").alias(f"{kind}_block")), [key, f"_{kind}"])
    r = r.select(F.col("p_pos").alias(U), F.col("q_pos").alias(I), "score", "_o", F.col("p_block").alias("key"),
                 F.pmod(F.col("q_block") - F.col("p_block"), F.lit(blocks)).cast("int").alias("stratum"))
    cell = "u array<int>, i array<int>, score array<double>, cuts array<int>"
    r = r.groupBy("stratum", "key").applyInPandas(_pack_cell, f"key int, stratum int, {cell}")
    strata, table = scratch_path(spark, "sgd_ratings"), scratch_path(spark, "sgd_factors")
    r.write.partitionBy("stratum").parquet(strata)
    r = spark.read.schema(f"key int, {cell}, stratum int").parquet(strata)
    named = materialize(ids["p"].select(F.lit("p").alias("kind"), F.col(U).alias("id"), "part", "parts", "block", "pos").unionByName(
        ids["q"].select(F.lit("q").alias("kind"), F.col(I).alias("id"), "part", "parts", "block", "pos")), "sgd_names")
    copies = named.where("parts > 1").select("kind", "block", "pos", F.col("id").alias("whole"))
    split = not copies.isEmpty()
    first = [_init_factors(ids[kind].where("part = 0"), key, rank, seed, salt).withColumn("kind", F.lit(kind)) for kind, key, salt in (("p", U, 1), ("q", I, 2))]
    f = _pack(named.join(first[0].unionByName(first[1]), ["kind", "id"]).select("kind", "block", "pos", "vec"))

    def run(batches):  # the rows of a key: the cell (c), the factors of its users (p) and of its items (q)
        import pyarrow as pa

        def done(held):
            if len(held) == 3:
                p, q = (held[x][1].reshape(-1, rank) for x in "pq")  # views: updated in place
                _sgd_block(p, q, *held["c"], gamma, lam)
            for kind in "pq":
                if kind in held:
                    block, m = held[kind]
                    yield pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([block], pa.int32()), pa.ListArray.from_arrays(
                        np.array([0, len(m)], np.int32), pa.array(m))], ["kind", "block", "m"])
        key, held = None, {}
        for b in batches:
            for n in range(b.num_rows):
                if b.column("key")[n].as_py() != key:
                    yield from done(held)
                    key, held = b.column("key")[n].as_py(), {}
                kind = b.column("kind")[n].as_py()
                held[kind] = [_numbers(b, c, n) for c in ("u", "i", "score", "cuts")] if kind == "c" else (b.column("block")[n].as_py(), _numbers(b, "m", n))
        yield from done(held)
    mean = F.array(*[F.avg(F.get("vec", F.lit(j))) for j in range(rank)])
    for epoch in range(1, epochs + 1):
        for s in range(blocks):
            at = F.when(F.col("kind") == "p", F.col("block")).otherwise(F.pmod(F.col("block") - s, F.lit(blocks))).cast("int")
            rows = r.where(F.col("stratum") == s).drop("stratum").withColumn("kind", F.lit("c"))
            both = f.withColumn("key", at).unionByName(rows, allowMissingColumns=True).repartition(4 * blocks, "key").sortWithinPartitions("key", "kind")
            f = both.mapInArrow(run, _BLOCK)
            if (s + 1) % cut_every == 0 and s + 1 < blocks:
                f = materialize(f, "sgd_part")
        if split:
            f = materialize(_unpack(f, rank), "sgd_part")
            own = materialize(f.join(copies, ["kind", "block", "pos"]), "sgd_copies")
            new = own.drop("vec").join(own.groupBy("kind", "whole").agg(mean.alias("vec")), ["kind", "whole"])
            f = _pack(f.join(own.select("kind", "block", "pos"), ["kind", "block", "pos"], "left_anti").unionByName(new.drop("whole")))
        f.write.parquet(f"{table}/epoch={epoch}")
        f = spark.read.schema(_BLOCK).parquet(f"{table}/epoch={epoch}")
    return SgdFit(table, named, blocks, rank, epochs)


def sgd_rows(fit: SgdFit, epoch: int | None = None) -> DataFrame:
    """Rows (epoch, kind, id, vec) of a fit: the factors after one epoch, or with None after each."""
    done = fit.names.sparkSession.read.schema(f"{_BLOCK}, epoch int").parquet(fit.table)
    done = _unpack(done if epoch is None else done.where(F.col("epoch") == epoch), fit.rank, "epoch")
    # all copies of an id are equal after an epoch: its first part stands for it
    return done.join(fit.names.where("part = 0").select("kind", "block", "pos", "id"), ["kind", "block", "pos"]).select("epoch", "kind", "id", "vec")


def sgd_factors(train: DataFrame, blocks: int, **how) -> DataFrame:
    """``sgd_fit`` and the written rows (epoch, kind, id, vec) after every epoch (``epoch_factors`` reads one)."""
    return materialize(sgd_rows(sgd_fit(train, blocks, **how)), "sgd_epochs")


def sgd_errors(fit: SgdFit, cells: DataFrame, together: int = 4) -> DataFrame:
    """JOB-15 / JOB-16: rows (epoch, split, rmse, mae, sqrt_mae, n) of cells (split, user_id, item_id, score) after every
    epoch, unclamped. A cell without factors or score counts in n only, as in ``error_metrics``.

    The cells are dealt to the grid of the fit; a task holds one cell of the grid and meets the factor blocks of
    ``together`` epochs one epoch at a time, so a rating moves once for these and a factor once for each block."""
    names, grid = fit.names.where("part = 0"), range(fit.blocks)
    for kind, key, block, pos in (("p", U, "ub", "u"), ("q", I, "ib", "i")):
        of = names.where(F.col("kind") == kind).select(F.col("id").alias(key), F.col("block").alias(block), F.col("pos").cast("int").alias(pos))
        cells = cells.join(of, key, "left")
    cells = materialize(cells.select("split", "ub", "ib", "u", "i", F.col("score").cast("double").alias("score")), "sgd_cells")
    whole = cells.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    lists = cells.where("ub is not null and ib is not null and score is not null").groupBy("ub", "ib", "split").agg(F.collect_list(F.struct("u", "i", "score")).alias("c"))
    chunks = -(-fit.epochs // together)
    lists = lists.select("ub", "ib", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), F.lit(0).alias("epoch"), F.lit("c").alias("kind"),
                         "split", F.col("c.u").alias("u"), F.col("c.i").alias("i"), F.col("c.score").alias("score"))
    f = cells.sparkSession.read.schema(f"{_BLOCK}, epoch int").parquet(fit.table).withColumn("chunk", F.floor((F.col("epoch") - 1) / together).cast("int"))
    every = F.explode(F.array(*[F.lit(n) for n in grid]))
    f = f.where("kind = 'p'").select(F.col("block").alias("ub"), every.alias("ib"), "chunk", "epoch", "kind", "m").unionByName(
        f.where("kind = 'q'").select(every.alias("ub"), F.col("block").alias("ib"), "chunk", "epoch", "kind", "m"))
    keys = ["ub", "ib", "chunk"]
    both = f.unionByName(lists, allowMissingColumns=True).repartition(min(fit.blocks ** 2 * chunks, 20_000), *keys).sortWithinPartitions(*keys, "epoch", "kind")
    rank = fit.rank

    def run(batches):
        import pyarrow as pa

        at, held, p = None, [], None
        for b in batches:
            for n in range(b.num_rows):
                key = tuple(b.column(c)[n].as_py() for c in keys)
                if key != at:
                    at, held, p = key, [], None
                kind, epoch = b.column("kind")[n].as_py(), b.column("epoch")[n].as_py()
                if kind == "c":
                    held.append([b.column("split")[n].as_py(), *[_numbers(b, c, n) for c in ("u", "i", "score")]])
                elif kind == "p":
                    p = _numbers(b, "m", n).reshape(-1, rank), epoch
                elif p is not None and p[1] == epoch:
                    q = _numbers(b, "m", n).reshape(-1, rank)
                    for split, u, i, score in held:
                        e = np.concatenate([np.einsum("nk,nk->n", p[0][u[lo:lo + 65_536]], q[i[lo:lo + 65_536]]) - score[lo:lo + 65_536] for lo in range(0, len(u), 65_536)])
                        e = e[~np.isnan(e)]
                        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (epoch, split, len(e), float(e @ e), float(np.abs(e).sum()))], ["epoch", "split", "c", "se", "ae"])
    sums = both.mapInArrow(run, "epoch bigint, split string, c bigint, se double, ae double").groupBy(F.col("epoch").cast("int").alias("epoch"), "split").agg(
        *[F.sum(x).alias(x) for x in ("c", "se", "ae")])
    out = whole.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(fit.epochs)))).join(sums, ["epoch", "split"], "left")
    mean = lambda x: F.when(F.col("c") > 0, F.col(x) / F.col("c"))
    return out.select("epoch", "split", F.sqrt(mean("se")).alias("rmse"), mean("ae").alias("mae"), F.sqrt(mean("ae")).alias("sqrt_mae"), "n")


def epoch_factors(factors: DataFrame, epoch: int | None = None):
    """(user_id, p) and (item_id, q) of one epoch; with None, of all, with the column epoch."""
    f = factors if epoch is None else factors.where(F.col("epoch") == epoch)
    by = ["epoch"] if epoch is None else []
    return (f.where("kind = 'p'").select(*by, F.col("id").alias(U), F.col("vec").alias("p")),
            f.where("kind = 'q'").select(*by, F.col("id").alias(I), F.col("vec").alias("q")))

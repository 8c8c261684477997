"""Neighbourhood jobs as a block-sparse product of the rating matrix with itself.

Similarities of entities (items, or users) are dot products over contexts (users, or items). The rows are dealt out by
block of targets: a task gets the rows of one block of target entities, and block by block the neighbours' rows in
contexts that those targets occur in. There it multiplies the two sparse matrices in bounded strips, for every fold at once, and keeps what the caller asked for: the best neighbours of each target row, their sum,
or the entries of the product. Neither co-rated pairs nor candidates become rows of a table, so a context with M rows
costs M rows for each block it touches, not M squared.

Contexts of up to ``heavy`` rows in a task are paired up with arrays. Larger ones are multiplied as dense matrices, a
few contexts at a time; the best neighbours of their rows come from the target's neighbours in descending order, which
is left as soon as enough of them occur in the context.

Profiles of the entities (features with weights) can be dealt out beside the rows. Their similarity is then worked out in
the task for the pairs of a strip, from the target's features and the block's list of each, and blended into the measure.

A task holds its rows at about 30 bytes each, and the rows of one entity are held together."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.operators.ranking import global_rank
from cinerank.operators.similarity import fold_stats
from cinerank.session import materialize

NANO = 1_000_000_000
STATS_T, STATS_N, TARGET, NEIGHBOUR, PROFILE_T, PROFILE_N = range(6)
#: the columns that travel for each side
FIELDS = {STATS_T: ("e", "st"), STATS_N: ("e", "st"), TARGET: ("c", "e", "v", "fold", "b", "cp"), NEIGHBOUR: ("c", "e", "v", "fold"),
          PROFILE_T: ("c", "e", "v"), PROFILE_N: ("c", "e", "v")}
TYPES = {"c": np.int64, "e": np.int64, "fold": np.int32}  # others are doubles
DEALT = "p int, q int, side tinyint, n int, cols binary"
PACK_ROWS = 1_000_000  # rows of a task that are put together before they are dealt out
SLICE = 100_000  # pairs whose measure is worked out at once
KEPT_ROWS = 16_384  # target rows whose best neighbours are put together at once


def nano(x: np.ndarray) -> np.ndarray:
    """Values in billionths, half away from zero, as a cast to DECIMAL(18,9) rounds."""
    return (np.sign(x) * np.floor(np.abs(x) * NANO + 0.5)).astype(np.int64)


@dataclass
class Stats:
    """Of each entity and fold, over the fold's train rows: their number, sum and squared sum, and how many have a value."""
    n: np.ndarray
    s: np.ndarray
    q: np.ndarray
    known: np.ndarray

    def at(self, k: np.ndarray) -> Stats:
        return Stats(self.n[k], self.s[k], self.q[k], self.known[k])

    def mean(self) -> np.ndarray:
        return np.divide(self.s, self.known, out=np.zeros_like(self.s), where=self.known > 0)

    def centred(self) -> np.ndarray:
        """The squared norm around the mean; equal values have none, but for rounding."""
        spread = self.q * self.known - self.s * self.s
        return np.where(spread <= 1e-12 * self.q * self.known, 0.0, np.divide(spread, self.known, out=np.zeros_like(self.s), where=self.known > 0))


def _cosine(dot: np.ndarray, qa: np.ndarray, qb: np.ndarray) -> np.ndarray:
    ok = (qa > 0) & (qb > 0)
    return np.where(ok, nano(np.divide(dot, np.sqrt(qa * qb), out=np.zeros_like(dot), where=ok)), -NANO)


def _cos(m, a: Stats, b: Stats) -> np.ndarray:
    return _cosine(m["dot"], a.q, b.q)


def _pears(m, a: Stats, b: Stats) -> np.ndarray:
    ma, mb = a.mean(), b.mean()
    return _cosine(m["dot"] - ma * m["sb"] - mb * m["sa"] + m["both"] * ma * mb, a.centred(), b.centred())


def _share(part: np.ndarray, union: np.ndarray) -> np.ndarray:
    return nano(np.divide(part, union, out=np.zeros_like(part), where=union != 0))


def _jac(m, a: Stats, b: Stats) -> np.ndarray:
    return _share(m["co"], a.n + b.n - m["co"])


def _signed(m, a: Stats, b: Stats) -> np.ndarray:
    return _share(m["dot"], a.n + b.n - m["co"])


def _signed_as_written(m, a: Stats, b: Stats) -> np.ndarray:
    return _share(m["dot"] + 2 * (m["co"] - m["sa"] + m["sb"] - m["dot"]) / 4, a.n + b.n - m["co"])


def _cos_distance(m, a: Stats, b: Stats) -> np.ndarray:
    ok = (a.q > 0) & (b.q > 0)
    return np.where(ok, nano(1 - np.divide(m["dot"], np.sqrt(a.q * b.q), out=np.zeros_like(a.q), where=ok)), -NANO)


def _euclid(m, a: Stats, b: Stats) -> np.ndarray:
    return nano(np.sqrt(np.maximum(a.q + b.q - 2 * m["dot"], 0.0)))


#: (sums it needs, function of them and both sides' statistics to billionths, whether more is better); the sums are dot, co
#: (common rows), both (those where both have a value), sa and sb (the values of either side over these), by pair and fold
Measure = tuple[tuple[str, ...], Callable, bool]
MEASURES: dict[str, Measure] = {
    "cos": (("dot",), _cos, True), "pears": (("dot", "both", "sa", "sb"), _pears, True), "jac": (("co",), _jac, True),
    "signed": (("dot", "co"), _signed, True), "signed_as_written": (("dot", "co", "sa", "sb"), _signed_as_written, True),
    "cos_distance": (("dot",), _cos_distance, False), "euc_distance": (("dot",), _euclid, False)}


@dataclass
class Profiles:
    """What entities are described by: rows (``entity``, ``feature``, ``weight``), unique per entity and feature, and how two
    are compared: "cos", "jac" (of the feature sets) or "dot" (weights of unit length). Called with pairs (a, b) it gives
    (a, b, csim) for these."""
    rows: DataFrame
    entity: str
    feature: str
    weight: str
    kind: str
    pairs: Callable

    def __call__(self, pairs: DataFrame) -> DataFrame:
        return self.pairs(pairs)

    def numbered(self) -> DataFrame:
        """(e, c, v) with features as numbers; others than whole numbers get their rank."""
        rows = self.rows.select(F.col(self.entity).cast("long").alias("e"), F.col(self.feature).alias("f"), F.col(self.weight).cast("double").alias("v"))
        if self.rows.schema[self.feature].dataType.typeName() not in ("byte", "short", "integer", "long"):
            ids = global_rank(rows.select("f").distinct(), ["f"], "id")
            rows = rows.join(ids, "f").select("e", F.col("id").alias("f"), "v")
        return rows.select("e", F.col("f").cast("long").alias("c"), "v")


def _planes(x: np.ndarray) -> bytes:
    """Rows of numbers as planes of bytes: the leading bytes of ids and of short fractions are alike, and shrink when sent."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes()


def _packed(side: int, cols: dict[str, np.ndarray]) -> bytes:
    return b"".join(_planes(np.diff(cols[k], prepend=0) if k == "c" else cols[k]) for k in FIELDS[side])


def _unpacked(side: int, n: int, raw: bytes) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in FIELDS[side]:
        kind = np.dtype(TYPES.get(k, np.float64))
        wide = len(raw) - at if k == "st" else kind.itemsize * n
        x = np.frombuffer(raw, np.uint8, wide, at).reshape(-1, n).T
        x = np.ascontiguousarray(x).view(kind)
        out[k], at = (np.cumsum(x[:, 0]) if k == "c" else x if k == "st" else x[:, 0]), at + wide
    return out


def _squeezed(side: int, cols: dict[str, np.ndarray]) -> bytes:
    """The columns compressed: they take a fraction where they are sorted, and less when sent. Ids in ascending order go as
    steps, and values of which there are few as places in their list."""
    out = []
    for k in FIELDS[side]:
        x = np.diff(cols[k], prepend=0) if k == "c" or (k == "e" and side not in (TARGET, NEIGHBOUR)) else cols[k]
        if k == "v":
            values, place = np.unique(x, return_inverse=True)
            few = len(values) <= 1 << 16
            out.append((len(values) if few else -1).to_bytes(8, "little", signed=True))
            if few:
                out.append(values.tobytes())
                x = place.astype(np.uint16)
        out.append(_planes(x))
    raw = b"".join(out)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _loose(side: int, n: int, data: bytes) -> dict[str, np.ndarray]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    out, at = {}, 0
    for k in FIELDS[side]:
        kind, values = np.dtype(TYPES.get(k, np.float64)), None
        if k == "v":
            few, at = int.from_bytes(raw[at:at + 8], "little", signed=True), at + 8
            if few >= 0:
                values, at, kind = np.frombuffer(raw, np.float64, few, at), at + 8 * few, np.dtype(np.uint16)
        wide = len(raw) - at if k == "st" else kind.itemsize * n
        x = np.ascontiguousarray(np.frombuffer(raw, np.uint8, wide, at).reshape(-1, n).T).view(kind)
        at += wide
        if k != "st":
            x = x[:, 0]
        if k == "c" or (k == "e" and side not in (TARGET, NEIGHBOUR)):
            x = np.cumsum(x)
        out[k] = x if values is None else values[x]
    return out


def _pack(side: int, squeeze: bool = False) -> Callable:
    """Rows (ps, q, the side's columns) to one record for each block of ``ps`` and ``q``, many rows in each."""
    fields = FIELDS[side]
    closed = _squeezed if squeeze else _packed

    def records(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        at, q = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        cols = {k: np.concatenate([h[2][k] for h in held]) for k in fields}
        row = np.concatenate([h[3] + first for h, first in zip(held, np.cumsum([0] + [len(h[1]) for h in held[:-1]]), strict=True)])
        q = q[row]
        order = np.lexsort((*[cols[k][row] for k in ("e", "c") if k in cols], q, at))
        at, q, row = at[order], q[order], row[order]
        cuts = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (q[1:] != q[:-1])]))
        ends = np.append(cuts[1:], len(at))
        out = [closed(side, {k: x[row[lo:hi]] for k, x in cols.items()}) for lo, hi in zip(cuts.tolist(), ends.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(at[cuts], pa.int32()), pa.array(q[cuts], pa.int32()), pa.array(np.full(len(cuts), side, np.int8)),
                                          pa.array(ends - cuts, pa.int32()), pa.array(out, pa.binary())], ["p", "q", "side", "n", "cols"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            ps = b.column("ps")
            counts = np.diff(ps.offsets.to_numpy())
            cols = {}
            for k in fields:
                if k == "st":
                    cols[k] = b.column(k).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                else:
                    cols[k] = b.column(k).to_numpy(zero_copy_only=False).astype(TYPES.get(k, np.float64))
            held.append((ps.flatten().to_numpy(), b.column("q").to_numpy(), cols, np.repeat(np.arange(b.num_rows), counts)))
            size += len(held[-1][0])
            if size >= PACK_ROWS:
                yield from records(held)
                held, size = [], 0
        if held:
            yield from records(held)

    return run


def deal_blocks(rows: DataFrame, entity: str, context: str, folds: Sequence[int], target_rows: int = 400_000, neighbour_rows: int = 1_000_000,
                profiles: Profiles | None = None, leaky: bool = False, squeeze: bool = False, train_only: bool = False) -> tuple[DataFrame, int]:
    """The rows of every task, as DEALT, and the number of tasks.

    rows: fold, ``entity``, ``context``, v, b, cp; unique per entity and context. A task has a block of targets, and reads the
    neighbours block by block. The number of both depends on the number of rows only, but that a few rows more are sent
    for a task on every core. A row goes to a block of targets only if its context occurs there, so it travels at most as
    often as its context has rows; statistics and profile of an entity go to every block of targets. Rows are dealt as
    columns of many rows, not one by one. ``leaky``: no fold leaves its own rows out. ``squeeze``: the columns are compressed.
    ``train_only``: of a single fold the neighbours' rows that it leaves out stay away, as no sum and no list needs them.

    A row without an entity, a context or a fold meets no other row, and one without a value adds to numbers of rows only."""
    sc = rows.sparkSession.sparkContext
    e = F.col(entity).cast("long")
    r = rows.select(F.col(context).cast("long").alias("c"), e.alias("e"), F.col("v").cast("double").alias("v"), F.col("fold").cast("int").alias("fold"),
                    F.col("b").cast("double").alias("b"), F.col("cp").cast("double").alias("cp")).dropna(subset=["c", "e", "fold"])
    n = r.count()
    tall = max(1, -(-n // target_rows), min(-(-n // 40_000), 2 * sc.defaultParallelism))

    def block_of(seed: int, blocks: int):
        return F.pmod(F.xxhash64(F.lit(seed), "e"), F.lit(blocks)).cast("int")

    p = block_of(1, tall)
    touched = materialize(r.groupBy("c").agg(F.collect_set(p).alias("ps"), F.count(F.lit(1)).alias("_n")), "block_contexts")
    dealt = touched.agg(F.sum(F.col("_n") * F.size("ps"))).first()[0] or 0
    wide = max(1, -(-dealt // (tall * neighbour_rows)))
    if profiles is not None:
        features = materialize(profiles.numbered(), "block_profiles")
        if profiles.kind == "jac":  # sets of features: their weights are of no use
            features = features.withColumn("v", F.lit(1.0))
        wide = max(wide, -(-features.count() // (3 * neighbour_rows)))
    q, alone, own = block_of(2, wide), F.lit(-1), F.array(p)
    seen = r.withColumn("fold", F.lit(-1)) if leaky else r.where(F.col("fold") != folds[0]) if train_only and len(folds) == 1 else r
    every = rows.select(e.alias("e"), (F.lit(-1) if leaky else F.col("fold").cast("int")).alias("fold"), F.col("v").cast("double").alias("v")).where("e is not null")
    known = fold_stats(every.withColumn("v", F.col("v").isNotNull().cast("double")), "e", folds, "v", "k").select("e", "ks") if every.where("v is null").take(1) else None
    st = fold_stats(every, "e", folds, "v", "x").withColumn("xn", F.col("xn").cast("array<double>"))
    st = st.withColumn("ks", F.col("xn")) if known is None else st.join(known, "e")
    st = st.select("e", F.concat("xn", "xs", "xq", "ks").alias("st"))

    def packed(x: DataFrame, side: int) -> DataFrame:
        return x.select("ps", "q", *FIELDS[side]).mapInArrow(_pack(side, squeeze), DEALT)

    def everywhere(x: DataFrame, side: int) -> DataFrame:
        once = packed(x.withColumn("q", q).withColumn("ps", F.array(F.lit(0))), side)
        return once.withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(tall - 1)))).select("p", "q", "side", "n", "cols")

    out = packed(r.withColumn("q", alone).withColumn("ps", own), TARGET)
    out = out.unionByName(packed(seen.withColumn("q", q).join(touched.select("c", "ps"), "c"), NEIGHBOUR))
    out = out.unionByName(packed(st.withColumn("q", alone).withColumn("ps", own), STATS_T)).unionByName(everywhere(st, STATS_N))
    if profiles is not None:
        described = features.join(st.select("e"), "e")
        out = out.unionByName(packed(described.withColumn("q", alone).withColumn("ps", own), PROFILE_T)).unionByName(everywhere(described, PROFILE_N))
    return out.repartitionById(tall, F.col("p")).sortWithinPartitions("p", "q", "side"), tall


class Pair:
    """The rows of one block of targets and one block of neighbours, as columns of each side."""

    def __init__(self, p: int, sides: dict[int, list[dict]]):
        self.p, self.sides = p, sides

    def column(self, side: int, name: str) -> np.ndarray:
        kind = TYPES.get(name, np.float64)
        return np.concatenate([np.empty(0, kind), *[x[name] for x in self.sides.get(side, [])]]) if name != "st" else \
            np.concatenate([x[name] for x in self.sides[side]]) if side in self.sides else np.empty((0, 0))


def _groups(batches: Iterator[pa.RecordBatch], squeezed: bool = False) -> Iterator[Pair]:
    """One pair of blocks after the other: the targets of a block come before its blocks of neighbours."""
    mine: dict[int, list[dict]] = {}
    held: dict[int, list[dict]] = {}
    now = None
    for b in batches:
        for p, q, side, n, raw in zip(*[b.column(k).to_pylist() for k in range(5)], strict=True):
            if held and now != (p, q):
                if now[1] < 0:
                    mine = held
                else:
                    yield Pair(now[0], mine | held)
                held = {}
            now = (p, q)
            held.setdefault(side, []).append((_loose if squeezed else _unpacked)(side, n, raw))
    if held and now[1] >= 0:
        yield Pair(now[0], mine | held)


def _add(keys: np.ndarray, sums: dict, k: np.ndarray, part: dict) -> tuple[np.ndarray, dict]:
    if not len(keys):
        return k, part
    both, inv = np.unique(np.concatenate([keys, k]), return_inverse=True)
    out = {}
    for m in sums:
        x = np.zeros((len(both), sums[m].shape[1]))
        x[inv[:len(keys)]] = sums[m]
        x[inv[len(keys):]] += part[m]
        out[m] = x
    return both, out


def _ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places from each first to each last, one range after the other, and the size of each."""
    size = last - first
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size), size


class Block:
    """One task's targets and neighbours, with entities numbered in ascending order of their ids."""

    def __init__(self, t: Pair, folds: Sequence[int], measure: Measure | str, heavy: int, blend: tuple[str, float] | None = None, leaky: bool = False,
                 shared: dict | None = None):
        """``shared`` keeps what every block of neighbours of the same targets would work out again."""
        get = t.column
        self.folds, self.heavy, self.leaky = np.array(folds, np.int32), heavy, leaky
        self.sums, self.rank, self.more = MEASURES[measure] if isinstance(measure, str) else measure
        self.measure, self.blend = measure, blend
        shared = {} if shared is None else shared
        if not shared:
            shared.update(self._targets(get, len(folds), blend is not None))
        vars(self).update(shared)
        self.n_ids, self.n_stats = self._stats(get(STATS_N, "e"), get(STATS_N, "st"), len(folds))
        self.n_mean = self.n_stats.mean()
        nc, ne = get(NEIGHBOUR, "c"), np.searchsorted(self.n_ids, get(NEIGHBOUR, "e"))
        order = np.lexsort((ne, nc))
        self.nc, self.ne, self.nv, self.nf = nc[order], ne[order], get(NEIGHBOUR, "v")[order], get(NEIGHBOUR, "fold")[order]
        self.nz, self.nk = self._known(self.nv)
        self.lo, self.hi = np.searchsorted(self.nc, self.tc, "left"), np.searchsorted(self.nc, self.tc, "right")
        if blend:
            e, f, w = (get(PROFILE_N, c) for c in ("e", "c", "v"))
            e = np.searchsorted(self.n_ids, e).astype(np.int32)
            order = np.lexsort((e, f))
            self.pn_e, self.pn_f, self.pn_w = e[order], f[order], np.nan_to_num(w[order])
            order = np.argsort(self.pn_e, kind="stable")  # and by neighbour, features as their places in ``features``
            self.features, code = np.unique(self.pn_f, return_inverse=True)
            self.pe_f, self.pe_w = code.astype(np.int32)[order], self.pn_w[order]
            self.pe_at = np.searchsorted(self.pn_e[order], np.arange(len(self.n_ids) + 1))

    @staticmethod
    def _known(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values with 0 for none, and 1 or 0 for whether there is one."""
        none = np.isnan(v)
        return (np.nan_to_num(v), 1.0 - none) if none.any() else (v, np.broadcast_to(1.0, len(v)))

    def _targets(self, get: Callable, folds: int, blend: bool) -> dict:
        out = dict(zip(("t_ids", "t_stats"), self._stats(get(STATS_T, "e"), get(STATS_T, "st"), folds), strict=True))
        te = np.searchsorted(out["t_ids"], get(TARGET, "e"))
        order = np.argsort(te, kind="stable")
        out["te"] = te[order]
        out |= {k: get(TARGET, c)[order] for k, c in (("tc", "c"), ("tv", "v"), ("tf", "fold"), ("b", "b"), ("cp", "cp"))}
        out["tz"], out["tk"] = self._known(out["tv"])
        if blend:
            e = np.searchsorted(out["t_ids"], get(PROFILE_T, "e"))
            order = np.lexsort((get(PROFILE_T, "c"), e))
            out |= {"pt_e": e[order], "pt_f": get(PROFILE_T, "c")[order], "pt_w": np.nan_to_num(get(PROFILE_T, "v")[order])}
        return out

    @staticmethod
    def _stats(ids: np.ndarray, st: np.ndarray, folds: int) -> tuple[np.ndarray, Stats]:
        order = np.argsort(ids)
        x = st.reshape(-1, 4, folds)[order]
        return ids[order], Stats(x[:, 0], x[:, 1], x[:, 2], x[:, 3])

    def out(self, folds: np.ndarray, f: int) -> np.ndarray:
        """Which target rows fold ``f`` leaves out; neighbours of a leaky product have no fold."""
        return np.zeros(len(folds), bool) if self.leaky else folds == f

    def strips(self, limit: int) -> Iterator[tuple[int, int]]:
        """Ranges of target rows, whole entities each, with at most ``limit`` light pairs and cells of dense products, or one entity."""
        size = self.hi - self.lo
        size = np.where(size > self.heavy, 0, size)
        first = np.flatnonzero(np.concatenate([[True], self.te[1:] != self.te[:-1]])) if len(self.te) else np.empty(0, np.int64)
        ends = np.concatenate([first[1:], [len(self.te)]])
        begin, held = 0, 0
        for a, z in zip(first.tolist(), ends.tolist(), strict=True):
            own = int(size[a:z].sum()) + (len(self.n_ids) if (self.hi[a:z] - self.lo[a:z] > self.heavy).any() else 0)
            if a > begin and held + own > limit:
                yield begin, a
                begin, held = a, 0
            held += own
        if len(self.te):
            yield begin, len(self.te)

    def chunks(self, a: int, z: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The light pairs of the rows a to z, about ``limit`` at a time; a row's pairs come together."""
        size = self.hi[a:z] - self.lo[a:z]
        upto = np.cumsum(np.where(size > self.heavy, 0, size))
        cuts = [a, *(a + np.unique(np.searchsorted(upto, np.arange(limit, int(upto[-1]), limit)) + 1)).tolist(), z]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi > lo:
                x, y = self.light_pairs(lo, hi)
                if len(x):
                    yield x, y

    def light_pairs(self, a: int, z: int) -> tuple[np.ndarray, np.ndarray]:
        """(target row, neighbour row) of the rows a to z in contexts that are not heavy, by target row and neighbour id."""
        rows = np.arange(a, z)
        size = self.hi[a:z] - self.lo[a:z]
        size = np.where(size > self.heavy, 0, size)
        x = np.repeat(rows, size)
        y = np.arange(len(x)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.lo[a:z], size)
        return x, y

    def product(self, a: int, z: int, limit: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Keys (entity in the strip * neighbours + neighbour) of its pairs, ascending, and each sum per pair and fold."""
        base, keys = int(self.te[a]), np.empty(0, np.int64)
        sums = {m: np.empty((0, len(self.folds))) for m in self.sums}
        for x, y in self.chunks(a, z, limit):
            k, inv = np.unique((self.te[x] - base) * len(self.n_ids) + self.ne[y], return_inverse=True)
            part = {m: np.empty((len(k), len(self.folds))) for m in self.sums}
            factors = {"dot": (self.tz, self.nz), "both": (self.tk, self.nk), "sa": (self.tz, self.nk), "sb": (self.tk, self.nz)}
            term = {m: factors[m][0][x] * factors[m][1][y] for m in part if m in factors} | {"co": np.ones(len(x))}
            for j, f in enumerate(self.folds):
                ta, tb = self.out(self.tf[x], f), self.nf[y] == f
                for m in part:
                    w = (ta != tb).astype(float) if m == "asked" else np.where(ta | tb, 0.0, term[m])
                    part[m][:, j] = np.bincount(inv, w, len(k))
            keys, sums = _add(keys, sums, k, part)
        rows = np.arange(a, z)[self.hi[a:z] - self.lo[a:z] > self.heavy]
        if len(rows):
            keys, sums = _add(keys, sums, *self.dense(rows, base))
        return keys, sums

    def dense(self, rows: np.ndarray, base: int, at_once: int = 64) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """The same for the heavy contexts of ``rows``, ``at_once`` contexts at a time, as products of dense matrices."""
        used, width, contexts = np.unique(self.te[rows]), len(self.n_ids), np.unique(self.tc[rows])
        total = {m: np.zeros((len(self.folds), len(used), width)) for m in self.sums}
        seen = np.zeros((len(used), width), bool)
        for k in range(0, len(contexts), at_once):
            some = contexts[k:k + at_once]
            mine = rows[np.isin(self.tc[rows], some)]
            theirs = np.concatenate([np.arange(*np.searchsorted(self.nc, [c, c + 1])) for c in some])
            at_t, at_n = (np.searchsorted(used, self.te[mine]), np.searchsorted(some, self.tc[mine])), (np.searchsorted(some, self.nc[theirs]), self.ne[theirs])

            def filled(shape: tuple, at: tuple, x) -> np.ndarray:
                out = np.zeros(shape)
                out[at] = x
                return out

            left = lambda x: filled((len(used), len(some)), at_t, x)  # noqa: B023, E731
            right = lambda x: filled((len(some), width), at_n, x)  # noqa: B023, E731
            seen |= (left(1.0) @ right(1.0)) > 0
            for j, f in enumerate(self.folds):
                ta, tb = self.out(self.tf[mine], f), self.nf[theirs] == f
                la, ra = {"v": left(np.where(ta, 0.0, self.tz[mine])), "1": left(~ta)}, {"v": right(np.where(tb, 0.0, self.nz[theirs])), "1": right(~tb)}
                la["k"], ra["k"] = left(np.where(ta, 0.0, self.tk[mine])), right(np.where(tb, 0.0, self.nk[theirs]))
                for m in self.sums:
                    if m == "asked":
                        total[m][j] += left(ta) @ ra["1"] + la["1"] @ right(tb)
                    else:
                        u, w = {"dot": "vv", "co": "11", "both": "kk", "sa": "vk", "sb": "kv"}[m]
                        total[m][j] += la[u] @ ra[w]
        i, j = np.nonzero(seen)
        return (used[i] - base) * width + j, {m: total[m][:, i, j].T for m in self.sums}

    def values(self, keys: np.ndarray, sums: dict[str, np.ndarray], base: int, limit: int = 1_000_000) -> np.ndarray:
        """The measure, in billionths, per pair and fold; with profiles, blended with their similarity unless an entity's
        norm is zero."""
        out = np.empty((len(keys), len(self.folds)), np.int64)
        width = max(1, len(self.n_ids))
        alike = self.profile_similarity(keys, base, limit)[:, None] if self.blend and len(keys) else None
        for lo in range(0, len(keys), SLICE):
            part = slice(lo, lo + SLICE)
            a, b = self.t_stats.at(base + keys[part] // width), self.n_stats.at(keys[part] % width)
            out[part] = own = self.rank({m: x[part] for m, x in sums.items()}, a, b)
            if not self.blend:
                continue
            p = self.blend[1]
            mixed = nano(p * alike[part] + (1.0 - p) * (own / NANO))
            norm = {"cos": lambda s: s.q, "pears": Stats.centred}.get(self.measure if isinstance(self.measure, str) else "")
            out[part] = mixed if norm is None else np.where((norm(a) > 0) & (norm(b) > 0), mixed, own)
        return out

    def profile_similarity(self, keys: np.ndarray, base: int, limit: int) -> np.ndarray:
        """The similarity of both profiles for every pair, one target after the other: the lists of its features in this
        block, about ``limit`` entries at a time, are added up by neighbour; or, where these are longer than the profiles of
        the neighbours asked for, the target's weights are looked up for each of their features. Without a common feature
        it is 0."""
        kind, width = self.blend[0], len(self.n_ids)
        sets = kind == "jac"
        tw, nw, ew = (np.broadcast_to(1.0, len(w)) if sets else w for w in (self.pt_w, self.pn_w, self.pe_w))
        sq_t = np.bincount(self.pt_e, tw * tw, len(self.t_ids))
        sq_n = np.bincount(self.pn_e, nw * nw, width)
        out = np.zeros(len(keys))
        at = np.flatnonzero(np.diff(keys // width, prepend=-1))
        for lo, hi in zip(at.tolist(), [*at[1:].tolist(), len(keys)], strict=True):
            e = base + int(keys[lo]) // width
            x, z = np.searchsorted(self.pt_e, [e, e + 1])
            n = keys[lo:hi] % width
            first, last = (np.searchsorted(self.pn_f, self.pt_f[x:z], side) for side in ("left", "right"))
            if (last - first).sum() > (self.pe_at[n + 1] - self.pe_at[n]).sum():
                d = self._looked_up(self.pt_f[x:z], tw[x:z], n, ew, limit)
            else:
                dots = np.zeros(width)
                y = 0
                while y < z - x:
                    upto = np.cumsum(last[y:] - first[y:])
                    end = y + max(1, int(np.searchsorted(upto, limit, "right")))  # one feature at least; its list is a part of the block
                    place, size = _ranges(first[y:end], last[y:end])
                    dots += np.bincount(self.pn_e[place], np.repeat(tw[x + y:x + end], size) * nw[place], width)
                    y = end
                d = dots[n]
            if kind == "dot":
                out[lo:hi] = d
            else:
                under = sq_t[e] + sq_n[n] - d if sets else np.sqrt(sq_t[e] * sq_n[n])
                out[lo:hi] = np.divide(d, under, out=np.zeros_like(d), where=(d != 0) & (under != 0))
        return out

    def _looked_up(self, features: np.ndarray, weights: np.ndarray, n: np.ndarray, ew: np.ndarray, limit: int) -> np.ndarray:
        """The dot product of a target's features with the profile of each neighbour ``n``, about ``limit`` features at a time."""
        place = np.minimum(np.searchsorted(self.features, features), max(0, len(self.features) - 1))
        known = self.features[place] == features if len(self.features) else np.zeros(len(features), bool)
        mine = np.bincount(place[known], weights[known], len(self.features)) if known.any() else np.zeros(len(self.features))
        d, at = np.zeros(len(n)), 0
        upto = np.cumsum(self.pe_at[n + 1] - self.pe_at[n])
        while at < len(n):
            end = at + max(1, int(np.searchsorted(upto[at:], limit + (upto[at - 1] if at else 0), "right")))
            some, size = _ranges(self.pe_at[n[at:end]], self.pe_at[n[at:end] + 1])
            d[at:end] = np.bincount(np.repeat(np.arange(end - at), size), mine[self.pe_f[some]] * ew[some], end - at)
            at = end
        return d

    def light_cells(self, a: int, z: int, limit: int, keys: np.ndarray, value: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Candidates (target row, neighbour row, fold's place, value) of the tested rows in contexts that are not heavy."""
        base, place = int(self.te[a]), np.searchsorted(self.folds, self.tf)
        tested = np.isin(self.tf, self.folds)
        for x, y in self.chunks(a, z, limit):
            ok = tested[x] & (self.nf[y] != self.tf[x]) & (self.t_ids[self.te[x]] != self.n_ids[self.ne[y]])
            x, y = x[ok], y[ok]
            at = np.searchsorted(keys, (self.te[x] - base) * len(self.n_ids) + self.ne[y])
            yield x, y, place[x], value[at, place[x]]

    def heavy_rows(self, a: int, z: int) -> list[int]:
        return (a + np.flatnonzero((self.hi[a:z] - self.lo[a:z] > self.heavy) & np.isin(self.tf[a:z], self.folds))).tolist()

    def best(self, a: int, z: int, limit: int, k: int, keys: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(target row, neighbour row, order) of the ``k`` best neighbours of each tested row; ties by the neighbour's id."""
        rows, nbrs, orders = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        value = -value if self.more else value
        for x, y, _, o in self.light_cells(a, z, limit, keys, value):
            by = np.lexsort((o, x))  # stable: equal ones stay in order of id
            x, y, o = x[by], y[by], o[by]
            new = np.concatenate([[True], x[1:] != x[:-1]])[:len(x)]
            nth = np.arange(len(x)) - np.maximum.accumulate(np.where(new, np.arange(len(x)), 0))
            rows.append(x[nth < k])
            nbrs.append(y[nth < k])
            orders.append(o[nth < k])
        base, width, lists = int(self.te[a]), len(self.n_ids), {}
        for r in self.heavy_rows(a, z):
            i, j = int(self.te[r]) - base, int(np.searchsorted(self.folds, self.tf[r]))
            if (i, j) not in lists:  # this target's neighbours in this fold, best first
                own = slice(*np.searchsorted(keys, [i * width, (i + 1) * width]))
                by = np.argsort(value[own, j], kind="stable")
                lists = {(i, j): ((keys[own] - i * width)[by], value[own, j][by])}
            ids, order = lists[i, j]
            lo, members = int(self.lo[r]), self.ne[self.lo[r]:self.hi[r]]
            found, at, step = 0, 0, 4 * k
            while at < len(ids) and found < k:
                some = ids[at:at + step]
                place = np.minimum(np.searchsorted(members, some), len(members) - 1)
                hit = np.flatnonzero((members[place] == some) & (self.nf[lo + place] != self.tf[r]) & (self.n_ids[some] != self.t_ids[self.te[r]]))[:k - found]
                rows.append(np.full(len(hit), r))
                nbrs.append(lo + place[hit])
                orders.append(order[at:at + step][hit])
                found, at, step = found + len(hit), at + step, 2 * step
        x, y, o = np.concatenate(rows), np.concatenate(nbrs), np.concatenate(orders)
        by = np.argsort(x, kind="stable")
        return x[by], y[by], o[by]

    def totals(self, a: int, z: int, limit: int, keys: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each row a to z: the sum of value times the neighbour's v over all its candidates, and their number."""
        total, count = np.zeros(z - a), np.zeros(z - a, np.int64)
        for x, y, _, o in self.light_cells(a, z, limit, keys, value):
            total += np.bincount(x - a, o * self.nv[y], z - a)
            count += np.bincount(x - a, minlength=z - a)
        base, width = int(self.te[a]), len(self.n_ids)
        for r in self.heavy_rows(a, z):
            y = np.arange(self.lo[r], self.hi[r])
            y = y[(self.nf[y] != self.tf[r]) & (self.n_ids[self.ne[y]] != self.t_ids[self.te[r]])]
            o = value[np.searchsorted(keys, (int(self.te[r]) - base) * width + self.ne[y]), np.searchsorted(self.folds, self.tf[r])]
            total[r - a], count[r - a] = (o * self.nv[y]).sum(), len(y)
        return total, count


def _blocks(folds: Sequence[int], measure: Measure | str, heavy: int, finish: Callable, blend: tuple[str, float] | None = None, leaky: bool = False) -> Callable:
    """``finish`` gets the pairs of blocks with the same targets, one after the other; their target rows are in the same order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, pairs in groupby(_groups(batches, True), lambda t: t.p):
            shared: dict = {}
            yield from finish(Block(t, folds, measure, heavy, blend, leaky, shared) for t in pairs)  # noqa: B023

    return run


class _Kept:
    """The ``k`` best neighbours of each target row so far, a range of target rows at a time: little more than these are held."""

    def __init__(self, rows: int, k: int):
        self.k, self.found, self.size = k, [[] for _ in range(0, max(rows, 1), KEPT_ROWS)], [0] * -(-max(rows, 1) // KEPT_ROWS)

    def add(self, x: np.ndarray, o: np.ndarray, nbr: np.ndarray, d: np.ndarray) -> None:
        """Rows x in ascending order."""
        if not len(x):
            return
        first, last, x = int(x[0]) // KEPT_ROWS, int(x[-1]) // KEPT_ROWS, x.astype(np.int32)
        cuts = np.searchsorted(x, np.arange(first, last + 2) * KEPT_ROWS)
        for r, lo, hi in zip(range(first, last + 1), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            self.found[r].append(tuple(c[lo:hi].copy() for c in (x, o, nbr, d)))
            self.size[r] += hi - lo
            if self.size[r] > self.k * KEPT_ROWS:
                self.best(r)

    def best(self, r: int) -> tuple[np.ndarray, ...]:
        """(row, order, neighbour, value) of the range, by row, best first."""
        none = (np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        self.found[r] = [_best(*[np.concatenate(c) for c in zip(none, *self.found[r], strict=True)], self.k)]
        self.size[r] = len(self.found[r][0][0])
        return self.found[r][0]


def _best(x: np.ndarray, o: np.ndarray, nbr: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    by = np.lexsort((nbr, o, x))
    x, o, nbr, d = x[by], o[by], nbr[by], d[by]
    first = np.concatenate([[True], x[1:] != x[:-1]])[:len(x)]
    ok = np.arange(len(x)) - np.maximum.accumulate(np.where(first, np.arange(len(x)), 0)) < k
    return x[ok], o[ok], nbr[ok], d[ok]


def best_neighbours(rows: DataFrame, entity: str, context: str, folds: Sequence[int], measure: Measure | str, k: int, payload: str = "deviation",
                    heavy: int = 512, limit: int = 400_000, profiles: Profiles | None = None, p: float = 0.5, **blocks) -> DataFrame:
    """For each row of ``rows`` in a fold of ``folds``: its own columns c, e, fold, v, b, cp and ``top``, the ``k`` best
    neighbours of its entity among the rows of its context outside its fold, best first, ties by ascending id, as
    (o, nbr, d): the order value in billionths (the negative similarity, or the distance), the neighbour's id, and its v
    ("value") or v less its mean in that fold ("deviation"). The measure is taken over the rows outside the fold; with
    ``profiles`` it counts 1 - p beside p times their similarity (SIM-11; not for a measure where less is better). What
    the blocks of neighbours give meets in the targets' task; at most 2 k neighbours of a row are held there."""
    if profiles is not None and not (MEASURES[measure] if isinstance(measure, str) else measure)[2]:
        raise ValueError(f"a distance ({measure}) can't be blended with a similarity of profiles")
    folds = sorted(int(f) for f in folds)
    kind = pa.struct([("o", pa.int64()), ("nbr", pa.int64()), ("d", pa.float64())])

    def finish(parts: Iterator[Block]) -> Iterator[pa.RecordBatch]:
        kept = None
        for block in parts:
            kept = kept or _Kept(len(block.te), k)
            for a, z in block.strips(limit):
                keys, sums = block.product(a, z, limit)
                x, y, o = block.best(a, z, limit, k, keys, block.values(keys, sums, int(block.te[a]), limit))
                d = block.nv[y]
                if payload == "deviation":
                    d = d - block.n_mean[block.ne[y], np.searchsorted(block.folds, block.tf[x])]
                kept.add(x, o, block.n_ids[block.ne[y]], d)
        for r in range(len(kept.found)):
            lo = r * KEPT_ROWS
            some = lo + np.flatnonzero(np.isin(block.tf[lo:lo + KEPT_ROWS], block.folds))
            if not len(some):
                continue
            x, o, nbr, d = kept.best(r)
            kept.found[r] = []
            ends = np.append(np.searchsorted(x, some), len(x)).astype(np.int32)
            top = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(v, from_pandas=True) for v in (o, nbr, d)], fields=list(kind)))
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (block.tc[some], block.t_ids[block.te[some]], block.tf[some])]
                                             + [pa.array(v[some], from_pandas=True) for v in (block.tv, block.b, block.cp)] + [top],
                                             ["c", "e", "fold", "v", "b", "cp", "top"])

    blocks = {"target_rows": 400_000 if len(folds) > 1 else 1_200_000} | blocks  # of a single fold a fifth or so has lists to keep
    dealt, _ = deal_blocks(rows, entity, context, folds, profiles=profiles, squeeze=True, train_only=True, **blocks)
    return dealt.mapInArrow(_blocks(folds, measure, heavy, finish, (profiles.kind, p) if profiles else None),
                            "c long, e long, fold int, v double, b double, cp double, top array<struct<o:bigint,nbr:bigint,d:double>>")


def neighbour_totals(rows: DataFrame, entity: str, context: str, folds: Sequence[int], measure: Measure | str, heavy: int = 512, limit: int = 400_000,
                     leaky: bool = False, target_rows: int = 1_500_000, **blocks) -> DataFrame:
    """For each row in a fold of ``folds``: c, e, fold, v, and over all neighbours of its entity among the rows of its context
    outside its fold ``total``, the sum of the measure (as a DECIMAL(18,9) has it) times the neighbour's v, and ``n``.
    ``leaky``: no fold leaves its own rows out."""
    folds = sorted(int(f) for f in folds)

    def finish(parts: Iterator[Block]) -> Iterator[pa.RecordBatch]:
        total = count = None
        for block in parts:
            if total is None:
                total, count = np.zeros(len(block.te)), np.zeros(len(block.te), np.int64)
            for a, z in block.strips(limit):
                keys, sums = block.product(a, z, limit)
                t, n = block.totals(a, z, limit, keys, block.values(keys, sums, int(block.te[a]), limit))
                total[a:z] += t
                count[a:z] += n
        own = np.flatnonzero(np.isin(block.tf, block.folds))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (block.tc[own], block.t_ids[block.te[own]], block.tf[own], block.tv[own], total[own] / NANO, count[own])],
                                         ["c", "e", "fold", "v", "total", "n"])

    dealt, _ = deal_blocks(rows, entity, context, folds, leaky=leaky, target_rows=target_rows, squeeze=True, train_only=True, **blocks)
    return dealt.mapInArrow(_blocks(folds, measure, heavy, finish, leaky=leaky), "c long, e long, fold int, v double, total double, n long")


MEASURES["gram"] = (("dot", "co", "asked"), None, True)


def gram_entries(rows: DataFrame, entity: str, context: str, folds: Sequence[int], heavy: int = 512, limit: int = 400_000,
                 target_rows: int = 1_500_000, **blocks) -> DataFrame:
    """Rows (fold, a, b, dot, co, n_a, n_b, sq_a, sq_b), a < b: the entries of each fold's train Gram matrix that its test
    rows ask for, that is of the pairs of which one occurs in a context's test rows and the other in its train rows."""
    folds = sorted(int(f) for f in folds)

    def emit(block: Block, keys: np.ndarray, sums: dict, first: int) -> pa.RecordBatch:
        width = max(1, len(block.n_ids))
        i, j = first + keys // width, keys % width
        pair, f = np.nonzero((sums["asked"] > 0) & (block.t_ids[i] < block.n_ids[j])[:, None])
        i, j, s, t = i[pair], j[pair], block.t_stats, block.n_stats
        columns = [block.folds[f], block.t_ids[i], block.n_ids[j], sums["dot"][pair, f], sums["co"][pair, f].astype(np.int64), s.n[i, f].astype(np.int64), t.n[j, f].astype(np.int64), s.q[i, f], t.q[j, f]]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["fold", "a", "b", "dot", "co", "n_a", "n_b", "sq_a", "sq_b"])

    def finish(parts: Iterator[Block]) -> Iterator[pa.RecordBatch]:
        for block in parts:
            for a, z in block.strips(limit):
                yield emit(block, *block.product(a, z, limit), int(block.te[a]))

    dealt, _ = deal_blocks(rows, entity, context, folds, target_rows=target_rows, squeeze=True, **blocks)
    return dealt.mapInArrow(_blocks(folds, "gram", heavy, finish), "fold int, a long, b long, dot double, co long, n_a long, n_b long, sq_a double, sq_b double")

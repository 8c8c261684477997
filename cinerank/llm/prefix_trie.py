"""Prefix trie of conversations: sorted prefixes, their common lengths, and range minima that give member intervals."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import materialize

KEY = 16  # bytes that stand for a turn
NONE = hashlib.sha256(b"").hexdigest()

#: kind, the node, its parent's smallest member, its counts; then what a node needs whose chunk doesn't know it wholly.
PARTS = [("kind", "tinyint"), ("conv_id", "long"), ("depth", "long"), ("parent", "long"), ("n_convs", "long"), ("n_children", "long"), ("n_leaves", "long"),
         ("sent", "long"), ("once", "long"), ("ends", "string"), ("chunk", "long"), ("side", "tinyint"), ("up_side", "tinyint"), ("id", "binary"), ("up", "binary"), ("piece", "long")]
ARROW = {"tinyint": pa.int8(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
WHOLE, SHARED, ENDS = 0, 1, 2  # kinds: a node known wholly; a chunk's part of a node; a piece of a shared node's list of ends


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths share from the root on."""
    lo, hi = 0, min(len(a), len(b)) // KEY
    if a[:hi * KEY] == b[:hi * KEY]:
        return hi
    while lo + 1 < hi:
        mid = (lo + hi) // 2
        if a[lo * KEY:mid * KEY] == b[lo * KEY:mid * KEY]:
            lo = mid
        else:
            hi = mid
    return lo


class RangeMin:
    """Sparse table: minima of all ranges of 2^k values, so any range's minimum takes two of them."""

    def __init__(self, x: np.ndarray):
        self.levels = [x]
        while len(self.levels[-1]) > (step := 1 << (len(self.levels) - 1)):
            self.levels.append(np.minimum(self.levels[-1][:-step], self.levels[-1][step:]))

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Of the values lo to hi, inclusive."""
        out = np.empty(len(lo), self.levels[0].dtype)
        k = np.frexp((hi - lo + 1).astype(float))[1] - 1
        for level in np.unique(k).tolist():
            own, x = k == level, self.levels[level]
            out[own] = np.minimum(x[lo[own]], x[hi[own] + 1 - (1 << level)])
        return out

    def extent(self, at: np.ndarray, bound: np.ndarray, right: bool) -> np.ndarray:
        """How many values next to each place hold at least its bound in one go: a binary search for each place."""
        n, far = len(self.levels[0]), np.zeros(len(at), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            begin = at + far + 1 if right else at - far - (1 << level)
            fits = (begin + (1 << level) <= n) & (begin >= 0)
            ok = fits.copy()
            ok[fits] = self.levels[level][begin[fits]] >= bound[fits]
            far[ok] += 1 << level
        return far


def chunk_nodes(chunk: int, ids: np.ndarray, paths: list[bytes], sizes: list[np.ndarray], before: bytes | None, after: bytes | None, piece: int = 1000) -> list[pa.RecordBatch]:
    """The nodes that ``paths`` (ascending, equal ones by id) have, as rows of PARTS.

    ``before`` and ``after`` are the paths next to the chunk. A node that reaches over to one of them is a part: its counts
    are those of this chunk, and a node or leaf that both chunks see is counted where it begins or ends."""
    m = len(paths)
    lens = np.array([len(p) // KEY for p in paths], np.int64)
    lcp = np.full(m + 1, -1, np.int64)  # of each row and the one before it, in the table
    lcp[1:m] = [common_turns(a, b) for a, b in zip(paths, paths[1:], strict=False)]
    inner = lcp.copy()  # the same within this chunk
    lcp[0] = -1 if before is None else common_turns(before, paths[0])
    lcp[m] = -1 if after is None else common_turns(paths[-1], after)
    sums = [np.concatenate([[0], np.cumsum(s)]) for s in sizes]  # code points of the first d turns
    total = np.array([s[-1] for s in sums], np.int64)

    # candidates: the prefix that each row shares with the one before it; its members by two searches in the table of minima
    at, table = np.arange(1, m), RangeMin(inner[1:m])
    left, right = table.extent(at - 1, inner[1:m], False), table.extent(at - 1, inner[1:m], True)
    low, high = at - 1 - left, at + right
    span, of_row = np.unique(low * m + high, return_inverse=True)
    at_row = np.concatenate([[-1], of_row, [-1]])  # the interval that a row and the one before it agree on
    lo, hi = np.concatenate([span // m, np.arange(m)]), np.concatenate([span % m, np.arange(m)])
    deep = np.concatenate([table.least(span // m, span % m - 1) if len(span) else np.empty(0, np.int64), lens])
    top = np.maximum(inner[lo], inner[hi + 1])  # depth of the interval around it
    forks = np.bincount(of_row, weights=lens[1:] > inner[1:m], minlength=len(lo)).astype(np.int64) if m > 1 else np.zeros(len(lo), np.int64)
    real = deep > top
    around = np.where(inner[lo] >= inner[hi + 1], at_row[lo], at_row[hi + 1])  # the interval around it, -1 at the root

    # a node for each depth that an interval has below the one around it
    iv = np.repeat(np.flatnonzero(real), (deep - top)[real])
    starts = np.concatenate([[0], np.cumsum((deep - top)[real])])[:-1]
    depth = np.arange(len(iv)) - np.repeat(starts, (deep - top)[real]) + np.repeat(top[real] + 1, (deep - top)[real])
    l, r, last = lo[iv], hi[iv], deep[iv] == depth  # noqa: E741
    n = r - l + 1
    smallest = RangeMin(ids).least(lo, hi)
    children = (lens[l] > depth) & (lcp[l] <= depth)
    children = children + np.where(last, forks[iv], 0)
    leaf = np.concatenate([[0], np.cumsum(lcp[1:] < lens)])
    offset = np.concatenate([[0], np.cumsum([len(s) for s in sums])])
    upto = np.concatenate(sums)  # code points before a depth, row by row
    sent = np.concatenate([[0], np.cumsum(total)])
    once = np.concatenate([[0], np.cumsum(total - upto[offset[:-1] + np.maximum(lcp[:m], 0)])])
    above = upto[offset[l] + np.maximum(depth - 1, 0)]
    sent_in = sent[r + 1] - sent[l] - n * above
    once_in = once[r + 1] - once[l + 1] + total[l] - upto[offset[l] + np.maximum(np.maximum(lcp[l], depth - 1), 0)]
    # members that end here come first: the rows from the first one on that are as long as it
    run_end = np.concatenate([np.flatnonzero(lens[1:] != lens[:-1]), [m - 1]])
    stop = np.where(last & (lens[l] == depth), np.minimum(run_end[np.searchsorted(run_end, l)], r) + 1, l)

    shared = ((l == 0) & (lcp[0] >= depth)) | ((r == m - 1) & (lcp[m] >= depth))
    side = np.where(l == 0, 0, 1)
    # a parent is the same interval one turn up, or the interval around it
    same = depth - 1 > top[iv]
    ul, ur = np.where(same, l, lo[around[iv]]), np.where(same, r, hi[around[iv]])
    wait = (depth > 0) & (((ul == 0) & (lcp[0] >= depth - 1)) | ((ur == m - 1) & (lcp[m] >= depth - 1)))
    known = (depth > 0) & ~wait
    parent = np.where(same, smallest[iv], smallest[around[iv]])
    names = [_prefix_ids(paths[p], int(depth[shared & (side == s)].max(initial=0))) for s, p in ((0, 0), (1, -1))]

    def listed(a: int, b: int) -> str:
        return ",".join(map(str, ids[a:b].tolist()))

    def column(x: np.ndarray, at: np.ndarray, there: np.ndarray | None = None) -> pa.Array:
        return pa.array(x[at], mask=None if there is None else ~there[at])

    def table_of(kind: int, size: int, **columns) -> pa.Table:
        return pa.table([(columns[c] if c in columns else pa.nulls(size)).cast(ARROW[t]) if c != "kind" else pa.array([kind] * size, pa.int8()) for c, t in PARTS], [c for c, _ in PARTS])

    counts = {"conv_id": smallest[iv], "depth": depth, "n_convs": n, "n_children": children, "n_leaves": leaf[r + 1] - leaf[l], "sent": sent_in, "once": once_in}
    w, z = np.flatnonzero(~shared), np.flatnonzero(shared)
    ends = [hashlib.sha256(listed(a, b).encode()).hexdigest() if b > a else None for a, b in zip(l[w].tolist(), stop[w].tolist(), strict=True)]
    chunks = np.full(len(iv), chunk)
    whole = table_of(WHOLE, len(w), **{c: column(x, w) for c, x in counts.items()}, parent=column(parent, w, known), ends=pa.array(ends, pa.string()),
                     chunk=column(chunks, w, wait), up_side=column(np.where(ul == 0, 0, 1), w, wait))
    own = [(names[s][d], names[s][d - 1] if d else None) for s, d in zip(side[z].tolist(), depth[z].tolist(), strict=True)]
    part = table_of(SHARED, len(z), **{c: column(x, z) for c, x in counts.items()}, chunk=column(chunks, z), side=column(side, z),
                    id=pa.array([x for x, _ in own], pa.binary()), up=pa.array([x for _, x in own], pa.binary()))
    cut = [(names[side[k]][depth[k]], j, listed(j, min(stop[k], j + piece))) for k in z.tolist() for j in range(l[k], stop[k], piece)]
    pieces = table_of(ENDS, len(cut), id=pa.array([x[0] for x in cut], pa.binary()), piece=pa.array([x[1] for x in cut], pa.int64()),
                      ends=pa.array([x[2] for x in cut], pa.string()), chunk=pa.array([chunk] * len(cut), pa.int64()))
    return pa.concat_tables([whole, part, pieces]).combine_chunks().to_batches()


def _prefix_ids(path: bytes, depth: int) -> list[bytes]:
    """Digests of the path's first 0 to ``depth`` turns."""
    h = hashlib.blake2b(digest_size=16)
    out = [h.digest()]
    for d in range(depth):
        h.update(path[d * KEY:(d + 1) * KEY])
        out.append(h.digest())
    return out


def trie_nodes(paths: DataFrame, chunk: int = 1 << 16, piece: int = 1000) -> DataFrame:
    """One row per node of the trie of ``paths`` (conv_id long, path: 16 bytes a turn, sizes: an int a turn).

    The paths are sorted over the whole cluster, equal ones by id, so a prefix that very many share is dealt over as many
    tasks as it needs. A task holds ``chunk`` paths at a time and knows the path before and after them. There each prefix
    that two neighbours share looks left and right, by binary search in a table of range minima of the common lengths, for
    the members it has; all counts of its subtree are differences of running sums over the sorted rows. Nodes that reach
    over the edge of a chunk are parts, at most a path's length for each edge; their counts add up. Only the list of the
    members that end at such a node is hashed by one task, in pieces of ``piece`` ids that it reads in order and does not
    keep, as SHA-256 has no parts that add up. One conversation is one record, as a text is, at 16 bytes a turn."""
    s = paths.select("conv_id", "path", "sizes").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").checkpoint()
    edges = s.select("path").mapInArrow(_edges, "part int, first binary, last binary").collect()  # two paths per partition
    first = {r.part: bytes(r["first"]) for r in edges}
    last = {r.part: bytes(r["last"]) for r in edges}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = _partition(), 0
        before = next((last[p] for p in sorted(last, reverse=True) if p < part), None)
        ids: list[int] = []
        rows: list[bytes] = []
        sizes: list[np.ndarray] = []

        def flush(n: int, after: bytes | None) -> list[pa.RecordBatch]:
            nonlocal k, before
            out = chunk_nodes((part << 32) + k, np.array(ids[:n], np.int64), rows[:n], sizes[:n], before, after, piece)
            k, before = k + 1, rows[n - 1]
            del ids[:n], rows[:n], sizes[:n]
            return out

        for b in batches:
            ids += b.column(0).to_pylist()
            rows += b.column(1).to_pylist()
            sizes += [x.values.to_numpy() for x in b.column(2)]
            while len(rows) > chunk:
                yield from flush(chunk, rows[chunk])
        if rows:
            yield from flush(len(rows), next((first[p] for p in sorted(first) if p > part), None))

    parts = materialize(s.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in PARTS)), "trie_parts")
    shared = parts.where(F.col("kind") == SHARED)
    adds = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "sent", "once")]
    nodes = shared.groupBy("id").agg(F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("up").alias("up"), *adds)
    lists = parts.where(F.col("kind") == ENDS).select("id", "chunk", "piece", "ends")
    lists = lists.repartition("id").sortWithinPartitions("id", "chunk", "piece").mapInArrow(_hash_lists, "id binary, ends string")
    nodes = materialize(nodes.join(lists, "id", "left"), "trie_shared")
    name = nodes.select(F.col("id").alias("up"), F.col("conv_id").alias("parent"))
    out = ["conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", (F.col("sent") - F.col("once")).alias("saved_tokens"),
           F.coalesce("ends", F.lit(NONE)).alias("ends_sha256")]
    whole = parts.where(F.col("kind") == WHOLE)
    # the parent of a node that one chunk knows wholly may be a shared one: found by its place in that chunk
    place = shared.select("id", "chunk", F.col("side").alias("up_side"), (F.col("depth") + 1).alias("depth")).join(nodes.select("id", F.col("conv_id").alias("parent")), "id").drop("id")
    waiting = whole.where("chunk is not null").drop("parent").join(place, ["chunk", "up_side", "depth"])
    return whole.where("chunk is null").select(*out).unionByName(waiting.select(*out)).unionByName(nodes.join(name, "up", "left").select(*out))


def _partition() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: list[bytes] = []
    for b in batches:
        if b.num_rows:
            found = [found[0] if found else b.column(0)[0].as_py(), b.column(0)[b.num_rows - 1].as_py()]
    if found:
        yield pa.RecordBatch.from_arrays([pa.array([_partition()], pa.int32()), *(pa.array([x], pa.binary()) for x in found)], ["part", "first", "last"])


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, h = None, hashlib.sha256()
    for b in batches:
        done: list[tuple[bytes, str]] = []
        for key, text in zip(b.column(0).to_pylist(), b.column(3).to_pylist(), strict=True):
            if key == now:
                h.update(b"," + text.encode())
            else:
                if now is not None:
                    done.append((now, h.hexdigest()))
                now, h = key, hashlib.sha256(text.encode())
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.binary()), pa.array([x for _, x in done], pa.string())], ["id", "ends"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([h.hexdigest()], pa.string())], ["id", "ends"])


def turn_lists(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turns array<struct<key binary, n int>>): a digest of each turn's role and text, in order of turn.

    Null role or text is empty, a null turn comes first, equal turns of a conversation come in order of their digests (so a
    repeated row is a turn of its own). Rows without a conv_id belong to no conversation. Other columns are not read."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    key = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    t = conversations.where("conv_id is not null").select("conv_id", F.struct("turn", key.alias("key"), F.length(text).alias("n")).alias("t"))
    lists = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return lists.select("conv_id", F.expr("transform(ts, t -> struct(t.key, t.n))").alias("turns"))


def as_paths(lists: DataFrame) -> DataFrame:
    """Rows (conv_id, turns) as paths for ``trie_nodes``."""
    return lists.select("conv_id", F.unhex(F.array_join(F.expr("transform(turns, t -> hex(t.key))"), "")).alias("path"), F.expr("transform(turns, t -> t.n)").alias("sizes"))


def prefix_trie(conversations: DataFrame, chunk: int = 1 << 16, piece: int = 1000) -> DataFrame:
    """The trie of whole conversations (conv_id, turn, role, text): a row per distinct sequence of first turns.

    An empty table has no nodes."""
    return trie_nodes(materialize(as_paths(turn_lists(conversations)), "trie_paths"), chunk, piece)


def rebuilt(lists: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Rows (conv_id, turns): the first h turns of conversation c - c % ``every``, then c's own after its first h, with
    h = crc32(c) % ``most``. A missing or short one gives what it has."""
    base = lists.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    d = lists.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % every).join(base, "base", "left")
    head = F.when(F.col("head").isNull(), F.expr("slice(turns, 1, 0)")).otherwise(F.expr("slice(head, 1, h)"))
    return d.select("conv_id", F.concat(head, F.expr("slice(turns, h + 1, size(turns))")).alias("turns"))


def trie_digest(conversations: DataFrame, chunk: int = 1 << 16, piece: int = 1000) -> DataFrame:
    """The nodes of the rebuilt conversations."""
    lists = materialize(turn_lists(conversations), "trie_turns")
    return trie_nodes(materialize(as_paths(rebuilt(lists)), "trie_paths"), chunk, piece)


#: The crc32 is written out: DuckDB has none.
SQL = """
with recursive own as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first) - 1 as pos,
    md5(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as k, length(coalesce(text, '')) as n
  from conversations where conv_id is not null),
convs as (
  select conv_id, conv_id - conv_id % 100 as base, xor(list_reduce(
    list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 6 as h
  from (select distinct conv_id from own)),
turns as (
  select c.conv_id, 0 as part, o.pos, o.k, o.n from convs c join own o on o.conv_id = c.base and o.pos < c.h
  union all
  select c.conv_id, 1, o.pos, o.k, o.n from convs c join own o on o.conv_id = c.conv_id and o.pos >= c.h),
numbered as (select conv_id, k, n, row_number() over (partition by conv_id order by part, pos) as d from turns),
prefixes as (
  select conv_id, 0 as d, '' as path, 0 as n, '' as up from convs
  union all
  select p.conv_id, p.d + 1, md5(p.path || t.k), t.n, p.path from prefixes p join numbered t on t.conv_id = p.conv_id and t.d = p.d + 1),
lens as (select conv_id, max(d) as len from prefixes group by conv_id),
nodes as (
  select d, path, any_value(up) as up, any_value(n) as n, count(*) as n_convs, min(conv_id) as first_id,
    coalesce(string_agg(p.conv_id::varchar, ',' order by p.conv_id) filter (where l.len = p.d), '') as ends
  from prefixes p join lens l using (conv_id) group by d, path),
kids as (select up as path, d - 1 as d, count(*) as n_children from nodes where d > 0 group by all),
full_nodes as (select a.*, coalesce(k.n_children, 0) as n_children from nodes a left join kids k using (path, d)),
below as (
  select p.path, p.d, sum(case when x.n_children = 0 then 1 else 0 end) as n_leaves, sum((x.n_convs - 1) * x.n) as saved
  from full_nodes x join prefixes p on p.conv_id = x.first_id and p.d <= x.d group by all)
select a.first_id::bigint as conv_id, a.d::bigint as depth, u.first_id::bigint as parent_conv_id, a.n_convs::bigint as n_convs, a.n_children::bigint as n_children,
  b.n_leaves::bigint as n_leaves, b.saved::bigint as saved_tokens, sha256(a.ends) as ends_sha256
from full_nodes a join below b using (path, d) left join full_nodes u on a.d > 0 and u.path = a.up and u.d = a.d - 1
"""

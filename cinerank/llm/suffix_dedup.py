"""Removal of long repeated byte strings with suffix arrays built by linear grouping."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator, Sequence
from itertools import pairwise
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import deal, groups, hash128, materialize

BUFFER_BITS = 20  # bytes of text that are hashed at once: 1 MB
RANDOM = np.random.default_rng(23)
BYTE_VALUE = RANDOM.integers(1, 1 << 62, size=256, dtype=np.int64).astype(np.uint64)
BASE = 0x9E3779B97F4A7C15
_POWERS: dict = {}


def suffix_array(s: Sequence[int]) -> Sequence[int]:
    """Suffix array of ``s``, whose last symbol is its only smallest one; linear grouping, no recursion.

    First phase: suffixes start in groups by symbol. Groups are processed from the highest down. The previous
    smaller position of a member is the nearest one to its left in a group still to come; such positions have the
    processed group's Lyndon word right behind their own prefix, so they leave their group for a new one just above
    it, those that are followed by it more often going higher. In the end suffixes share a group if and only if they
    share their Lyndon prefix. Second phase: from the smallest suffix up, the position before a placed suffix, and
    its previous smaller ones after it, take the next free place of their groups."""
    n = len(s)
    members: list[set[int]] = []
    for c in sorted(set(s)):
        members.append(set())
    number = {c: g for g, c in enumerate(sorted(set(s)))}
    group = array("q", (number[c] for c in s))  # arrays: a third of a list's memory
    for i, g in enumerate(group):
        members[g].add(i)
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members))) + [-1]
    nearest = array("q", range(n + 1))  # by position + 1; 0 is no position. Processed positions point to their left
    previous = array("q", [-1]) * n
    g = len(members) - 1
    while g >= 0:
        now = members[g]
        for i in now:
            nearest[i + 1] = i
        followed: dict[int, int] = {}
        for i in now:
            p = i
            while nearest[p] != p:
                p = nearest[p]
            q = i
            while nearest[q] != q:  # shorten the path for later searches
                nearest[q], q = p, nearest[q]
            previous[i] = p - 1
            if p:
                followed[p - 1] = followed.get(p - 1, 0) + 1
        times: dict[int, dict[int, list[int]]] = {}
        for j, k in followed.items():
            times.setdefault(k, {}).setdefault(group[j], []).append(j)
        for k in sorted(times, reverse=True):
            for h, js in times[k].items():
                if len(js) == len(members[h]):
                    continue
                new = len(members)
                members[h].difference_update(js)
                members.append(set(js))
                for j in js:
                    group[j] = new
                above.append(above[h])
                below.append(h)
                if above[h] >= 0:
                    below[above[h]] = new
                above[h] = new
        g = below[g]
    first = 0
    while below[first] >= 0:
        first = below[first]
    free, at, h = [0] * len(members), 0, first
    while h >= 0:
        free[h] = at
        at += len(members[h])
        h = above[h]
    out, placed = array("q", [-1]) * n, bytearray(n)
    out[0], placed[n - 1] = n - 1, 1
    for r in range(n):
        j = out[r] - 1
        while j >= 0 and not placed[j]:
            placed[j] = 1
            h = group[j]
            out[free[h]] = j
            free[h] += 1
            j = previous[j]
    return out


def common_prefixes(s: Sequence[int], sa: Sequence[int]) -> Sequence[int]:
    """Symbols that each suffix in ``sa`` shares with the one before it."""
    n, rank, out, k = len(s), array("q", [0]) * len(s), array("q", [0]) * len(s), 0
    for r, i in enumerate(sa):
        rank[i] = r
    for i in range(n):
        if rank[i]:
            j = sa[rank[i] - 1]
            while i + k < n and j + k < n and s[i + k] == s[j + k]:
                k += 1
            out[rank[i]] = k
            k -= k > 0
        else:
            k = 0
    return out


def repeated_starts(windows: list[tuple[bytes, bytes]], core: int, length: int) -> list[list[tuple[int, int]]]:
    """For windows (left, right) around one core of ``core`` bytes: the ranges of d, ascending and
    inclusive, for which the ``length`` bytes from d bytes before the core on also occur in another window, as far
    from its core.

    The windows are written in symbols: the core is one, and each side is its path in the tree of that side's
    strings, so a symbol is a stretch that two windows share wholly or not at all. The suffix array of all windows then
    gives the most bytes that each stretch has in common with any other window."""
    lefts, right_paths = _paths([w[0][::-1] for w in windows]), _paths([w[1] for w in windows])
    m = len(windows)
    text, size = array("q"), array("q")
    window, before = array("q"), array("q")  # of each symbol: its window, and the bytes from its start to the core's start
    for r in range(m):
        for node, a, b in reversed(lefts[r]):
            text.append(m + 1 + 2 * node)
            size.append(b - a)
            window.append(r)
            before.append(b)
        text.append(m)
        size.append(core)
        window.append(r)
        before.append(0)
        for node, a, b in right_paths[r]:
            text.append(m + 2 + 2 * node)
            size.append(b - a)
            window.append(r)
            before.append(-core - a)
        text.append(m - 1 - r)
        size.append(0)
        window.append(r)
        before.append(-length)
    sa = suffix_array(text)
    shared = common_prefixes(text, sa)
    ends = array("q", [0])
    for k in size:
        ends.append(ends[-1] + k)
    out: list[list[tuple[int, int]]] = [[] for _ in windows]
    for r, i in enumerate(sa):
        k = max(shared[r], shared[r + 1] if r + 1 < len(sa) else 0)
        w, d = window[i], before[i]
        if k and d >= 0:
            most = ends[i + k] - ends[i]
            low = d - size[i] + 1 if d else 0  # a core symbol has the one start d = 0; a left one those down to its end
            low = max(low, length - (most - d))  # starts further in have as many bytes less
            if low <= d:
                out[w].append((low, d))
    return [sorted(x) for x in out]


def _paths(sides: list[bytes]) -> list[list[tuple[int, int, int]]]:
    """For each string the edges (node, from, to) that it shares with another one, from the root of their tree on."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    depth, parent, at = [0], [0], [0] * len(sides)  # of nodes; at: the deepest node on a string's path
    stack = [0]
    for a, b in pairwise(order):
        k, last = len(commonprefix([sides[a], sides[b]])), -1
        while depth[stack[-1]] > k:
            last = stack.pop()
            if depth[stack[-1]] >= k:
                parent[last] = stack[-1]
        if depth[stack[-1]] < k:
            depth.append(k)
            parent.append(stack[-1])
            stack.append(len(depth) - 1)
            if last >= 0:
                parent[last] = stack[-1]
        if depth[stack[-1]] > depth[at[a]]:
            at[a] = stack[-1]
        at[b] = stack[-1]
    out: list[list[tuple[int, int, int]]] = []
    for r in range(len(sides)):
        path, n = [], at[r]
        while n:
            path.append((n, depth[parent[n]], depth[n]))
            n = parent[n]
        out.append(path[::-1])
    return out


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        n = (1 << BUFFER_BITS) + 1
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["up"], _POWERS["down"]


def anchors(data: np.ndarray, ends: np.ndarray, length: int, width: int) -> tuple[np.ndarray, ...]:
    """Anchors of the texts that ``data`` joins (text k ends at ends[k]): arrays hash, position, first and last start.

    A start's anchor is the position of the least hashed (length + 1 - width)-gram among the ``width`` grams that begin
    at it and after it; the leftmost of equals. It depends on the ``length`` bytes from the start alone, so equal
    strings have their anchors at the same place."""
    core = length + 1 - width
    n = len(data)
    up, down = _powers()
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * up[:n], out=total[1:])
    h = (total[core:] - total[:-core]) * down[:n - core + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    mask = np.uint64((1 << BUFFER_BITS) - 1)
    low = (h & ~mask) | np.arange(len(h), dtype=np.uint64)
    step = 1
    while 2 * step <= width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < width:
        low = np.minimum(low[:len(low) - (width - step)], low[width - step:])
    at = (low & mask).astype(np.int64)
    begins = np.concatenate([[0], ends[:-1]])
    ok = np.zeros(len(at) + 1, np.int64)
    long = ends - begins >= length
    np.add.at(ok, begins[long], 1)
    np.add.at(ok, ends[long] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(ok)[:-1])
    a = at[starts]
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1])]))
    first, last = starts[new], starts[np.concatenate([new[1:], [len(starts)]]) - 1]
    return h[a[new]].view(np.int64), a[new], first, last


def _anchor_rows(length: int, width: int):
    limit = (1 << BUFFER_BITS) - 1

    def flush(chunks: list, keys) -> Iterator[pa.RecordBatch]:
        if not chunks:
            return
        data = np.frombuffer(b"".join(c for _, _, c in chunks), np.uint8)
        ends = np.cumsum([len(c) for _, _, c in chunks])
        h, p, first, last = anchors(data, ends, length, width)
        k = np.searchsorted(ends, first, side="right")
        begin = np.concatenate([[0], ends[:-1]])[k]
        offset = np.array([o for _, o, _ in chunks])[k]
        packed = ((p - begin + offset) << 20) | ((p - first) << 10) | (p - last)
        rows = np.array([r for r, _, _ in chunks])[k]
        yield pa.RecordBatch.from_arrays([pa.array(h), keys.take(pa.array(rows)), pa.array(packed)], ["h", "t", "pos"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            chunks, held = [], 0
            for r, x in enumerate(b.column(1)):
                data = x.as_py()
                for o in range(0, max(len(data) - length + 1, 1), limit - length):  # each start lies in one chunk
                    part = data[o:o + limit - 1]
                    if held + len(part) > limit:
                        yield from flush(chunks, b.column(0))
                        chunks, held = [], 0
                    chunks.append((r, o, part))
                    held += len(part)
            yield from flush(chunks, b.column(0))

    return run


def _cut(length: int, width: int):
    """Rows (t, text, list of packed anchors) to windows: core digest, window digest, place, far, near, left, right."""
    core = length + 1 - width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for b in batches:
            rows: list[tuple] = []
            for t, text, pos in zip(b.column(0), b.column(1), b.column(2), strict=True):
                t = t.as_py()
                if t == before:  # a copy of the text before it
                    continue
                before, data = t, text.as_py()
                for p, ends in _places(pos.as_py()).items():
                    left, right = data[max(0, p - width + 1):p], data[p + core:p + length]
                    middle = hashlib.blake2b(data[p:p + core], digest_size=16).digest()
                    whole = hashlib.blake2b(b"%d " % len(left) + left + middle + right, digest_size=16).digest()
                    rows.append((middle, whole, t, p, *ends, left, right))
                    if len(rows) >= 8192:
                        yield _batch(rows, WINDOW)
                        rows = []
            yield _batch(rows, WINDOW)

    return run


WINDOW = pa.schema([("core", pa.binary()), ("win", pa.binary()), ("t", pa.binary()), ("p", pa.int64()), ("far", pa.int32()), ("near", pa.int32()),
                    ("left", pa.binary()), ("right", pa.binary())])
RANGE = pa.schema([("win", pa.binary()), ("lo", pa.int32()), ("hi", pa.int32())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _places(packed: list[int]) -> dict[int, tuple[int, int]]:
    """Position -> (far, near): how far before it its first and last start lie. An anchor may come from two buffers, with
    a part of its starts each, and from each copy of the text."""
    out: dict[int, tuple[int, int]] = {}
    for x in packed:
        far, near = out.get(x >> 20, (0, 1023))
        out[x >> 20] = max(far, (x >> 10) & 1023), min(near, x & 1023)
    return out


def _find(length: int, width: int):
    """Distinct windows, sorted by group, to rows (win, lo, hi): starts lo to hi bytes before the core also occur in another window."""
    core = length + 1 - width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[bytes, int, int]] = []
        for g in groups(batches, ["g0", "g1"]):
            win, left, right, low, high = (g.column(c).to_pylist() for c in ("win", "left", "right", "low", "high"))
            for w, a, b, found in zip(win, low, high, repeated_starts(list(zip(left, right, strict=True)), core, length), strict=True):
                out.extend((w, max(lo, a), min(hi, b)) for lo, hi in found if lo <= b and hi >= a)
            if len(out) >= 8192:
                yield _batch(out, RANGE)
                out = []
        yield _batch(out, RANGE)

    return run


def _each_start(length: int, width: int):
    """Distinct windows of a very frequent core to one row (digest of the string, win, d) for each start d bytes before it."""
    core = length + 1 - width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c, w, left, right, low, high in zip(*(b.column(n).to_pylist() for n in ("core", "win", "left", "right", "low", "high")), strict=True):
                d = range(max(low, length - core - len(right)), min(high, len(left)) + 1)
                key = [hashlib.blake2b(left[len(left) - k:] + b"\0" + c + right[:length - core - k], digest_size=16).digest() for k in d]
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.binary()), pa.array([w] * len(key), pa.binary()), pa.array(d, pa.int32())], ["key", "win", "d"])

    return run


def repeated_ranges(texts: DataFrame, length: int = 400, width: int = 200, block: int = 8192) -> DataFrame:
    """Rows (t, ranges) of ``texts`` (t: 16-byte key of the content, data binary): every start of a ``length``-byte string
    that also starts elsewhere in another text or at another place of the same one, as inclusive ranges a to b. Copies of
    a text are one text here.

    1. Each text's anchors (about two per ``width`` bytes) are found where it is read; only their hashes are counted.
    2. Each distinct text meets those of its anchors whose hash occurs at another place and cuts a window around each. Equal
       windows become one, combined map-side; all starts of a window that occurs at two places are repeated.
    3. The different windows around one core meet in one group, a suffix array of which tells the starts that they share.
       Groups are independent and small. The windows of a core that has more than ``block`` are dealt out by the bytes
       next to the core, once for the starts that hold the bytes before it and once for the others; where even such a
       group has more than ``block``, a digest of each start is counted instead, which needs no group at all. All
       three are exact.
    4. The starts found in a window become disjoint ranges before they meet the places of that window, and are cut to
       the starts that belong to each place in its row, so nothing is made per start."""
    if not (2 <= width <= min(1000, length)):
        raise ValueError("width must lie between 2 and length, and be 1000 at most")
    found = materialize(texts.select("t", "data").mapInArrow(_anchor_rows(length, width), "h long, t binary, pos long"), "anchors")
    place = F.xxhash64("t", F.shiftright("pos", 20))
    again = found.groupBy("h").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo < hi").select("h")
    # a set, not a list: a text's copies have the same anchors, and are combined map-side
    hits = found.join(again, "h").groupBy("t").agg(F.collect_set("pos").alias("pos"))
    windows = texts.join(hits.hint("merge"), "t").select("t", "data", "pos").mapInArrow(
        _cut(length, width), "core binary, win binary, t binary, p long, far int, near int, left binary, right binary")
    windows = materialize(windows, "windows")
    spot = F.xxhash64("t", "p")
    kinds = windows.groupBy("core", "win").agg(F.min(spot).alias("s0"), F.max(spot).alias("s1"), F.first("left").alias("left"), F.first("right").alias("right"))
    kinds = materialize(kinds, "window_kinds")
    size = kinds.groupBy("core").agg(F.count("*").alias("n")).where("n > 1")
    several = kinds.select("core", "win", "left", "right").join(size, "core")
    g0, g1 = hash128("core")
    plain = several.where(F.col("n") <= block).select("core", "win", "left", "right", g0.alias("g0"), g1.alias("g1"), F.lit(0).alias("low"), F.lit(width).alias("high"))
    # a string that starts at least ``part`` bytes before the core holds those bytes; any other holds most of the right side
    part = min(24, width // 2)
    near = F.expr(f"right(hex(left), {2 * part})")
    sides = F.array(F.struct(F.lit(part).alias("low"), F.lit(width).alias("high"), near.alias("key"), (F.octet_length("left") >= part).alias("ok")),
                    F.struct(F.lit(0).alias("low"), F.lit(part - 1).alias("high"), F.hex(F.substring("right", 1, width - part)).alias("key"), (F.octet_length("right") >= width - part).alias("ok")))
    cut = several.where(F.col("n") > block).select("core", "win", "left", "right", F.explode(sides).alias("s")).where("s.ok")
    h0, h1 = hash128("core", "s.low", "s.key")
    cut = materialize(cut.select("core", "win", "left", "right", h0.alias("g0"), h1.alias("g1"), "s.low", "s.high"), "window_sides")
    again_size = cut.groupBy("g0", "g1").agg(F.count("*").alias("n")).where("n > 1")
    cut = cut.join(again_size, ["g0", "g1"])
    small = plain.unionByName(cut.where(F.col("n") <= block).drop("n"))
    few = deal(small, "g0", "g1").mapInArrow(_find(length, width), "win binary, lo int, hi int")
    starts = cut.where(F.col("n") > block).select("core", "win", "left", "right", "low", "high").mapInArrow(_each_start(length, width), "key binary, win binary, d int")
    twice = starts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    many = starts.join(twice, "key").select("win", F.col("d").alias("lo"), F.col("d").alias("hi"))
    whole = kinds.where("s0 < s1").select("win", F.lit(0).alias("lo"), F.lit(width).alias("hi"))
    spans = whole.unionByName(few).unionByName(many).groupBy("win").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")).select("win", _disjoint("spans").alias("spans"))
    hit = windows.select("win", "t", "p", "far", "near").join(spans, "win")
    ranges = F.expr("transform(filter(spans, s -> s.lo <= far and s.hi >= near), s -> struct(p - least(s.hi, far) as a, p - greatest(s.lo, near) as b))")
    return hit.select("t", ranges.alias("ranges")).where(F.size("ranges") > 0)


def _disjoint(spans: str):
    """Inclusive ranges of an array, merged where they meet, in ascending order."""
    return F.expr(f"""aggregate(array_sort({spans}), cast(array() as array<struct<lo:int,hi:int>>), (acc, s) ->
        case when size(acc) > 0 and s.lo <= get(acc, size(acc) - 1).hi + 1
             then concat(slice(acc, 1, size(acc) - 1), array(struct(get(acc, size(acc) - 1).lo as lo, greatest(get(acc, size(acc) - 1).hi, s.hi) as hi)))
             else concat(acc, array(s)) end)""")


def _remove(length: int, keep: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, kept = [], []
            for data, copied, marks in zip(b.column(0), b.column(1), b.column(2), strict=True):
                data = data.as_py()
                found = [(0, len(data) - length)] if copied.as_py() else [(x["a"], x["b"]) for r in marks.as_py() or () for x in r]
                cover: list[tuple[int, int]] = []
                for x, y in sorted(found):
                    if cover and x <= cover[-1][1]:
                        cover[-1] = (cover[-1][0], max(cover[-1][1], y + length))
                    else:
                        cover.append((x, y + length))
                spans.append([{"from": x, "to": y} for x, y in cover])
                edge = [0, *(v for m in cover for v in m), len(data)]
                kept.append(b"".join(data[edge[i]:edge[i + 1]] for i in range(0, len(edge), 2)))
            kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*b.columns[3:], pa.array(spans, kind), pa.array(kept, pa.binary())], [*keep, "spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, length: int = 400, width: int = 200, block: int = 8192, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, plus data (the input bytes), spans (array of from/to of the removed runs) and kept (bytes).

    Every byte covered by a ``length``-byte string that also starts anywhere else is removed, judged on the input. Null
    text is empty. Texts shorter than ``length`` lose nothing. Repeated rows are copies of each other and lose all their
    bytes from ``length`` on, whatever their ids; null ids don't matter."""
    keep = [f for f in docs.schema.fields if f.name not in (text_col, "data", "spans", "kept")]
    d = docs.withColumn("_data", F.coalesce(F.col(text_col), F.lit("")).cast("binary")).withColumn("_t", F.unhex(F.md5("_data")))
    texts = d.where(F.octet_length("_data") >= length).select(F.col("_t").alias("t"), F.col("_data").alias("data"))
    marks = repeated_ranges(texts, length, width, block).groupBy("t").agg(F.collect_list("ranges").alias("_marks"))
    copies = texts.groupBy("t").agg(F.count("*").alias("n")).where("n > 1").select("t", F.lit(True).alias("_copied"))
    both = marks.join(copies, "t", "full").withColumnRenamed("t", "_t")
    names = [f.name for f in keep]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + ["data binary", "spans array<struct<from:bigint,to:bigint>>", "kept binary"])
    return d.join(both, "_t", "left").select("_data", "_copied", "_marks", *[f"`{n}`" for n in names], F.col("_data").alias("data")).mapInArrow(
        _remove(length, [*names, "data"]), schema)


def suffix_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, SHA-256 of the kept bytes."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["to"] - x["from"])
    return remove_repeats(docs.select("doc_id", "text")).select(
        "doc_id", F.octet_length("data").cast("long").alias("n_bytes"), removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

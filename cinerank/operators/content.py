"""Content-based recommender (JOB-9..JOB-12, SIM-8, SIM-9, AGG-20/21,
JOI-10/12/13, WIN-7, SRT-1, SET-2/3, FLT-4, PRJ-3).

Item profiles are long-format triples (row id, feature idx, weight). Scoring a
test cell looks up the user's weight of its item's features, so work grows with
the item's feature count only. For all folds at once a rating travels with its
item's features packed into some bytes, and a user's profile is one row of arrays:
no (rating, feature) row is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinerank.functions.scalar import rescale, trimmed_split
from cinerank.operators.block_product import Profiles
from cinerank.operators.ranking import global_rank
from cinerank.operators.similarity import pair_stats

U, I = "user_id", "item_id"

# Fixed order of the feature kinds in the vocabulary index.
KINDS = ["year", "director", "actor", "genre", "tag"]


def feature_values(movies: DataFrame, people: DataFrame, item_tags: DataFrame) -> DataFrame:
    """SET-2 / PRJ-8: (item_id, kind, value) for every kind, set semantics."""
    year = movies.select(I, F.lit("year").alias("kind"), F.col("year").alias("value"))
    ppl = people.select(I, F.col("kind"), F.trim("person").alias("value"))
    genre = movies.select(I, F.lit("genre").alias("kind"),
                          F.explode(trimmed_split("genres", "\\|")).alias("value"))
    tag = item_tags.select(I, F.lit("tag").alias("kind"), F.col("tag").alias("value"))
    return year.unionByName(ppl).unionByName(genre).unionByName(tag).where(F.length("value") > 0).distinct()


def vocabulary(features: DataFrame, tagged_items: DataFrame) -> DataFrame:
    """JOB-9 vocab / SRT-1 / SET-3 / WIN-7: (kind, value, idx), idx from 1 over
    (kind order, value). Year, director and actor values come from tagged
    items only; genres from the whole catalogue; tags from the folksonomy.
    The same value under two kinds keeps two indices."""
    restricted = features.where(F.col("kind").isin("year", "director", "actor")) \
        .join(tagged_items.select(I).distinct(), I, "left_semi")
    rest = features.where(F.col("kind").isin("genre", "tag"))
    distinct = restricted.unionByName(rest).select("kind", "value").distinct()
    kind_rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    distinct = distinct.withColumn("kind_rank", kind_rank)
    return global_rank(distinct, ["kind_rank", "value"], "idx", start=1).drop("kind_rank")


def item_profiles(features: DataFrame, vocab: DataFrame):
    """JOB-9 / FLT-4: one-hot item profiles (item_id, idx, weight=1.0) plus the
    rejected (item_id, kind, value) rows whose value is not in the vocabulary."""
    prof = (features.join(vocab, ["kind", "value"])
            .select(I, "idx", F.lit(1.0).alias("weight")).distinct())
    rejects = features.join(vocab, ["kind", "value"], "left_anti")
    return prof, rejects


def user_profiles(ratings: DataFrame, profiles: DataFrame, variant: str = "B",
                  part: Sequence[str] = ()) -> DataFrame:
    """JOB-10 / JOI-12: (part, user_id, idx, weight).

    A (AGG-20): sum of the user's scores over rated items with the feature,
      divided by the number of items the user rated;
    B (AGG-21): mean score over the rated items having the feature."""
    part = list(part)
    keys = [*part, U]
    whole = ("tinyint", "smallint", "int", "bigint")
    if profiles.schema["idx"].dataType.simpleString() not in whole or ratings.schema["score"].dataType.simpleString() not in (*whole, "float", "double"):
        return _user_profiles_by_join(ratings, profiles, variant, part)
    # a row without a key, and features without a number, are few or none
    odd = F.lit(False)
    for c in keys:
        odd = odd | F.col(c).isNull()
    out = _user_profiles_packed(ratings.where(~odd), profiles.where(F.col("idx").isNotNull()), variant, keys)
    out = out.unionByName(_user_profiles_by_join(ratings.where(~odd), profiles.where(F.col("idx").isNull()), variant, part))
    return out.unionByName(_user_profiles_by_join(ratings.where(odd), profiles, variant, part))


def _user_profiles_by_join(ratings: DataFrame, profiles: DataFrame, variant: str, part: list) -> DataFrame:
    j = ratings.select(*part, U, I, "score").join(profiles.select(I, "idx"), I)
    if variant == "B":
        return j.groupBy(*part, U, "idx").agg(F.avg("score").alias("weight"))
    n = ratings.groupBy(*part, U).agg(F.count(F.lit(1)).alias("_n"))
    s = j.groupBy(*part, U, "idx").agg(F.sum("score").alias("_s"))
    return s.join(n, part + [U]).select(*part, U, "idx", (F.col("_s") / F.col("_n")).alias("weight"))


def _user_profiles_packed(ratings: DataFrame, profiles: DataFrame, variant: str, keys: list) -> DataFrame:
    """A rating goes to its user with its item's packed features, not with a row for each. Ratings of one user come one after
    the other, and only the sums of its features are kept, however many ratings it has."""
    items = packed_items(profiles.where(F.col(I).isNotNull()).select(I, "idx", F.lit(1.0).alias("weight")))
    rows = ratings.select(*keys, I, F.col("score").cast("double").alias("score")).join(items, I, "left").select(*keys, "score", "features")
    rows = rows.repartition(*keys).sortWithinPartitions(*keys)

    def summed(batches):
        import pyarrow as pa

        types, last = None, None  # last: (key, ratings, features, sums) of the user whose ratings may go on

        def made(held):
            of = np.repeat(np.arange(len(held)), [len(x[2]) for x in held])
            s = np.concatenate([x[3] for x in held])
            n = np.array([x[1] for x in held])[of] if variant == "A" else s[:, 1]
            weight = np.divide(s[:, 0], n, out=np.zeros(len(of)), where=n > 0)
            columns = [pa.array([x[0][k] for x in held], t).take(pa.array(of)) for k, t in enumerate(types)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate([x[2] for x in held])), pa.array(weight, mask=s[:, 1] == 0)], [*keys, "idx", "weight"])

        for batch in batches:
            if not batch.num_rows:
                continue
            types = [batch.schema.field(c).type for c in keys]
            who = list(zip(*[batch.column(c).to_pylist() for c in keys], strict=True))
            score = batch.column("score")
            n, idx, _ = _unpack(batch.column("features").to_pylist())
            each = np.stack([score.fill_null(0.0).to_numpy(), score.is_valid().to_numpy(zero_copy_only=False)], axis=1)
            ends, done = np.concatenate([[0], np.cumsum(n)]), []
            first = [0, *[r for r in range(1, len(who)) if who[r] != who[r - 1]], len(who)]
            for a, b in zip(first[:-1], first[1:], strict=True):
                new = (who[a], b - a, *_sums_by_feature(idx[ends[a]:ends[b]], np.repeat(each[a:b], n[a:b], axis=0)))
                if last is not None and last[0] == new[0]:
                    last = (new[0], last[1] + new[1], *_sums_by_feature(np.concatenate([last[2], new[2]]), np.concatenate([last[3], new[3]])))
                    continue
                if last is not None:
                    done.append(last)
                last = new
            if done:
                yield made(done)
        if last is not None:
            yield made([last])
    kinds = ", ".join(f"`{c}` {ratings.schema[c].dataType.simpleString()}" for c in keys)
    out = rows.mapInArrow(summed, f"{kinds}, idx bigint, weight double")
    return out.withColumn("idx", F.col("idx").cast(profiles.schema["idx"].dataType))


def _pack(idx: np.ndarray, weight: np.ndarray) -> bytes:
    """The features of an item, in the order of their index, as compressed steps of the index and weights."""
    return zlib.compress(np.diff(idx, prepend=0).astype("<i8").tobytes() + weight.astype("<f8").tobytes(), 9)


def _unpack(blobs: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of features of each item, their indices, their weights); none for None."""
    parts = [np.frombuffer(zlib.decompress(x), "<i8") if x else np.empty(0, "<i8") for x in blobs]
    n = np.array([len(x) // 2 for x in parts], np.int64)
    idx = [np.cumsum(x[:len(x) // 2]) for x in parts]
    weight = [x[len(x) // 2:].view("<f8") for x in parts]
    return n, np.concatenate(idx or [np.empty(0, np.int64)]), np.concatenate(weight or [np.empty(0)])


def packed_items(iprof: DataFrame) -> DataFrame:
    """(item_id, features binary): one row for each item."""
    def pack(f: pd.Series, w: pd.Series) -> pd.Series:
        return pd.Series([_pack(np.asarray(x, np.int64), np.asarray(y, float)) for x, y in zip(f, w, strict=True)])
    known = iprof.where(F.col("idx").isNotNull() & F.col("weight").isNotNull())
    lists = known.groupBy(I).agg(F.sort_array(F.collect_list(F.struct("idx", "weight"))).alias("_f"))  # an item's features, not its ratings
    return lists.select(I, F.pandas_udf(pack, "binary")(F.col("_f.idx"), F.col("_f.weight")).alias("features"))


def _sums_by_feature(idx: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sum of the rows of each index."""
    found, at = np.unique(idx, return_inverse=True)
    return found, np.stack([np.bincount(at, c, len(found)) for c in rows.T], axis=1)


def user_profiles_by_fold(folds: DataFrame, profiles: DataFrame, n_folds: int = 5, parts: int | None = None) -> DataFrame:
    """JOB-10 (B) for every fold's train side at once: one row (user_id, idx, w) for each user, idx its features in
    ascending order, w[f - 1] their weights for fold f.

    The train side of fold f is "all ratings minus fold f", so each (user, feature) is summed up once over all
    ratings and within each fold, and fold f's weight is (total - part f) / (count - part f), null where nothing
    is left (sums of half-star scores are exact, so the result equals the direct per-fold average).

    A rating goes to its user with its item's packed features. Ratings of one user come one after the other, and only the
    sums of its features are kept, however many ratings it has. ``parts``: partitions by hash of the user."""
    rows = folds.select("fold", U, I, F.col("score").cast("double").alias("score")).where(F.col(U).isNotNull())
    rows = rows.join(packed_items(profiles), I).select(U, "fold", "score", "features")
    rows = (rows.repartition(parts, U) if parts else rows.repartition(U)).sortWithinPartitions(U)

    def made(held):
        import pyarrow as pa

        ids, idx, sums = zip(*held, strict=True)
        at = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in idx])]), pa.int32())
        s = np.concatenate(sums)
        left = s[:, 2:3] - s[:, 3 + n_folds:]
        w = np.where((left > 0) & (s[:, 1:2] > 0), (s[:, :1] - s[:, 3:3 + n_folds]) / np.maximum(left, 1), np.nan)
        flat, starts = [], [0]  # for one user after the other the weights of each fold
        for x, lo in zip(idx, at.to_numpy()[:-1], strict=True):
            flat.append(w[lo:lo + len(x)].T.ravel())
            starts += [starts[-1] + len(x) * f for f in range(1, n_folds + 1)]
        inner = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(np.concatenate(flat), from_pandas=True))
        outer = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * n_folds, pa.int32()), inner)
        return pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.ListArray.from_arrays(at, pa.array(np.concatenate(idx))), outer], [U, "idx", "w"])

    def profiles_of(batches):
        nonlocal id_type
        last = None  # (user, features, sums) of the user whose ratings may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            id_type = batch.schema.field(U).type
            ids = np.array(batch.column(U).to_pylist())
            fold = batch.column("fold").to_pandas().to_numpy(float, na_value=np.nan)
            score = batch.column("score").to_numpy(zero_copy_only=False)
            n, idx, _ = _unpack(batch.column("features").to_pylist())
            of = np.arange(1, n_folds + 1) == fold[:, None]
            known = ~np.isnan(score)
            value = np.where(known, score, 0.0)
            each = np.concatenate([value[:, None], known[:, None], np.ones((len(ids), 1)), of * value[:, None], of], axis=1)
            ends, done = np.concatenate([[0], np.cumsum(n)]), []
            first = np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1, [len(ids)]])
            for a, b in zip(first[:-1], first[1:], strict=True):
                new = (ids[a].item(), *_sums_by_feature(idx[ends[a]:ends[b]], np.repeat(each[a:b], n[a:b], axis=0)))
                if last is not None and last[0] == new[0]:
                    last = (new[0], *_sums_by_feature(np.concatenate([last[1], new[1]]), np.concatenate([last[2], new[2]])))
                    continue
                if last is not None:
                    done.append(last)
                last = new
            if done:
                yield made(done)
        if last is not None:
            yield made([last])
    id_type = None
    return rows.mapInArrow(profiles_of, f"{U} {folds.schema[U].dataType.simpleString()}, idx array<bigint>, w array<array<double>>")


def profile_norms(uprof: DataFrame, iprof: DataFrame, n_folds: int = 5) -> tuple[DataFrame, DataFrame]:
    """(user_id, _n array<double> with a norm per fold) and (item_id, i_norm)."""
    squares = F.transform("w", lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + F.coalesce(x * x, F.lit(0.0)))))
    return uprof.select(U, squares.alias("_n")), iprof.groupBy(I).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("i_norm"))


def content_scores_by_fold(folds: DataFrame, uprof: DataFrame, iprof: DataFrame, n_folds: int = 5,
                           norms: tuple[DataFrame, DataFrame] | None = None, parts: int | None = None, chunk: int = 4096) -> DataFrame:
    """``content_scores`` of every rating under the profiles of its own fold's train side, from the rows of
    ``user_profiles_by_fold``: a cell picks its fold's weights, and a user's norms for all folds lie in one row.

    Cells go to their user with their item's packed features and meet its profile in chunks of at most ``chunk`` cells.
    Profiles and ``norms`` in ``parts`` buckets by user_id and by item_id are read where they lie: only the cells are
    exchanged. A cell without user, item or fold has no profile."""
    cells = folds.select("fold", U, I, "score")
    whole = F.col("fold").isNotNull() & F.col(U).isNotNull() & F.col(I).isNotNull()
    un, inn = norms or profile_norms(uprof, iprof, n_folds)
    mine = cells.where(whole).join(packed_items(iprof), I, "left").join(inn, I, "left")
    mine = mine.repartition(parts, U) if parts else mine.repartition(U)
    at = F.row_number().over(Window.partitionBy(U).orderBy(I))
    mine = mine.withColumn("_chunk", F.floor((at - 1) / chunk)).groupBy(U, "_chunk").agg(
        F.collect_list(F.struct("fold", I, "score", "i_norm", "features")).alias("_cells"))
    mine = mine.join(uprof, U, "left").join(un, U, "left").select(U, "_cells", "idx", "w", "_n")

    def dots(batches):
        import pyarrow as pa

        for batch in batches:
            for r in range(batch.num_rows):  # a user's cells, ``chunk`` at most
                cell = pa.RecordBatch.from_struct_array(batch.column("_cells")[r].values)
                num = np.full(cell.num_rows, np.nan)
                fold = cell.column("fold").to_numpy()
                if batch.column("idx")[r].is_valid:
                    own = batch.column("idx")[r].values.to_numpy()
                    w = np.stack([x.values.to_numpy(zero_copy_only=False) for x in batch.column("w")[r]])
                    n, idx, weight = _unpack(cell.column("features").to_pylist())
                    of = np.repeat(np.arange(len(n)), n)
                    f = fold[of] - 1
                    pos = np.minimum(np.searchsorted(own, idx), len(own) - 1)
                    ok = (own[pos] == idx) & (f >= 0) & (f < n_folds)
                    num = np.bincount(of[ok], np.nan_to_num(w[f[ok], pos[ok]]) * weight[ok], len(n)).astype(float)
                sizes = batch.column("_n")[r].as_py() or []
                size = [sizes[x - 1] if 0 < x <= len(sizes) else None for x in fold.tolist()]
                yield pa.RecordBatch.from_arrays([
                    cell.column("fold"), batch.column(U).take(pa.array(np.full(cell.num_rows, r))), cell.column(I), cell.column("score"),
                    pa.array(num, from_pandas=True), pa.array(size, pa.float64()), cell.column("i_norm")],
                    ["fold", U, I, "score", "num", "u_norm", "i_norm"])
    kinds = ", ".join(f"{c} {folds.schema[c].dataType.simpleString()}" for c in ("fold", U, I, "score"))
    out = mine.mapInArrow(dots, f"{kinds}, num double, u_norm double, i_norm double")
    none = F.lit(None).cast("double")
    rest = cells.where(~whole).select("fold", U, I, "score", none.alias("num"), none.alias("u_norm"), none.alias("i_norm"))
    return _cosine_scores(out.unionByName(rest), ["fold"])


def content_scores(test: DataFrame, uprof: DataFrame, iprof: DataFrame,
                   part: Sequence[str] = ()) -> DataFrame:
    """JOB-11 / JOI-13 / PRJ-3: cosine(user profile, item profile) and 4*cos+1.
    A zero norm gives cosine 0.0 (so the rescaled score is 1.0)."""
    part = list(part)
    cells = test.select(*part, U, I, "score")
    dots = (cells.join(iprof.select(I, "idx", F.col("weight").alias("_wi")), I)
            .join(uprof.select(*part, U, "idx", F.col("weight").alias("_wu")), part + [U, "idx"])
            .groupBy(*part, U, I).agg(F.sum(F.col("_wu") * F.col("_wi")).alias("num")))
    un = uprof.groupBy(*part, U).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("u_norm"))
    inn = iprof.groupBy(I).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("i_norm"))
    out = (cells.join(dots, part + [U, I], "left").join(un, part + [U], "left").join(inn, I, "left"))
    return _cosine_scores(out, part)


def _cosine_scores(out: DataFrame, part: list) -> DataFrame:
    den = F.coalesce("u_norm", F.lit(0.0)) * F.coalesce("i_norm", F.lit(0.0))
    cos = F.when(den == 0, F.lit(0.0)).otherwise(F.coalesce("num", F.lit(0.0)) / den)
    return out.select(*part, U, I, "score", cos.alias("pred_raw"), rescale(cos).alias("pred"))


def profile_similarity(profiles: DataFrame, row: str, kind: str = "cos"):
    """SIM-8 / SIM-9 / JOI-10: the profiles and, called with pairs (a, b), their (a, b, csim).

    Cosine is 0.0 whenever the profile dot product is 0; Jaccard is
    |A and B| / |A or B| over feature sets (0.0 for two empty sets)."""
    values = profiles.select(F.col(row), F.col("idx"), F.col("weight").alias("v"))

    def fn(pairs: DataFrame) -> DataFrame:
        st = pair_stats(values, pairs.select("a", "b").distinct(), row, "idx", "v")
        if kind == "jac":
            union = F.col("n_a") + F.col("n_b") - F.col("co")
            csim = F.when(union == 0, F.lit(0.0)).otherwise(F.col("co") / union)
        else:
            csim = F.when(F.col("dot") == 0, F.lit(0.0)).otherwise(
                F.col("dot") / F.sqrt(F.col("sq_a") * F.col("sq_b")))
        return st.select("a", "b", csim.alias("csim"))
    return Profiles(values, row, "idx", "v", kind, fn)

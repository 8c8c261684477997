"""Factorisation queries (JOB-14..JOB-20). ALS, SGD and SVD are iterative with random starts, so their
fits are rows checks with invariants in the tests; scoring, centring, saving and a full-rank SVD have oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from cinerank.functions.scalar import r6
from cinerank.operators import factor as fa
from cinerank.operators import least_squares as ls
from cinerank.operators import neighbours as nb
from cinerank.operators.evaluate import error_metrics, rounded
from cinerank.operators.factor_model import FactorModel
from cinerank.plans.oracle_views import with_views
from cinerank.plans.registry import query
from cinerank.session import materialize, scratch_path
from cinerank.sources import views

METRICS = ["rmse", "mae", "sqrt_mae"]

#: Fits that several queries read, written once per session: (application, kind, sf_dir) -> what to read.
_FITTED: dict[tuple, object] = {}


def _once(spark, kind, sf_dir, fit):
    key = (spark.sparkContext.applicationId, kind, sf_dir)
    if key not in _FITTED:
        _FITTED[key] = fit()
    return _FITTED[key]


def _fold1(spark, sf_dir):
    train, test = nb.fold_sides(views.folds(spark, sf_dir), only=1)
    return train.drop("fold"), test.drop("fold")


def _overall(scored):
    return rounded(error_metrics(scored.withColumn("g", F.lit(1)), ("g",)).drop("g"), METRICS)


# --- ALS ----------------------------------------------------------------------

def _als(spark, sf_dir):
    """Folder with the factors of ALS (rank 20, lambda 0.1, 10 sweeps) on fold-1 train."""
    def fit():
        path = scratch_path(spark, "als_factors")
        fa.save_factors(*fa.als_factors(fa.als_model(_fold1(spark, sf_dir)[0])), path)
        return path
    return _once(spark, "als", sf_dir, fit)


def _als_scores(spark, sf_dir, bound=True):
    train, test = _fold1(spark, sf_dir)
    mu = train.agg(F.avg("score").alias("mu"))
    return fa.score_cells(test, *fa.load_factors(spark, _als(spark, sf_dir)), mu, bound=bound)


@query("job14_als_fold1")
def job14_als_fold1(spark, sf_dir):
    """JOB-14 / JOB-17: ALS (rank 20, lambda 0.1) on fold-1 train, clamped test metrics."""
    return _overall(_als_scores(spark, sf_dir))


@query("job16_als_light_errors")
def job16_als_light_errors(spark, sf_dir):
    """JOB-16: the same factors scored without clamping (observed cells only)."""
    return _overall(_als_scores(spark, sf_dir, bound=False))


@query("job20_point_lookup")
def job20_point_lookup(spark, sf_dir):
    """JOB-20: stored vs predicted value for every fold-1 test cell."""
    return _als_scores(spark, sf_dir).select("user_id", "item_id", F.col("score").alias("stored"), F.round("pred", 6).alias("pred"))


@query("snk12_factor_model")
def snk12_factor_model(spark, sf_dir):
    """SNK-12: the saved ALS factors that the other ALS queries use, read back: the items' rows."""
    return fa.load_factors(spark, _als(spark, sf_dir))[1].select("item_id", F.col("q").alias("features"))


# --- resumable least squares, all folds in the same jobs -----------------------

CURVE = (1, 2, 5, 10)


def _als_folds(spark, sf_dir, keep=()):
    """(rating table, factors after the sweeps in ``keep`` and the last, train mean of each fold): one fit of 10 sweeps for
    all folds. Queries of the last sweep read the fit of the learning curve where the session has it."""
    if not keep and (spark.sparkContext.applicationId, f"als_folds{CURVE}", sf_dir) in _FITTED:
        keep = CURVE

    def fit():
        r = ls.rating_table(views.folds(spark, sf_dir), views.N_FOLDS)
        total = [F.sum("score").alias("s"), F.count("score").alias("c")]
        own = {x["fold"]: x for x in r.groupBy("fold").agg(*total).collect()}  # a row for each fold
        s, c = sum(x["s"] for x in own.values()), sum(x["c"] for x in own.values())
        mean = [(s - own[f]["s"]) / (c - own[f]["c"]) if f in own else s / c for f in range(1, views.N_FOLDS + 1)]
        return r, ls.als_sweeps(r, ls.random_start(r, views.N_FOLDS), sweeps=CURVE[-1], keep=keep), mean
    return _once(spark, f"als_folds{keep}", sf_dir, fit)


def _als_test_cells(spark, sf_dir, bound=True):
    r, kept, mean = _als_folds(spark, sf_dir)
    return ls.score_test_cells(r.select("fold", "user_id", "item_id", "score"), *kept[CURVE[-1]], mean, bound=bound)


@query("job14_als_folds")
def job14_als_folds(spark, sf_dir):
    """JOB-14 / JOB-17: least squares (rank 20, lambda 0.1, 10 sweeps) on the train rows of every fold, clamped test metrics."""
    return rounded(error_metrics(_als_test_cells(spark, sf_dir), ("fold",)), METRICS)


@query("job16_als_light_errors_folds")
def job16_als_light_errors_folds(spark, sf_dir):
    """JOB-16: the same factors scored without clamping, in every fold."""
    return rounded(error_metrics(_als_test_cells(spark, sf_dir, bound=False), ("fold",)), METRICS)


@query("job20_point_lookup_folds")
def job20_point_lookup_folds(spark, sf_dir):
    """JOB-20: stored and predicted value of every rating, by the factors of the fold that has not seen it."""
    return _als_test_cells(spark, sf_dir).select("fold", "user_id", "item_id", F.col("score").alias("stored"), r6("pred").alias("pred"))


@query("job15_als_learning_curve_folds")
def job15_als_learning_curve_folds(spark, sf_dir):
    """JOB-15: train and test rmse / mae / sqrt_mae of every fold after 1, 2, 5 and 10 sweeps of one fit."""
    r, kept, mean = _als_folds(spark, sf_dir, keep=CURVE)
    out = None
    for epoch, factors in kept.items():
        s = ls.score_all_cells(r, *factors, views.N_FOLDS, mean)
        m = error_metrics(s, ("fold", "split")).withColumn("epoch", F.lit(epoch))
        out = m if out is None else out.unionByName(m)
    return rounded(out.select("epoch", "fold", "split", *METRICS, "n"), METRICS)


@query("job15_als_learning_curve")
def job15_als_learning_curve(spark, sf_dir):
    """JOB-15: the points of fold 1, from the same fit."""
    return job15_als_learning_curve_folds(spark, sf_dir).where("fold = 1").drop("fold")


GIVEN_LAMBDA, GIVEN_SWEEPS = 0.1, 2


def _sweep_sql() -> str:
    """Two sweeps at rank 2 from given item vectors, every 2 x 2 system solved by Cramer's rule."""
    def half(name, fixed, by, key):
        sums = (f"select t.g, t.{key}, count(*) as n, sum(f.v0 * f.v0) + {GIVEN_LAMBDA} * count(*) as a, sum(f.v0 * f.v1) as b, "
                f"sum(f.v1 * f.v1) + {GIVEN_LAMBDA} * count(*) as c, sum(t.score * f.v0) as y, sum(t.score * f.v1) as z "
                f"from step_train t join {fixed} f on f.g = t.g and f.{by} = t.{by} group by 1, 2")
        return (name, f"select g, {key}, n, (y * c - z * b) / (a * c - b * b) as v0, (a * z - b * y) / (a * c - b * b) as v1 from ({sums}) s")
    g = f"(select unnest(range(1, {views.N_FOLDS + 1})) as g) k"
    steps = [("step_train", f"select g, user_id, item_id, score from folds, {g} where fold <> g"),
             ("step_q0", f"select g, item_id, ((item_id * 5) % 101 + 1) / 64.0 as v0, ((item_id * 6) % 101 + 1) / 64.0 as v1 "
                         f"from (select distinct item_id from ratings) i, {g}")]
    for n in range(1, GIVEN_SWEEPS + 1):
        steps += [half(f"step_p{n}", f"step_q{n - 1}", "item_id", "user_id"), half(f"step_q{n}", f"step_p{n}", "user_id", "item_id")]
    rows = [f"select g as fold, '{kind}' as kind, {key} as id, n, round(v0, 6) + 0.0 as v0, round(v1, 6) + 0.0 as v1 from step_{kind}{GIVEN_SWEEPS}"
            for kind, key in (("p", "user_id"), ("q", "item_id"))]
    return with_views("folds", extra=steps) + " union all ".join(rows)


@query("job15_resumed_sweeps", _sweep_sql())
def job15_resumed_sweeps(spark, sf_dir):
    """JOB-14 / JOB-15: the factors of every fold after two sweeps at rank 2 from given item vectors, the second sweep
    a fit of its own that goes on from the tables of the first."""
    r = ls.rating_table(views.folds(spark, sf_dir), views.N_FOLDS)
    start = F.transform(F.sequence(F.lit(0), F.lit(1)), lambda j: (F.pmod(F.col("item_id") * (j + 5), F.lit(101)) + 1) / F.lit(64.0))
    items = r.select("item_id").distinct().select("item_id", F.array_repeat(start, views.N_FOLDS).alias("m"))
    for _ in range(GIVEN_SWEEPS):
        users, items = ls.als_sweeps(r, items, sweeps=1, lam=GIVEN_LAMBDA)[1]
    out = None
    for table, key, kind in ((users, "user_id", "p"), (items, "item_id", "q")):
        rows = table.select(F.lit(kind).alias("kind"), F.col(key).alias("id"), F.posexplode(F.arrays_zip("m", "n")).alias("g", "v"))
        rows = rows.where("v.n > 0").select((F.col("g") + 1).alias("fold"), "kind", "id", F.col("v.n").alias("n"),
                                            *[r6(F.get("v.m", F.lit(j))).alias(f"v{j}") for j in (0, 1)])
        out = rows if out is None else out.unionByName(rows)
    return out


# --- given factors: scoring and saving without a fit ---------------------------

GIVEN_RANK = 4


def _given(ids, key, name, step):
    """Factor tables by formula: entry j of an id is ((id * (j + step)) % 101) / 64, exact in binary."""
    vec = F.transform(F.sequence(F.lit(0), F.lit(GIVEN_RANK - 1)), lambda j: F.pmod(F.col(key) * (j + step), F.lit(101)) / F.lit(64.0))
    return ids.select(key).distinct().select(key, vec.alias(name))


def _given_pred() -> str:
    return " + ".join(f"((user_id * {j + 3}) % 101) / 64.0 * (((item_id * {j + 5}) % 101) / 64.0)" for j in range(GIVEN_RANK))


_GIVEN = [("raw", f"select user_id, item_id, score, {_given_pred()} as raw from folds where fold = 1"),
          ("cells", "select *, least(greatest(raw, 1.0), 5.0) as pred from raw")]


def _given_tables(spark, sf_dir):
    r = views.ratings(spark, sf_dir)
    path = scratch_path(spark, "given_factors")
    fa.save_factors(_given(r, "user_id", "p", 3), _given(r, "item_id", "q", 5), path)
    return fa.load_factors(spark, path)


def _error_sql(col: str, form: str) -> str:
    return (f"select '{form}' as form, round(sqrt(avg(({col} - score) * ({col} - score))), 6) as rmse, round(avg(abs({col} - score)), 6) as mae, "
            f"round(sqrt(avg(abs({col} - score))), 6) as sqrt_mae, count(*) as n from cells")


@query("job17_errors_of_given_factors", with_views("folds", extra=_GIVEN) + _error_sql("raw", "light") + " union all " + _error_sql("pred", "bounded"))
def job17_errors_of_given_factors(spark, sf_dir):
    """JOB-16 / JOB-17: errors of given factors on the fold-1 test cells, as they are and clamped to [1, 5]."""
    _, test = _fold1(spark, sf_dir)
    p, q = _given_tables(spark, sf_dir)
    scored = [fa.score_cells(test, p, q, bound=b).withColumn("form", F.lit(f)) for f, b in (("light", False), ("bounded", True))]
    return rounded(error_metrics(scored[0].unionByName(scored[1]), ("form",)), METRICS)


@query("job20_cells_of_given_factors", with_views("folds", extra=_GIVEN)
       + "select user_id, item_id, score as stored, round(pred, 6) + 0.0 as pred from cells")
def job20_cells_of_given_factors(spark, sf_dir):
    """JOB-20: stored and predicted value of every fold-1 test cell under given factors."""
    _, test = _fold1(spark, sf_dir)
    s = fa.score_cells(test, *_given_tables(spark, sf_dir))
    return s.select("user_id", "item_id", F.col("score").alias("stored"), r6("pred").alias("pred"))


_GIVEN_ALL = ("all_cells", f"select fold, user_id, item_id, score, least(greatest({_given_pred()}, 1.0), 5.0) as pred from folds")


@query("snk12_saved_model_cells", with_views("folds", extra=[_GIVEN_ALL])
       + "select user_id, item_id, score as stored, round(pred, 6) + 0.0 as pred from all_cells")
def snk12_saved_model_cells(spark, sf_dir):
    """SNK-12 / JOB-20: a model of given factors saved and loaded through Spark ML, and every rating scored by the loaded one."""
    path = scratch_path(spark, "factor_model")
    FactorModel(*_given_tables(spark, sf_dir)).write().save(path)
    s = FactorModel.load(path).transform(views.folds(spark, sf_dir).select("user_id", "item_id", "score"))
    return s.select("user_id", "item_id", F.col("score").alias("stored"), r6("pred").alias("pred"))


@query("job17_errors_of_given_factors_folds", with_views("folds", extra=[_GIVEN_ALL])
       + "select fold, round(sqrt(avg((pred - score) * (pred - score))), 6) as rmse, round(avg(abs(pred - score)), 6) as mae, "
         "round(sqrt(avg(abs(pred - score))), 6) as sqrt_mae, count(*) as n from all_cells group by fold")
def job17_errors_of_given_factors_folds(spark, sf_dir):
    """JOB-17: clamped errors of given factors on the test cells of every fold."""
    s = fa.score_cells(views.folds(spark, sf_dir).select("fold", "user_id", "item_id", "score"), *_given_tables(spark, sf_dir))
    return rounded(error_metrics(s, ("fold",)), METRICS)


def _entries_sql(key: str, step: int, kind: str) -> str:
    return (f"select '{kind}' as kind, {key} as id, j, (({key} * (j + {step})) % 101) / 64.0 as value "
            f"from (select distinct {key} from ratings) t, (select unnest(range({GIVEN_RANK})) as j) k")


@query("snk12_factor_tables", with_views("ratings") + _entries_sql("user_id", 3, "p") + " union all " + _entries_sql("item_id", 5, "q"))
def snk12_factor_tables(spark, sf_dir):
    """SNK-12: given factor tables saved, read back and listed entry by entry."""
    p, q = _given_tables(spark, sf_dir)
    rows = [t.select(F.lit(kind).alias("kind"), F.col(key).alias("id"), F.posexplode(kind).alias("j", "value"))
            for t, key, kind in ((p, "user_id", "p"), (q, "item_id", "q"))]
    return rows[0].unionByName(rows[1]).withColumn("j", F.col("j").cast("bigint"))


# --- SVD ------------------------------------------------------------------------

SVD_RANK = 20


def _svd_scores(spark, sf_dir):
    """Every rating predicted by the rank-20 SVD of the training rows of its fold, all folds in the same jobs."""
    def fit():
        folds = views.folds(spark, sf_dir)
        x, off = fa.centred_by_fold(folds, views.N_FOLDS)
        us, v, _ = fa.truncated_svd(x, k=SVD_RANK)
        cells = folds.select("fold", "user_id", "item_id", "score")
        return materialize(fa.svd_predict(cells, us, v, off, group=F.col("fold") - 1), "svd_scores")
    return _once(spark, "svd", sf_dir, fit)


@query("job18_svd_folds")
def job18_svd_folds(spark, sf_dir):
    """JOB-18 / JOB-19: rank-20 truncated SVD of item-mean-centred train rows for every fold, reconstructed at the
    test cells, item means added back, bounded to [1, 5]; metrics per fold."""
    return rounded(error_metrics(_svd_scores(spark, sf_dir), ("fold",)), METRICS)


@query("job18_svd_fold1")
def job18_svd_fold1(spark, sf_dir):
    """JOB-18: the same for fold 1 only."""
    return _overall(_svd_scores(spark, sf_dir).where("fold = 1"))


@query("job19_item_offsets", with_views("folds")
       + "select g.f as fold, f.item_id, round(avg(f.score), 6) + 0.0 as off from folds f "
         "join (select unnest([1, 2, 3, 4, 5]) as f) g on f.fold <> g.f group by 1, 2")
def job19_item_offsets(spark, sf_dir):
    """JOB-19: the item means of every fold's train rows, which centring takes away and adds back."""
    _, off = fa.centred_by_fold(views.folds(spark, sf_dir), views.N_FOLDS)
    rows = off.select("item_id", F.posexplode("off").alias("k", "off")).where("off is not null")
    return rows.select((F.col("k") + 1).alias("fold"), "item_id", r6("off").alias("off"))


_SEGMENTS = ("cells", "select c_nationkey as user_id, ascii(c_mktsegment) as item_id, avg(score) as score "
                      "from ratings join customer on c_custkey = user_id group by 1, 2")


@query("job18_full_rank_cells", with_views("ratings", extra=[_SEGMENTS])
       + "select user_id, item_id, round(score + 1e-9, 6) + 0.0 as pred from cells")
def job18_full_rank_cells(spark, sf_dir):
    """JOB-18 with nothing cut off: the nation x market segment matrix of mean scores, rebuilt from its SVD.
    Halves of the sixth place are rounded up (+ 1e-9), since both sides may be off by the last bit."""
    c = views.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("bigint").alias("n"), F.ascii("c_mktsegment").cast("bigint").alias("s"))
    cells = views.ratings(spark, sf_dir).join(c, "user_id").groupBy("n", "s").agg(F.avg("score").alias("score"))
    cells = materialize(cells.select(F.col("n").alias("user_id"), F.col("s").alias("item_id"), "score"), "segment_means")
    us, v, _ = fa.truncated_svd(cells, k=5, iters=2)
    return fa.svd_predict(cells, us, v, bound=False).select("user_id", "item_id", r6(F.col("pred") + 1e-9).alias("pred"))


# --- SGD ------------------------------------------------------------------------

def _sgd(spark, sf_dir):
    """The fit of 100 epochs on fold-1 train. The grid follows the number of ratings, never the cluster."""
    def fit():
        train = _fold1(spark, sf_dir)[0]
        return fa.sgd_fit(train, fa.sgd_grid(train.count()), epochs=fa.SGD_EPOCHS)
    return _once(spark, "sgd", sf_dir, fit)


@query("job15_sgd_learning_curve")
def job15_sgd_learning_curve(spark, sf_dir):
    """JOB-14 SGD mode / JOB-15: stratified block SGD (k=20, lambda=0.1, gamma=0.01);
    train and test rmse / mae / sqrt_mae after each of 100 epochs (unclamped, JOB-16), all epochs in one job."""
    cells = views.folds(spark, sf_dir).select(
        F.when(F.col("fold") == 1, "test").otherwise("train").alias("split"), "user_id", "item_id", "score")
    return rounded(fa.sgd_errors(_sgd(spark, sf_dir), cells), METRICS)


@query("job17_sgd_fold1")
def job17_sgd_fold1(spark, sf_dir):
    """JOB-14 SGD mode / JOB-17: block-SGD factors after 100 epochs, clamped test metrics on fold 1."""
    train, test = _fold1(spark, sf_dir)
    mu = train.agg(F.avg("score").alias("mu"))
    return _overall(fa.score_cells(test, *fa.epoch_factors(fa.sgd_rows(_sgd(spark, sf_dir), fa.SGD_EPOCHS)), mu))

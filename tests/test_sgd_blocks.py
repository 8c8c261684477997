"""SGD holds the factors of a block in one row, and its errors need no join of every rating for every epoch."""
import numpy as np
from pyspark.sql import functions as F

from cinerank.operators import factor as fa
from cinerank.operators.evaluate import error_metrics


def test_errors_of_all_epochs_are_those_of_the_joined_cells(spark):
    rng = np.random.default_rng(4)
    rows = [(u, i, float(rng.integers(1, 11)) / 2, "test" if rng.random() < 0.3 else "train") for u in range(25) for i in range(15) if rng.random() < 0.4]
    rows += [(0, i, 2.0, "train") for i in range(100, 130)]  # a hot user, dealt out
    rows += [(99, 1, 4.0, "test"), (1, 999, 4.0, "test"), (None, 1, 3.0, "train"), (2, 3, None, "test")]  # no factors, no score
    cells = spark.createDataFrame(rows, "user_id bigint, item_id bigint, score double, split string")
    train = cells.where("split = 'train' and score is not null")
    fit = fa.sgd_fit(train, 3, rank=3, epochs=5, most=12)
    assert spark.read.parquet(fit.table).count() == 5 * 2 * 3  # a row for each epoch, kind and block
    got = {(r.epoch, r.split): r for r in fa.sgd_errors(fit, cells, together=2).collect()}
    every = cells.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(5))))
    plain = error_metrics(fa.score_cells(every, *fa.epoch_factors(fa.sgd_rows(fit)), bound=False, by=("epoch",)), ("epoch", "split")).collect()
    assert len(got) == len(plain) == 10
    for r in plain:
        x = got[r.epoch, r.split]
        assert x.n == r.n and np.allclose([x.rmse, x.mae, x.sqrt_mae], [r.rmse, r.mae, r.sqrt_mae], atol=1e-12)
    assert {r.epoch for r in fa.sgd_rows(fit, 5).collect()} == {5}

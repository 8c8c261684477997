"""A step of the SVD sends each item's vectors once to each block of users, not with every rating."""
import numpy as np

from cinerank.operators import factor as fa


def test_step_is_the_matrix_times_its_transpose_in_every_group(spark):
    rng = np.random.default_rng(2)
    a = [np.where(rng.random((30, 8)) < 0.5, rng.normal(size=(30, 8)), 0.0) for _ in range(2)]
    rows = [(u, i, [None if m[u, i] == 0 else float(m[u, i]) for m in a]) for u in range(30) for i in range(8) if a[0][u, i] or a[1][u, i]]
    rows += [(None, 1, [1.0, 1.0]), (2, None, [1.0, 1.0])]  # no user, no item: part of no product
    values = spark.createDataFrame(rows, "user_id bigint, item_id bigint, x array<double>")
    m = rng.normal(size=(9, 2, 3))  # item 8 has no rating and is left out
    table = spark.createDataFrame([(i, m[i].tolist()) for i in range(9)], "item_id bigint, m array<array<double>>")
    cols, places = fa._columns(values, 2, len(rows), most_rows=6)
    assert places == 6 and cols.select("block").distinct().count() == 5
    sent = cols.count()
    assert sent <= 5 * 2 * 8 < sum(len(r[2]) for r in rows)  # fewer vectors travel than ratings
    got = {r.item_id: r for r in fa._step(cols, places, table, ("m",), 2, 3, lambda x, h: (x, h), ("m", "h")).collect()}
    assert sorted(got) == list(range(8))
    for g in range(2):
        h = a[g].T @ a[g] @ m[:8, g]
        assert all(np.allclose(got[i].h[g], h[i]) and np.allclose(got[i].m[g], m[i, g]) for i in range(8))
    assert [list(x) for x in (fa._strips(np.array([3, 1, 9, 1]), 4), fa._runs(np.array([1, 1, 2]), np.array([0, 1, 1])))] == [[(0, 2), (2, 3), (3, 4)], [(0, 1), (1, 2), (2, 3)]]

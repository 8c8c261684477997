"""Binary fixtures: vote tie, signed like/dislike counts."""
from cinerank.operators.knn import knn_classify, like_dislike_scores
from cinerank.operators.similarity import pair_stats
from cinerank.operators.knn import signed_similarity

COLS = "fold int, user_id bigint, item_id bigint, label int"


def test_vote_tie_is_dislike(spark):
    # user 1 rated 10 other items: 5 likes, 5 dislikes; all at the same distance
    train = [(1, 1, j, 1 if j < 105 else -1) for j in range(100, 110)]
    test = [(1, 1, 50, 1)]
    out = knn_classify(spark.createDataFrame(train, COLS), spark.createDataFrame(test, COLS), k=10).collect()
    assert out[0].pred == -1


def test_signed_similarity_counts(spark):
    # u=1 and v=2: one item each of LL, DD, LD, DL, plus item 5 only rated by u
    rows = [(1, 1, 1.0), (2, 1, 1.0), (1, 2, -1.0), (2, 2, -1.0), (1, 3, 1.0), (2, 3, -1.0),
            (1, 4, -1.0), (2, 4, 1.0), (1, 5, 1.0)]
    v = spark.createDataFrame(rows, "user_id bigint, item_id bigint, v double")
    pairs = spark.createDataFrame([(1, 2)], "a bigint, b bigint")
    st = pair_stats(v, pairs, "user_id", "item_id", "v").collect()[0]
    assert st.co == 4 and st.dot == 0.0 and st.n_a + st.n_b - st.co == 5
    sim = signed_similarity(pair_stats(v, pairs, "user_id", "item_id", "v")).collect()[0].sim
    assert float(sim) == 0.0  # (1 + 1 - 1 - 1) / 5


def test_like_dislike_score_without_raters_is_zero(spark):
    train = [(1, 2, 10, 1)]
    test = [(1, 1, 99, 1)]
    out = like_dislike_scores(spark.createDataFrame(train, COLS), spark.createDataFrame(test, COLS)).collect()
    assert out[0].pred == 0.0


def test_like_dislike_bracket_as_written(spark):
    # u=1, v=2: one item each of LL, DD, LD, DL; item 5 only u; v also liked the test item 99
    labels = [(1, 1, 1), (2, 1, 1), (1, 2, -1), (2, 2, -1), (1, 3, 1), (2, 3, -1), (1, 4, -1), (2, 4, 1),
              (1, 5, 1), (2, 99, 1)]
    train = spark.createDataFrame([(1, u, i, lab) for u, i, lab in labels], COLS)
    test = spark.createDataFrame([(1, 1, 99, 1)], COLS)
    intended = like_dislike_scores(train, test).collect()[0].pred
    written = like_dislike_scores(train, test, as_written=True).collect()[0].pred
    assert intended == 0.0                      # (1 + 1 - 1 - 1) / 6
    assert abs(written - 2 / 6) < 1e-9          # (1 + 1 - 1 + 1) / 6

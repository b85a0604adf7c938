"""The reference's own assertions and the worked cases of FIXTURES.md."""

import math

import pytest
from conftest import ratings_df, rows_of
from pyspark.sql import functions as F

from rateflow.operators import quality, sampling
from rateflow.operators.aggregates import user_means
from rateflow.operators.evaluate import errors
from rateflow.operators.predict import predict_mean, predict_user_knn
from rateflow.operators.recommend import popular_items, recommend_user_knn
from rateflow.operators.similarity import (
    co_ratings,
    co_rating_sums,
    item_pairs,
    top_neighbours,
    user_similarity,
)

U1 = [(1, 9, 3.0), (1, 2, 4.0), (1, 1, 3.0), (1, 6, 2.0), (1, 7, 3.5), (1, 5, 2.5)]
U2 = [(2, 7, 3.0), (2, 3, 4.0), (2, 6, 3.0), (2, 5, 2.0), (2, 2, 3.0), (2, 8, 4.0)]


def test_user_mean(spark):
    r = ratings_df(spark, [(123, 1, 1.0), (123, 2, 2.0), (123, 3, 3.0)])
    assert rows_of(user_means(r)) == [(123, 2.0)]


def test_co_ratings_in_item_order(spark):
    pairs = co_ratings(ratings_df(spark, U1 + U2))
    got = [(r["ru"], r["rv"]) for r in pairs.orderBy("item_id").collect()]
    assert got == [(4.0, 3.0), (2.5, 2.0), (2.0, 3.0), (3.5, 3.0)]
    assert {(r["u"], r["v"]) for r in pairs.collect()} == {(1, 2)}


def test_item_pairs(spark):
    r = ratings_df(spark, [(4, 1, 4.0), (1, 1, 1.0), (2, 1, 2.0), (3, 1, 3.0)])
    got = rows_of(item_pairs(r), "u", "v", "ru", "rv")
    assert got == [(1, 2, 1.0, 2.0), (1, 3, 1.0, 3.0), (1, 4, 1.0, 4.0),
                   (2, 3, 2.0, 3.0), (2, 4, 2.0, 4.0), (3, 4, 3.0, 4.0)]


def test_cosine(spark):
    sim = user_similarity(ratings_df(spark, U1 + U2)).collect()
    assert len(sim) == 1
    row = sim[0]
    assert (row["u"], row["v"], row["n"]) == (1, 2, 4)
    assert row["sim"] == pytest.approx(33.5 / (math.sqrt(38.5) * math.sqrt(31.0)))
    assert round(row["sim"], 6) == 0.969692


def test_cosine_sums(spark):
    s = co_rating_sums(ratings_df(spark, U1 + U2), blocks=3).collect()[0]
    assert (s["dot"], s["s1"], s["s2"], s["n"]) == (33.5, 38.5, 31.0, 4)


def test_neighbour_threshold(spark):
    # user 1 shares 9 items with user 2 and 10 with user 3
    rows = [(1, i, 3.0) for i in range(10)] + [(2, i, 4.0) for i in range(9)] + \
           [(3, i, 2.0) for i in range(10)]
    nb = top_neighbours(ratings_df(spark, rows), k=200, min_common=10)
    got = rows_of(nb, "user_id", "nb", "n")
    assert got == [(1, 3, 10), (3, 1, 10)]


def test_min_common_must_be_positive(spark):
    with pytest.raises(ValueError):
        top_neighbours(ratings_df(spark, U1), min_common=0)


def _knn_fixture(spark):
    # u=1 mean 3; neighbours v=2 (sim 1.0, rated item 100 with 5, mean 4) and
    # w=3 (sim 0.5, rated item 100 with 2, mean 3).
    train = ratings_df(spark, [
        (1, 1, 3.0), (1, 2, 3.0),
        (2, 100, 5.0), (2, 3, 3.0),
        (3, 100, 2.0), (3, 4, 4.0),
    ])
    nbrs = spark.createDataFrame(
        [(1, 2, 1.0, 1), (1, 3, 0.5, 2)], "user_id long, nb long, sim double, rk int")
    return train, nbrs, user_means(train)


def test_knn_prediction(spark):
    train, nbrs, means = _knn_fixture(spark)
    pairs = spark.createDataFrame([(1, 100), (1, 200), (9, 100)], "user_id long, item_id long")
    got = {(r["user_id"], r["item_id"]): r["prediction"]
           for r in predict_user_knn(pairs, nbrs, train, means, k=200).collect()}
    assert got[(1, 100)] == pytest.approx(3 + (1.0 * 1 + 0.5 * -1) / 1.5)
    assert round(got[(1, 100)], 6) == 3.333333
    assert got[(1, 200)] == 3.0          # no neighbour rated it
    assert got[(9, 100)] == 0.0          # unknown user


def test_knn_k_counts_neighbours_not_raters(spark):
    train, nbrs, means = _knn_fixture(spark)
    # first neighbour has not rated item 4, the second has; K = 1 stops before it
    pairs = spark.createDataFrame([(1, 4)], "user_id long, item_id long")
    got = predict_user_knn(pairs, nbrs, train, means, k=1).collect()[0]["prediction"]
    assert got == 3.0
    got2 = predict_user_knn(pairs, nbrs, train, means, k=2).collect()[0]["prediction"]
    assert got2 == pytest.approx(3 + 0.5 * (4.0 - 3.0) / 0.5)


def test_knn_recommendation_score_and_exclude(spark):
    train, nbrs, _ = _knn_fixture(spark)
    recs = recommend_user_knn(nbrs, train, k=200, n=30)
    got = {r["item_id"]: r["score"] for r in recs.filter("user_id = 1").collect()}
    assert got[100] == pytest.approx((1.0 * 5 + 0.5 * 2) / 1.5)
    assert got[100] == 4.0
    # a rated item of the user is recommended by default, not with exclude_rated
    train2 = train.unionByName(ratings_df(spark, [(1, 100, 1.0)]))
    keep = recommend_user_knn(nbrs, train2, n=30).filter("user_id = 1 AND item_id = 100").count()
    drop = recommend_user_knn(nbrs, train2, n=30, exclude_rated=True).filter(
        "user_id = 1 AND item_id = 100").count()
    assert (keep, drop) == (1, 0)


def test_popularity_threshold(spark):
    rows = [(u, 1, 4.0) for u in range(100)] + [(u, 2, 3.0) for u in range(101)]
    items = spark.createDataFrame([(1, "a"), (2, "b")], "item_id long, title string")
    got = rows_of(popular_items(ratings_df(spark, rows), items, min_count=100, n=30))
    assert got == [(2, "b", 3.0, 101)]


def test_errors_and_missing_pair(spark):
    pred = spark.createDataFrame([(1, 1, 3.0), (1, 2, 4.0), (1, 3, 2.0)],
                                 "user_id long, item_id long, prediction double")
    actual = ratings_df(spark, [(1, 1, 4.0), (1, 2, 4.0), (1, 3, 4.0), (1, 4, 4.0)])
    e = errors(pred, actual).collect()[0]
    assert e["rmse"] == pytest.approx(math.sqrt(5 / 3))
    assert round(e["rmse"], 6) == 1.290994
    assert (e["mae"], e["n"]) == (1.0, 3)
    assert e["coverage"] == 0.75


def test_errors_empty(spark):
    pred = spark.createDataFrame([], "user_id long, item_id long, prediction double")
    actual = ratings_df(spark, [(1, 1, 4.0)])
    e = errors(pred, actual).collect()[0]
    assert (e["rmse"], e["mae"], e["n"]) == (None, None, 0)


def test_baseline_unknown_user_is_zero(spark):
    means = user_means(ratings_df(spark, [(1, 1, 4.0)]))
    pairs = spark.createDataFrame([(1, 5), (2, 5)], "user_id long, item_id long")
    assert rows_of(predict_mean(pairs, means)) == [(1, 5, 4.0), (2, 5, 0.0)]


def test_histogram_two_buckets(spark):
    v = spark.createDataFrame([(x,) for x in [0, 1, 2, 3, 4]], "x long")
    assert rows_of(quality.histogram(v, "x", 2)) == [(0, 0.0, 2.0, 2), (1, 2.0, 4.0, 3)]


def test_histogram_one_value(spark):
    v = spark.createDataFrame([(5,), (5,), (5,)], "x long")
    assert rows_of(quality.histogram(v, "x", 20)) == [(0, 5.0, 5.0, 3)]


def test_histogram_empty_buckets_kept(spark):
    v = spark.createDataFrame([(0,), (10,)], "x long")
    got = rows_of(quality.histogram(v, "x", 5))
    assert [r[3] for r in got] == [1, 0, 0, 0, 1]


def _ordered(spark, pairs):
    return spark.createDataFrame([(i + 1, u, m) for i, (u, m) in enumerate(pairs)],
                                 "line long, user_id long, item_id long")


def test_user_order(spark):
    rows = _ordered(spark, [(1, 1), (1, 2), (2, 1), (4, 1), (3, 1)])
    flags = quality.order_check(rows).collect()[0]
    assert flags["user_order_ok"] is False
    assert flags["user_step_ok"] is False
    steps = rows_of(quality.user_step_violations(rows), "prev_user_id", "user_id")
    assert steps == [(2, 4), (4, 3)]


def test_item_order(spark):
    rows = _ordered(spark, [(1, 5), (1, 3), (2, 1)])
    got = rows_of(quality.item_order_violations(rows), "prev_item_id", "item_id", "line")
    assert got == [(5, 3, 2)]
    flags = quality.order_check(rows).collect()[0]
    assert (flags["user_order_ok"], flags["user_step_ok"], flags["item_order_ok"]) == (True, True, False)


def test_order_all_good(spark):
    rows = _ordered(spark, [(1, 1), (1, 2), (2, 1), (2, 7), (3, 3)])
    flags = quality.order_check(rows).collect()[0]
    assert (flags["user_order_ok"], flags["user_step_ok"], flags["item_order_ok"]) == (True, True, True)
    facts = quality.last_row_facts(rows).collect()[0]
    assert (facts["last_user_id"], facts["last_line"], facts["n_rows"]) == (3, 5, 5)


def test_dense_ids(spark):
    r = ratings_df(spark, [(40, 1, 1.0), (7, 1, 1.0), (12, 2, 1.0), (7, 3, 2.0)])
    assert rows_of(sampling.dense_ids(r, "user_id", "new_id")) == [(7, 1), (12, 2), (40, 3)]


def test_min_activity_and_restrict(spark):
    rows = [(1, i, 3.0) for i in range(20)] + [(2, i, 3.0) for i in range(19)]
    r = ratings_df(spark, rows)
    kept = sampling.min_activity(r, 20)
    assert rows_of(sampling.kept_users(kept)) == [(1,)]
    users = spark.createDataFrame([(2,)], "user_id long")
    items = spark.createDataFrame([(0,), (1,)], "item_id long")
    assert rows_of(sampling.restrict(r, users, items), "user_id", "item_id") == [(2, 0), (2, 1)]


def test_exact_size_sample(spark):
    ids = spark.range(1000).withColumnRenamed("id", "item_id")
    s1 = rows_of(sampling.sample_ids(ids, "item_id", 37, seed=3))
    s2 = rows_of(sampling.sample_ids(ids.repartition(7), "item_id", 37, seed=3))
    assert len(s1) == 37 and s1 == s2
    assert s1 != rows_of(sampling.sample_ids(ids, "item_id", 37, seed=4))


def test_split_disjoint_and_complete(spark):
    r = ratings_df(spark, [(u, i, 3.0) for u in range(30) for i in range(20)])
    s = sampling.with_split(r, [0, 1])
    per = s.groupBy("seed", "user_id", "item_id").agg(F.count(F.lit(1)).alias("c"))
    assert per.filter("c != 1").count() == 0
    assert per.count() == 2 * 600
    sizes = {(x["seed"], x["part"]): x["n"] for x in sampling.split_sizes(s).collect()}
    for seed in (0, 1):
        assert sum(v for (sd, _), v in sizes.items() if sd == seed) == 600
        assert 0.5 < sizes[(seed, "train")] / 600 < 0.7
    # the same rows after a repartition
    again = sampling.with_split(r.repartition(5), [0, 1])
    assert rows_of(s) == rows_of(again)


def test_recommendation_lists_keep_rank_order(spark):
    from rateflow.operators.recommend import recommendation_lists

    recs = spark.createDataFrame(
        [(1, 2, 20, "b"), (1, 1, 10, "a"), (1, 3, 30, "c"), (2, 1, 10, "a")],
        "user_id long, rk int, item_id long, title string")
    got = {r["user_id"]: list(r["titles"]) for r in recommendation_lists(recs).collect()}
    assert got == {1: ["a", "b", "c"], 2: ["a"]}


@pytest.mark.parametrize("n", [1, 37, 500, 999, 1000, 1500])
def test_threshold_sample_equals_top_n(spark, n):
    ids = spark.range(1000).withColumnRenamed("id", "item_id")
    top = rows_of(sampling.sample_ids(ids, "item_id", n, seed=5, method="topn"))
    thr = rows_of(sampling.sample_ids(ids, "item_id", n, seed=5, method="threshold"))
    assert thr == top and len(thr) == min(n, 1000)


def test_sample_of_zero(spark):
    ids = spark.range(10).withColumnRenamed("id", "item_id")
    assert sampling.sample_ids(ids, "item_id", 0, method="threshold").count() == 0
    assert sampling.sample_ids(ids, "item_id", 0, method="topn").count() == 0


def test_sample_ratings_drop_first(spark):
    # two users with 21 ratings each on items 0..20; every id is drawn
    r = ratings_df(spark, [(u, i, 3.0) for u in (5, 9) for i in range(21)])
    users = spark.createDataFrame([(5,), (9,)], "user_id long")
    items = spark.createDataFrame([(i,) for i in range(21)], "item_id long")
    keep = sampling.sample_ratings(r, users, items, 2, 21, min_count=21)
    assert rows_of(keep.groupBy("user_id").count()) == [(1, 21), (2, 21)]
    # losing each user's first rating leaves 20 < 21: nobody passes
    assert sampling.sample_ratings(r, users, items, 2, 21, min_count=21, drop_first=True).count() == 0
    slipped = sampling.sample_ratings(r, users, items, 2, 21, min_count=20, drop_first=True)
    assert rows_of(slipped.groupBy("user_id").agg(F.min("item_id"))) == [(1, 1), (2, 1)]

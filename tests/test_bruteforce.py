"""Operators against plain-Python loops written from the definitions."""

import math
import random
from collections import defaultdict

import pytest
from conftest import ratings_df
from pyspark.sql import Window
from pyspark.sql import functions as F

from rateflow.operators.aggregates import user_histories, user_means
from rateflow.operators.ordering import number_rows, previous_row
from rateflow.operators.predict import knn_errors_by_k, predict_user_knn
from rateflow.operators.recommend import recommend_user_knn
from rateflow.operators.similarity import (
    co_rating_sums,
    neighbours_for_users,
    top_neighbours,
    user_similarity,
    co_ratings,
    sums_from_pairs,
)

HALF_STARS = [x / 2 for x in range(1, 11)]


def make_ratings(seed, n_users=40, n_items=25, density=0.45, hot_item=None):
    rnd = random.Random(seed)
    rows = []
    for u in range(n_users):
        for i in range(n_items):
            if rnd.random() < density or (hot_item is not None and i == hot_item):
                rows.append((u, i, rnd.choice(HALF_STARS)))
    return rows


def brute_similarity(rows):
    hist = defaultdict(dict)
    for u, i, r in rows:
        hist[u][i] = r
    users = sorted(hist)
    out = {}
    for a in range(len(users)):
        for b in range(a + 1, len(users)):
            u, v = users[a], users[b]
            common = sorted(set(hist[u]) & set(hist[v]))
            if not common:
                continue
            dot = sum(hist[u][i] * hist[v][i] for i in common)
            s1 = sum(hist[u][i] ** 2 for i in common)
            s2 = sum(hist[v][i] ** 2 for i in common)
            den = math.sqrt(s1) * math.sqrt(s2)
            out[(u, v)] = ((dot / den) if den else 0.0, len(common))
    return out, hist


def brute_neighbours(sim, k, min_common):
    lists = defaultdict(list)
    for (u, v), (s, n) in sim.items():
        if n >= min_common:
            lists[u].append((v, s, n))
            lists[v].append((u, s, n))
    return {u: sorted(lst, key=lambda x: (-x[1], x[0]))[:k] for u, lst in lists.items()}


def brute_predict(u, item, nbrs, hist, means, k):
    mu = means.get(u, 0.0)
    raters = [(v, s) for v, s, _ in nbrs.get(u, [])[:k] if item in hist.get(v, {})]
    weight = sum(abs(s) for _, s in raters)
    if not weight:
        return mu
    return mu + sum((hist[v][item] - means.get(v, 0.0)) * s for v, s in raters) / weight


def test_similarity_equals_loop(spark):
    rows = make_ratings(1)
    expect, _ = brute_similarity(rows)
    got = {(r["u"], r["v"]): (r["sim"], r["n"])
           for r in user_similarity(ratings_df(spark, rows)).collect()}
    assert got == expect  # exact: half-star sums do not depend on order


def test_strategies_and_salting_agree(spark):
    rows = make_ratings(2, hot_item=3)
    r = ratings_df(spark, rows)
    cols = ["u", "v", "dot", "s1", "s2", "n"]
    ref = sorted(tuple(x) for x in sums_from_pairs(co_ratings(r, salt_above=None)).select(cols).collect())
    salted = sorted(tuple(x) for x in sums_from_pairs(co_ratings(r, salt_above=7)).select(cols).collect())
    for b in (1, 2, 5):
        blocks = sorted(tuple(x) for x in co_rating_sums(r, blocks=b).select(cols).collect())
        assert blocks == ref
    assert salted == ref


def test_similarity_by_seed_key(spark):
    rows = make_ratings(3, n_users=15, n_items=10)
    r = ratings_df(spark, rows)
    two = r.withColumn("seed", F.explode(F.array(F.lit(0), F.lit(1))))
    got = co_rating_sums(two, by=["seed"], blocks=3)
    one = co_rating_sums(r, blocks=3)
    assert got.count() == 2 * one.count()
    a = sorted(tuple(x) for x in got.filter("seed = 1").drop("seed").collect())
    b = sorted(tuple(x) for x in one.collect())
    assert a == b


def test_neighbours_and_predictions_equal_loop(spark):
    rows = make_ratings(4, n_users=30, n_items=30, density=0.5)
    sim, hist = brute_similarity(rows)
    k, min_common = 5, 6
    nb_expect = brute_neighbours(sim, k, min_common)
    r = ratings_df(spark, rows)
    nbrs = top_neighbours(r, k, min_common)
    got = defaultdict(list)
    for x in nbrs.orderBy("user_id", "rk").collect():
        got[x["user_id"]].append((x["nb"], x["sim"], x["n"]))
    assert dict(got) == nb_expect

    means_py = {u: sum(h.values()) / len(h) for u, h in hist.items()}
    pairs = [(u, i) for u in range(32) for i in range(0, 30, 3)]
    pdf = spark.createDataFrame(pairs, "user_id long, item_id long")
    pred = predict_user_knn(pdf, nbrs, r, user_means(r), k=3).collect()
    for x in pred:
        want = brute_predict(x["user_id"], x["item_id"], nb_expect, hist, means_py, 3)
        assert x["prediction"] == pytest.approx(want, abs=1e-12)
    assert len(pred) == len(pairs)


def test_k_grid_equals_single_k(spark):
    rows = make_ratings(5, n_users=30, n_items=30, density=0.5)
    r = ratings_df(spark, rows)
    nbrs = top_neighbours(r, 8, 6)
    means = user_means(r)
    grid = {x["k"]: (x["rmse"], x["mae"], x["n"])
            for x in knn_errors_by_k(r, nbrs, r, means, [2, 5, 8]).collect()}
    from rateflow.operators.evaluate import errors
    for k in (2, 5, 8):
        pred = predict_user_knn(r.select("user_id", "item_id"), nbrs, r, means, k)
        e = errors(pred, r).collect()[0]
        assert grid[k][0] == pytest.approx(e["rmse"], abs=1e-12)
        assert grid[k][1] == pytest.approx(e["mae"], abs=1e-12)
        assert grid[k][2] == e["n"]


def test_recommendations_equal_loop(spark):
    rows = make_ratings(6, n_users=25, n_items=20, density=0.5)
    sim, hist = brute_similarity(rows)
    nb = brute_neighbours(sim, 6, 5)
    r = ratings_df(spark, rows)
    recs = recommend_user_knn(top_neighbours(r, 6, 5), r, k=6, n=4, digits=9).collect()
    got = defaultdict(list)
    for x in sorted(recs, key=lambda x: (x["user_id"], x["rk"])):
        got[x["user_id"]].append((x["item_id"], x["score"]))
    for u, lst in nb.items():
        of_item = {i: [(s, hist[v][i]) for v, s, _ in lst if i in hist[v]] for i in {i for v, _, _ in lst for i in hist[v]}}
        scores = {i: round(sum(s * r for s, r in own) / sum(s for s, _ in own), 9) for i, own in of_item.items()}
        cand = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:4]
        assert [i for i, _ in got[u]] == [i for i, _ in cand]
        assert [s for _, s in got[u]] == pytest.approx([s for _, s in cand], abs=1e-9)
    # ranks are 1..n without gaps
    for lst in got.values():
        assert len(lst) <= 4


def test_neighbours_for_users_match_full(spark):
    rows = make_ratings(7, n_users=30, n_items=25, density=0.5)
    r = ratings_df(spark, rows)
    full = top_neighbours(r, 7, 5).filter("user_id IN (3, 11)")
    users = spark.createDataFrame([(3,), (11,)], "user_id long")
    part = neighbours_for_users(r, users, 7, 5)
    key = ["user_id", "nb", "sim", "n", "rk"]
    assert sorted(tuple(x) for x in full.select(key).collect()) == \
        sorted(tuple(x) for x in part.select(key).collect())


def test_similarity_in_unit_range(spark):
    r = ratings_df(spark, make_ratings(8))
    bad = user_similarity(r).filter((F.col("sim") < 0) | (F.col("sim") > 1 + 1e-12))
    assert bad.count() == 0


def test_number_rows_equals_row_number(spark):
    df = spark.range(0, 500, 3).withColumn("g", F.col("id") % 4)
    got = number_rows(df, "id", "rn", rows_per_block=10)
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("id")).cast("bigint"))
    assert sorted(got.collect()) == sorted(want.select(got.columns).collect())
    assert number_rows(df.limit(0), "id").count() == 0


def test_numbering_spreads_skewed_ids(spark):
    """Dense ids and one far outlier: no partition above twice the mean."""
    from rateflow import session

    df = spark.range(2000).unionAll(spark.range(10**12, 10**12 + 1))
    got = number_rows(df, "id", "rn", rows_per_block=200)
    assert got.agg(F.max("rn"), F.count_distinct("rn")).first() == (2001, 2001)
    stored = spark.read.parquet(session._WRITTEN[spark.sparkContext.applicationId][-1])
    sizes = [r["count"] for r in stored.groupBy(F.shiftright("_id", 33).alias("p")).count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 2 * 2001 / len(sizes)


@pytest.mark.parametrize("blocks,top", [(1, 10_000), (40, 10_000), (40, 500), (300, 301)])
def test_previous_row_equals_lag(spark, blocks, top):
    rnd = random.Random(9)
    lines = sorted(rnd.sample(range(top), 300))  # with and without gaps
    df = spark.createDataFrame([(ln, rnd.randint(0, 5), rnd.randint(0, 9)) for ln in lines],
                               "line long, user_id long, item_id long")
    got = previous_row(df, "line", ["user_id", "item_id"], default=0, rows_per_block=blocks)
    w = Window.orderBy("line")
    want = df.select("line", "user_id", "item_id",
                     F.coalesce(F.lag("user_id").over(w), F.lit(0)).alias("prev_user_id"),
                     F.coalesce(F.lag("item_id").over(w), F.lit(0)).alias("prev_item_id"))
    assert sorted(got.collect()) == sorted(want.select(got.columns).collect())


def test_user_histories_positions(spark):
    rows = make_ratings(10, n_users=12, n_items=15)
    got = user_histories(ratings_df(spark, rows)).collect()
    per = defaultdict(list)
    for x in got:
        per[x["user_id"]].append((x["pos"], x["item_id"]))
    for u, lst in per.items():
        lst.sort()
        assert [p for p, _ in lst] == list(range(1, len(lst) + 1))
        assert [i for _, i in lst] == sorted(i for _, i in lst)

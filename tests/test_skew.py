"""A hot item holding a third of all ratings is spread over many tasks."""

import random

import pytest
from conftest import ratings_df, rows_of
from pyspark.sql import functions as F

from rateflow.operators.similarity import block_pair_sums, co_ratings


def hot_item_ratings(n_users=240, n_items=60, seed=3):
    rnd = random.Random(seed)
    rows = [(u, 0, rnd.choice([1.0, 2.5, 4.0])) for u in range(n_users)]  # the hot item
    for u in range(n_users):
        for i in rnd.sample(range(1, n_items), 2):
            rows.append((u, i, 3.0))
    return rows  # item 0 holds 1/3 of the rows and ~99% of the pairs


def _max_share(df):
    per = df.groupBy(F.spark_partition_id().alias("pid")).count().collect()
    total = sum(r["count"] for r in per)
    return max(r["count"] for r in per) / total, len(per)


@pytest.mark.parametrize("subset_copartition", ["true", "false"])
def test_salted_join_splits_hot_item(spark, subset_copartition):
    r = ratings_df(spark, hot_item_ratings())
    # On data this small AQE would broadcast one side and coalesce the
    # shuffle into one partition; look at the shuffled join used at scale.
    confs = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.requireAllClusterKeysForCoPartition": subset_copartition}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        plain = co_ratings(r, salt_above=None).filter("item_id = 0")
        salted = co_ratings(r, salt_above=30).filter("item_id = 0")
        assert plain.count() == salted.count() == 240 * 239 // 2
        share_plain, _ = _max_share(plain)
        share_salted, parts = _max_share(salted)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert share_plain == 1.0          # one task forms every pair of the hot item
    assert parts >= 4 and share_salted < 0.5


def test_block_pairs_spread_hot_item(spark):
    """Block pairs meet each user pair once, and their shares are even."""
    from rateflow.operators.similarity import block_pairs, user_vectors

    r = ratings_df(spark, hot_item_ratings())
    rows = block_pairs(user_vectors(r), 6, 8)
    pairs = rows.groupBy("p", "q", "side").count().collect()
    size = {(x["p"], x["q"], x["side"]): x["count"] for x in pairs}
    formed = {(p, q): size[p, q, False] * (size[p, q, True] if p < q else (size[p, q, False] - 1) / 2)
              for p, q, side in size if not side}
    assert len(formed) == 21 and sum(formed.values()) == 240 * 239 / 2
    assert max(formed.values()) / sum(formed.values()) < 0.15
    sums = block_pair_sums(r, blocks=6)
    assert sums.agg(F.sum("n")).first()[0] == co_ratings(r, salt_above=None).count()


def test_partitions_follow_the_cluster_not_the_block_pairs(spark):
    """Any number of block pairs is dealt evenly to a given number of partitions."""
    from rateflow.operators.similarity import block_pairs, user_vectors

    r = ratings_df(spark, hot_item_ratings())
    rows = block_pairs(user_vectors(r), 20, 7).withColumn("pid", F.spark_partition_id())
    per = rows.groupBy("pid").agg(F.count_distinct("p", "q").alias("n")).collect()
    assert len(per) == 7 and all(x["n"] == 30 for x in per)     # 210 pairs
    assert rows.groupBy("p", "q").agg(F.count_distinct("pid").alias("n")).where("n > 1").count() == 0
    many, few = (block_pair_sums(r, b, partitions=n) for b, n in ((20, 7), (3, 2)))
    assert rows_of(many) == rows_of(few)


def test_block_pairs_shuffle_vectors_only(spark):
    """No join or aggregate follows the block pairs; no exchange is by item."""
    import contextlib
    import io

    from rateflow.operators.similarity import block_pairs, user_vectors
    from rateflow.session import scoped_conf

    r = ratings_df(spark, hot_item_ratings(n_users=30))
    with scoped_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            block_pairs(user_vectors(r), 3, 4).explain()
    plan = buf.getvalue()
    first = plan.index("shufflepartitionidpassthrough")
    assert "Join" not in plan[:first] and "Aggregate" not in plan[:first]
    keys = [line for line in plan.splitlines() if "Exchange hashpartitioning(item_id" in line]
    assert keys and all("_share" in line for line in keys)


def test_hot_item_is_looked_up_in_shares(spark):
    from rateflow.operators.similarity import ORDER_SHARES, user_vectors

    r = ratings_df(spark, hot_item_ratings())
    vectors = {x["user_id"]: (x["items"], x["values"]) for x in user_vectors(r).collect()}
    counts = {}
    for _, i, _ in hot_item_ratings():
        counts[i] = counts.get(i, 0) + 1
    order = {i: n + 1 for n, i in enumerate(sorted(counts, key=lambda i: (counts[i], i)))}
    want = {}
    for u, i, x in hot_item_ratings():
        want.setdefault(u, []).append((order[i], x))
    assert vectors == {u: tuple(map(list, zip(*sorted(e)))) for u, e in want.items()}
    assert ORDER_SHARES > 1 and all(items[-1] == max(order.values()) for items, _ in vectors.values())


def test_block_count_follows_the_counts():
    from rateflow.operators.similarity import BLOCK_RATINGS, BLOCK_USERS, block_count

    for users, ratings in ((14_999, 586_871), (1_499_900, 58_687_100), (10_000, 10**9)):
        b = block_count(users, ratings, 8)
        assert users / b <= BLOCK_USERS and ratings / b <= BLOCK_RATINGS
    assert block_count(10, 100, 8) == 6 and block_count(3, 100, 8) == 3 and block_count(0, 0) == 1


def test_sums_keep_their_groups_apart(spark):
    """Two seeds in one job equal two jobs, also with null and text keys."""
    r = ratings_df(spark, hot_item_ratings(n_users=60))
    both = r.withColumn("seed", F.explode(F.array(F.lit(1), F.lit(2)))).where("seed = 1 OR user_id % 3 > 0")
    got = block_pair_sums(both.withColumn("name", F.when(F.col("seed") == 1, "a")), 4, ("seed", "name"), 1, partitions=3)
    for seed, part in ((1, r), (2, r.where("user_id % 3 > 0"))):
        own = got.where(F.col("seed") == seed)
        assert own.where(F.col("name").isNull() == (F.col("seed") == 1)).count() == 0
        assert rows_of(own.drop("seed", "name")) == rows_of(block_pair_sums(part, 2))


def test_sums_do_not_depend_on_the_blocks_for_any_ratings(spark):
    """Ratings that are not half stars: equal sums up to rounding."""
    rnd = random.Random(4)
    rows = [(u, i, rnd.random() * 5) for u in range(40) for i in rnd.sample(range(50), 20)]
    r = ratings_df(spark, rows)
    one, many = ({(x["u"], x["v"]): (x["dot"], x["s1"], x["s2"], x["n"]) for x in
                  block_pair_sums(r, blocks=b).collect()} for b in (1, 7))
    assert one.keys() == many.keys()
    for k, x in one.items():
        assert x == pytest.approx(many[k], rel=1e-12)


def test_salted_join_equals_plain_join_and_spreads(spark):
    from rateflow.operators.salting import salted_join

    hot = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(900)], "k long, x long")
    other = spark.createDataFrame([(k, y) for k in (0, 3, 6, 9) for y in range(5)], "k long, y long")
    want = rows_of(hot.join(other, "k"), "k", "x", "y")
    confs = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {c: spark.conf.get(c) for c in confs}
    for c, v in confs.items():
        spark.conf.set(c, v)
    try:
        got = salted_join(hot, other, ["k"], "x", salt_above=20)
        assert rows_of(got, "k", "x", "y") == want
        share, parts = _max_share(got.filter("k = 0"))
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert parts >= 4 and share < 0.5

"""Block pairs meet as packed rows: no pair row is shuffled, no sum is stored."""

import contextlib
import io

import numpy as np
import pytest
from conftest import ratings_df, rows_of
from test_overlap import block, plain, skewed
from test_skew import hot_item_ratings

from rateflow import session
from rateflow.operators import overlap
from rateflow.operators.similarity import _unpack, block_pair_sums, co_ratings, packed_blocks, sums_from_pairs


def test_only_packed_blocks_are_shuffled_and_nothing_is_stored(spark):
    r = ratings_df(spark, hot_item_ratings(n_users=60))
    with session.scratch(spark):
        got = block_pair_sums(r, 5)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            got.explain()
        plan = buf.getvalue()
        assert "CartesianProduct" not in plan and "Aggregate" not in plan
        before = list(session._WRITTEN[spark.sparkContext.applicationId])
        assert rows_of(got) == rows_of(sums_from_pairs(co_ratings(r, salt_above=None)).select(got.columns))
        assert session._WRITTEN[spark.sparkContext.applicationId] == before
        assert not any("co_rating_sums" in path for path in before)


@pytest.mark.parametrize("blocks", [1, 2, 3, 6])
def test_each_user_is_written_once(spark, blocks):
    r = ratings_df(spark, [(u, i, 0.1 if u == 3 else 2.5) for u in range(20) for i in range(u % 4 + 1)])
    with session.scratch(spark):
        path, schema = packed_blocks(r, blocks, (), 1, [{}])
        rows = [_unpack(x.users, x.sizes, x.items, x.ratings) for x in spark.read.schema(schema).parquet(path).collect()]
        assert sorted(np.concatenate([b.users for b in rows]).tolist()) == list(range(20))
        assert sum(b.sizes.sum() for b in rows) == r.count() == sum(len(b.ratings) for b in rows)
        assert sorted(x for b in rows for x in set(b.ratings.tolist())) [:1] == [0.1]
        assert rows_of(block_pair_sums(r, blocks)) == rows_of(block_pair_sums(r, 4))


@pytest.mark.parametrize("t", [1, 3])
def test_sums_come_in_stretches(monkeypatch, t):
    import random

    monkeypatch.setattr(overlap, "STRETCH", 200)
    for dense in (0, 1 << 20):
        monkeypatch.setattr(overlap, "DENSE", dense)
        users = skewed(random.Random(t), range(60), 60, 24)
        parts = list(overlap.pair_sum_parts(block(users), block(users), t, True))
        assert len(parts) > 3
        assert sorted(x for part in parts for x in zip(*(c.tolist() for c in part))) == plain(users, users, t, True)


def test_no_ratings(spark):
    assert block_pair_sums(ratings_df(spark, []), 3).count() == 0
    seeded = ratings_df(spark, []).selectExpr("1 AS seed", "*")
    assert block_pair_sums(seeded, 3, ["seed"]).columns == ["seed", "u", "v", "dot", "s1", "s2", "n"]


def test_null_users_have_no_pairs_and_null_ratings_no_weight(spark):
    rows = [(u, i, None if (u, i) == (1, 2) else float((u or 0) + i)) for u in (1, 2, 3, None) for i in range(1, 5)]
    r = ratings_df(spark, rows)
    want = sums_from_pairs(co_ratings(r, salt_above=None))
    got = block_pair_sums(r, 2)
    assert rows_of(got) == rows_of(want.select(got.columns)) and got.count() == 3


def test_key_groups_share_one_packed_block(spark):
    rows = [(u, i, float(1 + (u * i) % 9) / 2) for u in range(30) for i in range(40) if (u * 7 + i * 3) % 4]
    r = ratings_df(spark, rows)
    seeded = r.selectExpr("explode(array(3, 5, cast(null as int))) AS seed", "*").where(
        "(user_id * item_id + coalesce(seed, 7)) % 5 > 0")
    groups = seeded.select("seed").distinct().collect()
    with session.scratch(spark):
        path, schema = packed_blocks(seeded, 2, ["seed"], 1, groups)
        blocks = spark.read.schema(schema).parquet(path).collect()
        assert len(blocks) == 2
        once = seeded.select("user_id", "item_id").distinct().count()
        assert sum(_unpack(b.users, b.sizes, b.items, b.ratings).sizes.sum() for b in blocks) == once < seeded.count()
        got = block_pair_sums(seeded, 2, ["seed"], 3)
        assert got.schema["seed"].dataType == seeded.schema["seed"].dataType
        for g in groups:
            own = seeded.where(seeded.seed.eqNullSafe(g.seed)).drop("seed")
            want = sums_from_pairs(co_ratings(own, salt_above=None), (), 3)
            assert rows_of(got.where(got.seed.eqNullSafe(g.seed)), *want.columns) == rows_of(want)


def test_packed_ratings_are_small_and_exact(spark):
    rows = [(u, i * 977 + u % 5 - (3 if u == 2 else 0), float(1 + (u * i) % 10) / 2) for u in range(300) for i in range(1, 50)]
    with session.scratch(spark):
        path, schema = packed_blocks(ratings_df(spark, rows), 1, (), 1, [{}])
        (b,) = spark.read.schema(schema).parquet(path).collect()
        assert sum(len(x) for x in (b.users, b.sizes, b.items, b.ratings, b.groups)) < 4 * len(rows)
        found = _unpack(b.users, b.sizes, b.items, b.ratings)
        ratings = {(u, i): x for u, i, x in rows}
        order = sorted({i for _, i, _ in rows}, key=lambda i: (sum(1 for x in rows if x[1] == i), i))
        place = min(found.items)
        assert {(u, order[i - place]): x for u, i, x in zip(found.users[found.owner].tolist(), found.items.tolist(),
                                                             found.ratings.tolist())} == ratings

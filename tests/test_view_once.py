"""Queries that read the rating view several times form it once."""

import contextlib
import io
import os

import pytest
from conftest import ratings_df, rows_of
from pyspark.sql import functions as F

from rateflow import session
from rateflow.operators.similarity import co_ratings, neighbours_for_users, top_neighbours, user_vectors
from rateflow.plans.catalog import QUERIES


def plan_of(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture
def tables(spark, scratch):
    lines = [(u, i, float((u * i) % 50 + 1)) for u in range(1, 13) for i in range(1, 31) if (u + i) % 5]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_quantity double").select(
        "*", F.lit(1).alias("l_partkey"), F.lit(1).alias("l_linenumber"), F.lit("1995-01-01").alias("l_shipdate")
    ).write.parquet(os.path.join(scratch, "lineitem.parquet"))
    spark.range(1, 13).select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey")).write.parquet(
        os.path.join(scratch, "orders.parquet"))
    spark.range(1, 31).select(F.col("id").alias("s_suppkey"), F.concat(F.lit("s"), "id").alias("s_name")).write.parquet(
        os.path.join(scratch, "supplier.parquet"))
    return scratch


@pytest.mark.parametrize("name", ["knn_recommendations_for_user", "als_recommendations", "als_recommendations_all"])
def test_the_view_is_formed_once(spark, tables, name):
    with session.scratch(spark):
        got = QUERIES[name](spark, tables)
        assert "lineitem" not in plan_of(got)
        got.collect()


def test_pairs_form_the_view_once(spark, tables):
    with session.scratch(spark):
        got = QUERIES["co_rating_pairs"](spark, tables)
        plan = plan_of(got)
        assert "lineitem" not in plan
        keys = [line for line in plan.splitlines() if "Exchange hashpartitioning(item_id" in line]
        assert len(keys) == 2 and all("_p" in line for line in keys), plan     # dealt by item and salt, no more
        want = co_ratings(QUERIES["ratings"](spark, tables), salt_above=None).select(got.columns)
        assert got.count() > 0 and rows_of(got) == rows_of(want)


def test_pairs_of_a_few_hot_items_and_of_none(spark):
    # Item 0 is hot; ratings without an item or a user pair with nothing.
    r = ratings_df(spark, [(u, i, float(1 + u % 5)) for u in range(30) for i in (0, u % 4 + 1)]
                   + [(None, 0, 1.0), (3, None, 2.0), (4, None, 2.0)])
    with session.scratch(spark):
        for salt in (7, 20, 1000):
            got = co_ratings(r, salt_above=salt)
            want = co_ratings(r, salt_above=None).select(got.columns)
            assert rows_of(got) == rows_of(want) and got.where("item_id = 0").count() == 30 * 29 // 2


def test_ratings_of_other_items_are_not_moved(spark):
    r = ratings_df(spark, [(u, i, float(1 + (u * i) % 5)) for u in range(12) for i in range(u % 3, 40, 2)])
    users = spark.createDataFrame([(1,), (4,)], "user_id long")
    got = neighbours_for_users(r, users, 5, 2)
    plan = plan_of(got)
    assert any("LeftSemi" in line and "item_id" in line for line in plan.splitlines()), plan
    with session.scratch(spark):
        want = top_neighbours(r, 5, 2).join(users, "user_id", "left_semi")
        assert rows_of(got, "user_id", "nb", "n", "rk") == rows_of(want, "user_id", "nb", "n", "rk")


def test_the_order_of_the_items_is_not_broadcast(spark):
    # Copied to its shares it is 32 times what its size before tells.
    r = ratings_df(spark, [(u, i, 3.0) for u in range(12) for i in range(20) if (u + i) % 3])
    with session.scratch(spark):
        got = user_vectors(r, (), 2)
        joins = [line for line in plan_of(got).splitlines() if "Join" in line and "_share" in line]
        assert len(joins) == 1 and "ShuffledHashJoin" in joins[0], joins
        assert rows_of(got.selectExpr("user_id", "size(items) n")) == [(u, sum((u + i) % 3 > 0 for i in range(20))) for u in range(12)]

"""Ordered files, counted imports, build-once tables, and the life of scratch tables."""

import os

import pytest
from conftest import SF_SMALL, ratings_df, rows_of
from pyspark.sql import functions as F

from rateflow import session
from rateflow.operators.quality import histogram, weighted_histogram
from rateflow.sources.sinks import build_once, fingerprint, import_ratings, manifest, write_ratings


def lines_of(path):
    return [line.rstrip("\n") for name in sorted(os.listdir(path)) if name.startswith("part-")
            for line in open(os.path.join(path, name))]


def test_ordered_file_with_a_header(spark, scratch):
    rows = [(u, i, (u * i) % 10 / 2 + 0.5) for u in range(40, 0, -1) for i in (5, 3, 9)]
    write_ratings(ratings_df(spark, rows).repartition(5), f"{scratch}/r", "csv", order=["user_id", "item_id"], header=True)
    assert lines_of(f"{scratch}/r") == ["userId,movieId,rating", *(f"{u},{i},{x:.1f}" for u, i, x in sorted(rows))]


def test_import_counts_every_line_in_its_pass(spark, scratch):
    os.mkdir(f"{scratch}/in")
    for name, text in (("a.csv", "userId,movieId,rating\n1,2,3.5\n\n7\n"), ("b.csv", "1,3,4.0,99\n2,2,nan\n 5 , 6 , 1.5\n"), ("c.csv", "")):
        with open(f"{scratch}/in/{name}", "w") as f:
            f.write(text)
    done = import_ratings(spark, f"{scratch}/in", f"{scratch}/out")
    name = F.regexp_extract("file", "([a-z]).csv$", 1).alias("f")
    assert rows_of(done.ratings.select(name, "user_id", "item_id", "rating")) == [("a", 1, 2, 3.5), ("b", 1, 3, 4.0), ("b", 5, 6, 1.5)]
    assert rows_of(done.rejects.select(name, "value")) == [("a", ""), ("a", "7"), ("a", "userId,movieId,rating"), ("b", "2,2,nan")]
    assert done.counts == {"lines": 7, "accepted": 3, "rejected": 4}
    with pytest.raises(Exception, match="(?i)exists"):
        import_ratings(spark, f"{scratch}/in", f"{scratch}/out")


def test_fingerprint_ignores_order_and_sees_every_change(spark):
    rows = [(1, 2, 3.0), (1, 3, 4.0), (2, 2, None), (2, 2, None)]
    df = ratings_df(spark, rows)
    same = fingerprint(df)
    assert fingerprint(ratings_df(spark, rows[::-1]).repartition(3)) == same
    for other in (rows[:3], [*rows, rows[0]], [(1, 2, 3.5), *rows[1:]], [(2, 1, 3.0), *rows[1:]], []):
        assert fingerprint(ratings_df(spark, other)) != same
    assert fingerprint(df.withColumnRenamed("rating", "value")) != same


def test_build_once_reuses_rebuilds_and_leaves_no_half_tables(spark, scratch):
    df, calls = ratings_df(spark, [(1, 2, 3.0), (2, 2, 4.0)]), []

    def build():
        calls.append(1)
        return df

    first = build_once(spark, scratch, "t", build, [df], {"k": 1})
    again = build_once(spark, scratch, "t", build, [df.orderBy(F.desc("user_id"))], {"k": 1})
    other = build_once(spark, scratch, "t", build, [df], {"k": 2})
    assert (first.built, again.built, other.built, len(calls)) == (True, False, True, 2)
    assert first.path == again.path != other.path and rows_of(again.table) == rows_of(df)
    assert manifest(spark, other.path)["params"] == {"k": 2}

    def fails():
        return df.withColumn("x", F.raise_error(F.lit("no")))

    with pytest.raises(Exception, match="no"):
        build_once(spark, scratch, "t", fails, [df], {"k": 3})
    assert build_once(spark, scratch, "t", build, [df], {"k": 3}).built


def test_second_of_two_builders_takes_the_first_result(spark, scratch):
    df = ratings_df(spark, [(1, 2, 3.0)])

    def slow():     # another builder finishes meanwhile
        assert build_once(spark, scratch, "t", lambda: df, [df]).built
        return df

    late = build_once(spark, scratch, "t", slow, [df])
    assert not late.built and rows_of(late.table) == rows_of(df)
    assert not [n for n in os.listdir(f"{scratch}/t") if n.startswith("_stage")]
    assert not [n for n in os.listdir(late.path) if n.startswith("_stage")]


def test_scratch_tables_go_at_the_end_of_their_block(spark):
    kept = session.write_and_read(spark.range(3), "kept")
    with session.scratch(spark):
        inner = session.write_and_read(spark.range(5), "inner")
        assert inner.count() == 5
    with pytest.raises(Exception, match="(?i)not.*exist|not found"):
        inner.count()
    assert kept.count() == 3
    session.release(spark)
    with pytest.raises(Exception, match="(?i)not.*exist|not found"):
        kept.count()


@pytest.mark.parametrize("values", [[5, 5, 5], [0, 1, 2, 3, 4], [1], [3, 9, 9, 9, 40, 41], []])
@pytest.mark.parametrize("buckets", [1, 2, 20])
def test_weighted_histogram_equals_the_plain_one(spark, values, buckets):
    df = spark.createDataFrame([(v,) for v in values], "x long")
    freq = df.groupBy("x").agg(F.count("*").alias("n"))
    assert rows_of(weighted_histogram(freq, "x", "n", buckets)) == rows_of(histogram(df, "x", buckets))


def test_activity_histogram_scans_the_ratings_once(spark):
    import contextlib
    import io

    from rateflow.plans.catalog import QUERIES

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES["user_activity_histogram"](spark, SF_SMALL).explain()
    assert buf.getvalue().count("FileScan parquet") == 2      # line items and orders

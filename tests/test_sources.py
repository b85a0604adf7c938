"""Readers, writers, reuse, model save/load."""

import os

from conftest import ratings_df, rows_of

from rateflow.operators.aggregates import dedupe_ratings
from rateflow.sources import item_genres, read_items, read_ratings, reuse_or_build, write_ratings


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_read_ratings_with_header_and_bad_rows(spark, scratch):
    p = _write(os.path.join(scratch, "r.csv"),
               "userId,movieId,rating,timestamp\n1,10,4.0,111\n2,20,3.5,222\n"
               "x,1,3.0\n1,2\n1,2,nan\n3,30,5.0,333,extra\n 4 ,40,2.5\n5,50,5.0\n")
    good, bad = read_ratings(spark, p, with_rejects=True)
    assert rows_of(good, "user_id", "item_id", "rating") == [
        (1, 10, 4.0), (2, 20, 3.5), (3, 30, 5.0), (4, 40, 2.5), (5, 50, 5.0)]
    # header, non-integer id, missing field, NaN rating
    assert bad.count() == 4


def test_read_ratings_parquet(spark, scratch):
    out = os.path.join(scratch, "p")
    ratings_df(spark, [(1, 2, 3.0)]).write.parquet(out)
    assert rows_of(read_ratings(spark, out, fmt="parquet"), "user_id", "item_id", "rating") == [(1, 2, 3.0)]


def test_read_items_quoted_title(spark, scratch):
    p = _write(os.path.join(scratch, "m.csv"),
               'movieId,title,genres\n1,Toy Story (1995),Adventure|Animation\n'
               '11,"American President, The (1995)",Comedy|Drama\n'
               'movieId,title,genres\n')
    items = read_items(spark, p)
    got = {r["item_id"]: (r["title"], list(r["genres"])) for r in items.collect()}
    assert got == {1: ("Toy Story (1995)", ["Adventure", "Animation"]),
                   11: ("American President, The (1995)", ["Comedy", "Drama"])}
    naive = {r["item_id"]: r["title"] for r in read_items(spark, p, naive=True).collect()}
    assert naive[11] == '"American President'
    genres = rows_of(item_genres(items), "item_id", "genre_pos", "genre")
    assert genres[-2:] == [(11, 1, "Comedy"), (11, 2, "Drama")]


def test_write_csv_round_trip(spark, scratch):
    out = os.path.join(scratch, "small")
    write_ratings(ratings_df(spark, [(1, 2, 3.0), (3, 4, 0.5)]), out, fmt="csv")
    lines = sorted(r["value"] for r in spark.read.text(out).collect())
    assert lines == ["1,2,3.0", "3,4,0.5"]
    assert rows_of(read_ratings(spark, out), "user_id", "item_id", "rating") == [(1, 2, 3.0), (3, 4, 0.5)]


def test_reuse_or_build(spark, scratch):
    out = os.path.join(scratch, "cached")
    calls = []

    def build():
        calls.append(1)
        return ratings_df(spark, [(1, 1, 1.0)])

    a = reuse_or_build(spark, out, build)
    b = reuse_or_build(spark, out, build)
    assert len(calls) == 1 and rows_of(a) == rows_of(b)


def test_dedupe_latest_wins(spark):
    df = spark.createDataFrame([(1, 1, 2.0, 10), (1, 1, 4.0, 20), (1, 1, 5.0, 15), (2, 1, 1.0, 1)],
                               "user_id long, item_id long, rating double, rated_at long")
    assert rows_of(dedupe_ratings(df), "user_id", "item_id", "rating") == [(1, 1, 4.0), (2, 1, 1.0)]


def test_check_rating_file_facts(spark, scratch):
    """Seven rating lines after a header; what is expected is stated by hand."""
    from rateflow.operators.quality import check_file_order
    from rateflow.sources import read_rating_lines

    text = ("userId,movieId,rating,timestamp\n"
            "1,2,3.5,1\n1,29,3.5,1\n1,10,4.0,1\n2,5,3.0,1\n4,1,5.0,1\n3,7,1.0,1\n3,8,2.0,1\n")
    p = _write(os.path.join(scratch, "ratings.csv"), text)
    got = check_file_order(read_rating_lines(spark, p))
    # Users go 1 1 1 2 4 3 3 on lines 2 to 8.
    assert rows_of(got["user_steps"], "prev_user_id", "user_id", "line") == [(2, 4, 6), (4, 3, 7)]
    # Only user 1 has a falling item: 29, then 10 on line 4.
    assert rows_of(got["item_order"], "prev_item_id", "item_id", "line") == [(29, 10, 4)]
    assert rows_of(got["values"], "rating", "n") == [(1.0, 1), (2.0, 1), (3.0, 1), (3.5, 2), (4.0, 1), (5.0, 1)]
    last = got["last"].collect()[0]
    assert (last["last_user_id"], last["last_line"], last["n_rows"]) == (3, 8, 7)
    flags = got["flags"].collect()[0]
    assert (flags["user_order_ok"], flags["user_step_ok"], flags["item_order_ok"]) == (False, False, False)


def test_short_and_odd_lines_are_rejected(spark, scratch):
    from rateflow.sources import parse_rating_lines, read_rating_lines

    p = _write(os.path.join(scratch, "r.csv"), "u,i,r\n1,2,3.5\n5\n\n5,x,nan\n6,1,inf\n7,1\n8,9,4.0,99\n")
    assert rows_of(read_rating_lines(spark, p)) == [(2, 1, 2, 3.5), (8, 8, 9, 4.0)]
    good, bad = parse_rating_lines(spark.read.text(p))
    assert rows_of(good, "user_id", "item_id", "rating") == [(1, 2, 3.5), (8, 9, 4.0)]
    assert sorted(r["value"] for r in bad.collect()) == ["", "5", "5,x,nan", "6,1,inf", "7,1", "u,i,r"]


def test_folder_lines_are_numbered_by_file_name(spark, scratch):
    from rateflow.sources import read_lines

    _write(os.path.join(scratch, "part-00000.csv"), "a\nb\n")
    _write(os.path.join(scratch, "part-00001.csv"), "".join(f"c{i}\n" for i in range(5000)))
    _write(os.path.join(scratch, "part-00002.csv"), "z\n")
    lines = {r["value"]: r["line"] for r in read_lines(spark, scratch).collect()}
    assert (lines["a"], lines["b"], lines["c0"], lines["c4999"], lines["z"]) == (1, 2, 3, 5002, 5003)


def test_typed_parquet_keeps_its_types(spark, scratch):
    import datetime as dt

    rows = [(1, 2, 3.0, dt.date(1995, 1, 2)), (1, 3, float("nan"), dt.date(1995, 1, 3)), (None, 3, 1.0, None)]
    path = os.path.join(scratch, "typed")
    spark.createDataFrame(rows, "user_id long, item_id long, rating double, rated_at date").write.parquet(path)
    good, bad = read_ratings(spark, path, "parquet", with_rejects=True)
    assert [tuple(r) for r in good.collect()] == [rows[0]]
    assert bad.count() == 2


def test_unfinished_folder_is_refused(spark, scratch):
    import pytest
    from rateflow.sources import reuse_or_build

    path = os.path.join(scratch, "built")
    build = lambda: spark.range(3)
    assert reuse_or_build(spark, path, build).count() == 3
    assert reuse_or_build(spark, path, lambda: spark.range(99)).count() == 3
    os.remove(os.path.join(path, "_SUCCESS"))
    with pytest.raises(ValueError, match="_SUCCESS"):
        reuse_or_build(spark, path, build)

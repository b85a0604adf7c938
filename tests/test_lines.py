"""Rating lines and splits hold each text and hash once per row."""

from conftest import rows_of
from pyspark.sql import functions as F

from rateflow.operators.sampling import with_split
from rateflow.sources import files
from rateflow.plans import catalog
from test_view_once import plan_of


def test_spoilt_lines_have_the_texts_of_the_formats(spark, monkeypatch):
    ids = [None, 0, -7, 3, 41, 2**40]
    ratings = [None, 0.0, 0.5, 5.0, -2.5, 999999.5, 1e6, 12345678.5, 3.3, 2.25, float("nan"), float("inf")]
    view = spark.createDataFrame([(u, i, r) for u in ids for i in (*ids, 5) for r in ratings],
                                 "user_id long, item_id long, rating double")
    monkeypatch.setattr(catalog, "_r", lambda spark, d: view)
    u, i = F.col("user_id"), F.col("item_id")
    texts = [F.format_string("%d", u), F.format_string("%d,x,nan", u), F.format_string("%d,%d,nan", u, i),
             F.format_string("u,%d,3.0", i), F.lit("")]
    value = F.format_string("%d,%d,%.1f", u, i, "rating")
    for n, text in enumerate(texts):
        value = F.when((u * 31 + i) % 11 == n, text).otherwise(value)
    got, want = catalog._spoilt_lines(spark, ""), view.select("user_id", "item_id", value.alias("value"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    plan = plan_of(got)
    assert "%d" not in plan


def test_a_split_hashes_a_row_once(spark):
    rows = spark.range(200).selectExpr("id AS user_id", "id * 7 AS item_id", "2.5D AS rating")
    split = with_split(rows, (0, 4))
    assert plan_of(split).count("md5(") == 1
    assert split.columns == ["user_id", "item_id", "rating", "seed", "part"]
    alone = with_split(rows, 4)
    assert rows_of(split.where("seed = 4").select("user_id", "part")) == rows_of(alone.select("user_id", "part"))


def test_words_are_typed_like_a_cast_and_not_parsed_as_numbers(spark):
    texts = ["1.5", " 2 ", "nan", "NaN", "+nan", "-NaN", "inf", "-Inf", "+infinity", "Infinity", "infinit", "nan\r", "\tnan", "inf ",
             "1e400", "-1e400", "3.5d", "4f", "0x1p3", "x", "rating", "Rating", "", " ", None, "-", ".5", "5.", "1,5", "\u0663", "null", "3 4"]
    lines = spark.createDataFrame([(t,) for t in texts], "rating string")
    found = lines.select("rating", F.expr(files._double("rating")).alias("x"), F.expr("try_cast(trim(rating) AS DOUBLE)").alias("y"))
    assert [(t, a, b) for t, a, b in map(tuple, found.collect()) if repr(a) != repr(b)] == []
    good, bad = files.parse_rating_lines(spark.createDataFrame([(f"1,2,{t}",) for t in texts if t is not None], "value string"))
    numbers = [t for t, x in found.select("rating", "y").collect() if t is not None and x is not None and abs(x) < float("inf")]
    assert sorted(r.value[4:] for r in bad.collect()) == sorted(t for t in texts if t is not None and t not in numbers and t != "1,5")
    assert good.count() == len(numbers) + 1     # "1,5" is a rating of 1 and a further field
    plan = plan_of(bad)
    assert plan.count("isnan") == 0 and plan.count("split(") == 1

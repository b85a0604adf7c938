"""Recommendation: popularity, user kNN, titles, unrated items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateflow.operators.aggregates import item_stats
from rateflow.operators.salting import salted_join


def popular_items(ratings: DataFrame, items: DataFrame, min_count: int = 100,
                  n: int = 30) -> DataFrame:
    """Highest mean rating among items with more than ``min_count`` ratings.

    ``item_id, title, mean_rating, n``; ties by item id.  Items without a
    title and titles without ratings drop out (inner join).  Planned as a
    map-side-combined aggregate, a join and a top-n.
    """
    stats = item_stats(ratings).filter(F.col("n") > F.lit(min_count))
    named = stats.join(items.select("item_id", "title"), "item_id")
    return (named.orderBy(F.desc("mean_rating"), F.asc("item_id")).limit(n)
            .select("item_id", "title", "mean_rating", "n"))


def recommend_user_knn(neighbours: DataFrame, ratings: DataFrame, k: int = 200,
                       n: int = 30, exclude_rated: bool = False,
                       by: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    """Per user, the ``n`` items with the best ``sum(sim*r)/sum(sim)`` over
    the first ``k`` neighbours that rated them.

    Items the user rated are kept unless ``exclude_rated``.  With ``digits``
    the score is rounded before ranking, so near-ties rank by item id.
    Output ``*by, user_id, rk, item_id, score``.
    """
    by = list(by)
    nb = neighbours.filter(F.col("rk") <= F.lit(k)).select(*by, "user_id", "nb", "sim")
    rated = ratings.select(*by, F.col("user_id").alias("nb"), "item_id", "rating")
    # A user in very many neighbour lists is a hot key.
    terms = salted_join(nb, rated, [*by, "nb"], "user_id")
    agg = (terms.groupBy(*by, "user_id", "item_id")
           .agg(F.sum(F.col("sim") * F.col("rating")).alias("_ws"), F.sum("sim").alias("_ss"))
           .filter(F.col("_ss") != 0))
    score = F.col("_ws") / F.col("_ss")
    if digits is not None:
        score = F.round(score, digits)
    agg = agg.select(*by, "user_id", "item_id", score.alias("score"))
    if exclude_rated:
        agg = agg.join(ratings.select(*by, "user_id", "item_id"),
                       [*by, "user_id", "item_id"], "left_anti")
    w = Window.partitionBy(*by, "user_id").orderBy(F.desc("score"), F.asc("item_id"))
    return (agg.withColumn("rk", F.row_number().over(w))
            .filter(F.col("rk") <= F.lit(n))
            .select(*by, "user_id", "rk", "item_id", "score"))


def attach_titles(recs: DataFrame, items: DataFrame) -> DataFrame:
    """Add ``title``; an id missing from the catalogue gets a null title."""
    return recs.join(items.select("item_id", "title"), "item_id", "left")


def recommendation_lists(recs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per user with the titles in rank order: ``*by, user_id, titles``.

    Only for output: each list holds at most the ``n`` ranked rows of one
    user, so the collected group is bounded by ``n``, not by the data.
    """
    ordered = F.array_sort(F.collect_list(F.struct("rk", "title")))
    return recs.groupBy(*by, "user_id").agg(
        F.transform(ordered, lambda x: x["title"]).alias("titles"))


def unrated_items(ratings: DataFrame, items: DataFrame, user_id: int) -> DataFrame:
    """``user_id, item_id`` for catalogue items the user has not rated."""
    own = ratings.filter(F.col("user_id") == F.lit(user_id)).select("item_id")
    return (items.select("item_id").distinct()
            .join(own, "item_id", "left_anti")
            .select(F.lit(user_id).cast("bigint").alias("user_id"), "item_id"))

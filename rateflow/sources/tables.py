"""Rating, item and ordered-row views over the driver's parquet tables.

The test tables are TPC-H-like, so ratings are modelled as "customer rates
supplier":

* ``user_id``  = ``orders.o_custkey``
* ``item_id``  = ``lineitem.l_suppkey``
* ``rating``   = ``ceil(l_quantity / 5) / 2`` (quantities 1..50 give the ten
  half stars 0.5 .. 5.0)
* ``rated_at`` = ``l_shipdate``

One rating per (user, item): the latest line wins, with a total order on
ties (ship date, order key, line number, part key, quantity, all
descending).  The dedupe is a ``max(struct)`` aggregate, so a hot pair is
combined map-side instead of being sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rateflow.session import sf_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(sf_path(sf_dir, name))


def tpch_ratings(spark: SparkSession, sf_dir: str, with_time: bool = False) -> DataFrame:
    """The rating view, lazy; persist it (and release it) where it is reused."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = li.join(orders, li["l_orderkey"] == orders["o_orderkey"])
    latest = (joined
              .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_suppkey").alias("item_id"))
              .agg(F.max(F.struct("l_shipdate", "l_orderkey", "l_linenumber",
                                  "l_partkey", "l_quantity")).alias("m")))
    cols = [
        "user_id", "item_id",
        (F.ceil(F.col("m.l_quantity") / 5) / 2).cast("double").alias("rating"),
    ]
    if with_time:
        cols.append(F.col("m.l_shipdate").alias("rated_at"))
    return latest.select(*cols)


def tpch_rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ratings, several of one (user, item) included, with the ``occurrence``
    number of each among them in the order of time (the last one is that of
    :func:`tpch_ratings`)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    order = Window.partitionBy("user_id", "item_id").orderBy(
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return (li.join(orders, li["l_orderkey"] == orders["o_orderkey"])
            .withColumnsRenamed({"o_custkey": "user_id", "l_suppkey": "item_id"})
            .select("user_id", "item_id", (F.ceil(F.col("l_quantity") / 5) / 2).cast("double").alias("rating"),
                    F.row_number().over(order).alias("occurrence")))


def tpch_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item catalogue: suppliers, titled by supplier name."""
    return read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("item_id"), F.col("s_name").alias("title"))


def tpch_items_with_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue with a genre list: parts, genres = words of the part name."""
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"),
        F.split("p_name", " ").alias("genres"))


def tpch_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole user id domain (customers with or without ratings)."""
    return read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in file order for the order checks: ``line, user_id, item_id``."""
    return read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("line"), "user_id",
        F.floor("value").cast("bigint").alias("item_id"))

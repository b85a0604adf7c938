"""Connected components of a link table by alternating large and small stars.

Each round sends every node's larger neighbours, then its smaller ones, to the
smallest neighbour; after a few rounds every node points at the smallest node
it can reach.  All of it is joins and aggregates; a node with very many links
is split by the skew handling of the join, and its minimum is pre-aggregated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.llm.common import written


def _least(edges: DataFrame) -> DataFrame:
    """``u, m`` with the least of each ``u`` and its neighbours ``v``."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every id of ``links`` (columns ``a, b``), where
    ``component`` is the smallest id reachable.  Links of an id with itself or
    with null, and repeated links, change nothing; no links give no rows."""
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(ordered, "links")
    before, now = None, _state(edges)
    while before != now and now[0]:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = _least(large)
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        edges = written(small, "links")
        # Edges that stay as they are: a star for each component.
        before, now = now, _state(edges)
    roots = edges.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(roots)

"""Shards of near-equal bytes by a k-d tree (DataFrame functions only).

Every row is a point of metadata: size in bytes, characters, source, language
and place of its id.  A node that stands for s shards is split along its
widest dimension (its range as a share of the whole table's) at the weighted
quantile that leaves floor(s/2)/s of its bytes on one side, until each leaf is
one shard.  The quantile is found for all nodes of a level at once: rows are
summed by (node, bin) and the bin that holds the quantile is divided again,
until that bin weighs less than 1/TOLERANCE of a shard or holds a single key.
A key is the dimension's value followed by 32 bits of a hash of the row, so
equal metadata (one source with a third of all rows) divides as well as any.

Only metadata takes part: a table of a few numbers per row is written once
and scanned for each round; per round the driver gets one row per node.

Edge cases: a null text has size 8 (no bytes) and the CRC of the empty text; null
metadata counts as 0; rows that repeat a ``doc_id`` are rows of their own; an
empty table gives an empty result; shards beyond the rows stay empty; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rateflow.llm.common import documents, local_table, text_of, written

SHARDS = 24
BINS = 4096
TOLERANCE = 1000
DIMENSIONS = ("_place", "_source", "_lang", "_chars", "_size")


def points(docs: DataFrame) -> DataFrame:
    """Row id, size, checksum and the dimensions (31-bit integers) of each row."""
    body = text_of(docs)
    whole = F.crc32(body.cast("binary"))
    category = lambda c: F.coalesce(F.shiftright(F.crc32(F.col(c).cast("binary")), 1), F.lit(0))
    bounded = lambda c: F.coalesce(F.least(F.greatest(c, F.lit(0)), F.lit(2**31 - 1)), F.lit(0))
    has = lambda c, value, other: value if c in docs.columns else F.lit(other)
    return docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(body) + 8).cast("long").alias("size"), whole.alias("text_crc32"),
        bounded(F.octet_length(body).cast("long")).alias("_size"),
        bounded(F.length(body).cast("long")).alias("_chars"),
        has("source", category("source") if "source" in docs.columns else None, 0).cast("long").alias("_source"),
        has("lang", category("lang") if "lang" in docs.columns else None, 0).cast("long").alias("_lang"),
        F.shiftright(F.xxhash64("doc_id", whole, F.monotonically_increasing_id()), 32)
        .bitwiseAND(2**32 - 1).alias("_tie"))


def kd_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, shard, slot``."""
    spark = docs.sparkSession
    rows = written(points(docs), "shard-points")
    ends = rows.agg(F.min("doc_id"), F.max("doc_id"), F.sum("size")).first()
    low, high, total = (ends[i] or 0 for i in range(3))
    place = ((F.coalesce(F.col("doc_id"), F.lit(low)).cast("double") - low) / max(1.0, float(high) - low)
             * (2**31 - 1)).cast("long")
    rows = rows.withColumn("_place", place)
    spans = rows.agg(*[(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]).first()
    dealt = rows.select("_row", "doc_id", "size", "text_crc32", "_tie", F.array(*DIMENSIONS).alias("_at"),
                        F.lit(1).alias("_node"))

    # Nodes have heap numbers (the root is 1) and stand for (first shard, number of shards).
    level, leaves = {1: (0, shards)}, []
    while level:
        leaves += [(n, first) for n, (first, s) in level.items() if s == 1]
        level = {n: x for n, x in level.items() if x[1] > 1}
        if not level:
            break
        facts = {r["_node"]: r for r in dealt.groupBy("_node").agg(
            F.sum("size").alias("_bytes"), *[(F.max(F.col("_at")[i]) - F.min(F.col("_at")[i])).alias(d)
                                             for i, d in enumerate(DIMENSIONS)]).collect()}
        widest = {n: max(range(len(DIMENSIONS)), key=lambda i: facts[n][DIMENSIONS[i]] / (spans[i] or 1)
                         if n in facts else 0) for n in level}
        aims = {n: (facts[n]["_bytes"] if n in facts else 0) * (level[n][1] // 2) / level[n][1] for n in level}
        split = _quantiles(dealt, widest, aims, max(1, total // shards // TOLERANCE))
        splits = local_table(spark, [(n, widest[n], split[n]) for n in level], "_node int, _dim int, _split long")
        dealt = (dealt.join(F.broadcast(splits), "_node", "left")
                 .withColumn("_node", F.when(F.col("_split").isNull(), F.col("_node"))
                             .otherwise(2 * F.col("_node") + (_key() >= F.col("_split")).cast("int")))
                 .drop("_dim", "_split"))
        level = {child: x for n, (first, s) in level.items()
                 for child, x in ((2 * n, (first, s // 2)), (2 * n + 1, (first + s // 2, s - s // 2)))}

    names = local_table(spark, leaves, "_node int, shard int")
    dealt = dealt.join(F.broadcast(names), "_node").withColumn("_part", F.shiftright("_row", 33))
    counts = dealt.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("shard", "_part").orderBy("_row")
    return (dealt.withColumn("_own", F.row_number().over(own) - 1).join(offsets, ["shard", "_part"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("_before") + F.col("_own")).alias("slot")))


def _key() -> Column:
    """The dimension's value, then the tie bits: one ordered 63-bit number."""
    return F.shiftleft(F.element_at("_at", F.col("_dim") + 1), 32).bitwiseOR(F.col("_tie"))


def _quantiles(rows: DataFrame, dimension: dict[int, int], aims: dict[int, float],
               tolerance: int) -> dict[int, int]:
    """Per node the key below which the aimed number of bytes lies."""
    spark = rows.sparkSession
    ranges = {n: (0, 2**63 - 1, 0) for n in aims}      # from key, to key, bytes below
    found: dict[int, int] = {}
    while ranges:
        grid = local_table(
            spark, [(n, dimension[n], lo, max(1, -(-(hi - lo + 1) // BINS)), hi, float(aims[n] - below))
                    for n, (lo, hi, below) in ranges.items()],
            "_node int, _dim int, _lo long, _step long, _hi long, _aim double")
        bins = (rows.join(F.broadcast(grid), "_node").withColumn("_key", _key())
                .where((F.col("_key") >= F.col("_lo")) & (F.col("_key") <= F.col("_hi")))
                .groupBy("_node", F.expr("(_key - _lo) div _step").alias("_bin"))
                .agg(F.sum("size").alias("_bytes"), F.min("_key").alias("_first"),
                     F.max("_key").alias("_last"), F.first("_aim").alias("_aim")))
        upto = Window.partitionBy("_node").orderBy("_bin")   # at most BINS rows of a node
        hit = (bins.withColumn("_upto", F.sum("_bytes").over(upto)).where(F.col("_upto") > F.col("_aim"))
               .groupBy("_node").agg(F.min_by(F.struct("_bytes", "_first", "_last", "_upto"), "_bin").alias("x"))
               .select("_node", "x.*").collect())
        left = {}
        for r in hit:
            n, below = r["_node"], ranges[r["_node"]][2] + r["_upto"] - r["_bytes"]
            if r["_first"] == r["_last"] or r["_bytes"] <= tolerance:
                # Whole bin to the nearer side.
                over = below + r["_bytes"] - aims[n] < aims[n] - below
                found[n] = r["_last"] + 1 if over else r["_first"]
            else:
                left[n] = (r["_first"], r["_last"], below)
        found.update({n: 2**63 - 1 for n in ranges if n not in left and n not in found})
        ranges = left
    return found


def q_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))

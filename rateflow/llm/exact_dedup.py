"""Exact dedup by content sort (DataFrame functions only).

Rows are range-partitioned on the content with Spark's sampled splitters and
sorted inside each partition (external sort), so equal texts lie next to each
other; the window over equal texts compares whole texts of neighbours.  The
splitter key is bounded (the first 32 characters, then the SHA-256 of the
whole text), so the sample that Spark takes of it stays small even for very
long texts; equality itself is decided on the whole text.

Hot texts: a text that holds more than 1/HOT_SHARES of all rows is dealt over
several sub-groups (at most HOT_SHARES texts can be that frequent, so the list
is small by proof and is broadcast); every sub-group is sorted and compared as
above and the sub-groups' results, one row each, are combined.

Edge cases: a null text equals the empty text.  A null ``doc_id`` ranks below
every other id, and ``keep_id`` is null if a whole group has none; rows of one
text that repeat the largest id keep exactly one.  An empty table gives an
empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rateflow.llm.common import documents, local_table, shuffle_partitions, text_of

HOT_SHARES = 1000


def exact_groups(docs: DataFrame, keep_columns: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``
    and the input columns named in ``keep_columns``.

    Of equal texts the row with the largest ``doc_id`` stays.
    """
    n = shuffle_partitions(docs.sparkSession)
    body = text_of(docs)
    rows = docs.select(
        F.col("doc_id").alias("_id"), body.alias("_text"), F.sha2(body, 256).alias("_sha"),
        *[F.col(c).alias(f"_in_{c}") for c in keep_columns])
    sizes = rows.groupBy("_sha").agg(F.count("*").alias("_n"))
    total = sizes.agg(F.sum("_n").alias("_total"))
    hot = (sizes.join(F.broadcast(total), F.col("_n") * HOT_SHARES > F.col("_total"))
           .select(F.col("_sha").alias("_hot"),
                   F.ceil(F.col("_n") * HOT_SHARES / F.col("_total")).alias("_parts")))
    # At most HOT_SHARES rows, counted once over the whole table.
    hot = local_table(docs.sparkSession, hot.collect(), "_hot string, _parts long")
    dealt = (rows.join(F.broadcast(hot), F.col("_sha") == F.col("_hot"), "left")
             .withColumn("_part", F.when(F.col("_hot").isNull(), F.lit(None).cast("long"))
                         .otherwise(F.pmod(F.xxhash64("_id"), F.col("_parts"))))
             .drop("_hot", "_parts")
             .withColumn("_head", F.substring("_text", 1, 32)))
    ranged = dealt.repartitionByRange(n, "_head", "_sha", "_part")
    same = Window.partitionBy("_head", "_sha", "_part", "_text").orderBy(F.desc_nulls_last("_id"))
    whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    compared = ranged.select(
        "_id", "_sha", "_part", *[f"_in_{c}" for c in keep_columns],
        F.row_number().over(same).alias("_rank"),
        F.first("_id").over(whole).alias("_keep"),
        F.count("*").over(whole).alias("_size"))
    merged = (compared.where("_part IS NOT NULL AND _rank = 1")
              .groupBy(F.col("_sha").alias("_hot"))
              .agg(F.max_by("_keep", F.coalesce("_keep", F.lit(-2**63))).alias("_hot_keep"),
                   F.min_by("_part", F.struct(F.col("_keep").isNull(), -F.col("_keep"), "_part"))
                   .alias("_hot_part"),
                   F.sum("_size").alias("_hot_size")))
    joined = compared.join(F.broadcast(merged), F.col("_sha") == F.col("_hot"), "left")
    first = (F.col("_rank") == 1) & (F.col("_hot").isNull() | (F.col("_part") == F.col("_hot_part")))
    return joined.select(
        F.col("_id").alias("doc_id"),
        F.when(F.col("_hot").isNull(), F.col("_keep")).otherwise(F.col("_hot_keep")).alias("keep_id"),
        F.coalesce("_hot_size", "_size").alias("group_size"),
        first.alias("kept"),
        F.col("_sha").alias("text_sha256"),
        *[F.col(f"_in_{c}").alias(c) for c in keep_columns if c != "doc_id"])


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    tagged = docs.withColumn("_row", F.struct(*[F.col(c) for c in docs.columns]))
    kept = exact_groups(tagged, ("_row",)).where("kept")
    return kept.select("_row.*")


def q_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""

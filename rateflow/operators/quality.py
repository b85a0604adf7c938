"""Profiling and data checks (row counts, distributions, histograms, order)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateflow.operators.ordering import previous_row


def row_counts(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """One row: ``n_ratings, n_items``."""
    n_items = items.select(F.count(F.lit(1))).scalar()
    return ratings.agg(F.count(F.lit(1)).alias("n_ratings")).select(
        "n_ratings", n_items.alias("n_items"))


def preview(df: DataFrame, n: int = 3, order: Sequence[str] = ("user_id", "item_id")) -> DataFrame:
    """First ``n`` rows in a stable order (a top-n, not a full sort)."""
    return df.orderBy(*order).limit(n)


def rating_distribution(ratings: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per rating value: ``rating, n``."""
    return ratings.groupBy(*by, "rating").agg(F.count(F.lit(1)).alias("n"))


def overall_mean(distribution: DataFrame) -> DataFrame:
    """Mean rating from a distribution: ``sum(rating * n) / sum(n)``."""
    return distribution.agg(
        (F.sum(F.col("rating") * F.col("n")) / F.sum("n")).alias("mean_rating"))


def item_rating_distribution(ratings: DataFrame, item_id: int) -> DataFrame:
    return rating_distribution(ratings.filter(F.col("item_id") == F.lit(item_id)))


def user_rating_distribution(ratings: DataFrame, user_id: int) -> DataFrame:
    return rating_distribution(ratings.filter(F.col("user_id") == F.lit(user_id)))


def histogram(values: DataFrame, col: str, buckets: int = 20) -> DataFrame:
    """Equal-width histogram of a numeric column.

    Same buckets as ``RDD.histogram(buckets)``: width ``(max-min)/buckets``,
    bucket ``floor((x-min)/width)`` with the maximum in the last bucket, and
    a single bucket ``[min, max]`` when all values are equal.  Empty buckets
    are returned with ``n = 0``.  Output ``bucket, lo, hi, n``.

    Min and max come from one aggregate job (two numbers to the driver); the
    histogram itself is then a single map-side-combined aggregate.
    """
    if buckets < 1:
        raise ValueError("buckets must be >= 1")
    vals = values.select(F.col(col).alias("x")).filter(F.col("x").isNotNull())
    spark = values.sparkSession
    stats = vals.agg(F.min("x").alias("mn"), F.max("x").alias("mx")).first()
    if stats is None or stats["mn"] is None:
        return spark.createDataFrame([], "bucket int, lo double, hi double, n bigint")
    mn, mx = stats["mn"], stats["mx"]
    nb = 1 if mx == mn else buckets
    inc = float(mx - mn) / nb
    if nb == 1:
        bucket = F.lit(0)
    else:
        bucket = F.least(F.floor((F.col("x") - F.lit(mn)) / F.lit(inc)), F.lit(nb - 1))
    filled = vals.select(bucket.cast("int").alias("bucket")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"))
    i = F.col("id").cast("int")
    frame = spark.range(nb).select(   # the nb bucket indices
        i.alias("bucket"),
        (i * F.lit(inc) + F.lit(mn)).alias("lo"),
        F.when(i == nb - 1, F.lit(float(mx))).otherwise((i + 1) * F.lit(inc) + F.lit(mn)).alias("hi"))
    return (frame.join(F.broadcast(filled), "bucket", "left")  # <= buckets rows each
            .select("bucket", "lo", "hi", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def activity_histogram(ratings: DataFrame, key: str, buckets: int = 20) -> DataFrame:
    """Histogram of the number of ratings per ``key`` (item or user)."""
    counts = ratings.groupBy(key).agg(F.count(F.lit(1)).alias("c"))
    return weighted_histogram(counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")), "c", "n", buckets)


def weighted_histogram(frequencies: DataFrame, value: str, weight: str, buckets: int = 20) -> DataFrame:
    """:func:`histogram` of a table of distinct values and how often each occurs,
    in one plan and one pass over it.

    The table is the only thing that meets in one task: R ratings have at most
    ``sqrt(2 R)`` different numbers of ratings per key.
    """
    if buckets < 1:
        raise ValueError("buckets must be >= 1")
    whole = Window.partitionBy()
    x, lo, hi = F.col(value), F.col("_lo"), F.col("_hi")
    step = (hi - lo).cast("double") / F.lit(buckets)
    bucket = F.when(lo == hi, F.lit(0)).otherwise(F.least(F.floor((x - lo) / step), F.lit(buckets - 1))).cast("int")
    filled = (frequencies.where(x.isNotNull()).withColumn("_lo", F.min(x).over(whole)).withColumn("_hi", F.max(x).over(whole))
              .groupBy("_lo", "_hi", bucket.alias("bucket")).agg(F.sum(weight).alias("n")))
    one = filled.groupBy("_lo", "_hi").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("_n"))
    last = F.when(lo == hi, F.lit(0)).otherwise(F.lit(buckets - 1))
    width = (hi - lo).cast("double") / (last + 1)
    i = F.col("bucket")
    return (one.withColumn("bucket", F.explode(F.sequence(F.lit(0), last)))
            .select("bucket", (i * width + lo).alias("lo"),
                    F.when(i == last, hi.cast("double")).otherwise((i + 1) * width + lo).alias("hi"),
                    F.coalesce(F.element_at("_n", i), F.lit(0)).cast("bigint").alias("n")))


def _with_previous(rows: DataFrame, line: str) -> DataFrame:
    # The row before the first one is (0, 0).
    return previous_row(rows, line, ["user_id", "item_id"], default=0)


def _step_bad() -> F.Column:
    u, pu = F.col("user_id"), F.col("prev_user_id")
    return ~((u == pu) | (u == pu + 1))


def _item_bad() -> F.Column:
    return (F.col("user_id") == F.col("prev_user_id")) & (F.col("item_id") < F.col("prev_item_id"))


def user_step_violations(rows: DataFrame, line: str = "line") -> DataFrame:
    """Rows whose user id is neither the previous one nor that plus 1.

    Output ``prev_user_id, user_id, line``.
    """
    p = _with_previous(rows, line)
    return p.filter(_step_bad()).select("prev_user_id", "user_id", line)


def item_order_violations(rows: DataFrame, line: str = "line") -> DataFrame:
    """Rows where, for an unchanged user, the item id falls.

    Output ``prev_item_id, item_id, line``.
    """
    p = _with_previous(rows, line)
    return p.filter(_item_bad()).select("prev_item_id", "item_id", line)


def order_check(rows: DataFrame, line: str = "line") -> DataFrame:
    """One row of flags and offender counts over rows in ``line`` order."""
    p = _with_previous(rows, line)
    user_down = F.col("user_id") < F.col("prev_user_id")
    return p.agg(
        F.coalesce(~F.bool_or(user_down), F.lit(True)).alias("user_order_ok"),
        F.coalesce(~F.bool_or(_step_bad()), F.lit(True)).alias("user_step_ok"),
        F.coalesce(~F.bool_or(_item_bad()), F.lit(True)).alias("item_order_ok"),
        F.count_if(_step_bad()).alias("n_user_step_violations"),
        F.count_if(_item_bad()).alias("n_item_order_violations"),
    )


def last_row_facts(rows: DataFrame, line: str = "line") -> DataFrame:
    """User id on the last row, the last line number and the row count."""
    return rows.agg(
        F.max_by("user_id", line).alias("last_user_id"),
        F.max(line).alias("last_line"),
        F.count(F.lit(1)).alias("n_rows"))


def item_catalog(items: DataFrame) -> DataFrame:
    """Distinct item ids of the catalogue."""
    return items.select("item_id").distinct()


def check_file_order(rows: DataFrame, line: str = "line") -> dict[str, DataFrame]:
    """The whole sort-order and value check of a rating file in one place.

    ``rows``: ``line, user_id, item_id, rating`` (see
    ``sources.read_rating_lines``).  Returns DataFrames: ``flags`` (one row),
    ``user_steps`` and ``item_order`` (offenders with line numbers),
    ``values`` (rows per rating value), ``last`` (last user id, last line,
    row count), and the two persisted tables that they share: ``lines`` (the
    rows) and ``rows`` (with their previous row); ``unpersist()`` both when
    done.  The file is read and lagged once for all five results.
    """
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    p = _with_previous(rows, line)
    user_down = F.col("user_id") < F.col("prev_user_id")
    flags = p.agg(
        F.coalesce(~F.bool_or(user_down), F.lit(True)).alias("user_order_ok"),
        F.coalesce(~F.bool_or(_step_bad()), F.lit(True)).alias("user_step_ok"),
        F.coalesce(~F.bool_or(_item_bad()), F.lit(True)).alias("item_order_ok"),
        F.count_if(_step_bad()).alias("n_user_step_violations"),
        F.count_if(_item_bad()).alias("n_item_order_violations"),
        F.count(F.lit(1)).alias("n_rows"),
        F.max_by("user_id", line).alias("last_user_id"),
        F.max(line).alias("last_line"))
    p = p.persist(StorageLevel.MEMORY_AND_DISK)
    return {
        "flags": flags,
        "user_steps": p.filter(_step_bad()).select("prev_user_id", "user_id", line),
        "item_order": p.filter(_item_bad()).select("prev_item_id", "item_id", line),
        "values": rating_distribution(rows),
        "last": flags.select("last_user_id", "last_line", "n_rows"),
        "lines": rows,
        "rows": p,
    }

"""Global row order without a one-task window.

A window with no ``partitionBy`` (``lag`` over the whole file, a global
``dense_rank``) moves every row into a single task.  Instead:

* :func:`number_rows` range-partitions the rows on the order key (Spark
  samples the quantiles, so skewed keys still give even partitions), sorts
  each partition, stores the result and adds the offset of the partitions
  before;
* :func:`previous_row` cuts dense keys such as line numbers into blocks of
  ``ROWS_PER_BLOCK``, lags inside each block and carries the last row of a
  block over to the next.  Keys with gaps are numbered first.

The number of partitions and blocks follows from the number of rows; the
only tables handled by one task have one row per partition or block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateflow.session import write_and_read

ROWS_PER_BLOCK = 250_000


def number_rows(df: DataFrame, order_col: str, out_col: str = "rn",
                rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Add ``out_col`` = 1-based position of the row by ``order_col``.

    Equal to ``row_number() OVER (ORDER BY order_col)``.  The sorted rows are
    written to the checkpoint directory first, so that counts and positions
    see the same partitions.
    """
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows_per_block))
    ranged = (df.repartitionByRange(parts, order_col).sortWithinPartitions(order_col)
              .withColumn("_id", F.monotonically_increasing_id()))
    d = write_and_read(ranged, "numbered").withColumn("_blk", F.shiftright("_id", 33))
    counts = d.groupBy("_blk").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_blk", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    row = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return d.join(offsets, "_blk").withColumn(out_col, F.col("_off") + row + 1).drop("_blk", "_id", "_off")


def previous_row(df: DataFrame, order_col: str, value_cols: Sequence[str],
                 default=0, prefix: str = "prev_",
                 rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Add ``prev_<c>`` = value of ``c`` on the row just before in order.

    Equal to ``lag(c, 1, default) OVER (ORDER BY order_col)`` over the whole
    table.  The first row gets ``default``.
    """
    value_cols = list(value_cols)
    lo, hi, n = df.agg(F.min(order_col), F.max(order_col), F.count(order_col)).first()
    if not n:
        out = df
        for c in value_cols:
            out = out.withColumn(prefix + c, F.lit(default))
        return out
    key = order_col
    if hi - lo + 1 > 2 * n:  # not dense: blocks by position
        df, key, lo = number_rows(df, order_col, "_line", rows_per_block), "_line", 1
    vals = F.struct(*[F.col(c) for c in value_cols])
    d = df.withColumn("_blk", F.floor((F.col(key) - F.lit(lo)) / F.lit(rows_per_block)).cast("bigint"))
    inner = F.lag(vals, 1).over(Window.partitionBy("_blk").orderBy(key))
    # Last row of every non-empty block, then the last row of the block before.
    last = d.groupBy("_blk").agg(F.max_by(vals, F.col(key)).alias("_last"))
    carry = last.select("_blk", F.lag("_last", 1).over(Window.orderBy("_blk")).alias("_carry"))
    out = (d.withColumn("_inner", inner).join(carry, "_blk", "left")
           .withColumn("_prev", F.coalesce("_inner", "_carry")))
    for c in value_cols:
        out = out.withColumn(prefix + c, F.coalesce(F.col("_prev")[c], F.lit(default)))
    return out.drop("_blk", "_inner", "_carry", "_prev", *([] if key == order_col else [key]))

"""Reusable column expressions.

All of them are built-in Spark expressions so they stay inside whole-stage
codegen and give the same value on every row whatever the partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stable_hash_key(*cols) -> Column:
    """32-bit non-negative key from the md5 of ``'|'``-joined values.

    Unlike ``rand()``/``randomSplit`` this depends only on the row's values,
    so a split or sample is the same after any repartition, after a retried
    task, and in any other engine that has md5.
    """
    digest = F.md5(F.concat_ws("|", *[_col(c).cast("string") for c in cols]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_bucket(modulus: int, *cols) -> Column:
    """Bucket ``0..modulus-1`` of :func:`stable_hash_key`."""
    return stable_hash_key(*cols) % F.lit(modulus)


def split_part(bucket: Column, weights: Sequence[int] = (6, 2, 2),
               names: Sequence[str] = ("train", "validation", "test")) -> Column:
    """Name of the split a bucket in ``0..sum(weights)-1`` falls in."""
    if len(weights) != len(names):
        raise ValueError("one name per weight")
    expr = None
    upper = 0
    for w, name in zip(weights, names):
        upper += int(w)
        cond = bucket < F.lit(upper)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(names[-1]))


def error_aggs(prediction: str | Column = "prediction", actual: str | Column = "rating",
               digits: int | None = None) -> list[Column]:
    """RMSE, MAE, the number of scored pairs and their share of all pairs as
    aggregate columns.

    One pass instead of separate sum, sum and count jobs.  A pair without a
    prediction counts in ``coverage`` only.  With no scored pair the errors
    are null and ``n`` is 0; with no pair the coverage is null.
    """
    d = _col(prediction) - _col(actual)
    rmse = F.sqrt(F.avg(d * d))
    mae = F.avg(F.abs(d))
    if digits is not None:
        rmse, mae = F.round(rmse, digits), F.round(mae, digits)
    scored = F.count(d)
    return [rmse.alias("rmse"), mae.alias("mae"), scored.alias("n"),
            F.try_divide(scored, F.count(F.lit(1))).alias("coverage")]

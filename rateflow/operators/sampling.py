"""Sampling, restriction, dense ids and seeded splits.

Samples and splits are driven by an md5 hash of ``(seed, ids)``: the same
rows come out after any repartition, after a retried task, and in any SQL
engine with md5, unlike ``rand()``-based ``sample``/``randomSplit``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateflow.functions.columns import hash_bucket, split_part, stable_hash_key
from rateflow.operators.ordering import number_rows

PARTS = ("train", "validation", "test")


def sample_ids(df: DataFrame, id_col: str, n: int, seed: int = 0,
               method: str = "threshold") -> DataFrame:
    """Exact-size sample of ``n`` distinct ids without replacement.

    The ``n`` ids with the smallest ``md5(seed|id)`` key (ties broken by id).
    ``method='threshold'`` finds the n-th key by two histogram passes and
    then filters, so nothing of size ``n`` meets in one task.  ``'topn'``,
    for small ``n``, plans a top-n (``TakeOrderedAndProject``).  Both return
    the same ids.
    """
    ids = df.select(id_col).distinct()
    if n <= 0:
        return ids.limit(0)
    if method == "topn":
        key = stable_hash_key(F.lit(seed), F.col(id_col))
        return ids.orderBy(key, F.col(id_col)).limit(n)
    if method != "threshold":
        raise ValueError(f"unknown method {method!r}")
    return _sample_by_threshold(ids, id_col, n, seed)


def _nth_bucket(counts: DataFrame, bucket: str, need: int):
    """(bucket holding the need-th row, rows in smaller buckets), from a
    table of at most 65,536 bucket counts."""
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    row = (counts.select(bucket, "c", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("below"))
           .filter((F.col("below") < F.lit(need)) & (F.col("below") + F.col("c") >= F.lit(need)))
           .first())
    return (None, None) if row is None else (row[bucket], row["below"])


def _sample_by_threshold(ids: DataFrame, id_col: str, n: int, seed: int) -> DataFrame:
    keyed = ids.select(id_col, stable_hash_key(F.lit(seed), F.col(id_col)).alias("_key"))
    hi = F.shiftright("_key", 16)
    hi_counts = keyed.groupBy(hi.alias("_hi")).agg(F.count(F.lit(1)).alias("c"))
    hi_star, below_hi = _nth_bucket(hi_counts, "_hi", n)
    if hi_star is None:  # fewer than n ids: all of them
        return ids
    lo = F.col("_key").bitwiseAND(F.lit(0xFFFF))
    lo_counts = (keyed.filter(hi == F.lit(hi_star))
                 .groupBy(lo.alias("_lo")).agg(F.count(F.lit(1)).alias("c")))
    lo_star, below_lo = _nth_bucket(lo_counts, "_lo", n - below_hi)
    key_star = (hi_star << 16) | lo_star
    # ids with key below key*, plus the smallest ids among those with key*
    # (equal 32-bit keys are rare; their count is what is sorted)
    take_at = n - below_hi - below_lo
    at = keyed.filter(F.col("_key") == F.lit(key_star)).orderBy(id_col).limit(take_at)
    return (keyed.filter(F.col("_key") < F.lit(key_star)).select(id_col)
            .unionByName(at.select(id_col)))


def restrict(ratings: DataFrame, users: DataFrame | None = None,
             items: DataFrame | None = None) -> DataFrame:
    """Keep ratings whose user and item are both in the given sets."""
    out = ratings
    if users is not None:
        out = out.join(users.select("user_id"), "user_id", "left_semi")
    if items is not None:
        out = out.join(items.select("item_id"), "item_id", "left_semi")
    return out


def min_activity(ratings: DataFrame, min_count: int = 20, key: str = "user_id") -> DataFrame:
    """Keep ratings of keys with at least ``min_count`` ratings.

    A count aggregate (combined map-side, so a hot key costs nothing extra)
    and a semi-join, instead of a window that would sort a hot key's rows in
    one task.
    """
    passing = (ratings.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
               .filter(F.col("_n") >= F.lit(min_count)).select(key))
    return ratings.join(passing, key, "left_semi")


def kept_users(ratings: DataFrame) -> DataFrame:
    return ratings.select("user_id").distinct()


def dense_ids(ratings: DataFrame, col: str = "user_id", out_col: str = "new_id") -> DataFrame:
    """Mapping ``col -> out_col`` numbering the distinct ids 1..n ascending.

    Same ids as ``dense_rank() OVER (ORDER BY col)`` without moving all ids
    into one task (see :mod:`rateflow.operators.ordering`).
    """
    distinct = ratings.select(col).distinct()
    return number_rows(distinct, col, out_col=out_col)


def renumber_users(ratings: DataFrame) -> DataFrame:
    """Ratings with ``user_id`` replaced by its dense 1..n id."""
    mapping = dense_ids(ratings, "user_id", "_new")
    return (ratings.join(mapping, "user_id")
            .withColumn("user_id", F.col("_new")).drop("_new")
            .select("user_id", "item_id", "rating"))


def sample_ratings(ratings: DataFrame, users: DataFrame, items: DataFrame,
                   n_users: int = 3000, n_items: int = 10000, min_count: int = 20,
                   seed: int = 0, drop_first: bool = False) -> DataFrame:
    """Small rating set: sampled users and items, active users, dense ids.

    Draws ``n_users`` from the whole user domain and ``n_items`` from the
    catalogue, keeps ratings whose user and item were both drawn, keeps users
    with at least ``min_count`` kept ratings and renumbers them 1..n.

    ``drop_first=True`` reproduces a slip of the original line-by-line
    sampler: each sampled user's first rating in file order (the smallest
    item id, the file being sorted by user and item) is lost before the item
    filter.  Off by default.
    """
    su = sample_ids(users, "user_id", n_users, seed)
    si = sample_ids(items, "item_id", n_items, seed)
    mine = restrict(ratings, su)
    if drop_first:
        first = Window.partitionBy("user_id").orderBy("item_id")  # at most a catalogue of rows
        mine = (mine.withColumn("_pos", F.row_number().over(first))
                .filter(F.col("_pos") > 1).drop("_pos"))
    kept = min_activity(restrict(mine, items=si), min_count)
    return renumber_users(kept)


def with_split(ratings: DataFrame, seeds: int | Sequence[int] = 0,
               weights: Sequence[int] = (6, 2, 2), names: Sequence[str] = PARTS) -> DataFrame:
    """Add ``seed`` and ``part`` columns (a seeded hash split).

    With several seeds every rating appears once per seed, so all seeds run
    in one job and every later join and aggregate is keyed by ``seed``.
    Bucket ``md5(seed|user|item) % sum(weights)``; the default weights give
    train = buckets 0-5, validation = 6-7, test = 8-9.
    """
    if isinstance(seeds, int):
        seeded = ratings.withColumn("seed", F.lit(seeds))
    else:
        seeded = ratings.withColumn("seed", F.explode(F.array(*[F.lit(int(s)) for s in seeds])))
    bucket = hash_bucket(int(sum(weights)), "seed", "user_id", "item_id")
    # A column of its own: the comparisons would hash a row again for every part.
    return seeded.withColumn("_bucket", bucket).withColumn("part", split_part(F.col("_bucket"), weights, names)).drop("_bucket")


def part(split: DataFrame, name: str) -> DataFrame:
    return split.filter(F.col("part") == F.lit(name)).drop("part")


def split_sizes(split: DataFrame) -> DataFrame:
    return split.groupBy("seed", "part").agg(F.count(F.lit(1)).alias("n"))


def union_splits(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bag union of two splits (train + validation for the baseline)."""
    return a.unionByName(b)


def keys_only(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The (user, item) pairs to predict."""
    return df.select(*by, "user_id", "item_id")

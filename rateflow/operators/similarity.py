"""User-user cosine similarity over co-rated items and top-K neighbours.

Pairs of users are only ever formed through a shared item, never as a
cartesian product of all users.

The per-pair sums ``dot, s1, s2, n`` have one plan at every size
(:func:`block_pair_sums`): users are hashed into large blocks that are packed into one
row each, for all key groups at once, the two rows of a block pair meet in a task, and the pairs of users are formed
and summed there by an exact overlap join (:mod:`rateflow.operators.overlap`):
with a least number of common items, pairs are formed through each user's rarest
items only.  Pair rows are never shuffled or stored.

:func:`co_ratings` gives the pair rows themselves, for bounded inputs such
as given users; a hot item's raters are split there into blocks on both
sides of the join (a salt).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rateflow.operators.ordering import number_rows
from rateflow.operators.overlap import Block, pair_sum_parts
from rateflow.operators.salting import hot_keys, salted_join
from rateflow.session import map_batches, scratch_path, write_and_read

# Items with more raters than this are salted (see module doc).
DEFAULT_SALT_ABOVE = 20_000


def co_ratings(ratings: DataFrame, by: Sequence[str] = (),
               salt_above: int | None = DEFAULT_SALT_ABOVE) -> DataFrame:
    """Rows ``*by, item_id, u, v, ru, rv`` for every item both u and v rated, u < v."""
    by = list(by)
    base = ratings.select(*by, "item_id", "user_id", "rating")
    if salt_above is None:
        a = base.select(*by, "item_id", F.col("user_id").alias("u"), F.col("rating").alias("ru"))
        b = base.select(*by, "item_id", F.col("user_id").alias("v"), F.col("rating").alias("rv"))
        return a.join(b, [*by, "item_id"]).filter(F.col("u") < F.col("v"))
    if salt_above < 1:
        raise ValueError("salt_above must be >= 1")
    # Only the hot items come back to the ratings (at most R / salt_above
    # rows); they are written, so that the join is planned by their true size.
    hot = hot_keys(base, [*by, "item_id"], salt_above)
    s = base.join(hot, [*by, "item_id"], "left").withColumn(
        "_s", F.ceil(F.coalesce("_n", F.lit(1)) / F.lit(salt_above)).cast("int"))
    own = F.pmod(F.xxhash64("user_id"), F.col("_s")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("_s") - 1))
    keys = [*by, "item_id", "_p", "_q"]
    # Partition explicitly on all join keys, so the salt takes effect even if
    # the session lets joins reuse a partitioning on a subset of them.
    nparts = int(ratings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a = s.select(*by, "item_id", F.col("user_id").alias("u"), F.col("rating").alias("ru"),
                 own.alias("_p"), every.alias("_q")).repartition(nparts, *keys)
    b = s.select(*by, "item_id", F.col("user_id").alias("v"), F.col("rating").alias("rv"),
                 every.alias("_p"), own.alias("_q")).repartition(nparts, *keys)
    return (a.join(b, keys)
            .filter(F.col("u") < F.col("v"))
            .drop("_p", "_q"))


def item_pairs(ratings: DataFrame, salt_above: int | None = DEFAULT_SALT_ABOVE) -> DataFrame:
    """Per item, every pair of its raters (lower id first) with both ratings."""
    return co_ratings(ratings, salt_above=salt_above)


def _cosine(dot, s1, s2) -> F.Column:
    den = F.sqrt(s1) * F.sqrt(s2)
    return F.when(den != 0, dot / den).otherwise(F.lit(0.0))


def _sum_aggs(ru: str, rv: str) -> list[F.Column]:
    return [F.sum(F.col(ru) * F.col(rv)).alias("dot"),
            F.sum(F.col(ru) * F.col(ru)).alias("s1"),
            F.sum(F.col(rv) * F.col(rv)).alias("s2"),
            F.count(F.lit(1)).alias("n")]


def sums_from_pairs(pairs: DataFrame, by: Sequence[str] = (), min_common: int = 1) -> DataFrame:
    """Per-pair sums ``*by, u, v, dot, s1, s2, n`` from co-rating rows."""
    agg = pairs.groupBy(*by, "u", "v").agg(*_sum_aggs("ru", "rv"))
    if min_common > 1:
        agg = agg.filter(F.col("n") >= F.lit(min_common))
    return agg


# Users and ratings of a block: what one side of a block pair may hold in a task.
BLOCK_USERS, BLOCK_RATINGS = 131_072, 4_000_000
# Key groups that one packed block tells apart (bits of a long).
MASK_BITS = 62


def block_count(users: int, ratings: int, cores: int = 1) -> int:
    """Blocks for all key groups: at most about ``BLOCK_USERS`` users and
    ``BLOCK_RATINGS`` ratings in each, and a few block pairs for every core."""
    return max(1, -(-users // BLOCK_USERS), -(-ratings // BLOCK_RATINGS),
               min(users, math.ceil(math.sqrt(4.0 * cores))))


def user_vectors(ratings: DataFrame, by: Sequence[str] = (), min_common: int = 1,
                 extra: Sequence[str] = ()) -> DataFrame:
    """``*by, user_id, items, values, *extra``: per user the ratings in one global order
    of the items, the rarest first (ties: lower id), and the ``extra`` columns likewise.

    ``items`` holds the items' places in that order.  The order is joined to the
    ratings in ``ORDER_SHARES`` shares of an item, so a popular item is no key of its
    own; by its size before the shares are made Spark would broadcast it, all of them through
    the driver, so the join is a shuffled one.  Users with fewer than ``min_common`` ratings cannot reach it and are left out.
    """
    counts = ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("_c"))
    order = (number_rows(counts.select("item_id", F.struct("_c", "item_id").alias("_o")), "_o", "_place")
             .select("item_id", "_place", F.explode(F.sequence(F.lit(0), F.lit(ORDER_SHARES - 1))).alias("_share")))
    share = F.pmod(F.xxhash64("user_id"), F.lit(ORDER_SHARES)).cast("int")
    entry = F.struct("_place", F.col("rating").cast("double").alias("rating"), *extra)
    return (ratings.select(*by, "user_id", "item_id", "rating", *extra, share.alias("_share"))
            .join(order.hint("shuffle_hash"), ["item_id", "_share"])
            .groupBy(*by, "user_id").agg(F.array_sort(F.collect_list(entry)).alias("_e"))
            .where(F.size("_e") >= min_common)
            .select(*by, "user_id", F.col("_e._place").alias("items"), F.col("_e.rating").alias("values"),
                    *[F.col(f"_e.{c}").alias(c) for c in extra]))


# Shares of one item's ratings when its place in the order is looked up.
ORDER_SHARES = 32


def block_pairs(vectors: DataFrame, blocks: int, partitions: int, by: Sequence[str] = ()) -> DataFrame:
    """``*by, p, q, side, user_id, items, values``: each user's vector in all block
    pairs of its block, sorted so that a task has one block pair after the other.

    A block pair goes to the partition of its number (``repartitionById``), so
    consecutive pairs go to different partitions, whatever their count.  Every vector is
    copied ``blocks`` times: for few blocks only; :func:`block_pair_sums` copies none.
    """
    by = list(by)
    own = F.pmod(F.xxhash64("user_id"), F.lit(blocks)).cast("int")
    p, q = F.least("_b", "_o"), F.greatest("_b", "_o")
    copies = (vectors.withColumn("_b", own).withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
              .select(*by, p.alias("p"), q.alias("q"), (F.col("_b") != p).alias("side"), "user_id", "items", "values"))
    # Number of the pair (p, q >= p), row by row.
    number = F.expr(f"p * {blocks}L - (p * (p - 1)) div 2 + (q - p)")
    group = F.pmod(F.xxhash64(*by), F.lit(partitions)) if by else F.lit(0)
    return (copies.withColumn("_id", F.pmod(group + number, F.lit(partitions)).cast("int"))
            .repartitionById(partitions, "_id").sortWithinPartitions(*by, "p", "q", "side", "user_id").drop("_id"))


def with_groups(ratings: DataFrame, by: Sequence[str], groups: list) -> DataFrame:
    """``user_id, item_id, rating, groups``: each rating once, with a bit for every key
    group it is in (the number in ``groups``).  The groups of a rating are combined
    map-side, so several seeds move hardly more rows than one."""
    bit = F.lit(0).cast("long")
    for i, group in enumerate(groups):
        same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.lit(group[c])) for c in by], F.lit(True))
        bit = F.when(same, F.lit(1 << i).cast("long")).otherwise(bit)
    rows = ratings.select("user_id", "item_id", "rating", bit.alias("groups")).where(F.col("groups") != 0)
    return rows.groupBy("user_id", "item_id", "rating").agg(F.bit_or("groups").alias("groups")) if by else rows


def packed_blocks(ratings: DataFrame, blocks: int, by: Sequence[str], min_common: int,
                  groups: list) -> tuple[str, StructType]:
    """Path and schema of the written blocks: one row ``block, users, sizes, items,
    ratings, groups`` (arrays as compressed bytes) per block, for all key groups."""
    rated = ratings if "groups" in ratings.columns else with_groups(ratings, by, groups)
    vectors = user_vectors(rated.where(F.col("user_id").isNotNull()), (), min_common, ["groups"])
    own = F.pmod(F.xxhash64("user_id"), F.lit(blocks)).cast("int")
    rows = (vectors.select(own.alias("block"), "user_id", "items", "values", "groups")
            .repartitionById(blocks, "block").sortWithinPartitions("block", "user_id"))
    schema = StructType([rows.schema["block"], *StructType.fromDDL(
        "users binary, sizes binary, items binary, ratings binary, groups binary").fields])
    packed = map_batches(rows, lambda batches: _pack(batches, schema.names), schema)
    path = scratch_path(ratings.sparkSession, "user_blocks")
    packed.write.parquet(path)
    return path, schema


def _squeezed(x: np.ndarray) -> bytes:
    """An array as its type, length and compressed bytes, those of equal weight together."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T.tobytes()
    return x.dtype.str.encode() + len(x).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _restored(data: bytes) -> np.ndarray:
    data = memoryview(data)
    kind, n = np.dtype(bytes(data[:3]).decode()), int.from_bytes(data[3:11], "little")
    planes = pa.decompress(data[11:], n * kind.itemsize, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, n).T).view(kind).reshape(n)


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int32) if not len(x) or (x.max() < 2**31 and x.min() >= -2**31) else x


def _pack(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows ``block, user_id, items, values, groups`` in order of block and user as one row
    per block.  Of the rising items of a user, the steps are kept; of few distinct
    ratings, their numbers."""
    def row(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        lists, values, groups = (table.column(i).chunk(0) for i in (2, 3, 4))
        # A null rating adds nothing to the sums, as in SQL, but its item counts.
        items, ratings = lists.flatten().to_numpy(), values.flatten().fill_null(0.0).to_numpy()
        steps = np.diff(items, prepend=0)
        sizes = np.diff(lists.offsets.to_numpy())
        starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        steps[starts] = items[starts]
        kinds, which = np.unique(ratings, return_inverse=True, equal_nan=False)
        few = len(kinds) <= 256
        arrays = [table.column(1).to_numpy().astype(np.int64), sizes.astype(np.int32), _narrow(steps)]
        coded = (len(kinds).to_bytes(2, "little") + kinds.tobytes() + _squeezed(which.astype(np.uint8)) if few
                 else bytes(2) + _squeezed(ratings.astype(np.float64)))
        packed = [*(_squeezed(a) for a in arrays), coded, _squeezed(_narrow(groups.flatten().to_numpy()))]
        return pa.RecordBatch.from_arrays([parts[0].column(0).slice(0, 1), *(pa.array([x], pa.binary()) for x in packed)],
                                          names=names)

    rows: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            part = batch.slice(start, end - start)
            if rows and rows[-1].column(0)[0] != part.column(0)[0]:
                yield row(rows)
                rows = []
            rows.append(part)
    if rows:
        yield row(rows)


def _unpack(users: bytes, sizes: bytes, items: bytes, ratings: bytes) -> Block:
    users, sizes, steps = _restored(users), _restored(sizes).astype(np.int64), _restored(items).astype(np.int64)
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    total = np.cumsum(steps)
    before = (total - steps)[starts]
    total -= np.repeat(before, sizes[sizes > 0])
    n_kinds = int.from_bytes(memoryview(ratings)[:2], "little")
    rest = memoryview(ratings)[2 + 8 * n_kinds:]
    values = np.frombuffer(memoryview(ratings)[2:2 + 8 * n_kinds], np.float64)[_restored(rest)] if n_kinds else _restored(rest)
    return Block(users, sizes, total, values)


def block_pair_sums(ratings: DataFrame, blocks: int, by: Sequence[str] = (),
                    min_common: int = 1, partitions: int | None = None) -> DataFrame:
    """``*by, u, v, dot, s1, s2, n`` (u < v, n >= ``min_common``), the sums being
    formed where the block pairs lie.

    Users are hashed into ``blocks`` blocks, each written once as one row with the
    ratings of all key groups (:func:`packed_blocks`).  A block pair is a join of two of
    these rows, so a block is copied ``blocks + 1`` times in its compressed form; pair rows
    are not shuffled, and each pair of blocks is taken once.  A task takes its block pairs
    one after the other, and of a pair the key groups one after the other
    (:mod:`rateflow.operators.overlap`), so its memory is that of a few blocks.
    One rating per key group and (user, item) is expected.
    Sums of half-star ratings are exact in any order; others can differ in the last bits.

    The sums are not stored: they are formed when the result is read.
    """
    groups = ratings.select(*by).distinct().collect() if by else [{}]
    if not groups:
        schema = StructType([*(ratings.schema[c] for c in by), *StructType.fromDDL(SUMS).fields])
        return ratings.sparkSession.createDataFrame([], schema)
    slices = [groups[i:i + MASK_BITS] for i in range(0, len(groups), MASK_BITS)]
    return reduce(DataFrame.unionAll, [_grouped_pair_sums(with_groups(ratings, by, part), ratings.schema, blocks, by,
                                                          min_common, part, partitions) for part in slices])


SUMS = "u long, v long, dot double, s1 double, s2 double, n long"


def _grouped_pair_sums(rated: DataFrame, kinds: StructType, blocks: int, by: Sequence[str], min_common: int,
                       groups: list, partitions: int | None = None) -> DataFrame:
    """:func:`block_pair_sums` of ratings that carry their ``groups``."""
    by = list(by)
    spark, n_groups = rated.sparkSession, len(groups)
    slots = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    path, row = packed_blocks(rated, blocks, by, min_common, groups)
    arrays, keys = ("users", "sizes", "items", "ratings", "groups"), ["p", "q"]
    packed = spark.read.schema(row).parquet(path).withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    ahead = F.pmod(F.col("q") - F.col("p"), F.lit(blocks)) * 2
    once = (ahead < blocks) | ((ahead == blocks) & (F.col("p") < F.col("q")))
    left = packed.select(F.col("block").alias("p"), F.col("_o").alias("q"), *[F.col(c).alias(f"_{c}") for c in arrays])
    right = packed.select(F.col("_o").alias("p"), F.col("block").alias("q"), *arrays)
    pairs = (left.where(once).repartition(slots, *keys).join(right.where(once).repartition(slots, *keys).hint("merge"), keys)
             .select("p", "q", *[f"_{c}" for c in arrays], *arrays))

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                p, q = (batch.column(c)[i].as_py() for c in range(2))
                sides = [[batch.column(first + c)[i].as_buffer() for c in range(5)] for first in (2, 7)]
                left, in_left = _unpack(*sides[0][:4]), _restored(sides[0][4])
                right, in_right = (left, in_left) if p == q else (_unpack(*sides[1][:4]), _restored(sides[1][4]))
                for g in range(n_groups):
                    a = _of_group(left, in_left, g) if by else left
                    b = a if p == q else _of_group(right, in_right, g) if by else right
                    for u, v, *columns in pair_sum_parts(a, b, min_common, same=p == q):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c) for c in (np.full(len(u), g), np.minimum(u, v), np.maximum(u, v), columns[0],
                                                   np.where(u < v, columns[1], columns[2]),
                                                   np.where(u < v, columns[2], columns[1]), columns[3])],
                            names=["_g", "u", "v", "dot", "s1", "s2", "n"])

    found = map_batches(pairs, sums, f"_g long, {SUMS}")
    value = lambda c: F.get(F.array(*[F.lit(g[c]).cast(kinds[c].dataType) for g in groups]), F.col("_g").cast("int"))
    return found.select(*[value(c).alias(c) for c in by], "u", "v", "dot", "s1", "s2", "n")


def _of_group(block: Block, masks: np.ndarray, group: int) -> Block:
    """The ratings of a block that are in one key group."""
    keep = (masks >> group) & 1 == 1
    sizes = np.bincount(block.owner[keep], minlength=len(block.users))
    return Block(block.users, sizes, block.items[keep], block.ratings[keep])


def co_rating_sums(ratings: DataFrame, by: Sequence[str] = (), min_common: int = 1,
                   blocks: int | None = None) -> DataFrame:
    """``*by, u, v, dot, s1, s2, n`` over co-rated items, u < v.

    The ratings are written once, each with its key groups: they are read for the
    counts, the order of the items and the vectors.  One small job over per-user counts
    gives the numbers of users and ratings; :func:`block_count` follows from them.
    """
    spark = ratings.sparkSession
    groups = ratings.select(*by).distinct().collect() if by else [{}]
    found = []
    for part in [groups[i:i + MASK_BITS] for i in range(0, len(groups), MASK_BITS)]:
        rated = write_and_read(with_groups(ratings, by, part), "pair_ratings")
        row = (rated.groupBy("user_id").agg(F.count(F.lit(1)).alias("c"))
               .agg(F.count(F.lit(1)).alias("u"), F.sum("c").alias("r")).first())
        b = blocks or block_count(int(row["u"]), int(row["r"] or 0), spark.sparkContext.defaultParallelism)
        found.append(_grouped_pair_sums(rated, ratings.schema, b, by, min_common, part))
    return reduce(DataFrame.unionAll, found) if found else block_pair_sums(ratings, 1, by, min_common)


def aligned_sums(ratings: DataFrame, min_common: int = 1) -> DataFrame:
    """:func:`co_rating_sums` of ratings that repeat a (user, item), numbered by
    ``occurrence``: the first rating of u meets the first of v, the second the
    second, and what one of them has more of meets none (a merge of the two lists)."""
    return co_rating_sums(ratings.withColumn("item_id", F.struct("item_id", "occurrence")), (), min_common)


def similarity_from_sums(sums: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return sums.select(*by, "u", "v", _cosine(F.col("dot"), F.col("s1"), F.col("s2")).alias("sim"), "n")


def similarity_from_pairs(pairs: DataFrame, by: Sequence[str] = (),
                          min_common: int = 1) -> DataFrame:
    """Cosine over co-rated items: ``*by, u, v, sim, n``."""
    return similarity_from_sums(sums_from_pairs(pairs, by, min_common), by)


def user_similarity(ratings: DataFrame, by: Sequence[str] = (), min_common: int = 1) -> DataFrame:
    """Cosine similarity of every user pair with a co-rated item.

    Norms run over the co-rated items only.  Pairs with no common item are
    not formed; they would have similarity 0.0 and count 0.
    """
    return similarity_from_sums(co_rating_sums(ratings, by, min_common), by)


def directed(sim: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Each undirected pair as two rows: ``*by, user_id, nb, sim, n``."""
    both = F.explode(F.array(
        F.struct(F.col("u").alias("user_id"), F.col("v").alias("nb")),
        F.struct(F.col("v").alias("user_id"), F.col("u").alias("nb"))))
    return (sim.select(*by, both.alias("_d"), "sim", "n")
            .select(*by, "_d.user_id", "_d.nb", "sim", "n"))


def rank_neighbours(directed_sim: DataFrame, k: int = 200, by: Sequence[str] = ()) -> DataFrame:
    """First ``k`` neighbours per user by similarity (ties: lower id first).

    ``row_number() <= k`` plans as a partial window-group limit before the
    shuffle, so a user with many candidates sends at most ``k`` per task.
    """
    w = Window.partitionBy(*by, "user_id").orderBy(F.desc("sim"), F.asc("nb"))
    return (directed_sim.withColumn("rk", F.row_number().over(w))
            .filter(F.col("rk") <= F.lit(k)))


def top_neighbours(ratings: DataFrame, k: int = 200, min_common: int = 10,
                   by: Sequence[str] = (), stored: bool = True) -> DataFrame:
    """``*by, user_id, nb, sim, n, rk``: the ``k`` most similar users with at
    least ``min_common`` co-rated items (the count filter comes first).  Not
    ``stored``, they are formed whenever the result is read."""
    if min_common < 1:
        raise ValueError("min_common must be >= 1")
    sim = user_similarity(ratings, by, min_common)
    ranked = rank_neighbours(directed(sim, by), k, by)
    # Written, if it is read more than once: at most k rows a user, unlike the pairs.
    return write_and_read(ranked, "neighbours") if stored else ranked


def neighbours_for_users(ratings: DataFrame, users: DataFrame, k: int = 200,
                         min_common: int = 10) -> DataFrame:
    """Top-``k`` neighbours of a given set of users only.

    Forms only the pairs that involve a target user (the target side of the
    join is restricted first), so asking for one user does not compute the
    similarity of every pair.  Same rows as filtering :func:`top_neighbours`.
    """
    if min_common < 1:
        raise ValueError("min_common must be >= 1")
    targets = ratings.join(users.select("user_id").distinct(), "user_id", "left_semi")
    a = targets.select("item_id", F.col("user_id").alias("u"), F.col("rating").alias("ru"))
    # Ratings of other items meet no target; they go before anything is moved.
    b = (ratings.join(targets.select("item_id").distinct(), "item_id", "left_semi")
         .select("item_id", F.col("user_id").alias("v"), F.col("rating").alias("rv")))
    pairs = salted_join(b, a, ["item_id"], "v").filter(F.col("u") != F.col("v"))
    sim = similarity_from_pairs(pairs, (), min_common)
    d = sim.select(F.col("u").alias("user_id"), F.col("v").alias("nb"), "sim", "n")
    return rank_neighbours(d, k)

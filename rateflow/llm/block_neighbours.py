"""Nearest neighbours by a block matrix join.

The vectors are packed once into blocks of at most ``BLOCK`` rows: the exact
components, the same as 8-bit integers with one scale per row, the squared length
of these, and ``off``, the distance between a row and its 8-bit form
(:func:`vector_blocks`).  The rows that are queries are dealt from there into
blocks of their own.

Candidate blocks and query blocks are dealt into groups, and every pair of groups is
one small task: a shuffle copies each candidate block once per query group and each
query block once per candidate group.  A group pair is worked off in tiles
(:class:`Search`): the product of two 8-bit tiles is exact in the
matrix unit and gives the distance of the 8-bit forms, which ``off`` of both rows
bounds from below and above (triangle inequality).  A tile's kth upper bound, and
later the worst entry of a query's heap of ``k``, drop pairs by their lower bounds; the
rest is computed in double precision from the exact components and pushed to the
heap.  The group pairs' heaps are ranked once more, at most ``k`` rows each.  No
neighbour is lost, so recall is 1.

A vector's work is shared by all queries of a group, and nothing passes the driver but
the numbers of blocks and queries.

Edge cases: a vector that is null, empty or zero, or holds a null or a non-finite
component, takes no part, neither does a row without ``vec_id``.  Vectors meet those
of their own length.  Every row is its own candidate's exception by its place in
the table, not by its id: rows that repeat a query's id are queries and candidates
themselves.  Ties go to the smaller ``vec_id``; fewer candidates than ``k`` give fewer
rows; a distance beyond the double range is infinite; an empty table gives an empty
result.  Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rateflow.llm.common import map_batches, written

# Rows of a block (fewer, if vectors are long), blocks and queries of a group.
BLOCK, BLOCK_VALUES = 8192, 1 << 20
GROUP_BLOCKS, GROUP_QUERIES = 4, 4096
# Rows and columns of a tile; longest stretch whose 8-bit products are exact in float32.
TILE_QUERIES, TILE_ROWS, EXACT = 128, 2048, 1024

BLOCK_DDL = ("block long, dim int, n int, n_queries int, wide boolean, rows binary, ids binary, query binary, "
             "exact binary, codes binary, scale binary, square binary, off binary")


def _block(rows, ids, query, exact) -> dict:
    """A block's columns from row numbers, ids, query marks and a matrix."""
    wide = exact.dtype == np.float64
    with np.errstate(over="ignore", under="ignore", divide="ignore", invalid="ignore"):
        x = exact.astype(np.float64)
        scale = np.abs(x).max(axis=1) / 127
        scaled = x / scale[:, None]
        usable = np.isfinite(scaled).all(axis=1)
        scale = np.where(usable, scale, 0)
        codes = np.where(usable[:, None], np.clip(np.rint(scaled), -127, 127), 0).astype(np.int8)
        square = scale * scale * (codes.astype(np.int64) ** 2).sum(axis=1)
        rest = x - codes * scale[:, None]
        off = np.sqrt((rest * rest).sum(axis=1)) * (1 + 1e-9)
    return {"block": int(rows[0]), "dim": exact.shape[1], "n": len(ids), "n_queries": int(query.sum()), "wide": wide,
            "rows": rows.astype(np.int64).tobytes(), "ids": ids.astype(np.int64).tobytes(), "query": query.astype(bool).tobytes(),
            "exact": exact.tobytes(), "codes": codes.tobytes(), "scale": scale.tobytes(), "square": square.tobytes(),
            "off": off.tobytes()}


def rows_by_length(batches: Iterable[pa.RecordBatch], block: int, values: int, kind=None) -> Iterator[tuple[np.ndarray, ...]]:
    """Row numbers, ids, query marks and matrices of at most ``block`` rows (fewer, if
    they hold more than ``values`` numbers) of ``row, vec_id, query, v``."""
    for batch in batches:
        rows, ids, query = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        lists = batch.column(3)
        lengths = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(lengths) - lengths
        for dim in np.unique(lengths):
            own = np.flatnonzero(lengths == dim)
            size = max(1, min(block, values // int(dim)))
            for at in range(0, len(own), size):
                some = own[at:at + size]
                exact = flat[starts[some, None] + np.arange(dim)]
                yield (rows[some].astype(np.int64), ids[some].astype(np.int64), query[some].astype(bool),
                       exact if kind is None else exact.astype(kind))


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of ``row, vec_id, query, v``."""
    for columns in rows_by_length(batches, BLOCK, BLOCK_VALUES):
        yield pa.RecordBatch.from_pylist([_block(*columns)], schema=_schema())


def _schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in BLOCK_DDL.split(", "))])


class Block:
    """A block as arrays; the exact rows stay in their own precision."""

    def __init__(self, row: dict):
        def of(name: str, kind, width: int = 0):
            values = np.frombuffer(row[name], dtype=kind)
            return values.reshape(-1, row["dim"]) if width else values

        self.dim = row["dim"]
        self.rows, self.ids, self.query = of("rows", np.int64), of("ids", np.int64), of("query", bool)
        self.exact = of("exact", np.float64 if row["wide"] else np.float32, 1)
        self.codes = of("codes", np.int8, 1)
        self.scale, self.square, self.off = (of(n, np.float64) for n in ("scale", "square", "off"))


def _queries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The query rows ``row, vec_id, query, v`` of blocks."""
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row)
            own = np.flatnonzero(block.query)
            if len(own):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.rows[own]), pa.array(block.ids[own]), pa.array(block.query[own]),
                     pa.array(list(block.exact[own].astype(np.float64)), pa.list_(pa.float64()))],
                    names=["row", "vec_id", "query", "v"])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of 8-bit rows."""
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT):
        out += a[:, at:at + EXACT].astype(np.float32) @ b[:, at:at + EXACT].astype(np.float32).T
    return out


def distance_bounds(q: Block, some: slice, c: Block, others: slice) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances between the rows of two blocks."""
    with np.errstate(over="ignore", invalid="ignore"):
        both = q.square[some, None] + c.square[others]
        near = both - 2 * (q.scale[some, None] * c.scale[others]) * products(q.codes[some], c.codes[others])
        slack = 1e-12 * both
        off = q.off[some, None] + c.off[others]
        upper = (np.sqrt(np.maximum(near + slack, 0)) + off) * (1 + 1e-12)
        lower = (np.sqrt(np.maximum(near - slack, 0)) - off) * (1 - 1e-12)
        lower -= 1e-12 * off
    return np.where(np.isnan(lower), -np.inf, lower), np.where(np.isnan(upper), np.inf, upper)


class Search:
    """Heaps of the ``k`` nearest candidates of a block's queries."""

    def __init__(self, queries: Block, k: int):
        self.queries, self.k = queries, k
        # Worst first: (-distance, -vec_id).
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in queries.ids]
        self.limit = np.full(len(queries.ids), np.inf)
        self.computed = 0

    def meet(self, block: Block) -> None:
        for lo in range(0, len(self.heaps), TILE_QUERIES):
            for at in range(0, len(block.ids), TILE_ROWS):
                self._tile(slice(lo, lo + TILE_QUERIES), block, slice(at, at + TILE_ROWS))

    def _tile(self, some: slice, block: Block, others: slice) -> None:
        q, k = self.queries, self.k
        lower, upper = distance_bounds(q, some, block, others)
        own = q.rows[some, None] == block.rows[others]
        lower[own], upper[own] = np.inf, np.inf
        limit = self.limit[some]
        if upper.shape[1] >= k:
            limit = np.minimum(limit, np.partition(upper, k - 1, axis=1)[:, k - 1])
        i, j = np.nonzero((lower <= limit[:, None]) & ~own)
        i, j = i + some.start, j + others.start
        with np.errstate(over="ignore"):
            away = block.exact[j].astype(np.float64) - q.exact[i].astype(np.float64)
            away = np.sqrt((away * away).sum(axis=1))
        self.computed += len(i)
        for query, distance, vec_id in zip(i.tolist(), away.tolist(), block.ids[j].tolist()):
            heap, entry = self.heaps[query], (-distance, -vec_id)
            if len(heap) < k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == k:
                self.limit[query] = -heap[0][0]

    def found(self) -> pa.Table:
        hits = [(row, own, -v, -d) for row, own, heap in zip(self.queries.rows.tolist(), self.queries.ids.tolist(), self.heaps)
                for d, v in heap]
        kinds = (("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()))
        return pa.table([pa.array([h[at] for h in hits], kind) for at, (_, kind) in enumerate(kinds)],
                        names=[name for name, _ in kinds])


def _joined(k: int):
    """What a pair of groups does: all its queries against all its blocks."""
    def work(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        searches = [Search(Block(row), k) for row in queries.to_pylist()]
        for at in range(candidates.num_rows):
            block = Block(candidates.slice(at, 1).to_pylist()[0])
            for search in searches:
                if search.queries.dim == block.dim:
                    search.meet(block)
        out = [s.found() for s in searches]
        return pa.concat_tables(out) if out else pa.schema(
            [("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]).empty_table()
    return work


def vector_blocks(vectors: DataFrame, is_query: Column) -> DataFrame:
    """The written blocks of ``vec_id, embedding``."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    whole = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = (vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                           F.coalesce(is_query, F.lit(False)).alias("query"), F.col("embedding"))
            .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
            .where(F.coalesce(whole & F.exists(x, lambda e: e != 0), F.lit(False)))
            .select("row", "vec_id", "query", F.col("embedding").alias("v")))
    return written(map_batches(rows, _pack, BLOCK_DDL), "vector-blocks")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``vectors`` (``vec_id,
    embedding``) that ``is_query`` marks, the ``k`` nearest other rows."""
    blocks = vector_blocks(vectors, is_query)
    n_blocks, n_queries = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_queries"), F.lit(0))).first()
    query_groups = max(1, -(-n_queries // GROUP_QUERIES))
    dealt = (map_batches(blocks.where("n_queries > 0"), _queries, "row long, vec_id long, query boolean, v array<double>")
             .repartition(query_groups, "row"))
    queries = written(map_batches(dealt, _pack, BLOCK_DDL), "query-blocks")
    found = group_pairs(blocks, queries, n_blocks, query_groups, _joined(k),
                        "query long, query_id long, vec_id long, score double")
    best = Window.partitionBy("query").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def group_pairs(blocks: DataFrame, queries: DataFrame, n_blocks: int, query_groups: int, work, schema: str) -> DataFrame:
    """``work(candidate blocks, query blocks)`` for every pair of a group of blocks
    and a group of queries; both tables tell their blocks by ``block``."""
    # Groups of a few blocks; more of them while there are idle cores.
    block_groups = max(1, -(-n_blocks // GROUP_BLOCKS), min(n_blocks, blocks.sparkSession.sparkContext.defaultParallelism))

    def group(n: int) -> Column:
        return F.pmod(F.xxhash64("block"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    keys = ["block_group", "query_group"]
    return (blocks.withColumn("block_group", group(block_groups)).withColumn("query_group", every(query_groups)).groupBy(*keys)
            .cogroup(queries.withColumn("query_group", group(query_groups)).withColumn("block_group", every(block_groups)).groupBy(*keys))
            .applyInArrow(work, schema))


def q_block_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, F.col("vec_id") % 100 == 0, k=10)


SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), s AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, list_distance(q.v, c.v) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.row <> c.row AND len(q.v) = len(c.v)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY score, vec_id)::INT AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

"""Exact top-k search with vector-approximation files.

Vectors become integer vectors (``floor(256 * x)``) and are packed once into blocks
of at most ``BLOCK`` rows.  A block is its own approximation file: beside the exact
integers it keeps one byte per component, the number of the cell that the component
lies in (the component's range in the block is divided into 256 cells of one width).

For a query the best end of every cell gives an upper bound of the inner product:
``q . low + (q * width) . cells`` plus a constant of the query, so the bounds of a tile
are one product of the byte cells.  :class:`Search` scans the cells, leaves out the rows
whose bound is below the query's kth score so far, and reads the exact vectors of the
others in the order of their bounds until the kth score is above the next bound; the
kth score is handed on from block to block.  All scores are integer sums, and exact.

Query rows are dealt from the blocks into blocks of their own, groups of candidate
and query blocks meet as in :mod:`rateflow.llm.block_neighbours`, and each pair of
groups returns at most ``k`` rows per query, which are ranked once more.  Nothing but
the numbers of blocks and queries passes the driver.

Edge cases: a vector that is null or empty, or holds a null or a non-finite
component, takes no part as query or candidate, neither does a row without
``vec_id``, nor one with an integer of 2 ** 26 or more, whose scores could leave
the range of exact sums (up to 2,048 components).  Vectors meet only those of their
own length.  A query's own row is told by its place in the table: rows that repeat
its ``vec_id`` are candidates, and queries with a list of their own.  Ties go to the
smaller ``vec_id``; fewer candidates than k give fewer rows; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rateflow.llm.block_neighbours import GROUP_QUERIES, group_pairs, rows_by_length
from rateflow.llm.common import map_batches, written

LARGEST = 1 << 26
BLOCK, BLOCK_VALUES = 8192, 1 << 20
TILE_QUERIES, TILE_ROWS = 128, 2048

BLOCK_DDL = ("block long, dim int, n_queries int, rows binary, ids binary, query binary, exact binary, cells binary, "
             "low binary, width binary")
HITS_DDL = "query long, query_id long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, is_query: Column, scale: int = 256) -> DataFrame:
    """``row, vec_id, query, v`` (array<int>) of the vectors that take part."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    fits = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e * scale) < F.lit(LARGEST - 1)))
    return (vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                           F.coalesce(is_query, F.lit(False)).alias("query"), "embedding")
            .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
            .where((F.size("embedding") > 0) & F.coalesce(fits, F.lit(False)))
            .select("row", "vec_id", "query", F.transform(x, lambda e: F.floor(e * scale).cast("int")).alias("v")))


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Approximation files of ``row, vec_id, query, v``."""
    for rows, ids, query, exact in rows_by_length(batches, BLOCK, BLOCK_VALUES, np.int32):
        low = exact.min(axis=0).astype(np.int64)
        width = (exact.max(axis=0) - low) // 256 + 1
        yield pa.RecordBatch.from_pylist([{
            "block": int(rows[0]), "dim": exact.shape[1], "n_queries": int(query.sum()), "rows": rows.tobytes(),
            "ids": ids.tobytes(), "query": query.tobytes(), "exact": exact.tobytes(),
            "cells": ((exact - low) // width).astype(np.uint8).tobytes(), "low": low.tobytes(), "width": width.tobytes()}],
            schema=_SCHEMA)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
_SCHEMA = pa.schema([(name, _KINDS[kind]) for name, kind in (c.split() for c in BLOCK_DDL.split(", "))])


class ApproximationFile:
    """One block: ids, exact rows, and their cells with the ranges of these."""

    def __init__(self, row: dict):
        self.dim = row["dim"]
        self.rows, self.ids = (np.frombuffer(row[x], dtype=np.int64) for x in ("rows", "ids"))
        self.query = np.frombuffer(row["query"], dtype=bool)
        self.exact = np.frombuffer(row["exact"], dtype=np.int32).reshape(-1, self.dim)
        self.cells = np.frombuffer(row["cells"], dtype=np.uint8).reshape(-1, self.dim)
        self.low, self.width = (np.frombuffer(row[x], dtype=np.int64) for x in ("low", "width"))

    def bounds(self, queries: np.ndarray, rows: slice) -> np.ndarray:
        """Upper bounds of the inner products with integer ``queries``."""
        q = queries.astype(np.float64)
        step = q * self.width
        fixed = q @ self.low + np.maximum(q, 0) @ (self.width - 1)
        scanned = step.astype(np.float32) @ self.cells[rows].astype(np.float32).T
        # What the two roundings, of the products and of their sums, can lose.
        slack = 1e-6 * self.dim * 256 * np.abs(step).max(axis=1) + 1e-9 * np.abs(q) @ np.abs(self.low) + 1
        return scanned + (fixed + slack)[:, None]


class Search:
    """Heaps of the ``k`` best rows of the queries of a block."""

    def __init__(self, queries: ApproximationFile, k: int):
        self.queries, self.k = queries, k
        self.vectors = queries.exact.astype(np.int64)
        # Worst first: (score, -vec_id).
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in queries.ids]
        self.read = 0

    def meet(self, file: ApproximationFile) -> None:
        for lo in range(0, len(self.heaps), TILE_QUERIES):
            for at in range(0, len(file.ids), TILE_ROWS):
                bounds = file.bounds(self.vectors[lo:lo + TILE_QUERIES], slice(at, at + TILE_ROWS))
                for i, bound in enumerate(bounds, lo):
                    self._scan(i, bound, file, at)

    def _scan(self, i: int, bound: np.ndarray, file: ApproximationFile, at: int) -> None:
        heap, k = self.heaps[i], self.k
        own = file.rows[at:at + TILE_ROWS] == self.queries.rows[i]
        worst = heap[0][0] if len(heap) == k else -np.inf
        left = np.flatnonzero((bound >= worst) & ~own)
        step = 4 * k
        while len(left):
            if len(left) > step:
                order = np.argpartition(-bound[left], step)
                near, left = left[order[:step]], left[order[step:]]
            else:
                near, left = left, left[:0]
            scores = file.exact[at + near].astype(np.int64) @ self.vectors[i]
            self.read += len(near)
            for entry in zip(scores.tolist(), (-file.ids[at + near]).tolist()):
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                else:
                    heapq.heappushpop(heap, entry)
            if len(heap) == k:
                left = left[bound[left] >= heap[0][0]]
            step *= 4

    def found(self) -> pa.Table:
        hits = [(row, own, -v, s) for row, own, heap in zip(self.queries.rows.tolist(), self.queries.ids.tolist(), self.heaps)
                for s, v in heap]
        return pa.table([pa.array([h[at] for h in hits], pa.int64()) for at in range(4)],
                        names=["query", "query_id", "vec_id", "score"])


def _queries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The query rows ``row, vec_id, query, v`` of blocks."""
    for batch in batches:
        for row in batch.to_pylist():
            file = ApproximationFile(row)
            own = np.flatnonzero(file.query)
            yield pa.RecordBatch.from_arrays(
                [pa.array(file.rows[own]), pa.array(file.ids[own]), pa.array(file.query[own]),
                 pa.array(list(file.exact[own]), pa.list_(pa.int32()))], names=["row", "vec_id", "query", "v"])


def _joined(k: int):
    def work(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        searches = [Search(ApproximationFile(row), k) for row in queries.to_pylist()]
        for at in range(candidates.num_rows):
            file = ApproximationFile(candidates.slice(at, 1).to_pylist()[0])
            for search in searches:
                if search.queries.dim == file.dim:
                    search.meet(file)
        out = [s.found() for s in searches]
        return pa.concat_tables(out) if out else pa.schema([(c.split()[0], pa.int64()) for c in HITS_DDL.split(", ")]).empty_table()
    return work


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row of ``vectors`` (``vec_id,
    embedding``) that ``is_query`` marks, the k other rows with the highest
    inner product of the integer vectors."""
    blocks = written(map_batches(integer_vectors(vectors, is_query), _pack, BLOCK_DDL), "vector-files")
    n_blocks, n_queries = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_queries"), F.lit(0))).first()
    query_groups = max(1, -(-n_queries // GROUP_QUERIES))
    dealt = (map_batches(blocks.where("n_queries > 0"), _queries, "row long, vec_id long, query boolean, v array<int>")
             .repartition(query_groups, "row"))
    queries = written(map_batches(dealt, _pack, BLOCK_DDL), "query-files")
    found = group_pairs(blocks, queries, n_blocks, query_groups, _joined(k), HITS_DDL)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def q_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id AS vec_id,
         list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.row <> c.row AND len(q.v) = len(c.v)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id)::INT AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

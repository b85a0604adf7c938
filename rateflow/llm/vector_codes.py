"""Vector code compression: product codes by a dual-tree Lloyd iteration.

Vectors become integers (``floor(4096 * x)``) and are cut into ``PARTS`` equal
parts; every part position has a codebook of ``ENTRIES`` integer vectors.  A round
gives each part its nearest entry and moves each entry to the floor of the mean of
its parts.

The vectors are packed once into blocks of at most ``BLOCK`` rows (a few MB), and for every
part position of a block a tree over its parts is built and stored with it: per
node the box, the sum and the count of its parts (:class:`PartTree`).  In each round
a task sends the tree of a part position against a tree over the entries
(:func:`assign`), level by level for all nodes at once: for a pair of nodes the
boxes bound the distances from both sides, and a pair is dropped whose lower bound
is above another pair's upper bound; among single entries the half space
between two entries drops the one that is farther from every point of the box.  A
node with one entry left gives it its stored sum and count, or, in the last
round, its index, without reading a part.  Only leaves that stay uncertain are
compared part by part, in integers.  All arithmetic is 64-bit integer and exact.

A block returns one row per part position and entry (count, sums), these are added
up by Spark, and the driver sees the ``PARTS * ENTRIES`` new entries, nothing that
grows with the rows.

Edge cases: a vector that is null or holds a null or a non-finite component is
dropped.  Vectors take part if they are as long as the one with the smallest
``vec_id`` (of those with a positive multiple of ``PARTS`` components) and no
integer reaches 2 ** 28, the bound within which distances are exact; others
keep their row, with null code and error.  Null ids order last, rows of one id by
their components; fewer vectors than ``ENTRIES`` give as many entries; entries
that nothing is assigned to stay.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm.common import map_batches, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LARGEST = 1 << 28
# Rows of a block (fewer, if vectors are long) and parts of a leaf.
BLOCK, BLOCK_VALUES, LEAF = 8192, 1 << 20, 16
# Parts of the smaller table in the final join, so that no label is one task's.
LABEL_SHARES = 32


def integer_rows(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, v`` of the rows whose vector is whole; ``v`` is null
    where it cannot be cut or an integer is too large."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    whole = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    small = F.forall(x, lambda e: F.abs(e * scale) < F.lit(LARGEST - 1))
    fits = (F.size("embedding") > 0) & (F.size("embedding") % PARTS == 0) & small
    return (vectors.where(F.col("embedding").isNotNull()).where(F.coalesce(whole, F.lit(False)))
            .select(F.col("vec_id").cast("long").alias("vec_id"), "label",
                    F.when(fits, F.transform(x, lambda e: F.floor(e * scale).cast("int"))).alias("v")))


class PartTree:
    """Halves by the widest component down to ``LEAF`` parts.

    ``order`` lists the parts so that a node is ``order[start:end]``; the nodes
    of a level follow each other, and children are ``child`` and ``child + 1``
    (-1 for a leaf).
    """

    FIELDS = ("order", "start", "end", "child", "low", "high", "sums")

    def __init__(self, parts: np.ndarray):
        order = np.arange(len(parts))
        start, end, child = [0], [len(parts)], []
        at = 0
        while at < len(start):
            lo, hi = start[at], end[at]
            if hi - lo <= LEAF:
                child.append(-1)
            else:
                own = parts[order[lo:hi]]
                widest = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                mid = (hi - lo) // 2
                order[lo:hi] = order[lo:hi][np.argpartition(own[:, widest], mid)]
                child.append(len(start))
                start += [lo, lo + mid]
                end += [lo + mid, hi]
            at += 1
        self.order, self.start, self.end, self.child = order, np.array(start), np.array(end), np.array(child)
        sorted_parts = parts[order]
        self.low = np.array([sorted_parts[a:b].min(axis=0) for a, b in zip(start, end)])
        self.high = np.array([sorted_parts[a:b].max(axis=0) for a, b in zip(start, end)])
        totals = np.concatenate([np.zeros((1, parts.shape[1]), dtype=np.int64), np.cumsum(sorted_parts, axis=0)])
        self.sums = totals[self.end] - totals[self.start]


class EntryTree:
    """A binary tree over the entries: ``members`` (nodes x entries), boxes, children."""

    def __init__(self, entries: np.ndarray):
        members, child = [np.arange(len(entries))], []
        at = 0
        while at < len(members):
            own = members[at]
            if len(own) == 1:
                child.append(-1)
            else:
                rows = entries[own]
                widest = int(np.argmax(rows.max(axis=0) - rows.min(axis=0)))
                own = own[np.argsort(rows[:, widest], kind="stable")]
                child.append(len(members))
                members += [own[:len(own) // 2], own[len(own) // 2:]]
            at += 1
        self.child = np.array(child)
        self.low = np.array([entries[m].min(axis=0) for m in members])
        self.high = np.array([entries[m].max(axis=0) for m in members])
        self.single = np.array([m[0] if len(m) == 1 else -1 for m in members])


def _bounds(low, high, low2, high2) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared distance between points of two boxes, row by row."""
    gap = np.maximum(np.maximum(low - high2, low2 - high), 0)
    reach = np.maximum(high - low2, high2 - low)
    return (gap * gap).sum(axis=1), (reach * reach).sum(axis=1)


def assign(tree: PartTree, parts: np.ndarray, entries: np.ndarray) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """Entries of all parts of a tree.

    Returns the nodes that went to one entry as a whole ``[(nodes, entries)]``,
    the parts that were compared one by one, with their entries, and the number
    of node pairs looked at.
    """
    index = EntryTree(entries)
    square = (entries * entries).sum(axis=1)
    nodes, codes = np.array([0]), np.array([0])  # pairs of part node and entry node
    settled, loose_parts, loose_codes, visited = [], [], [], 0
    while len(nodes):
        visited += len(nodes)
        # Entry side first: divide until every pair has a single entry.
        while (index.single[codes] < 0).any():
            inner = index.single[codes] < 0
            both = np.concatenate([index.child[codes[inner]], index.child[codes[inner]] + 1])
            nodes = np.concatenate([nodes[~inner], nodes[inner], nodes[inner]])
            codes = np.concatenate([codes[~inner], both])
            least, most = _bounds(tree.low[nodes], tree.high[nodes], index.low[codes], index.high[codes])
            limit = np.full(len(tree.start), np.iinfo(np.int64).max)
            np.minimum.at(limit, nodes, most)
            keep = least <= limit[nodes]
            nodes, codes = nodes[keep], codes[keep]
        entry = index.single[codes]
        # The entry nearest to the middle of the box drops all that lie behind
        # the half space between them (of equally near ones the lower index wins).
        middle = tree.low[nodes] + tree.high[nodes]
        away = ((middle - 2 * entries[entry]) ** 2).sum(axis=1)
        order = np.lexsort((entry, away, nodes))
        nodes, codes, entry = nodes[order], codes[order], entry[order]
        first = np.r_[True, nodes[1:] != nodes[:-1]]
        best = entry[first][np.cumsum(first) - 1]
        towards = entries[best] - entries[entry]
        # Largest |x - best|^2 - |x - entry|^2 over the box.
        worst = square[best] - square[entry] - 2 * np.minimum(tree.low[nodes] * towards, tree.high[nodes] * towards).sum(axis=1)
        keep = (entry == best) | (worst > 0) | ((worst == 0) & (entry < best))
        nodes, codes, entry = nodes[keep], codes[keep], entry[keep]
        first = np.r_[True, nodes[1:] != nodes[:-1]]
        alone = np.diff(np.r_[np.flatnonzero(first), len(nodes)])[np.cumsum(first) - 1] == 1
        settled.append((nodes[alone], entry[alone]))
        nodes, codes, entry = nodes[~alone], codes[~alone], entry[~alone]
        leaf = tree.child[nodes] < 0
        if leaf.any():
            some, which = np.unique(nodes[leaf], return_inverse=True)
            possible = np.zeros((len(some), len(entries)), dtype=bool)
            possible[which, entry[leaf]] = True
            sizes = tree.end[some] - tree.start[some]
            own = tree.order[np.concatenate([np.arange(a, b) for a, b in zip(tree.start[some], tree.end[some])])]
            # |x|^2 is the same for all entries of a part.
            away = square - 2 * (parts[own] @ entries.T)
            away[~np.repeat(possible, sizes, axis=0)] = np.iinfo(np.int64).max
            loose_parts.append(own)
            loose_codes.append(away.argmin(axis=1))  # the lower index of equals
        nodes, codes = nodes[~leaf], codes[~leaf]
        nodes, codes = np.concatenate([tree.child[nodes], tree.child[nodes] + 1]), np.concatenate([codes, codes])
    none = [np.zeros(0, dtype=np.int64)]
    return settled, np.concatenate([*loose_parts, *none]), np.concatenate([*loose_codes, *none]), visited


def moved(tree: PartTree, parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Count and sums of the parts that go to each entry."""
    counts = np.zeros(len(entries), dtype=np.int64)
    sums = np.zeros(entries.shape, dtype=np.int64)
    settled, rows, codes, _ = assign(tree, parts, entries)
    for nodes, entry in settled:
        np.add.at(counts, entry, tree.end[nodes] - tree.start[nodes])
        np.add.at(sums, entry, tree.sums[nodes])
    np.add.at(counts, codes, 1)
    np.add.at(sums, codes, parts[rows])
    return counts, sums


def coded(tree: PartTree, parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each part."""
    out = np.empty(len(parts), dtype=np.int64)
    settled, rows, codes, _ = assign(tree, parts, entries)
    for nodes, entry in settled:
        for node, e in zip(nodes, entry):
            out[tree.order[tree.start[node]:tree.end[node]]] = e
    out[rows] = codes
    away = parts - entries[out]
    return out, (away * away).sum(axis=1)


BLOCK_DDL = "ids binary, no_id binary, labels array<string>, n int, width int, rows binary, trees array<binary>"


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of ``vec_id, label, v`` with the trees of all part positions."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = max(LEAF, min(BLOCK, BLOCK_VALUES // len(batch.column(2)[0])))
        for at in range(0, batch.num_rows, size):
            some = batch.slice(at, size)
            ids, n = some.column(0), some.num_rows
            lists = some.column(2)
            rows = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(n, -1)
            cut = rows.astype(np.int64).reshape(n, PARTS, -1)
            trees = [_stored(PartTree(np.ascontiguousarray(cut[:, p]))) for p in range(PARTS)]
            yield pa.RecordBatch.from_pydict({
                "ids": [ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes()],
                "no_id": [ids.is_null().to_numpy(zero_copy_only=False).astype(bool).tobytes()],
                "labels": pa.array([some.column(1).to_pylist()], pa.list_(pa.string())),
                "n": pa.array([n], pa.int32()), "width": pa.array([rows.shape[1]], pa.int32()),
                "rows": [rows.tobytes()], "trees": pa.array([trees], pa.list_(pa.binary()))})


def _stored(tree: PartTree) -> bytes:
    kinds = {"order": np.int32, "start": np.int32, "end": np.int32, "child": np.int32,
             "low": np.int32, "high": np.int32, "sums": np.int64}
    head = np.array([len(tree.order), len(tree.start)], dtype=np.int64).tobytes()
    return head + b"".join(np.ascontiguousarray(getattr(tree, f), dtype=kinds[f]).tobytes() for f in PartTree.FIELDS)


def _restored(data: bytes, width: int) -> PartTree:
    n, nodes = np.frombuffer(data, dtype=np.int64, count=2)
    tree, at = PartTree.__new__(PartTree), 16
    for field in PartTree.FIELDS:
        kind = np.int64 if field == "sums" else np.int32
        count = int(n if field == "order" else nodes * (width if field in ("low", "high", "sums") else 1))
        values = np.frombuffer(data, dtype=kind, count=count, offset=at)
        at += values.nbytes
        values = values.astype(np.int64)
        setattr(tree, field, values.reshape(-1, width) if field in ("low", "high", "sums") else values)
    return tree


def _opened(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict, list]]:
    for batch in batches:
        for i in range(batch.num_rows):
            block = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            cut = np.frombuffer(block["rows"], dtype=np.int32).astype(np.int64).reshape(block["n"], PARTS, -1)
            yield block, [(_restored(t, cut.shape[2]), np.ascontiguousarray(cut[:, p])) for p, t in enumerate(block["trees"])]


def _round(batches: Iterable[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``part, entry, at, n, total``: what a task adds to the entries' sums."""
    counts, sums = np.zeros(books.shape[:2], dtype=np.int64), np.zeros(books.shape, dtype=np.int64)
    for _, positions in _opened(batches):
        for p, (tree, parts) in enumerate(positions):
            n, total = moved(tree, parts, books[p])
            counts[p] += n
            sums[p] += total
    part, entry, at = (x.ravel() for x in np.indices(books.shape))
    yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(at, pa.int32()),
                                      pa.array(np.repeat(counts.ravel(), books.shape[2])), pa.array(sums.ravel())],
                                     names=["part", "entry", "at", "n", "total"])


def _codes(batches: Iterable[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    for block, positions in _opened(batches):
        codes, errors = zip(*(coded(tree, parts, books[p]) for p, (tree, parts) in enumerate(positions)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.frombuffer(block["ids"], dtype=np.int64), mask=np.frombuffer(block["no_id"], dtype=bool)),
             pa.array(block["labels"], pa.string()),
             pa.array([bytes(row).hex() for row in np.array(codes, dtype=np.uint8).T], pa.string()),
             pa.array(np.sum(errors, axis=0))], names=["vec_id", "label", "code", "error"])


def vector_blocks(rows: DataFrame, width: int) -> DataFrame:
    """The written blocks of the rows with ``width`` components."""
    own = rows.where(F.size("v") == width).select("vec_id", F.col("label").cast("string").alias("label"), "v")
    return written(map_batches(own, _blocks, BLOCK_DDL), "code-blocks")


def codebooks(blocks: DataFrame, first: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """``parts x entries x components`` after ``rounds`` from the ``first`` ones."""
    books = first
    for _ in range(rounds):
        now = books
        sums = (map_batches(blocks, lambda batches: _round(batches, now), "part int, entry int, at int, n long, total long")
                .groupBy("part", "entry", "at")
                .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")))
        books = now.copy()
        for r in sums.where("n > 0").collect():  # one row per component of the codebooks
            books[r["part"], r["entry"], r["at"]] = int(r["total"]) // r["n"]
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for a table
    ``vec_id, embedding, label``."""
    spark = vectors.sparkSession
    rows = integer_rows(vectors)
    head = rows.where("v IS NOT NULL").orderBy(F.asc_nulls_last("vec_id"), "v").select(F.size("v").alias("width")).first()
    width = head["width"] if head else PARTS
    seeds = (rows.where(F.size("v") == width).orderBy(F.asc_nulls_last("vec_id"), "v").limit(ENTRIES)
             .select("v").collect())
    rest = rows.where(F.coalesce(F.size("v") != width, F.lit(True))).select(
        "vec_id", F.col("label").cast("string").alias("label"), F.lit(None).cast("string").alias("code"),
        F.lit(None).cast("long").alias("error"))
    if not seeds:
        books = np.zeros((PARTS, 0, width // PARTS), dtype=np.int64)
        out = rest
    else:
        first = np.array([s["v"] for s in seeds], dtype=np.int64).reshape(len(seeds), PARTS, -1).swapaxes(0, 1)
        blocks = vector_blocks(rows, width)
        books = codebooks(blocks, np.ascontiguousarray(first), rounds)
        final = books
        out = written(map_batches(blocks, lambda batches: _codes(batches, final),
                                  "vec_id long, label string, code string, error long").unionByName(rest), "codes")
    # Sums per label go back to the rows in shares, so that one label with most
    # of the rows is no single task's.
    own = F.struct(F.col("label").isNull().alias("none"), F.coalesce("label", F.lit("")).alias("label"))
    sums = (out.groupBy(own.alias("_own")).agg(F.sum("error").alias("label_error"))
            .withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SHARES - 1)))))
    return (out.withColumn("_own", own).withColumn("_share", F.pmod(F.xxhash64("vec_id", "code"), F.lit(LABEL_SHARES)).cast("int"))
            .join(sums, ["_own", "_share"])
            .select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")))


def q_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))


def _sql() -> str:
    """Lloyd's rounds one after the other, on distances of all parts to all entries."""
    out = ["""WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, list_transform(embedding, lambda x: x::DOUBLE)) AS row, vec_id, label,
         list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT row, vec_id, label, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS w
  FROM kept, (SELECT unnest(range(8)) AS p)
), book0 AS (SELECT p, row - 1 AS e, w AS b FROM parts WHERE row <= 16)"""]
    for i in range(ROUNDS + 1):
        out.append(f"""near{i} AS MATERIALIZED (
  SELECT row, p, any_value(vec_id) AS vec_id, any_value(label) AS label, any_value(w) AS w,
         arg_min({{'e': e, 'd': d}}, (d, e)) AS best
  FROM (SELECT x.*, e, list_sum(list_transform(list_zip(w, b), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM parts x JOIN book{i} USING (p)) GROUP BY row, p
)""")
        if i < ROUNDS:
            out.append(f"""mean{i} AS (
  SELECT p, e, list((s - ((s % c) + c) % c) // c ORDER BY i) AS b FROM (
    SELECT p, best.e AS e, i, sum(w[i])::BIGINT AS s, count(*) AS c
    FROM near{i}, (SELECT unnest(range(1, (SELECT max(len(w)) FROM parts) + 1)) AS i) GROUP BY p, best.e, i) GROUP BY p, e
), book{i + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(mean{i}.b, book{i}.b) AS b FROM book{i} LEFT JOIN mean{i} USING (p, e)
)""")
    out.append(f"""codes AS (
  SELECT row, any_value(vec_id) AS vec_id, any_value(label) AS label,
         string_agg(printf('%02x', best.e::INT), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
  FROM near{ROUNDS} GROUP BY row
), book AS (
  SELECT sha256(string_agg(array_to_string(b, ','), ',' ORDER BY p, e)) AS h FROM book{ROUNDS}
)""")
    return ",\n".join(out) + """
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM codes, book
"""


SQL = _sql()

"""Best-fit decreasing packing of documents into token sequences.

Best-fit decreasing needs only how many pieces there are of each length, so
the corpus is reduced to a histogram of at most ``max_tokens`` rows.  The
plan places lengths in falling order; a segment tree over the remaining
capacities finds the tightest open bin in logarithmic time, and all pieces of
one length that go to equal bins are placed in one step.  The plan's steps
(a few thousand, bounded by ``max_tokens``, not by the data) are broadcast,
and each piece finds its place from its length and its rank among the pieces
of that length.  Ranks come from counts per input partition and length, so no
length, however frequent, gathers in one task.

Token ids are those of the byte-level BPE vocabulary (the merge ranks are its
ids); the special token's string in a text stands for its id, and ``END`` follows
each document.

Edge cases: a null or empty text is one piece that holds only ``END``; very
long texts are cut into pieces of ``max_tokens`` of which only the first may
be shorter; rows that repeat a ``doc_id`` or have none are packed as they
come; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rateflow.llm.common import documents, local_table, map_batches, text_of, written

MAX_TOKENS = 1024
END = 2
SPECIAL = {"<|endoftext|>": 50256}

_ENCODERS: dict = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(path: str):
    """The encoder of a rank file, made once per Python worker."""
    if path not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    return _ENCODERS[path]


def token_ids(text: str, path: str) -> np.ndarray:
    ids = encoder(path).encode_to_numpy(text, allowed_special="all")
    return np.append(ids.astype("<u4"), np.uint32(END)).astype("<u4")


def tokenised_pieces(docs: DataFrame, path: str | None = None, max_tokens: int = MAX_TOKENS,
                     with_ids: bool = False) -> DataFrame:
    """Pieces of every document with their rank among the partition's pieces
    of equal length: ``_part, _rank, doc_id, piece, start, length, ids_crc32``
    and ``ids`` if asked for."""
    path = path or default_vocabulary()
    fields = [("_part", pa.int32()), ("_rank", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()),
              ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
    schema = pa.schema(fields)

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen = [0] * (max_tokens + 1)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                some = batch.slice(at, 256)
                for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    ids = token_ids(text, path)
                    first = len(ids) % max_tokens or max_tokens
                    ends = range(first, len(ids) + 1, max_tokens)
                    for piece, end in enumerate(ends):
                        start = 0 if piece == 0 else end - max_tokens
                        own = ids[start:end]
                        row = (part, seen[len(own)], doc_id, piece, start, len(own), zlib.crc32(own.tobytes()))
                        rows.append((*row, own.astype(np.int32)) if with_ids else row)
                        seen[len(own)] += 1
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(x), type=f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

    ddl = "_part int, _rank long, doc_id long, piece int, start long, length long, ids_crc32 long"
    return map_batches(docs.select(F.col("doc_id").cast("long"), text_of(docs)), pieces,
                       ddl + (", ids array<int>" if with_ids else ""))


class OpenBins:
    """Open bins by remaining capacity, under a segment tree that finds the
    smallest capacity of at least a given size that has an open bin."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)
        self.groups: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _mark(self, capacity: int) -> None:
        node = capacity + self.leaves
        self.any[node] = bool(self.groups[capacity])
        while node > 1:
            node //= 2
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]

    def put(self, capacity: int, first: int, count: int) -> None:
        if count:
            self.groups[capacity].append((first, count))
            self._mark(capacity)

    def take(self, capacity: int) -> tuple[int, int]:
        group = self.groups[capacity].pop()
        self._mark(capacity)
        return group

    def tightest(self, size: int) -> int | None:
        node = size + self.leaves
        if self.any[node]:
            return size
        while node > 1:
            if node % 2 == 0 and self.any[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.any[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over ``counts`` (pieces of each length).

    Steps ``(length, from_rank, to_rank, per_bin, first_bin, offset)``: the
    pieces of that length with these ranks fill bins from ``first_bin`` on,
    ``per_bin`` in each, from ``offset`` on.
    """
    bins, steps, opened = OpenBins(capacity), [], 0
    for length in sorted((x for x in counts if counts[x]), reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = bins.tightest(length)
            if room is None:
                each = capacity // length
                first, n_bins, room = opened, -(-left // each), capacity
                opened += n_bins
            else:
                first, n_bins = bins.take(room)
                each = room // length
            full = min(left // each, n_bins)
            rest = min(left - full * each, each - 1) if full < n_bins else 0
            for n, k, at in ((full, each, first), (int(rest > 0), rest, first + full)):
                if n:
                    steps.append((length, rank, rank + n * k, k, at, capacity - room))
                    bins.put(room - k * length, at, n)
                    rank += n * k
                    left -= n * k
            used = full + int(rest > 0)
            bins.put(room, first + used, n_bins - used)
    return steps


def placed(pieces: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to written pieces."""
    spark = pieces.sparkSession
    per_part = pieces.groupBy("_part", "length").agg(F.count("*").alias("_n"))
    # One row per length, at most max_tokens.
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    steps = local_table(
        spark, plan_bins(counts, max_tokens),
        "_length long, _from long, _to long, _each long, _bin long, _at long")
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("_part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = (pieces.join(offsets, ["_part", "length"])
              .withColumn("_r", F.col("_before") + F.col("_rank")))
    hit = (F.col("length") == F.col("_length")) & (F.col("_r") >= F.col("_from")) & (F.col("_r") < F.col("_to"))
    index = F.col("_r") - F.col("_from")
    return ranked.join(F.broadcast(steps), hit).select(
        *[c for c in pieces.columns if not c.startswith("_")],
        (F.col("_bin") + F.expr("(_r - _from) div _each")).alias("sequence_id"),
        (F.col("_at") + (index % F.col("_each")) * F.col("length")).alias("offset"))


def pack(docs: DataFrame, path: str | None = None, max_tokens: int = MAX_TOKENS,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32[, ids],
    sequence_id, offset``."""
    return placed(written(tokenised_pieces(docs, path, max_tokens, with_ids), "pieces"), max_tokens)


def sequences(docs: DataFrame, path: str | None = None, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """One row per packed sequence: ``sequence_id, ids`` (the pieces' ids in
    order) and ``doc_ids`` (the document of each piece)."""
    rows = pack(docs, path, max_tokens, with_ids=True)
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return (rows.groupBy("sequence_id").agg(parts.alias("_p"))
            .select("sequence_id", F.flatten("_p.ids").alias("ids"), F.col("_p.doc_id").alias("doc_ids")))


def q_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))

"""Removal of repeated byte strings by a distributed merge sort of suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else
in the corpus as well.

1. Suffixes are sorted only where they can matter.  In every window of
   ``LENGTH`` bytes the leftmost least hash of its ``GRAM``-byte strings is the
   window's anchor; equal windows have equal anchors at the same place.  An
   anchor whose gram occurs once in the corpus is dropped (distinguishing
   prefixes: the sort never exchanges bytes that cannot match).
2. Each task cuts, for its anchors, the suffix that starts at the anchor (as
   far as the anchor's windows reach) and the bytes before it, sorts them,
   merges equal ones, front-codes them and sends them as runs; equal grams
   meet in one task.
3. There the runs are merged by a loser tree that knows common prefixes.
   Among the suffixes of one gram, in order, the best match to the right of any
   class of equal left sides is a neighbour in the class; classes are split by
   the next byte to the left, so every pair of equal windows is found without
   listing pairs.
4. The covered intervals go back to their documents, which are joined once more.

Edge cases: a null text is the empty text; texts shorter than ``LENGTH`` keep
all bytes; rows are told apart by their place in the table, so rows that repeat a
``doc_id`` or have none are documents of their own; texts of one byte over and
over have an anchor at every byte, merged before they are sent; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm.common import documents, map_batches, shuffle_partitions, text_of, written
from rateflow.llm.loser_tree import common_prefix, merged
from rateflow.llm.near_dedup import _by_key
from rateflow.llm.shingles import batch_bytes, mixed, powers

LENGTH = 400
GRAM = 64
RUN_BYTES = 24 << 20     # a task sends its suffixes as a run whenever it holds so many bytes
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = np.random.default_rng(400).integers(0, 2**64, 256, dtype=np.uint64)
PLACE = np.uint64((1 << 24) - 1)


def anchors(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Anchors of the windows of texts that lie one after the other in ``data``
    (less than 2**24 bytes): place, first and last window start, gram hash."""
    n, none = len(data), np.empty(0, np.int64)
    if n < length:
        return none, none, none, none
    power, inverse = powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * power[:-1], out=sums[1:])
    hashes = mixed((sums[gram:] - sums[:-gram]) * inverse[:n - gram + 1])
    ranked = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
    # Sliding minimum over the grams of a window: suffix minima of a block meet prefix minima of the next.
    w = length - gram + 1
    blocks = -(-len(ranked) // w)
    padded = np.full(blocks * w, np.uint64(2**64 - 1))
    padded[:len(ranked)] = ranked
    padded = padded.reshape(blocks, w)
    down = np.minimum.accumulate(padded, axis=1).ravel()
    up = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - length + 1
    least = (np.minimum(up[:starts], down[w - 1:w - 1 + starts]) & PLACE).astype(np.int64)
    begins = np.concatenate([[0], ends[:-1]])
    valid = np.zeros(starts + 1, dtype=np.int32)
    usable = ends - begins >= length
    np.add.at(valid, begins[usable], 1)
    np.add.at(valid, ends[usable] - length + 1, -1)
    windows = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
    if not len(windows):
        return none, none, none, none
    place = least[windows]
    cut = np.flatnonzero(place[1:] != place[:-1]) + 1
    first = np.concatenate([[0], cut])
    last = np.append(cut, len(windows)) - 1
    return place[first], windows[first], windows[last], hashes[place[first]].view(np.int64)


def _pieces(ends: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes (a longer text is alone)."""
    first = 0
    while first < len(ends):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield first, last
        first = last


def _long_anchors(data: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchors of one text of any size, in overlapping parts."""
    part = 1 << 20
    for at in range(0, max(1, len(data) - length + 1), part):
        own = data[at:at + part + length - 1]
        place, lo, hi, h = anchors(own, np.array([len(own)]), length, gram)
        yield place + at, lo + at, hi + at, h


def anchored(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``gram, row, place, lo, hi``: byte places within the row's text."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            data, ends = batch_bytes(batch.column(1))
            for first, last in _pieces(ends):
                base = ends[first - 1] if first else 0
                own, own_ends = data[base:ends[last - 1]], ends[first:last] - base
                parts = _long_anchors(own, length, gram) if last - first == 1 else [
                    anchors(own, own_ends, length, gram)]
                for place, lo, hi, h in parts:
                    text = np.searchsorted(own_ends, lo, side="right")
                    begin = np.concatenate([[0], own_ends])[text]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h), pa.array(ids[first:last][text]),
                         *[pa.array((x - begin).astype(np.int32)) for x in (place, lo, hi)]],
                        names=["gram", "row", "place", "lo", "hi"])

    return map_batches(keyed.select("row", "text"), rows, "gram long, row long, place int, lo int, hi int")


def _packed(members: list[tuple[bytes, bytes, list]]) -> bytes:
    """A front-coded run of ``(suffix, left, positions)`` sorted by suffix."""
    import zstandard

    shared, tails, before = [], [], b""
    for suffix, _, _ in members:
        n = common_prefix(before, suffix)
        shared.append(n)
        tails.append(suffix[n:])
        before = suffix
    numbers = np.array([shared, [len(x) for x in tails], [len(m[1]) for m in members],
                        [len(m[2]) for m in members]], dtype="<i4")
    where = np.array([p for m in members for p in m[2]], dtype="<i8")
    parts = [np.array([len(members), len(where)], dtype="<i8").tobytes(), numbers.tobytes(), where.tobytes(),
             *tails, *[m[1] for m in members]]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _unpacked(blob: bytes) -> Iterator[tuple[bytes, int, tuple[bytes, np.ndarray]]]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, n_where = np.frombuffer(raw, "<i8", 2).tolist()
    numbers = np.frombuffer(raw, "<i4", 4 * n, 16).reshape(4, n)
    where = np.frombuffer(raw, "<i8", 2 * n_where, 16 + 16 * n).reshape(n_where, 2)
    tail = 16 + 16 * n + 16 * n_where
    left = tail + int(numbers[1].sum())
    suffix, at = b"", 0
    for shared, n_tail, n_left, n_own in numbers.T.tolist():
        suffix = suffix[:shared] + raw[tail:tail + n_tail]
        yield suffix, shared, (raw[left:left + n_left], where[at:at + n_own])
        tail, left, at = tail + n_tail, left + n_left, at + n_own


def sorted_runs(rows: DataFrame, targets: int, length: int = LENGTH) -> DataFrame:
    """``target, run`` from rows ``row, text, found`` (the row's anchors)."""
    def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict] = defaultdict(dict)
        size = 0

        def sent() -> pa.RecordBatch:
            out = [(t, _packed(sorted((*key, places) for key, places in own.items()))) for t, own in held.items()]
            return pa.RecordBatch.from_arrays([pa.array([t for t, _ in out], pa.int32()),
                                               pa.array([b for _, b in out], pa.binary())], names=["target", "run"])

        for batch in batches:
            for row, text, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                text = text.as_buffer().to_pybytes()
                values = found.values
                gram, place, lo, hi = (values.field(i).to_numpy().tolist() for i in range(4))
                for g, a, first, last in zip(gram, place, lo, hi):
                    key = text[a:last + length], text[first:a]
                    places = held[g % targets].setdefault(key, [])
                    if not places:
                        size += last + length - first + 200
                    places.append((row, a))
                    size += 100
                if size > RUN_BYTES:
                    yield sent()
                    held.clear()
                    size = 0
        if held:
            yield sent()

    return map_batches(rows, runs, "target int, run binary")


def covered(members: list[tuple[bytes, bytes, list]], prefixes: list[int], length: int = LENGTH) -> Iterator[tuple]:
    """For the sorted suffixes of one gram ``(suffix, left, positions)`` with
    ``prefixes[i]`` common with the one before: ``(member, back, ahead)``, the
    bytes before and after the anchor that repeated windows cover."""
    n = len(members)
    lefts = [m[1][::-1] for m in members]
    for i, (suffix, left, places) in enumerate(members):
        if len(places) > 1:
            yield i, len(left), len(suffix)
    # A class: members in order, each with its common prefix with the one before it in the class.
    classes = [(list(range(n)), [0, *prefixes[1:]], 0)]
    while classes:
        own, common, depth = classes.pop()
        if len(own) < 2:
            continue
        first = lefts[own[0]]
        back = len(first)
        for i in own[1:]:
            back = min(back, common_prefix(first, lefts[i], depth)) if back > depth else depth
        for j, i in enumerate(own):
            ahead = max(common[j] if j else 0, common[j + 1] if j + 1 < len(own) else 0)
            if back + ahead >= length:
                yield i, back, ahead
        parts: dict[int, tuple[list, list]] = {}
        least: dict[int, int] = {}
        for j, i in enumerate(own):
            if j:
                for c in least:
                    if common[j] < least[c]:
                        least[c] = common[j]
            if len(lefts[i]) > back:
                c = lefts[i][back]
                ids, shared = parts.setdefault(c, ([], []))
                shared.append(least.get(c, 0) if ids else 0)
                ids.append(i)
                least[c] = 1 << 30
        for ids, shared in parts.values():
            if len(ids) > 1 and max(shared) + max(len(lefts[i]) for i in ids) >= length:
                classes.append((ids, shared, back))


def repeated(runs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``row, start, stop``: intervals of bytes covered by repeated windows."""
    def flushed(out: list) -> pa.RecordBatch:
        found = np.array(out, dtype=np.int64).reshape(-1, 3)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1].astype(np.int32)),
                                           pa.array(found[:, 2].astype(np.int32))], names=["row", "start", "stop"])

    def solved(group: list, prefixes: list, out: list) -> None:
        if len(group) == 1 and len(group[0][2]) == 1:
            return
        for i, back, ahead in covered(group, prefixes, length):
            out.extend((row, a - back, a + ahead) for row, a in group[i][2])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for target in _by_key(batches):
            out: list = []
            group: list = []
            prefixes: list[int] = []
            same: dict[bytes, int] = {}      # left sides of the suffix at hand
            blobs = [x.as_buffer().to_pybytes() for x in target.column(1)]
            for suffix, prefix, (left, where) in merged([_unpacked(b) for b in blobs]):
                if prefix < gram:
                    solved(group, prefixes, out)
                    group, prefixes, same = [], [], {}
                    if len(out) > 20_000:
                        yield flushed(out)
                        out = []
                if not group or prefix < len(suffix) or len(group[-1][0]) != len(suffix):
                    same = {}
                if left in same:
                    group[same[left]][2].extend(where.tolist())
                else:
                    same[left] = len(group)
                    group.append((suffix, left, where.tolist()))
                    prefixes.append(prefix)
            solved(group, prefixes, out)
            yield flushed(out)

    ordered = runs.repartition("target").sortWithinPartitions("target")
    return map_batches(ordered, rows, "row long, start int, stop int")


def merged_spans(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals as maximal runs."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    first = np.flatnonzero(np.append(True, starts[1:] > stops[:-1]))
    return starts[first], stops[np.append(first[1:] - 1, len(starts) - 1)]


def with_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, text, found``: every row with its covered intervals (null if
    there are none)."""
    n = shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       text_of(docs).alias("text"))
    keyed = written(rows, "texts")
    marks = written(anchored(keyed, length, gram), "anchors")
    often = marks.groupBy("gram").agg(F.count("*").alias("_n")).where("_n > 1").select("gram")
    found = (marks.join(often, "gram").groupBy("row")
             .agg(F.collect_list(F.struct("gram", "place", "lo", "hi")).alias("found")))
    # One exchange of the texts serves both joins (the filter, always true, is the one the inner join infers).
    dealt = keyed.where(F.col("row").isNotNull()).repartition(n, "row")
    suffixes = dealt.join(found.hint("shuffle_hash"), "row").select("row", "text", "found", "doc_id")
    spans = repeated(sorted_runs(suffixes, 4 * n, length), length, gram)
    own = spans.groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("found"))
    return dealt.join(own.hint("shuffle_hash"), "row", "left").select("doc_id", "text", "found")


def _remains(text: bytes, found: pa.ListScalar) -> tuple[bytes, list[tuple[int, int]]]:
    """What stays of a text, and the maximal runs that go."""
    if not found.is_valid:
        return text, []
    starts, stops = merged_spans(*[found.values.field(i).to_numpy() for i in (0, 1)])
    cuts = list(zip(starts.tolist(), stops.tolist()))
    edges = [0, *[x for cut in cuts for x in cut], len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])), cuts


def cleaned(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, kept`` (the remaining bytes), ``spans`` (removed byte ranges,
    maximal) and ``n_bytes`` of every row."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _slices(batches):
            sizes, kept, spans = [], [], []
            for text, found in zip(some.column(1), some.column(2)):
                stays, cuts = _remains(text.as_buffer().to_pybytes(), found)
                sizes.append(len(text.as_buffer()))
                kept.append(stays)
                spans.append([{"start": a, "stop": b} for a, b in cuts])
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array(kept, pa.binary()), pa.array(spans, span), pa.array(sizes, pa.int64())],
                names=["doc_id", "kept", "spans", "n_bytes"])

    return map_batches(with_spans(docs, length, gram), rows,
                       "doc_id long, kept binary, spans array<struct<start: int, stop: int>>, n_bytes long")


def digests(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row; the
    texts themselves do not come back from the workers."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _slices(batches):
            out = []
            for text, found in zip(some.column(1), some.column(2)):
                stays, cuts = _remains(text.as_buffer().to_pybytes(), found)
                size = len(text.as_buffer())
                out.append((size, size - len(stays), len(cuts), hashlib.sha256(stays).hexdigest()))
            types = [pa.int64()] * 3 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [some.column(0), *[pa.array(x, t) for x, t in zip(zip(*out), types)]], names=names)

    return map_batches(with_spans(docs, length, gram), rows,
                       "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _slices(batches: Iterable[pa.RecordBatch], n: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, n):
            yield batch.slice(at, n)


def q_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))

"""Near-duplicate documents by chosen-path set similarity join.

A document is the set of its distinct word shingles; two are linked if their
sets have a Jaccard similarity of ``PERCENT`` or more, and a component of links
is one group.  Equal sets are first made one class, so copies cost nothing.

In each of ``TREES`` independent trees a node picks minwise coordinates by a
hash of its path, 4/3 on average (1 / similarity), and its documents branch by
their minwise tokens there, so unrelated documents part.  From the second level on (a
token that one common phrase shares is no sign of similarity) a node of at most ``LIMIT``
documents is compared exhaustively by signatures; larger nodes branch on (by
one coordinate a level, so that a group of near copies does not grow) and, in
the first ``STAR_TREES`` trees, offer each document to the node's smallest one.
Nodes that are still large after ``MAX_DEPTH`` levels hold almost equal sets;
they are compared in pieces of at most about ``LIMIT``.

A linked pair survives a path of depth d with J^d only, so large nodes part
links.  Once the first components are known, a large node of which at most
``LIMIT / 2`` documents are outside its largest component is compared in full
(these against all others, in pieces); the documents of the other large nodes
are rooted again in as many more trees as let a pair at the threshold meet at the
depth of their deepest path with the chance ``TARGET``.

What the signatures let pass (an estimate of at least ``LEAST``, more than
three standard errors below the threshold: about one link in 1,600 at exactly the
threshold is lost here, fewer above it) is confirmed on the full sets.  A
node with very many such pairs first offers a maximum spanning forest of them;
once the components of those links are known, its pairs between different
components are confirmed inside the node, where each full set is sent once, so
a group of copies never emits all its pairs.

Edge cases: a null or empty text, or one of white space, has no shingle and is
linked with nothing.  A row without ``doc_id`` is linked with nothing, kept and
stays (its ``component_id`` is null).  Rows that share a ``doc_id`` are linked
each by its own text; ``kept`` says whether a row has the smallest ``doc_id`` of its
group, and ``stays`` marks one row of each group: of its smallest ``doc_id`` the one
whose text has the smallest hash.  :func:`near_dedup` keeps the rows that stay.
An empty table gives an empty result; extra columns are ignored by
:func:`near_groups` and kept by :func:`near_dedup`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm.common import documents, id_filter, map_batches, maybe_in, text_of, written
from rateflow.llm.components import components
from rateflow.llm.shingles import batch_bytes, shingle_sets, signature

PERCENT = 75
TREES = 16
PATHS = TREES + len(range(0, TREES, 3))  # see _first_level
STAR_TREES = 2
TARGET = 0.99  # chance that a pair at the threshold meets
LIMIT = 1024
LEVELS = 3     # levels that a large node is branched at a time
MAX_DEPTH = 25
COORDINATES = 128
LEAST = 0.62
SPARSE = 2     # pairs per document up to which a node offers them all
SET_ROWS = 512  # rows with full sets or signatures that go to Python at once


def described(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, row, n_shingles, digest, sig`` of every row (the last
    two null for empty sets); ``row`` is a number to be written with the rest,
    ``sig`` is 128 minwise values of 32 bits."""
    names = ["doc_id", "text_hash", "row", "n_shingles", "digest", "sig"]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                sets = shingle_sets(*batch_bytes(some.column(3)))
                yield pa.RecordBatch.from_arrays([
                    *some.columns[:3], pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([signature(s).astype("<u4").tobytes() if len(s) else None for s in sets], pa.binary()),
                ], names=names)

    text = text_of(docs)
    return map_batches(docs.select(F.col("doc_id").cast("long"), F.xxhash64(text), F.monotonically_increasing_id(), text),
                       rows, "doc_id long, text_hash long, row long, n_shingles long, digest binary, sig binary")


def _child(key: Column, sig: Column, salt: int = 1) -> Column:
    """The node below ``key`` that a document goes to by a coordinate drawn there."""
    at = F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(COORDINATES))
    return F.xxhash64(key, at, F.substring(sig, (4 * at + 1).cast("int"), F.lit(4)))


def _first_level(reps: DataFrame) -> DataFrame:
    """``key, id, tree, sig``: the roots branch by 4/3 coordinates on average."""
    key, sig = F.xxhash64("tree"), F.col("sig")
    both = F.array_distinct(F.array(_child(key, sig), _child(key, sig, 2)))
    rows = reps.select("id", "sig", F.explode(F.array(*[F.lit(t) for t in range(TREES)])).alias("tree"))
    return rows.select(F.explode(F.when(F.col("tree") % 3 == 0, both).otherwise(F.array(_child(key, sig))))
                       .alias("key"), "id", "tree", "sig")


def _below(rows: DataFrame, levels: int) -> DataFrame:
    """``key, parent, id, tree`` of the nodes ``levels`` below those of ``key, id, tree, sig``."""
    rows = rows.withColumn("parent", F.col("key"))
    for _ in range(levels):
        rows = rows.withColumn("key", _child(F.col("key"), F.col("sig")))
    return rows.select("key", "parent", "id", "tree")


def _sized(rows: DataFrame) -> DataFrame:
    """Nodes of two documents or more: ``key, parent, id, tree, n, pivot``."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("pivot")).where("n > 1")
    return rows.join(sizes, "key")


def small_nodes(reps: DataFrame) -> tuple[DataFrame, DataFrame, list[tuple[int, DataFrame]]]:
    """All nodes of at most ``LIMIT`` documents (``key, id, n``), the star
    pairs ``a, b`` of the larger ones, and these by their depth."""
    first = _below(_first_level(reps), 1).withColumn("parent", F.lit(0).cast("long"))
    nodes, depth = written(_sized(first), "nodes"), 2
    small, stars, by_depth = [], [], []
    while True:
        small.append(nodes.where(F.col("n") <= LIMIT).select("key", "id", "n"))
        large = nodes.where(F.col("n") > LIMIT)
        if large.isEmpty():
            break
        by_depth.append((depth, large))
        stars.append(large.where((F.col("tree") < STAR_TREES) & (F.col("pivot") < F.col("id")))
                     .select(F.col("pivot").alias("a"), F.col("id").alias("b")))
        if depth >= MAX_DEPTH:
            piece = F.xxhash64("key", F.pmod(F.xxhash64("id"), F.ceil(2 * F.col("n") / LIMIT)))
            small.append(large.select(piece.alias("key"), "id", F.lit(LIMIT).cast("long").alias("n")))
            break
        nodes = written(_sized(_below(large.select("key", "id", "tree").join(reps, "id"), LEVELS)), "nodes")
        depth += LEVELS
    all_stars = reps.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    return reduce(DataFrame.unionAll, small), reduce(DataFrame.unionAll, stars, all_stars).distinct(), by_depth


def _weighed(large: list[tuple[int, DataFrame]], labelled: DataFrame) -> DataFrame:
    """``depth, key, parent, n, main, rest`` of large nodes: their largest
    component and the number of documents outside it."""
    rows = reduce(DataFrame.unionAll, [nodes.select(F.lit(depth).alias("depth"), "key", "parent", "id")
                                       for depth, nodes in large])
    counts = rows.join(labelled, "id").groupBy("depth", "key", "parent", "label").agg(F.count("*").alias("c"))
    most = F.max(F.struct("c", "label"))
    return written(counts.groupBy("depth", "key", "parent").agg(
        F.sum("c").alias("n"), most["label"].alias("main"), (F.sum("c") - most["c"]).alias("rest")), "weighed")


def _against_main(nodes: DataFrame, weighed: DataFrame, labelled: DataFrame) -> DataFrame:
    """``key, id`` of pieces of at most about ``LIMIT``, in which the ``rest`` of
    each node of ``weighed`` meets itself and the whole largest component."""
    pieces = F.ceil(2 * F.col("_all") / LIMIT)
    own = weighed.where((F.col("rest") > 0) & (2 * F.col("rest") <= LIMIT)).select("key", F.col("n").alias("_all"), "main")
    rows = nodes.select("key", "id").join(own, "key").join(labelled, "id")
    at = F.when(F.col("label") == F.col("main"), F.array(F.pmod(F.xxhash64("id", "key"), pieces))) \
        .otherwise(F.sequence(F.lit(0).cast("long"), pieces - 1))
    return rows.select("key", "id", F.explode(at).alias("_piece")).select(F.xxhash64("key", "_piece").alias("key"), "id")


def deep_nodes(reps: DataFrame, labelled: DataFrame, large: list[tuple[int, DataFrame]]) -> DataFrame:
    """``key, id`` of nodes where pairs meet that large nodes may have parted
    (``labelled``: ``id, label``, the components so far)."""
    weighed, still, found, again = _weighed(large, labelled), None, [], []
    for depth, nodes in large:
        own = weighed.where(F.col("depth") == depth)
        if still is not None:  # below a node that is compared in full, nothing is left
            own = own.join(still.select(F.col("key").alias("parent")), "parent", "left_semi")
        found.append(_against_main(nodes, own, labelled))
        still = own.where(2 * F.col("rest") > LIMIT)
        if still.isEmpty():
            break
        leaf = depth if depth >= MAX_DEPTH else depth + LEVELS
        paths = math.log(1 / (1 - TARGET)) / (PERCENT / 100) ** leaf  # each keeps a pair with J ** leaf
        again.append(nodes.join(still.select("key"), "key", "left_semi")
                     .select("id", F.lit(math.ceil(paths) - PATHS).alias("more")))
    if again:
        ids = written(reduce(DataFrame.unionAll, again).groupBy("id").agg(F.max("more").cast("long").alias("more"))
                      .where("more > 0"), "deep")
        if not ids.isEmpty():
            found += _rooted_again(ids, reps, labelled)
    return reduce(DataFrame.unionAll, found)


def _rooted_again(ids: DataFrame, reps: DataFrame, labelled: DataFrame) -> list[DataFrame]:
    """``key, id`` of the nodes of ``more`` trees of each document (``id, more``)."""
    trees = F.sequence(F.lit(TREES).cast("long"), TREES + F.col("more") - 1)
    rows = ids.join(reps, "id").select("id", "sig", F.explode(trees).alias("tree"))
    rows, depth, found = _below(rows.withColumn("key", F.xxhash64("tree")), 2 + LEVELS), 2 + LEVELS, []
    while True:
        nodes = written(_sized(rows), "nodes")
        found.append(nodes.where(F.col("n") <= LIMIT).select("key", "id"))
        large = nodes.where(F.col("n") > LIMIT)
        if large.isEmpty():
            return found
        weighed = _weighed([(depth, large)], labelled)
        found.append(_against_main(large, weighed, labelled))
        large = large.join(weighed.where(2 * F.col("rest") > LIMIT).select("key"), "key", "left_semi")
        if depth >= MAX_DEPTH:
            piece = F.pmod(F.xxhash64("id", "key"), F.ceil(2 * F.col("n") / LIMIT))
            return [*found, large.select(F.xxhash64("key", piece).alias("key"), "id")]
        rows = _below(large.select("key", "id", "tree").join(reps, "id"), LEVELS)
        depth += LEVELS


def _by_key(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each key of batches sorted by their first column."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if rest and rest[-1].column(0)[0] != batch.column(0)[0]:
            yield pa.Table.from_batches(rest)
            rest = []
        start = 0
        for cut in cuts:
            rest.append(batch.slice(start, cut - start))
            yield pa.Table.from_batches(rest)
            rest, start = [], cut
        rest.append(batch.slice(start))
    if rest:
        yield pa.Table.from_batches(rest)


def forest(n: int, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Indices of a maximum spanning forest of the edges."""
    parent, out = list(range(n)), []
    for e in np.argsort(-weight, kind="stable"):
        u, v = int(a[e]), int(b[e])
        while parent[u] != u:
            parent[u] = u = parent[parent[u]]
        while parent[v] != v:
            parent[v] = v = parent[parent[v]]
        if u != v:
            parent[u] = v
            out.append(e)
    return np.array(out, dtype=np.int64)


def _passing(sigs: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a node with different labels whose estimate passes, and their
    equal coordinates."""
    # By label, the commonest last: each row is compared with the labels after its own.
    _, which, sizes = np.unique(labels, return_inverse=True, return_counts=True)
    order = np.lexsort((which, sizes[which]))
    sigs, which = sigs[order], which[order]
    ends = np.append(np.flatnonzero(which[1:] != which[:-1]) + 1, len(which))
    at, to, same = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i, end in enumerate(np.repeat(ends, np.diff(ends, prepend=0))):
        if end == len(which):
            break
        equal = np.count_nonzero(sigs[end:] == sigs[i], axis=1)
        passed = np.flatnonzero(equal >= LEAST * COORDINATES)
        at.append(np.full(len(passed), i))
        to.append(passed + end)
        same.append(equal[passed])
    return order[np.concatenate(at)], order[np.concatenate(to)], np.concatenate(same)


def _signatures(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u4").reshape(-1, COORDINATES)


def _offered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each node (``key, id, sig``): all that pass, or a maximum
    spanning forest of them if they are many."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for node in _by_key(batches):
        if node.num_rows < 2:
            continue
        ids = node.column(1).to_numpy()
        a, b, same = _passing(_signatures(node.column(2)), ids)
        if len(a) > SPARSE * len(ids):
            keep = forest(len(ids), a, b, same)
            a, b = a[keep], b[keep]
        if len(a):
            out.append((np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b])))
        if sum(len(x) for x, _ in out) > 50_000:
            yield _pairs(out)
            out = []
    yield _pairs(out)


def _open(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, id`` of the documents of each node (``key, id, label, sig``) that
    have a passing pair in another component."""
    for node in _by_key(batches):
        labels = node.column(2).to_numpy()
        if node.num_rows < 2 or (labels == labels[0]).all():
            continue
        a, b, _ = _passing(_signatures(node.column(3)), labels)
        if len(a):
            rows = np.union1d(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(node.column(i).to_numpy()[rows]) for i in (0, 1)],
                                             names=["key", "id"])


def _linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between components in each node (``key, id, label, sig,
    shingles``), enough to connect what can be connected there."""
    for node in _by_key(batches):
        if node.num_rows < 2:
            continue
        ids, labels = node.column(1).to_numpy(), node.column(2).to_numpy()
        sets = [np.frombuffer(s, dtype=np.uint64) for s in node.column(4).to_pylist()]
        a, b, same = _passing(_signatures(node.column(3)), labels)
        root = {x: x for x in labels.tolist()}

        def top(x: int, root: dict = root) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        found = []
        for e in np.argsort(-same, kind="stable"):
            i, j = int(a[e]), int(b[e])
            u, v = top(int(labels[i])), top(int(labels[j]))
            if u != v and similar(sets[i], sets[j]):
                root[u] = v
                found.append((ids[[i]], ids[[j]]))
        yield _pairs(found)


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets reach the similarity."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x) or 100 * len(x) < PERCENT * len(y):
        return False
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int(np.count_nonzero(y[at] == x))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def _pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    both = [np.concatenate([x[i] for x in found]) if found else np.empty(0, np.int64) for i in (0, 1)]
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in both], names=["a", "b"])


def _gathered(rows: DataFrame) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key", "id")


def offered_pairs(nodes: DataFrame, reps: DataFrame) -> DataFrame:
    """Distinct candidate pairs ``a, b`` of small nodes."""
    rows = nodes.join(reps, "id").select("key", "id", "sig")
    return map_batches(_gathered(rows), _offered, "a long, b long").distinct()


def open_rows(nodes: DataFrame, reps: DataFrame, labelled: DataFrame) -> DataFrame:
    """``key, id`` of the documents that have a passing pair in another
    component in their node."""
    rows = nodes.join(labelled, "id").join(reps, "id").select("key", "id", "label", "sig")
    return written(map_batches(_gathered(rows), _open, "key long, id long"), "open", SET_ROWS)


def remaining_links(still: DataFrame, reps: DataFrame, labelled: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a, b`` between components, of :func:`open_rows`.  Each set goes
    to a node once, not once a pair, and only sets that have a passing pair there."""
    rows = still.join(labelled, "id").join(reps, "id").join(sets, "id").select("key", "id", "label", "sig", "shingles")
    return map_batches(_gathered(rows), _linked, "a long, b long")


def full_sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``id, shingles`` (sorted 64-bit hashes) of classes ``id, doc_id, digest``."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                sets = [s.tobytes() for s in shingle_sets(*batch_bytes(some.column(1)))]
                # Another text under the same doc_id has another digest.
                own = [hashlib.md5(s).digest() == d.as_py() for s, d in zip(sets, some.column(2))]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(sets, pa.binary())],
                                                 names=["id", "shingles"]).filter(pa.array(own, pa.bool_()))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    texts = maybe_in(texts, "doc_id", id_filter(classes, "doc_id")).where("__maybe")
    return map_batches(texts.join(classes, "doc_id").select("id", "text", "digest"), rows,
                       "id long, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = [similar(*(np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in pair))
                      for pair in zip(batch.column(2), batch.column(3))]
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    return map_batches(pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb"), rows, "a long, b long")


def _merged(labels: DataFrame, more: DataFrame) -> DataFrame:
    """The components ``id, component`` of ``labels`` joined by more links."""
    if more.isEmpty():
        return labels
    of = lambda c: labels.select(F.col("id").alias(c), F.col("component").alias(f"_{c}"))
    bridges = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    joined = components(bridges).select(F.col("id").alias("component"), F.col("component").alias("_top"))
    alone = joined.select(F.col("component").alias("id"), "component").join(labels, "id", "left_anti")
    return (labels.unionAll(alone.select("id", "component")).join(joined, "component", "left")
            .select("id", F.coalesce("_top", "component").alias("component")))


def class_components(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``id, component`` of the linked ones of ``classes`` (``id, doc_id, digest, sig``)."""
    reps = classes.select("id", "sig")
    nodes, stars, large = small_nodes(reps)
    a = reps.select(F.col("id").alias("a"), F.col("sig").alias("sa"))
    b = reps.select(F.col("id").alias("b"), F.col("sig").alias("sb"))
    equal = F.size(F.filter(F.sequence(F.lit(0), F.lit(COORDINATES - 1)), lambda i: F.substring(
        F.col("sa"), 4 * i + 1, F.lit(4)) == F.substring(F.col("sb"), 4 * i + 1, F.lit(4))))
    near_stars = stars.join(a, "a").join(b, "b").where(equal >= LEAST * COORDINATES).select("a", "b")
    pairs = written(offered_pairs(nodes, reps).unionAll(near_stars).distinct(), "pairs")
    ids = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
    sets_of = lambda ids: written(
        full_sets(docs, classes.join(ids, "id").select("id", "doc_id", "digest")), "sets", SET_ROWS)
    labelled = lambda labels: (reps.select("id").join(labels, "id", "left")
                               .select("id", F.coalesce("component", "id").alias("label")))
    sets = sets_of(ids)
    labels = components(written(confirmed(pairs, sets), "links", SET_ROWS))
    # What dense nodes held back: pairs between components, whose links join these.
    dense = nodes.where(F.col("n") > 2 * SPARSE + 1).select("key", "id")
    still = open_rows(dense, reps, labelled(labels))
    labels = _merged(labels, written(remaining_links(still, reps, labelled(labels), sets), "links", SET_ROWS))
    # What large nodes may have parted.
    if not large:
        return labels
    own = written(labelled(labels), "labels")
    still = open_rows(deep_nodes(reps, own, large), reps, own)
    if still.isEmpty():
        return labels
    more = sets.unionAll(sets_of(still.select("id").distinct().join(sets.select("id"), "id", "left_anti")))
    return _merged(labels, written(remaining_links(still, reps, own, more), "links", SET_ROWS))


def _grouped(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, kept, stays, again`` of every
    row; ``again`` rows repeat the id and text of their group's row that stays."""
    rows = written(described(docs), "signatures")
    # A class has the texts of one set; its id is a hash of the set's digest.
    first = F.min(F.struct("doc_id", "text_hash", "row"))
    classes = written(
        rows.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest")
        .agg(first.alias("first"), F.first("sig").alias("sig"))
        .select("digest", F.col("first.doc_id").alias("doc_id"), "first", "sig", F.xxhash64("digest").alias("id")),
        "classes")
    linked = class_components(docs, classes.drop("first"))
    least = classes.join(linked, "id", "left").select("digest", F.coalesce("component", "id").alias("component"), "first")
    smallest = least.groupBy("component").agg(F.min("first").alias("_own"))
    of_class = least.select("digest", "component").join(smallest, "component").select("digest", "_own")
    component = F.coalesce("_own.doc_id", "doc_id")
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    stays = F.coalesce(F.col("row") == F.col("_own.row"), F.lit(True))
    same = (F.col("doc_id") == F.col("_own.doc_id")) & (F.col("text_hash") == F.col("_own.text_hash"))
    return (rows.select("doc_id", "text_hash", "row", "n_shingles",
                        F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
            .join(of_class, "digest", "left")
            .select("doc_id", "text_hash", "n_shingles", component.alias("component_id"),
                    kept.alias("kept"), stays.alias("stays"), (same & ~stays).alias("again")))


def near_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, stays`` of every row."""
    return _grouped(docs).select("doc_id", "n_shingles", "component_id", "kept", "stays")


def near_dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group."""
    dropped = written(_grouped(docs).where(~F.col("stays"))
                      .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "again").distinct(), "dropped")
    # Texts that surely stay are not shuffled.
    asked = maybe_in(docs, "doc_id", id_filter(dropped, "__id"))
    sure = asked.where(~F.col("__maybe")).select(*docs.columns)
    maybe = asked.where("__maybe").withColumn("__text", F.xxhash64(text_of(docs)))
    own = (F.col("doc_id") == F.col("__id")) & (F.col("__text") == F.col("__hash"))
    out = sure.unionAll(maybe.join(dropped, own, "left_anti").select(*docs.columns))
    again = dropped.where("again")
    if again.isEmpty():
        return out
    return out.unionAll(maybe.join(again, own, "left_semi").dropDuplicates(["doc_id", "__text"]).select(*docs.columns))


def q_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir)).drop("stays")


# All pairs that share a shingle, then everything reachable; for small tables.
SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * c >= 75 * (a.n + b.n - c)
), reach AS (
  SELECT doc_id AS id, doc_id AS r FROM documents
  UNION
  SELECT reach.id, links.y FROM reach JOIN links ON links.x = reach.r
), least AS (
  SELECT id, min(r) AS component_id FROM reach GROUP BY id
)
SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id, id = component_id AS kept
FROM least LEFT JOIN sizes ON doc_id = id
"""

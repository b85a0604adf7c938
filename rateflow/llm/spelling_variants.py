"""Spelling variant grouping with a bit-sliced position index.

Words are the letter runs of whole texts with their numbers of occurrences.
Two words are near if they differ by exactly one inserted, deleted or replaced
character.  A word's *form* is its most frequent near word, if that is at least
``FACTOR`` times as frequent; its *root* is the end of the chain of forms.

The vocabulary is searched in blocks.  For a block the index gives, per position
and letter, the bitset of the block's words that have that letter there
(:func:`near_in_block`).  All words of the block are then read letter by letter
at once; every one carries three bitsets over the block: the words equal so far,
those with one replaced letter, and those with one inserted letter, which are
read one position further on.  No pair of words is formed unless it is near.

Which words meet in a block: one edit leaves the first or the last half of the
shorter word as it is, so each word is offered under both halves, once as the
shorter (or equally long) and once as the longer one of a pair.  Groups with more
than ``LIMIT`` words are divided again by halves of what remains, until one
letter remains; words being distinct, such a group is bounded by the alphabet.  A
pair with equal first halves is left out under the last half, so each pair is
found exactly once.  A task returns one row per word and group (count and best
near word), never pairs.

Edge cases: a null text has no words; a row without ``doc_id`` is hashed with an
empty id; repeated rows count as often as they occur.  Very long runs are words
like others.  Ties go to the smaller word in code-point order.  A word without
near words has 0 near words and is its own root; an empty table gives an empty
result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm.common import documents, lower_ascii, map_batches, text_of, written

MIN_LENGTH, MIN_COUNT, FACTOR = 6, 5, 5
DELETE_ONE_IN = 199
# Words of one group that are compared with each other, and of one block.
LIMIT, BLOCK = 4096, 1024


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``: the distinct words of all texts and how often they occur.

    Runs of letters, A-Z in lower case; of one in ``DELETE_ONE_IN`` (by the
    CRC-32 of id and run) one letter is left out.  A run shorter than
    ``min_length`` cannot give a word.
    """
    runs = F.regexp_extract_all(lower_ascii(text_of(docs)), F.lit(f"[a-zÀ-ÿ]{{{min_length},}}"), F.lit(0))
    each = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = F.pmod(h, F.length("run")).cast("int")
    word = F.when(h % DELETE_ONE_IN == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
                  ).otherwise(F.col("run"))
    return (each.select(word.alias("word")).where(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def _halves(rows: DataFrame) -> DataFrame:
    """Each row of ``key, m, rest, strict, word, n`` under the first and the last
    half of its ``rest``; ``m`` is the length of the shorter word's rest."""
    k = F.floor(F.col("m") / 2).cast("int")
    size = F.length("rest")
    first = F.struct(F.concat("key", F.lit("\x01F"), F.substring("rest", F.lit(1), k)).alias("key"),
                     (F.col("m") - k).alias("m"), F.substring("rest", k + 1, size).alias("rest"), F.col("strict"))
    kept = size - (F.col("m") - k)
    last = F.struct(F.concat("key", F.lit("\x01L"), F.substring("rest", kept + 1, size)).alias("key"),
                    k.alias("m"), F.substring("rest", F.lit(1), kept).alias("rest"), F.lit(True).alias("strict"))
    # One letter cannot be halved: all pairs then agree in the empty first half.
    offers = F.when(F.col("m") > 1, F.array(first, last)).otherwise(F.array(first))
    return rows.select(F.explode(offers).alias("o"), "word", "n").select("o.*", "word", "n")


def groups(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``key, m, rest, strict, word, n``: words of one ``key`` agree in all but
    ``rest``; groups have at most ``limit`` words or one letter left (``m`` = 1)."""
    role = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("m")
    rows = _halves(words.select("word", "n", role).where("m > 0").select(
        F.col("m").cast("string").alias("key"), "m", F.col("word").alias("rest"), F.lit(False).alias("strict"), "word", "n"))
    done = []
    while True:
        hot = written(rows.where("m > 1").groupBy("key").agg(F.count(F.lit(1)).alias("c"))
                      .where(F.col("c") > limit).select("key"), "hot-halves")
        if hot.isEmpty():
            return reduce(DataFrame.unionByName, [*done, rows])
        done.append(rows.join(hot, "key", "left_anti"))
        rows = written(_halves(rows.join(hot, "key", "left_semi")), "halves")


def _packed(rows: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    n = rows.shape[-1]
    padded = np.zeros((*rows.shape[:-1], -(-n // 64) * 64), dtype=bool)
    padded[..., :n] = rows
    return np.packbits(padded, axis=-1, bitorder="little").view(np.uint64)


def _places(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of every set bit."""
    row, at = np.nonzero(bits)
    hit, bit = np.nonzero(np.unpackbits(bits[row, at].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return row[hit], at[hit] * 64 + bit


def near_in_block(rests: list[str], group: np.ndarray, strict: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Both directions of every near pair ``(i, j)`` of a block.

    ``rests`` have length ``m`` or ``m + 1``; only words of one ``group`` (numbers
    from 0) meet.  Pairs of two words of length ``m`` differ by a replaced letter;
    one of each length, by an inserted one, which for ``strict`` groups must
    not be explained by a letter added at the end.  Pairs of two longer words are
    another block's.
    """
    n = len(rests)
    short = np.fromiter((len(r) == m for r in rests), dtype=bool, count=n)
    own = np.flatnonzero(short)
    if not len(own):
        return own, own
    letters = np.zeros((n, m + 1), dtype=np.uint32)
    for rows, width in ((own, m), (np.flatnonzero(~short), m + 1)):
        joined = "".join(rests[i] for i in rows).encode("utf-32-le", "surrogatepass")
        letters[rows, :width] = np.frombuffer(joined, dtype="<u4").reshape(len(rows), width)
    alphabet, letters = np.unique(letters, return_inverse=True)
    letters = letters.reshape(n, m + 1)
    letters[own, m] = len(alphabet)  # no letter there

    def with_letter(position: int) -> np.ndarray:
        return _packed(letters[:, position] == np.arange(len(alphabet))[:, None])

    members = _packed(group == np.arange(group[-1] + 1)[:, None])
    longer = _packed(~short)
    equal = members[group[own]]
    replaced, inserted = np.zeros_like(equal), np.zeros_like(equal)
    here = with_letter(0)
    for position in range(m):
        ahead, letter = with_letter(position + 1), letters[own, position]
        same = here[letter]
        inserted = (inserted | equal) & ahead[letter]
        replaced = (replaced & same) | (equal & ~same)
        equal &= same
        here = ahead
    inserted = np.where(strict[own, None], inserted & ~equal, inserted | equal) & longer
    i, j = _places(replaced & ~longer)
    a, b = _places(inserted)
    return np.concatenate([own[i], own[a], b]), np.concatenate([j, b, own[a]])


def _near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``key, m, rest, strict, word, n`` sorted by ``m, key`` to
    ``word, c, best_n, best``: the near words of a word in its group."""
    block: list[tuple] = []
    pending: list[tuple] = []
    numbers: list[int] = []

    def found() -> pa.RecordBatch | None:
        ns = np.array([r[5] for r in block], dtype=np.int64)
        i, j = near_in_block([r[2] for r in block], np.array(numbers), np.array([r[3] for r in block]), block[0][1])
        if not len(i):
            return None
        rank = np.empty(len(block), dtype=np.int64)
        rank[sorted(range(len(block)), key=lambda x: block[x][4])] = np.arange(len(block))
        order = np.lexsort((rank[j], -ns[j], i))
        i, j = i[order], j[order]
        first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
        return pa.RecordBatch.from_arrays(
            [pa.array([block[x][4] for x in i[first]], pa.string()), pa.array(np.diff(np.r_[first, len(i)]), pa.int64()),
             pa.array(ns[j[first]]), pa.array([block[x][4] for x in j[first]], pa.string())],
            names=["word", "c", "best_n", "best"])

    def closed(m: int | None) -> Iterator[pa.RecordBatch]:
        """End the pending group, and the block where it is full or ``m`` changes."""
        if len(pending) > 1:  # a word alone in its group has nothing near there
            if block and (block[0][1] != pending[0][1] or len(block) + len(pending) > BLOCK):
                yield from emptied()
            numbers.extend([numbers[-1] + 1 if numbers else 0] * len(pending))
            block.extend(pending)
        pending.clear()
        if m is None and block:
            yield from emptied()

    def emptied() -> Iterator[pa.RecordBatch]:
        out = found()
        if out is not None:
            yield out
        block.clear()
        numbers.clear()

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if pending and pending[0][0] != row[0]:
                yield from closed(row[1])
            pending.append(row)
    yield from closed(None)


def variants(words: DataFrame, factor: int = FACTOR, limit: int = LIMIT) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for a table ``word, n`` of
    distinct words of two characters or more."""
    words = written(words.select("word", "n"), "words")
    rows = groups(words, limit).select("key", "m", "rest", "strict", "word", "n")
    found = map_batches(rows.repartition("key").sortWithinPartitions("m", "key"), _near,
                        "word string, c long, best_n long, best string")
    best = (found.groupBy("word").agg(F.sum("c").alias("n_near"),
                                      F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form"))).alias("b"))
            .select("word", "n_near", "b.form", (-F.col("b.less")).alias("form_n")))
    holds = F.col("form_n") >= F.col("n") * factor
    near = written(words.join(best, "word", "left")
                   .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                           F.when(holds, F.col("form")).alias("form"), F.when(holds, F.col("form_n")).alias("form_n")),
                   "near-words")
    return (near.join(_roots(near.where("form IS NOT NULL").select("word", F.col("form").alias("root"))), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def _roots(steps: DataFrame) -> DataFrame:
    """``word, root`` from ``word, root`` = the next word: each round doubles the
    steps taken.  A form is ``FACTOR`` times as frequent as its word, so a chain
    is as short as the logarithm of the largest count and never a circle."""
    steps = written(steps, "forms")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("_on"))
        moved = written(steps.join(further, "root", "left")
                        .select("word", F.coalesce("_on", "root").alias("root"), F.col("_on").isNotNull().alias("moved")), "forms")
        steps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return steps


def q_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(documents(spark, sf_dir)))


# CRC-32 from its rule; near words meet by a word with one place left open, or
# with one character left out.
SQL = """
WITH crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[a-zÀ-ÿ]+')) AS run
  FROM documents
), per AS (
  SELECT doc_id, run, count(*) AS c FROM runs WHERE length(run) >= 6 GROUP BY ALL
), bytes AS (
  SELECT run, c, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM per
), hashed AS (
  SELECT run, c, xor(list_reduce(list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
    lambda h, b: xor(t[(xor(h, b) & 255) + 1], h >> 8), 4294967295::BIGINT), 4294967295::BIGINT) AS h
  FROM bytes, crc
), words AS (
  SELECT word, sum(c)::BIGINT AS n FROM (
    SELECT c, CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                   ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5
), places AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words
), shapes AS (
  SELECT word, n, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM places
), near AS (
  SELECT x.word, y.word AS other, y.n AS m FROM shapes x JOIN shapes y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT w.word, s.word, s.n FROM shapes s JOIN words w ON w.word = s.a || s.b
  UNION SELECT s.word, w.word, w.n FROM shapes s JOIN words w ON w.word = s.a || s.b
), best AS (
  SELECT word, count(*) AS n_near, max(m) AS form_n,
         arg_min(other, (-m, other)) AS form FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN form_n >= 5 * n THEN form END AS form, CASE WHEN form_n >= 5 * n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chain AS (
  WITH RECURSIVE walk AS (
    SELECT word, word AS place, 0 AS step FROM forms
    UNION ALL
    SELECT walk.word, forms.form, step + 1 FROM walk JOIN forms ON walk.place = forms.word WHERE forms.form IS NOT NULL
  ) SELECT word, arg_max(place, step) AS root FROM walk GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN chain USING (word)
"""

"""SentencePiece encoding and decoding with shared prefixes.

Texts are marked (a space becomes U+2581, one is put in front) and cut before
each run of marks; no piece crosses such a cut.  The distinct marked words of
a batch are sorted, which makes their trie's depth-first order, and one
forward pass serves them all: a word takes over the forward states of the
prefix it shares with the word before and computes only the rest.

The forward state of a prefix is, for a unigram model, its best score and last
piece (Viterbi).  For a byte-pair model it is the last piece of the prefix's
own encoding: the one piece that may follow the state before it, that is, whose
merge order leaves the two pieces side by side.  Either way the word is read
back from its end.  Ids equal those of the sentencepiece library.

The model file is a parameter; models with a normalisation table or with
user-defined symbols are refused.

Edge cases: a null or empty text has no id; characters that the model lacks
become byte pieces (or the unknown id); texts of any length are encoded whole;
rows that repeat a ``doc_id`` or have none are encoded as they come; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm.common import documents, map_batches, text_of

MARK = "▁"
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, BYTE = 1, 2, 6
CACHED_WORDS = 400_000   # words that a worker keeps with their ids

_MODELS: dict = {}


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            value: object = number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            value = data[at:at + size]
            at += size
        yield key >> 3, value


class Model:
    """Pieces of a model file, an encoder for distinct words and a decoder."""

    def __init__(self, data: bytes):
        self.scores: list[float] = []
        self.pieces: list[str] = []
        kinds: list[int] = []
        self.kind, self.dummy, self.squeeze, tables = UNIGRAM, True, True, b""
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                self.kind = dict(_fields(value)).get(3, UNIGRAM)
            elif field == 3:
                norm = dict(_fields(value))
                tables = norm.get(2, b"")
                self.dummy, self.squeeze = bool(norm.get(3, 1)), bool(norm.get(4, 1))
        if tables or self.kind not in (UNIGRAM, BPE) or not set(kinds) <= {NORMAL, UNKNOWN, 3, BYTE}:
            raise ValueError("only unigram and byte-pair models without normalisation or user-defined symbols")
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == NORMAL}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece crosses a word's beginning")
        self.unknown = kinds.index(UNKNOWN) if UNKNOWN in kinds else 0
        self.byte_ids = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == BYTE}
        self.tails = {p[i:] for p in self.ids for i in range(len(p))}
        self.penalty = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10.0
        plain = [bytes([int(p[3:5], 16)]) if k == BYTE else b" \xe2\x81\x87 " if k == UNKNOWN else
                 b"" if k == 3 else p.encode() for p, k in zip(self.pieces, kinds)]
        self.flat = np.frombuffer(b"".join(plain), dtype=np.uint8)
        self.sizes = np.array([len(p) for p in plain], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.follows: dict[int, bool] = {}      # pairs of pieces (two ids) that stay apart
        self.cache: dict[str, tuple[int, ...]] = {}

    # Marking and unmarking

    def marked(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return (MARK if self.dummy else "") + text.replace(" ", MARK)

    def decode(self, ids: np.ndarray) -> str:
        sizes = self.sizes[ids]
        shift = self.starts[ids] - (np.cumsum(sizes) - sizes)
        data = self.flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))].tobytes()
        text = data.replace(MARK.encode(), b" ").decode("utf-8", "replace")
        return text[1:] if self.dummy and text.startswith(" ") else text

    # Words

    def _merged(self, text: str) -> list[str]:
        """Byte-pair encoding of a short string by its merge order."""
        parts = list(text)
        while True:
            best = max(((self.scores[self.ids[a + b]], -i) for i, (a, b) in enumerate(zip(parts, parts[1:]))
                        if a + b in self.ids), default=None)
            if best is None:
                return parts
            i = -best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def _side_by_side(self, before: int, piece: int) -> bool:
        """Whether two pieces are the encoding of their concatenation."""
        a, b = self.pieces[before], self.pieces[piece]
        return self._merged(a + b) == [a, b]

    def _last_pieces(self, word: str, last: list[int]) -> None:
        """Append the last piece of every longer prefix of ``word`` to those
        that ``last`` holds (-1: a character that the model lacks)."""
        ids, tails, known = self.ids.get, self.tails, self.follows
        for stop in range(len(last), len(word) + 1):
            start = stop - 1
            found = -1
            piece = word[start:stop]
            while True:
                i = ids(piece)
                if i is not None:
                    if not start or last[start] < 0:
                        found = i
                        if not start:
                            break
                    else:
                        key = last[start] << 20 | i
                        fits = known.get(key)
                        if fits is None:
                            fits = known[key] = self._side_by_side(last[start], i)
                        if fits:
                            found = i
                            break
                start -= 1
                if start < 0:
                    break
                piece = word[start:stop]
                if piece not in tails:
                    break
            last.append(found)

    def encode_words(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """Ids of each distinct word."""
        out: dict[str, tuple[int, ...]] = {}
        before = ""
        last: list[int] = [-1]        # last piece of each prefix of the word at hand
        best: list[float] = [0.0]     # and, for a unigram model, its score
        if len(self.follows) > 2_000_000:
            self.follows.clear()
        for word in sorted(words):
            n, end = 0, min(len(word), len(before))
            if before[:end] == word[:end]:
                n = end
            else:
                while word[n] == before[n]:
                    n += 1
            del last[n + 1:], best[n + 1:]
            if self.kind == BPE:
                self._last_pieces(word, last)
            else:
                self._best_pieces(word, last, best)
            ids: list[int] = []
            at = len(word)
            while at:
                i = last[at]
                at -= len(self.pieces[i]) if i >= 0 else 1
                if i >= 0:
                    ids.append(i)
                elif self.byte_ids:
                    ids += [self.byte_ids[b] for b in reversed(word[at].encode())]
                elif not ids or ids[-1] != self.unknown:   # a run of unknown characters is one id
                    ids.append(self.unknown)
            ids.reverse()
            out[word] = tuple(ids)
            before = word
        return out

    def _best_pieces(self, word: str, last: list[int], best: list[float]) -> None:
        """The Viterbi states of every longer prefix of ``word``."""
        for stop in range(len(last), len(word) + 1):
            i = self.ids.get(word[stop - 1:stop], -1)
            top = best[stop - 1] + (self.penalty if i < 0 else self.scores[i])
            start = stop - 2
            while start >= 0 and (piece := word[start:stop]) in self.tails:
                j = self.ids.get(piece)
                if j is not None and best[start] + self.scores[j] > top:
                    top, i = best[start] + self.scores[j], j
                start -= 1
            best.append(top)
            last.append(i)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; distinct new words are encoded once."""
        split = [WORD.findall(self.marked(t)) for t in texts]
        new = set(chain.from_iterable(split)).difference(self.cache)
        if len(self.cache) + len(new) > CACHED_WORDS:
            self.cache.clear()
            new = set(chain.from_iterable(split))
        self.cache.update(self.encode_words(list(new)))
        ids = self.cache.__getitem__
        return [np.fromiter(chain.from_iterable(map(ids, words)), dtype="<u4") for words in split]


def model(path: str) -> Model:
    """The model of a file, read once per Python worker."""
    if path not in _MODELS:
        with open(path, "rb") as f:
            _MODELS[path] = Model(f.read())
    return _MODELS[path]


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids`` (array<int>) of every row."""
    path = path or default_model()

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, ids in _encoded(batches, path):
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))],
                names=["doc_id", "ids"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), text_of(docs)), rows, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` of rows ``doc_id, ids`` (null ids give a null text)."""
    path = path or default_model()

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else model(path).decode(np.array(x, dtype=np.int64))
                     for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return map_batches(encoded.select("doc_id", "ids"), rows, "doc_id long, text string")


def _encoded(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            some = batch.slice(at, 1024)
            yield some, model(path).encode(some.column(1).to_pylist())


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_ids, ids_crc32`` (of little-endian 32-bit ids) and
    ``round_trip`` (the ids decode to the text) of every row."""
    path = path or default_model()
    names = ["doc_id", "n_ids", "ids_crc32", "round_trip"]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, ids in _encoded(batches, path):
            same = [model(path).decode(x.astype(np.int64)) == text.replace(MARK, " ")
                    for x, text in zip(ids, some.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()), pa.array(same, pa.bool_())],
                names=names)

    return map_batches(docs.select(F.col("doc_id").cast("long"), text_of(docs)), rows,
                       "doc_id long, n_ids long, ids_crc32 long, round_trip boolean")


def q_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))

"""Secret scan: keyword automaton, anchored expressions near its hits, checksums.

An Aho-Corasick automaton over the kinds' keywords reads each text once; a
kind's expression is tried only where one of its keywords starts.  Kinds with
an embedded checksum count only if it is right.  (Hexadecimal runs have no
keyword; they are found by one pass for runs of the least length.)

Base kinds: ``assign`` (a password, secret, token or API key that is given a
value of 6 or more characters), ``access`` (AKIA access key ids of 20 or more
characters) and ``hex`` (24 or more hexadecimal digits).  Added kinds, with a
checksum: ``github`` (``gh[pousr]_``) and ``npm`` (``npm_``), 30 base-62
characters and their CRC-32 as 6 base-62 digits.

Spans are in code points, the end exclusive, and do not overlap within a kind.
Edge cases: a null text is the empty text and has no span; texts of any length
are read whole; an empty table gives an empty result; extra columns are
ignored by :func:`scan` and kept by :func:`redact`; rows that repeat a
``doc_id`` or have none are scanned as they come.
"""

from __future__ import annotations

import hashlib
import re
import string
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm.common import documents, map_batches, text_of

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "github", "npm")
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase
LOWER = {ord(c): ord(c.lower()) for c in string.ascii_uppercase}
MARK = "[SECRET]"

_AUTOMATON: list = []


def automaton():
    if not _AUTOMATON:
        import ahocorasick

        words = ahocorasick.Automaton()
        for kind, own in KEYWORDS.items():
            for word in own:
                words.add_word(word, (kind, len(word)))
        words.make_automaton()
        _AUTOMATON.append(words)
    return _AUTOMATON[0]


def checksum(body: str) -> str:
    """The CRC-32 of a token's body as six base-62 digits."""
    crc, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        crc, digit = divmod(crc, 62)
        digits = BASE62[digit] + digits
    return digits


def _at(kind: str, text: str, start: int) -> tuple[int, bool] | None:
    """End of the kind's match that starts here, and whether it counts."""
    if kind == "assign":
        m = ASSIGN.match(text, start)
        return m and (m.end(), m.end(2) - m.start(2) >= 6)
    if kind == "access":
        m = ACCESS.match(text, start)
        return m and (m.end(), m.end() - start >= 20)
    m = CHECKED.match(text, start)
    return m and (m.end(), checksum(m[1]) == m[2])


def find(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` by start, then kind as listed."""
    low = text.lower()
    if len(low) != len(text):  # a letter whose lower case is longer
        low = text.translate(LOWER)
    hits = sorted({(end - n + 1, kind) for end, (kind, n) in automaton().iter(low)})
    spans, passed = [], dict.fromkeys(KINDS, 0)
    for start, kind in hits:
        if start >= passed[kind] and (found := _at(kind, text, start)):
            passed[kind] = found[0]
            if found[1]:
                spans.append((start, found[0], kind))
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redacted(text: str) -> str:
    """The text with each run of covered characters replaced by ``MARK``."""
    out, done = [], 0
    for start, end, _ in find(text):
        if end <= done:
            continue
        if start >= done:
            out += [text[done:start], MARK]
        done = end
    return "".join(out) + text[done:]


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every row."""
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names[1:]]
            for text in batch.column(1):
                spans = find(text.as_py())
                base = [s for s in spans if s[2] in BASE]
                values = [sum(s[2] == kind for s in base) for kind in BASE]
                values += [hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)]
                for column, value in zip(out, values):
                    column.append(value)
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, type=t) for x, t in zip(out, types)]], names=names)

    return map_batches(docs.select(F.col("doc_id").cast("long"), text_of(docs)), rows,
                       "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret replaced by ``[SECRET]``; other columns as
    they are, but ``n_chars`` (if there is one) follows the text.  A null text
    stays null."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [None if x is None else redacted(x) for x in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, type=batch.schema.field(at).type))

    clean = map_batches(docs, rows, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(F.col("text").contains(MARK), F.length("text").cast(kind))
                                 .otherwise(F.col("n_chars")))
    return clean


def q_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))

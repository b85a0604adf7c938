"""Language identification by compression.

For each language a bounded sample of labelled texts is the raw-content
dictionary of a zstandard compressor.  A text (letters only, in lower case) is
compressed with every dictionary, in blocks so that a long text leans on the
dictionary rather than on itself, and the language with the fewest bytes wins;
equal sizes go to the language with more labelled rows.  Every block starts with
``MARK``, which all dictionaries end with: it pays the fixed costs of a compressed
block, so that the bytes a short text saves show too.  A prediction is rejected, by one
rule at every length, if the best language saves less than ``MIN_MARGIN`` of the next
one's bytes; equal sizes are always rejected.

The model is fitted on rows with a label whose ``crc32(doc_id) mod 4`` is not 2:
per language at most ``SAMPLE_ROWS`` rows, chosen by a hash of their id, at most
``SAMPLE_CHARS`` characters of each and ``DICTIONARY`` bytes in all.  Every
text is classified whole.

Edge cases: a null text, or one without any letter, is ``und`` with score 0;
so is every text if no label can be learned.  With one learned language the
score is 1.  A row without ``doc_id`` is not learned from and not held out;
repeated rows are classified as they come; an empty table gives an empty
result; extra columns are ignored by :func:`identify` and kept by
:func:`identified`.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rateflow.llm.common import documents, map_batches, text_of

SAMPLE_ROWS = 100
SAMPLE_CHARS = 8_192
DICTIONARY = 64_000
BLOCK = 4_096
LEVEL = 9
MIN_MARGIN = 0.02
MARK = b" 0123456789:;<=>?@0987654321#%&*+"
UNKNOWN = "und"
NOT_LETTERS = re.compile(r"[\W\d_]+")

_COMPRESSORS: dict = {}


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def letters(text: str) -> bytes:
    """The text's words of letters, in lower case; empty if it has no letter."""
    words = NOT_LETTERS.sub(" ", text.lower()).strip()
    return f" {words} ".encode() if any(c.isalpha() for c in words) else b""


def fit(docs: DataFrame) -> list[tuple[str, bytes]]:
    """``(language, dictionary)``, the language with most labelled rows first."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                       & ~held_out(F.col("doc_id")))
    rows = known.select("lang", F.xxhash64(F.col("doc_id").cast("string")).alias("_h"), "doc_id",
                        F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    first = Window.partitionBy("lang").orderBy("_h", "doc_id", "text")
    sample = rows.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= SAMPLE_ROWS).collect()
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    texts: dict[str, list[bytes]] = {}
    room = dict.fromkeys(counts, DICTIONARY)
    for r in sorted(sample, key=lambda r: r["_r"]):
        text = letters(r["text"])[:room[r["lang"]]]
        if text:
            texts.setdefault(r["lang"], []).append(text)
            room[r["lang"]] -= len(text)
    return [(lang, b"".join(reversed(texts[lang]))) for lang in sorted(texts, key=lambda x: (-counts[x], x))]


def compressors(model: list[tuple[str, bytes]]) -> list:
    """One compressor per language, made once per Python worker."""
    key = tuple((lang, hash(content)) for lang, content in model)
    if key not in _COMPRESSORS:
        import zstandard

        made = []
        for lang, content in model:
            words = zstandard.ZstdCompressionDict(content + MARK, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            how = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, dict_size=len(content) + len(MARK), source_size=BLOCK, write_content_size=0, write_checksum=0,
                write_dict_id=0)
            words.precompute_compress(compression_params=how)
            made.append((lang, zstandard.ZstdCompressor(compression_params=how, dict_data=words)))
        _COMPRESSORS.clear()
        _COMPRESSORS[key] = made
    return _COMPRESSORS[key]


def predict(text: str | None, model: list[tuple[str, bytes]]) -> tuple[str, float, bool]:
    """``(language, score, rejected)``; the score is the share of bytes that
    the best language saves over the next."""
    body = letters(text or "")
    if not body or not model:
        return UNKNOWN, 0.0, True
    sizes = [(sum(len(c.compress(MARK + body[i:i + BLOCK])) for i in range(0, len(body), BLOCK)), rank, lang)
             for rank, (lang, c) in enumerate(compressors(model))]
    sizes.sort()
    score = (sizes[1][0] - sizes[0][0]) / sizes[1][0] if len(sizes) > 1 else 1.0
    return sizes[0][2], score, score < MIN_MARGIN


def _classified(docs: DataFrame, model: list[tuple[str, bytes]], schema: str) -> DataFrame:
    """Append ``lang_pred, score, rejected`` to rows that have a ``text``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # DICTIONARY bytes a language

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [predict(text.as_py(), sent.value) for text in batch.column("text")]
            for name, kind, i in (("lang_pred", pa.string(), 0), ("score", pa.float64(), 1),
                                  ("rejected", pa.bool_(), 2)):
                batch = batch.append_column(name, pa.array([x[i] for x in found], type=kind))
            yield batch

    return map_batches(docs, rows, schema)


def identify(docs: DataFrame, model: list[tuple[str, bytes]] | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       held_out(F.col("doc_id")).alias("held_out"), text_of(docs).alias("text"))
    schema = "doc_id long, held_out boolean, text string, lang_pred string, score double, rejected boolean"
    return _classified(rows, fit(docs) if model is None else model, schema).drop("text")


def identified(docs: DataFrame, model: list[tuple[str, bytes]] | None = None) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    row = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), text_of(docs).alias("text"))
    schema = StructType(list(row.schema.fields))
    schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    kept = _classified(row, fit(docs) if model is None else model, schema).where(~F.col("rejected"))
    return kept.select("_row.*")


def q_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))

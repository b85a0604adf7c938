"""Rating and item files (CSV or parquet) with explicit bad-row handling.

CSV fields are read as strings and converted with ``try_cast`` so a bad
row becomes nulls instead of a failed job; such rows are rejected and can
be counted.  A header line is just a row whose id does not parse, so files
with and without a header (and files with a repeated header line) read the
same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_RATING_FIELDS = ("user_id", "item_id", "rating", "rated_at")
_ITEM_FIELDS = ("item_id", "title", "genres")


def _string_schema(names) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


def _read_csv_strings(spark: SparkSession, path: str, names) -> DataFrame:
    # Extra fields beyond the schema are dropped by the CSV reader; missing
    # ones come back as null and are rejected below.
    return (spark.read
            .option("header", "false")
            .option("quote", '"')
            .option("escape", '"')
            .option("mode", "PERMISSIVE")
            .schema(_string_schema(names))
            .csv(path))


_RATING_TYPES = {"user_id": "BIGINT", "item_id": "BIGINT", "rating": "DOUBLE", "rated_at": "BIGINT"}


def _double(name: str) -> str:
    """``try_cast(trim(name) AS DOUBLE)`` that does not fail inside for words: the parser
    of numbers throws and catches an error for each of them, ``nan`` included, which is
    the greater part of the time of reading a spoilt file."""
    text = f"trim({name})"
    special = f"WHEN lower({text}) = 'nan' THEN double('nan') WHEN lower({text}) IN ('inf', 'infinity') THEN double('inf')"
    parsed = f"try_cast({text} AS DOUBLE)"
    # Numbers, signs and blanks sort before letters; no other word is a number.
    return (f"CASE WHEN {text} < 'A' THEN {parsed} {special} "
            f"WHEN lower({text}) RLIKE '^[ni]' THEN {parsed} ELSE NULL END")


def _typed(raw: DataFrame) -> DataFrame:
    """``raw`` (its row under ``_raw``) with the rating fields typed: string
    fields are parsed, typed ones keep their type (ids and ratings are cast)."""
    out = []
    for name, kind in _RATING_TYPES.items():
        have = raw.schema[name].dataType if name in raw.columns else None
        if have is None:
            out.append(F.lit(None).cast(kind).alias(name))
        elif isinstance(have, StringType):
            out.append(F.expr(_double(name) if kind == "DOUBLE" else f"try_cast(trim({name}) AS {kind})").alias(name))
        elif name == "rated_at":
            out.append(F.col(name))
        else:
            out.append(F.col(name).cast(kind).alias(name))
    return raw.select(*out, F.struct(*[F.col(c) for c in raw.columns]).alias("_raw"))


def _valid_rating() -> F.Column:
    # Spark takes NaN for greater than infinity, and a null rating gives false; the rating is parsed once.
    finite = F.abs("rating") < F.lit(float("inf"))
    return F.coalesce(F.col("user_id").isNotNull() & F.col("item_id").isNotNull() & finite, F.lit(False))


def _good_and_bad(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = _typed(raw)
    return rows.filter(_valid_rating()).drop("_raw"), rows.filter(~_valid_rating()).select("_raw.*")


def read_ratings(spark: SparkSession, path: str, fmt: str = "csv",
                 with_rejects: bool = False):
    """Read ``user_id,item_id,rating[,rated_at]`` rows.

    Rows whose ids are not integers, whose rating is missing, NaN or
    infinite, or that have fewer than three fields are rejected.  Columns of
    a parquet file keep their types (a date stays a date, filters reach the
    scan).  With ``with_rejects=True`` returns ``(ratings, rejects)``;
    ``rejects`` holds the raw fields of the rejected rows.
    """
    if fmt == "parquet":
        raw = spark.read.parquet(path)
        raw = raw.select(*[c for c in _RATING_FIELDS if c in raw.columns])
    elif fmt == "csv":
        raw = _read_csv_strings(spark, path, _RATING_FIELDS)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    good, bad = _good_and_bad(raw)
    return (good, bad) if with_rejects else good


def _line_fields(lines: DataFrame) -> DataFrame:
    """The comma-separated fields of ``value``; a missing one is null.

    The generator keeps the split in a step of its own: a filter on the fields would
    otherwise repeat it, and all of the expression of ``value``, for every field it names,
    in code too long to be compiled.
    """
    parts = lines.select("*", F.explode(F.array(F.split("value", ","))).alias("_parts"))
    return parts.select(*lines.columns, *[F.get("_parts", F.lit(i)).alias(c) for i, c in enumerate(_RATING_FIELDS)])


def parse_rating_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(ratings, rejects)`` of text lines in a ``value`` column; the rejects
    keep the whole line."""
    good, bad = _good_and_bad(_line_fields(lines.select("value")))
    return good, bad.select("value")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file, or of a folder's files in the order of their
    names, with their 1-based line number: ``line, value``.

    ``monotonically_increasing_id`` tells an input split's lines apart, and
    the file's name and the place of the split in the file put the splits in
    order.  A count per split (one small aggregate) gives each split's
    offset: no shuffle or sort of the lines.  The offsets, one row per input
    split, are joined by Spark's own choice of plan.
    """
    raw = (spark.read.text(path)
           .select("value", F.monotonically_increasing_id().alias("_id"),
                   F.col("_metadata.file_path").alias("_file"),
                   F.col("_metadata.file_block_start").alias("_start"))
           .withColumn("_row", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))))
    split = ["_file", "_start"]
    per_split = raw.groupBy(*split).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    # Running sums within a file, then over the files.
    files = per_split.groupBy("_file").agg(F.sum("_n").alias("_n"))
    before_file = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (per_split.withColumn("_in_file", F.coalesce(F.sum("_n").over(before), F.lit(0)))
               .join(files.select("_file", F.coalesce(F.sum("_n").over(before_file), F.lit(0)).alias("_of_file")),
                     "_file")
               .select(*split, (F.col("_in_file") + F.col("_of_file") - F.col("_first")).alias("_off")))
    return (raw.join(offsets, split)
            .select((F.col("_off") + F.col("_row") + 1).alias("line"), "value"))


def typed_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, user_id, item_id, rating`` of every line of a text file or
    folder, in the order of the lines within an input split (``file, start``); the
    three rating fields are all null where the line is no valid rating."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                       F.col("_metadata.file_block_start").alias("start"))
    rows = _typed(_line_fields(raw))
    return rows.select("_raw.file", "_raw.start", *[F.when(_valid_rating(), F.col(c)).alias(c)
                                                    for c in ("user_id", "item_id", "rating")])


def flagged_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, value, user_id, item_id, rating, accepted`` of every line of a text
    file or folder."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    return _typed(_line_fields(raw)).select("_raw.file", "_raw.value", "user_id", "item_id", "rating",
                                            _valid_rating().alias("accepted"))


def read_rating_lines(spark: SparkSession, path: str) -> DataFrame:
    """Valid rating rows with their line numbers: ``line, user_id, item_id,
    rating``.  Other lines (a header, a short line) are skipped but counted
    in the numbering; :func:`parse_rating_lines` gives them as rejects.
    """
    return (_typed(_line_fields(read_lines(spark, path))).filter(_valid_rating())
            .select(F.col("_raw.line").alias("line"), "user_id", "item_id", "rating"))


def read_items(spark: SparkSession, path: str, naive: bool = False) -> DataFrame:
    """Read ``item_id,title,genres`` rows of a CSV catalogue.

    Titles use real CSV quoting, so ``"American President, The (1995)"``
    stays whole.  ``naive=True`` instead splits the line on every comma and
    keeps field 1, the way a plain ``split(',')`` does (a quoted title with a
    comma is cut).  Genres are split on ``|`` into ``ARRAY<STRING>``.  Lines
    whose id is not an integer (the header, repeated headers) are dropped.
    """
    if naive:
        lines = spark.read.text(path)
        parts = F.split(F.regexp_replace("value", "\n", ""), ",")
        df = lines.select(
            F.expr("try_cast(get(split(value, ','), 0) AS BIGINT)").alias("item_id"),
            F.get(parts, 1).alias("title"),
            F.split(F.element_at(parts, -1), r"\|").alias("genres"))
    else:
        raw = _read_csv_strings(spark, path, _ITEM_FIELDS)
        df = raw.select(
            F.expr("try_cast(item_id AS BIGINT)").alias("item_id"),
            F.col("title"),
            F.when(F.col("genres").isNull(), F.array().cast("array<string>"))
             .otherwise(F.split("genres", r"\|")).alias("genres"))
    return df.filter(F.col("item_id").isNotNull())


def parse_item_lines(lines: DataFrame) -> DataFrame:
    """Items of text lines in a ``value`` column, with the quoting and the
    dropped lines of :func:`read_items`."""
    schema = ", ".join(f"{c} STRING" for c in _ITEM_FIELDS)
    row = F.from_csv("value", schema, {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    raw = lines.select(row.alias("_r")).select("_r.*")
    return (raw.select(F.expr("try_cast(item_id AS BIGINT)").alias("item_id"), "title",
                       F.when(F.col("genres").isNull(), F.array().cast("array<string>"))
                       .otherwise(F.split("genres", r"\|")).alias("genres"))
            .filter(F.col("item_id").isNotNull()))


def item_genres(items: DataFrame) -> DataFrame:
    """One row per (item, genre) with the genre's 1-based position."""
    return items.select(
        "item_id", "title",
        F.posexplode("genres").alias("genre_pos", "genre"),
    ).withColumn("genre_pos", (F.col("genre_pos") + 1).cast("int"))

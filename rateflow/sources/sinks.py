"""Writers, counted imports and build-once tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rateflow.sources.files import flagged_lines

HEADER = "userId,movieId,rating"


def write_ratings(ratings: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                  order: Sequence[str] = (), header: bool = False) -> None:
    """Write ratings; CSV lines are ``user,item,rating`` with one decimal, or what a
    column ``value`` holds.

    ``order`` sorts the lines by these columns over the files in the order of their
    names (a range partitioning, no one-task sort); ``header`` puts a header line
    before the first of them.
    """
    if fmt == "parquet":
        ratings.select("user_id", "item_id", "rating").write.mode(mode).parquet(path)
        return
    if fmt != "csv":
        raise ValueError(f"unsupported format {fmt!r}")
    value = F.col("value") if "value" in ratings.columns else F.format_string("%d,%d,%.1f", "user_id", "item_id", "rating")
    order = list(order) or (["user_id", "item_id"] if header else [])
    lines = ratings.select(*order, value.alias("value"))
    if header:  # without keys it sorts before all lines
        lines = lines.unionByName(ratings.sparkSession.range(1).select(F.lit(HEADER).alias("value")), allowMissingColumns=True)
    if order:
        lines = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    lines.select("value").write.mode(mode).text(path)


@dataclass
class Imported:
    """What :func:`import_ratings` has written, and its counters."""

    ratings: DataFrame      # file, user_id, item_id, rating
    rejects: DataFrame      # file, value
    counts: dict[str, int]  # lines, accepted, rejected


def import_ratings(spark: SparkSession, source: str, target: str) -> Imported:
    """Read the text lines of a rating file or folder into the table ``target``.

    One pass: lines are parsed, counted (``observe``) and written, accepted and
    rejected ones in partitions of their own, each with the file it came from.
    ``target`` must not exist.
    """
    seen = Observation("import")
    rows = flagged_lines(spark, source).observe(
        seen, F.count(F.lit(1)).alias("lines"), F.count_if("accepted").alias("accepted"),
        F.count_if(~F.col("accepted")).alias("rejected"))
    rows.write.mode("errorifexists").partitionBy("accepted").parquet(target)
    table = spark.read.schema(rows.schema).parquet(target)
    return Imported(table.where("accepted").select("file", "user_id", "item_id", "rating"),
                    table.where("NOT accepted").select("file", "value"), dict(seen.get))


def _folder(spark: SparkSession, path: str):
    """Hadoop's file system and path class for a path."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop.Path


def reuse_or_build(spark: SparkSession, path: str,
                   build: Callable[[], DataFrame]) -> DataFrame:
    """Read the parquet at ``path`` if it exists, else build, write, re-read.

    Re-reading the written files cuts the lineage, so later jobs and retried
    tasks start from storage instead of recomputing ``build``.  A folder
    without the writer's ``_SUCCESS`` mark is an unfinished or foreign write:
    it is neither read nor overwritten.  Changed inputs are not noticed; see
    :func:`build_once`.
    """
    fs, at = _folder(spark, path)
    if not fs.exists(at(path)):
        build().write.mode("errorifexists").parquet(path)
    elif not fs.exists(at(path, "_SUCCESS")):
        raise ValueError(f"{path} has no _SUCCESS mark: remove the unfinished write first")
    return spark.read.parquet(path)


def fingerprint(df: DataFrame) -> str:
    """A digest of a table's schema and rows that does not depend on their order
    or partitioning: the count, the sum and the exclusive or of row hashes."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    row = df.select(F.xxhash64(*columns, F.lit(1)).alias("a"), F.xxhash64(F.lit(2), *columns).alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("a").cast("decimal(38,0)")), F.lit(0)).alias("a"),
        F.coalesce(F.bit_xor("b"), F.lit(0)).alias("b")).first()
    return f"{df.schema.simpleString()}|{row['n']}|{row['a']}|{row['b']}"


@dataclass
class Built:
    """A build-once table: ``built`` says whether this call has made it."""

    table: DataFrame
    built: bool
    path: str


def build_once(spark: SparkSession, root: str, name: str, build: Callable[[], DataFrame],
               inputs: Sequence[DataFrame] = (), params: Mapping | None = None) -> Built:
    """The table ``name`` under ``root``, built only if its inputs or parameters are new.

    The folder's name is a digest of the inputs' rows (:func:`fingerprint`) and the
    parameters, which a manifest beside the data spells out, so a changed input
    or parameter leads to another folder and a stale one is never read.  Data and
    manifest are written to a folder of their own and renamed at the end: readers see
    all or nothing, and of two builders at once the second takes the first's result.
    """
    facts = json.dumps({"name": name, "inputs": [fingerprint(i) for i in inputs], "params": dict(params or {})},
                       sort_keys=True, default=str)
    digest = spark.range(1).select(F.sha2(F.lit(facts), 256)).first()[0]
    path = f"{root.rstrip('/')}/{name}/{digest}"
    fs, at = _folder(spark, path)
    built = False
    if not fs.exists(at(path)):
        stage = f"{root.rstrip('/')}/{name}/_stage-{uuid.uuid4().hex}"
        build().write.parquet(f"{stage}/data")
        spark.range(1).select(F.lit(facts).alias("value")).coalesce(1).write.text(f"{stage}/manifest")
        built = fs.rename(at(stage), at(path)) and not fs.exists(at(path, at(stage).getName()))
        if not built:   # another builder was first
            for left in (stage, f"{path}/{at(stage).getName()}"):
                fs.delete(at(left), True)
    return Built(spark.read.parquet(f"{path}/data"), bool(built), path)


def manifest(spark: SparkSession, path: str) -> dict:
    """The inputs and parameters of a build-once table."""
    return json.loads(spark.read.text(f"{path}/manifest").first()["value"])


def write_shelves(lines: DataFrame, path: str, shelf: str) -> None:
    """Text lines (``value``) in one folder per value of ``shelf``."""
    lines.select("value", shelf).write.partitionBy(shelf).text(path)

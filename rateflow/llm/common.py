"""Helpers shared by the corpus operators: tables, shared scratch, digests."""

from __future__ import annotations

import json
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType

_SCRATCH: dict[str, list[str]] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session (tests) may leave it unset; it then gets a temporary
    folder.  On a cluster an unset folder is an error, never a machine's own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or \
            spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    key = spark.sparkContext.applicationId
    if key not in _LOCAL:
        _LOCAL[key] = "file://" + tempfile.mkdtemp(prefix="rateflow-llm-")
    return _LOCAL[key]


_LOCAL: dict[str, str] = {}
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor costs the tasks it ran, not the steps
    before.  The folder stays until :func:`release`, as the caller's lazy
    result may still read it.  ``batch_rows`` is the most rows that go to Python at
    once while this job runs, for rows so large that the usual number would fill
    a worker's memory.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/rateflow-llm/{name}-{uuid.uuid4().hex}"
    usual = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(batch_rows or usual))
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(BATCH_ROWS, usual)
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def tables_written(spark: SparkSession) -> int:
    """How many scratch tables this session's operators have written and not released."""
    return len(_SCRATCH.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Delete the scratch tables that this session's operators have written: those
    after the first ``since``, but for the last ``keep``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = _SCRATCH.get(spark.sparkContext.applicationId, [])
    used = paths[since:len(paths) - keep]
    for path in used:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
        paths.remove(path)


def local_table(spark: SparkSession, rows: list, ddl: str) -> DataFrame:
    """A small table made on the driver, without Python on the executors."""
    schema = DataType.fromDDL(ddl)
    text = json.dumps([dict(zip(schema.names, row)) for row in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), ArrayType(schema))))


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text column, a null being the empty text."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df.mapInArrow(fn, schema)`` with this package on the workers' path.

    A cluster ships the package (``--py-files``); where the driver's own copy
    is visible to the workers (local runs), it is found without that.
    """
    env = df.sparkSession.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)
    return df.mapInArrow(fn, schema)


FILTER_BITS = 1 << 23


def id_filter(ids: DataFrame, column: str) -> DataFrame:
    """A bitmap of hashed ids in at most 256 rows of 4 KiB, whatever the number
    of ids: small enough to broadcast by proof.  For :func:`maybe_in`."""
    at = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)) + 1
    return (ids.groupBy(F.bitmap_bucket_number(at).alias("__bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("__bits")))


def maybe_in(df: DataFrame, column: str, bitmap: DataFrame, out: str = "__maybe") -> DataFrame:
    """Add ``out``: false only if the row's id is surely not among the ids of
    ``bitmap``.  Keeps large rows out of a shuffle that cannot match them; with
    very many ids it is true for most rows, which costs but never errs."""
    at = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)) + 1
    bit = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("__bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    has = F.floor(byte / F.pow(F.lit(2), bit % 8)).cast("long") % 2 == 1
    return (df.withColumn("__bucket", F.bitmap_bucket_number(at))
            .join(F.broadcast(bitmap), "__bucket", "left")
            .withColumn(out, F.coalesce(has, F.lit(False))).drop("__bucket", "__bits"))

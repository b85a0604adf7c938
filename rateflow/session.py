"""Session construction and lineage-cut helpers."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every rateflow job wants: adaptive execution (runtime coalescing,
# skew-join splitting, broadcast promotion of small sides), a fixed time zone
# for timestamp comparisons, and no UI server.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "rateflow", extra: dict | None = None) -> SparkSession:
    """Get or create a session with rateflow's defaults.

    On a cluster, call with ``master=None`` so the launcher's settings win.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint directory the cluster names.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    (local runs, tests) is ``fallback`` used, or a scratch directory of this
    machine if the session is local; on a cluster an unset directory is an
    error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    target = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if target is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        target = tempfile.mkdtemp(prefix="rateflow-ckpt-")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def map_batches(df: DataFrame, fn, schema) -> DataFrame:
    """``df.mapInArrow(fn, schema)`` with this package on the workers' path.

    A cluster ships the package (``--py-files``); where the driver's own copy
    is visible to the workers (local runs), it is found without that.
    """
    env = df.sparkSession.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)
    return df.mapInArrow(fn, schema)


def sf_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")


# Tables written by write_and_read, by application, until release().
_WRITTEN: dict[str, list[str]] = {}


@contextmanager
def scoped_conf(spark: SparkSession, settings: dict[str, str]):
    """Set SQL confs for the block, then restore the previous values."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def write_and_read(df: DataFrame, name: str, settings: dict[str, str] | None = None, path: str | None = None) -> DataFrame:
    """Run ``df`` now, store it as parquet under the checkpoint directory and
    read it back (a lineage cut that survives executor loss).

    ``settings`` are SQL confs in force while the job is planned and run,
    then restored; plan nothing else in the same session meanwhile.  ``path``: a
    :func:`scratch_path` to write to.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    with scoped_conf(spark, settings or {}):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# For write_and_read: the job's shuffle files go when its result is written, and do not
# wait until the driver happens to collect its garbage.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def collect_garbage(spark: SparkSession) -> None:
    """Let go of what ended jobs have left: Spark deletes the shuffle files and cached blocks of
    objects that the driver has collected, which a driver with room to spare does late."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_written(spark: SparkSession, path: str) -> None:
    """Delete a table at a :func:`scratch_path` that nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)
    _WRITTEN[spark.sparkContext.applicationId].remove(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the checkpoint directory, deleted by :func:`release`."""
    path = os.path.join(checkpoint_dir(spark), "rateflow", f"{name}-{uuid.uuid4().hex}")
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


@contextmanager
def scratch(spark: SparkSession):
    """Delete, at the end of the block, the tables that operators write in it.

    Results that read them must be used or written inside the block.
    """
    key = spark.sparkContext.applicationId
    outer = _WRITTEN.pop(key, [])
    try:
        yield
    finally:
        release(spark)
        _WRITTEN[key] = outer


def release(spark: SparkSession) -> None:
    """Delete the tables this application's operators have written."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in _WRITTEN.pop(spark.sparkContext.applicationId, []):
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)

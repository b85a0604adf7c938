import pytest

from rateflow.llm import common
from rateflow.llm.common import id_filter, maybe_in, release, scratch_root, tables_written, written


def test_id_filter_never_misses(spark):
    ids, rows = spark.range(0, 20_000, 7), spark.range(40_000).selectExpr("id", "0 AS _bits")
    out = maybe_in(rows, "id", id_filter(ids, "id")).collect()
    inside = {r["id"] for r in ids.collect()}
    assert len(out) == 40_000 and all(r["__maybe"] for r in out if r["id"] in inside)
    assert sum(r["__maybe"] for r in out) < 1.05 * len(inside)
    assert id_filter(ids, "id").count() <= 256
    assert not any(r["__maybe"] for r in maybe_in(rows, "id", id_filter(ids.limit(0), "id")).collect())


def test_written_tables_are_released(spark):
    df = written(spark.range(5), "test")
    assert df.count() == 5
    path = common._SCRATCH[spark.sparkContext.applicationId][-1]
    assert path.startswith(scratch_root(spark))
    release(spark)
    with pytest.raises(Exception, match="(?i)not.*exist|not found"):
        spark.read.parquet(path).count()


def test_release_spares_older_and_newest_tables(spark):
    old = written(spark.range(3), "old")
    mark = tables_written(spark)
    used, last = written(spark.range(4), "used"), written(spark.range(5), "last")
    release(spark, since=mark, keep=1)
    assert (old.count(), last.count(), tables_written(spark)) == (3, 5, mark + 1)
    with pytest.raises(Exception, match="(?i)not.*exist|not found"):
        used.count()

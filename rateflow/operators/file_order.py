"""Sort-order and value check of rating files, from one summary per input split.

A task reads its splits line by line in file order, so everything about
neighbouring rows inside a split is known there: :func:`scan` keeps one row per split
(its numbers of lines and rows, its first and last row, its offenders and value
counts).  The splits' rows are put in file order afterwards, which gives the line
offsets and the neighbours across split borders.  No line is shuffled, sorted or
lagged by a window; the only table that one task sees whole has one row per split.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rateflow.session import map_batches, write_and_read
from rateflow.sources.files import typed_lines

# One row per split, offender (kind "step" or "item": the value before, its own,
# its line in the split) or rating value (kind "value": its count under "line").
SCAN_DDL = ("kind string, file string, start long, lines long, n_rows long, n_down long, n_step long, n_item long, "
            "first_line long, first_user long, first_item long, last_line long, last_user long, last_item long, "
            "before long, own long, rating double, line long")
_FIELDS = [part.split() for part in SCAN_DDL.split(", ")]
_SCHEMA = pa.schema([(name, {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}[kind])
                     for name, kind in _FIELDS])


class _Split:
    """What is known of a split after some of its lines."""

    def __init__(self, file: str, start: int):
        self.place = {"file": file, "start": start}
        self.facts = dict.fromkeys(("lines", "n_rows", "n_down", "n_step", "n_item"), 0)
        self.first: dict = {}
        self.last: dict = {}
        self.values: dict[float, int] = {}

    def add(self, valid: np.ndarray, user: np.ndarray, item: np.ndarray, rating: np.ndarray) -> list[pa.RecordBatch]:
        """Take the next lines; the offenders among them."""
        at = np.flatnonzero(valid)
        facts, before = self.facts, self.facts["lines"]
        facts["lines"] += len(valid)
        if not len(at):
            return []
        user, item = user[at], item[at]
        facts["n_rows"] += len(at)
        for value, n in zip(*(x.tolist() for x in np.unique(rating[at], return_counts=True))):
            self.values[value] = self.values.get(value, 0) + n
        if not self.first:
            self.first = {"first_line": before + int(at[0]) + 1, "first_user": int(user[0]), "first_item": int(item[0])}
            last_user, last_item = user[0], item[0]     # the row before is another split's
        else:
            last_user, last_item = self.last["last_user"], self.last["last_item"]
        old_user, old_item = np.r_[last_user, user[:-1]], np.r_[last_item, item[:-1]]
        step = (user != old_user) & (user != old_user + 1)
        fall = (user == old_user) & (item < old_item)
        facts["n_down"] += int(np.count_nonzero(user < old_user))
        facts["n_step"] += int(np.count_nonzero(step))
        facts["n_item"] += int(np.count_nonzero(fall))
        self.last = {"last_line": before + int(at[-1]) + 1, "last_user": int(user[-1]), "last_item": int(item[-1])}
        return [self._offenders(kind, old[bad], own[bad], before + at[bad] + 1)
                for kind, bad, old, own in (("step", step, old_user, user), ("item", fall, old_item, item)) if bad.any()]

    def _offenders(self, kind: str, before: np.ndarray, own: np.ndarray, line: np.ndarray) -> pa.RecordBatch:
        return _rows(len(line), kind=kind, **self.place, before=before, own=own, line=line)

    def end(self) -> list[pa.RecordBatch]:
        n = len(self.values)
        return [_rows(1, kind="split", **self.place, **self.facts, **self.first, **self.last),
                _rows(n, kind="value", **self.place, rating=np.array(list(self.values), dtype=float),
                      line=np.array(list(self.values.values()), dtype=np.int64))]


def _rows(n: int, **columns) -> pa.RecordBatch:
    arrays = []
    for field in _SCHEMA:
        x = columns.get(field.name)
        arrays.append(pa.array(x, field.type) if isinstance(x, np.ndarray) else pa.repeat(pa.scalar(x, field.type), n))
    return pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Splits of ``file, start, user_id, item_id, rating`` (nulls: no valid row)."""
    split = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = batch.column(0), batch.column(1).to_numpy()
        ends = [batch.num_rows]
        if start[0] != start[-1] or file[0] != file[-1]:    # splits follow each other
            names = np.array(file.to_pylist())
            ends = [*(np.flatnonzero((start[1:] != start[:-1]) | (names[1:] != names[:-1])) + 1).tolist(), *ends]
        valid = np.asarray(batch.column(2).is_valid())
        user, item = (batch.column(i).fill_null(0).to_numpy() for i in (2, 3))
        rating = batch.column(4).fill_null(0).to_numpy()
        at = 0
        for end in ends:
            place = {"file": file[at].as_py(), "start": int(start[at])}
            if split is None or split.place != place:
                if split is not None:
                    yield from split.end()
                split = _Split(**place)
            yield from split.add(valid[at:end], user[at:end], item[at:end], rating[at:end])
            at = end
    if split is not None:
        yield from split.end()


def scan(spark: SparkSession, path: str) -> DataFrame:
    """The written summaries of the splits of a rating file or folder."""
    return write_and_read(map_batches(typed_lines(spark, path), _summaries, SCAN_DDL), "file_scan")


def file_order(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The whole check of a rating file, or of a folder's files in the order of
    their names, from one pass over the lines.

    ``facts``: one row with the three flags, the numbers of offenders, the user and
    line of the last valid row, and the numbers of valid rows and of lines.
    ``user_steps`` (``prev_user_id, user_id, line``) and ``item_order``
    (``prev_item_id, item_id, line``): the offenders.  ``values``: rows per rating.

    Lines that are no valid rating (a header) count in the line numbers only; the row
    before the first one is (0, 0).  A file without a valid row has all flags true.
    """
    scanned = scan(spark, path)
    # One row per split: its offset and the last row of the splits before it.
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("n_rows") > 0, F.struct("last_user", "last_item")), ignorenulls=True).over(before)
    splits = (scanned.where("kind = 'split'").withColumn("_offset", F.coalesce(F.sum("lines").over(before), F.lit(0)))
              .withColumn("_last", F.coalesce(last, F.struct(F.lit(0).cast("long").alias("last_user"),
                                                             F.lit(0).cast("long").alias("last_item"))))
              .withColumn("_down", F.col("first_user") < F.col("_last.last_user"))
              .withColumn("_step", ~F.col("first_user").isin(F.col("_last.last_user"), F.col("_last.last_user") + 1))
              .withColumn("_fall", (F.col("first_user") == F.col("_last.last_user"))
                          & (F.col("first_item") < F.col("_last.last_item"))))
    total = {name: F.coalesce(F.sum(F.col(name) + F.coalesce(F.col(border).cast("long"), F.lit(0))), F.lit(0))
             for name, border in (("n_down", "_down"), ("n_step", "_step"), ("n_item", "_fall"))}
    newest = F.max(F.when(F.col("n_rows") > 0, F.struct((F.col("_offset") + F.col("last_line")).alias("line"), "last_user")))
    facts = splits.agg(
        (total["n_down"] == 0).alias("user_order_ok"), (total["n_step"] == 0).alias("user_step_ok"),
        (total["n_item"] == 0).alias("item_order_ok"),
        total["n_step"].alias("n_user_step_violations"), total["n_item"].alias("n_item_order_violations"),
        newest["last_user"].alias("last_user_id"), newest["line"].alias("last_line"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("lines"), F.lit(0)).alias("n_lines"))

    def offenders(kind: str, border: str, old: str, own: str, column: str) -> DataFrame:
        inner = (scanned.where(F.col("kind") == kind).join(splits.select("file", "start", "_offset"), ["file", "start"])
                 .select(F.col("before").alias(f"prev_{column}"), F.col("own").alias(column),
                         (F.col("_offset") + F.col("line")).alias("line")))
        return inner.unionAll(splits.where(border).select(F.col(f"_last.{old}"), own, F.col("_offset") + F.col("first_line")))

    return {
        "facts": facts,
        "user_steps": offenders("step", "_step", "last_user", "first_user", "user_id"),
        "item_order": offenders("item", "_fall", "last_item", "first_item", "item_id"),
        "values": (scanned.where("kind = 'value'").groupBy("rating").agg(F.sum("line").alias("n"))),
    }

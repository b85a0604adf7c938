"""The file check from split summaries equals a plain loop over the lines."""

import os
import random

import pytest

from rateflow.operators.file_order import file_order


def loop(texts):
    """The check line by line over all files in name order."""
    last_user = last_item = n_rows = last_line = 0
    steps, falls, down, values, line, user = [], [], False, {}, 0, None
    for text in texts:
        for row in text.splitlines():
            line += 1
            try:
                u, i, r = row.split(",")[:3]
                u, i, r = int(u), int(i), float(r)
            except ValueError:
                continue
            if r != r:
                continue
            down |= u < last_user
            if u not in (last_user, last_user + 1):
                steps.append((last_user, u, line))
            if u == last_user and i < last_item:
                falls.append((last_item, i, line))
            values[r] = values.get(r, 0) + 1
            last_user = user = u
            last_item, n_rows, last_line = i, n_rows + 1, line
    facts = (not down, not steps, not falls, len(steps), len(falls), user, last_line or None, n_rows, line)
    return facts, sorted(steps), sorted(falls), sorted(values.items())


def written(folder, texts):
    for n, text in enumerate(texts):
        with open(os.path.join(folder, f"part-{n:03d}.csv"), "w") as f:
            f.write(text)
    return folder


def checked(spark, path):
    got = file_order(spark, path)
    names = ("user_order_ok", "user_step_ok", "item_order_ok", "n_user_step_violations", "n_item_order_violations",
             "last_user_id", "last_line", "n_rows", "n_lines")
    row = got["facts"].first()
    return (tuple(row[n] for n in names), sorted(map(tuple, got["user_steps"].collect())),
            sorted(map(tuple, got["item_order"].collect())), sorted(map(tuple, got["values"].collect())))


@pytest.mark.parametrize("split_bytes", ["64", "300", "134217728"])
def test_any_splits_equal_the_loop(spark, scratch, split_bytes):
    """Offenders on split and file borders, files without a valid row, headers."""
    rnd = random.Random(int(split_bytes))
    texts, user = [], 1
    for n in range(6):
        lines = ["userId,movieId,rating,timestamp"]
        for _ in range(rnd.choice([0, 1, 60])):
            user += rnd.choice([0, 0, 0, 1, 1, 2, -1])
            lines.append(rnd.choice([f"{user},{rnd.randint(1, 9)},{rnd.randint(1, 10) / 2}"] * 9 + ["", "7", "x,1,2.0", "3,4,nan"]))
        texts.append("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert checked(spark, written(scratch, texts)) == loop(texts)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_sorted_file_and_batches(spark, scratch):
    """More lines than one batch holds; the header counts as line 1."""
    rows = [f"{u},{i},3.5" for u in range(1, 1501) for i in (2, 4, 9, 11, 30, 31, 32, 50, 51, 60)]
    texts = ["userId,movieId,rating\n" + "\n".join(rows) + "\n"]
    facts, steps, falls, values = checked(spark, written(scratch, texts))
    assert facts == (True, True, True, 0, 0, 1500, 15_001, 15_000, 15_001)
    assert (steps, falls, values) == ([], [], [(3.5, 15_000)])


def test_file_without_rows(spark, scratch):
    assert checked(spark, written(scratch, ["userId,movieId,rating\n\n"])) == \
        ((True, True, True, 0, 0, None, None, 0, 2), [], [], [])

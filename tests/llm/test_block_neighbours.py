import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rateflow.llm import block_neighbours
from rateflow.llm.block_neighbours import Block, Search, _block, distance_bounds, nearest, products, q_block_neighbours


def plain(rows, is_query, k):
    """All distances, for rows ``(vec_id, vector)`` that take part."""
    out = []
    for at, (q, v) in enumerate(rows):
        if is_query(q):
            away = []
            for other, (c, w) in enumerate(rows):
                if other != at and len(w) == len(v):
                    x = np.array(v, dtype=np.float64) - np.array(w, dtype=np.float64)
                    away.append((float(np.sqrt((x * x).sum())), c))
            out += [(q, n + 1, c, d) for n, (d, c) in enumerate(sorted(away)[:k])]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def test_matches_sql_on_the_table(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    got, want = result(q_block_neighbours(spark, sf)), sorted(con.execute(block_neighbours.SQL).fetchall())
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], rel=1e-12)


def made(x, rows=None):
    n = len(x)
    return Block(_block(np.arange(n) if rows is None else rows, np.arange(n), np.ones(n, dtype=bool), x))


@pytest.mark.parametrize("dim,spread", [(3, 1.0), (64, 1e-3), (2100, 1e5)])
def test_bounds_hold_and_drop_most_pairs(dim, spread):
    r = np.random.default_rng(dim)
    x = (r.normal(size=(400, dim)) * spread * 10 ** r.uniform(-3, 3, (400, 1))).astype(np.float32)
    a, b = made(x[:100]), made(x[100:], np.arange(100, 400))
    exact = np.sqrt(((x[:100, None].astype(np.float64) - x[100:].astype(np.float64)) ** 2).sum(axis=2))
    lower, upper = distance_bounds(a, slice(0, 100), b, slice(0, 300))
    assert (lower <= exact).all() and (exact <= upper).all()
    whole = (a.codes.astype(np.int64) @ b.codes.astype(np.int64).T)
    assert (products(a.codes, b.codes) == whole).all()
    search = Search(a, 5)
    search.meet(b)
    got = [sorted(-d for d, _ in heap) for heap in search.heaps]
    assert np.array(got) == pytest.approx(np.sort(exact, axis=1)[:, :5], rel=1e-12)
    assert search.computed < 0.5 * exact.size


@pytest.mark.parametrize("block,queries", [(16, 5), (8192, 4096)])
def test_odd_vectors_and_ties(spark, monkeypatch, block, queries):
    """Small groups and one group give the same rows; repeated ids are rows of their own."""
    monkeypatch.setattr(block_neighbours, "BLOCK", block)
    monkeypatch.setattr(block_neighbours, "TILE_QUERIES", 4)
    monkeypatch.setattr(block_neighbours, "TILE_ROWS", 8)
    monkeypatch.setattr(block_neighbours, "GROUP_QUERIES", queries)
    r = random.Random(8)
    rows = [(i, [r.choice([-0.5, 0.003, 0.25, 1.5]) for _ in range(4)]) for i in range(1, 80)]
    rows += [(10, rows[9][1]), (10, [1.0, 2.0, 0.0, 0.0]), (20, [1.0, 2.0]), (21, [0.5, 0.5]), (30, [9.0] * 3)]
    rows += [(40, [1e200, 0.0, 0.0, 1.0]), (41, [1e-310, 0.0, 0.0, 0.0]), (50, [3e38, -3e38, 1.0, 0.0])]
    odd = [(60, None), (70, []), (80, [0.0] * 4), (90, [1.0, None, 0.0, 0.0]), (100, [float("nan")] * 4),
           (110, [float("inf")] * 4), (None, [1.0] * 4), (120, [0.0, -0.0])]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + odd],
                                  "vec_id long, embedding array<double>, v string, row int").repartition(3)
    got = result(nearest(table, F.col("vec_id") % 10 == 0, 6))
    want = plain(rows, lambda q: q % 10 == 0, 6)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == [w[3] for w in want]


def test_no_vectors_and_no_queries(spark):
    ddl = "vec_id long, embedding array<float>"
    table = spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 1.0])], ddl)
    assert nearest(spark.createDataFrame([], ddl), F.col("vec_id") == 1).collect() == []
    assert nearest(table, F.col("vec_id") > 5).collect() == []
    assert result(nearest(table, F.col("vec_id") == 1)) == [(1, 1, 2, float(np.sqrt(2)))]

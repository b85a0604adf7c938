import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rateflow.llm import vector_search
from rateflow.llm.vector_search import ApproximationFile, Search, _pack, integer_vectors, q_top_k, top_k


def plain(rows, is_query, k):
    """All inner products, for rows ``(vec_id, integers)`` that take part."""
    out = []
    for at, (q, v) in enumerate(rows):
        if is_query(q):
            scores = sorted((-sum(a * b for a, b in zip(v, w)), c) for other, (c, w) in enumerate(rows)
                            if other != at and len(w) == len(v))
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scores[:k])]
    return sorted(out)


def result(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()))


def test_matches_sql_on_the_table(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    assert result(q_top_k(spark, sf)) == sorted(con.execute(vector_search.SQL).fetchall())


@pytest.mark.parametrize("block,queries", [(9, 3), (8192, 4096)])
def test_odd_vectors_and_ties(spark, monkeypatch, block, queries):
    monkeypatch.setattr(vector_search, "BLOCK", block)
    monkeypatch.setattr(vector_search, "GROUP_QUERIES", queries)
    monkeypatch.setattr(vector_search, "TILE_QUERIES", 4)
    r = random.Random(2)
    rows = [(i, [r.choice([-0.5, -0.003, 0.0, 0.25, 1.5]) for _ in range(4)]) for i in range(60)]
    rows += [(70, [1.0, 2.0]), (71, [0.5, 0.5]), (3, [9.0, 9.0, 9.0, 9.0]), (72, [0.0] * 4), (80, [200_000.5, 1.0, 0.0, -200_000.5])]
    odd = [(80, None), (81, []), (82, [1.0, None, 0.0, 0.0]), (83, [float("nan")] * 4), (84, [float("inf")] * 4),
           (None, [1.0] * 4), (90, [1e30, 0.0, 0.0, 0.0]), (91, [0.0, 0.0, 0.0, -262144.0])]
    table = spark.createDataFrame([(i, v, "x", 5) for i, v in rows + odd], "vec_id long, embedding array<double>, v string, row int")
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    assert result(top_k(table, F.col("vec_id") % 10 == 0, 5)) == plain(whole, lambda q: q % 10 == 0, 5)
    assert top_k(table, F.col("vec_id") > 1000, 5).count() == 0 and top_k(table.limit(0), F.lit(True), 5).count() == 0


def test_repeated_ids_are_rows_of_their_own(spark):
    """Every query row gets its own list, and a copy of it is a candidate."""
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [2.0, 0.0]), (3, [0.0, 3.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    for k in (2, 10):
        assert result(top_k(table, F.col("vec_id").isin(50, 7), k)) == plain(whole, lambda q: q in (50, 7), k)


def test_sums_are_exact_beyond_floats(spark):
    big = 2 ** 18 - 0.01     # near the largest component that takes part
    rows = [(0, [big] * 64), (1, [big] * 64), (2, [big] * 63 + [big - 1 / 256])]
    whole = [(i, [math.floor(256 * x) for x in w]) for i, w in rows]
    got = result(top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, 5))
    assert got == plain(whole, lambda q: q == 0, 5) and got[0][3] > 2 ** 53


@pytest.mark.parametrize("spread", [3, 300, 2 ** 25])
def test_bounds_hold_and_few_rows_are_read(spark, spread):
    import pyarrow as pa

    r = np.random.default_rng(spread)
    rows = r.integers(-spread, spread, (2000, 16)).astype(np.int32)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(2000)), pa.array(np.arange(2000)), pa.array(np.arange(2000) < 40),
                                        pa.array(list(rows), pa.list_(pa.int32()))], names=["row", "vec_id", "query", "v"])
    file = ApproximationFile(next(iter(_pack([batch]))).to_pylist()[0])
    assert file.cells.dtype == np.uint8 and (file.exact == rows).all()
    queries = rows[:40].astype(np.int64)
    exact = queries @ rows.astype(np.int64).T
    assert (file.bounds(queries, slice(0, 2000)) >= exact).all()
    search = Search(file, 5)
    search.meet(file)
    for i in range(40):
        mine = np.delete(np.arange(2000), i)
        want = mine[np.lexsort((mine, -exact[i, mine]))[:5]]
        assert sorted(search.heaps[i], reverse=True) == [(int(exact[i, w]), -int(w)) for w in want]
    assert search.read < 2000 * 2000 * 0.05

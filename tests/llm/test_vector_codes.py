import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from rateflow.llm import vector_codes
from rateflow.llm.vector_codes import PartTree, _restored, _stored, assign, coded, compress, moved, q_vector_codes


def result(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def plain(rows, rounds=6):
    """Lloyd's rounds, one part after the other, on rows ``(vec_id, vector, label)`` in id order."""
    ints = [[math.floor(4096 * x) for x in v] for _, v, _ in rows]
    size = len(ints[0]) // 8
    cut = [[v[p * size:(p + 1) * size] for p in range(8)] for v in ints]
    books = [[cut[i][p] for i in range(min(16, len(cut)))] for p in range(8)]

    def nearest(part, book):
        return min(range(len(book)), key=lambda e: (sum((a - b) ** 2 for a, b in zip(part, book[e])), e))

    for _ in range(rounds):
        for p in range(8):
            own = defaultdict(list)
            for c in cut:
                own[nearest(c[p], books[p])].append(c[p])
            books[p] = [[sum(col) // len(own[e]) for col in zip(*own[e])] if own[e] else b for e, b in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by_label = [], defaultdict(int)
    for (i, _, label), c in zip(rows, cut):
        codes = [nearest(c[p], books[p]) for p in range(8)]
        error = sum((a - b) ** 2 for p in range(8) for a, b in zip(c[p], books[p][codes[p]]))
        by_label[label] += error
        out.append((i, "".join(f"{e:02x}" for e in codes), error, label))
    return sorted(((i, c, e, by_label[label], sha) for i, c, e, label in out), key=str)


def test_matches_sql_on_the_table(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    assert result(q_vector_codes(spark, sf)) == sorted(con.execute(vector_codes.SQL).fetchall(), key=str)


@pytest.mark.parametrize("values", ["few", "many", "clusters"])
def test_trees_assign_like_all_distances(values):
    r = np.random.default_rng(len(values))
    parts = {"few": r.integers(-2, 3, (900, 3)), "many": r.integers(-5000, 5000, (900, 6)),
             "clusters": r.integers(-5000, 5000, (12, 4))[r.integers(0, 12, 900)] + r.integers(-40, 40, (900, 4))}[values]
    entries = parts[r.integers(0, 900, 16)].copy()
    entries[5] = entries[3]  # equal entries: the lower index
    want = ((parts[:, None] - entries) ** 2).sum(axis=2)
    tree = _restored(_stored(PartTree(parts)), parts.shape[1])
    codes, errors = coded(tree, parts, entries)
    assert (codes == want.argmin(axis=1)).all() and (errors == want.min(axis=1)).all() and 5 not in codes
    counts, sums = moved(tree, parts, entries)
    for e in range(16):
        assert counts[e] == (codes == e).sum() and (sums[e] == parts[codes == e].sum(axis=0)).all()
    if values == "clusters":  # whole nodes are settled by their sums
        settled, loose, _, _ = assign(tree, parts, entries)
        whole = sum((tree.end[n] - tree.start[n]).sum() for n, _ in settled)
        assert whole + len(loose) == 900 and whole > 450


@pytest.mark.parametrize("block", [20, 8192])
def test_odd_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    r = random.Random(5)
    rows = [(i, [r.choice([-0.5, -0.0001, 0.0, 0.3, 1.7]) for _ in range(16)], r.choice(["a", "b", None])) for i in range(70)]
    rows += [(90, rows[3][1], "b"), (90, rows[4][1], None), (90, rows[4][1], None)]
    dropped = [(91, None, "a"), (92, [0.5, None] * 8, "a"), (93, [float("nan")] * 16, "a"), (94, [float("inf")] * 16, "a")]
    rest = [(95, [], "a"), (96, [1.0] * 8, "a"), (97, [1.0] * 9, None), (98, [1e30] * 16, "b")]
    table = spark.createDataFrame([(*x, "y") for x in rows + dropped + rest],
                                  "vec_id long, embedding array<double>, label string, code string")
    got = result(compress(table))
    want = plain(sorted(rows, key=lambda x: (x[0], x[1])))
    assert [g for g in got if g[1] is not None] == want
    sums = {x[2]: next(w[3] for w in want if w[0] == x[0]) for x in rows if x[0] < 90}
    assert [(g[0], g[2], g[3]) for g in got if g[1] is None] == [(i, None, sums[label]) for i, _, label in rest]


def test_few_and_no_vectors(spark):
    ddl = "vec_id long, embedding array<float>, label int"
    rows = [(7, [0.25 * i for i in range(8)], 1), (None, [0.5] * 8, None), (3, [-0.25] * 8, 1)]
    got = result(compress(spark.createDataFrame(rows, ddl)))
    assert got == plain(sorted(rows, key=lambda x: (x[0] is None, x[0] or 0)))
    assert [(g[0], g[2]) for g in got] == [(3, 0), (7, 0), (None, 0)]  # three vectors, three entries
    assert compress(spark.createDataFrame([], ddl)).collect() == []
    only = compress(spark.createDataFrame([(1, [1e30] * 8, 4)], ddl)).collect()
    assert [(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in only] == [(1, None, None, None)]

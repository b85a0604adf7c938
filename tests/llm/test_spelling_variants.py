import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from rateflow.llm import spelling_variants
from rateflow.llm.spelling_variants import near_in_block, q_spelling_variants, variants, vocabulary


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_words(rows, least=6, often=5):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= often}


def plain_variants(words):
    near = {w: [v for v in words if is_near(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_matches_sql_on_the_table(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = result(q_spelling_variants(spark, sf))
    assert got == sorted(con.execute(spelling_variants.SQL).fetchall())
    assert any(r[1] for r in got)


@pytest.mark.parametrize("seed", range(6))
def test_block_search_finds_each_pair_once(seed):
    """Short words of few letters: runs of one letter, where an insertion has several places."""
    r = random.Random(seed)
    m = r.randint(1, 5)
    rests, group, strict = [], [], []
    for g in range(4):
        words = {"".join(r.choices("abé", k=m + r.randint(0, 1))) for _ in range(90)}
        flag = r.random() < 0.5
        for w in sorted(words):
            rests.append(w), group.append(g), strict.append(flag)
    i, j = near_in_block(rests, np.array(group), np.array(strict), m)
    got = Counter(zip(i.tolist(), j.tolist()))
    want = Counter()
    for x in range(len(rests)):
        for y in range(len(rests)):
            a, b = sorted((rests[x], rests[y]), key=len)
            if group[x] == group[y] and is_near(a, b) and len(a) == m and not (strict[x] and len(b) > m and b[:m] == a):
                want[x, y] += 1
    assert got == want


@pytest.mark.parametrize("limit,block", [(4, 8), (4096, 1024)])
def test_variants_match_brute_force(spark, monkeypatch, limit, block):
    """Divided groups (LIMIT 4) and whole ones give the same rows."""
    monkeypatch.setattr(spelling_variants, "BLOCK", block)
    r = random.Random(limit)
    words = {}
    while len(words) < 500:
        w = "".join(r.choices("abc", k=r.randint(2, 7)))
        words[w] = r.choice([5, 6, 25, 30, 125, 700, 4000])
    words |= {"x" * 3000: 9, "x" * 2999: 50, "x" * 2998 + "yx": 5, "ab" * 1500: 5, "é": 8, "a": 100}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = result(variants(table, limit=limit))
    assert got == plain_variants(words)
    assert sum(x[2] not in (x[0], x[1]) for x in got) > 5  # chains of forms


def test_odd_rows(spark, frame, odd_rows):
    run = "Straßen" + "É" * 30
    rows = [(i, t) for i, t, *_ in odd_rows] + [(20, None), (21, "")]
    rows += [(i, "Über-grüße Kolibri KOLIBRI kolibrr " * 4 + run) for i in range(30, 1030)] + [(None, "kolibri " * 3)] * 2
    got = result(variants(vocabulary(frame(rows))))
    want = plain_words(rows)
    assert got == plain_variants(want)
    assert {w: n for w, _, _, n, *_ in got} == want
    assert any(len(w) == 6 and is_near(w, "kolibri") for w in want)  # a letter left out


def test_empty_tables(spark, frame):
    assert variants(vocabulary(frame([]))).collect() == []
    assert variants(vocabulary(frame([(1, None), (2, "12 !")]))).collect() == []
    assert result(variants(spark.createDataFrame([("lonely", 7)], "word string, n long"))) == \
        [("lonely", None, "lonely", 7, 0, None)]

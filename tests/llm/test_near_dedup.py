import random
import re

import numpy as np
import pytest

from rateflow.llm import near_dedup
from rateflow.llm.components import components
from rateflow.llm.near_dedup import forest, near_groups, q_near_dedup
from rateflow.llm.shingles import batch_bytes, shingle_sets

SF = "/root/testdata/sf0.01"


def words_set(text):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def groups(texts):
    """Components of all linked pairs, over an inverted index."""
    sets = {i: words_set(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    at = {}
    for i, s in sets.items():
        for x in s:
            at.setdefault(x, []).append(i)
    done = set()
    for own in at.values():
        for n, i in enumerate(own):
            for j in own[:n]:
                if (i, j) not in done:
                    done.add((i, j))
                    both = len(sets[i] & sets[j])
                    if 100 * both >= 75 * len(sets[i] | sets[j]):
                        a, b = sorted((find(i), find(j)))
                        root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_whole_table_equals_all_pairs(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in q_near_dedup(spark, SF).collect()}
    assert got == groups(texts)


@pytest.mark.parametrize("limit,depth", [(4, 25), (4, 1), (256, 25)])
def test_large_and_dense_nodes(spark, monkeypatch, limit, depth):
    """One large group of near copies, a chain, copies and a shared passage."""
    monkeypatch.setattr(near_dedup, "LIMIT", limit)
    monkeypatch.setattr(near_dedup, "MAX_DEPTH", depth)
    r = random.Random(8)
    word = lambda: "".join(r.choices("abcdefgh", k=6))
    base = [word() for _ in range(200)]
    texts = {}
    for i in range(60):
        own = list(base)
        for _ in range(r.randint(0, 4)):
            own[r.randrange(200)] = word()
        texts[i] = " ".join(own)
    chain = [word() for _ in range(120)]
    for i in range(100, 110):
        chain = chain[3:] + [word() for _ in range(3)]
        texts[i] = " ".join(chain)
    for i in range(200, 230):
        texts[i] = " ".join(base[:60] + [word() for _ in range(100)])
    texts.update({300: texts[0], 301: texts[0].upper(), 302: "", 303: None, 304: "a b", 305: "A  b"})
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_groups(docs).collect()}
    assert got == groups(texts)


def test_words_are_cut_at_ascii_white_space_only():
    import pyarrow as pa

    texts = ["a\x0bb\x1fc d", "", "Ä a b   c  d e f", "one two three four FIVE", " x", "y "]
    sets = shingle_sets(*batch_bytes(pa.array(texts)))
    assert [len(s) for s in sets] == [len(words_set(t)) for t in texts]
    same = shingle_sets(*batch_bytes(pa.array(["One two\tthree four five", "one two three four FIVE "])))
    assert np.array_equal(*same) and np.array_equal(same[0], sets[3])


def test_components_of_a_path_a_star_and_loops(spark):
    pairs = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 40)] + [(7, 7), (None, 3)]
    out = {r["id"]: r["component"] for r in
           components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(51)}, **{1000 + i: 1000 for i in range(40)}}


def test_forest_takes_the_heaviest_edges():
    keep = forest(4, np.array([0, 1, 0, 2]), np.array([1, 2, 2, 3]), np.array([5, 1, 4, 2]))
    assert sorted(keep.tolist()) == [0, 2, 3]


def test_links_inside_deep_nodes_are_found(spark, monkeypatch):
    """Pairs just above the threshold among texts of 36 of 48 passages, which
    no rare passage parts."""
    monkeypatch.setattr(near_dedup, "LIMIT", 4)
    monkeypatch.setattr(near_dedup, "MAX_DEPTH", 11)
    r = random.Random(5)
    pool = [" ".join("".join(r.choices("abcdefgh", k=7)) for _ in range(30)) for _ in range(48)]
    texts = {}
    for i in range(0, 300, 2):
        own = sorted(r.sample(range(48), 36))
        new = sorted(r.sample(own, 32) + r.sample(sorted(set(range(48)) - set(own)), 4))
        texts[i], texts[i + 1] = (" ".join(pool[k] for k in x) for x in (own, new))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_groups(docs).collect()}
    sets = [words_set(texts[i]) for i in range(300)]
    pairs = [(i, j) for i in range(300) for j in range(i)
             if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    found = sum(got[i] == got[j] for i, j in pairs)
    print(f"recall {found} of {len(pairs)}")
    assert len(pairs) >= 100 and found >= 0.99 * len(pairs)


def test_rows_of_one_id_stay_or_go_by_their_own_text(spark):
    r = random.Random(6)
    text = lambda: [r.choice("abcdefgh") + str(r.randrange(10**6)) for _ in range(150)]
    a, b, c, d = text(), text(), text(), text()
    join = " ".join
    rows = [(1, join(a)), (2, join(a[:-1])), (2, join(b)),    # one text of id 2 is a copy, the other unique
            (3, join(c)), (3, join(c[:-1])), (4, join(c[1:])),   # two similar texts under the smallest id
            (5, join(d)), (5, join(d)), (6, ""), (6, ""), (None, join(a)), (None, join(a))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(x) for x in near_dedup.near_dedup(docs).collect()]
    want = [(1, join(a)), (2, join(b)), (5, join(d)), (6, ""), (6, ""), (None, join(a)), (None, join(a))]
    three = [x for x in got if x[0] == 3]
    assert len(three) == 1 and three[0] in rows
    assert sorted(map(str, got)) == sorted(map(str, want + three))
    rows = near_groups(docs).collect()
    assert sum(x["stays"] for x in rows) == len(got)
    assert all(x["kept"] == (x["doc_id"] is None or x["doc_id"] == x["component_id"]) for x in rows)
    assert sum(x["kept"] for x in rows if x["doc_id"] == 3) == 2 and sum(x["kept"] for x in rows if x["doc_id"] == 5) == 2

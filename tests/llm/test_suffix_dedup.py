import random
from collections import Counter

import numpy as np
import pytest

from rateflow.llm.loser_tree import common_prefix, merged
from rateflow.llm.suffix_dedup import anchors, cleaned, covered


def removed(texts, length):
    """Covered bytes of each text, by comparing all windows."""
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        out.append(bytes(gone))
    return out


def corpus(seed, alphabet=b"ab "):
    r = random.Random(seed)
    word = lambda n: bytes(r.choices(alphabet, k=n))
    shared = [word(r.randint(20, 90)) for _ in range(4)]
    texts = [b"".join(r.choice([*shared, word(r.randint(0, 30))]) for _ in range(r.randint(0, 8))) for _ in range(25)]
    return texts + [b"x" * 150, b"xy" * 80, b"", texts[0], texts[0], word(39)]


@pytest.mark.parametrize("seed", range(4))
def test_equals_comparison_of_all_windows(spark, seed):
    texts = corpus(seed)
    docs = spark.createDataFrame([(i % 20, t.decode()) for i, t in enumerate(texts)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_bytes"], bytes(r["kept"]), len(r["spans"])) for r in
                 cleaned(docs, length=40, gram=12).collect())
    want = []
    for i, (t, gone) in enumerate(zip(texts, removed(texts, 40))):
        runs = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        want.append((i % 20, len(t), bytes(b for b, g in zip(t, gone) if not g), runs))
    assert got == sorted(want)


def test_whole_table_equals_comparison_of_all_windows(spark, texts):
    from rateflow.llm.suffix_dedup import q_suffix_dedup

    got = {r["doc_id"]: r["n_removed"] for r in q_suffix_dedup(spark, "/root/testdata/sf0.001").collect()}
    ids, data = list(texts), [(t or "").encode() for t in texts.values()]
    assert got == {i: sum(g) for i, g in zip(ids, removed(data, 400))} and sum(got.values()) > 0


def test_equal_windows_have_equal_anchors():
    r = random.Random(5)
    text = bytes(r.choices(b"abcdefgh", k=900))
    data = np.frombuffer(text + text[100:700], dtype=np.uint8)
    place, lo, hi, gram = anchors(data, np.array([900, 1500]), 200, 32)
    of = {s: (p - s, g) for p, a, b, g in zip(place, lo, hi, gram) for s in range(a, b + 1)}
    assert sorted(of) == [*range(0, 701), *range(900, 1301)]
    assert all(of[100 + i] == of[900 + i] for i in range(400))


def test_loser_tree_merges_in_order_with_prefixes():
    r = random.Random(9)
    for k in (1, 2, 5, 8):
        runs = [sorted(bytes(r.choices(b"ab", k=r.randint(0, 12))) for _ in range(r.randint(0, 40))) for _ in range(k)]
        coded = []
        for run in runs:
            coded.append(iter([(s, common_prefix(s, run[i - 1]) if i else 0, None) for i, s in enumerate(run)]))
        out = list(merged(coded))
        strings = [s for s, _, _ in out]
        assert strings == sorted(s for run in runs for s in run)
        assert [n for _, n, _ in out[1:]] == [common_prefix(a, b) for a, b in zip(strings, strings[1:])]


def test_class_splitting_equals_all_pairs():
    r = random.Random(3)
    for _ in range(60):
        members = sorted({(b"g" + bytes(r.choices(b"ab", k=r.randint(0, 6))), bytes(r.choices(b"ab", k=r.randint(0, 6))))
                          for _ in range(r.randint(2, 14))})
        prefixes = [0] + [common_prefix(a[0], b[0]) for a, b in zip(members, members[1:])]
        want = set()
        for i, (s, left) in enumerate(members):
            for j, (t, other) in enumerate(members):
                back, ahead = common_prefix(left[::-1], other[::-1]), common_prefix(s, t)
                if i != j and back + ahead >= 6:
                    want |= {(i, x) for x in range(-back, ahead)}
        got = {(i, x) for i, b, a in covered([(*m, [0]) for m in members], prefixes, 6) for x in range(-b, a)}
        assert got == want

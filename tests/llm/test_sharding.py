import zlib

import pytest

from rateflow.llm.sharding import kd_shards, q_shards


def check(rows, texts, shards):
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(i) for i, _ in texts)
    own = {s: [] for s in range(shards)}
    for r in rows:
        own[r["shard"]].append(r)
    for part in own.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    return [sum(r["size"] for r in part) for part in own.values()]


def test_whole_table_is_dealt_evenly(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = q_shards(spark, sf).collect()
    sizes = check(rows, list(texts.items()), 24)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 8, zlib.crc32(data), "bytes")
    longest = max(len((t or "").encode()) for t in texts.values()) + 8
    assert max(sizes) - min(sizes) <= longest and max(sizes) <= 1.1 * sum(sizes) / 24


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_equal_metadata_divides(spark, shards):
    """One source, one text and no id on most rows still divide evenly."""
    rows = [(None, "same text", "s") for _ in range(960)] + [(i, "x" * (i % 50), None) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = check(kd_shards(docs, shards).collect(), rows_of(rows), shards)
    assert max(sizes) - min(sizes) <= 130


def rows_of(rows):
    return [(i, t) for i, t, _ in rows]


def test_splits_are_those_of_a_k_d_tree(spark):
    """Every split is along the dimension with the largest share of its whole range,
    divides it in order, and leaves each side its share of the bytes."""
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    shard = {r["doc_id"]: r["shard"] for r in q_shards(spark, sf).collect()}
    low, high = min(docs), max(docs)
    crc = lambda s: zlib.crc32(s.encode()) >> 1 if s is not None else 0
    at = {i: (int((i - low) / max(1.0, high - low) * (2 ** 31 - 1)), crc(d["source"]), crc(d["lang"]),
              len(d["text"] or ""), len((d["text"] or "").encode())) for i, d in docs.items()}
    size = {i: p[4] + 8 for i, p in at.items()}

    def spans(ids):
        return [max(at[i][k] for i in ids) - min(at[i][k] for i in ids) for k in range(5)]

    whole, seen = spans(docs), []

    def divided(ids, first, n):
        if n == 1:
            return
        own = spans(ids)
        widest = max(range(5), key=lambda k: own[k] / (whole[k] or 1))
        left = [i for i in ids if shard[i] < first + n // 2]
        right = [i for i in ids if shard[i] >= first + n // 2]
        assert max(at[i][widest] for i in left) <= min(at[i][widest] for i in right)
        aim = sum(size[i] for i in ids) * (n // 2) / n
        assert abs(sum(size[i] for i in left) - aim) <= max(size.values())
        seen.append(widest)
        divided(left, first, n // 2)
        divided(right, first + n // 2, n - n // 2)

    divided(list(docs), 0, 24)
    assert len(seen) == 23 and len(set(seen)) > 1

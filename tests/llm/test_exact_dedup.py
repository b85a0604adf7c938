from rateflow.llm import exact_dedup
from rateflow.llm.exact_dedup import exact_groups


def test_largest_id_stays_and_one_row_of_it(frame, odd_rows):
    out = exact_groups(frame(odd_rows)).collect()
    base = [r for r in out if r["group_size"] == 4]
    assert {r["keep_id"] for r in base} == {6} and [r["doc_id"] for r in base if r["kept"]] == [6]
    empty = [r for r in out if r["text_sha256"].startswith("e3b0c44298fc1c14")]
    assert {r["keep_id"] for r in empty} == {3} and [r["doc_id"] for r in empty if r["kept"]] == [3]
    assert sum(r["kept"] for r in out) == len({r[1] or "" for r in odd_rows})


def test_hot_text_is_dealt_and_combined(frame, monkeypatch):
    rows = [(i, "hot") for i in range(300)] + [(None, "hot")] * 3 + [(299, "hot")] + [(1000 + i, f"t{i}") for i in range(50)]
    for shares in (3, 1000):
        monkeypatch.setattr(exact_dedup, "HOT_SHARES", shares)
        out = exact_groups(frame(rows)).collect()
        hot = [r for r in out if r["group_size"] > 1]
        assert len(hot) == 304 and {(r["keep_id"], r["group_size"]) for r in hot} == {(299, 304)}
        assert [r["doc_id"] for r in hot if r["kept"]] == [299]
        assert len(out) == 354 and sum(r["kept"] for r in out) == 51


def test_group_without_any_id_keeps_one_row(frame):
    out = exact_groups(frame([(None, "x"), (None, "x"), (1, "y")])).collect()
    assert sorted((r["keep_id"] or 0, r["kept"]) for r in out) == [(0, False), (0, True), (1, True)]


def test_matches_sql_on_the_table(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.execute(exact_dedup.SQL).fetchall()
    got = exact_dedup.q_exact_dedup(spark, sf).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)

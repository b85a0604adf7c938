"""Every operator on odd rows and on an empty table: all rows come back."""

import pytest

from rateflow.llm import (
    exact_dedup, language, licenses, near_dedup, packing, secrets, sentence_pieces, sharding, suffix_dedup)

OPERATORS = {
    "pack": packing.pack, "suffixes": lambda d: suffix_dedup.cleaned(d), "language": language.identify,
    "exact": exact_dedup.exact_groups, "pieces": sentence_pieces.digests, "secrets": secrets.scan,
    "near": near_dedup.near_groups, "licenses": licenses.license_labels, "shards": sharding.kd_shards,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_all_come_back(frame, odd_rows, name):
    out = OPERATORS[name](frame(odd_rows)).collect()
    if name == "pack":
        assert sum(r["piece"] == 0 for r in out) == len(odd_rows)
    else:
        assert sorted(str(r["doc_id"]) for r in out) == sorted(str(r[0]) for r in odd_rows)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table_gives_empty_result(frame, name):
    assert OPERATORS[name](frame([])).collect() == []


@pytest.mark.parametrize("keep", [language.identified, exact_dedup.exact_dedup, near_dedup.near_dedup,
                                  secrets.redact])
def test_filters_keep_the_columns(frame, odd_rows, keep):
    docs = frame(odd_rows)
    out = keep(docs)
    assert out.dtypes == docs.dtypes
    assert 0 < out.count() <= len(odd_rows)

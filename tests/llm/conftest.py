import random

import pytest

SF = "/root/testdata/sf0.001"
CLASHES = ("_row", "row", "key", "label", "kept", "found", "ids", "run", "gram", "sig", "id", "_id", "_text", "shard",
           "_node", "_part", "_size", "piece", "n_words", "words", "score", "rejected", "component", "digest", "a", "u")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, " + \
    ", ".join(f"{c} string" for c in CLASHES)


def prose(seed, n, syllables=("ka", "lo", "mi", "ter", "an", "sou", "vel", "dri", "é")):
    r = random.Random(seed)
    return " ".join("".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def frame(spark):
    """Make a documents table, with extra columns of clashing names, from
    ``(doc_id, text)`` or ``(doc_id, text, lang)`` rows."""
    def made(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, len(r[1]) if r[1] is not None else None,
                 *["x"] * len(CLASHES)) for r in rows]
        return spark.createDataFrame(full, COLUMNS)

    return made


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows and ids."""
    base = prose(1, 120)
    return [(1, base, "xx"), (2, None, "xx"), (3, "", None), (4, prose(2, 40_000), "xx"), (5, base, "yy"),
            (5, base, "yy"), (6, base, None), (None, prose(3, 30), "xx"), (None, None, None), (7, " \t\n ", "yy"),
            (8, "a" * 3000, "yy"), (9, "one two", "yy"), (9, prose(4, 50), "yy"), (-10, "12 34 !", "xx")]


@pytest.fixture(scope="session")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}

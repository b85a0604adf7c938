import random
import zlib

import zstandard

from rateflow.llm.language import fit, identify, letters, predict

from rateflow.llm.common import documents

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_columns(spark):
    docs = documents(spark, SF)
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    out = identify(docs).collect()
    assert len(out) == len(truth)
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in out if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert sum(r["rejected"] for r in out) <= 0.01 * len(out)


def test_labels_of_held_out_rows_are_not_read(spark):
    from pyspark.sql import functions as F

    docs = documents(spark, SF)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    assert fit(docs.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang")))) == fit(docs)


def test_null_letterless_and_ties():
    model = [("aa", b" kala mala tala "), ("bb", b" kala mala tala ")]
    assert predict(None, model) == ("und", 0.0, True) and predict("12 -- ², !", model)[0] == "und"
    for n in (1, 3, 20, 100, 5000):  # no language stands out, at any length
        assert predict("kala " * n, model) == ("aa", 0.0, True)
    assert predict("kala", model[:1]) == ("aa", 1.0, False) and predict("kala", [])[0] == "und"
    assert letters("Éa1b_c!") == " éa b c ".encode()


UNLEARNED = {
    "russian": "Добрый день. Мы хотим рассказать вам о новой книге, которая вышла в прошлом году. ",
    "chinese": "今天天气很好，我们一起去公园散步吧。那里有很多花和树，还有一个美丽的湖。",
    "greek": "Καλημέρα σας, θα θέλαμε να σας μιλήσουμε για ένα νέο βιβλίο. ",
    "junk": "zzzqx vrrk qxqw ",
}


def test_unlearned_languages_are_rejected_at_every_length(spark):
    model = fit(documents(spark, SF))
    for text in UNLEARNED.values():
        for n in (4, 10, 25, 60, 200, 1000, 9000):
            assert predict((text * n)[:n], model)[2]


def test_sizes_are_those_of_plain_compression(spark):
    """Sizes, winner, score and rejection by calls of the compressor alone."""
    model = fit(documents(spark, SF))
    mark = b" 0123456789:;<=>?@0987654321#%&*+"
    r = random.Random(1)
    texts = [row["text"] for row in documents(spark, SF).select("text").collect() if row["text"]]
    for text in r.sample(texts, 60) + [t[:30] for t in r.sample(texts, 60)]:
        body = letters(text)
        if not body:
            continue
        sizes = []
        for lang, content in model:
            how = zstandard.ZstdCompressionParameters.from_level(
                9, dict_size=len(content) + len(mark), source_size=4096, write_content_size=0, write_checksum=0, write_dict_id=0)
            packer = zstandard.ZstdCompressor(compression_params=how, dict_data=zstandard.ZstdCompressionDict(
                content + mark, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            sizes.append(sum(len(packer.compress(mark + body[at:at + 4096])) for at in range(0, len(body), 4096)))
        best, second = sorted(sizes)[:2]
        score = (second - best) / second
        assert predict(text, model) == (model[sizes.index(best)][0], score, score < 0.02)

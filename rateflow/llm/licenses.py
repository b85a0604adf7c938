"""License scan by diagonal voting (DataFrame functions only).

Every rolling word k-gram of every text is hashed and joined with the k-grams
of the templates (a fixed list of a few hundred grams, broadcast); hashes that no
template has are left out before the join (:func:`template_grams` is a fixed table,
so its hashes are constants of the plan), and a hit's words are compared with the
template's.  A hit at word ``i`` of a text and word ``j`` of a template votes for the
diagonal ``i - j``; votes are summed by text, template and diagonal, diagonals of one
template at most ``SLACK`` words apart are merged (words put in or left out shift
the diagonal), and the merged span is verified: a base phrase needs all its words
in place on one diagonal, a longer passage ``COVER`` of its k-grams, in rising order
(the longest run of hits by rising words of text and template, within a stretch of
the text that is at most ``SLACK`` words longer than the passage).

Words are runs of letters and digits (every non-ASCII character is part of a
word), A-Z in lower case.  ``score`` is the best verified share of a template,
1 for a base phrase and 0 without a label.

Edge cases: a null or empty text has no word and no label; texts of any length
are read whole; rows are told apart by their place in the table, so rows that
repeat a ``doc_id`` or have none keep their own results; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rateflow.llm.common import documents, local_table, lower_ascii, text_of

SLACK = 8
COVER = 0.6
PHRASES = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]
PASSAGES = [
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in "
                   "compliance with the license"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license "
                   "is distributed on an as is basis without warranties or conditions of any kind either express or "
                   "implied"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the "
            "following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and "
            "the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the "
            "implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the software"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited "
            "to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
PHRASE_GRAM, PASSAGE_GRAM = 2, 4
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(text), NOT_WORD), lambda w: w != "")


def _gram(words: Column, i: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(words, i + j) for j in range(k)])


def _grams(words: Column, n_words: Column, k: int, known: list | None = None) -> Column:
    """``(at, text, gram)`` for every place of a k-gram, or for those whose hash and
    first word are ``known`` (rows of :func:`template_grams`)."""
    places = F.when(n_words >= k, F.sequence(F.lit(0), n_words - k)).otherwise(F.array().cast("array<int>"))
    if known is not None:
        first, grams = {r["t_text"].split(" ")[0] for r in known}, [r["t_gram"] for r in known]
        places = F.filter(places, lambda i: F.get(words, i).isin(sorted(first)))
        places = F.filter(places, lambda i: _gram(words, i, k).isin(grams))
    return F.transform(places, lambda i: F.struct(
        i.alias("at"), F.array_join(F.slice(words, i + 1, k), " ").alias("text"), _gram(words, i, k).alias("gram")))


def template_grams(spark: SparkSession, phrases=PHRASES, passages=PASSAGES) -> DataFrame:
    rows = [(n, label, base, text.split(" "), k) for n, (label, text, base, k) in enumerate(
        [(*p, True, PHRASE_GRAM) for p in phrases] + [(*p, False, PASSAGE_GRAM) for p in passages])]
    texts = local_table(spark, rows, "template int, label string, base boolean, words array<string>, k int")
    by_k = [texts.where(F.col("k") == k).withColumn("n", F.size("words"))
            .select("template", "label", "base", (F.col("n") - k + 1).alias("n_grams"),
                    F.explode(_grams(F.col("words"), F.col("n"), k)).alias("g"))
            for k in (PHRASE_GRAM, PASSAGE_GRAM)]
    return by_k[0].unionAll(by_k[1]).select(
        "template", "label", "base", "n_grams", F.col("g.at").alias("t_at"),
        F.col("g.text").alias("t_text"), F.col("g.gram").alias("t_gram"))


def hits(docs: DataFrame) -> DataFrame:
    """A row without template for every text, and one per k-gram hit."""
    split = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long").alias("doc_id"),
                        words_of(text_of(docs)).alias("_words"))
    counted = split.withColumn("n_words", F.size("_words"))
    words, n = F.col("_words"), F.col("n_words")
    own = F.array(F.struct(F.lit(-1).alias("at"), F.lit(None).cast("string").alias("text"),
                           F.lit(None).cast("long").alias("gram")))
    grams = template_grams(docs.sparkSession)
    fixed = grams.collect()     # the templates of this module
    known = {base: [r for r in fixed if r["base"] == base] for base in (True, False)}
    exploded = counted.select("_row", "doc_id", "n_words", F.explode(F.concat(
        own, _grams(words, n, PHRASE_GRAM, known[True]), _grams(words, n, PASSAGE_GRAM, known[False]))).alias("g"))
    met = (F.col("g.gram") == F.col("t_gram")) & (F.col("g.text") == F.col("t_text"))
    return (exploded.join(F.broadcast(grams), met, "left").where(F.col("template").isNotNull() | (F.col("g.at") < 0))
            .select("_row", "doc_id", "n_words", "template", "label", "base", "n_grams", "t_at",
                    (F.col("g.at") - F.col("t_at")).alias("diagonal")))


def _in_order(hits: Column, n_grams: Column) -> Column:
    """Most template places that hits ``(at, t_at)``, sorted by ``at``, run through in
    rising order, in one stretch of the text not much longer than the template."""
    # A run ends where the template's place does not rise or the stretch gets too long.
    start = F.struct(F.lit(0).alias("best"), F.lit(0).alias("n"), F.lit(-1).cast("long").alias("last"), F.lit(0).cast("long").alias("since"))

    def step(run: Column, hit: Column) -> Column:
        goes_on = (hit["t_at"] > run["last"]) & (hit["at"] - run["since"] < n_grams + SLACK) & (run["n"] > 0)
        n = F.when(goes_on, run["n"] + 1).otherwise(F.lit(1))
        return F.struct(F.greatest(run["best"], n).alias("best"), n.alias("n"), hit["t_at"].cast("long").alias("last"),
                        F.when(goes_on, run["since"]).otherwise(hit["at"].cast("long")).alias("since"))

    return F.aggregate(hits, start, step, lambda run: run["best"])


def spans(docs: DataFrame) -> DataFrame:
    """Merged diagonals of every text: ``_row, doc_id, n_words, template, label,
    base, start, places, cover`` (one row without template for each text)."""
    key = ["_row", "doc_id", "n_words", "template", "label", "base", "n_grams"]
    votes = (hits(docs).repartition("_row").groupBy(*key, "diagonal")
             .agg(F.collect_set("t_at").alias("_seen"))
             # A phrase must stand in full on its own diagonal.
             .where(F.col("template").isNull() | ~F.col("base") | (F.size("_seen") == F.col("n_grams"))))
    ordered = Window.partitionBy("_row", "template").orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(ordered) > SLACK) | F.col("base"), F.lit(True))
    merged = (votes.withColumn("_apart", apart.cast("int"))
              .withColumn("_span", F.sum("_apart").over(ordered)).groupBy(*key, "_span")
              .agg(F.min("diagonal").alias("start"), F.flatten(F.collect_list(F.transform(
                  "_seen", lambda t: F.struct((F.col("diagonal") + t).alias("at"), t.alias("t_at"))))).alias("_hits"))
              .withColumn("_n", _in_order(F.array_sort("_hits"), F.col("n_grams"))).drop("_hits"))
    cover = F.col("_n") / F.col("n_grams")
    return (merged.withColumn("cover", F.when(F.col("template").isNotNull(), cover).otherwise(0.0))
            .where(F.col("template").isNull() | F.col("base") | (F.col("cover") >= COVER))
            .drop("_n", "_span", "n_grams"))


def license_labels(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score`` of every row."""
    base = F.coalesce(F.col("base"), F.lit(False))
    listed = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(c)))
    return (spans(docs).groupBy("_row", "doc_id", "n_words").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        listed(F.when(base, F.col("label"))).alias("base_labels"), listed("label").alias("labels"),
        F.max("cover").alias("score"))
        .withColumn("n_words", F.col("n_words").cast("long")).drop("_row"))


def q_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_labels(documents(spark, sf_dir))

"""Very long texts, repeated benchmark rows, language profiles, held to plain versions."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidelake.llm import chat, decontaminate, langid, quality, queries, simhash, toxicity
from tidelake.llm.words import words

LONG = 90_000


def test_fingerprints_of_texts_longer_than_a_block(spark):
    from tests.llm.test_simhash import brute_fingerprint

    rng = np.random.default_rng(1)
    text = " ".join(f"w{i}" for i in rng.integers(0, 1 << 40, LONG))  # more than a block of 65,536 shingles
    docs = spark.createDataFrame([(1, text), (2, text + " x"), (3, "short")], "doc_id long, text string")
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert int(got[1].fingerprint, 16) == brute_fingerprint(text) and got[2].component_id == 1 and got[3].component_id == 3


def test_models_score_a_very_long_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    long = spark.createDataFrame([(10**9, "a word and more of it " * LONG, "en")], docs.schema)
    every = docs.unionByName(long)
    for rows in (toxicity.toxicity(every, labels), quality.quality(every, labels), langid.language_id(every)):
        got = rows.where("doc_id = 1000000000").collect()
        assert len(got) == 1 and 0 <= got[0].score <= 1
    assert rows.count() == docs.count() + 1


def test_a_very_long_turn_is_formatted_whole(spark):
    text = "long turn " * LONG
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    (row,) = chat.chat_digests(turns, queries.tokenizer_path()).collect()
    assert (row.n_turns, row.loss_chars) == (2, len(text))


def test_benchmark_rows_that_repeat_count_once(spark):
    phrase = "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs = spark.createDataFrame([(1, f"a {phrase} b"), (2, "clean text"), (3, None)], "doc_id long, text string")
    once = spark.createDataFrame([("i", phrase), ("j", "clean other words")], "item_id string, text string")
    many = once.unionByName(spark.createDataFrame([("i", phrase)] * 500, once.schema))
    rows = lambda benchmark: sorted(map(tuple, decontaminate.contamination(docs, benchmark).collect()))
    assert rows(once) == rows(many) and sum(len(b) for b in decontaminate._blocks(many, "item_id", "text", 1 << 20)) == 2
    assert words(phrase)[0] == b"one"


def test_profiles_are_the_most_frequent_grams_of_what_is_drawn(spark):
    rng = np.random.default_rng(2)
    rows = [(7 if i < 400 else i, " ".join(rng.choice(["the", "of", "und", "der", "la", "le"], 20)), "ab"[i % 2], "x") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, gram string")
    whole = langid.profiles(docs, "lang", F.lit(True), "doc_id", "text", most=10**6, top=50)
    for lang in "ab":
        counts = Counter()
        for _, text, own, _ in rows:
            if own == lang:
                codes, n = langid.grams(text)
                counts.update(dict(zip(codes.tolist(), n.tolist())))
        signed = {int(np.uint64(c).astype(np.int64)): n for c, n in counts.items()}
        assert whole[lang] == [c for c, _ in sorted(signed.items(), key=lambda kv: (-kv[1], kv[0]))[:50]]
    few = langid.profiles(docs.where("doc_id = 7"), "lang", F.lit(True), "doc_id", "text", most=20, top=50)
    assert set(few) == {"a", "b"} and few != langid.profiles(docs.where("doc_id = 7"), "lang", F.lit(True), "doc_id", "text", most=10**6, top=50)  # one id's documents are drawn one by one

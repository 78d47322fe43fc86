import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidelake.llm import simhash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_components(fps, distance=3):
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fps = sorted(parent)
    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {f: root(f) for f in fps}


@pytest.mark.parametrize("text", [None, "", " \n\t", "one", "one two", "A b C", "the cat sat on the mat " * 9, "é\x85ü wörd\x0bnext\x0cpage x"])
def test_fingerprint_is_the_contracts(text):
    assert simhash.fingerprint_of(text) == brute_fingerprint(text)


def test_spark_xxhash_agrees(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("the cat sat"))).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"the cat sat", 42)


def clustered(rng, groups, each):
    out = set()
    for _ in range(groups):
        f = int(rng.integers(0, 1 << 63)) * 2
        for _ in range(each):
            out.add(f)
            for bit in rng.choice(64, int(rng.integers(0, 5)), replace=False):
                f ^= 1 << int(bit)
    return sorted(out)


@pytest.mark.parametrize("limit", [8192, 3])
def test_links_give_the_components_of_all_pairs(spark, limit):
    fps = clustered(np.random.default_rng(limit), 12, 9)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash.links(spark.createDataFrame(signed, "fp long"), bucket_limit=limit)
    for a, b in links.collect():
        assert a != b
    got = {r.node % (1 << 64): r.root for r in simhash.components(links).collect()}
    expect = brute_components(fps)
    groups, wanted = {}, {}
    for f in fps:
        groups.setdefault(got.get(f, f - (1 << 64) if f >> 63 else f), set()).add(f)
        wanted.setdefault(expect[f], set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = dict(simhash.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)}


def test_documents_with_nulls_ties_and_clashing_columns(spark):
    rows = [(5, "a b c d e f", 1), (3, "a b c d e f", 2), (3, "a b c d e f", 2), (9, None, 3), (8, "", 4), (None, "  ", 5), (None, "q r s t u v w x", 6), (1, "other words stand here now", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(None, None), (None, 8), (1, 1), (3, 3), (3, 3), (5, 3), (8, 8), (9, 8)], key=str)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.fp for r in kept.collect()) == [2, 4, 6, 7]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.keep_one(docs).count() == 0

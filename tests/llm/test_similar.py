import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidelake.llm import similar


def texts(seed=5):
    """Random texts with copies of few and of many replaced words."""
    rng = np.random.default_rng(seed)
    word = lambda: "w" + str(rng.integers(0, 1 << 40))
    out = []
    for length in (12, 40, 150, 400):
        for _ in range(6):
            base = [word() for _ in range(length)]
            out.append(" ".join(base))
            for share in (0.005, 0.01, 0.02, 0.03, 0.06):
                w = list(base)
                for i in rng.choice(length, max(1, int(length * share)), replace=False):
                    w[i] = word()
                out.append(" ".join(w).upper())
    return [*out, out[0], None, "", " \n", "few words", "Few  words", "one"]


def brute_kept(found, percent=80):
    sets = []
    for t in found:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    root = list(range(len(found)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for b in range(len(sets)):
        for a in range(b):
            same = len(sets[a] & sets[b])
            if 100 * same >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return sorted(i for i in range(len(found)) if root[i] == i)


@pytest.mark.parametrize("block", [1 << 19, 40])
def test_keeps_what_all_pairs_keep(spark, block):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string").repartition(3)
    kept = similar.keep_one(docs, block=block)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == brute_kept(texts())


def test_the_stage_drops_copies_of_similarity_080(spark):
    found = texts(9)
    docs = spark.createDataFrame(list(enumerate(found)), "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()) == brute_kept(found)


def test_fingerprints_alone_give_candidates_that_are_held_to_the_similarity(spark):
    base = [f"w{i * 7919}" for i in range(500)]
    half = [f"v{i * 104729}" for i in range(500)]
    found = [" ".join(base), " ".join([*base[:-1], "other"]), " ".join(base[1:]), " ".join(half), "one two", "one  two"]
    docs = spark.createDataFrame(list(enumerate(found)), "doc_id long, text string")
    prints = similar.with_bands(docs, "doc_id", "text", 5).withColumn("bands", F.array().cast("array<long>"))
    nodes = [similar._node(similar.shingles_of(t)) for t in found]
    made = similar.links(docs, prints, "doc_id", "text", 5, 80, 1 << 19).collect()
    assert len(made) == 2 and {n for r in made for n in r} == set(nodes[:3])
    assert similar.links(docs, prints, "doc_id", "text", 5, 100, 1 << 19).count() == 0


def test_nulls_ties_and_empty(spark):
    rows = [(3, "a b c d e f", 1), (3, "a b c d e f", 2), (5, "A b c d e f", 3), (None, "  ", 4), (None, "q r s t u v w x", 5), (8, "", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node int")
    kept = sorted(r.node for r in similar.keep_one(docs).collect())
    assert kept in ([1, 5, 6], [2, 5, 6])
    assert similar.keep_one(spark.createDataFrame([], docs.schema)).count() == 0


def near_copies(n, seed=3):
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in rng.integers(0, 1 << 40, 300)]
    out = []
    for k in range(n):
        w = list(base)
        for i in rng.choice(300, 2, replace=False):
            w[i] = f"n{k}x{i}"
        out.append(" ".join(w))
    return out


def test_rows_of_a_crowded_bucket_grow_with_its_texts(spark, monkeypatch):
    counts = []

    def counted(f):
        def g(*args):
            made = f(*args)
            counts.append(made.count())
            return made

        return g

    monkeypatch.setattr(similar, "tiles_of", counted(similar.tiles_of))
    monkeypatch.setattr(similar, "tiles_across", counted(similar.tiles_across))
    rows = {}
    for n in (200, 400, 800):
        counts.clear()
        found = near_copies(n)
        docs = spark.createDataFrame(list(enumerate(found)), "doc_id long, text string")
        assert [r.doc_id for r in similar.keep_one(docs, block=4096).collect()] == [0]
        rows[n] = sum(counts)
    assert rows[400] < 2.4 * rows[200] and rows[800] < 2.4 * rows[400], rows


def test_texts_outside_the_largest_component_meet_all(spark):
    """Blocks so small that the rounds alone join little: the exact way has to."""
    found = near_copies(12) + near_copies(5, 4) + texts(2)[:40]
    docs = spark.createDataFrame(list(enumerate(found)), "doc_id long, text string")
    assert sorted(r.doc_id for r in similar.keep_one(docs, block=20).collect()) == brute_kept(found)


def test_clashing_columns_and_a_very_long_text(spark):
    long = " ".join(f"w{i}" for i in range(150_000))
    rows = [(1, long, 1, "a", 2.0), (2, long + " more", 2, "b", 2.0), (3, "short text", 3, "c", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, own_hash int, kept_id string, __text double")
    kept = similar.keep_one(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id, r.own_hash, r.kept_id) for r in kept.collect()) == [(1, 1, "a"), (3, 3, "c")]

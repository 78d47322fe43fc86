import numpy as np
import pytest

from tidelake.llm import decontaminate as d
from tidelake.llm.fm_index import FmIndex, suffix_order
from tidelake.llm.words import words


@pytest.mark.parametrize("n,symbols", [(1, 1), (40, 1), (200, 2), (500, 7)])
def test_index_finds_what_scanning_finds(n, symbols):
    rng = np.random.default_rng(n)
    text = rng.integers(1, symbols + 1, n)
    ended = np.append(text, 0)
    assert suffix_order(ended).tolist() == sorted(range(n + 1), key=lambda i: ended[i:].tolist())
    index = FmIndex(text)
    for k in (1, 2, 5):
        phrases = rng.integers(1, symbols + 3, (20, k))
        for p, lo, hi in zip(phrases, *index.search(phrases)):
            found = sorted(index.locate(np.arange(lo, max(lo, hi))).tolist())
            assert found == [i for i in range(n - k + 1) if (text[i : i + k] == p).all()]


def brute(text, items):
    own, hit, named = words(text), set(), set()
    for item, t in items:
        w = words(t)
        k = min(13, len(w))
        for a in range(len(w) - k + 1 if w else 0):
            for i in range(len(own) - k + 1):
                if own[i : i + k] == w[a : a + k]:
                    hit.update(range(i, i + k))
                    named.add(item)
    return len(own), len(hit), sorted(named)


def test_judgement_equals_brute_force_at_any_shard_size():
    rng = np.random.default_rng(3)
    vocabulary = ["a", "B", "cc", "é", "x9", "ß"]
    say = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [("10", say(20)), ("2", say(13)), ("3", say(4)), ("x", ""), ("y", None), ("z", "a"), ("10", say(15))]
    texts = [None, "", "...", *[say(int(n)) for n in rng.integers(1, 60, 25)], "q " * 20 + items[0][1] + "! " + items[1][1].upper()]
    texts += [texts[-1], texts[5]]
    known = d.phrases_of(items)
    for shard in (1, 7, 2_000_000):
        for text, (n, hits, named, spans) in zip(texts, d.judge(texts, known, shard)):
            assert (n, hits, named) == brute(text, items)
            assert sum(b - a for a, b in spans) == hits and all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_rows_blocks_and_stage(spark):
    bench = [(1, "one two three four five"), (None, "six seven"), (2, None), (3, "")]
    rows = [(1, "ONE two, three four five", 0), (1, "ONE two, three four five", 0), (None, "x six seven " + "y " * 60, 1), (2, None, 2), (3, "clean text", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, contamination int")
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in d.contamination(docs, items).collect()}
    assert got == {(1, 5, 5, 1, True), (None, 63, 2, 1, False), (2, 0, 0, 0, False), (3, 2, 0, 0, False)}
    kept = d.keep_uncontaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r.contamination for r in kept.collect()) == [1, 2, 3]
    one = d.with_contamination(docs.select("doc_id", "text"), items)
    many = d.with_contamination(docs.select("doc_id", "text"), items, block_bytes=8)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    assert d.contamination(docs, items.limit(0)).where("n_hit > 0").count() == 0
    assert d.contamination(docs.limit(0), items).count() == 0


def test_long_texts_and_long_items_go_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(d, "PIECE_WORDS", 40)
    rng = np.random.default_rng(9)
    item = " ".join(f"w{i}" for i in rng.integers(0, 500, 300))
    text = " ".join(f"w{i}" for i in rng.integers(0, 500, 3000)) + " " + " ".join(item.split()[100:160])
    docs = spark.createDataFrame([(1, text, "x", 0), (2, "clean", "y", 1)], "doc_id long, text string, n_words string, row int")
    bench = spark.createDataFrame([("a", item), ("b", "never seen words")], "item_id string, text string")
    got = {r.doc_id: r for r in d.contamination(docs, bench).collect()}
    n, hit, _ = brute(text, [("a", item)])
    assert (got[1].n_words, got[1].n_hit, got[1].n_items) == (n, hit, 1) and hit >= 60
    blocks = {r.doc_id: r for r in d.with_contamination(docs, bench, block_bytes=300).collect()}
    assert blocks[1].contamination.n_hit == hit and blocks[2].contamination.n_hit == 0
    assert {c for c in docs.columns} <= {*blocks[1].asDict()}


def test_phrases_travel_packed():
    import pickle

    known = d.phrases_of([("a", "one two three"), ("b", "two three one"), ("c", "one two three")])
    assert known.symbols[b"two"] == 3
    back = pickle.loads(pickle.dumps(known))
    assert "symbols" not in back.__dict__ and back.symbols == known.symbols
    assert sorted(back.names[i] for i in back.items(3, np.array([0, 1]))) == ["a", "b", "c"]

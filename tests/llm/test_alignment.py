"""Alignment of two tokenizers against plain versions of groups, links and counts."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from tidelake.llm import alignment
from tidelake.llm.alignment import alignment as aligned

A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def plain_components(n, edges):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


@pytest.mark.parametrize("seed", range(5))
def test_union_find_is_the_plain_one(seed):
    rng = np.random.default_rng(seed)
    n = 300
    u, v = rng.integers(0, n, 60 + 60 * seed), rng.integers(0, n, 60 + 60 * seed)
    assert alignment.union_find(n, u, v).tolist() == plain_components(n, zip(u.tolist(), v.tolist()))
    path = np.arange(n - 1)
    assert set(alignment.union_find(n, path[::-1], path[::-1] + 1).tolist()) == {0}
    assert alignment.union_find(4, u[:0], v[:0]).tolist() == [0, 1, 2, 3]


@pytest.mark.parametrize("seed", range(8))
def test_components_are_the_minimal_groups(seed):
    rng = np.random.default_rng(seed)
    size = 400
    a, b = (np.sort(np.append(rng.choice(np.arange(1, size), 60 + 20 * seed, replace=False), size)) for _ in range(2))
    u, v = alignment.overlaps(a, b)
    span = lambda ends: [(x, y) for x, y in zip([0, *ends[:-1].tolist()], ends.tolist())]
    assert set(zip(u.tolist(), v.tolist())) == {(i, j) for i, (p, q) in enumerate(span(a)) for j, (r, s) in enumerate(span(b)) if max(p, r) < min(q, s)}
    cuts = sorted(set(a.tolist()) & set(b.tolist()))
    a_group, b_group = alignment.components(a, b)
    assert a_group.tolist() == [np.searchsorted(cuts, x) for x in a] and b_group.tolist() == [np.searchsorted(cuts, x) for x in b]
    i, j = alignment.links(a, b, a_group, b_group)
    assert sorted(zip(i.tolist(), j.tolist())) == [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x == y]


def brute(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(A_PATH)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    codes = alignment.byte_level_alphabet()
    docs, counts = [], Counter()
    for t in texts:
        a, b = (one.encode(" " + t, add_special_tokens=False).ids, two.encode(t)) if t else ([], [])
        a_bytes = [bytes(codes[c] for c in one.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or not (b"".join(a_bytes) == b"".join(b_bytes) == (" " + t).encode()):
            docs.append(None)
            continue
        ends = []
        for ids, parts in ((a, a_bytes), (b, b_bytes)):
            at, found = 0, {}
            for i, p in zip(ids, parts):
                at += len(p)
                found[at] = i
            ends.append(found)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        links = [(ends[0][c], ends[1][c]) for c in cuts]
        counts.update(links)
        groups, left = [], [list(e.items())[::-1] for e in ends]
        for cut in cuts:
            sides = [[], []]
            for side, rest in zip(sides, left):
                while rest and rest[-1][0] <= cut:
                    side.append(str(rest.pop()[1]))
            groups.append("|".join(map(",".join, sides)))
        docs.append((len(a), len(b), len(groups), links, ";".join(groups)))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, n, links, text = d
            out.append((n_a, n_b, n, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


TEXTS = [
    "The cat sat on the mat.", None, "", " ", "  two  spaces ", "tail ", "\tTab\nline\r\n", "a▁b", "▁", "naïve café – 東京 🙂 ﬁ", "é", "<|endoftext|> <s>x</s> <0x41>",
    "don't we've I'll 'tis", "x" * 300, "1234567890 3.14", "The cat sat on the mat.", "nul\x00byte", "a b  c", "wörter wie diese\nund jene, dann noch mehr", "the the the the the cat", "�\U0001f9d1‍\U0001f680",
]


def test_rows_are_those_of_the_plain_version(spark, sf_dir):
    some = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()]
    texts = [*TEXTS, *some, "long " + "wordy text and more " * 20_000]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_a int, block string").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in aligned(docs, A_PATH, B_PATH).collect()}
    want = brute(texts)
    assert [got[i] for i in range(len(texts))] == want


def test_words_forgotten_in_between_change_nothing(spark):
    made = alignment.Aligner(A_PATH, B_PATH, memo=40)
    texts = [f"some {i} words {i * 7 % 50} of {'abc' * (i % 4)} text" for i in range(200)]
    whole = alignment.Aligner(A_PATH, B_PATH)
    for i in range(0, 200, 10):
        for x, y in zip(made.texts(texts[i : i + 10]), whole.texts(texts[i : i + 10])):
            assert x[0] == y[0] and x[1].tolist() == y[1].tolist()


def test_repeats_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "same text"), (1, "same text"), (None, "same text"), (None, None)], "doc_id long, text string")
    rows = sorted(aligned(docs, A_PATH, B_PATH).collect(), key=str)
    assert len(rows) == 4 and {r.count_sum for r in rows} == {0, 3 * rows[0].n_links} and sum(r.doc_id is None for r in rows) == 2
    assert aligned(docs.where("doc_id = 9"), A_PATH, B_PATH).count() == 0

"""Exact duplicates against a plain version: white space, nulls, repeats, shared lengths and prefixes."""

import hashlib
import re
from collections import defaultdict

import pytest

from tidelake.llm import exact


def brute(rows):
    groups = defaultdict(list)
    for i, (d, t) in enumerate(rows):
        clean = re.sub("[\x20\x09-\x0d]+", " ", t or "")
        groups[hashlib.sha256(clean.encode()).hexdigest()].append((d is None, d if d is not None else 0, i))
    out = []
    for digest, members in groups.items():
        least = min(members)
        keep = None if least[0] else least[1]
        out += [(None if m[0] else m[1], keep, len(members), digest) for m in members]
    return sorted(out, key=str)


LONG = "x" * 70
CASES = [
    (5, "a b"), (3, "a \n b"), (9, "a\t\x0b\x0c\rb"), (4, "a b "), (1, "ab"), (2, "a\x85b"), (6, "a\xa0b"),
    (7, None), (8, ""), (10, " "), (11, "\n\n"), (12, LONG + "1"), (13, LONG + "2"), (14, LONG + "1"), (15, "é" * 40), (16, "é" * 40),
    (3, "a b"), (None, "alone"), (None, "alone"), (None, "a b"), (20, "q" * 300_000), (21, "q" * 300_000), (22, "q" * 299_999 + "r"),
]


def test_groups_are_those_of_equal_texts(spark):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in CASES], "doc_id long, text string, digest string, row int")
    rows = exact.exact_groups(docs, every_digest=True).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.digest) for r in rows), key=str) == brute(CASES)
    kept = defaultdict(int)
    for r in rows:
        kept[r.digest] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}


def test_only_surviving_groups_are_hashed_in_full(spark):
    docs = spark.createDataFrame([(1, "one length"), (2, "two length"), (3, "alone"), (4, LONG + "1"), (5, LONG + "2"), (6, "one\nlength")], "doc_id long, text string")
    rows = {r.doc_id: r for r in exact.exact_groups(docs).collect()}
    assert rows[3].digest is None and rows[2].digest is None  # a length and a prefix that no other row has
    assert rows[4].digest and rows[5].digest and rows[4].digest != rows[5].digest  # told apart by the full hash alone
    assert rows[1].digest == rows[6].digest and rows[6].keep_id == 1 and not rows[6].kept
    assert all(rows[d].group_size == 1 and rows[d].kept for d in (2, 3, 4, 5))


@pytest.mark.parametrize("bits", [1, 1 << 27])
def test_slots_that_collide_lose_nothing(spark, monkeypatch, bits):
    monkeypatch.setattr(exact, "MOST_BITS", bits)
    made = [(i, f"text {i % 700} of some words") for i in range(1500)]
    rows = exact.exact_groups(spark.createDataFrame(made, "doc_id long, text string"), every_digest=True).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.digest) for r in rows), key=str) == brute(made)


def test_hot_groups_go_back_to_their_rows(spark, monkeypatch):
    monkeypatch.setattr(exact, "MOST_HOT", 8)
    made = [(i, "same" if i % 2 else f"pair {i // 6}") for i in range(400)]
    rows = exact.exact_groups(spark.createDataFrame(made, "doc_id long, text string"), every_digest=True).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.digest) for r in rows), key=str) == brute(made)


def test_keep_first_returns_whole_rows(spark):
    docs = spark.createDataFrame([(d, t, f"src{i}") for i, (d, t) in enumerate(CASES)], "doc_id long, text string, source string")
    rows = exact.keep_first(docs).collect()
    clean = [re.sub("[\x20\x09-\x0d]+", " ", r.text or "") for r in rows]
    assert len(clean) == len(set(clean)) == len({re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in CASES})
    named = {c: r.doc_id for c, r in zip(clean, rows)}
    assert named["a b"] == 3 and named[""] == 7 and named["alone"] is None and rows[0].source.startswith("src")
    assert exact.keep_first(docs.where("doc_id in (8, 15)")).columns == ["doc_id", "text", "source"]


def test_an_empty_table_has_no_groups(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact.exact_groups(docs).count() == 0 and exact.keep_first(docs).count() == 0


def test_one_row_and_null_texts(spark):
    docs = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [(r.keep_id, r.group_size, r.kept) for r in exact.exact_groups(docs).collect()] == [(1, 1, True)]

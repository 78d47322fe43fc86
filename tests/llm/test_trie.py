"""The prefix trie against a plain one: heavy nodes, many buckets, split ends, nulls, ties, repeats."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from tidelake.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, label string, key string"


def label(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, label(r or "", x or ""), (r or "", x or "")))
    own = {c: [x[3] for x in sorted(v)] for c, v in turns.items()}
    members = defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        path = own.get(c - c % 5, [])[:h] + own[c][h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append((c, d == len(path)))
    saved = {k: (len(v) - 1) * (len(k[-1][1].encode()) if k else 0) for k, v in members.items()}
    children = defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    leaves, sums = defaultdict(int), defaultdict(int)
    for k in members:
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            sums[k[:d]] += saved[k]
    out = []
    for k, v in members.items():
        ends = ",".join(str(c) for c, last in sorted(v) if last)
        parent = min(c for c, _ in members[k[:-1]]) if k else None
        out.append((min(v)[0], len(k), parent, len(v), children[k], leaves[k], sums[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed, convs=120, deep=7):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-20, 4 * convs), convs):
        for t in range(rng.randint(1, deep)):
            common = t == 0 and rng.random() < 0.6
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", "hello" if common else f"t{rng.randint(0, 2)}é"))
    rng.shuffle(rows)
    return rows


ODD = [(None, 1, "user", "x"), (5, None, None, None), (5, 1, None, "a"), (5, 1, "user", "b"), (5, 1, "user", "b"), (6, 0, "user", None), (7, 0, "user", "long " * 40_000), (8, 0, "user", "long " * 40_000), (10**12, 3, "s", "z")]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("most, least, bucket", [(trie.MOST_HEAVY, trie.LEAST_HEAVY, trie.BUCKET_NODES), (10**6, 1, 5), (10**6, 12, 30), (10**6, 0, 10)])
def test_nodes_are_those_of_the_plain_trie(spark, most, least, bucket):
    rows = made(most % 7 + least) + ODD
    turns = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    assert got(trie.prefix_trie(turns, most, least, bucket)) == brute(rows)


def test_a_node_that_many_tasks_end_at_is_hashed_in_order(spark, monkeypatch):
    rows = [(c, 0, "user", "same") for c in range(4000)] + [(c, 0, "user", f"other {c}") for c in range(4000, 4100)]
    monkeypatch.setattr(trie, "CHUNK", 500)
    ends = spark.createDataFrame([(bytes([c % 3 and 7] * 16), c) for c in range(-50, 5000)], "key binary, conv_id long").repartition(4)
    want = {bytes([k] * 16): hashlib.sha256(",".join(str(c) for c in range(-50, 5000) if (c % 3 and 7) == k).encode()).hexdigest() for k in (0, 7)}
    assert {bytes(r.key): r.ends_sha256 for r in trie.end_digests(ends).collect()} == want
    assert got(trie.prefix_trie(spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA), 10**6, 50, 20)) == brute(rows)


def test_louds_finds_parents_children_and_paths():
    rng = random.Random(3)
    names = [bytes([i // 250, i % 250 + 1] * 8) for i in range(300)]
    parents = [b"none" if i < 4 else names[rng.randrange(i)] for i in range(300)]
    built, place, ends = trie.Louds.of(np.array(names, "S16"), np.array(parents, "S16"))
    assert len(built.bits) == 2 * 300 + 1 and int(built.bits.sum()) == 300
    of = {n: i + 1 for i, n in enumerate(built.label.tolist())}
    strip = lambda b: b.rstrip(b"\0")
    for name, parent in zip(names, parents):
        assert built.parent[of[strip(name)]] == of.get(strip(parent), 0)
        assert of[strip(name)] in built.children(of.get(strip(parent), 0))
    assert [len(built.children(i)) for i in range(301)] == [sum(p == (b"none" if i == 0 else names[place[i - 1]]) for p in parents) for i in range(301)]
    path, at = [], names[299]
    while at != b"none":
        path.append(at)
        at = parents[names.index(at)]
    assert built.find(path[::-1]) == of[strip(names[299])] and built.find([*path[::-1], b"x" * 16]) is None
    values = np.arange(300)
    sums = built.rolled_up(values, ends)
    for i in range(300):
        below = [j for j in range(300) if i + 1 in ancestry(built, j + 1)]
        assert sums[i] == sum(values[j] for j in below)


def ancestry(built, node):
    while node:
        yield node
        node = int(built.parent[node])


def test_shard_tries_hold_every_light_node(spark):
    turns = spark.createDataFrame([(*r, "", "") for r in made(9)], SCHEMA)
    whole = trie.prefix_trie(turns, 10**6, 12, 30).count()
    rows = trie.shard_tries(turns, 10**6, 12, 30).collect()
    heavy = len(trie.heavy_nodes(trie.labelled_turns(turns), 10**6, 12))
    assert len(rows) > 1 and sum(len(r.labels) // 16 for r in rows) == whole - heavy == sum(len(r.n_convs) for r in rows)
    for r in rows:
        n = len(r.n_convs)
        assert np.unpackbits(np.frombuffer(r.louds, np.uint8))[: 2 * n + 1].sum() == n


def test_heavy_nodes_are_bounded(spark):
    turns = spark.createDataFrame([(*r, "", "") for r in made(2, 200)], SCHEMA)
    labelled = trie.labelled_turns(turns)
    for most in (5, 40, 200):
        assert len(trie.heavy_nodes(labelled, most, 0)) <= most + 1


def test_an_empty_table_has_no_nodes(spark):
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "u", "x", "", "")], SCHEMA)).count() == 0


def test_sql_says_the_same(spark):
    rows = [r for r in made(4, 60) + ODD if len(r[3] or "") < 1000]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted(con.execute(trie.SQL).fetchall(), key=str) == brute(rows)

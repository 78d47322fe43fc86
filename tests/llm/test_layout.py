"""Mixing, sharding, token files, media and chats."""

import hashlib
import io
import random
import tarfile
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelake.llm import chat, media, mixing, queries, rans, sharding, tokens
from tidelake.llm.shared import open_fs, scratch, table

LEAVES = "domain string, lang string, source string, tokens long"


def budgets(spark, leaves, mix):
    rows = mixing.leaf_budgets(spark.createDataFrame(leaves, LEAVES), mix).collect()
    return {(r.domain, r.lang, r.source): r.got for r in rows}


def test_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = [("a", "en", "x", 10), ("a", "en", "y", 1000), ("a", "de", "z", 1000), ("b", "en", "w", 1000)]
    got = budgets(spark, leaves, mixing.Mix(budget=400, max_epochs=1))
    # a has 200: en 100 and de 100; x can take 10, and its 40 short go to y
    assert got == {("a", "en", "x"): 10, ("a", "en", "y"): 90, ("a", "de", "z"): 100, ("b", "en", "w"): 200}
    got = budgets(spark, [("a", "en", "x", 10), ("a", "de", "z", 30), ("b", "en", "w", 1000)], mixing.Mix(budget=400, max_epochs=2))
    assert got == {("a", "en", "x"): 20, ("a", "de", "z"): 60, ("b", "en", "w"): 320}


@pytest.mark.parametrize("seed", range(4))
def test_budgets_add_up_and_follow_weights(spark, seed):
    rng = random.Random(seed)
    leaves = [(f"d{i}", f"l{j}", f"s{k}", rng.choice([0, 3, 50, 900, 10_000])) for i in range(3) for j in range(3) for k in range(rng.randint(1, 4))]
    mix = mixing.Mix(weights={"domain": {"d0": 5, "d1": 0}, "source": {"s1": 7, "s2": 0}}, budget=rng.randint(1, 9000), max_epochs=2)
    got = budgets(spark, leaves, mix)
    weight = {"s1": 7, "s2": 0}
    cap = {x[:3]: 0 if x[0] == "d1" or x[2] == "s2" else 2 * x[3] for x in leaves}
    assert sum(got.values()) == min(mix.budget, sum(cap.values()))
    assert all(0 <= got[k] <= cap[k] for k in got)
    for a in got:  # open siblings share by weight, to a token
        for b in got:
            if a[:2] == b[:2] and got[a] < cap[a] and got[b] < cap[b]:
                assert abs(got[a] / weight.get(a[2], 1) - got[b] / weight.get(b[2], 1)) <= 1


def test_mixture_takes_whole_epochs_and_a_prefix(spark):
    rows = [(i, "w " * (i % 5 + 1), "en" if i % 2 else None, "src1") for i in range(40)] + [(3, "w w", "en", "src1"), (None, None, "en", "src1"), (41, "", "en", "src2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    mix = mixing.Mix(budget=150, max_epochs=3)
    got = mixing.mixture(docs, mix, F.lit("d")).collect()
    for lang in ("en", ""):
        own = [r for r in got if r.lang == lang]
        assert 0 <= own[0].leaf_budget - sum(r.n_tokens for r in own) < 5 + 1
        last = max(r.epoch for r in own)
        whole = Counter(r.doc_id for r in own if r.epoch < last)
        assert not last or len(set(whole.values())) <= 2
    kept = mixing.mixed_documents(docs, mix, F.lit("d"))
    assert kept.columns == docs.columns and kept.count() == len(got)
    assert mixing.mixture(docs.limit(0), mix, F.lit("d")).count() == 0


def test_many_leaves_are_joined_on_a_salt(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "w " * (i % 4 + 1), "en", f"src{i % 3}") for i in range(60)], "doc_id long, text string, lang string, source string")
    mix = mixing.Mix(budget=100, max_epochs=2)
    one = sorted(map(str, mixing.mixture(docs, mix, F.lit("d")).collect()))
    monkeypatch.setattr(mixing, "MOST_BROADCAST", 0)
    assert one == sorted(map(str, mixing.mixture(docs, mix, F.lit("d")).collect()))


def test_hypergeometric_follows_its_law():
    rng = random.Random(0)
    draws = Counter(sharding.hypergeometric(rng, 6, 9, 5) for _ in range(20_000))
    from math import comb

    for k in range(6):
        assert abs(draws[k] / 20_000 - comb(6, k) * comb(9, 5 - k) / comb(15, 5)) < 0.012
    big = [sharding.hypergeometric(rng, 10**10, 23 * 10**10, 10**9) for _ in range(300)]
    assert abs(np.mean(big) - 10**9 / 24) < 3 * np.std(big) / 300**0.5 + 1


def test_matrix_has_its_margins():
    rows = [5, 0, 17, 100, 1]
    m = sharding.communication_matrix(rows, sharding.shard_sizes(sum(rows), 7), 1)
    assert [sum(r) for r in m] == rows and [sum(c) for c in zip(*m)] == sharding.shard_sizes(123, 7)


@pytest.mark.parametrize("n", [0, 1, 23, 500])
def test_shards_are_exact_and_gapless(spark, n):
    rows = [(i if i % 10 else None, None if i % 7 == 0 else "é" * (i % 3)) for i in range(n)] + [(1, "again"), (1, "again")] * (n > 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shuffled(docs, rows_per_partition=13).collect()
    assert len(got) == len(rows)
    sizes = Counter(r.shard for r in got)
    assert [sizes[s] for s in range(24)] == sharding.shard_sizes(len(rows), 24)
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    expect = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == expect
    assert sorted(map(str, got)) == sorted(map(str, sharding.shuffled(docs, rows_per_partition=13).collect()))


def test_shuffle_is_uniform(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    seen = np.zeros((300, 24))
    for seed in range(12):
        for r in sharding.shuffled(docs, seed=seed, rows_per_partition=20).collect():
            seen[r.doc_id, r.shard] += 1
    expect = 12 / 24
    assert abs(((seen - expect) ** 2 / expect).sum() / (300 * 23) - 1) < 0.1


def test_equal_rows_are_shuffled_like_any_other(spark):
    """Among 4,000 rows, 1,000 equal ones go to shards and slots uniformly, and a second run deals them alike."""
    docs = spark.range(4000).select(F.when(F.col("id") % 4 == 0, -1).otherwise(F.col("id")).alias("doc_id"), F.lit("x").alias("text")).repartition(5)
    docs = table(docs, "equal-rows-test")
    got = sharding.shuffled(docs, rows_per_partition=100).collect()
    assert sorted(map(str, got)) == sorted(map(str, sharding.shuffled(docs, rows_per_partition=100).collect()))
    assert sorted((r.shard, r.slot) for r in got) == [(s, i) for s, n in enumerate(sharding.shard_sizes(4000, 24)) for i in range(n)]
    equal = [r for r in got if r.doc_id == -1]
    by_shard = np.bincount([r.shard for r in equal], minlength=24)
    assert ((by_shard - 1000 / 24) ** 2 / (1000 / 24)).sum() < 50  # 23 degrees of freedom: 0.999 is at 49.7
    by_slot = np.bincount([r.slot * 8 // 167 for r in equal], minlength=8)
    assert ((by_slot - 125) ** 2 / 125).sum() < 25  # 7 degrees: 0.999 is at 24.3
    rank = lambda n: F.pmod(F.xxhash64(F.lit(1), F.col("row")), F.lit(n))
    parts = docs.withColumn("row", F.monotonically_increasing_id()).where("doc_id = -1").groupBy(rank(40)).count()
    assert parts.count() > 30 and parts.agg(F.max("count")).first()[0] < 60  # no window holds a group of equal rows


def test_one_hot_id_is_cut_along_its_own_order(spark, monkeypatch):
    rows = [(None, "w " * (i % 9 + 1) + f"x{i}", "en", "src1") for i in range(3000)] + [(5, "w w w", "en", "src2")] * 400
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    mix = mixing.Mix(budget=9000 + 301, max_epochs=1, weights={"source": {"src1": 100, "src2": 1}})
    seen = []
    monkeypatch.setattr(mixing, "table", lambda df, name: seen.append((name, table(df, name))) or seen[-1][1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        narrow = mixing.mixture(docs, mix, F.lit("d")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    near = next(df for name, df in seen if name == "mix-near")
    assert near.where("source = 'src1'").select("piece").distinct().count() > 2  # one id is in several ranges
    wide = mixing.mixed_documents(docs, mix, F.lit("d"))
    assert Counter((r.doc_id, r.source, r.n_tokens) for r in narrow) == Counter((r.doc_id, r.source, len(r.text.split())) for r in wide.collect())
    assert any(name == "mix-equal" for name, _ in seen)
    for source in ("src1", "src2"):
        own = [r for r in narrow if r.source == source]
        left = own[0].leaf_budget - sum(r.n_tokens for r in own)
        assert 0 <= left < 10 and (source == "src1" or left == own[0].leaf_budget % 3)
    tokens_in_order = sorted(r.n_tokens for r in narrow if r.source == "src1")  # an id's rows go by tokens first
    assert tokens_in_order == sorted(len(t.split()) for _, t, _, s in rows if s == "src1")[: len(tokens_in_order)]


def test_rans_round_trip_checkpoints_and_checksum():
    rng = np.random.default_rng(0)
    for n in (0, 1, rans.LANES, rans.LANES + 1, 3 * rans.LANES * rans.EVERY + 5):
        ids = (rng.zipf(1.3, n) % 5000).astype(np.uint32)
        table = rans.Frequencies.of_counts(np.bincount(ids, minlength=5000))
        block = rans.encode(ids, table)
        assert (rans.decode(block, table) == ids).all()
        step = rans.LANES * rans.EVERY
        for a in range(0, -(-n // step)):
            assert (rans.decode(block, table, a, a + 1) == ids[a * step : (a + 1) * step]).all()
    for at in (-1, -4000, -100_000):
        bad = bytearray(block)
        bad[at] ^= 1
        with pytest.raises((ValueError, IndexError)):
            rans.decode(bytes(bad), table)


def test_tokenizer_memo_equals_the_library():
    rng = random.Random(4)
    tok = tokens.Tokenizer(queries.tokenizer_path(), memo=50)
    parts = [" ", "  ", "\n", "\t", "a", "word", "1'2", "'s", "é", "漢字", ".", ",", "<|endoftext|>", " ", "\x1c", "B9"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    for a in range(0, 4000, 500):
        some = texts[a : a + 500]
        expect = [e.ids for e in tok.library.encode_batch(some, add_special_tokens=False)]
        assert [np.frombuffer(x, tok.kind).tolist() for x in tok.encode(some)] == expect


def test_token_files_round_trip(spark, monkeypatch):
    rows = [(7, "hello world", 1), (None, "no id", 2), (3, None, 3), (3, "", 4), (7, "again  \n x", 5), (2**60 + 1, "big " * 5000, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    got = tokens.tokenized(docs, queries.tokenizer_path(), 2).collect()
    tok = tokens.tokenizer(queries.tokenizer_path())
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, expect = 0, []
    for d, t, _ in order:
        ids = tok.library.encode(t or "", add_special_tokens=False).ids + [2]
        expect.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expect
    assert tokens.tokenized(docs.limit(0), queries.tokenizer_path(), 2).count() == 0


def test_segments_split_and_join():
    ids = np.arange(5000, dtype=np.uint32) % 70
    data = tokens.pack_segment([None, 4], [2000, 3000], ids, 70) + tokens.pack_segment([9], [1], ids[:1], 70)
    seen = [(d, n.tolist(), np.concatenate(list(b)).tolist()) for d, n, b in tokens.read_segments(io.BytesIO(data))]
    assert seen == [([None, 4], [2000, 3000], ids.tolist()), ([9], [1], [0])]


def test_media_columns_and_tar_shards(spark):
    rows = [(1, "abc", 1), (2, None, 2), (3, "", 3), (4, "é" * 200, 4), (5, "abc", 5), (5, "abc", 5), (None, "x" * 192, 6), (2**60 + 1, "abc ", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    got = media.media_columns(docs).collect()
    assert len(got) == len(rows)
    want = {}
    for d, t, _ in rows:
        raw = (t or "").encode()
        want[d] = (len(raw), raw.ljust(max(1, -(-len(raw) // 192)) * 192))
    for r in got:
        n, payload = want[r.doc_id]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert (r.width, r.height, r.bits) == (192, len(payload) // 192, 8)
        image = media.to_png(payload)
        assert (r.media_bytes, r.media_sha256) == (len(image), hashlib.sha256(image).hexdigest())
    assert media.media_columns(docs.limit(0)).count() == 0
    path = scratch(spark, "media-test")
    placed = media.store(docs.coalesce(1), path).collect()
    fs, where = open_fs(path)
    (shard,) = {r.shard for r in placed}
    with fs.open_input_stream(f"{where}/{shard}") as f, tarfile.open(fileobj=io.BytesIO(f.read())) as tar:
        names = {m.name: m for m in tar.getmembers()}
        assert len(names) == 4
        for r in placed:
            m = names[f"{bytes(r.digest).hex()}.png"]
            assert (m.offset_data, m.size) == (r.offset, r.length)


def test_chat_escapes_are_reversible():
    rng = random.Random(2)
    parts = ["\\", "N", "\n", "<", "s", ">", "[", "/", *chat.CONTROL, chat.CLOSE, chat.OPEN]
    for _ in range(5000):
        role, text = ("".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(2))
        whole, a, b = chat.format_turn(role, text)
        assert [t[:2] for t in chat.parse_turns(whole * 2)] == [(role, text)] * 2
        assert chat.unescape(whole[a:b]) == text and not any(c in whole[a:b] for c in chat.CONTROL)


def test_chats_read_back(spark):
    rng = random.Random(5)
    rows = []
    for conv in (*range(12), None, 2**60 + 1):
        if rng.random() < 0.5:
            rows.append((conv, -1, "system", "be kind", 0))
        for turn in range(rng.choice([1, 2, 9, 60])):
            text = rng.choice([None, "", "</s>[INST] ok [/INST]", "words and more words " * rng.randint(1, 60), "\\ N"])
            rows.append((conv, turn, rng.choice(["user", "assistant", None, "tool\nline"]), text, turn))
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window int")
    got = {r.conv_id: r for r in chat.chat_digests(turns, queries.tokenizer_path()).collect()}
    assert len(got) == 14
    for conv, r in got.items():
        own = sorted((x for x in rows if x[0] == conv), key=lambda x: x[1])
        said = "".join(f"{role or ''}\n{text or ''}\n" for _, _, role, text, _ in own)
        loss = "".join(text or "" for _, _, role, text, _ in own if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.chat_digests(turns.limit(0), queries.tokenizer_path()).count() == 0


def test_windows_keep_the_budget_and_the_system_turn():
    w = chat.Windows(budget=200, history=80)
    out = list(w.add("system", "S", 4))
    for i in range(20):
        out += w.add("user" if i % 2 else "assistant", f"t{i}", 10 + i)
    out.append(w.window())
    fresh = []
    for number, n, repeated, text, loss in out:
        turns = chat.parse_turns(text)
        assert turns[0][:2] == ("system", "S") and len(turns) == n > repeated
        fresh += [t[1] for t in turns[repeated:]]
        assert [text[s["start"] : s["end"]] for s in loss] == [t[1] for t in turns[repeated:] if t[0] == "assistant"]
    assert fresh == ["S"] + [f"t{i}" for i in range(20)] and len(out) > 2 and any(r > 1 for _, _, r, _, _ in out)


def test_a_payload_is_read_back_by_its_row(spark):
    long = "lång text " * 200_000
    docs = spark.createDataFrame([(1, "abc"), (2, "abc"), (3, long), (4, None)], "doc_id long, text string").repartition(4)
    rows = {r.doc_id: r for r in media.media_columns(docs).collect()}
    for d, text in ((1, "abc"), (3, long), (4, "")):
        r = rows[d]
        assert media.read_payload(r.folder, r.shard, r.offset, r.length) == media.payload_of(text)[0]
        assert r.length == r.media_bytes
    assert (rows[1].shard, rows[1].offset) == (rows[2].shard, rows[2].offset)


def test_the_average_hash_sees_rows_and_columns():
    dark, light = np.zeros((4, 192), np.uint8), np.full((4, 192), 200, np.uint8)
    hash_of = lambda x: media.feature_of(x).rpartition("hash=")[2]
    top, bottom = np.concatenate([light, dark]), np.concatenate([dark, light])
    assert hash_of(top) == "ffffffff00000000" and hash_of(bottom) == "00000000ffffffff"
    assert hash_of(np.concatenate([dark[:, :96], light[:, :96]], axis=1)) == "0f" * 8
    rows = np.random.default_rng(1).integers(0, 256, (20_000, 192)).astype(np.uint8)
    mean, var = (float(p.partition("=")[2]) for p in media.feature_of(rows).split(";")[:2])
    assert abs(mean - rows.mean()) < 1e-3 and abs(var - rows.astype(float).var()) < 1e-2


def test_spans_of_a_block_decode_from_checkpoints():
    rng = np.random.default_rng(5)
    ids = (rng.zipf(1.3, 3 * rans.INTERVAL + 777) % 5000).astype(np.uint32)
    table = rans.Frequencies.of_counts(np.bincount(ids, minlength=5000))
    block = rans.encode(ids, table)
    for a, b in [(0, 1), (5, rans.INTERVAL), (rans.INTERVAL - 1, rans.INTERVAL + 1), (2 * rans.INTERVAL + 9, len(ids)), (7, len(ids)), (9, 9)]:
        assert (rans.decode_span(block, table, a, b) == ids[a:b]).all()
    bad = bytearray(block)
    bad[-1] ^= 1
    with pytest.raises((ValueError, IndexError)):
        rans.decode_span(bytes(bad), table, 2 * rans.INTERVAL + 9, len(ids))  # its last word


def test_units_of_a_segment_are_read_on_their_own():
    rng = np.random.default_rng(6)
    lengths = [*rng.integers(1, 900, 3000).tolist(), tokens.BLOCK + 5, 1, 1, 40_000]
    ids = rng.integers(0, 300, sum(lengths)).astype(np.uint32)
    data = b"before" + tokens.pack_segment(list(range(len(lengths))), lengths, ids, 300)
    units = tokens.units_of(lengths, 200_000)
    assert len(units) > 5 and units[0][0] == 0 and units[-1][1] == len(lengths) and all(x[1] == y[0] for x, y in zip(units, units[1:]))
    ends = np.cumsum(lengths)
    for first, last, n in units:
        docs, own, pieces = tokens.read_unit(io.BytesIO(data), 6, first, last)
        assert docs == list(range(first, last)) and own.tolist() == lengths[first:last] and n == sum(own)
        assert (np.concatenate(list(pieces)) == ids[ends[first] - lengths[first] : ends[last - 1]]).all()


def test_one_file_is_decoded_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(tokens, "UNIT", 2000)
    rows = [(i // 40 if i < 80 else i, f"word{i % 17} more words " * (i % 30 + 1)) for i in range(300)] + [(0, "same")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = scratch(spark, "tokens-test")
    manifest = tokens.write_tokens(docs, path, queries.tokenizer_path(), 2)
    units = manifest.collect()
    assert len(units) > len({u.file for u in units}) and max(u.n_tokens for u in units) < 4000
    read = tokens.read_tokens(manifest, path)
    got = sorted(map(tuple, read.collect()), key=lambda r: r[1])
    tok, start, expect = tokens.tokenizer(queries.tokenizer_path()), 0, []
    hashed = {r.t: r.h for r in spark.createDataFrame([(t,) for _, t in rows], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    for d, t in sorted(rows, key=lambda r: (r[0], hashed[r[1]])):
        ids = tok.library.encode(t, add_special_tokens=False).ids + [2]
        expect.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == expect
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = lambda some: tokens._in_order(some).groupBy(F.spark_partition_id().alias("task")).count().collect()
        hot, equal = tasks(docs.where("doc_id = 0")), tasks(spark.range(2000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("a common start " * 9).alias("text")))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(hot) > 1  # a frequent id is not one task's
    assert len(equal) > 2 and max(r["count"] for r in equal) < 1000  # nor are equal rows


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    rows = [(None, f"w{i} x", "en", "src1", i, "row", 0.5) for i in range(6)] + [(1, "a " * 200_000, "de", "src2", 9, "row", 0.5)]
    kind = "doc_id long, text string, lang string, source string, n_tokens int, row string, domain double"
    seen = set()
    for some in (rows, rows[::-1], rows[3:] + rows[:3]):
        docs = spark.createDataFrame(some, kind)
        mix = mixing.Mix(budget=14, max_epochs=1)
        kept = mixing.mixed_documents(docs, mix, F.lit("d"))
        assert kept.columns == docs.columns
        seen.add(tuple(sorted(r.n_tokens for r in kept.collect())))
    assert len(seen) == 1 and len(next(iter(seen))) == 3


def test_shards_take_long_texts_and_clashing_columns(spark):
    rows = [(i, "é" * (1_000_000 if i == 3 else i), 7, "x", 1) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int, place string, part int")
    got = {r.doc_id: r for r in sharding.shuffled(docs).collect()}
    assert len(got) == 30 and got[3].size == 2_000_008 and {r.shard for r in got.values()} == set(range(24))


def test_words_are_encoded_once_whatever_stands_beside_them():
    tok = tokens.Tokenizer(queries.tokenizer_path())
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(9)) for _ in range(300)]
    after = [".", ",", ".\nAs", "***", "!!", "|", "'s", ")", ";\nHe", "\n\n x", " 7,"]
    texts = ["".join(f" {w}{rng.choice(after)}" for w in rng.choices(words, k=200)) for _ in range(100)]
    expect = [e.ids for e in tok.library.encode_batch(texts, add_special_tokens=False)]

    class Counting:
        seen = 0

        def encode_batch_fast(self, some, **how):
            self.seen += sum(map(len, some))
            return library.encode_batch_fast(some, **how)

    library, tok.library = tok.library, Counting()
    assert [np.frombuffer(x, tok.kind).tolist() for x in tok.encode(texts)] == expect
    assert tok.library.seen < 2 * sum(len(" " + w) for w in words)  # not once for each sign that follows them


def test_pieces_end_only_where_the_tokenizer_cuts():
    rng = random.Random(10)
    wide = [chr(c) for c in (0x85, 0xA0, 0xAA, 0xB2, 0xD7, 0xF7, 0x120, 0x301, 0x435, 0x482, 0x1680, 0x180E, 0x2003, 0x2019, 0x2028, 0x202F, 0x205F, 0x2167, 0x3000, 0x6F22, 0xFEFF, 0x1F600)]
    parts = [" ", " ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x7f", "\0", "'", "'s", "'ll", "a", "é", "B", "1", ".", "(", "<|endoftext|>", "<|", "x" * 300, *wide]
    for plain in (False, True):
        tok = tokens.Tokenizer(queries.tokenizer_path(), memo=400, plain=plain)
        for _ in range(20):
            some = rng.choices(parts, k=5) if rng.random() < 0.7 else parts
            texts = ["".join(rng.choices([" ", *some], k=rng.randint(0, 9))) for _ in range(500)]
            expect = [e.ids for e in tok.library.encode_batch(texts, add_special_tokens=False)]
            assert [np.frombuffer(x, tok.kind).tolist() for x in tok.encode(texts)] == expect

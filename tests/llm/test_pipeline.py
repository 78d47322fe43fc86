from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_chain_and_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).toPandas(), docs.schema)
        assert docs.columns == columns
        assert docs.count() <= before or name == "mixing"
        before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(last) == before
    rows = sorted(last, key=lambda r: r.start)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))


def test_five_operators_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_ids"]


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def plain_groups(docs):
    """Smallest id of each component of texts whose shingle sets agree to 0.8."""
    sets = {d: shingles(t or "") for d, t in docs.items()}
    root = {d: d for d in docs}

    def find(d):
        return d if root[d] == d else find(root[d])

    for a in docs:
        for b in docs:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {find(d) for d in docs}


def test_run_equals_brute_force_stage_by_stage(spark, tmp_path, monkeypatch):
    import random
    import zlib

    import duckdb
    import numpy as np

    from tidelake.llm import mixing, queries, shared, tokens
    from test_decontaminate import brute

    rng = random.Random(3)
    plain = [f"{a}{b}" for a in "bdfgklm" for b in ("ano", "eri", "ilo", "uma", "ost")]
    foul = ["scumtrash", "vilefool", "hatefilth"]
    say = lambda n, extra=(): " ".join(rng.choice(plain) if not extra or rng.random() < 0.7 else rng.choice(extra) for _ in range(n))
    item = " ".join(f"exam{rng.randint(0, 99)}" for _ in range(40))
    rows, toxic = [], {}
    for i in range(240):
        bad = i % 4 == 0
        rows.append([i, say(60, foul if bad else ()), "en" if i % 3 else "de", f"src{i % 5}"])
        toxic[i] = int(bad)
    base = {r[0]: r[1] for r in rows}
    for i in range(240, 260):  # near and exact copies of clean documents
        words = base[i - 239 if (i - 239) % 4 else i - 238].split()
        if i % 2:
            words[30] = "changed"
        rows.append([i, " ".join(words), "en", "src1"])
    rows.append([260, say(50) + " " + " ".join(item.split()[5:25]), "en", "src2"])  # contaminated
    rows.append([261, None, None, None])
    rows.append([262, "", "en", "src2"])
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, t) for i, t in toxic.items()], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([("q", item)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    seen = {}
    stages = [(name, (lambda s, d, p, f=f, n=name: seen.setdefault(n, f(s, d, p)))) for name, f in corpus_pipeline.STAGES]
    dropped = []
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    monkeypatch.setattr(corpus_pipeline, "drop_path", lambda s, p: dropped.append(p))
    paths = []
    monkeypatch.setattr(corpus_pipeline, "product", lambda s, n: paths.append(shared.product(s, n)) or paths[-1])
    out = corpus_pipeline.run(spark, str(tmp_path))
    kept = [spark.read.parquet(p) for p in paths[:-1]]
    texts = [{r.doc_id: r.text for r in k.collect()} for k in kept]
    assert dropped == paths[:-1] and all(k.columns == docs.columns for k in kept)
    clean = {i for i in range(263) if not toxic.get(i)}
    assert set(texts[0]) == clean
    assert set(texts[1]) == plain_groups(texts[0])
    assert set(texts[2]) == {i for i, t in texts[1].items() if not (lambda n, hit, _: hit and 20 * hit >= n)(*brute(t, [("q", item)]))} and 260 not in texts[2]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{paths[2]}/*.parquet')")
    expect = sorted(r[0] for r in con.execute(f"SELECT doc_id FROM ({mixing.mixture_sql()})").fetchall())
    assert sorted(r.doc_id for r in kept[3].select("doc_id").collect()) == expect and expect
    tok, start, want = tokens.tokenizer(queries.tokenizer_path()), 0, []
    for d in expect:
        ids = tok.library.encode(texts[3][d] or "", add_special_tokens=False).ids + [2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, out.collect()), key=lambda r: r[1]) == want


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0

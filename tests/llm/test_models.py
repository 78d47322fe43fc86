"""Toxicity, quality and language: held-out accuracy and edge cases."""

import numpy as np
import pytest

from tidelake.llm import langid, quality, queries, toxicity
from tidelake.llm.labelled import remainder
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.1"


def accuracy(spark, scored, target):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").select("predicted", target).toPandas()
    hit = rows["predicted"] == rows[target]
    return hit.mean(), hit[rows[target] == (1 if target == "toxic" else 0)].mean()


def test_toxicity_on_held_out_rows(spark):
    whole, toxic = accuracy(spark, queries.op2_toxicity(spark, SF), "toxic")
    assert whole > 0.97 and toxic > 0.75


def test_quality_on_held_out_rows(spark):
    whole, low = accuracy(spark, queries.op7_quality(spark, SF), "quality")
    assert whole > 0.98 and low > 0.95


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = queries.op8_language_id(spark, SF).where("held_out").join(docs, "doc_id")
    assert rows.where("lang = lang_pred").count() / rows.count() > 0.98


def test_folds_are_of_the_id_as_text(spark):
    import zlib

    rows = spark.range(50).select("id", remainder(F.col("id"), 5).alias("r")).collect()
    assert all(r.r == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


@pytest.fixture()
def odd(spark):
    rows = [(1, None, "en", 5), (2, "", "en", 6), (3, "1234 !!", None, 7), (3, "1234 !!", None, 7), (None, "plain words here", "de", 8), (4, "word " * 30000, "en", 9)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")


LABELS = "doc_id long, toxic int, quality int"


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(1, 1, 1), (2, 0, 0), (4, 1, None), (4, 0, 0), (None, 1, 1), (77, None, 3)]])
def test_scores_are_defined_for_every_row(spark, odd, labels):
    known = spark.createDataFrame(labels, LABELS)
    for scored in (toxicity.toxicity(odd, known), quality.quality(odd, known)):
        rows = scored.collect()
        assert len(rows) == 6
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    empty = spark.createDataFrame([], odd.schema)
    assert toxicity.toxicity(empty, known).count() == quality.quality(empty, known).count() == 0
    assert toxicity.keep_clean(odd, known).columns == odd.columns


def test_languages_are_defined_for_every_row(spark, odd):
    rows = {(r.doc_id, r.lang_pred) for r in langid.language_id(odd).collect()}
    assert (1, "und") in rows and (3, "und") in rows and (2, "und") in rows
    assert langid.language_id(spark.createDataFrame([], odd.schema)).count() == 0


def brute_rank(text, known, top):
    import re

    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    letters = " " + re.sub(" +", " ", letters).strip() + " "
    counts = {}
    for n in (1, 2, 3):
        for i in range(len(letters) - n + 1):
            g = letters[i : i + n]
            if g != " ":
                counts[g] = counts.get(g, 0) + 1
    code = lambda g: sum(ord(c) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g))
    own = sorted(counts, key=lambda g: (-counts[g], code(g)))[:top]
    out = {}
    for lang, profile in known.items():
        place = {g: i for i, g in enumerate(profile)}
        out[lang] = sum(abs(i - place[code(g)]) if code(g) in place else top for i, g in enumerate(own))
    return out


def test_distance_is_the_out_of_place_measure():
    known = {"a": langid.top_grams("the cat sat on the mat and the dog", 50).tolist(), "b": langid.top_grams("der hund und die katze sind da", 50).tolist()}
    ranker = langid.Ranker(known, 50)
    for text in ("the dog", "die katze!", "zzz 9 qq", "Ünder the É"):
        expect = brute_rank(text, known, 50)
        lang, score = ranker.best(text)
        assert lang == min(sorted(expect), key=expect.get)
        assert score == pytest.approx(1 - expect[lang] / (50 * min(50, len(langid.top_grams(text, 50)))))


def test_l1_leaves_few_weights():
    rng = np.random.default_rng(0)
    rows = []
    for i in range(400):
        at = np.unique(rng.integers(0, 1 << 12, 60))
        label = i % 2
        rows.append((np.union1d(at[at > 3], [label]), label))
    at, w, _ = toxicity.train(rows, toxicity.Ftrl(bits=12))
    weights = dict(zip(at.tolist(), w))
    assert weights[1] > 0 > weights.get(0, -1) and len(at) < 60


def test_rules_as_columns_equal_rules_as_arrays(spark):
    rng = np.random.default_rng(1)
    x = rng.random((300, len(quality.STATISTICS)))
    y = ((x[:, 0] > 0.4) & (x[:, 3] <= 0.7)).astype(int)
    rules, b = quality.fit_rules(x, y)
    assert rules and all(1 <= len(r.terms) <= 3 for r in rules)
    frame = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{s} double" for s in quality.STATISTICS))
    got = [r[0] for r in frame.select(quality.score_column(F.struct("*"), rules, b)).collect()]
    expect = 1 / (1 + np.exp(-(b + sum(r.weight * r.holds(x) for r in rules))))
    assert np.allclose(got, expect) and ((expect > 0.5) == y).mean() > 0.97


def plain_ftrl(rows, p, seed=7):
    """FTRL-proximal coordinate by coordinate, as its update rule is written."""
    z, n = {}, {}
    rng = np.random.default_rng(seed)

    def weight(i, l1):
        zi, ni = z.get(i, 0.0), n.get(i, 0.0)
        if abs(zi) <= l1:
            return 0.0
        return -(zi - (l1 if zi > 0 else -l1)) / ((p.beta + ni**0.5) / p.alpha + p.l2)

    for _ in range(p.epochs):
        for k in rng.permutation(len(rows)):
            at, label = rows[k]
            w = {i: weight(i, p.l1) for i in at} | {"bias": weight("bias", 0.0)}
            score = 1 / (1 + np.exp(-sum(w.values())))
            for i in w:
                g = score - label
                sigma = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / p.alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: w for i in z if i != "bias" and (w := weight(i, p.l1))}, weight("bias", 0.0)


def test_training_is_ftrl_coordinate_by_coordinate():
    rng = np.random.default_rng(8)
    rows = [(np.unique(np.append(rng.integers(2, 300, 12), i % 2)), int((i % 2) ^ (rng.random() < 0.1))) for i in range(150)]
    p = toxicity.Ftrl(bits=9, l1=0.6, epochs=3)
    at, w, bias = toxicity.train(rows, p)
    expect, b = plain_ftrl([([int(i) for i in a], y) for a, y in rows], p)
    assert dict(zip(at.tolist(), w)) == pytest.approx(expect, abs=1e-9) and bias == pytest.approx(b)
    assert 0 < len(at) < 300


def test_lasso_meets_its_conditions_and_a_plain_solver():
    rng = np.random.default_rng(4)
    a = (rng.random((400, 12)) < 0.4).astype(float)
    y = (1 / (1 + np.exp(-(2 * a[:, 0] - 3 * a[:, 1] + 0.3))) > rng.random(400)).astype(float)
    w, b = quality.lasso(a, y, 0.01, rounds=6000)
    e = 1 / (1 + np.exp(-(a @ w + b))) - y
    slope = a.T @ e / len(y)
    assert abs(e.mean()) < 1e-6
    assert all(abs(s + 0.01 * np.sign(v)) < 1e-5 if v else abs(s) <= 0.01 + 1e-6 for s, v in zip(slope, w))
    pw, pb = np.zeros(12), 0.0
    for _ in range(40_000):  # proximal gradient, no momentum
        e = 1 / (1 + np.exp(-(a @ pw + pb))) - y
        new = pw - 0.3 * (a.T @ e / len(y))
        pw, pb = np.sign(new) * np.maximum(np.abs(new) - 0.3 * 0.01, 0), pb - 0.3 * e.mean()
    assert np.allclose(w, pw, atol=1e-4) and abs(b - pb) < 1e-4


def test_a_trees_first_cut_is_the_best_one():
    rng = np.random.default_rng(2)
    x = rng.random((200, 3))
    y = (x[:, 1] > 0.63).astype(float)
    cuts = [np.linspace(0.05, 0.95, 40)] * 3
    g, h = 0.5 - y, np.full(200, 0.25)
    found = []
    quality._tree(x, g, h, 1, (), cuts, 5, np.arange(3), found, np.arange(200))
    gain = {(i, c): sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (x[:, i] > c, x[:, i] <= c)) for i in range(3) for c in cuts[i] if 5 <= (x[:, i] > c).sum() <= 195}
    i, c = max(gain, key=gain.get)
    assert {r.terms for r in found} == {((i, True, c),), ((i, False, c),)}


def test_a_repeated_labelled_id_is_drawn_once(spark):
    from tidelake.llm.labelled import sample

    rows = [(1, "hot id", 0)] * 3000 + [(1, "hot id again", 0)] * 10 + [(i, f"text {i}", 1) for i in range(2, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 12)], "doc_id long, toxic int")
    got = sample(docs, labels, "toxic", F.lit(True), 5, "doc_id", "text").collect()
    assert len(got) == 10 and len({r["__id"] for r in got}) == 10

"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the different words, their stems (first 4 to 7 bytes, so that inflected
forms share weights), word pairs and pairs with one or two words skipped of a whole text,
hashed into ``2 ** bits`` coordinates.  Training is sequential, as FTRL
is, over a bounded sample (``most`` documents of each class) in one task, and the bias is
corrected for the rates at which the classes are drawn; its L1 term
leaves few weights, which are collected and broadcast (at most ``2 ** bits`` pairs).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.labelled import excess, remainder, sample
from tidelake.llm.shared import give_back
from tidelake.llm.words import words

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEPS = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93))
STEMS = (4, 5, 6, 7)
#: A score of 0.5 or more is a prediction of 1.
THRESHOLD = 0.5


@dataclass(frozen=True)
class Ftrl:
    """Per-coordinate rates alpha / (beta + sqrt(sum of squared gradients)), L1 and L2 terms."""

    bits: int = 20
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 1.0
    epochs: int = 6


def coordinates(text: str | None, bits: int) -> np.ndarray:
    """Hashed coordinates of a text's words, stems, pairs and skip-pairs, repeats included."""
    found = words(text)
    h = np.fromiter(map(zlib.crc32, found), np.uint64, len(found)) * _MIX
    stems = [np.fromiter((zlib.crc32(w[:k]) for w in found), np.uint64, len(found)) * _MIX + np.uint64(k) for k in STEMS]
    parts = [h, *stems] + [h[:-gap] * step + h[gap:] for gap, step in zip((1, 2, 3), _STEPS) if len(h) > gap]
    return ((np.concatenate(parts) * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


def train(rows: list[tuple[np.ndarray, int]], p: Ftrl, seed: int = 7) -> tuple[np.ndarray, np.ndarray, float]:
    """Nonzero coordinates, their weights, and the bias. rows: unique coordinates and label."""
    z, n = np.zeros(1 << p.bits), np.zeros(1 << p.bits)
    bz = bn = 0.0

    def weight(zi, ni, l1):
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((p.beta + np.sqrt(ni)) / p.alpha + p.l2))

    rng = np.random.default_rng(seed)
    for _ in range(p.epochs):
        for i in rng.permutation(len(rows)):
            at, label = rows[i]
            zi, ni = z[at], n[at]
            w = weight(zi, ni, p.l1)
            b = -bz / ((p.beta + bn**0.5) / p.alpha + p.l2)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35))) - label
            root = np.sqrt(ni + g * g)
            z[at] = zi + g - (root - np.sqrt(ni)) / p.alpha * w
            n[at] = ni + g * g
            bz += g - ((bn + g * g) ** 0.5 - bn**0.5) / p.alpha * b
            bn += g * g
    w = weight(z, n, p.l1)
    at = np.flatnonzero(w)
    return at, w[at], float(-bz / ((p.beta + bn**0.5) / p.alpha + p.l2))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, target: str = "toxic", p: Ftrl | None = None, most: int = 6000, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray, float]:
    """A model from a bounded sample.  With no labelled rows of one class, the score is constant."""
    p = p or Ftrl()

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at = [np.unique(coordinates(t, p.bits)).astype(np.int32).tobytes() for t in pdf["text"]]
            yield pd.DataFrame({"id": pdf["__id"], "at": at, "label": pdf["label"]})
        give_back()

    def trained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [(i, np.frombuffer(a, np.int32), int(y)) for pdf in batches for i, a, y in zip(pdf["id"], pdf["at"], pdf["label"])]
        rows = [r[1:] for r in sorted(rows, key=lambda r: (r[0], r[1].tobytes()))]
        ones = sum(y for _, y in rows)
        if 0 < ones < len(rows):
            at, w, bias = train(rows, p)
            bias -= over
        else:
            at, w, bias = np.array([], np.int64), np.array([]), 4.0 if ones else -4.0
        yield pd.DataFrame({"at": np.append(at, -1), "w": np.append(w, bias)})
        del rows
        give_back()

    over = excess(labels, target, learn, most, id_col)
    chosen = sample(docs, labels, target, learn, most, id_col, text_col)
    kind = f"id {chosen.schema['__id'].dataType.simpleString()}, at binary, label int"
    model = chosen.mapInPandas(featured, kind).repartition(1).mapInPandas(trained, "at long, w double").toPandas()
    if model.empty:
        return np.array([], np.int64), np.array([]), -4.0
    bias = model["at"] < 0
    return model.loc[~bias, "at"].to_numpy(), model.loc[~bias, "w"].to_numpy(), float(model.loc[bias, "w"].iloc[0])


def scorer(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], bits: int = Ftrl.bits):
    """A pandas UDF from text to the probability of label 1."""
    sent = docs.sparkSession.sparkContext.broadcast((model[0].astype(np.int32), model[1].astype(np.float32), model[2]))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at, w, bias = sent.value
        dense = np.zeros(1 << bits, np.float32)
        dense[at] = w
        live = dense != 0
        for texts in batches:
            out = np.empty(len(texts))
            for i, text in enumerate(texts):
                c = coordinates(text, bits)
                c = np.unique(c[live[c]])
                out[i] = dense[c].sum(dtype=np.float64) + bias
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -35, 35))))
        give_back()

    return score


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    Null and empty texts have no features and score as the bias does; long texts are read
    whole.  Repeated rows are each scored, equal texts alike; other columns of docs are not read.  A null id belongs to the fold of the empty text.  An
    empty table gives no rows; without labels of both classes the score is constant.
    """
    model = fit(docs, labels, remainder(F.col(id_col), folds) != held, id_col=id_col, text_col=text_col)
    score = scorer(docs, model)
    scored = docs.select(F.col(id_col).alias("doc_id"), (remainder(F.col(id_col), folds) == held).alias("held_out"), score(F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose text scores below the threshold, with all their columns."""
    model = fit(docs, labels, remainder(F.col(id_col), folds) != held, id_col=id_col, text_col=text_col)
    return docs.where(scorer(docs, model)(F.col(text_col)) < THRESHOLD)

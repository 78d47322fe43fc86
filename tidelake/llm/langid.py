"""Language identification by rank-order profiles of character n-grams.

A profile is the ``top`` most frequent 1- to 3-grams of a language, in order.  A text's
own most frequent n-grams are ranked the same way; the out-of-place distance to a
language is the sum of rank differences, ``top`` for an n-gram its profile lacks.
Letters are lower-cased, every run of other characters is one space.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.labelled import remainder
from tidelake.llm.shared import give_back, text_batches

TOP = 400
UNDETERMINED = "und"


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes of a text's 1- to 3-grams (21 bits a character), ascending, and their counts."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    letter = _letters()[code]
    if not letter.any():
        return np.array([], np.uint64), np.array([], np.int64)
    code = np.where(letter, code, np.uint64(32))
    code = np.concatenate(([32], code[letter | np.append(True, letter[:-1])], [32])).astype(np.uint64)
    code = code[np.append(True, (code[1:] != 32) | (code[:-1] != 32))]
    one, two = code[code != 32], (code[:-1] << np.uint64(21)) | code[1:]
    three = (two[:-1] << np.uint64(21)) | code[2:]
    return np.unique(np.concatenate((one, two, three)), return_counts=True)


def top_grams(text: str | None, top: int = TOP) -> np.ndarray:
    """The most frequent n-grams' codes in order; ties by code."""
    codes, counts = grams(text)
    return codes[np.argsort(-counts, kind="stable")[:top]]


def profiles(docs: DataFrame, lang_col: str, learn: Column, id_col: str, text_col: str, most: int = 3000, top: int = TOP, seed: int = 23) -> dict[str, list[int]]:
    """Profiles of all languages, from about ``most`` documents of each, chosen by a hash of id and text.

    Many documents of one id are drawn like any others; rows that repeat are drawn together.
    The result holds at most ``top`` codes a language.
    """
    known = docs.where(learn & F.col(lang_col).isNotNull())
    share = known.groupBy(F.col(lang_col).alias("__lang")).agg(F.least(F.lit(1.0), F.lit(float(most)) / F.count("*")).alias("__share"))
    share = share.collect()  # a row for each language
    if not share:
        return {}
    of_lang = F.element_at(F.create_map(*(F.lit(x) for r in share for x in (r["__lang"], r["__share"]))), F.col(lang_col))
    spread = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed)), F.lit(1 << 20)) / F.lit(float(1 << 20))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, texts in pdf.groupby("lang")["text"]:
                codes, counts = zip(*(grams(t) for t in texts))
                codes, at = np.unique(np.concatenate(codes), return_inverse=True)
                yield pd.DataFrame({"lang": lang, "gram": codes.astype(np.int64), "n": np.bincount(at, np.concatenate(counts), len(codes)).astype(np.int64)})

    counts = known.where(spread < of_lang).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInPandas(counted, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counts.withColumn("place", place).where(F.col("place") <= top).toPandas()
    return {lang: part.sort_values("place")["gram"].tolist() for lang, part in best.groupby("lang")}


class Ranker:
    """Out-of-place distances of a text to a set of profiles."""

    def __init__(self, known: dict[str, list[int]], top: int = TOP) -> None:
        self.top, self.langs = top, sorted(known)
        self.codes = np.unique(np.array([c for p in known.values() for c in p], np.uint64))
        self.places = np.full((len(self.langs), len(self.codes)), -1, np.int64)
        for i, lang in enumerate(self.langs):
            self.places[i, np.searchsorted(self.codes, np.array(known[lang], np.uint64))] = np.arange(len(known[lang]))

    def best(self, text: str | None) -> tuple[str, float]:
        """The nearest language, ties by name, and 1 minus its share of the largest distance."""
        own = top_grams(text, self.top)
        if not len(own) or not self.langs:
            return UNDETERMINED, 0.0
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        there = np.flatnonzero(self.codes[at] == own)
        places = self.places[:, at[there]]
        apart = np.where(places < 0, self.top, np.abs(places - there)).sum(axis=1) + self.top * (len(own) - len(there))
        i = int(apart.argmin())
        return self.langs[i], 1.0 - float(apart[i]) / (self.top * len(own))


def language_id(docs: DataFrame, folds: int = 3, held: int = 1, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", most: int = 3000, top: int = TOP) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of docs.

    Null texts and texts without letters are ``und`` with score 0, as are all texts where
    no row with a language may be learned from.  Long texts are read whole.  Repeated rows
    are each returned, other columns are not; an empty table gives no rows.
    """
    text_batches(docs.sparkSession)
    known = profiles(docs, lang_col, remainder(F.col(id_col), folds) != held, id_col, text_col, most, top)
    sent = docs.sparkSession.sparkContext.broadcast(known)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ranker = Ranker(sent.value, top)
        for texts in batches:
            yield pd.DataFrame([ranker.best(t) for t in texts], columns=["lang_pred", "score"])
        give_back()

    out = docs.select(F.col(id_col).alias("doc_id"), (remainder(F.col(id_col), folds) == held).alias("held_out"), predict(F.col(text_col)).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")

"""Bounded samples of labelled documents, and the split into learning and held-out rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.shared import text_batches


def remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def _known(labels: DataFrame, target: str, learn: Column, id_col: str) -> DataFrame:
    return labels.where(learn & F.col(target).isin(0, 1)).groupBy(F.col(id_col).alias("__id")).agg(F.max(target).alias("label"))


def excess(labels: DataFrame, target: str, learn: Column, most: int, id_col: str) -> float:
    """Log of the ratio at which ``sample`` draws class 1 rather than class 0.

    A model of the sample has so much too large an intercept for all labelled documents.
    """
    n = dict(_known(labels, target, learn, id_col).groupBy("label").count().collect())
    rate = lambda k: min(1.0, most / n[k]) if n.get(k) else 1.0
    return math.log(rate(1) / rate(0))


def sample(docs: DataFrame, labels: DataFrame, target: str, learn: Column, most: int, id_col: str, text_col: str, seed: int = 17) -> DataFrame:
    """(text, label) of at most ``most`` documents of each class, in a seeded order of ids.

    labels: id_col and target (0 or 1; null and other values are ignored; a repeated id
    counts once, with its largest label).  learn: a condition on the id column.  Only ids
    are ranked; the chosen ids (at most 2 * most) are broadcast to the scan of the texts.
    Of several documents of one id one is drawn, by a hash of its text.
    """
    text_batches(docs.sparkSession)
    known = _known(labels, target, learn, id_col)
    order = F.xxhash64("__id", F.lit(seed))
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("label") == label).orderBy(order, "__id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    drawn = texts.join(F.broadcast(chosen), "__id").select("__id", "text", "label")
    if drawn.groupBy("__id").count().where("count > 1").isEmpty():  # texts are grouped only where ids repeat
        return drawn
    one = F.min_by("text", F.struct(F.xxhash64("text", F.lit(seed)), "text")).alias("text")
    return drawn.groupBy("__id", "label").agg(one).select("__id", "text", "label")

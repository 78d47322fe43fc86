"""The corpus pipeline: toxicity, near-duplicates, decontamination, mixing, token files.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and is
written as Parquet and reread before the next.  All but the last return the columns of
documents, whatever further columns these have.

In every stage a null text is an empty one and a long text is read whole; a row that is
there several times is judged as often, and near-duplicates keep one of it.  Rows with
null ids, sources or languages stay in as any other.  An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm import decontaminate, mixing, similar, tokens, toxicity
from tidelake.llm.queries import END_ID, tokenizer_path
from tidelake.llm.shared import drop_path, product, scratch_space


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on labelled rows of docs, does not reject."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each component of texts whose 5-word shingles agree to 0.8 or more.

    Candidates are the components of the SimHash operator and, as far as 0.8 is beyond its 64 bits, MinHash bands.
    """
    return similar.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than a twentieth of their words inside benchmark phrases."""
    return decontaminate.keep_uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture at the production weights; a document is there once for each epoch it is in."""
    return mixing.mixed_documents(docs, mixing.PRODUCTION, mixing.domain_of_source(F.col("source")))


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixture in id order, and each document's place in them."""
    return tokens.tokenized(docs, tokenizer_path(), END_ID)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_ids", write_token_files),
]

#: Trained weights and token ids are beyond SQL; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; a stage's scratch tables go once it is written, its own table once the next is."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = product(spark, f"stage-{name}")
        with scratch_space(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before:
            drop_path(spark, before)
        before = path
    return docs

"""The registered queries of the training-data operators, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm import decontaminate, exact, trie
from tidelake.llm.alignment import alignment
from tidelake.llm.chat import chat_digests
from tidelake.llm.langid import language_id
from tidelake.llm.media import media_columns
from tidelake.llm.mixing import PRODUCTION, domain_of_source, mixture, mixture_sql
from tidelake.llm.quality import quality
from tidelake.llm.sharding import shuffled
from tidelake.llm.simhash import near_duplicates
from tidelake.llm.tokens import tokenized
from tidelake.llm.toxicity import toxicity


#: The end id that the token files' contract names.
END_ID = 2


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A file of the installed public tokenizers; the byte-level BPE if none is named."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents and their components."""
    return near_duplicates(_read(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents by FTRL-proximal logistic regression."""
    return toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of all documents in tar shards, and what range reads find in them."""
    return media_columns(_read(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of all documents at the production weights."""
    return mixture(_read(spark, sf_dir, "documents"), PRODUCTION, domain_of_source(F.col("source")))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of all conversations and of one that quotes the template, read back."""
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    quoted = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), quoted.alias("text"))
    extra = extra.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in turns.schema))
    return chat_digests(turns.unionByName(extra), tokenizer_path())


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark phrases in all documents by an FM-index per shard."""
    return decontaminate.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by a sparse rule ensemble."""
    return quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents by rank-order n-gram profiles."""
    return language_id(_read(spark, sf_dir, "documents"))


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files of all documents, read back."""
    return tokenized(_read(spark, sf_dir, "documents"), tokenizer_path(), END_ID, slice_bytes=6 << 20)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of exact sizes, uniformly shuffled."""
    return shuffled(_read(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids by two tokenizers in minimal groups, and how often their links are made in the corpus."""
    return alignment(_read(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations."""
    return trie.prefix_trie(_read(spark, sf_dir, "conversations"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts among all documents; unique texts are hashed as well, for the digest column."""
    rows = exact.exact_groups(_read(spark, sf_dir, "documents"), every_digest=True)
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": op1_simhash,
        "op2_toxicity": op2_toxicity,
        "op3_media_columns": op3_media_columns,
        "op4_mixing": op4_mixing,
        "op5_chat_formatting": op5_chat_formatting,
        "op6_decontamination": op6_decontamination,
        "op7_quality": op7_quality,
        "op8_language_id": op8_language_id,
        "op9_token_ids": op9_token_ids,
        "op10_sharding": op10_sharding,
        "op11_alignment": op11_alignment,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_exact_dedup": op13_exact_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_mixing": mixture_sql(), "op6_decontamination": decontaminate.SQL, "op12_prefix_trie": trie.SQL, "op13_exact_dedup": exact.SQL}

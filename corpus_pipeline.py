"""From raw documents to packed sequences, in stages that hand on Parquet.

Every stage but the last keeps the columns of its input. Removed lines and redacted identifiers
change the text, and ``n_chars`` with it. Null and empty texts are rejected by the first stage;
further columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from claimwright.llm import language, minhash, packing, pii, quality
from claimwright.session import scratch_path

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LEAST_LANGUAGE_SCORE = 0.2


def counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text, where there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line-first rules, without their failing lines."""
    return counted(quality.clean_documents(docs))


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones show, with the predicted language.

    Rejected: texts without a letter, and those whose best language is as good as a guess.
    Without labelled documents nothing can be told apart, and all pass.
    """
    model = language.fit_languages(spark, docs)
    if not model.families:
        return docs
    found = language.predict_languages(docs, model).where((F.col("lang_pred") != language.UNKNOWN) & (F.col("lang_score") >= LEAST_LANGUAGE_SCORE))
    return found.select(*[F.col("lang_pred").alias(c) if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates."""
    return minhash.drop_near_duplicates(spark, docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal identifiers replaced by their kind."""
    return counted(pii.redact(spark, docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens, with their ids and the ids' crc32."""
    return packing.pack_documents(docs, VOCABULARY).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality rules", clean),
    ("language ID", identify),
    ("MinHash near-dedup", deduplicate),
    ("PII", redact),
    ("packing", pack),
]

# Models and packing are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the table of documents; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        path = scratch_path(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

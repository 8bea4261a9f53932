"""From raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept. The first four return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm import jaccard, packing, privacy, quality, suffixes
from stationflow.session import stored

# No SQL twin: a fitted model and a tokenizer take part. See tests/llm/test_pipeline.py.
ORACLE_SQL = None


def resized(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a changed text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.char_length(F.coalesce(F.col("text"), F.lit(""))).cast(kind))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return jaccard.one_of_each(docs, width=5, percent=80)


def repeated_string_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 100 bytes that start earlier."""
    return resized(suffixes.cut_texts(docs))


def private_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without personal data and the terms that reveal it."""
    return resized(privacy.sanitised(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    return packing.digested(packing.packed(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram jaccard join", near_duplicate_stage),
    ("suffix-array dedup", repeated_string_stage),
    ("pii", private_data_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and reread."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, rows, sf_dir)

"""The training-data pipeline: each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from msgflow.llm.bpe import encode_documents
from msgflow.llm.chunk_recipes import drop_exact_copies
from msgflow.llm.mixing import mix
from msgflow.llm.odd_sketch import drop_near_copies
from msgflow.llm.queries import vocabulary
from msgflow.llm.toxicity import drop_toxic
from msgflow.session import run_dir


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for A-Z case, the row with the largest doc_id stays."""
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked over five-word shingles at 0.8, the smallest doc_id stays."""
    return drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their source take them."""
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document of the mix."""
    return encode_documents(docs, vocabulary())


STAGES = [
    ("toxicity", clean),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("mixing", mixture),
    ("BPE", tokens),
]

#: No SQL: the toxicity model, the near-duplicate links and the merges are not expressible.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = run_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

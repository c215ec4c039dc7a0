"""From raw documents to encoded training text, in five stages.

Each stage takes what its predecessor kept, read from Parquet, and returns
the columns of ``documents``; the last returns encoded documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trolley.llm import bpe, exact_dedup, jaccard_join, mixing, toxicity
from trolley.sources.storage import settled


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return jaccard_join.one_per_class(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, their number, and digests of the ids and of the bytes decoded from them."""
    return bpe.encode_documents(docs).select("doc_id", "ids", *bpe.digests())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# The fitted classifier, the min-hash forest and the encoder are not SQL.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}

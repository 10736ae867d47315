"""A corpus from raw documents to packed sequences, in five stages.

Each stage reads all that the one before has kept. Null ids and texts, empty tables, repeated rows and extra columns
are handled as the operators say: rows without an id are kept by the second stage and drawn alike by the fourth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import jaccard, mixing, packing, quality, secrets
from millrace.llm.common import documents
from millrace.workspace import fresh_dir


def reject_by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose histograms are near those of their language."""
    return quality.keep_documents(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every component of near copies."""
    return jaccard.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark."""
    return secrets.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights; one that is drawn several times is there as often."""
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("quality", reject_by_quality), ("near_copies", keep_one_of_near_copies), ("secrets", mask_secrets),
    ("mixing", mix_sources), ("packing", pack_sequences),
]

# The Jensen-Shannon stage, the automata and the tokenizer have no SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}

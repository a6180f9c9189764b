"""Training-data pipeline over ``documents``: drop poor text, near copies and leaked benchmark text, redact, pack.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the
columns of their input. ``run`` writes each stage's result to the shared folder and reads it again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecquery.llm import decontaminate, packing, pii, quality, registry, simhash
from vecquery.sources.tables import read_table, write_stage

#: Documents that score below it are rejected.
LEAST_QUALITY = 0.3


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts; it learns as the query of that operator does."""
    model = quality.train(docs, read_table(spark, sf_dir, "labels"), ~quality.held_out())
    return docs.filter(quality.score_column(model) >= LEAST_QUALITY)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind and ``n_chars`` brought up to date."""
    text = docs.withColumn("text", pii.redacted_column(pii.train_network(docs)))
    return text.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in their sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", drop_poor),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("PII", redact),
    ("best-fit packing", pack),
]

#: SQL has no compression, XXH64, network or tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", spread_by="doc_id")
    for name, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


ENTRIES = {**registry.ENTRIES, "pipeline": (run, ORACLE_SQL)}

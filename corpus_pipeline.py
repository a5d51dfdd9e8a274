"""From documents to packed sequences: language, toxicity, near duplicates, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and
read again as the next one's ``docs``. All but the last return documents with
all their columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellwright.llm import decontam, langid, packing, simhash, toxicity
from cellwright.llm.queries import table, tokenizer_path
from cellwright.session import store


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in an identified language."""
    return langid.keep_identified(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near duplicates."""
    return simhash.drop_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language ID", language),
    ("toxicity", clean),
    ("SimHash near-dedup", dedup),
    ("benchmark decontamination", decontaminate),
    ("packing", pack),
]

#: two stages are trained networks, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = store(docs, "stage")
    return docs

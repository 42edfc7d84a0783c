"""The corpus pipeline: toxicity, exact dedup, near duplicates, decontamination, packing.

Each stage gets all documents its predecessor kept and returns a DataFrame, which is
written and read again before the next one. All but the last return the columns of
`documents`. Decisions belong to rows, not to doc_ids: rows that share a doc_id are
judged apart, rows with a null doc_id like all others. Null and empty texts are clean
documents without words; further columns are kept, whatever their names. An empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import op1_toxicity, op3_exact_dedup, op4_decontamination, op5_packing, op9_jaccard
from newsloom.llm.common import free_name, handover, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents scored toxic (0.5 or more). Without labels of both classes a document's score is the share of toxic labels."""
    model = op1_toxicity.train(docs, table(spark, sf_dir, "labels"))
    name = free_name("toxicity", docs.columns)
    return op1_toxicity.score(docs, model, name=name).filter(F.col(name) < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays: the largest doc_id. All null and empty texts are equal."""
    return op3_exact_dedup.distinct_texts(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents one row stays: the smallest doc_id (null ids last). Texts without words all stay."""
    return op9_jaccard.distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly made of them go."""
    return op4_decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; a document without words is its end id."""
    return op5_packing.pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL can't express the toxicity model or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = handover(docs, name)
    return docs

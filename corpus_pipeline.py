"""A corpus pipeline of five stages over ``documents``.

Every stage takes all that its predecessor kept. The first four return the columns of documents; the
last returns the encoded texts. Between stages the documents are a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import staged, table
from sluice.llm.contamination import without_contaminated
from sluice.llm.encoding import encode_texts
from sluice.llm.language import UNKNOWN, identify
from sluice.llm.minhash import one_per_group
from sluice.llm.substrings import without_repeats

#: A text whose n-grams are ranked so unlike every learned language is in none of them.
LEAST_SCORE = 0.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages."""
    found = identify(docs).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return found.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_per_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that documents with a smaller id have."""
    found = without_repeats(docs)
    if "n_chars" in docs.columns:
        chars = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint"))
        found = found.withColumn("n_chars", F.coalesce(chars, "n_chars"))
    return found.select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text."""
    found = encode_texts(docs.select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.coalesce(F.size("ids"), F.lit(0)).cast("bigint").alias("n_tokens"),
        "ids",
        "round_trip",
        "exact",
    )


STAGES = [
    ("language", language),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("decontamination", decontaminated),
    ("encoding", encoded),
]

#: SQL can express neither the language profiles nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: from raw documents to token ids.

Rejected documents go, one document of each near-duplicate group stays, secrets are masked, sources are mixed to their
target weights (a document may repeat), and what is left is encoded. Every stage works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import bpe, group_join, mixing, quality, secrets
from tallyward.llm.common import stage
from tallyward.llm.queries import ship, small_batches, table, vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def prepare(spark: SparkSession) -> None:
    ship(spark)
    small_batches(spark)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.keep_good(docs, quality.fit_references(docs), COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return group_join.keep_first(docs, COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span found, in whatever layer, is masked; ``n_chars`` follows the text."""
    prepare(spark)
    masked = secrets.scan_documents(docs, ("lang", "source"), redacted=True)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.draw(docs, COLUMNS, quality=table(spark, sf_dir, "labels"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    encoded = bpe.encode(docs, vocabulary(), "lang", "source")
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicates), ("secret scans", mask_secrets),
          ("mixing sources", mix_sources), ("BPE encoding", encode)]

# Hash draws, divergences and merge rounds have no SQL form; tests/llm compares the operators of the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)

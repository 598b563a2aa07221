"""From raw documents to packed sequences, in stages over one documents table.

Each stage gets what the stage before it kept. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, stored, table
from tidemark.llm.decontaminate import uncontaminated
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.ngram_join import one_of_each
from tidemark.llm.packing import pack
from tidemark.llm.quality import accepted


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages of three sentences; a document of which nothing is left goes."""
    left = dedup_lines(docs, sentences=True).where((F.col("n_removed") == 0) | (F.length(F.trim("text")) > 0))
    columns = [F.col(f"row.{c}").alias(c) for c in docs.columns if c not in ("text", "n_chars")]
    return left.select(*columns, "text", F.length("text").cast("long").alias("n_chars")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 0.8 of their five-word shingles in common."""
    return one_of_each(docs, n=5, share=(80, 100))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences.

    Workers live on through the stages, so each keeps fewer words at hand than it might alone.
    """
    return pack(docs, remembered=300_000)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

# A learned classifier and a tokeniser cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each over what the stage before it wrote."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

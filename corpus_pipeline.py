"""From raw documents to a training mix: quality rules, line dedup, near-duplicate removal, decontamination, mixing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before it kept. All but the last return
the columns of ``documents`` and, where a table has more, those too. Null texts and empty texts end at the quality
rules; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cairnsift.llm import decontaminate, line_dedup, mixing, near_dup, quality
from cairnsift.llm.shared import SPACE, fresh, shipped
from cairnsift.session import configure, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return docs.where(quality.accepted(F.col("text")))


def line_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of repeated runs go, and with them documents of which no word is left."""
    n_chunks, n_removed = fresh(docs, "n_chunks", "n_removed")
    cut = line_dedup.remove(docs, whole=True)
    left = cut.where((F.col(n_removed) == 0) | (F.length(F.btrim("text", F.lit(SPACE))) > 0)).drop(n_chunks, n_removed)
    return left.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links of five-word shingles at 0.8 or more connect, the least id stays."""
    shipped(spark)
    gone = near_dup.groups(docs).where("NOT kept").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs.doc_id == gone["_gone"], "left_anti")


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    benchmark = shipped(spark).read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.clean(docs, benchmark)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in equal parts by characters, each document repeated by its count, dealt out in hash order."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_chunks),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("source mix", source_mix),
]

# Sketches, bands and alignments are beyond SQL; tests hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one stage keeps is written before the next reads it."""
    shipped(configure(spark))
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

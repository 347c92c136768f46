"""From raw documents to packed sequences: five stages, each written and read again.

``STAGES`` lists the stages in order; each takes ``(spark, docs, sf_dir)``. All
but the last return the columns of ``documents``; the last gives the pieces of
the packed sequences, which can hold a document several times, as the mix does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.llm.common import Scratch
from docloom.llm.exact import drop_exact
from docloom.llm.minhash import drop_near
from docloom.llm.mixing import mixed_rows
from docloom.llm.packing import pack
from docloom.llm.quality import keep_good

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

NEAR_WORDS = 5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and so do the frequent lines of the others."""
    return keep_good(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays."""
    return drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five words, similarity 0.8)."""
    return drop_near(docs, size=NEAR_WORDS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, shuffled; each written file holds one output shard."""
    return mixed_rows(docs).drop("mix_shard")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("packing", packing),
]

#: SQL can neither sketch nor tokenize; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs

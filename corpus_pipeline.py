"""From raw documents to a training mix: five stages, each written and reread before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import decontam, language, mixing, rlz, setsketch
from kerbside.llm.text import table
from kerbside.session import scratch_path


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a learned language stay; null texts and texts without a letter go."""
    return language.drop_undetermined(docs, language.references(language.training_rows(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near-duplicates stays."""
    return setsketch.drop_near_duplicates(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are taken out of the texts; all documents stay.

    ``n_chars``, where there is such a column, follows the texts.
    """
    left = rlz.drop_duplicate_spans(docs)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken, so that sources meet their targets."""
    return mixing.mixed(docs)


STAGES = [
    ("language", languages),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontaminated", decontaminated),
    ("mix", mix),
]

# Cross-parsing and balancing iterate, which SQL can't state; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of ``documents``; what each stage keeps is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

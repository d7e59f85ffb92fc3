"""A training corpus from raw documents: four filters and a packer, each step over all that the one before it kept.

Every filter returns the columns of its input, whatever they are called, and may be given any rows: a null text counts as empty, a null id as
an id of its own, rows of one id are judged by their own texts, equal rows share their fate in every filter but the two for copies, which
keep one, and long texts are read whole. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, exact_dedup, jaccard_join, packing, toxicity
from tidemark.llm.store import read, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5; the model learns from the labels of ``sf_dir``. Empty texts stay."""
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, empty ones included, the one with the smallest id; one without an id only if its whole group has none."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each linked group of similar texts the one with the smallest id. Texts without words are linked with nothing and stay."""
    return jaccard_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make up less than a twentieth; texts without words stay."""
    return decontamination.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the sequences; an empty text is its end id alone."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Learned scores and a tokenizer have no SQL; tests/llm checks every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written as Parquet and read again as the input of the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

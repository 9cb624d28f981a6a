"""The training-data pipeline: from documents to packed sequences.

Every stage works on all that the one before it kept, calls one operator and lets its
decisions take effect. The columns of documents stay until the last stage, whose rows say
where the pieces of the documents go.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm.classifier import accepted
from tagloom.llm.common import table, written
from tagloom.llm.decontam import decontaminate
from tagloom.llm.lines import dedup_lines
from tagloom.llm.packing import pack
from tagloom.llm.simhash import one_of_each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. A null or empty text is scored as an empty one;
    rows without an id and repeated rows are scored like others, an empty table gives none."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat earlier ones go; every row stays, if need be without text, and a null
    text stays null. Rows of one id, or of none, lose their own lines only."""
    return dedup_lines(docs, max_edits=2, min_chars=24)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates one row stays, that of the least id; rows without an id are compared
    like others and stay only where no row with an id is near. Null and empty texts are alike."""
    return one_of_each(docs, by_row=True, shingle=3, max_distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, with or without an id, and with every row of
    their id; null and empty texts hold none."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), unnamed=True)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and the sequences they are packed into; a null text is an
    empty document, repeated rows are packed as often as they occur."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", packing),
]

# A trained network, fingerprints and packing are beyond SQL; tests hold each operator
# against a brute-force version and each stage against its operator.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over the documents, each stage's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs

"""What the operators share: words, input tables, tables cut from their lineage."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import shared_dir

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again: later work starts from
    files that every executor reaches, whatever becomes of the executors before."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def carried() -> None:
    """Functions of this package travel to the workers as they are, so that a cluster
    needs no copy of it installed."""
    cloudpickle.register_pickle_by_value(sys.modules["tagloom.llm"])


carried()

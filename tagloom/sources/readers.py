"""Readers and the dispatch from a source description to one of them."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.predicates import where_dsl, where_fields
from tagloom.operators.cells import cells_to_rows
from tagloom.seeds import TSV_FIELDS
from tagloom.specs import HBASE, HDFS, HIVE, RDBMS, SourceSpec

ROW_KEY = "row"


def read_cells(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Declared fields of one family of a cell table, row key first, all text.

    Every row with a cell of the family counts, whether it has these fields or not, and
    conditions may ask for other fields.
    """
    cells = spark.read.parquet(spec.table)
    asked = [f for f in where_fields(spec.where) if f not in spec.fields and f != ROW_KEY]
    wide = cells_to_rows(cells, spec.family, [*spec.fields, *asked], ROW_KEY, all_rows=True)
    return _where(wide, spec).select(ROW_KEY, *spec.fields)


def _where(df: DataFrame, spec: SourceSpec) -> DataFrame:
    return df.where(where_dsl(spec.where)) if spec.where else df


def read_wide(spark: SparkSession, path: str, fields: Sequence[str], key: str = "id") -> DataFrame:
    """Key and chosen columns of a wide table, all text."""
    return spark.read.parquet(path).select(*[F.col(c).cast("string").alias(c) for c in (key, *fields)])


def catalog_text(table: str, fields: Sequence[str], family: str, key: str = "id") -> str:
    """Catalog of a wide table: the key and its fields, all text."""
    columns = {key: {"cf": "rowkey", "col": key, "type": "string"}}
    columns |= {f: {"cf": family, "col": f, "type": "string"} for f in fields}
    return json.dumps({"table": {"namespace": "default", "name": table}, "rowkey": key, "columns": columns})


def read_catalog(spark: SparkSession, catalog: str) -> DataFrame:
    """The wide table that a catalog text describes."""
    spec = json.loads(catalog)
    fields = [name for name, c in spec["columns"].items() if c["cf"] != "rowkey"]
    return read_wide(spark, spec["table"]["name"], fields, spec["rowkey"])


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    predicate: str | None = None,
    partition: tuple[str, int, int, int] | None = None,
    **options: str,
) -> DataFrame:
    """A database table. The predicate reaches the database; ``partition`` is
    ``(column, lower, upper, parts)`` and lets as many tasks read at once."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition:
        column, lower, upper, parts = partition
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(parts))
        )
    df = reader.load()
    return df.where(predicate) if predicate else df


def read_tag_family(tags: DataFrame, tag_id: int) -> DataFrame:
    """A level-4 tag and its values, the tag first and the values in their order."""
    picked = tags.where((F.col("id") == tag_id) | (F.col("pid") == tag_id))
    return picked.orderBy("level", F.col("order").asc_nulls_first(), "id")


def read_hive(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def read_delimited(spark: SparkSession, path: str, separator: str, fields: Sequence[str]) -> DataFrame:
    """Separated text with the given field names, all text, no header."""
    schema = ", ".join(f"`{f}` string" for f in fields)
    return spark.read.csv(path, sep=separator.replace("\\t", "\t"), schema=schema)


def read_tsv_fixed(spark: SparkSession, path: str, kind: str, fields: Sequence[tuple[str, int]]) -> DataFrame:
    """TAB lines of a known kind. Lines with too few fields are dropped; what is
    too much stays in the last field. ``fields`` picks ``(name, position)``."""
    size = TSV_FIELDS[kind]
    # a line has that many fields if it has at least one TAB less; counting them
    # first means that only the lines that stay are split
    tabs = F.length("value") - F.length(F.translate("value", "\t", ""))
    parts = spark.read.text(path).where(tabs >= size - 1).select(F.split("value", "\t", size).alias("p"))
    return parts.select(*[F.col("p")[i].alias(n) for n, i in fields])


def read_libsvm(spark: SparkSession, path: str, features: int | None = None) -> DataFrame:
    """Label and feature vector; naming the number of features saves a pass."""
    reader = spark.read.format("libsvm")
    return (reader.option("numFeatures", str(features)) if features else reader).load(path)


def _from_rdbms(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    extra = {
        name: spec.option(given)
        for name, given in (("driver", "driver"), ("user", "username"), ("password", "password"))
        if spec.option(given)
    }
    table = f"({spec.option('sql')}) AS rule_rows" if spec.option("sql") else spec.table
    partition = None
    if spec.option("partitionColumn"):
        low, high, parts = (int(spec.option(n)) for n in ("lowerBound", "upperBound", "numPartitions"))
        partition = (spec.option("partitionColumn"), low, high, parts)
    df = _where(read_jdbc(spark, spec.option("url"), table, None, partition, **extra), spec)
    return df.select(*spec.fields) if spec.fields else df


def _from_hive(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    df = _where(spark.sql(spec.option("sql")) if spec.option("sql") else read_hive(spark, spec.table), spec)
    return df.select(*spec.fields) if spec.fields else df


def _from_hdfs(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    df = _where(read_delimited(spark, spec.table, spec.option("sperator", ","), spec.fields), spec)
    wanted = [f for f in spec.option("outFields").split(",") if f in spec.fields]
    return df.select(*wanted) if wanted else df


READERS: dict[str, Callable[[SparkSession, SourceSpec], DataFrame]] = {
    HBASE: read_cells,
    RDBMS: _from_rdbms,
    HIVE: _from_hive,
    HDFS: _from_hdfs,
}


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Rows of whatever kind of source the description names."""
    return READERS[spec.kind](spark, spec)

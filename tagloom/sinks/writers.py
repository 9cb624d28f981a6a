"""Writers. A table is written as a new version; nothing overwrites what it reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.cells import rows_to_cells, sort_cells
from tagloom.operators.profile import encode_tags, merge_profile, upsert_wide
from tagloom.session import small_table

SHEET_ROWS = 65535


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v{version:08d}"


def write_version(df: DataFrame, root: str, version: int, key: str | None = None, parts: int | None = None) -> str:
    """Write one version of a table and return its folder.

    With ``parts`` the rows are spread over that many pieces by key hash; without
    it they stay where the merge left them, which is by key hash as well. A folder
    that exists already is an error, so a run that comes too late cannot damage
    the version another run wrote.
    """
    if key and parts:
        df = df.repartition(parts, key)
    path = version_path(root, version)
    df.write.mode("errorifexists").parquet(path)
    return path


def write_profile_wide(
    new: DataFrame, root: str, version: int, base: int | None = None, key: str = "id", parts: int | None = None
) -> str:
    """Upsert tag columns into the wide profile as a new version."""
    if base is not None:
        old = new.sparkSession.read.parquet(version_path(root, base))
        new = upsert_wide(old, new, key)
    return write_version(new, root, version, key, parts)


def write_merged_profile(new: DataFrame, root: str, version: int, base: int | None = None) -> str:
    """Merge ``(user_id, tag_id)`` rows into the profile as a new version."""
    spark = new.sparkSession
    old = (
        spark.read.parquet(version_path(root, base))
        if base is not None
        else small_table(spark, [], "user_id bigint, tag_ids array<bigint>")
    )
    return write_version(merge_profile(old, new), root, version)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write a table bucketed and sorted by its key and return it.

    A profile kept this way is merged, joined and grouped by user without being
    shuffled again; only the new rows travel. Take at least as many buckets as
    the session has shuffle partitions. The rows are brought together by bucket
    first, so that each bucket is one file.
    """
    (
        df.repartition(buckets, key)
        .write.mode("errorifexists")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .format("parquet")
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def profile_cells(profile: DataFrame, family: str = "user", prefix: str = "u_") -> DataFrame:
    """Profile rows as cells: key ``u_<id>``, columns userId and tagIds."""
    rows = profile.select(
        F.concat(F.lit(prefix), F.col("user_id").cast("string")).alias("row"),
        F.col("user_id").alias("userId"),
        encode_tags(F.col("tag_ids")).alias("tagIds"),
    )
    return rows_to_cells(rows, "row", family)


def write_cells(cells: DataFrame, path: str, partitions: int | None = None) -> str:
    """Cells in key order, ready for a range-partitioned load."""
    sort_cells(cells, partitions).write.mode("errorifexists").parquet(path)
    return path


def sync_table(df: DataFrame, key: str, family: str, path: str, partitions: int | None = None) -> str:
    """Copy a table into cells with the chosen row key."""
    return write_cells(rows_to_cells(df, key, family), path, partitions)


def export_users(users: DataFrame, columns: Sequence[str], path: str, sheet_rows: int = SHEET_ROWS) -> str:
    """Users as CSV sheets with a header and a bounded number of rows each."""
    (
        users.select(*columns)
        .write.mode("errorifexists")
        .option("maxRecordsPerFile", sheet_rows)
        .csv(path, header=True)
    )
    return path


def save_model(model: MLWritable, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_or_fit(spark: SparkSession, path: str, fit) -> KMeansModel:
    """The stored model, or a new one that is then stored."""
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(files):
        return KMeansModel.load(path)
    model = fit()
    save_model(model, path)
    return model

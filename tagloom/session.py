"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Settings that may change on a running session. Shuffle partition counts are
# left to the cluster; AQE coalesces small ones and splits skewed ones.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tagloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    # call sites of every column expression help only in error messages
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Tables up to this many rows are small enough to broadcast; a tag row with its
# whole path takes some hundred bytes, so this stays in the tens of megabytes.
BROADCAST_ROWS = 100_000


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a table has at most so many rows.

    Asks for the one row behind them. Spark then reads a few partitions at a time
    and stops once it has enough; no row but that one leaves the JVM.
    """
    return not df.select(F.lit(1)).offset(rows).limit(1).collect()


def broadcast_if(small: bool, df: DataFrame) -> DataFrame:
    """Broadcast a table whose size was checked; otherwise the join shuffles, and
    AQE splits its skewed partitions."""
    return F.broadcast(df) if small else df


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    Without that setting a folder of this machine is used, but only if the
    session itself runs on this machine alone.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="tagloom-")
    return f"{base.rstrip('/')}/tagloom/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again, for what several later steps
    start from: none of them makes it anew, and a lost executor costs only its own share."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """Driver-side rows as a local relation. Unlike rows handed over one by one its
    size is known to the optimizer, and reading it needs no Python worker."""
    struct = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)
    columns = list(zip(*rows)) or [()] * len(struct)
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), struct)

"""Account numbers kept by bucket, so that a batch of numbers reads only where they are.

The four account columns of the users are taken apart once, when the index is written.
A bucket is a folder, chosen by a hash of kind and number; a question reads the folders of
its own numbers. Within a folder the rows stand by kind and number, so that the files'
least and greatest values leave out more.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.columns import classify_account
from tagloom.session import broadcast_if, is_small

KINDS = ("mobile", "email", "qq", "id_card")
SCHEMA = "kind string, num string, user_id bigint, bucket int"


@dataclass(frozen=True)
class AccountIndex:
    path: str
    buckets: int


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("kind", "num"), F.lit(buckets)).cast("int")


def write_accounts(
    users: DataFrame, path: str, *, buckets: int = 256, lanes: int = 4, key: str = "id", kinds: Sequence[str] = KINDS
) -> AccountIndex:
    """Index the accounts of ``users``: the key and a column for each kind; null accounts are nobody's.

    A bucket is written by up to ``lanes`` tasks, dealt by user, so a number that many users
    gave fills no single one. A folder that exists already is an error.
    """
    accounts = users.select(
        F.col(key).cast("bigint").alias("user_id"),
        F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("num")) for k in kinds])).alias("a"),
    ).select("a.kind", "a.num", "user_id")
    accounts = accounts.where("num is not null").withColumn("bucket", _bucket(buckets))
    lane = F.pmod(F.xxhash64("user_id"), F.lit(lanes))
    dealt = accounts.repartition("bucket", lane).sortWithinPartitions("bucket", "kind", "num")
    dealt.write.mode("errorifexists").partitionBy("bucket").parquet(path)
    return AccountIndex(path, buckets)


def find_accounts(spark: SparkSession, index: AccountIndex, numbers: DataFrame, number: str = "num") -> DataFrame:
    """``(num, kind, user_id)`` of the numbers, as ``lookup_users`` finds them over all users.

    A number of no known format has no user. The buckets that are asked for come to the
    driver, at most as many as the index has; if all are, all are read, once.
    """
    asked = numbers.select(F.col(number).alias("num")).distinct()
    asked = asked.select("num", classify_account(F.col("num")).alias("kind")).where("kind is not null")
    asked = asked.withColumn("bucket", _bucket(index.buckets))
    few = is_small(numbers)
    places = sorted(r["bucket"] for r in asked.select("bucket").distinct().collect())
    rows = spark.read.schema(SCHEMA).parquet(index.path).where(F.col("bucket").isin(*places))
    return rows.join(broadcast_if(few, asked), ["bucket", "kind", "num"]).select("num", "kind", "user_id")

"""How much of a user table is well formed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.columns import ACCOUNT_FORMATS, IP_FORMAT, URL_FORMAT, digits_to_date

CHECKS = {
    **ACCOUNT_FORMATS,
    "url": URL_FORMAT,
    "ip": IP_FORMAT,
}


def valid(kind: str, value: Column) -> Column:
    """Whether a value passes; a missing value does not."""
    if kind == "date":
        well = value.rlike(r"^\d{4}-?\d{2}-?\d{2}$") & digits_to_date(value).isNotNull()
    else:
        well = value.rlike(CHECKS[kind])
    return F.coalesce(well, F.lit(False))


def validity_report(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Share of passing values per column, all columns in one aggregation."""
    shares = df.agg(
        F.count("*").alias("_n"),
        *[F.count_if(valid(kind, F.col(name))).alias(name) for name, kind in columns.items()],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.lit(kind).alias("kind"),
                F.col(name).alias("passed"),
                F.try_divide(F.col(name).cast("double"), F.col("_n").cast("double")).alias("share"),
            )
            for name, kind in columns.items()
        ]
    )
    return shares.select(F.explode(entries).alias("e")).select("e.*")

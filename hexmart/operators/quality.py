"""Checks on tables; each is one row of counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexmart.functions.text import mask


def key_and_srid(df: DataFrame, key: str, srid: str, expected: int) -> DataFrame:
    """Rows with another SRID, with a NULL key, and keys in excess of the distinct ones; all 0 if the table is valid."""
    per_key = df.groupBy(key).agg(
        F.count("*").alias("n"), F.count_if(~F.col(srid).eqNullSafe(F.lit(expected))).alias("wrong")
    )
    excess = F.sum(F.when(F.col(key).isNotNull(), F.col("n") - 1).otherwise(0))
    return per_key.agg(
        F.coalesce(F.sum("wrong"), F.lit(0)).alias("wrong_srid"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n")).otherwise(0)), F.lit(0)).alias("null_keys"),
        F.coalesce(excess, F.lit(0)).alias("duplicate_keys"),
    )


def relation_equality(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one of two relations has, as multisets."""
    b = b.select(*a.columns)
    counted = a.withColumn("_side", F.lit(1)).unionByName(b.withColumn("_side", F.lit(-1)))
    net = counted.groupBy(*a.columns).agg(F.sum("_side").alias("_net"))
    return net.agg(
        F.coalesce(F.sum(F.greatest("_net", F.lit(0))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.greatest(-F.col("_net"), F.lit(0))), F.lit(0)).alias("only_right"),
    )


def not_null_count(df: DataFrame, column: str) -> DataFrame:
    """How many rows break the rule that ``column`` is NULL."""
    return df.agg(F.count(column).alias("validation_errors"))


def masked(df: DataFrame, columns: list[str], allowed: tuple[str, ...], user: str | None = None) -> DataFrame:
    """The table with sensitive columns shown only to allowed users."""
    return df.select(*[mask(F.col(c), allowed, user).alias(c) if c in columns else F.col(c) for c in df.columns])

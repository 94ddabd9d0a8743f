"""Slowly changing snapshots (type 2) by comparing columns, and their clean-up."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexmart.session import fresh_path
from hexmart.sources import folders


def first_snapshot(current: DataFrame, key: str, run_at: datetime, prefix: str = "") -> DataFrame:
    """The rows as open versions from ``run_at`` on; ``prefix`` goes before the names of the version columns."""
    at = F.lit(run_at).cast("timestamp_ntz")
    scd_id = F.md5(F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(str(run_at))))
    return (
        current.withColumn(f"{prefix}scd_id", scd_id)
        .withColumn(f"{prefix}updated_at", at)
        .withColumn(f"{prefix}valid_from", at)
        .withColumn(f"{prefix}valid_to", F.lit(None).cast("timestamp_ntz"))
    )


def check_snapshot(
    snapshot: DataFrame, current: DataFrame, key: str, check_cols: list[str], run_at: datetime, prefix: str = ""
) -> DataFrame:
    """Next state of a snapshot: changed rows are closed at ``run_at`` and follow anew; absent keys stay open.

    Closed history is passed through without a join.
    """
    valid_to = f"{prefix}valid_to"
    open_rows = snapshot.filter(F.col(valid_to).isNull())
    closed_before = snapshot.filter(F.col(valid_to).isNotNull())
    names = {c: f"_new_{c}" for c in check_cols}
    fresh = current.select(F.col(key), F.lit(True).alias("_seen"), *[F.col(c).alias(n) for c, n in names.items()])
    differs = reduce(Column.__or__, [~F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    at = F.lit(run_at).cast("timestamp_ntz")
    compared = open_rows.join(fresh, key, "left")
    kept = compared.withColumn(valid_to, F.when(F.col("_seen") & differs, at)).select(*snapshot.columns)
    known = open_rows.select(key, F.lit(True).alias("_known"), *[F.col(c).alias(n) for c, n in names.items()])
    versions = current.join(known, key, "left").filter(F.col("_known").isNull() | differs).select(*current.columns)
    opened = first_snapshot(versions, key, run_at, prefix).select(*snapshot.columns)
    return closed_before.unionByName(kept).unionByName(opened)


def split_invalidated(snapshot: DataFrame, inserted_at: datetime, prefix: str = "") -> tuple[DataFrame, DataFrame]:
    """Clean-up: the open rows that stay, and the closed rows for the audit table."""
    valid_to = F.col(f"{prefix}valid_to")
    audit = snapshot.filter(valid_to.isNotNull())
    return snapshot.filter(valid_to.isNull()), audit.withColumn("_inserted_at", F.lit(inserted_at).cast("timestamp_ntz"))


def clean_up(spark: SparkSession, path: str, audit_path: str, inserted_at: datetime, prefix: str = "") -> int:
    """Move the closed rows of a stored snapshot to its audit table; returns how many.

    The audit rows are written first, into a folder named after the run, so that a run repeated after a stop writes the same folder
    again and none is there twice.  Then the rows that stay are stored, and take the place of the snapshot's folder by a rename.
    """
    snapshot = spark.read.parquet(path)
    kept, closed = split_invalidated(snapshot, inserted_at, prefix)
    run = f"{audit_path}/run={inserted_at:%Y%m%dT%H%M%S%f}"
    closed.write.mode("overwrite").parquet(run)
    moved = spark.read.schema(closed.schema).parquet(run).count()
    if moved:
        staged = fresh_path(spark, "snapshot")
        kept.write.parquet(staged)
        folders.swap(spark, staged, path)
    return moved

"""Small DataFrame helpers of the operators."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexmart.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_names(df: DataFrame, n: int) -> list[str]:
    """``n`` column names that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    return [name for i in range(n + len(taken)) if (name := f"_own{i}") not in taken][:n]


def row_key() -> Column:
    """Tells rows of documents apart: equal only for rows of equal id and equal text."""
    return F.xxhash64("doc_id", "text")


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def settle(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and let go of the shuffle files that made it.

    Spark deletes the files of a shuffle once the driver has collected its last reference, which may take long where
    the driver allocates little; until then every step of a job would keep its files on disk.
    """
    written = materialize(df, tag)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return written

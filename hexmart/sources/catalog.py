"""Reading tables: a small catalog of named sources, typed CSV seeds, and freshness."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexmart.operators.quality import key_and_srid
from hexmart.session import materialize


@dataclass(frozen=True)
class Source:
    """Where a named table lies and how to read it."""

    path: str
    format: str = "parquet"
    schema: str | None = None
    options: dict[str, str] = field(default_factory=dict)


class Catalog:
    """Named sources; a name that is not listed is looked up among Spark's own tables."""

    def __init__(self, sources: dict[str, Source]):
        self.sources = sources

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        source = self.sources.get(name)
        if source is None:
            return spark.table(name)
        reader = spark.read.format(source.format).options(**source.options)
        return (reader.schema(source.schema) if source.schema else reader).load(source.path)

    def lookup(self, spark: SparkSession, name: str, key: str) -> DataFrame:
        """A named table, indexed by a field; see :func:`lookup_table`."""
        return lookup_table(self.load(spark, name), key, name)


def lookup_table(df: DataFrame, key: str, name: str = "the table") -> DataFrame:
    """A table to look rows up in: stored with ``key`` in front, and refused if a key is NULL or comes twice."""
    stored = materialize(df.select(key, *[c for c in df.columns if c != key]), "lookup")
    null_keys, twice = key_and_srid(stored.withColumn("_srid", F.lit(0)), key, "_srid", 0).first()[1:]
    if null_keys or twice:
        raise ValueError(f"{name} is no look-up table by {key}: {null_keys} rows without key, {twice} with a key that another has")
    return stored


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV seed with a header and declared types; nothing is inferred."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def freshness(df: DataFrame, loaded_at: str, as_of: datetime, max_hours: float) -> DataFrame:
    """One row: newest stamp, its age in hours at ``as_of``, and whether that is too old."""
    age = F.timestamp_diff("SECOND", F.col("newest"), F.lit(as_of).cast("timestamp_ntz")) / 3600.0
    newest = df.agg(F.max(F.col(loaded_at)).cast("timestamp_ntz").alias("newest"))
    return newest.withColumn("age_hours", age).withColumn("stale", F.col("newest").isNull() | (F.col("age_hours") > max_hours))

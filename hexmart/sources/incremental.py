"""Incremental loads as DataFrame transformations, and on partitioned tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexmart.sources.stored import StoredTable


def merge(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Matched rows are replaced by the batch, new ones added; the batch holds one row per key."""
    return target.join(batch.select(*keys), keys, "left_anti").unionByName(batch)


def delete_insert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """All target rows whose key occurs in the batch go, then the whole batch comes in."""
    return target.join(batch.select(key).distinct(), key, "left_anti").unionByName(batch)


def overwrite_static(target: DataFrame, batch: DataFrame, partition: str, values: list[date]) -> DataFrame:
    """Replace exactly the listed partitions, also those for which the batch has no row."""
    listed = F.col(partition).isin(values)
    return target.filter(~listed | F.col(partition).isNull()).unionByName(batch.filter(listed))


def write_partitions(batch: DataFrame, path: str, partition: str) -> None:
    """Replace only the partitions that the batch touches; the other files stay as they are."""
    batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def merge_partitions(path: str, batch: DataFrame, keys: list[str], partition: str, cluster: list[str] | None = None) -> None:
    """Merge on ``keys`` into a stored table, rewriting only the partitions that the batch touches; see :class:`StoredTable`."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema.fields)
    StoredTable(batch.sparkSession, path, partition, schema).merge(batch, keys, cluster)


def last_partitions(as_of: date, n: int) -> list[date]:
    """The last ``n`` days before ``as_of``."""
    return [as_of - timedelta(days=i) for i in range(1, n + 1)]


def day_window(ts: str, as_of: date, days: int) -> Column:
    """Rows of the ``days`` days before ``as_of``, as a plain range on the stamp so that it reaches the scan."""
    first = F.lit(as_of - timedelta(days=days)).cast("timestamp_ntz")
    return (F.col(ts) >= first) & (F.col(ts) < F.lit(as_of).cast("timestamp_ntz"))


def batch_window(ts: str, as_of: date, first_run: bool, old: int = 3, new: int = 1) -> Column:
    """A first run takes ``old`` days, later ones ``new`` days; :meth:`StoredTable.due` decides by what the target holds."""
    return day_window(ts, as_of, old if first_run else new)


def since_high_water(df: DataFrame, target: DataFrame, ts: str) -> DataFrame:
    """Rows at or after the newest stamp of the target; all rows if the target is empty.

    The mark is read once, from one column, and enters the scan as a literal.
    """
    mark = target.agg(F.max(ts)).first()[0]
    return df if mark is None else df.filter(F.col(ts) >= F.lit(mark).cast(df.schema[ts].dataType))

"""Partitioned tables in a folder: what they hold by their listing, and writes that touch only their partitions."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexmart.session import materialize
from hexmart.sources import folders
from hexmart.sources.sinks import cluster_by_cell

# How Spark names the folder of the rows whose partition column is null.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class StoredTable:
    """A Parquet table in ``path``, one folder per value of the column ``partition``.

    Loads replace whole partitions: rows that stay are read from the touched folders alone, the new content is staged in the
    shared folder, and Spark's dynamic overwrite swaps it in, so that files of other partitions are neither read nor written.
    A load that is stopped leaves each partition old or new, and running it again ends in the same table.  The null partition is
    a partition like any other.
    """

    spark: SparkSession
    path: str
    partition: str
    schema: str

    def _folders(self) -> list[str]:
        """Names of the partition folders, from one listing on the driver; no file is opened."""
        return [name for name in folders.subfolders(self.spark, self.path) if name.startswith(f"{self.partition}=")]

    def partitions(self) -> list:
        """The stored partition values, None for null, of the partition column's type."""
        raw = [unquote(name.split("=", 1)[1]) for name in self._folders()]
        kind = self.frame_schema()[self.partition].dataType.simpleString()
        values = [(None if value == NULL_FOLDER else value,) for value in raw]
        typed = self.spark.createDataFrame(values, "v string").select(F.col("v").cast(kind)) if values else None
        return [] if typed is None else [row[0] for row in typed.collect()]

    def newest(self):
        """The largest stored partition value; None if there is none."""
        return max((v for v in self.partitions() if v is not None), default=None)

    def exists(self) -> bool:
        return bool(self._folders())

    def frame_schema(self):
        return self.spark.createDataFrame([], self.schema).schema

    def read(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def within(self, values: list) -> Column:
        """Null-safe membership, as a filter that prunes folders."""
        column, known = F.col(self.partition), [v for v in values if v is not None]
        listed = column.isin(known) if known else F.lit(False)
        return F.coalesce(listed, F.lit(False)) | column.isNull() if None in values else F.coalesce(listed, F.lit(False))

    def _conform(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f.name).cast(f.dataType) for f in self.frame_schema().fields])

    def replace(self, rows: DataFrame, emptied: list | None = None, cluster: list[str] | None = None) -> None:
        """Replace the partitions that ``rows`` has; of the listed ``emptied`` ones those without rows go."""
        rows = self._conform(rows)
        if emptied:
            rows = materialize(rows, "staged")
            left = {row[0] for row in rows.select(self.partition).distinct().collect()}  # one value per partition
            gone = [v for v in emptied if v not in left]
        out = cluster_by_cell(rows, *cluster) if cluster else rows
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.partition).parquet(self.path)
        if emptied and gone:
            self._drop(gone)

    def _drop(self, values: list) -> None:
        held = dict(zip(self.partitions(), self._folders()))
        for value in values:
            if value in held:
                folders.delete(self.spark, f"{self.path}/{held[value]}")

    def _touched(self, rows: DataFrame) -> list:
        """Partition values of ``rows``: one row per partition comes to the driver, as from a listing."""
        return [row[0] for row in rows.select(self.partition).distinct().collect()]

    def merge(self, batch: DataFrame, keys: list[str], cluster: list[str] | None = None) -> None:
        """Matched rows are replaced by the batch, new ones added.  The partition follows from the keys; a key may come once."""
        batch = materialize(self._conform(batch), "batch")
        if not batch.groupBy(*keys).count().filter("count > 1").isEmpty():
            raise ValueError("the batch holds a key more than once")
        touched = self._touched(batch)
        same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys]
        new = batch.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
        kept = self.read().filter(self.within(touched)).join(new, same, "left_anti")
        self.replace(materialize(kept.unionByName(batch), "merged"), cluster=cluster)

    def delete_insert(self, batch: DataFrame, key: str, cluster: list[str] | None = None) -> None:
        """All rows whose key occurs in the batch go, wherever they are stored, then the whole batch comes in.

        The folders that hold such rows are found from the two columns key and partition alone.
        """
        batch = materialize(self._conform(batch), "batch")
        keys = batch.select(F.col(key).alias("_key")).distinct()
        hit = self.read().select(key, self.partition).join(keys, F.col(key) == F.col("_key"), "left_semi")
        touched = list(dict.fromkeys([*self._touched(hit), *self._touched(batch)]))
        kept = self.read().filter(self.within(touched)).join(keys, F.col(key) == F.col("_key"), "left_anti")
        self.replace(materialize(kept.unionByName(batch), "merged"), emptied=touched, cluster=cluster)

    def overwrite_static(self, batch: DataFrame, values: list) -> None:
        """Replace exactly the listed partitions, also those for which the batch has no row."""
        self.replace(self._conform(batch).filter(self.within(values)), emptied=values)

    def overwrite_dynamic(self, batch: DataFrame) -> None:
        """Replace the partitions for which the batch has rows."""
        self.replace(batch)

    def window(self, as_of: date, old: int, new: int) -> tuple[date, date]:
        """Days to load, the last exclusive: without stored partitions the last ``old`` days, else from ``new`` days before the
        newest stored one, so that a target that fell behind catches up."""
        newest = self.newest()
        return (as_of - timedelta(days=old) if newest is None else newest - timedelta(days=new)), as_of

    def due(self, ts: str, as_of: date, old: int = 3, new: int = 1) -> Column:
        """Rows to load for :meth:`window`, as a plain range on the stamp so that it reaches the scan."""
        first, last = self.window(as_of, old, new)
        return (F.col(ts) >= F.lit(first).cast("timestamp_ntz")) & (F.col(ts) < F.lit(last).cast("timestamp_ntz"))

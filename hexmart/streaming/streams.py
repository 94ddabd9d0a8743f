"""Streams: aggregates that refresh themselves, by newest group or by mergeable parts, over a folded history."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hexmart.operators.lookup import json_field_array
from hexmart.sources import folders


def read_stream(spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet", files_per_trigger: int = 100) -> DataFrame:
    """Parquet files of a folder as a stream, a bounded number per micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def _trigger(interval_minutes: int | None) -> dict:
    return {"processingTime": f"{interval_minutes} minutes"} if interval_minutes else {"availableNow": True}


def _write_batches(stream: DataFrame, path: str, checkpoint: str, mode: str, interval_minutes: int | None, made: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Each micro-batch into a folder of its own.  A batch that runs again writes the same folder again, so restarts leave no
    duplicates; one that is folded already was complete and is not run again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        made(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id:012d}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(interval_minutes)).foreachBatch(write).start()


def _state(spark: SparkSession, path: str) -> tuple[int, list[int]]:
    """The batch up to which history is folded (-1: none) and the complete batches after it."""
    number = lambda name: int(name.split("=")[1])
    held = [n for n in folders.subfolders(spark, path) if folders.exists(spark, f"{path}/{n}/_SUCCESS")]
    folded = max((number(n) for n in held if n.startswith("base=")), default=-1)
    return folded, [number(n) for n in held if n.startswith("batch=") and number(n) > folded]


def unfolded(spark: SparkSession, path: str) -> DataFrame:
    """The folded history and the batches after it, with the number of the batch as ``batch``."""
    folded, batches = _state(spark, path)
    out = spark.read.parquet(f"{path}/base={folded:012d}") if folded >= 0 else None
    if batches:
        rows = spark.read.option("basePath", path).parquet(*[f"{path}/batch={b:012d}" for b in batches])
        rows = rows.withColumn("batch", F.col("batch").cast("bigint"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError(f"{path} holds no batch yet")
    return out


def fold(spark: SparkSession, path: str, reduced: Callable[[DataFrame], DataFrame], at_least: int = 1) -> None:
    """Fold history and complete batches into one table, once ``at_least`` batches wait; a batch job beside the stream.

    ``reduced`` keeps one row per key and the column ``batch``.  The new history is complete before what it replaces is
    deleted, and the one before stays for queries that have begun.
    """
    folded, batches = _state(spark, path)
    if len(batches) < at_least:
        return
    reduced(unfolded(spark, path)).write.mode("overwrite").parquet(f"{path}/base={max(batches):012d}")
    for b in batches:
        folders.delete(spark, f"{path}/batch={b:012d}")
    for name in folders.subfolders(spark, path):
        if name.startswith("base=") and int(name.split("=")[1]) < folded:
            folders.delete(spark, f"{path}/{name}")


def auto_refresh(aggregate: DataFrame, path: str, checkpoint: str, interval_minutes: int | None = None) -> StreamingQuery:
    """Keep ``path`` equal to a streaming aggregate: only changed groups are written, under the batch that changed them.

    Without an interval the query handles what is there and stops.
    """
    return _write_batches(aggregate, path, checkpoint, "update", interval_minutes, lambda batch: batch)


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    newest = [F.max_by(F.struct(*values), "batch").alias("_row")] if values else []
    return rows.groupBy(*keys).agg(*newest, F.max("batch").alias("batch")).select(*keys, *[F.col(f"_row.{v}") for v in values], "batch")


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Current state of a table written by :func:`auto_refresh`: per key the row of its newest batch."""
    return _newest(unfolded(spark, path), keys).drop("batch")


def fold_latest(spark: SparkSession, path: str, keys: list[str], at_least: int = 1) -> None:
    fold(spark, path, lambda rows: _newest(rows, keys), at_least)


@dataclass(frozen=True)
class Parts:
    """An aggregate whose parts merge: ``keys`` and, per measure, a kind (count, sum, min, max) and what it is taken of.

    A stream of parts needs no state and no watermark: a row may come years late, it is one more part of its key.
    """

    keys: dict[str, Column]
    measures: dict[str, tuple[str, Column]]

    def _merged(self, rows: DataFrame) -> DataFrame:
        kind = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
        return rows.groupBy(*self.keys).agg(*[kind[k](name).alias(name) for name, (k, _) in self.measures.items()], F.max("batch").alias("batch"))

    def of(self, rows: DataFrame) -> DataFrame:
        """The parts of one batch."""
        kind = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
        return rows.groupBy(*[c.alias(name) for name, c in self.keys.items()]).agg(*[kind[k](c).alias(name) for name, (k, c) in self.measures.items()])

    def stream(self, rows: DataFrame, path: str, checkpoint: str, interval_minutes: int | None = None) -> StreamingQuery:
        """Keep the parts of a stream of rows in ``path``."""
        return _write_batches(rows, path, checkpoint, "append", interval_minutes, self.of)

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        """The aggregate over all rows so far."""
        return self._merged(unfolded(spark, path)).drop("batch")

    def fold(self, spark: SparkSession, path: str, at_least: int = 1) -> None:
        fold(spark, path, self._merged, at_least)


def page_view_parts() -> Parts:
    """Page views by key: hits, first and last stamp."""
    return Parts(
        keys={"session_id": F.col("domain_sessionid"), "anonymous_user_id": F.col("domain_userid"), "page_view_id": F.col("_context.data.id"), "page_url": F.col("page_url")},
        measures={"_hits": ("count", F.lit(1)), "page_view_start": ("min", F.col("derived_tstamp")), "collector_tstamp": ("max", F.col("collector_tstamp"))},
    )


def page_view_stream(events: DataFrame, path: str, checkpoint: str, interval_minutes: int | None = None) -> StreamingQuery:
    """Page views from an event stream, upserted by key; events may come in any order and at any time."""
    data = json_field_array(F.col("contexts"), "struct<data: struct<id: string>>")
    return page_view_parts().stream(events.withColumn("_context", F.explode(data)), path, checkpoint, interval_minutes)


def page_views_so_far(spark: SparkSession, path: str) -> DataFrame:
    views = page_view_parts().read(spark, path)
    hits = (F.col("_hits") * 10).alias("approx_time_on_page")
    return views.select("session_id", "anonymous_user_id", "page_view_id", "page_url", hits, "page_view_start", "collector_tstamp")


def fold_page_views(spark: SparkSession, path: str, at_least: int = 1) -> None:
    page_view_parts().fold(spark, path, at_least)

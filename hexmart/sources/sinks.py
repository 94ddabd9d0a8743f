"""Writing tables: append or replace, layout by cell, and restartable loads in blocks."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from hexmart.session import fresh_path
from hexmart.sources import folders

SRID = 3163


def update_table(
    rows: DataFrame,
    path: str,
    mode: str = "append",
    geometry: str | None = None,
    types: dict[str, str] | None = None,
    rows_per_file: int | None = None,
) -> DataFrame:
    """Append ``rows`` to a stored table or replace it; a batch without rows adds no file.  The rows are made once.

    ``types`` casts columns, ``geometry`` names the geometry column, which is stored as ``geometry`` beside its SRID,
    ``rows_per_file`` bounds the rows written at a time.  Returns the rows as written.
    """
    if mode not in ("append", "replace"):
        raise ValueError("mode is append or replace")
    for column, kind in (types or {}).items():
        rows = rows.withColumn(column, F.col(column).cast(kind))
    if geometry:
        rows = rows.withColumnRenamed(geometry, "geometry").withColumn("srid", F.lit(SRID))
    spark, counter = rows.sparkSession, Observation()
    before = folders.data_files(spark, path) if mode == "append" else set()
    writer = rows.observe(counter, F.count(F.lit(1)).alias("rows")).write.mode("append" if mode == "append" else "overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)
    if mode == "append" and not counter.get["rows"]:
        # Spark leaves a file without rows; what others may have added meanwhile is looked at and stays.
        for name in folders.data_files(spark, path) - before:
            if spark.read.parquet(f"{path}/{name}").isEmpty():
                folders.delete(spark, f"{path}/{name}")
    return rows


def cluster_by_cell(df: DataFrame, cell: str = "cell", *more: str) -> DataFrame:
    """Range layout on the cell: relatives lie together, and scans for a region skip files by their min/max.

    The remaining columns break ties, so that one very frequent cell fills several files instead of one.
    """
    others = [c for c in df.columns if c != cell]
    ties = [F.xxhash64(*others)] if others else []
    return df.repartitionByRange(F.col(cell), *[F.col(c) for c in more], *ties).sortWithinPartitions(cell, *more)


def _read_progress(spark: SparkSession, path: str) -> set[int]:
    try:
        return {row[0] for row in spark.read.parquet(path).select("block").distinct().collect()}
    except AnalysisException:
        return set()


def blocked_load(
    df: DataFrame, path: str, progress_path: str, blocks: int, cell: str = "cell", start: int = 1, at_once: int | None = None
) -> DataFrame:
    """Load ``df`` in ``blocks`` blocks, skipping those already logged; returns the log.

    A block is a share of the cells.  All blocks that are due are written at once, or ``at_once`` per write, so that a stop costs
    that many; either way ``df`` is read once, as several writes take their blocks from one staged copy that is laid out by block.
    Each write replaces just its blocks, so running a block again after a failure leaves no duplicates; its log line
    (block, objects, seconds) is written after its data, with the rows that its files hold.
    """
    spark = df.sparkSession
    done = _read_progress(spark, progress_path)
    todo = [b for b in range(start, blocks + 1) if b not in done]
    if not todo:
        return spark.read.parquet(progress_path)
    block = (F.pmod(F.xxhash64(cell), F.lit(blocks)) + 1).cast("int")
    numbered = df.withColumn("block", block).filter(F.col("block").isin(todo))
    at_once = at_once or len(todo)
    if at_once < len(todo):
        staged = fresh_path(spark, "blocks")
        numbered.hint("rebalance", "block").write.partitionBy("block").parquet(staged)
        numbered = spark.read.schema(numbered.schema).parquet(staged)
    for i in range(0, len(todo), at_once):
        batch, began = todo[i : i + at_once], time.time()
        writer = numbered.filter(F.col("block").isin(batch)).hint("rebalance", "block").write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("block").parquet(path)
        seconds = (time.time() - began) / len(batch)
        listed = spark.createDataFrame([(b,) for b in batch], "block int")
        counts = spark.read.schema(numbered.schema).parquet(path).filter(F.col("block").isin(batch)).groupBy("block").count()
        log = listed.join(counts, "block", "left").select(
            "block", F.coalesce("count", F.lit(0)).alias("objects"), F.lit(round(seconds, 2)).alias("seconds")
        )
        log.write.mode("append").parquet(progress_path)
    return spark.read.parquet(progress_path)

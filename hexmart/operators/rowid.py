"""Dense row numbers without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType

from hexmart.session import materialize

# Spark draws the ranges from a sample of the keys that it gathers on the driver; of a long value it gets this many characters or items.
RANGE_CHARS, RANGE_ITEMS = 64, 8


def _range_keys(df: DataFrame, order: list[str]) -> list[Column]:
    """Short keys that never part the order: equal where long values share their beginning, ordered as ``order`` elsewhere.

    A value that was cut stands after all that are its beginning, and the columns behind it do not count.
    """
    keys, whole = [], F.lit(True)
    for name in order:
        value, kind = F.col(name), df.schema[name].dataType
        if isinstance(kind, (StringType, BinaryType)):
            start, long = F.substring(value, 1, RANGE_CHARS), F.length(value) > RANGE_CHARS
        elif isinstance(kind, ArrayType):
            start, long = F.slice(value, 1, RANGE_ITEMS), F.size(value) > RANGE_ITEMS
        else:
            start, long = value, None
        keys.append(F.when(whole, start))
        if long is not None:
            long = F.coalesce(long, F.lit(False))
            keys.append(F.when(whole, long))
            whole = whole & ~long
    return keys


def dense_row_id(df: DataFrame, order: list[str], out: str = "id") -> DataFrame:
    """Number the rows 1..n in the order of ``order`` (NULLs last), like row_number() over one global window.

    Rows are range-partitioned and written once; only one count per range and a sample of short keys are gathered. Rows whose long
    values share their first ``RANGE_CHARS`` characters meet in one range, where whole values order them.
    Pass enough columns in ``order`` to make it unique: ties, which fall into one range, are then split too.
    """
    keys = [F.col(c).asc_nulls_last() for c in order]
    ranged = df.repartitionByRange(*[k.asc_nulls_last() for k in _range_keys(df, order)]).sortWithinPartitions(*keys)
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = materialize(ranged.withColumn("_range", F.spark_partition_id()).withColumn("_pos", position), "rowid")
    counts = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    # One row per range, so this window is bounded by the number of partitions.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.join(F.broadcast(offsets), "_range")
        .withColumn(out, F.col("_offset") + F.col("_pos") + 1)
        .select(out, *df.columns)
    )

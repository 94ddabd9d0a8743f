"""Mixing sources to target weights by capped water-filling, with DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexmart.llm.frames import fresh_names
from hexmart.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def cycled_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1 .. cycle, repeating, for the sources in code-point order, null last.

    ``sources`` has one row per source, so one task can order it.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    return sources.withColumn("weight", ((F.row_number().over(order) - 1) % cycle + 1).cast("bigint"))


def water_fill(sources: DataFrame, max_epochs: int = 3) -> DataFrame:
    """Targets by weight that share the total size, none above ``max_epochs`` times its source's size.

    A source that is clamped stays clamped while the excess is shared by weight, and sources reach their limit in the
    order of limit / weight. So one pass in that order finds them: a source is clamped if its limit is at most its share of
    what the clamped ones before it leave. ``sources``: source, source_size, weight (positive), one row each. Integers up
    to the one division keep the result the same everywhere.
    """
    cap = F.col("source_size") * max_epochs
    order = Window.orderBy(cap / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before, after, whole = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    ranked = sources.select(
        "source", "source_size", "weight", cap.alias("cap"),
        (F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0))).alias("left"),
        F.sum("weight").over(after).alias("sharing"),
        F.row_number().over(order).alias("place"),
    )
    wide = lambda name: F.col(name).cast("decimal(19,0)")  # noqa: E731  products of two sums overflow a bigint
    clamped = wide("cap") * wide("sharing") <= wide("weight") * wide("left")
    marked = ranked.withColumn("open", F.min(F.when(~clamped, F.col("place"))).over(whole))
    level = F.max(F.when(F.col("place") == F.col("open"), F.struct("left", "sharing"))).over(whole)
    shared = marked.withColumn("level", level)
    target = F.when(F.col("open").isNull() | (F.col("place") < F.col("open")), F.col("cap").cast("double")).otherwise(
        (F.col("weight") * F.col("level.left")).cast("double") / F.col("level.sharing"))
    return shared.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, seed: int = 7, max_epochs: int = 3, cycle: int = 3) -> DataFrame:
    """How often the mix takes each document: doc_id, size, source_size, target, repeats, taken.

    The size of a document is its number of words (null or blank text: 0). Each source gets a target by capped
    water-filling. Every document of a source is taken floor(target / source_size) times; for the rest of the target the
    documents come once more in a seeded order (md5 of seed and doc_id) while at least half of a document still fits, so a
    source's taken words miss its target by half a document at most. Documents of the same id stand in the order of their
    size and are counted one by one. A null source is a source; an empty table gives no rows; other columns are ignored.

    The order is a running sum: sums per (source, bucket of the md5) first, then inside a bucket, whose rows are bounded
    because the number of buckets follows the number of a source's documents. So a source that holds a third of all rows
    is spread over as many tasks as its rows need.
    """
    key = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 15), 16, 10).cast("bigint")
    sized = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("draw")), "mix-sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    filled = water_fill(cycled_weights(sources.select("source", "source_size"), cycle), max_epochs)
    counted = sources.select(F.col("source").alias("s"), "n")
    plan = materialize(filled.join(counted, F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "source_size", "target", F.floor(F.col("n") / BUCKET_ROWS + 1).alias("buckets"),
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).alias("whole"),
    ), "mix-plan").withColumnRenamed("source", "s")
    rows = sized.join(plan, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn(
        "bucket", F.floor(F.col("draw") / F.lit(float(1 << 60)) * F.col("buckets")))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("source", "bucket").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("upto", F.sum("size").over(inside)).join(
        starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    once_more = (F.col("start") + F.col("upto")) * 2 - F.col("size") <= rest * 2
    repeats = (F.col("whole") + F.when(once_more & (rest > 0), 1).otherwise(0)).cast("bigint")
    return placed.select("doc_id", "source", "size", "source_size", "target", repeats.alias("repeats"), (F.col("size") * repeats).alias("taken"))


def take_mix(docs: DataFrame, seed: int = 7, max_epochs: int = 3, cycle: int = 3) -> DataFrame:
    """The documents of the mix: each row of ``docs`` as often as ``mix_sources`` says, with the columns of ``docs``.

    Rows that agree in id, source and size share out their counts among them, in the order of a hash of their texts, so that a rerun takes the same ones. Copies come from exploding a sequence of at
    most ``max_epochs`` numbers. An empty table stays empty.
    """
    key, counts_name, place, copy = fresh_names(docs, 4)
    counts = mix_sources(docs, seed, max_epochs, cycle).groupBy(F.xxhash64("doc_id", "source", "size").alias(key)).agg(
        F.sort_array(F.collect_list("repeats"), False).alias(counts_name))
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "source", word_count(F.col("text")))).join(counts, key)
    placed = keyed.withColumn(place, F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64("text"))))
    repeats = F.element_at(counts_name, F.col(place)).cast("int")
    taken = placed.where(repeats > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), repeats)))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns])

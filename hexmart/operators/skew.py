"""Joins split by measured key weight, and what a cell column looks like."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexmart.functions import cells as C
from hexmart.session import materialize

# A key with more rows than this, or than one ten-thousandth of its table, is spread over several tasks.
ROWS_PER_TASK = 1_000_000
MOST_HEAVY = 10_000


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """(key, _n): rows per key, pre-aggregated on the map side and stored."""
    return materialize(df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")), "key-counts")


def heavy_keys(counts: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK, most: int = MOST_HEAVY) -> DataFrame | None:
    """(key, _ways) for the keys that one task should not carry alone, or None if there are none.

    A key is heavy above ``rows_per_task`` rows or one ``most``-th of all rows, whichever is more.  So fewer than
    ``most`` keys can be heavy at any size, which bounds the broadcast of them, and a task gets a bounded share.
    """
    largest, total = counts.agg(F.max("_n"), F.sum("_n")).first()
    limit = max(rows_per_task, -(-(total or 0) // most))
    if largest is None or largest <= limit:
        return None
    return counts.filter(F.col("_n") > limit).select(key, F.ceil(F.col("_n") / limit).cast("int").alias("_ways"))


def heavy_keys_of(stored: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame | None:
    """:func:`heavy_keys` of a stored table.  Its rows are counted first, by the footers of its files: a table that one task may
    carry has no heavy key."""
    return heavy_keys(key_counts(stored, key), key, rows_per_task) if stored.count() > rows_per_task else None


def weighted_join(
    left: DataFrame, right: DataFrame, on: str, how: str = "inner", left_heavy: DataFrame | None = None, right_heavy: DataFrame | None = None
) -> DataFrame:
    """Equi join on ``on`` in which each heavy key is spread by its own weight; both weights come from :func:`heavy_keys`.

    A left row of a key takes one of the key's left salts by its content and is copied to the key's right salts, a
    right row the other way round, so every pair meets once.  Keys that are not heavy have one salt of each kind.  ``how`` is
    inner or left; a left join splits the left side alone.  Left rows of one key that are equal in all columns stay together.
    """
    if how not in ("inner", "left"):
        raise ValueError("weighted_join keeps the left side: use inner or left")
    if how == "left" and right_heavy is not None:
        raise ValueError("a left join can only split its left side")
    sides, salts = [left, right], []
    for n, heavy in enumerate((left_heavy, right_heavy)):
        if heavy is None:
            continue
        salt = f"_salt{n}"
        salts.append(salt)
        known = F.broadcast(heavy.select(on, "_ways"))  # fewer than MOST_HEAVY rows
        ways = F.coalesce("_ways", F.lit(1))
        for m, side in enumerate(sides):
            own = F.pmod(F.xxhash64(*side.columns), ways).cast("int")
            copies = F.explode(F.sequence(F.lit(0), ways - 1))
            sides[m] = side.join(known, on, "left").withColumn(salt, own if m == n else copies).drop("_ways")
    return sides[0].join(sides[1], [on, *salts], how).drop(*salts)


@dataclass(frozen=True)
class CellProfile:
    """Resolution range of a table, its distinct cells with their rows (``_n``), stored, and those that hold very many."""

    lo: int
    hi: int
    cells: DataFrame = field(compare=False)
    heavy: DataFrame | None = field(default=None, compare=False)


def cell_profile(df: DataFrame, cell: str = "cell", hot_rows: int = ROWS_PER_TASK) -> CellProfile:
    """One pass over the cell column alone, pre-aggregated per cell and stored, so that nothing later needs the table
    again to learn about its cells."""
    counts = key_counts(df.select(F.col(cell).alias("cell")), "cell")
    lo, hi = counts.agg(F.min(C.resolution("cell")), F.max(C.resolution("cell"))).first()
    if lo is None:
        raise ValueError("the table has no cells")
    return CellProfile(lo, hi, counts, heavy_keys(counts, "cell", hot_rows))

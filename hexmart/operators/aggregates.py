"""Aggregates with the NULL and order rules of the source queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from hexmart.functions import cells as C
from hexmart.functions.text import initcap_words
from hexmart.session import wide_rows

# The mean areas are known to 1e-7 km2; sums are rounded there, which also makes them the same in whatever order the
# partial sums meet.
AREA_DIGITS = 7


def area_sum(area: Column) -> Column:
    return F.round(F.sum(area), AREA_DIGITS)


def sum_area(cell: str) -> Column:
    return area_sum(C.cell_area(cell))


def nested_area(cells: list[str]) -> Column:
    """Area shared by nested cells: the smallest of them; an absent context cell does not count."""
    first, *others = [C.cell_area(c) for c in cells]
    infinity = F.lit(float("inf"))
    return F.least(first, *[F.coalesce(a, infinity) for a in others]) if others else first


def sum_area_adaptive(cells: list[str]) -> Column:
    return area_sum(nested_area(cells))


def min_initcap(column: str) -> Column:
    return F.min(initcap_words(F.col(column)))


def array_distinct(column: str) -> Column:
    """Distinct values in ascending order; a NULL among them stands last, once."""
    values = F.sort_array(F.collect_set(column))
    has_null = F.max(F.col(column).isNull())
    return F.when(has_null, F.array_append(values, F.min(F.when(F.col(column).isNull(), F.col(column))))).otherwise(values)


def array_length(column: str) -> Column:
    """Length of :func:`array_distinct`, without building the array."""
    return (F.count_distinct(column) + F.max(F.col(column).isNull().cast("int"))).cast("int")


@dataclass(frozen=True)
class Zones:
    """Rows that stand for cells at ``res`` below the key ``zone``, a cell one level coarser: for all of them where ``at`` is the zone itself, else
    for ``at`` alone.  The fold is made per cell, which is named ``cell`` in the place of the zone."""

    zone: str
    at: str
    res: int
    cell: str


# A task folds groups of about so many bytes of elements at a time, or one larger group.
FOLD_BYTES = 1 << 20


def json_fold(
    df: DataFrame, keys: list[str], fields: dict[str, str], out: str, max_items: int | None = None, part: str = "part", zones: Zones | None = None
) -> DataFrame:
    """Fold detail rows into one JSON array per group, elements sorted, NULL fields kept.

    ``fields`` maps JSON names to columns.  A group is one row.  Rows come group by group in the order of the elements, so a task holds
    the text of one group, however many it has.  If the caller gives ``max_items``, every row has a
    number ``part``, and a group of more elements comes as several rows with the same keys, each with a share of the
    elements, so that no task and no value grows with the largest group; unnesting gives all elements back.  ``df`` is
    then read twice, first for the group sizes alone: pass a stored table.  With ``zones`` a row that stands for several cells is
    one element of each; there is no ``max_items`` then.
    """
    item = F.struct(*[F.col(column).alias(name) for name, column in fields.items()])
    if max_items is None:
        return _folded(df, keys, fields, item, out, zones)
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_size"))
    largest = sizes.agg(F.max("_size")).first()[0] or 0
    placed = df.withColumn("_part", F.lit(0))
    if largest > max_items:
        names = [f"_key{i}" for i in range(len(keys))]
        large = sizes.filter(F.col("_size") > max_items).select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "_size")
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
        share = F.pmod(F.xxhash64(item), F.ceil(F.col("_size") / max_items)).cast("int")
        placed = df.join(large, same, "left").withColumn("_part", F.coalesce(share, F.lit(0)))
    return _folded(placed, [*keys, "_part"], fields, item, out).select(*keys, out, F.col("_part").alias(part))


def _folded(df: DataFrame, keys: list[str], fields: dict[str, str], item: Column, out: str, zones: Zones | None = None) -> DataFrame:
    wide_rows(df.sparkSession)
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*fields.values())) == 1
    at = [] if zones is None else [zones.at]
    rows = df.select(*keys, *at, first.alias("_first"), F.to_json(item, {"ignoreNullFields": "false"}).alias("_item"))
    kinds = StructType([StructField(k, df.schema[k].dataType) for k in keys])
    if zones is not None:
        kinds = kinds.add("_cells", ArrayType(LongType()))
    folded = rows.mapInArrow(_fold_batches(keys, out, zones), kinds.add(out, "string"))
    if zones is None:
        return folded
    others = [k for k in keys if k != zones.zone]
    return folded.select(F.explode("_cells").alias(zones.cell), *others, out)


def _fold_batches(keys: list[str], out: str, zones: Zones | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def texts(items: pa.Array, counts: np.ndarray) -> pa.Array:
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        return pc.binary_join_element_wise("[", pc.binary_join(pa.ListArray.from_arrays(offsets, items), ","), "]", "")

    def whole(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The folds of whole groups."""
        table = pa.Table.from_batches(held).combine_chunks()
        items = pa.concat_arrays(table.column("_item").chunks)
        starts = np.flatnonzero(table.column("_first").to_numpy())
        counts = np.diff(np.append(starts, len(items)))
        heads = table.select(keys).take(pa.array(starts)).combine_chunks()

        def batch(which: np.ndarray, cells: list[pa.Array], text: pa.Array) -> pa.RecordBatch:
            some = heads.take(pa.array(which)).combine_chunks()
            return pa.RecordBatch.from_arrays([*[pa.concat_arrays(c.chunks) for c in some.columns], *cells, text], names=[*keys, *["_cells"] * len(cells), out])

        if zones is None:
            yield batch(np.arange(len(starts)), [], texts(items, counts))
            return
        group, zone, at = np.repeat(np.arange(len(starts)), counts), heads.column(zones.zone).to_numpy(), table.column(zones.at).to_numpy()
        below = np.stack([C.child_ids(zone, digit, zones.res) for digit in range(7)], axis=1)
        there = ~(C.pentagon_ids(zone)[:, None] & (np.arange(7) == 1))  # a pentagon lacks its first child
        shared = at == zone[group]
        digit = np.where(shared, -1, at >> 3 * (C.MAX_RES - zones.res) & 7)
        own = np.zeros((len(starts), 7), bool)
        own[group[~shared], digit[~shared]] = True
        # Cells with rows of their own each have a text; all others of a zone have the same.
        for d in np.flatnonzero(own.any(axis=0)):
            rows = np.flatnonzero(np.where(shared, (own & there)[group, d], digit == d))
            which = np.flatnonzero(own[:, d])
            cells = pa.ListArray.from_arrays(pa.array(np.arange(len(which) + 1, dtype=np.int32)), pa.array(below[which, d]))
            yield batch(which, [cells], texts(items.take(pa.array(rows)), np.bincount(group[rows], minlength=len(starts))[which]))
        rest = there & ~own & (np.bincount(group[shared], minlength=len(starts)) > 0)[:, None]
        which = np.flatnonzero(rest.any(axis=1))
        if len(which):
            rows = np.flatnonzero(shared & rest.any(axis=1)[group])
            ends = np.concatenate([[0], np.cumsum(rest[which].sum(axis=1))]).astype(np.int32)
            cells = pa.ListArray.from_arrays(pa.array(ends), pa.array(below[which][rest[which]]))
            yield batch(which, [cells], texts(items.take(pa.array(rows)), np.bincount(group[rows], minlength=len(starts))[which]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            starts = np.flatnonzero(batch.column("_first").to_numpy(zero_copy_only=False))
            if size >= FOLD_BYTES and len(starts):
                yield from whole([*held, batch.slice(0, starts[0])])
                held, size, batch = [], 0, batch.slice(starts[0])
            held.append(batch)
            size += batch.column("_item").nbytes
        if held:
            yield from whole(held)

    return run

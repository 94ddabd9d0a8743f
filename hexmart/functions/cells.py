"""Arithmetic on 64-bit cell ids as Spark columns.

Layout of an id (public H3 index layout): mode 1 at bit 59, resolution at bit 52, base cell at bit 45, then fifteen
3-bit digits, digit i at bit 3 * (15 - i); digits finer than the resolution are 7.  Everything here is exact on ids of
that layout and stays inside generated code or native higher-order functions.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RES = 15
# Mean cell area in km2 for resolutions 0..15.
MEAN_AREA_KM2 = (
    4250546.8477000, 607220.9782429, 86745.8540347, 12392.2648621, 1770.3235517, 252.9033645, 36.1290521, 5.1612932,
    0.7373276, 0.1053325, 0.0150475, 0.0021496, 0.0003071, 0.0000439, 0.0000063, 0.0000009,
)
# Base cells that are pentagons.
PENTAGONS = (4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117)

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _int(r: Column | int) -> Column:
    return F.lit(r) if isinstance(r, int) else r


def to_cell(hex_id: ColumnOrName) -> Column:
    """Text id to long."""
    return F.conv(_col(hex_id), 16, 10).cast("long")


def to_hex(cell: ColumnOrName) -> Column:
    """Long id to text."""
    return F.lower(F.hex(_col(cell)))


def resolution(cell: ColumnOrName) -> Column:
    return F.shiftright(_col(cell), 52).bitwiseAND(F.lit(15)).cast("int")


def base_cell(cell: ColumnOrName) -> Column:
    return F.shiftright(_col(cell), 45).bitwiseAND(F.lit(127)).cast("int")


def digit(cell: ColumnOrName, i: int) -> Column:
    return F.shiftright(_col(cell), 3 * (MAX_RES - i)).bitwiseAND(F.lit(7)).cast("int")


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b).cast("long"))


def _low_ones(bits: Column | int) -> Column:
    """A long whose lowest ``bits`` bits are set."""
    if isinstance(bits, int):
        return F.lit((1 << bits) - 1).cast("long")
    return F.call_function("shiftleft", F.lit(1).cast("long"), bits) - F.lit(1)


def _free_bits(r: Column | int) -> Column | int:
    """How many bits lie below the digits of resolution ``r``."""
    return 3 * (MAX_RES - r) if isinstance(r, int) else F.lit(3) * (F.lit(MAX_RES) - r)


def _res_bits(r: Column | int) -> Column:
    if isinstance(r, int):
        return F.lit(r << 52).cast("long")
    return F.shiftleft(r.cast("long"), 52)


def parent(cell: ColumnOrName, r: Column | int) -> Column:
    """Ancestor-or-self at resolution ``r``; the caller keeps ``r`` at or below the cell's own resolution."""
    without_res = _col(cell).bitwiseAND(F.lit(~(15 << 52)))
    return without_res.bitwiseOR(_res_bits(r)).bitwiseOR(_low_ones(_free_bits(r)))


def is_pentagon(cell: ColumnOrName) -> Column:
    c = _col(cell)
    digits = c.bitwiseAND(F.lit((1 << 45) - 1))
    return base_cell(c).isin(*PENTAGONS) & (digits == _low_ones(_free_bits(resolution(c))))


def children(cell: ColumnOrName, r: int | None = None) -> Column:
    """Array of descendants at resolution ``r`` (direct children if omitted).

    Empty if ``r`` is coarser than the cell, the cell itself if equal.  A pentagon lacks every descendant whose first
    non-zero digit below it is 1.  Arrays hold 7^(r - res) ids; see :func:`explode_children` for large steps.
    """
    c = _col(cell)
    res = resolution(c)
    prefix = c.bitwiseAND(F.bitwise_not(_low_ones(_free_bits(res)))).bitwiseAND(F.lit(~(15 << 52)))
    no_cells = F.array().cast("array<long>")
    if r is None:
        made = F.transform(
            F.sequence(F.lit(0).cast("long"), F.lit(6).cast("long")),
            lambda k: prefix.bitwiseOR(_res_bits(res + 1))
            .bitwiseOR(F.call_function("shiftleft", k, F.lit(3) * (F.lit(MAX_RES - 1) - res)))
            .bitwiseOR(_low_ones(F.lit(3) * (F.lit(MAX_RES - 1) - res))),
        )
        made = F.when(is_pentagon(c), F.concat(F.slice(made, 1, 1), F.slice(made, 3, 5))).otherwise(made)
        return F.when(res < MAX_RES, made).otherwise(no_cells)

    depth = F.lit(r) - res
    powers = F.array(*[F.lit(7**n).cast("long") for n in range(r + 1)])
    count = F.get(powers, depth)
    packed = F.when(depth <= TABLE_DEPTH, F.slice(_packed_table(), 1, count.cast("int")))
    if r > TABLE_DEPTH:
        numbers = F.sequence(F.lit(0).cast("long"), count - 1)
        packed = packed.otherwise(F.transform(numbers, lambda k: _packed(k, r)))

    def led_by_one(p: Column) -> Column:
        return reduce(Column.__or__, [(p >= 8**m) & (p < 2 * 8**m) for m in range(r)], F.lit(False))

    packed = F.when(is_pentagon(c), F.filter(packed, lambda p: ~led_by_one(p))).otherwise(packed)
    head = prefix.bitwiseOR(_res_bits(r)).bitwiseOR(_low_ones(_free_bits(r)))
    made = F.transform(packed, lambda p: head.bitwiseOR(F.shiftleft(p, 3 * (MAX_RES - r))))
    return F.when(res <= r, made).otherwise(no_cells)


def child_ids(cells: np.ndarray, digit: int, r: int) -> np.ndarray:
    """The children at ``r`` with this digit of cells one level coarser, in NumPy."""
    above = 3 * (MAX_RES - r + 1)
    return cells & ~((1 << above) - 1) & ~(15 << 52) | r << 52 | digit << above - 3 | (1 << above - 3) - 1


def pentagon_ids(cells: np.ndarray) -> np.ndarray:
    """:func:`is_pentagon` in NumPy."""
    free = (np.int64(1) << 3 * (MAX_RES - (cells >> 52 & 15))) - 1
    return np.isin(cells >> 45 & 127, PENTAGONS) & ((cells & (1 << 45) - 1) == free)


# Up to this many levels the digits of all descendants come from one constant array.
TABLE_DEPTH = 3


def _packed(k: Column, digits: int) -> Column:
    """The base-7 digits of ``k`` as 3-bit groups."""
    out = F.lit(0).cast("long")
    for n in range(digits):
        out = out.bitwiseOR(F.shiftleft(F.pmod(_div(k, 7**n), F.lit(7)).cast("long"), 3 * n))
    return out


def _packed_table() -> Column:
    packed = [sum((k // 7**n % 7) << 3 * n for n in range(TABLE_DEPTH)) for k in range(7**TABLE_DEPTH)]
    return F.expr(f"array({', '.join(f'{p}L' for p in packed)})")


def explode_children(df: DataFrame, cell: str, r: int, out: str, step: int = TABLE_DEPTH) -> DataFrame:
    """One row per descendant at ``r``, replacing nothing: the new column is ``out``.

    Wide gaps are bridged in steps of ``step`` levels so that no row ever holds more than 7^step ids.  Rows finer than
    ``r`` give no output.
    """
    df = df.filter(resolution(cell) <= r).withColumn(out, F.col(cell))
    for mid in [*range(r % step, r, step), r]:
        if mid > 0 and step <= TABLE_DEPTH:
            df = _explode_step(df, mid, out, step)
        elif mid > 0:
            grown = F.when(resolution(out) < mid, children(out, mid)).otherwise(F.array(F.col(out)))
            df = df.withColumn(out, F.explode(grown))
    return df


def _explode_step(df: DataFrame, mid: int, out: str, step: int) -> DataFrame:
    """Cells coarser than ``mid``, by ``step`` levels at most, become their descendants there.  Digits are exploded and put into the id afterwards,
    in generated code."""
    c, digits = F.col(out), F.col("_digits")
    res = resolution(c)
    count = F.coalesce(F.get(F.array(*[F.lit(7**n) for n in range(step + 1)]), F.greatest(F.lit(mid) - res, F.lit(0))), F.lit(0))
    head = c.bitwiseAND(F.bitwise_not(_low_ones(_free_bits(res)))).bitwiseAND(F.lit(~(15 << 52))).bitwiseOR(_res_bits(mid)).bitwiseOR(_low_ones(_free_bits(mid)))
    led_by_one = reduce(Column.__or__, [(digits >= 8**m) & (digits < 2 * 8**m) for m in range(step)])
    lacking = (res < mid) & is_pentagon(c) & led_by_one
    made = F.when(res < mid, head.bitwiseOR(F.shiftleft(digits, 3 * (MAX_RES - mid)))).otherwise(c)
    grown = df.withColumn("_digits", F.explode(F.slice(_packed_table(), F.lit(1), count)))
    return grown.filter(~lacking).withColumn(out, made).drop("_digits")


def normalize(df: DataFrame, cell: str, r: int, out: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Bring a table of mixed resolutions to ``r``: finer rows go to their ancestor, coarser ones to all descendants.

    ``lo`` and ``hi`` are the table's resolution range where it is known; they only spare work.
    """
    if lo is not None and lo >= r:
        return df.withColumn(out, parent(cell, r))
    fine = F.when(resolution(cell) >= r, parent(cell, r)).otherwise(F.col(cell))
    return explode_children(df.withColumn("_fine", fine), "_fine", r, out).drop("_fine")


def mean_area(r: Column | int) -> Column:
    """Mean cell area in km2 at resolution ``r``."""
    return F.get(F.array(*[F.lit(a) for a in MEAN_AREA_KM2]), _int(r))


def cell_area(cell: ColumnOrName) -> Column:
    return mean_area(resolution(cell))


def thresholds(min_unit_m: float) -> list[float]:
    """Share per resolution from which one class fills a cell, for a smallest mapped detail of ``min_unit_m`` metres."""
    return [max(0.0, 1 - min_unit_m**2 / 1_000_000 / area) for area in MEAN_AREA_KM2]


def threshold(min_unit_m: ColumnOrName, r: ColumnOrName) -> Column:
    """The same rule on columns."""
    unit = _col(min_unit_m)
    return F.greatest(F.lit(0.0), F.lit(1.0) - unit * unit / F.lit(1_000_000.0) / mean_area(_col(r)))

"""A planar hexagon grid with the cell-id layout of :mod:`hexmart.functions.cells`, in metres.

The grid lies in the projected plane in which all areas are measured.  Each level refines the one above by seven
(digit 0 keeps the centre, digits 1..6 are its neighbours) and is turned by asin(sqrt(3/28)), alternately to either
side.  Level 0 has the mean area of the public grid's resolution 0, so every level matches its mean area.  Ids are not
equal to those of the grid on the globe; both share the same ancestry arithmetic.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from hexmart.functions import cells as C

ORIGIN = (400_000.0, 300_000.0)
TURN = math.asin(math.sqrt(3 / 28))
# Distance between neighbouring centres at resolution 0, from the hexagon area formula A = sqrt(3)/2 * s^2.
SPACING_0 = math.sqrt(C.MEAN_AREA_KM2[0] * 1e6 * 2 / math.sqrt(3))
ROWS, COLS = 10, 11
# The grid uses no base cell that the id layout reserves for pentagons.
BASE_CELLS = [b for b in range(122) if b not in C.PENTAGONS]
# Lattice steps of digits 0..6 in axial coordinates (i, j): the centre, then the neighbours counter-clockwise.
STEPS = [(0, 0), (1, 0), (0, 1), (-1, 1), (-1, 0), (0, -1), (1, -1)]


def spacing(r: int) -> float:
    return SPACING_0 / math.sqrt(7) ** r


def cell_area_m2(r: int) -> float:
    return SPACING_0**2 * math.sqrt(3) / 2 / 7**r


def turn(r: int) -> float:
    return TURN if r % 2 else 0.0


def axial_to_metres(i: float, j: float, r: int) -> tuple[float, float]:
    s, a = spacing(r), turn(r)
    return (
        s * (i * math.cos(a) + j * math.cos(a + math.pi / 3)),
        s * (i * math.sin(a) + j * math.sin(a + math.pi / 3)),
    )


def digit_offsets(r: int) -> list[tuple[float, float]]:
    """Offset in metres of digits 0..6 at level ``r``."""
    return [axial_to_metres(i, j, r) for i, j in STEPS]


def base_centres() -> list[tuple[float, float]]:
    """Centre of each base cell number 0..121 (the reserved ones stay at the origin and never occur)."""
    centres = [ORIGIN] * 122
    for n, number in enumerate(BASE_CELLS):
        x, y = axial_to_metres(n // COLS - ROWS // 2, n % COLS - COLS // 2, 0)
        centres[number] = (ORIGIN[0] + x, ORIGIN[1] + y)
    return centres


def _double_array(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def centre(cell: str | Column) -> tuple[Column, Column]:
    """Centre (x, y) of a cell: the base cell's plus one table look-up per digit."""
    c = F.col(cell) if isinstance(cell, str) else cell
    both = _centre(c)
    return both.x, both.y


def _centre(c: Column) -> Column:
    x_of, y_of = [F.array(*[_double_array([p[axis] for p in digit_offsets(r)]) for r in range(C.MAX_RES + 1)]) for axis in (0, 1)]
    base = C.base_cell(c)
    start = F.struct(
        F.get(_double_array([p[0] for p in base_centres()]), base).alias("x"),
        F.get(_double_array([p[1] for p in base_centres()]), base).alias("y"),
    )
    res = C.resolution(c)
    levels = F.when(res > 0, F.sequence(F.lit(1), res)).otherwise(F.array().cast("array<int>"))

    def add(total: Column, level: Column) -> Column:
        d = F.call_function("shiftright", c, F.lit(3) * (F.lit(C.MAX_RES) - level)).bitwiseAND(F.lit(7)).cast("int")
        return F.struct(
            (total.x + F.get(F.get(x_of, level), d)).alias("x"), (total.y + F.get(F.get(y_of, level), d)).alias("y")
        )

    return F.aggregate(levels, start, add)


def axial_centre(i: Column, j: Column, r: Column) -> tuple[Column, Column]:
    """Centre (x, y) of lattice coordinates at level ``r``."""
    out = []
    for axis in (0, 1):
        along_i = F.get(_double_array([axial_to_metres(1, 0, n)[axis] for n in range(C.MAX_RES + 1)]), r)
        along_j = F.get(_double_array([axial_to_metres(0, 1, n)[axis] for n in range(C.MAX_RES + 1)]), r)
        out.append(i * along_i + j * along_j + ORIGIN[axis])
    return out[0], out[1]


def corners(x: Column, y: Column, r: Column) -> Column:
    """Closed ring of a hexagon around (x, y) at resolution ``r``, counter-clockwise."""
    dx, dy = [], []
    for level in range(C.MAX_RES + 1):
        radius = spacing(level) / math.sqrt(3)
        angles = [turn(level) + math.pi / 6 + k * math.pi / 3 for k in range(6)]
        dx.append(_double_array([radius * math.cos(a) for a in [*angles, angles[0]]]))
        dy.append(_double_array([radius * math.sin(a) for a in [*angles, angles[0]]]))
    return F.zip_with(
        F.get(F.array(*dx), r), F.get(F.array(*dy), r), lambda a, b: F.struct((x + a).alias("x"), (y + b).alias("y"))
    )


def boundary(cell: str | Column) -> Column:
    """Boundary ring of a cell as array<struct<x, y>>."""
    c = F.col(cell) if isinstance(cell, str) else cell
    res = C.resolution(c)
    return F.get(F.transform(F.array(_centre(c)), lambda p: corners(p.x, p.y, res)), 0)


def nearest_axial(x: Column, y: Column, r: Column) -> Column:
    """Axial coordinates struct<i, j> of the cell at level ``r`` around a point."""
    s = F.get(_double_array([spacing(n) for n in range(C.MAX_RES + 1)]), r)
    a = F.when(r % 2 == 1, F.lit(TURN)).otherwise(F.lit(0.0))
    u = ((x - ORIGIN[0]) * F.cos(a) + (y - ORIGIN[1]) * F.sin(a)) / s
    v = ((y - ORIGIN[1]) * F.cos(a) - (x - ORIGIN[0]) * F.sin(a)) / s
    fj = v * (2 / math.sqrt(3))
    fi = u - fj / 2
    # Round the three cube coordinates and correct the one that moved most.
    parts = F.struct(fi.alias("i"), fj.alias("j"), (-fi - fj).alias("k"))

    def rounded(p: Column) -> Column:
        i, j, k = F.round(p.i), F.round(p.j), F.round(p.k)
        di, dj, dk = F.abs(i - p.i), F.abs(j - p.j), F.abs(k - p.k)
        i_moved = (di > dj) & (di > dk)
        j_moved = ~i_moved & (dj > dk)
        return F.struct(
            F.when(i_moved, -j - k).otherwise(i).cast("long").alias("i"),
            F.when(j_moved, -i - k).otherwise(j).cast("long").alias("j"),
        )

    return F.get(F.transform(F.array(parts), rounded), 0)


def encode(axial: Column, r: Column) -> Column:
    """Cell id of axial coordinates struct<i, j> at level ``r``; NULL outside the base patch.

    Walks up one level at a time: the residue of the lattice point modulo the level's factor names the digit, the rest
    divides exactly.
    """
    # Digit per residue modulo 7 of i + 3j (odd levels) and i + 5j (even levels).
    digit_of = {}
    for k in (3, 5):
        table = [0] * 7
        for d, (i, j) in enumerate(STEPS):
            table[(i + k * j) % 7] = d
        digit_of[k] = F.array(*[F.lit(d) for d in table])
    step_i = F.array(*[F.lit(s[0]).cast("long") for s in STEPS])
    step_j = F.array(*[F.lit(s[1]).cast("long") for s in STEPS])

    def with_digit(acc: Column, level: Column) -> Column:
        odd = level % 2 == 1
        d = F.when(odd, F.get(digit_of[3], F.pmod(acc.i + 3 * acc.j, F.lit(7)).cast("int"))).otherwise(
            F.get(digit_of[5], F.pmod(acc.i + 5 * acc.j, F.lit(7)).cast("int"))
        )
        return F.struct(acc.i.alias("i"), acc.j.alias("j"), acc.bits.alias("bits"), d.alias("d"))

    def up(acc: Column, level: Column) -> Column:
        odd = level % 2 == 1
        i, j = acc.i - F.get(step_i, acc.d), acc.j - F.get(step_j, acc.d)
        pi = F.when(odd, 2 * i - j).otherwise(3 * i + j)
        pj = F.when(odd, i + 3 * j).otherwise(2 * j - i)
        bits = acc.bits.bitwiseOR(F.call_function("shiftleft", acc.d.cast("long"), F.lit(3) * (F.lit(C.MAX_RES) - level)))
        return F.struct(
            F.call_function("div", pi, F.lit(7).cast("long")).alias("i"),
            F.call_function("div", pj, F.lit(7).cast("long")).alias("j"),
            bits.alias("bits"),
        )

    def level_up(acc: Column, level: Column) -> Column:
        return F.get(F.transform(F.array(with_digit(acc, level)), lambda a: up(a, level)), 0)

    start = F.struct(axial.i.alias("i"), axial.j.alias("j"), F.lit(0).cast("long").alias("bits"))
    levels = F.when(r > 0, F.sequence(r, F.lit(1), F.lit(-1))).otherwise(F.array().cast("array<int>"))

    def finish(acc: Column) -> Column:
        a, b = acc.i + ROWS // 2, acc.j + COLS // 2
        number = F.get(F.array(*[F.lit(n) for n in BASE_CELLS]), (a * COLS + b).cast("int"))
        inside = a.between(0, ROWS - 1) & b.between(0, COLS - 1)
        head = F.lit(1 << 59).bitwiseOR(F.shiftleft(r.cast("long"), 52)).bitwiseOR(F.shiftleft(number.cast("long"), 45))
        free = F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(3) * (F.lit(C.MAX_RES) - r)) - 1
        return F.when(inside, head.bitwiseOR(acc.bits).bitwiseOR(free))

    return F.aggregate(levels, start, level_up, finish)


def cell_at(x: Column, y: Column, r: int | Column) -> Column:
    """Id of the cell at resolution ``r`` that holds a point."""
    level = F.lit(r) if isinstance(r, int) else r
    return encode(nearest_axial(x, y, level), level)

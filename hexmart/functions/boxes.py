"""Boxes over cell tables: a cover of a box by ranges of cell ids, which a scan can skip files by, and the exact test."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexmart.functions import cells as C
from hexmart.functions import grid as G

# The hexagons of all descendants of a cell lie within this many spacings of its centre.
REACH = 0.61
MOST_CELLS = 48


@dataclass(frozen=True)
class Box:
    xmin: float
    ymin: float
    xmax: float
    ymax: float

    def _apart(self, x: float, y: float) -> float:
        return math.hypot(max(self.xmin - x, x - self.xmax, 0.0), max(self.ymin - y, y - self.ymax, 0.0))

    def _inside(self, x: float, y: float, reach: float) -> bool:
        return self.xmin <= x - reach and x + reach <= self.xmax and self.ymin <= y - reach and y + reach <= self.ymax

    def cover(self, finest: int, most: int = MOST_CELLS) -> list[int]:
        """At most some ``most`` cells, down to level ``finest``, below which every cell of that level lies whose hexagon meets the box.

        Cells at the rim are split, the coarsest first, as long as there is room for their children; a box of any size costs the
        driver a few thousand steps.
        """
        near = lambda r, x, y: self._apart(x, y) <= REACH * G.spacing(r)
        centres = G.base_centres()
        rim = [(0, (1 << 59) | (b << 45) | ((1 << 45) - 1), *centres[b]) for b in G.BASE_CELLS if near(0, *centres[b])]
        done: list[int] = []
        while rim:
            level, cell, x, y = rim.pop(0)
            if level == finest or self._inside(x, y, REACH * G.spacing(level)):
                done.append(cell)
                continue
            shift = 3 * (C.MAX_RES - level - 1)
            below = (cell & ~(15 << 52) & ~(7 << shift)) | ((level + 1) << 52)
            offsets = G.digit_offsets(level + 1)
            children = [(level + 1, below | (d << shift), x + dx, y + dy) for d, (dx, dy) in enumerate(offsets)]
            children = [c for c in children if near(level + 1, c[2], c[3])]
            if len(done) + len(rim) + len(children) > most and len(children) > 1:
                done.append(cell)
            else:
                rim += children
        return done

    def ranges(self, lo: int, hi: int, most: int = MOST_CELLS) -> list[tuple[int, int]]:
        """Ranges of ids, both ends included, for a table with cells of the levels ``lo`` to ``hi``; sorted, without repeats."""
        out = set()
        for r in range(lo, hi + 1):
            # A cover of its own for each level: a coarse cell may meet the box with a rim where none of its descendants lie.
            for cell in self.cover(r, most):
                level = cell >> 52 & 15
                free = 3 * (C.MAX_RES - level)
                head = (cell & ~(15 << 52) | (r << 52)) >> free << free
                unused = (1 << 3 * (C.MAX_RES - r)) - 1
                sixes = sum(6 << 3 * (C.MAX_RES - n) for n in range(level + 1, r + 1))
                out.add((head | unused, head | sixes | unused))
        return sorted(out)

    def holds_id(self, cell: str, lo: int, hi: int, most: int = MOST_CELLS) -> Column:
        """Whether an id is in the cover: plain comparisons with literals, so they reach a Parquet scan."""
        tests = [F.col(cell) == low if low == high else (F.col(cell) >= low) & (F.col(cell) <= high) for low, high in self.ranges(lo, hi, most)]
        while len(tests) > 1:  # a balanced tree: hundreds of tests in a chain would be as deep as they are many
            tests = [tests[n] | tests[n + 1] if n + 1 < len(tests) else tests[n] for n in range(0, len(tests), 2)]
        return tests[0] if tests else F.lit(False)

    def meets(self, cell: str) -> Column:
        """Whether the hexagon of a cell and the box have a point in common: no axis of either keeps them apart."""
        x, y = G.centre(cell)
        centre = F.array(F.struct(x.alias("x"), y.alias("y")))
        return F.get(F.transform(centre, lambda p: self._touches(p.x, p.y, C.resolution(cell))), 0)  # the centre is worked out once

    def _touches(self, x: Column, y: Column, res: Column) -> Column:
        dx, dy = x - (self.xmin + self.xmax) / 2, y - (self.ymin + self.ymax) / 2
        w, h = (self.xmax - self.xmin) / 2, (self.ymax - self.ymin) / 2

        def by_level(value) -> Column:
            return F.get(F.array(*[F.lit(float(value(r))) for r in range(C.MAX_RES + 1)]), res)

        together = F.lit(True)
        for ax, ay in ((1.0, 0.0), (0.0, 1.0)):
            widest = by_level(lambda r: max(abs(ax * cx + ay * cy) for cx, cy in _corners(r)))  # noqa: B023
            together = together & (F.abs(dx * ax + dy * ay) <= widest + w * ax + h * ay)
        for k in range(3):
            nx, ny = by_level(lambda r: math.cos(G.turn(r) + k * math.pi / 3)), by_level(lambda r: math.sin(G.turn(r) + k * math.pi / 3))  # noqa: B023
            together = together & (F.abs(dx * nx + dy * ny) <= by_level(lambda r: G.spacing(r) / 2) + F.abs(nx) * w + F.abs(ny) * h)
        return together


def _corners(r: int) -> list[tuple[float, float]]:
    radius = G.spacing(r) / math.sqrt(3)
    return [(radius * math.cos(G.turn(r) + math.pi / 6 + k * math.pi / 3), radius * math.sin(G.turn(r) + math.pi / 6 + k * math.pi / 3)) for k in range(6)]


def cells_in_box(df: DataFrame, box: Box, lo: int, hi: int, cell: str = "cell", most: int = MOST_CELLS) -> DataFrame:
    """Rows whose cell meets the box, of a table with cells of the levels ``lo`` to ``hi``.

    On a table laid out by cell (:func:`hexmart.sources.sinks.cluster_by_cell`) the id ranges skip most of its files; what
    is left is tested exactly.
    """
    return df.filter(box.holds_id(cell, lo, hi, most)).filter(box.meets(cell))

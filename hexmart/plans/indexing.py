"""Indexing polygon layers on the grid: uniform, as a mesh, and adaptive."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexmart.functions import cells as C
from hexmart.functions import grid as G
from hexmart.operators.rings import Decide, Rejects, cut, descend, settle
from hexmart.operators.rowid import dense_row_id
from hexmart.session import materialize, replace_stored, ways
from hexmart.sources.sinks import cluster_by_cell

# Slack for sums of areas: two roundings of the same area may differ by this share of a cell.
SLACK = 1e-9
SHARE_DIGITS = 9
MESH_MARGIN = 0.6
# An adaptive index leaves the levels below to single tasks once each has so many groups to settle; a group of more points goes on by itself.
GROUPS_PER_TASK = 64
GROUP_POINTS = 1 << 18


def _attributes(df: DataFrame, geometry: str) -> list[str]:
    return [c for c in df.columns if c != geometry]


def _numbered(df: DataFrame, geometry: str) -> tuple[DataFrame, DataFrame]:
    """(polygons, attributes): ``_row`` with the geometry, and ``_row`` with the other columns in a struct.

    The numbers are written before anything is shuffled, so a task that runs again cannot give the rings of one polygon
    two numbers, and equal rows stay two polygons.
    """
    attributes = _attributes(df, geometry)
    stored = materialize(df.select(F.monotonically_increasing_id().alias("_row"), F.struct(*attributes).alias("_attributes"), geometry), "polygons")
    return stored.select("_row", "_attributes", geometry), stored.select("_row", "_attributes")


def _named(cells: DataFrame, attributes: DataFrame, *columns: str) -> DataFrame:
    """Cells per ``_row`` with the polygon's attributes.

    A polygon may own very many cells; the cells come shuffled by the join's own exchange, so adaptive execution splits them. Spark
    cannot know how many cells a cut yields and would take them for few, so neither side is left to be broadcast.
    """
    return cells.join(attributes.hint("merge"), "_row").select(*columns, "_attributes.*")


def polyfill(df: DataFrame, r: int, key: str, geometry: str = "geometry", rejects: Rejects | None = None) -> DataFrame:
    """(key, cell) for the cells at ``r`` whose centre lies in the polygon; each row of ``df`` is a polygon of its own."""
    return index_uniform(df.select(key, geometry), r, key, geometry, rejects).select(key, "cell")


def index_uniform(df: DataFrame, r: int, key: str, geometry: str = "geometry", rejects: Rejects | None = None) -> DataFrame:
    """One row per cell and polygon with the polygon's attributes in place of its geometry; rows of one key stay apart.

    Only a number travels with the pieces; attributes join the cells at the end.
    """
    polygons, attributes = _numbered(df, geometry)
    pieces = cut(polygons, ["_row"], r, geometry, fragments=False, rejects=rejects, measures=("winding",))
    turns = pieces.groupBy("_row", "cell").agg(F.sum(F.col("sign") * F.col("winding")).alias("_turns"))
    return _named(turns.filter("_turns > 0.5"), attributes, "cell")


def mesh(df: DataFrame, r: int, geometry: str = "geometry", rejects: Rejects | None = None) -> DataFrame:
    """Cells at ``r`` whose centre lies within 0.6 sqrt(area) of any polygon."""
    return _near(cut(df, [], r, geometry, fragments=False, rejects=rejects, measures=("winding", "distance")), r)


def _near(pieces: DataFrame, r: int) -> DataFrame:
    margin = MESH_MARGIN * math.sqrt(G.cell_area_m2(r))
    # Each polygon around the centre adds one turn, however many rings it has; so one sum serves the union of all.
    per_cell = pieces.groupBy("cell").agg(
        F.sum(F.col("sign") * F.col("winding")).alias("_turns"), F.min("distance").alias("_distance")
    )
    return per_cell.filter((F.col("_turns") > 0.5) | (F.col("_distance") <= margin)).select("cell")


def overlap_area(
    df: DataFrame, r: int, key: str, geometry: str = "geometry", targets: DataFrame | None = None, rejects: Rejects | None = None
) -> DataFrame:
    """(key, cell, area in m2) for every polygon and cell at ``r`` that overlap; only ``targets``, if given.

    Each row of ``df`` is a polygon of its own: rows that share a key, or have none, give a row each.
    """
    polygons, attributes = _numbered(df.select(key, geometry), geometry)
    pieces = cut(polygons, ["_row"], r, geometry, fragments=False, rejects=rejects, measures=("area",))
    if targets is not None:
        pieces = pieces.join(targets.select("cell").distinct(), "cell", "left_semi")
    areas = pieces.groupBy("_row", "cell").agg(F.sum(F.col("sign") * F.col("area")).alias("area"))
    return _named(areas.filter(F.col("area") > SLACK * G.cell_area_m2(r)), attributes, "cell", "area").select(key, "cell", "area")


def clip_to_cells(df: DataFrame, r: int, key: str, geometry: str = "geometry", rejects: Rejects | None = None) -> DataFrame:
    """(key, cell, ring, hole): the rings of each polygon clipped to each cell at ``r``."""
    pieces = cut(df.select(key, geometry), [key], r, geometry, exact=True, rejects=rejects, measures=("area",))
    ring = F.zip_with("xs", "ys", lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    solid = F.abs(F.col("area")) > SLACK * G.cell_area_m2(r)
    return pieces.filter(solid).select(key, "cell", ring.alias("ring"), (F.col("sign") * F.signum("area") < 0).alias("hole"))


def class_share(df: DataFrame, column: str, r: int, geometry: str = "geometry", rejects: Rejects | None = None) -> DataFrame:
    """(cell, class, share of the cell's area); polygons without a class do not count."""
    pieces = cut(df.filter(F.col(column).isNotNull()), [column], r, geometry, fragments=False, rejects=rejects, measures=("area",))
    return _shares(pieces, column, r)


def _shares(pieces: DataFrame, column: str, r: int) -> DataFrame:
    area = F.sum(F.col("sign") * F.col("area"))
    shares = pieces.groupBy("cell", column).agg((area / G.cell_area_m2(r)).alias("share"))
    return shares.filter(F.col("share") > SLACK)


def _decide(shares: DataFrame, column: str, r: int, last: bool, tx: list[float], tx_spatial: float) -> DataFrame:
    """One row per cell: its leading class and whether it is valid, to subdivide, or to drop.

    The larger share leads, then the smaller class: the least pair of negated share and class, in one aggregate.
    """
    leading = F.struct((-F.round("share", SHARE_DIGITS)).alias("order"), F.col(column).alias("leader"))
    cells = shares.groupBy("cell").agg(
        F.min(leading).alias("_first"), F.max("share").alias("_top"), F.sum("share").alias("_sum")
    ).withColumn(column, F.col("_first.leader"))
    if last:
        state = F.when(F.col("_sum") >= tx_spatial - SLACK, "valid").otherwise("drop")
    else:
        state = (
            F.when(F.col("_sum") < 1 - tx[r] - SLACK, "drop")
            .when(F.col("_top") >= tx[r] - SLACK, "valid")
            .otherwise("open")
        )
    return cells.select("cell", column, state.alias("_state"))


def _decide_partition(tx: list[float], tx_spatial: float, res_max: int) -> Decide:
    """:func:`_shares` and :func:`_decide` for groups of pieces in NumPy; classes are numbered in their order."""

    def decide(r: int, group: np.ndarray, kind: np.ndarray, measures: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, width = int(group[-1]) + 1, int(kind.max()) + 1
        pairs, stands, of = np.unique(group * width + kind, return_index=True, return_inverse=True)
        share = np.bincount(of, weights=measures["area"]) / G.cell_area_m2(r)
        keep = share > SLACK
        pairs, stands, share = pairs[keep], stands[keep], share[keep]
        own, total, top, first = pairs // width, np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
        np.add.at(total, own, share)
        np.maximum.at(top, own, share)
        order = np.lexsort((pairs, -np.round(share, SHARE_DIGITS), own))
        some, leads = np.unique(own[order], return_index=True)
        first[some] = stands[order[leads]]
        there = np.zeros(n, bool)
        there[some] = True
        if r == res_max:
            return there & (total >= tx_spatial - SLACK), np.zeros(n, bool), first
        there &= total >= 1 - tx[r] - SLACK
        full = top >= tx[r] - SLACK
        return there & full, there & ~full, first

    return decide


def _decide_objects(limits: list[float], measures: tuple[str, ...], res_max: int) -> Decide:
    def decide(r: int, group: np.ndarray, kind: np.ndarray, sums: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        full = G.cell_area_m2(r)
        area, wide = (np.bincount(group, weights=sums[name]) for name in ("area", measures[-1]))
        touched = wide > 1e-12 * full
        valid = touched & (area >= limits[r] * full - SLACK * full)
        return valid, touched & ~valid & (r < res_max), np.searchsorted(group, np.arange(len(area)))

    return decide


def _heavy(stored: DataFrame, groups: list[str]) -> tuple[bool, DataFrame | None]:
    """Whether the groups of pieces are enough to keep all tasks busy, and those that have too many points for one task."""
    points = stored.groupBy(*groups).agg(F.sum(F.size("xs")).alias("_points"))
    count, most = points.agg(F.count(F.lit(1)), F.max("_points")).first()
    enough = count >= GROUPS_PER_TASK * ways(stored.sparkSession)
    return enough, materialize(points.filter(F.col("_points") > GROUP_POINTS).select(*groups), "heavy") if enough and most > GROUP_POINTS else None


def index_adaptive_partition(
    df: DataFrame,
    column: str,
    tx: list[float],
    res_min: int,
    res_max: int,
    tx_spatial: float = 0.5,
    mesh_cells: DataFrame | None = None,
    geometry: str = "geometry",
    rejects: Rejects | None = None,
) -> DataFrame:
    """Adaptive cells (cell, class) of a layer whose polygons do not overlap: coarse where one class fills a cell.

    Level by level: a cell filled by one class to ``tx[level]`` is valid, one that is nearly empty goes, the others
    are split; at ``res_max`` the leading class takes every cell covered to ``tx_spatial``.  Cells come from
    ``mesh_cells`` at ``res_min``, by default those of :func:`mesh`.  As soon as there are cells enough for all tasks, each is settled
    with all that is below it inside one (:func:`settle`), and nothing more is stored or dealt out.  Until then, and for a cell with too much in it,
    every level is one stored table of fragments, so a lost executor costs one level at most.  A level's table goes
    once the next one is stored, unless cells are settled from it, and the last level is measured without its fragments and not stored.
    Only counts reach the driver.
    """
    pieces = stored = materialize(cut(df.select(column, geometry), [column], res_min, geometry, rejects=rejects, measures=("area", "winding", "distance")), "level")
    cells = _near(pieces, res_min) if mesh_cells is None else mesh_cells.select("cell").distinct()
    pieces = pieces.join(cells, "cell", "left_semi").filter(F.col(column).isNotNull())
    found, kept = [], False
    for r in range(res_min, res_max + 1):
        enough, heavy = (False, None) if r == res_max else _heavy(stored, ["cell"])
        if enough:
            light = pieces if heavy is None else pieces.join(heavy, "cell", "left_anti")
            # Dealt out by a key of its own: the join's partitions by cell would do, but adaptive execution merges them by their few bytes.
            light = light.withColumn("_dealt", F.xxhash64("cell")).repartition(ways(df.sparkSession), "_dealt").withColumn("_owner", F.lit(0).cast("bigint"))
            light = light.withColumn("_class", F.dense_rank().over(Window.partitionBy("_dealt", "cell").orderBy(column)))
            found.append(settle(light, [column], res_max, ("area",), _decide_partition(tx, tx_spatial, res_max)))
            if heavy is None:
                break
            pieces, kept = pieces.join(heavy, "cell", "left_semi"), True
        decided = _decide(_shares(pieces, column, r), column, r, r == res_max, tx, tx_spatial)
        if r == res_max:
            found.append(decided.filter("_state = 'valid'"))
            break
        decided = materialize(decided, "decided")
        found.append(decided.filter("_state = 'valid'"))
        left = pieces.join(decided.filter("_state = 'open'").select("cell").hint("merge"), "cell", "left_semi")
        pieces = _onward(left, [column], r, r + 1 == res_max, ("area",))
        if r + 1 < res_max:
            pieces = stored = replace_stored(None if kept else stored, pieces, "level")
            kept = False
            if pieces.isEmpty():
                break
    out = found[0].select("cell", column)
    for part in found[1:]:
        out = out.unionByName(part.select("cell", column))
    return out


def _onward(pieces: DataFrame, keep: list[str], r: int, last: bool, measures: tuple[str, ...]) -> DataFrame:
    """Pieces of level ``r`` cut to level ``r`` + 1, without their fragments if that is the last.

    The join that picked them has dealt them out, and one level makes at most seven of one; so they are not dealt out again.
    """
    state = pieces.select(*keep, "sign", "cell", "level", "cx", "cy", "xs", "ys")
    return descend(state, keep, r + 1, fragments=not last, measures=measures)


def index_adaptive_objects(
    df: DataFrame,
    key: str,
    tx: list[float],
    res_min: int,
    res_max: int,
    fast: bool = False,
    geometry: str = "geometry",
    rejects: Rejects | None = None,
) -> DataFrame:
    """Adaptive cells of objects that may overlap: (cell, attributes), each object on its own.

    A cell filled by the object to ``tx[level]`` (half at ``res_max``) is valid; otherwise it is split while the
    object touches it, for which the cell counts with a margin unless ``fast``.  Cells are settled and levels stored as in
    :func:`index_adaptive_partition`, for each object and cell.
    """
    limits = [*tx[:res_max], 0.5]
    polygons, attributes = _numbered(df, geometry)
    measures = ("area",) if fast else ("area", "area_wide")
    pieces = stored = materialize(cut(polygons, ["_row"], res_min, geometry, rejects=rejects, measures=measures), "level")
    found, settled, kept = [], [], False
    for r in range(res_min, res_max + 1):
        enough, heavy = (False, None) if r == res_max else _heavy(stored, ["_row", "cell"])
        if enough:
            light = pieces if heavy is None else pieces.join(heavy, ["_row", "cell"], "left_anti")
            light = light.join(attributes.hint("merge"), "_row").repartition(ways(df.sparkSession), "_row", "cell").sortWithinPartitions("_row", "cell")
            light = light.withColumn("_owner", F.col("_row")).withColumn("_class", F.lit(0))
            settled.append(settle(light, ["_attributes"], res_max, measures, _decide_objects(limits, measures, res_max)).select("cell", "_attributes.*"))
            if heavy is None:
                break
            pieces, kept = pieces.join(heavy, ["_row", "cell"], "left_semi"), True
        full = G.cell_area_m2(r)
        cells = pieces.groupBy("_row", "cell").agg(
            F.sum(F.col("sign") * F.col("area")).alias("_area"), F.sum(F.col("sign") * F.col(measures[-1])).alias("_wide")
        )
        touched = F.col("_wide") > 1e-12 * full
        valid = touched & (F.col("_area") >= limits[r] * full - SLACK * full)
        if r == res_max:
            found.append(cells.filter(valid).select("_row", "cell"))
            break
        decided = materialize(cells.select("_row", "cell", valid.alias("_valid"), touched.alias("_touched")), "decided")
        found.append(decided.filter("_valid").select("_row", "cell"))
        left = pieces.join(decided.filter("_touched and not _valid").select("_row", "cell").hint("merge"), ["_row", "cell"], "left_semi")
        pieces = _onward(left, ["_row"], r, r + 1 == res_max, measures)
        if r + 1 < res_max:
            pieces = stored = replace_stored(None if kept else stored, pieces, "level")
            kept = False
            if pieces.isEmpty():
                break
    if found:
        settled.insert(0, _named(reduce(DataFrame.unionByName, found), attributes, "cell"))
    return reduce(DataFrame.unionByName, settled)


def geom_view(df: DataFrame, cell: str = "cell", out: str = "geometry") -> DataFrame:
    """The table with a dense id and the boundary of its cell."""
    order = [cell, *[c for c in df.columns if c != cell]]
    return dense_row_id(df, order).withColumn(out, G.boundary(cell)).withColumn("hex_id", C.to_hex(cell))


def in_box(df: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float, geometry: str = "geometry") -> DataFrame:
    """Rows whose polygons meet a box.

    Extents are compared first; what is left needs an edge that meets the box, or the box lies inside.
    """
    rings = F.flatten(geometry)
    xs = F.transform(F.flatten(rings), lambda p: p.x)
    ys = F.transform(F.flatten(rings), lambda p: p.y)
    near = (F.array_min(xs) <= xmax) & (F.array_max(xs) >= xmin) & (F.array_min(ys) <= ymax) & (F.array_max(ys) >= ymin)

    def edges(ring):
        return F.zip_with(ring, F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def meets(e):
        # Liang-Barsky: the part of the edge inside all four half-planes is not empty.
        dx, dy = e.b.x - e.a.x, e.b.y - e.a.y
        low, high = F.lit(0.0), F.lit(1.0)
        possible = F.lit(True)
        for p, q in ((-dx, e.a.x - xmin), (dx, F.lit(xmax) - e.a.x), (-dy, e.a.y - ymin), (dy, F.lit(ymax) - e.a.y)):
            possible = possible & ((p != 0) | (q >= 0))
            low = F.greatest(low, F.when(p < 0, q / p))
            high = F.least(high, F.when(p > 0, q / p))
        return possible & (low <= high)

    def turns(e):
        x, y = F.lit(xmin), F.lit(ymin)
        crossing = (e.a.y > y) != (e.b.y > y)
        right = e.a.x + (y - e.a.y) * (e.b.x - e.a.x) / F.nullif(e.b.y - e.a.y, F.lit(0.0)) > x
        return crossing & F.coalesce(right, F.lit(False))

    all_edges = F.flatten(F.transform(rings, edges))
    inside = F.size(F.filter(all_edges, turns)) % 2 == 1
    return df.filter(near).filter(F.exists(all_edges, meets) | inside)


EXTENT = ("xmin", "ymin", "xmax", "ymax")


def store_layer(df: DataFrame, path: str, level: int = 6, geometry: str = "geometry") -> None:
    """Write a polygon layer with the extent of each polygon beside it, laid out by the cell of its middle.

    Neighbours lie together, so the extents of a file's rows span a small area and a box skips files by their statistics.
    """
    points = F.flatten(F.flatten(geometry))
    xs, ys = F.transform(points, lambda p: p.x), F.transform(points, lambda p: p.y)
    bounds = {"xmin": F.array_min(xs), "ymin": F.array_min(ys), "xmax": F.array_max(xs), "ymax": F.array_max(ys)}
    middle = G.cell_at((F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2, level)
    placed = df.withColumns(bounds).withColumn("_place", F.coalesce(middle, F.lit(0)))
    cluster_by_cell(placed, "_place").drop("_place").write.parquet(path)


def layer_in_box(layer: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float, geometry: str = "geometry") -> DataFrame:
    """Rows of a stored layer whose polygons meet a box; the extents are compared in the scan."""
    near = (F.col("xmin") <= xmax) & (F.col("xmax") >= xmin) & (F.col("ymin") <= ymax) & (F.col("ymax") >= ymin)
    return in_box(layer.filter(near), xmin, ymin, xmax, ymax, geometry).drop(*EXTENT)

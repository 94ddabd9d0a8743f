"""Adaptive join: link two sets of cells of different resolutions by ancestry."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexmart.functions import cells as C
from hexmart.operators.skew import heavy_keys, heavy_keys_of, key_counts, weighted_join
from hexmart.session import materialize

# An ancestor with more cells below it is spread over several tasks.
ROWS_PER_SALT = 1_000_000


def _ancestors(cells: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """One row per (cell, ancestor level in lo..hi)."""
    levels = cells.withColumn("lo", lo).withColumn("hi", hi).filter(F.col("lo") <= F.col("hi"))
    return levels.withColumn("lvl", F.explode(F.sequence("lo", "hi"))).select("cell", "lvl", C.parent("cell", F.col("lvl")).alias("anc"))


def _meet_ancestors(chains: DataFrame, among: DataFrame, coarsest: int, finest: int) -> DataFrame:
    """``chains`` joined with the cells ``among`` on ``anc``, split by how many cells stand below an ancestor.

    Only an ancestor enough levels above the finest cell can have more than ``ROWS_PER_SALT`` cells below it.  Those levels are
    coarse, so their counts shrink to a few rows on the map side; without such levels nothing is counted.
    """
    gap = math.floor(math.log(ROWS_PER_SALT) / math.log(7)) + 1
    heavy = None
    if coarsest + gap <= finest:
        heavy = heavy_keys(key_counts(chains.filter(F.col("lvl") <= finest - gap).select("anc"), "anc"), "anc", ROWS_PER_SALT)
    return weighted_join(chains, among.select(F.col("cell").alias("anc")), "anc", left_heavy=heavy)


def nearest_ancestor(cells: DataFrame, among: DataFrame, lo: int, strict: bool, finest: int = C.MAX_RES) -> DataFrame:
    """For each cell its nearest ancestor in ``among`` at resolution ``lo`` or finer: (cell, lvl)."""
    hi = C.resolution("cell") - (1 if strict else 0)
    chains = _ancestors(cells.select("cell"), F.lit(lo), hi)
    return _meet_ancestors(chains, among, lo, finest).groupBy("cell").agg(F.max("lvl").alias("lvl"))


def adaptive_join(
    src: DataFrame,
    tar: DataFrame,
    res_min: int,
    res_max: int,
    src_cell: str = "cell",
    tar_cell: str = "cell",
    src_res_min: int = 0,
) -> DataFrame:
    """Pairs (src, tar): per source cell its nearest ancestor-or-self in the target, else its topmost descendants.

    Sources without either give no row.  ``res_min`` and ``res_max`` are the resolution range of the target,
    ``src_res_min`` is the coarsest source resolution where it is known; it spares offers that no source can take.
    Both sides are reduced to distinct cells first and stored, so the tables themselves are scanned once and repeated
    cells never multiply inside the join; no loop over levels reaches the driver.
    """

    def stored(df: DataFrame, cell: str) -> DataFrame:
        cells = df.select(F.col(cell).alias("cell")).filter("cell is not null").distinct()
        return materialize(cells, "cells")

    return link_cells(stored(src, src_cell), stored(tar, tar_cell), res_min, res_max, src_res_min)


def link_cells(
    sources: DataFrame, targets: DataFrame, res_min: int, res_max: int, src_res_min: int = 0, src_res_max: int = C.MAX_RES
) -> DataFrame:
    """The join of :func:`adaptive_join` on tables of distinct cells; pass stored ones, as both are read several times.

    ``src_res_max`` is the finest source resolution where it is known; it keeps the salting of ancestors low.
    """
    up = materialize(nearest_ancestor(sources, targets, res_min, strict=False, finest=src_res_max), "links")
    up_pairs = up.select(F.col("cell").alias("src"), C.parent("cell", F.col("lvl")).alias("tar"))

    rest = sources.join(up.select("cell"), "cell", "left_anti")
    # A target is topmost below a source only if no other target lies between them, so each target offers itself
    # to the levels strictly between its nearest target ancestor and itself.
    reachable = targets.filter(C.resolution("cell") <= res_max)
    shadow = nearest_ancestor(reachable, targets, src_res_min, strict=True, finest=res_max)
    first = F.greatest(F.coalesce("lvl", F.lit(-1)) + 1, F.lit(src_res_min))
    offers = reachable.join(shadow, "cell", "left").select("cell", first.alias("from_lvl"))
    chains = _ancestors(offers, F.col("from_lvl"), C.resolution("cell") - 1)
    down_pairs = _meet_ancestors(chains, rest, src_res_min, res_max).select(F.col("anc").alias("src"), F.col("cell").alias("tar"))
    return up_pairs.unionByName(down_pairs)


def children_among(df: DataFrame, cells: DataFrame, cell: str, r: int, lo: int, hi: int, out: str) -> DataFrame:
    """Rows of ``df`` once per cell of level ``r`` in ``cells`` (distinct, column ``cell``) below theirs or equal to it, as ``out``.

    The descendants of a cell share its prefix, so a listed cell meets the rows above it by an equi join on its ancestors at
    the levels ``lo`` to ``hi`` that ``df`` has.  The work follows the listed cells and the pairs, however coarse a row is.
    """
    chains = _ancestors(cells.select("cell"), F.lit(lo), F.lit(min(hi, r)))
    held = key_counts(df.select(F.col(cell).alias("_above")).filter(C.resolution("_above") <= r), "_above")
    pairs = materialize(_meet_ancestors(chains, held.select(F.col("_above").alias("cell")), lo, r).select(F.col("anc").alias("_above"), F.col("cell").alias(out)), "children")
    weights = [heavy_keys(held, "_above", ROWS_PER_SALT), heavy_keys_of(pairs, "_above", ROWS_PER_SALT)]
    return weighted_join(df.withColumn("_above", F.col(cell)), pairs, "_above", "inner", *weights).drop("_above")

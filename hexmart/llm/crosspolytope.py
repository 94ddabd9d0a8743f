"""Approximate nearest neighbours by cross-polytope hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexmart.session import materialize

TABLES = 8
PROBES = 950  # at any size; fewer lose neighbours in small tables
NEAR_AXES = 64
MOST_CELLS = 1 << 20
BUCKET_ROWS = 20_000
BLOCK = 1 << 21
QUERIES = 500
ROUNDS = 3


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the length is a power of two."""
    x, n, h = x.copy(), x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotate(x: np.ndarray, table: int, seed: int = 11) -> np.ndarray:
    """A pseudo-rotation: random signs and a Hadamard transform, three times; rows are padded to a power of two."""
    n = 1 << max(x.shape[1] - 1, 0).bit_length()
    out = np.zeros((len(x), n))
    out[:, : x.shape[1]] = x
    signs = np.random.Generator(np.random.PCG64([seed, table])).choice([-1.0, 1.0], (ROUNDS, n))
    for k in range(ROUNDS):
        out = hadamard(out * signs[k])
    return out


def axis_costs(rotated: np.ndarray) -> np.ndarray:
    """How far each signed axis falls short of the nearest one, squared; the axis -i is n + i."""
    both = np.concatenate([rotated, -rotated], axis=1)
    return (both.max(axis=1, keepdims=True) - both) ** 2


def cheapest_keys(first: np.ndarray, second: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``probes`` chained keys of the least summed costs for each row, made of its NEAR_AXES nearest axes of either rotation."""
    near = [np.argsort(cost, axis=1, kind="stable")[:, :NEAR_AXES] for cost in (first, second)]
    a, b = (np.take_along_axis(cost, axes, 1) for cost, axes in zip((first, second), near))
    both = (a[:, :, None] + b[:, None, :]).reshape(len(a), -1)
    probes = min(probes, both.shape[1])
    chosen = np.argpartition(both, probes - 1, axis=1)[:, :probes]
    return np.take_along_axis(near[0], chosen // b.shape[1], 1), np.take_along_axis(near[1], chosen % b.shape[1], 1)


def usable(embedding: Column) -> Column:
    bad = F.exists(embedding, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce((F.size(embedding) > 0) & ~bad & F.exists(embedding, lambda v: v != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the ``k`` nearest of the other rows found, by Euclidean distance.

    Every row is hashed by its direction: a table chains the signed axes nearest to it after two pseudo-rotations into one key, so there
    are (2 * padded length)^2 keys. A query looks at the keys of the least summed distance to its own, ``probes`` of each of the
    ``tables``, however many rows there are: what a query looks at follows from its vector alone. What it finds is ranked by exact distances in double precision, ties by the smaller vec_id.
    Vectors that are null, zero or hold a null or non-finite component take no part, nor do null ids or vectors of another length
    than most (the shorter on a tie). Rows of one id are one candidate at their least distance. No usable row gives no rows; other
    columns are ignored.

    A cell is a first axis and a share of the second ones; there are more shares where there are more rows. Cells are cut by counts
    into parts of rows and turns of queries, both of bounded size. A part keeps only its ``k`` best for a query, so what leaves it
    follows the queries. A query that finds fewer than ``k`` rows is compared with all rows, so it gets ``k`` neighbours, or all
    other rows if there are fewer.
    """
    valid = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", F.coalesce(is_query, F.lit(False)).alias("query"))
    common = valid.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    total, width = (common["count"], common["n"]) if common else (0, 0)
    valid = valid.where(F.size("embedding") == width)
    axes = 2 << max(width - 1, 0).bit_length()
    shares = max(1, min(axes, MOST_CELLS // (tables * axes), -(-total // (axes * BUCKET_ROWS))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries(batch, table, row, cell, asks, second, lengths):
            take, ends = pa.array(row), np.append(0, np.cumsum(lengths)).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(row), table, np.int32)), pa.array(cell.astype(np.int32)), pa.array(np.full(len(row), asks)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(second.astype(np.int32))), batch.column("vec_id").take(take), batch.column("embedding").take(take)],
                names=["tab", "cell", "asks", "second", "vec_id", "embedding"])

        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("embedding"))
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            ask = np.flatnonzero(batch.column("query").to_numpy(zero_copy_only=False))
            for table in range(tables):
                costs = [axis_costs(rotate(x, 2 * table + k)) for k in (0, 1)]
                a, b = (cost.argmin(axis=1) for cost in costs)
                yield entries(batch, table, np.arange(len(x)), a * shares + b % shares, False, b, np.ones(len(x), np.int64))
                for i in range(0, len(ask), QUERIES):
                    asked = ask[i : i + QUERIES]
                    a, b = (axis.ravel() for axis in cheapest_keys(costs[0][asked], costs[1][asked], probes))
                    cell, row = a * shares + b % shares, np.repeat(asked, len(a) // len(asked))
                    order = np.lexsort((cell, row))
                    cell, row, b = cell[order], row[order], b[order]
                    starts = np.flatnonzero(np.append(True, (cell[1:] != cell[:-1]) | (row[1:] != row[:-1])))
                    yield entries(batch, table, row[starts], cell[starts], True, b, np.diff(np.append(starts, len(row))))

    kind = vectors.schema["embedding"].dataType.simpleString()
    placed = materialize(valid.mapInArrow(place, f"tab int, cell int, asks boolean, second array<int>, vec_id bigint, embedding {kind}"), "cells")
    bounded = lambda entries: F.ceil(F.count_if(entries) / BUCKET_ROWS).cast("int")
    sizes = placed.groupBy("tab", "cell").agg(bounded(~F.col("asks")).alias("parts"), bounded(F.col("asks")).alias("turns"))
    cut = placed.join(F.broadcast(sizes.where("parts > 0 and turns > 0")), ["tab", "cell"])  # at most MOST_CELLS rows, or tables * axes
    own = lambda ways: F.array(F.pmod(F.xxhash64("vec_id"), ways).cast("int"))
    every = lambda ways: F.sequence(F.lit(0), F.col(ways) - 1)
    dealt = cut.withColumn("part", F.explode(F.when(F.col("asks"), every("parts")).otherwise(own("parts")))).withColumn(
        "turn", F.explode(F.when(F.col("asks"), own("turns")).otherwise(every("turns"))))

    def best(table: pa.Table) -> pa.Table:
        asks = table.column("asks").combine_chunks()
        queries, rows = table.filter(asks), table.filter(pa.compute.invert(asks))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(queries) and len(rows):
            second = rows.column("second").combine_chunks().flatten().to_numpy()
            order = np.argsort(second, kind="stable")
            second, x, ids = second[order], _matrix(rows.column("embedding"))[order], rows.column("vec_id").to_numpy()[order]
            q, of = _matrix(queries.column("embedding")), queries.column("vec_id").to_numpy()
            wanted = queries.column("second").combine_chunks()
            lists, wanted = np.append(0, np.cumsum(wanted.value_lengths().to_numpy())), wanted.flatten().to_numpy()
            low = np.searchsorted(second, wanted, "left")
            counts = np.searchsorted(second, wanted, "right") - low
            upto = np.append(0, np.cumsum(counts))[lists]  # pairs before each query
            i = 0
            while i < len(q):
                j = max(i + 1, int(np.searchsorted(upto, upto[i] + BLOCK // x.shape[1], "right")) - 1)
                entry = slice(lists[i], lists[j])
                n = counts[entry]
                at = np.repeat(low[entry] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                who = np.repeat(np.arange(i, j), upto[i + 1 : j + 1] - upto[i:j])
                other = ids[at] != of[who]
                at, who = at[other], who[other]
                distance = np.sqrt(((q[who] - x[at]) ** 2).sum(-1))
                names = ids[at]
                order = np.lexsort((distance, names, who))
                who, names, distance = who[order], names[order], distance[order]
                once = np.append(True, (who[1:] != who[:-1]) | (names[1:] != names[:-1]))[: len(who)]  # rows of one id are one, the nearest
                who, names, distance = who[once], names[once], distance[once]
                order = np.lexsort((names, distance, who))
                who, names, distance = who[order], names[order], distance[order]
                first = np.searchsorted(who, who, "left")
                keep = np.arange(len(who)) - first < k
                found.append((of[who[keep]], names[keep], distance[keep]))
                i = j
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*found)))))

    def ranked(met: DataFrame) -> DataFrame:
        once = met.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        return once.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(F.struct("score", "vec_id"))), 1, k).alias("near"))

    found = materialize(ranked(dealt.groupBy("tab", "cell", "part", "turn").applyInArrow(best, "query_id bigint, vec_id bigint, score double")), "nearest")
    # Queries that looked into too few rows go on to all rows, in blocks; where buckets hold k rows there are none.
    full = found.where(F.size("near") >= k)
    short = valid.where("query").select(F.col("vec_id"), "embedding").join(full.select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti")
    short = materialize(short, "nearest-short")
    if short.isEmpty():
        near = full
    else:
        blocks, turns = (max(1, -(-n // BUCKET_ROWS)) for n in (total, short.count()))
        dealt_by = lambda ways: F.array(F.pmod(F.xxhash64("vec_id"), F.lit(ways)).cast("int"))
        all_of = lambda ways: F.sequence(F.lit(0), F.lit(ways - 1))
        sides = ((valid, False, dealt_by(blocks), all_of(turns)), (short, True, all_of(blocks), dealt_by(turns)))
        rows, asked = (side.select("vec_id", "embedding", F.lit(asks).alias("asks"), F.array(F.lit(0)).alias("second"), F.explode(part).alias("part"), turn.alias("turns"))
                       .withColumn("turn", F.explode("turns")).drop("turns") for side, asks, part, turn in sides)
        rest = ranked(rows.unionByName(asked).groupBy("part", "turn").applyInArrow(best, "query_id bigint, vec_id bigint, score double"))
        near = full.unionByName(rest)
    listed = near.select("query_id", F.posexplode("near").alias("place", "hit"))
    return listed.select("query_id", (F.col("place") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))

"""Hard-negative mining by branch and bound over decomposed (columnar) vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexmart.llm.vectors import finite, matrix, usual_length
from hexmart.session import materialize

SCALE = 256
BLOCK_ROWS = 8192
ANCHORS = 512
STEP = 8


def whole(x: np.ndarray, kind: type) -> np.ndarray:
    """Integers that came as doubles, as numbers in which their sums of products are exact."""
    return np.frompyfunc(int, 1, 1)(x) if kind is object else x.astype(kind)


class Block:
    """Rows of a block by dimension, with the least and the largest value of each."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, reach: int):
        """``reach``: the largest absolute component of the anchors; it decides how wide exact sums must be."""
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        widest = int(np.abs(rows).max(initial=0)) * reach * max(1, rows.shape[1])
        self.kind = np.float32 if widest < 1 << 24 else np.float64 if widest < 1 << 53 else object
        self.columns = np.ascontiguousarray(whole(rows[order], self.kind).T)
        self.low, self.high = (f(axis=1) if rows.size else np.zeros(rows.shape[1], self.kind) for f in (self.columns.min, self.columns.max))

    def scan(self, anchor: np.ndarray, alive: np.ndarray, useful) -> tuple[np.ndarray, np.ndarray]:
        """Positions and exact scores of the rows that the bounds leave over.

        Dimensions are read in the anchor's order of falling magnitude, ``STEP`` at a time. After each step a row's score lies between
        its sum so far plus the least and plus the most that the rest can add; ``useful(least, most)`` keeps the rows that may
        still be in the answer (None: all may), and only their values are read from then on.
        """
        q = whole(anchor, self.kind)
        order = np.argsort(-np.abs(q), kind="stable")
        ends = np.sort(np.stack([q * self.low, q * self.high]), axis=0)[:, order]
        rest = np.zeros((2, len(q) + 1), ends.dtype)
        rest[:, :-1] = np.cumsum(ends[:, ::-1], axis=1)[:, ::-1]
        whole_block = np.zeros(len(self.ids), self.columns.dtype) if 2 * len(alive) > len(self.ids) else None
        score = np.zeros(len(alive), self.columns.dtype)
        for a in range(0, len(q), STEP):
            if not len(alive):
                break
            dims = order[a : a + STEP]
            if whole_block is not None:  # reading whole columns is cheaper than picking most of their rows
                whole_block += q[dims] @ self.columns[dims]
                score = whole_block[alive]
            else:
                score = score + q[dims] @ self.columns[dims[:, None], alive]
            keep = useful(score + rest[0, min(a + STEP, len(q))], score + rest[1, min(a + STEP, len(q))])
            if keep is not None and not keep.all():
                alive, score = alive[keep], score[keep]
                whole_block = whole_block if 2 * len(alive) > len(self.ids) else None
        return alive, score


def _largest(values: np.ndarray, k: int):
    """The k-th largest, or None if there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


def best(block: Block, anchor: np.ndarray, anchor_id: int, label: int, k: int) -> list[tuple[int, int]]:
    """(score, id) of the first ``k`` rows of the anchor's label, without rows of its id."""
    alive = np.flatnonzero((block.labels == label) & (block.ids != anchor_id))

    def useful(least: np.ndarray, most: np.ndarray) -> np.ndarray | None:
        if len(least) <= k or most.min() >= least.max():
            return None
        return most >= _largest(least, k)

    rows, score = block.scan(anchor, alive, useful)
    return [(int(score[i]), int(block.ids[rows[i]])) for i in np.lexsort((block.ids[rows], -score))[:k]]


def in_windows(block: Block, anchor: np.ndarray, label: int, tops: list[int], percent: int, k: int) -> list[tuple[int, int, int]]:
    """(top, score, id): for each score ``top``, the first ``k`` rows of another label with percent * top <= 100 * score <= 100 * top."""
    windows = [(-(-percent * t // 100), t) for t in sorted(set(tops)) if t >= 0]
    if not windows:
        return []

    lowest, highest = windows[0][0], windows[-1][1]

    def useful(least: np.ndarray, most: np.ndarray) -> np.ndarray | None:
        if most.min() >= highest and least.max() <= lowest:
            return None
        keep = np.zeros(len(most), bool)
        for low, top in windows:
            inside = least[(least >= low) & (most <= top)]
            floor = _largest(inside, k)
            keep |= (most >= (low if floor is None else max(low, floor))) & (least <= top)
        return keep

    rows, score = block.scan(anchor, np.flatnonzero(block.labels != label), useful)
    order = np.lexsort((block.ids[rows], -score))
    rows, score = rows[order], score[order]
    return [(t, int(score[i]), int(block.ids[rows[i]])) for low, t in windows for i in np.flatnonzero((score >= low) & (score <= t))[:k]]


def mine(vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 5, percent: int = 80, scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: hard negatives of each anchor and positive.

    Components become floor(scale * x); a score is the integer inner product with the anchor, higher first, ties by smaller vec_id.
    An anchor's positives are its first ``positives`` other rows of its label; a negative of a positive has another label and a score of
    ``percent`` to 100 percent of the positive's. All rows are searched for every anchor: rows are dealt into blocks of some ``BLOCK_ROWS``,
    anchors into sets of some ``ANCHORS``, and a task sees one block and one set, so no task grows with the table. In a block ``Block.scan``
    reads dimension by dimension. Only the first few rows of each block leave it.

    Rows with a null label, a null vector, or any null or non-finite component take no part; neither do rows without id, which
    nothing could name, nor vectors of another length than most (the longer on a tie). Rows that agree in id, label and vector
    count once; a row of the anchor's own id is never its positive. Rows of one id and different content are different rows, also as anchors.
    A positive of negative score has an empty window. No row, anchor or positive gives no rows. Other columns are ignored.
    """
    named = vectors.where(finite(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("bigint").alias("id"), (F.col("label") if label is None else label).cast("bigint").alias("lab"),
        F.col("embedding").alias("x"), F.coalesce(is_anchor, F.lit(False)).alias("asks")).where("lab is not null")
    rows = materialize(named.dropDuplicates(["id", "lab", "x"]), "bond")
    width = usual_length(rows, "x")
    rows = rows.where(F.size("x") == width)
    largest = F.array_max(F.transform("x", lambda v: F.abs(F.floor(v.cast("double") * scale))))
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("a"), F.max(F.when(F.col("asks"), largest)).alias("reach")).first()
    blocks, sets, reach = (max(1, -(-v // per)) for v, per in ((counts["n"], BLOCK_ROWS), (counts["a"], ANCHORS), (counts["reach"] or 0, 1)))
    integers = lambda column: np.floor(matrix(column, width, np.float64) * scale)
    own = F.xxhash64("id", "lab", "x")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = rows.select("id", "lab", "x", F.pmod(own, F.lit(blocks)).cast("int").alias("block"), numbers(sets).alias("grp"))
    anchors = materialize(rows.where("asks").select(
        own.alias("anchor"), F.col("id").alias("anchor_id"), F.col("lab").alias("of"), F.col("x").alias("q"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(sets)).cast("int").alias("set")), "anchors")

    def meet(asked: DataFrame, search, schema: str) -> DataFrame:
        """``search`` over each block and set of anchors."""

        def both(left: pa.Table, right: pa.Table) -> pa.Table:
            names = schema.replace(" bigint", "").split(", ")
            found = []
            if left.num_rows and right.num_rows:
                block = Block(left["id"].to_numpy(), left["lab"].to_numpy(), integers(left["x"]), reach)
                asks = integers(right["q"])
                lists = right["tops"].to_pylist() if "tops" in right.column_names else [None] * len(asks)
                for key, of, lab, x, tops in zip(right["anchor"].to_pylist(), right["anchor_id"].to_pylist(), right["of"].to_pylist(), asks, lists):
                    found += [(key, *hit) for hit in search(block, x, of, lab, tops)]
            return pa.table({name: pa.array([f[i] for f in found], pa.int64()) for i, name in enumerate(names)})

        everywhere = asked.withColumn("at", numbers(blocks))
        return dealt.groupBy("block", "grp").cogroup(everywhere.groupBy("at", "set")).applyInArrow(both, schema)

    def first(df: DataFrame, k: int, *keys: str) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "found"))).where(F.col("rank") <= k)

    near = meet(anchors, lambda block, x, of, lab, _: best(block, x, of, lab, positives), "anchor bigint, score bigint, found bigint")
    liked = materialize(first(near, positives, "anchor").select("anchor", F.col("found").alias("positive_id"), F.col("score").alias("top"), F.col("rank").alias("place")), "positives")
    tops = liked.groupBy("anchor").agg(F.collect_set("top").alias("tops"))  # at most ``positives`` numbers
    hits = meet(anchors.join(tops, "anchor"), lambda block, x, of, lab, t: in_windows(block, x, lab, t, percent, negatives), "anchor bigint, top bigint, score bigint, found bigint")
    ranked = first(hits, negatives, "anchor", "top").join(liked, ["anchor", "top"]).join(anchors.select("anchor", "anchor_id"), "anchor")
    return ranked.select("anchor_id", "positive_id", "rank", F.col("found").alias("negative_id"), F.col("top").alias("positive_score"), F.col("score").alias("negative_score"))

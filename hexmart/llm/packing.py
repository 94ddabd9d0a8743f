"""Best-fit packing of documents into sequences of a fixed number of words, with conflicts."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexmart.llm.mixing import word_count
from hexmart.session import materialize

CAPACITY = 2048
PER_SOURCE = 2
GROUP_PIECES = 8192


def best_fit(pieces: list[tuple], capacity: int, per_source: int) -> list[int]:
    """The bin of each piece (size, source, cluster), largest first.

    Bins stand in the order of what they have left. The search for a piece begins at the first bin that it fits into and goes to
    the next until one is compatible, so it finds the tightest compatible bin. A bin carries a bitmap of the duplicate clusters
    in it and, for each count up to ``per_source``, one of the sources that it holds that often. Only what comes twice in the
    group needs a bit.
    """
    bit_of: tuple[dict, dict] = ({}, {})
    for k in (0, 1):
        counts = Counter(p[k + 1] for p in pieces)
        bit_of[k].update((v, 1 << i) for i, v in enumerate(v for v, n in counts.items() if n > (per_source if k == 0 else 1)))
    order = sorted(range(len(pieces)), key=lambda i: (-pieces[i][0], i))
    left: list[tuple[int, int]] = []
    clusters: list[int] = []
    sources: list[list[int]] = []
    into = [0] * len(pieces)
    for i in order:
        size, source, cluster = pieces[i]
        s, c = bit_of[0].get(source, 0), bit_of[1].get(cluster, 0)
        at = bisect_left(left, (size, -1))
        while at < len(left) and (clusters[left[at][1]] & c or sources[left[at][1]][-1] & s):
            at += 1
        if at < len(left):
            room, b = left.pop(at)
        else:
            room, b = capacity, len(clusters)
            clusters.append(0)
            sources.append([0] * per_source)
        into[i] = b
        clusters[b] |= c
        level = next(k for k in range(per_source) if not sources[b][k] & s or not s)
        sources[b][level] |= s
        if room > size:
            insort(left, (room - size, b))
    return into


def pack(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, cluster: str | None = None) -> DataFrame:
    """doc_id, source, piece, start, length, bin_id: where each stretch of words of each document goes.

    A document longer than ``capacity`` words is cut into pieces of ``capacity`` words and a rest; every word is in one piece
    and every piece in one bin of at most ``capacity`` words. A bin holds no two pieces of one duplicate cluster (column ``cluster``,
    by default documents of equal text) and at most ``per_source`` pieces of one source, null being a source. A null, empty or
    blank text gives one row of length 0 without a bin. Repeated rows are packed one by one and spread over all groups; ids may be null; other columns are ignored.

    Pieces are dealt by a hash into groups whose number follows the number of pieces, and each group is packed by itself. A group of
    thousands of pieces leaves at most a few bins open, so little is lost against one list of all bins, which no task could hold.
    """
    key = F.xxhash64("text") if cluster is None else F.xxhash64(F.col(f"`{cluster}`"))
    sized = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("cluster")), "pack-sizes")
    count = sized.agg(F.sum(F.ceil(F.col("size") / capacity))).first()[0] or 0
    groups = int(count / GROUP_PIECES) + 1
    # Repeated rows meet as one row and a count; their copies are numbered and so dealt to different groups.
    copies = sized.groupBy("doc_id", "source", "size", "cluster").agg(F.count(F.lit(1)).alias("copies"))
    copies = copies.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    numbers = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("size") / capacity) - 1, F.lit(0)).cast("int"))
    pieces = copies.withColumn("piece", F.explode(numbers)).select(
        "doc_id", "source", "cluster", "copy", "piece", (F.col("piece") * F.lit(capacity).cast("bigint")).alias("start"),
        F.least(F.col("size") - F.col("piece") * F.lit(capacity).cast("bigint"), F.lit(capacity)).alias("length"))
    grouped = pieces.withColumn("grp", F.pmod(F.xxhash64("doc_id", "source", "cluster", "copy", "piece"), F.lit(groups)).cast("int"))

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("doc_id", "source", "cluster", "copy", "piece")])
        length, group = table.column("length").to_pylist(), table.column("grp")[0].as_py()
        some = [i for i, n in enumerate(length) if n]
        source, same = table.column("source").to_pylist(), table.column("cluster").to_pylist()
        bins: list[int | None] = [None] * len(length)
        for i, b in zip(some, best_fit([(length[i], source[i], same[i]) for i in some], capacity, per_source)):
            bins[i] = (group << 32) | b
        return table.drop_columns(["cluster", "copy", "grp"]).append_column("bin_id", pa.array(bins, pa.int64()))

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = grouped.groupBy("grp").applyInArrow(fill, f"doc_id {kind}, source string, piece int, start bigint, length bigint, bin_id bigint")
    return out.select("doc_id", "source", "piece", "start", "length", "bin_id")

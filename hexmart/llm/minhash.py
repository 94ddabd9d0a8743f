"""Near-duplicates by MinHash with tensored banding.

A document gets two collections of HALVES half-keys, each from WIDTH minhashes. A table of the search is a pair of half-keys,
one from each collection, so HALVES * HALVES tables of keys of 2 * WIDTH minhashes need only 2 * HALVES * WIDTH minhashes. Documents
at the least similarity 0.8 miss all 400 tables with a chance of 2 * (1 - 0.8^4)^20, about 5 in 100,000; closer ones hardly
ever. Every link is confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexmart.llm.bytestext import U, mix, shingle_hashes, slices, word_hashes
from hexmart.llm.components import connect
from hexmart.llm.frames import settle

HALVES = 20
WIDTH = 4
_RANDOM = np.random.Generator(np.random.PCG64(31))
FACTORS = _RANDOM.integers(0, 2**64, 2 * HALVES * WIDTH, dtype=U) | U(1)
MASKS = _RANDOM.integers(0, 2**64, 2 * HALVES * WIDTH, dtype=U)


def _half_keys(shingles: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """One row per document with shingles, one column per half-key."""
    keys = np.zeros((len(begin), 2 * HALVES), U)
    for i, (factor, mask) in enumerate(zip(FACTORS, MASKS)):
        least = mix(np.minimum.reduceat((shingles ^ mask) * factor, begin))
        column = keys[:, i // WIDTH]
        column[:] = mix(column + least)
    return keys


def _signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, node (a hash of the shingle set), left and right half-keys (empty without shingles)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in slices(batch):
                shingles, begin = shingle_hashes(*word_hashes(data, offsets, fold=True), words)
                sets = [np.unique(shingles[i:j]) for i, j in zip(begin[:-1], begin[1:])]
                sizes = np.array([len(s) for s in sets])
                some = np.flatnonzero(sizes)
                keys = np.zeros((len(sets), 2 * HALVES), U)
                if len(some):
                    distinct = np.concatenate(sets)
                    starts = np.append(0, np.cumsum(sizes[some]))[:-1]
                    keys[some] = _half_keys(distinct, starts)
                node = np.array([mix(np.array([mix(s + U(77)).sum(dtype=U) + U(len(s))]))[0] for s in sets], U)
                lists = lambda a: pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(np.where(sizes > 0, a.shape[1], 0))).astype(np.int32)), pa.array(a[some].ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, end - row), pa.array(sizes, pa.int64()), pa.array(node.view(np.int64)), lists(keys[:, :HALVES]), lists(keys[:, HALVES:])],
                    names=["doc_id", "n_shingles", "node", "left", "right"])

    return docs.select("doc_id", "text").mapInArrow(sign, "doc_id bigint, n_shingles bigint, node bigint, left array<bigint>, right array<bigint>")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """node, n, shingles (array) of the wanted (doc_id, node); the text is read again instead of keeping every set."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in slices(batch):
                shingles, begin = shingle_hashes(*word_hashes(data, offsets, fold=True), words)
                found = [np.unique(shingles[i:j]).view(np.int64) for i, j in zip(begin[:-1], begin[1:])]
                node = batch.column("node").slice(row, end - row)
                own = [mix(np.array([mix(s.view(U) + U(77)).sum(dtype=U) + U(len(s))]))[0].view(np.int64) for s in found]
                keep = [i for i, n in enumerate(node.to_pylist()) if n == own[i]]
                flat = np.concatenate([found[i] for i in keep]) if keep else np.zeros(0, np.int64)
                ends = np.append(0, np.cumsum([len(found[i]) for i in keep])).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [node.take(pa.array(keep, pa.int64())), pa.array([len(found[i]) for i in keep], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                    names=["node", "n", "shingles"])

    chosen = docs.select("doc_id", "text").join(wanted, "doc_id").select("node", "text")
    return settle(chosen.mapInArrow(sets, "node bigint, n bigint, shingles array<bigint>"), "minhash-sets")


def _similar(common: Column, sizes: Column, percent: int) -> Column:
    return 100 * common >= percent * (sizes - common)


def _own(sets: DataFrame) -> DataFrame:
    """node, n, own: how many shingles each set has, and how many of them are in no other set."""
    each = sets.select("node", F.explode("shingles").alias("s"))
    sole = each.groupBy("s").agg(F.min("node").alias("node"), F.max("node").alias("last")).where("node = last")
    return sets.select("node", "n").distinct().join(sole.groupBy("node").agg(F.count(F.lit(1)).alias("own")), "node", "left").select(
        "node", "n", F.coalesce("own", F.lit(0)).alias("own"))


def _possible(percent: int) -> Column:
    """Whether sets of nx and ny shingles, ox and oy of them in no other set, can be similar: they share no own shingle."""
    shared = F.least(F.col("nx") - F.col("ox"), F.col("ny") - F.col("oy"))
    return _similar(shared, 2 * shared + F.col("ox") + F.col("oy"), percent)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("node").alias("x"), F.col("shingles").alias("sx"))
    right = sets.select(F.col("node").alias("y"), F.col("shingles").alias("sy"))
    common = F.size(F.array_intersect("sx", "sy"))
    return pairs.join(left, "x").join(right, "y").where(_similar(common, F.size("sx") + F.size("sy"), percent)).select("x", "y").distinct()


def _side(known: DataFrame, side: str) -> DataFrame:
    return known.select(F.col("node").alias(side), F.col("n").alias(f"n{side}"), F.col("own").alias(f"o{side}"))


def _grouped(apart: DataFrame) -> DataFrame:
    """node, root, group, far: buckets that share nodes are one group; far are the nodes outside the group's largest component."""
    least = apart.groupBy("key").agg(F.min("node").alias("y"))
    met = connect(apart.join(least, "key").select(F.col("node").alias("x"), "y")).withColumnRenamed("root", "group")
    nodes = apart.select("node", "root").distinct().join(met, "node", "left").select("node", "root", F.coalesce("group", "node").alias("group"))
    largest = nodes.groupBy("group", "root").agg(F.count(F.lit(1)).alias("k")).groupBy("group").agg(F.max(F.struct("k", "root")).alias("top"))
    return nodes.join(largest, "group").select("node", "root", "group", (F.col("root") != F.col("top.root")).alias("far"))


def _differences(grouped: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The grouped nodes with n, delta (the shingles in which a set differs from its group's core) and excess.

    The core are the shingles of more than half of the group's sets. Sets x and y are similar if they differ in at most
    b * (nx + ny) shingles, b = (100 - percent) / (100 + percent), and they differ where just one of their deltas has a shingle. So
    similar sets share at least half of the sum of their size(delta) - b * n. The excess is that difference, times 100 + percent.
    """
    held = settle(grouped.join(sets, "node").dropDuplicates(["node"]), "minhash-held")
    members = held.groupBy("group").agg(F.count(F.lit(1)).alias("members"))
    counts = held.select("group", F.explode("shingles").alias("s")).groupBy("group", "s").agg(F.count(F.lit(1)).alias("k"))
    core = counts.join(members, "group").where("2 * k > members").groupBy("group").agg(F.collect_list("s").alias("core"))
    both = held.join(core, "group", "left").withColumn("core", F.coalesce("core", F.array().cast("array<bigint>")))
    delta = both.withColumn("delta", F.concat(F.array_except("shingles", "core"), F.array_except("core", "shingles")))
    excess = (100 + percent) * F.size("delta").cast("long") - (100 - percent) * F.col("n")
    return settle(delta.select("node", "root", "group", "far", "n", "delta", excess.alias("excess")), "minhash-differences")


def _entries(differences: DataFrame, percent: int) -> DataFrame:
    """A row for each of the first shingles of each delta, rarest in the group first, if others of the group have it: s, rest (how many
    shingles of the delta are left from there on) and early (whether it also is one of the first for the lesser excess of a pair).

    The first shingle that two similar sets x and y share stands after at most size(delta) - (excess x + excess y) / 2 others. The lesser
    excess gives b * n there. The other one may be more by 2 * b * n * 100 / percent at most, as deltas differ in size by no more
    than the sets differ in shingles; this gives n * (100 - percent) / percent.
    """
    each = differences.select("node", "group", F.explode("delta").alias("s"))
    shared = each.groupBy("group", "s").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    ranked = each.join(shared, ["group", "s"]).groupBy("node").agg(F.array_sort(F.collect_list(F.struct("k", "s"))).alias("ranked"))
    first = differences.select("node", "root", "group", "far", "n", "excess", F.size("delta").cast("long").alias("size")).join(ranked, "node").select(
        "*", (F.col("size") - F.size("ranked")).alias("own"), F.posexplode("ranked").alias("at", "by"))
    place = F.col("own") + F.col("at")
    return first.where(percent * place <= (100 - percent) * F.col("n")).select(
        "node", "root", "group", "far", "excess", F.col("by.s").alias("s"), (F.col("size") - place).alias("rest"),
        ((100 + percent) * place <= (100 - percent) * F.col("n")).alias("early"))


def _meeting(lesser: DataFrame, greater: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components with a shingle in both, from which on enough shingles are left in both deltas."""
    side = lambda df, s: df.select("group", "s", *[F.col(c).alias(a + s) for c, a in (("node", ""), ("root", "r"), ("excess", "e"), ("rest", "l"))])
    ordered = (F.col("ex") < F.col("ey")) | ((F.col("ex") == F.col("ey")) & (F.col("x") < F.col("y")))
    enough = 2 * (100 + percent) * F.least("lx", "ly") >= F.col("ex") + F.col("ey")
    return side(lesser, "x").join(side(greater, "y"), ["group", "s"]).where((F.col("rx") != F.col("ry")) & ordered & enough).select("x", "y")


def _across(apart: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between nodes of a group that are in different components; nodes that need not share a shingle of their deltas are
    linked by the node of least excess, as it is similar to both."""
    differences = _differences(_grouped(apart), sets, percent)
    least = differences.groupBy("group").agg(F.min(F.struct("excess", "node", "root")).alias("low"))
    near = differences.join(least, "group").where("root != low.root and excess + low.excess <= 0").select(F.col("low.node").alias("x"), F.col("node").alias("y"))
    entries = settle(_entries(differences, percent), "minhash-entries")
    early, far = entries.where("early"), F.col("far")
    met = _meeting(early.where(far), entries, percent).unionByName(_meeting(early.where(~far), entries.where(far), percent))
    pairs = met.unionByName(near).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    return _verified(settle(pairs, "minhash-across"), sets, percent)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: the groups of documents whose sets of ``words``-word shingles are similar.

    Two documents are linked if 100 * |intersection| >= percent * |union|; component_id is the least id that links reach, kept
    says whether it is the document's own. Letters A-Z count as a-z. A text of fewer words than a shingle is one shingle; a
    null, empty or blank text has none and is linked with nothing. Documents of equal sets are one node. A null id is
    never linked and is kept. Rows of one id are linked as their texts are. Other columns are ignored.

    Buckets of table keys are not paired: their members are compared with two of them (least and largest node), which joins almost all
    of a group of copies. Members of one bucket that are still in different components are not paired either. They meet by the rare
    shingles in which they differ from what most of their group have, as similar ones must share such shingles, and only those that
    can still share enough of them are compared. So the work follows the documents and the rare differences that several of a group
    share, and no candidate is left out.
    """
    signed = settle(_signatures(docs, words), "minhash-signatures")
    usable = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    nodes = usable.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    sole = usable.select("doc_id", "node", "n_shingles", "left", "right").join(nodes, ["doc_id", "node"], "left_semi")

    first = sole.select("node", F.posexplode("left").alias("i", "a")).select("node", "i", F.xxhash64("i", "a").alias("half"))
    met = first.groupBy("half").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("half")
    alive = settle(first.join(met, "half", "left_semi").select("node", "half"), "minhash-halves")
    tables = alive.join(sole.select("node", "right"), "node").select("node", "half", F.posexplode("right").alias("j", "b"))
    keyed = tables.select("node", F.xxhash64("half", "j", "b").alias("key"))
    ends = keyed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    members = settle(keyed.join(ends, "key"), "minhash-members")

    sets = _sets(docs, members.select("node").distinct().join(nodes, "node"), words)
    known = settle(_own(sets), "minhash-own")
    to_hubs = members.select(F.explode(F.array("low", "high")).alias("x"), F.col("node").alias("y")).where("x != y").select(
        F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    hubs = settle(to_hubs.join(_side(known, "x"), "x").join(_side(known, "y"), "y").where(_possible(percent)).select("x", "y"), "minhash-hubs")
    links = settle(_verified(hubs, sets, percent), "minhash-links")
    roots = connect(links)

    linked = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    placed = members.select("key", "node").distinct().join(linked, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("key")
    more = settle(_across(settle(placed.join(mixed, "key", "left_semi"), "minhash-apart"), sets, percent), "minhash-more-links")
    if more.take(1):
        roots = connect(roots.select(F.col("node").alias("x"), F.col("root").alias("y")).unionByName(more))

    rooted = nodes.join(roots, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("least"))
    labels = rooted.join(least, "root").select("node", "least")
    own = F.coalesce(F.when(F.col("n_shingles") > 0, F.col("least")), F.col("doc_id"))
    out = signed.join(labels, "node", "left").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), own))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))

"""Document fingerprints by SimHash, and search within a Hamming radius."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexmart.llm.bytestext import U, mix, shingle_hashes, slices, word_hashes
from hexmart.llm.frames import text_bytes
from hexmart.session import materialize

BITS = 128
WORDS = 2
RADIUS = 3
BLOCKS, CHOSEN = 6, 3
PART_BYTES = 16 << 20
DRAWN = 64
_LANES = np.array([sum(((b >> (7 - i)) & 1) << (8 * i) for i in range(8)) for b in range(256)], U)  # bit i of a byte to byte lane i


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """16 bytes per text. Every shingle of WORDS words votes on each bit, once for each time that it occurs; a tie is 0.

    Votes are added in the eight byte lanes of one 64-bit sum, at most 255 at a time. A text without words is all 0.
    """
    shingles, begin = shingle_hashes(*word_hashes(data, offsets), WORDS)
    votes = np.zeros((len(offsets) - 1, BITS), np.int64)
    counts = np.diff(begin)
    chunks = -(-counts // 255)
    owner = np.repeat(np.arange(len(counts)), chunks)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    starts = begin[owner] + number * 255
    some = np.flatnonzero(counts)
    if len(some):
        whole = np.append(0, np.cumsum(chunks[some]))[:-1]
        for half, salt in enumerate((0, 0x51ED270B)):
            bits = mix(shingles + U(salt)).view(np.uint8).reshape(-1, 8)
            for byte in range(8):
                lanes = np.add.reduceat(_LANES[bits[:, byte]], starts).view(np.uint8).reshape(-1, 8)
                at = (half * 8 + byte) * 8
                votes[some, at : at + 8] = np.add.reduceat(lanes.astype(np.int64), whole, axis=0)
    return np.packbits(2 * votes > counts[:, None], axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal bits."""
    return 1 - np.unpackbits(a ^ b, axis=1).sum(axis=1) / BITS


def fingerprint_texts(texts: list[str]) -> np.ndarray:
    batch = pa.record_batch({"text": pa.array(texts, pa.string())})
    return np.concatenate([np.zeros((0, BITS // 8), np.uint8), *[fingerprints(data, offsets) for _, _, data, offsets in slices(batch)]])


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document.

    The edited text of a document has its last floor(n_chars / 4) characters replaced by the first as many (or all) of the next
    document's by id; after the last comes the first. A null text is empty, a null id comes last, rows of one id stand in the
    order of their texts. Other columns are ignored.

    Ids are cut into ranges at quantiles of a bounded draw of ids (DRAWN per range, ranges of about PART_BYTES of text). A range
    is one group; the first document of each range is sent to the range before it too, so no range needs another.
    """
    last = 2**63 - 1
    keyed = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(last)).alias("at"), F.coalesce("text", F.lit("")).alias("text"))
    ranges = int(text_bytes(docs) / PART_BYTES) + 1
    drawn = keyed.select("at").distinct().orderBy(F.xxhash64("at"), "at").limit(ranges * DRAWN)
    drawn = np.sort([r.at for r in drawn.collect()])
    bounds = np.unique(drawn[(np.arange(1, ranges) * len(drawn)) // ranges]) if len(drawn) else np.zeros(0, np.int64)

    @F.pandas_udf("int")
    def range_of(at):
        import pandas as pd

        return pd.Series(np.searchsorted(bounds, at.to_numpy(), "right").astype(np.int32))

    firsts = keyed.groupBy(range_of("at").alias("part")).agg(F.min("at").alias("at")).collect()  # one row per range
    firsts = sorted((r["part"], r["at"]) for r in firsts)
    before = {at: firsts[i - 1][0] for i, (_, at) in enumerate(firsts)}  # the first of all follows the last range

    @F.pandas_udf("int")
    def range_before(at):
        import pandas as pd

        return pd.Series([before.get(a, -1) for a in at.tolist()], dtype="int32")

    parted = keyed.withColumn("own", range_of("at")).withColumn("also", range_before("at"))
    sent = F.when(F.col("also") >= 0, F.array(F.struct(F.col("own").alias("part"), F.lit(False).alias("guest")), F.struct(F.col("also").alias("part"), F.lit(True).alias("guest"))))
    dealt = parted.withColumn("to", F.explode(F.coalesce(sent, F.array(F.struct(F.col("own").alias("part"), F.lit(False).alias("guest"))))))
    dealt = dealt.select("doc_id", "at", "text", F.col("to.part").alias("part"), F.col("to.guest").alias("guest"))

    def pair(table: pa.Table) -> pa.Table:
        at, guest, texts = table.column("at").to_pylist(), table.column("guest").to_pylist(), table.column("text").to_pylist()
        order = sorted(range(len(at)), key=lambda i: (guest[i], at[i], texts[i]))
        own = [i for i in order if not guest[i]]
        follows = own[1:] + order[len(own) : len(own) + 1]
        table, texts = table.take(own), [texts[i] for i in own + follows[-1:]]
        edited = []
        for text, after in zip(texts, texts[1:]):
            k = len(text) // 4
            edited.append(text[: len(text) - k] + after[:k])
        plain = fingerprint_texts(texts)
        changed = fingerprint_texts(edited)
        name = lambda rows: pa.array([r.tobytes().hex() for r in rows], pa.string())
        return pa.table({
            "doc_id": table.column("doc_id"), "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            "fingerprint": name(plain[:-1]), "edited_fingerprint": name(changed),
            "near_edited": pa.array(likeness(plain[:-1], changed), pa.float64()), "near_next": pa.array(likeness(plain[:-1], plain[1:]), pa.float64())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("part").applyInArrow(pair, f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _distance(a: Column, b: Column) -> Column:
    """Bits that differ between two fingerprints in hexadecimal, 15 digits at a time."""
    part = lambda c, i: F.conv(F.substring(c, i, 15), 16, 10).cast("bigint")
    return sum((F.bit_count(part(a, i).bitwiseXOR(part(b, i))) for i in range(1, BITS // 4 + 1, 15)), F.lit(0))


def near_fingerprints(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """x < y, distance: all pairs of different fingerprints (hexadecimal, column ``fingerprint``) at most ``radius`` bits apart.

    The bits are cut into BLOCKS blocks. If ``radius`` <= BLOCKS - CHOSEN bits differ, some CHOSEN blocks agree, so one table per
    choice of blocks, keyed by those, finds every pair; 20 tables with keys of 60 bits and more. Rows of one
    fingerprint are one; nulls take no part.
    """
    if radius > BLOCKS - CHOSEN:
        raise ValueError(f"{BLOCKS} blocks with {CHOSEN} chosen find pairs within {BLOCKS - CHOSEN} bits only")
    cuts = np.linspace(0, BITS // 4, BLOCKS + 1).astype(int)
    piece = [F.substring("fingerprint", int(a) + 1, int(b - a)) for a, b in zip(cuts, cuts[1:])]
    keys = F.array(*[F.xxhash64(F.lit(i), *[piece[j] for j in chosen]) for i, chosen in enumerate(combinations(range(BLOCKS), CHOSEN))])
    tables = rows.select("fingerprint").where("fingerprint is not null").distinct().select(F.col("fingerprint").alias("x"), F.explode(keys).alias("key"))
    tables = materialize(tables, "fingerprint-tables")
    other = tables.withColumnRenamed("x", "y")
    met = tables.join(other, "key").where((F.col("x") < F.col("y")) & (_distance(F.col("x"), F.col("y")) <= radius))
    return met.select("x", "y").distinct().withColumn("distance", _distance(F.col("x"), F.col("y")))

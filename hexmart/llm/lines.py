"""Line dedup: two Bloom filters single out suspected repeats, only those are gathered and confirmed."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexmart.llm.frames import fresh_names
from hexmart.session import materialize

BLANKS = b" \t\n\x0b\x0c\r"
PART_LINES = 1 << 17
SEGMENT_LINES = 1 << 20
BITS_PER_LINE, PROBES = 16, 5
WIDE = 16


def key_of(line: bytes) -> bytes:
    return line.strip(BLANKS).lower()


def long_enough(key: bytes, least: int) -> bool:
    """Whether UTF-8 bytes hold at least ``least`` code points, of 1 to 4 bytes each."""
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


class Bloom:
    """A Bloom filter over 64-bit hashes, a power of two bits wide."""

    def __init__(self, lines: int):
        self.shift = np.uint64(64 - max(10, int(lines * BITS_PER_LINE - 1).bit_length()))
        self.bits = np.zeros(1 << (61 - int(self.shift)), np.uint8)

    def _places(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        step = (hashes << np.uint64(32) | hashes >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
        for k in range(PROBES):
            yield (hashes * np.uint64(0xC2B2AE3D27D4EB4F) + step * np.uint64(k)) >> self.shift

    def add(self, hashes: np.ndarray) -> None:
        for place in self._places(hashes):
            np.bitwise_or.at(self.bits, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for place in self._places(hashes):
            found &= (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found


class SeenTwice:
    """Two filters: what was added once, and what was added when the first filter had it already."""

    def __init__(self, lines: int):
        self.once, self.twice = Bloom(lines), Bloom(lines)

    def add(self, hashes: np.ndarray, many: np.ndarray) -> None:
        """Different hashes; ``many`` marks those that stand for several occurrences."""
        self.twice.add(hashes[many | self.once.has(hashes)])
        self.once.add(hashes)

    def suspects(self, hashes: np.ndarray) -> np.ndarray:
        return hashes[self.twice.has(hashes)]


def _digests(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, "V16")


def _hashes(digests: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(digests).view(np.uint64).reshape(-1, 2)[:, 0]


def _read_lines(least: int, part_lines: int):
    """Rows of documents to packed parts: who they are, and a digest, the row and the line number of each line that counts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        hashes: list = []
        digests, rows, numbers = bytearray(), [], []

        def part() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([
                pa.array([uuid.uuid4().hex]), pa.array([len(rows)], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([hashes], pa.list_(pa.int64())),
                pa.array([bytes(digests)], pa.binary()), pa.array([np.array(rows, np.int32).tobytes()], pa.binary()), pa.array([np.array(numbers, np.int32).tobytes()], pa.binary())],
                names=["part", "n", "ids", "hashes", "digests", "rows", "numbers"])
            for box in (ids, hashes, digests, rows, numbers):
                box.clear()
            return out

        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                if not text:
                    continue
                own = None
                for number, line in enumerate(text.split(b"\n")):
                    key = key_of(line)
                    if long_enough(key, least):
                        if own is None:
                            own = len(ids)
                            ids.append(batch.column("id")[i].as_py())
                            hashes.append(batch.column("hash")[i].as_py())
                        digests += blake2b(key, digest_size=WIDE).digest()
                        rows.append(own)
                        numbers.append(number)
                if len(rows) >= part_lines:  # a row stays in one part, so that it counts once
                    yield part()
        if rows:
            yield part()

    return cut


def _to_segments(segments: int):
    """A part's different hashes, dealt to segments of the hash space, with a mark for those that several of its rows hold."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                h = _hashes(_digests(batch.column("digests")[i].as_py()))
                row = np.frombuffer(batch.column("rows")[i].as_py(), np.int32)
                order = np.lexsort((row, h))
                h, row = h[order], row[order]
                new = np.ones(len(h), bool)
                new[1:] = h[1:] != h[:-1]
                start = np.flatnonzero(new)
                last = np.append(start[1:], len(h)) - 1
                keys, many = h[start], row[start] != row[last]
                at = ((keys >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)  # rises with the key
                edges = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                cuts = list(zip(edges, np.append(edges[1:], len(at))))
                yield pa.RecordBatch.from_arrays([
                    pa.array(at[edges].astype(np.int32)), pa.array([batch.column("part")[i].as_py()] * len(cuts)),
                    pa.array([keys[a:b].tobytes() for a, b in cuts], pa.binary()), pa.array([many[a:b].tobytes() for a, b in cuts], pa.binary())],
                    names=["segment", "part", "keys", "many"])

    return deal


def _suspects(table: pa.Table) -> pa.Table:
    keys = [np.frombuffer(b, np.uint64) for b in table["keys"].to_pylist()]
    many = [np.frombuffer(b, bool) for b in table["many"].to_pylist()]
    seen = SeenTwice(sum(map(len, keys)))
    for k, m in zip(keys, many):
        seen.add(k, m)
    found = [seen.suspects(k) for k in keys]
    told = [(part, f.tobytes()) for part, f in zip(table["part"].to_pylist(), found) if len(f)]
    return pa.table({"part": pa.array([p for p, _ in told], pa.string()), "keys": pa.array([f for _, f in told], pa.binary())})


PLACE = pa.struct([("id", pa.int64()), ("hash", pa.int64()), ("number", pa.int32())])


def _suspected_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a part and its suspected hashes: each digest with its number of rows, its largest id, and where its lines are."""
    for batch in batches:
        for i in range(batch.num_rows):
            digests = _digests(batch.column("digests")[i].as_py())
            told = np.concatenate([np.frombuffer(b, np.uint64) for b in batch.column("told")[i].as_py()])
            take = np.flatnonzero(np.isin(_hashes(digests), told))
            if not len(take):
                continue
            row = np.frombuffer(batch.column("rows")[i].as_py(), np.int32)[take]
            number = np.frombuffer(batch.column("numbers")[i].as_py(), np.int32)[take]
            words = np.ascontiguousarray(digests[take]).view(np.uint64).reshape(-1, 2)
            order = np.lexsort((number, row, words[:, 1], words[:, 0]))
            words, row, number, take = words[order], row[order], number[order], take[order]
            new = np.append(True, (words[1:] != words[:-1]).any(axis=1))
            first = np.flatnonzero(new)
            other = new | np.append(True, row[1:] != row[:-1])
            own, hashes = batch.column("ids")[i].values.take(pa.array(row)), batch.column("hashes")[i].values.take(pa.array(row))
            plain = np.array([np.iinfo(np.int64).min if v is None else v for v in own.to_pylist()], np.int64)
            top = np.maximum.reduceat(plain, first)
            offsets = pa.array(np.append(first, len(row)).astype(np.int32))
            places = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([own, hashes, pa.array(number)], fields=list(PLACE)))
            yield pa.RecordBatch.from_arrays([
                pa.array([digests[t].tobytes() for t in take[first]], pa.binary()), pa.array(np.add.reduceat(other, first).astype(np.int64)),
                pa.array(top, mask=np.array([own[int(a)].as_py() is None and t == np.iinfo(np.int64).min for a, t in zip(first, top)], bool)), places],
                names=["digest", "docs", "top", "places"])


def repeated_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, part_lines: int = PART_LINES) -> DataFrame:
    """(id, hash, numbers): the line numbers, from 0, that each row of ``docs`` loses; ``hash`` is xxhash64 of its text.

    1. Each task packs 128-bit digests of its lines' keys into parts of bounded size; the parts are stored, the texts are not.
    2. A part sends its different hashes, once each, to segments of the hash space. The number of segments follows the number of lines, so
       a segment and its two Bloom filters stay bounded. A segment answers each part with the hashes that its second filter has.
    3. Only the suspected lines of a part go on: one row per part and digest, so a line that stands in a third of all documents is
       a few numbers per part. Sums over digests confirm or clear them, and the largest id keeps its lines.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.xxhash64("text").alias("hash"), "text")
    parts = materialize(rows.mapInArrow(_read_lines(least_chars, part_lines), "part string, n bigint, ids array<bigint>, hashes array<bigint>, digests binary, rows binary, numbers binary"), "lines")
    segments = max(1, -(-(parts.agg(F.sum("n")).first()[0] or 0) // SEGMENT_LINES))
    sent = parts.select("part", "digests", "rows").mapInArrow(_to_segments(segments), "segment int, part string, keys binary, many binary")
    answers = sent.groupBy("segment").applyInArrow(_suspects, "part string, keys binary").groupBy("part").agg(F.collect_list("keys").alias("told"))
    suspects = materialize(parts.join(answers, "part").mapInArrow(_suspected_lines, "digest binary, docs bigint, top bigint, places array<struct<id:bigint,hash:bigint,number:int>>"), "suspects")
    confirmed = suspects.groupBy("digest").agg(F.sum("docs").alias("all"), F.max("top").alias("keeper")).where(F.col("all") >= least_docs)
    lost = suspects.join(confirmed.select("digest", "keeper"), "digest").select("keeper", F.explode("places").alias("place"))
    lost = lost.where((F.col("place.id") < F.col("keeper")) | (F.col("place.id").isNull() & F.col("keeper").isNotNull()))
    return lost.select("place.*").groupBy("id", "hash").agg(F.collect_set("number").alias("numbers"))


def drop_repeated_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, part_lines: int = PART_LINES) -> DataFrame:
    """``docs`` with its columns, texts without the lines they lose, and n_lines (before), n_dropped.

    Lines end at \\n. A line's key is the line without the characters ``BLANKS`` at both ends and A-Z in lower case. A key of at least
    ``least_chars`` code points that at least ``least_docs`` documents hold loses all its lines but those of the largest doc_id among them.
    A key that a document holds several times counts it once. Every row is a document, also repeated rows; rows that share the
    largest id all keep their lines. A null id is smaller than any id; keys that only documents with null id hold stay. Null and empty texts
    have one empty line and stay as they are. An empty table stays empty. Columns whose names the operator uses are no obstacle: n_lines and
    n_dropped replace columns of these names.

    Keys are compared by 128-bit cryptographic digests, over all documents. A text travels once, to meet the numbers of its lost lines.
    """
    columns = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    own_id, own_hash, numbers = fresh_names(docs, 3)
    lost = materialize(repeated_lines(docs, least_chars, least_docs, part_lines), "lost-lines").toDF(own_id, own_hash, numbers)
    met = docs.select(*[F.col(f"`{c}`") for c in columns]).join(lost, F.col("doc_id").cast("bigint").eqNullSafe(F.col(own_id)) & (F.xxhash64("text") == F.col(own_hash)), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, told = batch.column("text").cast(pa.binary()), batch.column(numbers)
            kept = texts
            if told.null_count < len(told):
                values = texts.to_pylist()
                for i, gone in enumerate(told.to_pylist()):
                    if gone:
                        gone = set(gone)
                        values[i] = b"\n".join(line for n, line in enumerate(values[i].split(b"\n")) if n not in gone)
                kept = pa.array(values, pa.binary())
            at = batch.schema.get_field_index("text")
            yield batch.select(columns).set_column(at, "text", kept.cast(pa.string())).append_column(
                "n_lines", pa.array([1 if t is None else t.count(b"\n") + 1 for t in texts.to_pylist()], pa.int64())).append_column(
                "n_dropped", pa.array([len(g or ()) for g in told.to_pylist()], pa.int64()))

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in columns] + ["n_lines bigint", "n_dropped bigint"])
    return met.select(*[F.col(f"`{c}`") for c in columns], F.col(numbers)).mapInArrow(cut, schema)

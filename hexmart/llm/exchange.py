"""Exchange of very many small keyed entries as packed arrays.

A row per hash costs more in headers than in content. Here a batch sends one row per bucket of the key space that holds
the batch's entries as byte arrays; Spark shuffles those rows by bucket and a task sees whole buckets. The number of
buckets follows the size of the input, so a bucket stays bounded. Before they are sent, entries of one key are folded
into one per batch (``fold``), so a key that stands in a third of all rows comes once per batch and not once per row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hexmart.llm.bytestext import U, mix

BUCKET_ENTRIES = 1 << 20
ENTRIES = "bucket int, hash binary, row binary, place binary, kind binary"


def bucket_count(entries: float) -> int:
    return max(1, int(entries / BUCKET_ENTRIES) + 1)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Keys may be the least of several hashes, so their bits are scattered once more."""
    return ((mix(keys) >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


def fold(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key, start of each run of equal keys in that order, length of each run."""
    order = np.argsort(keys)
    ranked = keys[order]
    head = np.ones(len(ranked), bool)
    head[1:] = ranked[1:] != ranked[:-1]
    starts = np.flatnonzero(head)
    return order, starts, np.diff(np.append(starts, len(ranked)))


ONE, MANY, TOLD = 0, 1, 2


def fold_batch(keys: np.ndarray, rows: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The entries of a batch, one per key, with how often the batch saw the key (ONE, MANY).

    The further entries of a key need no answer: they are known to repeat. They travel as TOLD under a key made from their
    row, which deals them out evenly.
    """
    order, starts, lengths = fold(keys)
    kind = np.full(len(keys), TOLD, np.uint8)
    kind[order[starts]] = np.where(lengths > 1, MANY, ONE)
    return np.where(kind == TOLD, mix(rows.view(U) + places.astype(U)), keys), rows, places, kind


def send(keys: np.ndarray, rows: np.ndarray, places: np.ndarray, kind: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row per bucket with its entries in the order of the documents, in which rows and places compress well."""
    where = bucket_of(keys, buckets)
    order = np.argsort(where, kind="stable")
    where, keys, rows, places, kind = where[order], keys[order], rows[order], places[order], kind[order]
    cuts = np.flatnonzero(np.diff(where)) + 1
    lows, highs = np.append(0, cuts), np.append(cuts, len(keys))
    if not len(keys):
        lows = highs = np.zeros(0, np.int64)
    part = lambda a, dtype: pa.array([a[i:j].astype(dtype).tobytes() for i, j in zip(lows, highs)], pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(where[lows].astype(np.int32)), part(keys, U), part(rows, np.int64), part(places, np.int32), part(kind, np.uint8)],
        names=["bucket", "hash", "row", "place", "kind"])


def received(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All entries of one bucket."""
    get = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
    return get("hash", U), get("row", np.int64), get("place", np.int32), get("kind", np.uint8)


def by_row(rows: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
    """The distinct rows and for each of them its packed part of every column."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])[: len(rows)])
    ends = np.append(starts[1:], len(rows))[: len(starts)]
    return rows[starts], [[c[i:j].tobytes() for i, j in zip(starts, ends)] for c in (column[order] for column in columns)]


def answer(rows: np.ndarray, columns: dict[str, np.ndarray], buckets: int) -> pa.Table:
    """What a bucket found, packed by the bucket of the document that it is for."""
    where = bucket_of(rows.view(U), buckets)
    order = np.argsort(where, kind="stable")
    where = where[order]
    lows = np.flatnonzero(np.append(True, where[1:] != where[:-1])[: len(where)])
    highs = np.append(lows[1:], len(where))[: len(lows)]
    packed = {name: pa.array([c[i:j].tobytes() for i, j in zip(lows, highs)], pa.binary()) for name, c in (
        (name, column[order]) for name, column in {"row": rows, **columns}.items())}
    return pa.table({"bucket": pa.array(where[lows].astype(np.int32)), **packed})


def per_row(answers: DataFrame, *columns: str) -> DataFrame:
    """One row per document with all answers for it, packed; they are its own places, so bounded by its length."""

    def collect(table: pa.Table) -> pa.Table:
        get = lambda name, dtype: np.frombuffer(b"".join(table.column(name).to_pylist()), dtype)
        rows, packed = by_row(get("row", np.int64), *[get(c, np.int32) for c in columns])
        return pa.table({"row": pa.array(rows, pa.int64()), **{c: pa.array(p, pa.binary()) for c, p in zip(columns, packed)}})

    return answers.groupBy("bucket").applyInArrow(collect, "row bigint, " + ", ".join(f"{c} binary" for c in columns))


def repeated_places(entries: DataFrame, buckets: int) -> DataFrame:
    """Rows and places of the keys that occur more than once, in one batch or in several: ``row, places``."""

    def meet(table: pa.Table) -> pa.Table:
        keys, rows, places, kind = received(table)
        told = kind == TOLD
        order, starts, lengths = fold(keys[~told])
        many = np.zeros(len(starts), bool)
        if len(starts):
            many = np.logical_or.reduceat(kind[~told][order] == MANY, starts) | (lengths > 1)
        shared = np.empty(len(order), bool)
        shared[order] = np.repeat(many, lengths)
        keep = told.copy()
        keep[~told] = shared
        return answer(rows[keep], {"places": places[keep]}, buckets)

    return per_row(entries.groupBy("bucket").applyInArrow(meet, "bucket int, row binary, places binary"), "places")


def planes(numbers: np.ndarray) -> bytes:
    """All lowest bytes, then all second ones and so on: high bytes of small numbers become runs of zeros, which Spark's codec folds."""
    return np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def from_planes(packed: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def steps(numbers: np.ndarray) -> bytes:
    """Signed numbers as the planes of their differences, small ones of either sign as small numbers."""
    step = np.diff(numbers, prepend=numbers.dtype.type(0))
    return planes((step << 1) ^ (step >> (8 * numbers.itemsize - 1)))


def from_steps(packed: bytes, kind: type) -> np.ndarray:
    folded = from_planes(packed, kind)
    half = (folded >> 1) & np.dtype(kind).type(np.iinfo(kind).max)
    return np.cumsum(half ^ -(folded & 1), dtype=kind)


def unpack(packed: bytes | None) -> np.ndarray:
    return np.unique(np.frombuffer(packed or b"", np.int32)).astype(np.int64)

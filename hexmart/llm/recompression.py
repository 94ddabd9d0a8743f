"""Long repeated word sequences by recompression.

Each document becomes a sequence of symbols, first its words. A round names every maximal run of one symbol, then deals the
symbols to a left and a right side and names every pair (left, right). A name is a hash of its parts, so it is the same in
every task without a dictionary. What a round makes of a symbol depends on its neighbours alone, so two equal word
sequences get equal symbols, except near their ends. For every window of words the symbols that cannot depend on what stands
outside are known exactly (``Parse.zone``). A window can repeat only if all these symbols occur elsewhere too. Those few
windows are then verified by a hash of the whole window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexmart.llm import exchange
from hexmart.llm.bytestext import U, mix, powers, slices, spans, word_bounds, word_hashes
from hexmart.llm.frames import fresh_names, row_key, settle, text_bytes

ROUNDS = 3
SHORTEST = 3
WINDOW_BASE = 0xD6E8FEB86659FD93
WINDOW_INVERSE = pow(WINDOW_BASE, -1, 2**64)


class Parse:
    """The symbols of a slice of documents after some rounds, and for each window the symbols [low, high) sure to recur with it."""

    def __init__(self, words: np.ndarray, first: np.ndarray, window: int, rounds: int = ROUNDS):
        lengths = np.maximum(np.diff(first) - window + 1, 0)
        before = np.cumsum(lengths) - lengths
        self.windows = np.repeat(first[:-1] - before, lengths) + np.arange(lengths.sum())
        self.symbols, self.starts, self.end = words, np.arange(len(words)), len(words)
        self.head = np.zeros(len(words) + 1, bool)
        self.head[first] = True
        self.head = self.head[:-1]
        self.low, self.high = self.windows, self.windows + window
        for number in range(rounds if len(words) else 0):
            self._runs()
            self._pairs(number)

    def _merge(self, block: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Keep one symbol per block; gives each old symbol's block."""
        at = np.flatnonzero(block)
        self.symbols, self.starts, self.head = symbols[at], self.starts[at], self.head[at]
        return np.cumsum(block) - 1

    def _zone(self, low: np.ndarray, high: np.ndarray) -> None:
        empty = (self.low >= self.high) | (low >= high)
        self.low, self.high = np.where(empty, 0, low), np.where(empty, 0, high)

    def _runs(self) -> None:
        block = self.head.copy()
        block[1:] |= self.symbols[1:] != self.symbols[:-1]
        at = np.flatnonzero(block)
        length = np.diff(np.append(at, len(block))).astype(U)
        named = self.symbols.copy()
        named[at] = np.where(length > U(1), mix(self.symbols[at] * U(0x9FB21C651E98DF25) + length), self.symbols[at])
        into = self._merge(block, named)
        # the first and the last run may go on outside
        self._zone(into[self.low] + 1, into[np.maximum(self.high, 1) - 1])

    def _pairs(self, number: int) -> None:
        right = mix(self.symbols + U(number + 1)) >> U(63) == U(1)
        joined = np.zeros(len(right), bool)  # with the symbol before
        joined[1:] = right[1:] & ~right[:-1] & ~self.head[1:]
        left = np.zeros(len(right), bool)
        left[:-1] = joined[1:]
        named = self.symbols.copy()
        at = np.flatnonzero(left)
        named[at] = mix(self.symbols[at] * U(0xA24BAED4963EE407) + mix(self.symbols[at + 1] + U(0x9E6C63D0676A9A99)))
        into = self._merge(~joined, named)
        # a right symbol at the start may belong to what stands before, a left one at the end to what follows
        last = np.maximum(self.high, 1) - 1
        self._zone(into[self.low] + right[self.low], into[last] + right[last])

    def long_symbols(self, first: np.ndarray) -> np.ndarray:
        """Which symbols stand for at least SHORTEST words; shorter ones recur everywhere and tell nothing."""
        return np.diff(np.append(self.starts, self.end)) >= SHORTEST


def _each_slice(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for row, end, data, offsets in slices(batch):
        words, first = word_hashes(data, offsets)
        yield row, end, words, first


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(row_key().alias("row"), "text")


def repeated_windows(docs: DataFrame, window: int) -> DataFrame:
    """The windows of ``window`` words whose word sequence also starts anywhere else: ``row`` (hash of id and text) and packed word places.

    Texts of one id and equal content are two documents. Null and short texts have no window.
    """
    size = text_bytes(docs)
    symbol_buckets, window_buckets = exchange.bucket_count(size / 40), exchange.bucket_count(size / 25)

    def symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, parts = batch.column("row").to_numpy(), []
            for row, end, words, first in _each_slice(batch):
                parse = Parse(words, first, window)
                at = np.flatnonzero(parse.long_symbols(first))
                doc = np.searchsorted(first, parse.starts[at], "right") - 1
                parts.append((parse.symbols[at], rows[row:end][doc], parse.starts[at] - first[doc]))
            if parts:
                yield exchange.send(*exchange.fold_batch(*map(np.concatenate, zip(*parts))), symbol_buckets)

    keyed = _keyed(docs)
    shared = settle(exchange.repeated_places(keyed.mapInArrow(symbols, exchange.ENTRIES), symbol_buckets), "repeat-symbols")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, known, parts = batch.column("row").to_numpy(), batch.column("places"), []
            for row, end, words, first in _each_slice(batch):
                parse = Parse(words, first, window)
                told = [exchange.unpack(known[i].as_py()) + first[i - row] for i in range(row, end)]
                alone = parse.long_symbols(first)
                alone[np.searchsorted(parse.starts, np.concatenate(told))] = False
                count = np.zeros(len(alone) + 1, np.int64)
                np.cumsum(alone, out=count[1:])
                at = parse.windows[count[parse.high] == count[parse.low]]
                sums = np.zeros(len(words) + 1, U)
                np.cumsum(words * powers(WINDOW_BASE, len(words)), out=sums[1:])
                keys = mix((sums[at + window] - sums[at]) * powers(WINDOW_INVERSE, len(words) + 1)[at])
                doc = np.searchsorted(first, at, "right") - 1
                parts.append((keys, rows[row:end][doc], at - first[doc]))
            if parts:
                yield exchange.send(*exchange.fold_batch(*map(np.concatenate, zip(*parts))), window_buckets)

    with_symbols = keyed.join(shared, "row", "left")
    return settle(exchange.repeated_places(with_symbols.mapInArrow(verify, exchange.ENTRIES), window_buckets), "repeat-windows")


def _removed(places: bytes | None, words: int, window: int) -> np.ndarray:
    at = exchange.unpack(places)
    return spans(at, at + window, words) if len(at) else np.zeros(words, bool)


def repeat_digest(docs: DataFrame, window: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document without the words that a repeated window covers.

    The kept words are joined by one space. A text that is null, empty or blank has no words and the hash of nothing; shorter
    texts than a window stay whole; rows of one id each give a row; all further columns are ignored.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, digests = [], [], []
            for text, places in zip(batch.column("text"), batch.column("places")):
                words = (text.as_py() or "").encode().split()
                gone = _removed(places.as_py(), len(words), window)
                counts.append(len(words))
                removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(b" ".join(compress(words, ~gone))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    found = repeated_windows(docs, window)
    rows = docs.select("doc_id", "text", row_key().alias("row")).join(found, "row", "left").select("doc_id", "text", "places")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(apply, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string")


def remove_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """``docs`` with the words that a repeated window covers cut from ``text``; ``n_chars``, where it exists, follows.

    A text that loses nothing stays as it is. Otherwise the stretches that stay keep their own blanks and are joined by a
    line break. A text that loses everything stays as an empty text.
    """
    row, places = fresh_names(docs, 2)
    found = repeated_windows(docs, window).select(F.col("row").alias(row), F.col("places").alias(places))
    joined = docs.withColumn(row, row_key()).join(found, row, "left").drop(row)

    def cut(text: str | None, told: bytes | None) -> str | None:
        if not text or not told:
            return text
        data = np.frombuffer(text.encode(), np.uint8)
        starts, ends, _ = word_bounds(data, np.array([0, len(data)]))
        stay = np.r_[False, ~_removed(told, len(starts), window), False]
        low, high = np.flatnonzero(stay[1:] & ~stay[:-1]), np.flatnonzero(~stay[1:] & stay[:-1])
        return b"\n".join(data[starts[i] : ends[j - 1]].tobytes() for i, j in zip(low, high)).decode()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([cut(t.as_py(), p.as_py()) for t, p in zip(batch.column("text"), batch.column(places))], batch.column("text").type)
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", texts).drop_columns([places])

    out = joined.mapInArrow(apply, docs.schema)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out

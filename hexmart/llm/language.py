"""Language identification with hyperdimensional n-gram profiles."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexmart.llm.bytestext import U, mix, slices
from hexmart.session import materialize

SYMBOLS = 128
DIMENSIONS = 512
NGRAMS = SYMBOLS**3
UNKNOWN = "und"
TABLES = 64


def letters_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The characters of a slice as symbols and for each text the index of its first one.

    Letters of either case become one symbol of a fixed alphabet, everything else is a blank (0), and runs of blanks are one.
    A-Z and a-z have symbols of their own; other letters share the rest by a hash of the code point.
    """
    text = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    lead = (data & 0xC0) != 0x80
    first = np.concatenate([[0], np.cumsum(lead)])[offsets]
    wide = np.flatnonzero(text >= 128)
    symbol = np.zeros(len(text), np.int64)
    narrow = text < 128
    low = text | 32
    symbol[narrow & (low >= 97) & (low <= 122)] = (low - 96)[narrow & (low >= 97) & (low <= 122)]
    points, back = np.unique(text[wide], return_inverse=True)
    folded = [chr(c).lower()[0] if chr(c).isalpha() else "" for c in points.tolist()]
    own = np.array([27 + int(mix(np.array([ord(c)], U))[0] % U(SYMBOLS - 27)) if c else 0 for c in folded], np.int64)
    symbol[wide] = own[back] if len(points) else 0
    keep = np.ones(len(symbol), bool)
    keep[1:] = (symbol[1:] > 0) | (symbol[:-1] > 0)
    keep[first[:-1][np.diff(first) > 0]] = True
    return symbol[keep], np.append(0, np.cumsum(keep))[first]


def ngrams(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all trigrams within a text that have a letter, and the text of each; a shorter text is one n-gram with blanks."""
    length = np.diff(first)
    padded = np.concatenate([symbols, [0, 0]])
    count = np.where(length > 2, length - 2, np.minimum(length, 1))
    of = np.repeat(np.arange(len(length)), count)
    at = np.arange(count.sum()) + np.repeat(first[:-1] - (np.cumsum(count) - count), count)
    end = first[of + 1]
    part = lambda j: np.where(at + j < end, padded[at + j], 0)
    code = (part(0) * SYMBOLS + part(1)) * SYMBOLS + part(2)
    return code[code > 0], of[code > 0]


def letter_vectors(seed: int = 5) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).choice(np.array([-1, 1], np.float32), (SYMBOLS, DIMENSIONS))


def bind(codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The vector of each n-gram: the product of its letters' vectors, the first permuted twice and the second once."""
    twice, once = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
    return twice[codes // (SYMBOLS * SYMBOLS)] * once[codes // SYMBOLS % SYMBOLS] * letters[codes % SYMBOLS]


def bundle(codes: np.ndarray, of: np.ndarray, texts: int, letters: np.ndarray) -> np.ndarray:
    """The sum of the n-gram vectors of each text. Texts of a block share the work of binding."""
    out = np.zeros((texts, DIMENSIONS), np.float32)
    distinct, place = np.unique(codes, return_inverse=True)
    for low in range(0, texts, TABLES):
        high = min(low + TABLES, texts)
        a, b = np.searchsorted(of, [low, high])
        used = np.unique(place[a:b])
        index = np.zeros(len(distinct), np.int64)
        index[used] = np.arange(len(used))
        counts = np.bincount((of[a:b] - low) * len(used) + index[place[a:b]], minlength=(high - low) * len(used)).reshape(high - low, len(used))
        for k in range(0, len(used), 4096):
            out[low:high] += counts[:, k : k + 4096].astype(np.float32) @ bind(distinct[used[k : k + 4096]], letters)
    return out


@dataclass
class Profiles:
    languages: list[str]
    prototypes: np.ndarray  # unit vectors


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame) -> Profiles:
    """A prototype per language: the bundle of all n-grams of all its texts that are not held out.

    Tasks count n-grams per language, Spark adds the counts, and the sum of their vectors is taken per part of the n-gram
    space. What reaches the driver is one vector per language and part. Each text counts alike: its counts are divided by its length.
    Rows without text or language teach nothing.
    """
    letters = letter_vectors()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for row, end, data, offsets in slices(batch):
                code, of = ngrams(*letters_of(data, offsets))
                weight = 1 / np.maximum(np.bincount(of, minlength=end - row), 1)
                own = np.array(langs[row:end], object)[of] if len(of) else np.zeros(0, object)
                for lang in set(langs[row:end]):
                    of_lang = own == lang
                    block = np.flatnonzero(of_lang)
                    if len(block):
                        distinct, back = np.unique(code[block], return_inverse=True)
                        sums = np.bincount(back, weight[of[block]]).astype(np.float32)
                        total = totals.setdefault(lang, np.zeros(DIMENSIONS))
                        for k in range(0, len(distinct), 4096):
                            total += sums[k : k + 4096] @ bind(distinct[k : k + 4096], letters)
        for lang, vector in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(vector)], names=["lang", "place", "value"])

    teaching = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out()).select("lang", "text")
    sums = teaching.mapInArrow(count, "lang string, place int, value double").groupBy("lang", "place").agg(F.sum(F.round("value", 3)).alias("value"))
    rows = materialize(sums, "language-profiles").orderBy("lang", "place").toArrow()
    languages = rows.column("lang").to_pylist()[::DIMENSIONS]
    vectors = np.asarray(rows.column("value").to_numpy(), np.float64).reshape(len(languages), DIMENSIONS)
    return Profiles(languages, vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12))


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """doc_id, held_out, lang_pred, score: the language of the nearest prototype by cosine, the score its cosine moved to 0..1.

    A text that is null or has no letter is ``und`` with score 0, as is every text if nothing was learned. Ties go to the first
    language by code point.
    """
    languages, prototypes = profiles.languages, profiles.prototypes.astype(np.float32)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_vectors()
        for batch in batches:
            names, scores = [], []
            for row, end, data, offsets in slices(batch):
                code, of = ngrams(*letters_of(data, offsets))
                sums = bundle(code, of, end - row, letters)
                some = np.bincount(of, minlength=end - row) > 0
                if languages:
                    cosine = sums @ prototypes.T / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
                    best = cosine.argmax(1)
                    names += [languages[b] if s else UNKNOWN for b, s in zip(best, some)]
                    scores += [float(np.clip((1 + cosine[i, b]) / 2, 0, 1)) if s else 0.0 for i, (b, s) in enumerate(zip(best, some))]
                else:
                    names += [UNKNOWN] * (end - row)
                    scores += [0.0] * (end - row)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")

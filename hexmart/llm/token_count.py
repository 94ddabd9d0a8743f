"""Token counts of a unigram vocabulary without making the tokens."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 200_000


def read_vocabulary(path: str = VOCABULARY) -> tuple[tuple[str, float], ...]:
    """Pieces and scores of a sentencepiece model, without its control, unknown and byte pieces; a bounded table."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return tuple((model.id_to_piece(i), model.get_score(i)) for i in plain)


class Counter(dict):
    """Counts of words that begin after a space, made when first asked for.

    The automaton gives the pieces that end at a place, the longest first. A path is replaced only by a better one, so of
    equal paths the one whose last piece begins earliest stays, as in a search that goes forward by beginnings. A character
    that no piece of one character covers may be unknown, at the least score less a penalty, and then counts its bytes.
    """

    def __init__(self, pieces: tuple[tuple[str, float], ...]):
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.by_word = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p, _ in pieces)

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = count = self.best(SPACE + word)
        return count

    def best(self, text: str) -> int:
        """The number of pieces on the best path over ``text``."""
        n = len(text)
        scores: list[float | None] = [0.0] + [None] * n
        counts = [0] * (n + 1)
        place = 0

        def unknown(end: int) -> None:
            c = text[end - 1]
            if c not in self.single and scores[end - 1] is not None:
                score = scores[end - 1] + self.unknown
                if scores[end] is None or score > scores[end]:
                    scores[end], counts[end] = score, counts[end - 1] + len(c.encode())

        for last, (length, score) in self.automaton.iter(text):
            end = last + 1
            while place < end - 1:
                place += 1
                unknown(place)
            begin = scores[end - length]
            if begin is not None:
                score += begin
                if scores[end] is None or score > scores[end]:
                    scores[end], counts[end] = score, counts[end - length] + 1
        while place < n:
            place += 1
            unknown(place)
        return counts[n]

    def of(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.by_word:
            return self.best(SPACE + text.replace(" ", SPACE))
        words = text.split(" ")
        if SPACE in text or "" in words:
            return sum(self.best(run) for run in re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE)))
        return sum(map(self.__getitem__, words))


@lru_cache(maxsize=2)
def _counter(pieces: tuple[tuple[str, float], ...]) -> Counter:
    return Counter(pieces)


def count_tokens(docs: DataFrame, pieces: tuple[tuple[str, float], ...] | None = None) -> DataFrame:
    """doc_id, n_tokens of every whole text under the unigram model of ``pieces`` (piece, score).

    Spaces become ▁ and one stands before the text, nothing else is normalised; unknown characters fall back to bytes. Where no
    piece goes over a beginning of a word, the best path is the paths of the words, so each word is searched once and kept
    in a bounded table. A null or empty text has 0 tokens, repeated rows each a row; other columns are ignored.
    """
    pieces = read_vocabulary() if pieces is None else pieces

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(pieces)
        for batch in batches:
            counts = pa.array([counter.of(t.as_py()) for t in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), counts], names=["doc_id", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, n_tokens bigint")

"""Quality classifier by positive-unlabelled learning with the non-negative unbiased risk."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexmart.llm.bytestext import hash_between, prefix_hash, slices, word_bounds
from hexmart.session import materialize

# Kinds of bytes: each mark of ASCII by itself, letters and digits by kind, bytes of longer characters.
_KIND = np.zeros(256, np.int64)
_marks = [b for b in range(33, 127) if not chr(b).isalnum()]
for _i, _b in enumerate(_marks):
    _KIND[_b] = 9 + _i
_KIND[9:14] = 1
_KIND[10] = 2
_KIND[32] = 3
_KIND[48:58] = 4
_KIND[65:91] = 5
_KIND[97:123] = 6
_KIND[[ord(c) for c in "aeiou"]] = 7
_KIND[128:] = 8
KINDS = 9 + len(_marks)
SHAPES = 8
FEATURES = KINDS * KINDS + SHAPES


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text: shares of neighbouring byte kinds, square roots, and how long and how repetitive the text is."""
    docs = len(offsets) - 1
    out = np.zeros((docs, FEATURES), np.float32)
    size = np.diff(offsets)
    kind = _KIND[data]
    of = np.repeat(np.arange(docs), size)
    pair = np.zeros(len(data), np.int64)
    pair[1:] = np.where(of[1:] == of[:-1], kind[:-1], 0)
    shares = np.bincount(of * (KINDS * KINDS) + pair * KINDS + kind, minlength=docs * KINDS * KINDS).reshape(docs, -1)
    out[:, :-SHAPES] = np.sqrt(shares / np.maximum(size, 1)[:, None])
    starts, ends, first = word_bounds(data, offsets)
    words = hash_between(prefix_hash(data), starts, ends)
    for i in range(docs):
        own = words[first[i] : first[i + 1]]
        n = len(own)
        if not n:
            continue
        ranked = np.sort(own)
        distinct = 1 + int((ranked[1:] != ranked[:-1]).sum())
        twice = float((own[1:] == own[:-1]).mean()) if n > 1 else 0.0
        early = np.sort(own[: max(n // 2, 1)])
        late = np.searchsorted(early, own[n // 2 :])
        seen = float((early[np.minimum(late, len(early) - 1)] == own[n // 2 :]).mean())
        out[i, -SHAPES:] = (np.log1p(n) / 5, np.log1p(distinct) / 5, distinct / n, np.log(distinct / n), twice, seen, np.log1p(size[i] / n) / 2, n < 20)
    return out


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 250, rate: float = 0.05, decay: float = 1e-5) -> Model:
    """Logistic model that minimises prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)), full batches, Adam.

    While the second term is negative, the step goes against its gradient instead, as the non-negative estimator asks.
    """
    spread = np.maximum(np.concatenate([positive, unlabelled]).std(0), 1e-3)
    p, u = positive / spread, unlabelled / spread
    w, m, v = np.zeros(p.shape[1] + 1), np.zeros(p.shape[1] + 1), np.zeros(p.shape[1] + 1)
    value = lambda x: x @ w[:-1].astype(np.float32) + w[-1]
    for step in range(1, steps + 1):
        gp, gu = value(p), value(u)
        sp, su = 1 / (1 + np.exp(-np.clip(gp, -30, 30))), 1 / (1 + np.exp(-np.clip(gu, -30, 30)))
        negative = float(np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean())
        toward = lambda x, s: np.append(x.T @ s.astype(np.float32), s.sum()) / len(s)
        pull = prior * toward(p, sp - 1)
        push = toward(u, su) - prior * toward(p, sp)
        grad = pull + push if negative >= 0 else -push
        grad[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(w[:-1] / spread, float(w[-1]))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 4000) -> Model:
    """Fit on at most ``per_class`` trusted positives and as many unlabelled texts, both of rows that are not held out.

    Trusted positives are rows of label 1. Unlabelled texts are drawn from all rows, whatever their label. The class prior is
    the share of label 1 among the labelled rows. The samples are the least hashes of ids; an id that several rows share stands
    for one of their texts. Without positives or without texts the model knows nothing and gives the prior (0.5 without labels). Null labels and ids count as absent.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    shares = known.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    prior = min(max(0.5 if shares is None else shares, 0.01), 0.99)
    turn = F.xxhash64(F.col("doc_id").cast("string"), F.lit("quality"))
    draw = lambda df, kind: df.select("doc_id").distinct().orderBy(turn, "doc_id").limit(per_class).withColumn("kind", F.lit(kind))
    ids = draw(docs.where(F.col("doc_id").isNotNull() & ~held_out()), 0).unionByName(draw(known.where("quality = 1"), 1))
    # One text per drawn id, of at most 2 * per_class ids, however many rows share it.
    drawn = docs.select("doc_id", "text").join(F.broadcast(materialize(ids, "quality-sample")), "doc_id")
    chosen = drawn.groupBy("kind", "doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("kind", "text")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in slices(batch):
                x = features(data, offsets).astype(np.float16)
                yield pa.RecordBatch.from_arrays([batch.column("kind").slice(row, end - row), pa.array([r.tobytes() for r in x], pa.binary())], names=["kind", "x"])

    rows = chosen.mapInArrow(describe, "kind int, x binary").toArrow()
    kind = rows.column("kind").to_numpy()
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.float16).reshape(len(kind), FEATURES)
    if not (kind == 1).any() or not (kind == 0).any():
        return Model(np.zeros(FEATURES), float(np.log(prior / (1 - prior))))
    return fit(x[kind == 1].astype(np.float32), x[kind == 0].astype(np.float32), prior)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row. A null text counts as empty; both get the model's score of no features."""
    weights, bias = model.weights, model.bias

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(weights, bias)
        for batch in batches:
            parts = [own.score(features(data, offsets)) for _, _, data, offsets in slices(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(parts) if parts else [], pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs, train(docs, labels))


def keep_good(docs: DataFrame, labels: DataFrame, trained_on: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs``, unchanged, whose text scores 0.5 or more."""
    model = train(docs if trained_on is None else trained_on, labels)
    weights, bias = model.weights, model.bias

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(weights, bias)
        for batch in batches:
            parts = [own.score(features(data, offsets)) for _, _, data, offsets in slices(batch)]
            if parts:
                yield batch.filter(pa.array(np.concatenate(parts) >= 0.5))

    return docs.mapInArrow(keep, docs.schema)

"""Whitening and hard negatives against plain versions."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexmart.llm import bond, whitening
from hexmart.llm.queries import QUERIES
from tests.llm.conftest import SF

NAN, INF = float("nan"), float("inf")


def plain_whitening(rows, k):
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in rows], dtype=np.int64)
    n, total = len(x), x.sum(axis=0)
    y = (x * n - total) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-values)[:k]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, total)) for r in x]
    return deviation, y @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def test_whitening_of_the_given_vectors(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rows = [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    deviation, whitened, explained = plain_whitening(rows, 8)
    got = defaultdict(dict)
    for r in QUERIES["op11_whitening"](spark, SF).collect():
        got[r.vec_id][r.component] = r
    assert set(got) == {i for i, _ in rows} and all(set(v) == set(range(1, 9)) for v in got.values())
    mine = np.array([[got[i][c].whitened for c in range(1, 9)] for i, _ in rows])
    signs = np.sign((mine * whitened).sum(axis=0))
    assert np.allclose(mine * signs, whitened, rtol=1e-7, atol=1e-7)
    assert [got[i][1].deviation for i, _ in rows] == deviation
    assert np.allclose([got[rows[0][0]][c].explained for c in range(1, 9)], explained, rtol=1e-9)
    assert {r.n for v in got.values() for r in v.values()} == {len(rows)} and got[rows[0][0]][1].identity_error < 1e-9


def test_whitening_stays_exact_where_a_covariance_would_not(spark):
    """Singular values over ten orders of magnitude: a covariance in doubles loses the small ones, the R factor does not."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5)) * np.array([2.0**40, 2.0**24, 2.0**12, 30.0, 3.0])
    x[:, 1:] += x[:, :1] * 2.0**-30
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    stored = whitening.integers(df, scale=1024, offset=0)
    model = whitening.fit(stored, 5)
    exact = np.floor(x * 1024)
    y = (exact * 400 - exact.sum(axis=0)) / 400
    values = np.linalg.svd(y, compute_uv=False) ** 2 / 400
    assert len(model.eigenvalues) == 5 and np.allclose(model.eigenvalues, values, rtol=1e-6) and model.identity_error < 1e-5


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(1)
    vectors = [[float(a), float(a) * 2, 0.5, float(b)] for a, b in rng.integers(0, 9, (60, 2))]  # dependent and constant dimensions
    rows = [(i % 50, v, "x", i) for i, v in enumerate(vectors)]
    bad = [(None, vectors[0], None, None), (60, None, "x", 1), (61, [1.0, None, 0.0, 0.0], "x", 1), (62, [NAN, 1.0, 0.0, 0.0], "x", 1), (63, [INF, 1.0, 0.0, 0.0], "x", 1), (64, [1.0], "x", 1), (65, [], "x", 1)]
    df = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>, x string, n int")
    out = whitening.whiten(df).collect()
    taken = rows + bad[:1]
    assert Counter((r.vec_id, r.component) for r in out) == Counter((r[0], c) for r in taken for c in (1, 2))
    deviation, whitened, _ = plain_whitening([r[:2] for r in taken], 2)
    assert Counter(int(r.deviation) for r in out if r.component == 1) == Counter(deviation)
    assert np.allclose(sorted(abs(r.whitened) for r in out), sorted(np.abs(whitened).ravel()), atol=1e-9) and out[0].identity_error < 1e-9
    for few in (df.limit(0), df.where("vec_id = 1 and n = 1"), df.where("vec_id = 65"), spark.createDataFrame([(1, [2.0]), (2, [2.0])], "vec_id int, embedding array<float>")):
        assert whitening.whiten(few).count() == 0
    with pytest.raises(OverflowError):
        whitening.whiten(spark.createDataFrame([(1, [1e15]), (2, [2e15]), (3, [3e15]), (4, [4e15]), (5, [5e15])], "vec_id int, embedding array<double>"))


def test_deviations_of_any_size():
    rows = np.array([[3, -4, 0], [2**30, -(2**31), 5], [2**50, 2**51, -(2**50)], [2**61, -(2**61), 1]], dtype=np.int64)
    for part in (rows[:1], rows[:2], rows[:3], rows):
        assert whitening._deviations(part) == [sum(int(v) ** 2 for v in r) for r in part]
    assert whitening._deviations(rows[:0]) == []


def plain_mining(rows, anchors, k=5, m=5, percent=80):
    """rows: (id, label, integer vector), each once."""
    out = []
    for a, label, q in anchors:
        score = lambda v: sum(int(x) * int(y) for x, y in zip(q, v))
        liked = sorted((-score(v), i) for i, lab, v in rows if lab == label and i != a)[:k]
        other = sorted((-score(v), i) for i, lab, v in rows if lab != label)
        for s, p in liked:
            hits = [(i, -t) for t, i in other if percent * -s <= 100 * -t <= 100 * -s][:m]
            out += [(a, p, n, i, -s, t) for n, (i, t) in enumerate(hits, 1)]
    return Counter(out)


def test_mining_the_given_vectors(spark, monkeypatch):
    rows = []
    for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect():
        if r.label is not None and r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding):
            label = (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label
            rows.append((r.vec_id, label, tuple(math.floor(256 * float(c)) for c in r.embedding)))
    want = plain_mining(rows, [r for r in rows if r[0] % 100 == 0])
    assert Counter(tuple(r) for r in QUERIES["op13_hard_negatives"](spark, SF).collect()) == want and want
    monkeypatch.setattr(bond, "BLOCK_ROWS", 60)
    monkeypatch.setattr(bond, "ANCHORS", 2)
    assert Counter(tuple(r) for r in QUERIES["op13_hard_negatives"](spark, SF).collect()) == want


def test_mining_ties_repeats_and_odd_rows(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(int(i), int(rng.integers(0, 3)), tuple(map(int, rng.integers(-3, 4, 6)))) for i in range(150)]
    rows += [(7, 0, (1, 1, 1, 1, 1, 1)), (200, 1, rows[0][2]), (0, 2, rows[1][2])]  # ids that stand for two rows
    given = [(i, lab, [float(c) for c in v], "x", 1) for i, lab, v in rows]
    bad = [(None, 1, given[0][2], "x", 1), (300, None, given[0][2], "x", 1), (301, 1, None, "x", 1), (302, 1, [None] * 6, "x", 1), (303, 1, [NAN] * 6, "x", 1), (304, 1, [INF] * 6, "x", 1),
           (305, 1, [1.0] * 7, "x", 1), (306, 1, [], "x", 1)]
    df = spark.createDataFrame(given + given[:40] + given[:3] * 5 + bad, "vec_id bigint, label int, embedding array<double>, rank string, block int")
    distinct = list(dict.fromkeys(rows))
    want = plain_mining(distinct, [r for r in distinct if r[0] % 10 == 0])
    for size in (8192, 20):
        monkeypatch.setattr(bond, "BLOCK_ROWS", size)
        assert Counter(tuple(r) for r in bond.mine(df, F.col("vec_id") % 10 == 0, scale=1).collect()) == want
    assert bond.mine(df.limit(0), F.lit(True)).count() == 0 and bond.mine(df, F.lit(False)).count() == 0
    assert bond.mine(df.where("label = 1"), F.lit(True)).count() == 0


@pytest.mark.parametrize("scale", [1, 1 << 14, 1 << 24, 1 << 30])
def test_scan_is_exact_at_every_width(scale):
    rng = np.random.default_rng(scale)
    rows, labels = np.floor(rng.normal(0, scale, (500, 19))), rng.integers(0, 2, 500)
    block = bond.Block(np.arange(500), labels, rows, int(np.abs(rows).max()))
    whole = [[int(c) for c in r] for r in rows]
    for a in range(0, 500, 50):
        score = [sum(x * y for x, y in zip(whole[a], r)) for r in whole]
        liked = sorted((-score[i], i) for i in range(500) if labels[i] == labels[a] and i != a)[:4]
        assert bond.best(block, rows[a], a, labels[a], 4) == [(-s, i) for s, i in liked]
        tops = [-s for s, _ in liked]
        want = [(t, score[i], i) for t in sorted(set(tops)) for i in sorted((i for i in range(500) if labels[i] != labels[a] and 80 * t <= 100 * score[i] <= 100 * t), key=lambda i: (-score[i], i))[:3]]
        assert bond.in_windows(block, rows[a], labels[a], tops, 80, 3) == want


def test_scan_drops_rows_before_the_last_dimension():
    rng = np.random.default_rng(2)
    rows = np.floor(rng.normal(0, 1, (4000, 64)) * 2.0 ** -np.arange(64)[None] * 1e6)
    block, seen = bond.Block(np.arange(4000), np.zeros(4000, int), rows, int(np.abs(rows).max())), []
    block.scan(rows[0], np.arange(4000), lambda least, most: (seen.append(len(least)), most >= bond._largest(least, 5))[1])
    assert seen[0] == 4000 and seen[-1] < 100

"""Operators that find copies, against brute force."""

import hashlib

import numpy as np
import pytest

from hexmart.llm import components, exchange, minhash, recompression, simhash, suffix
from tests.llm import brute


def pairs_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates(docs, words):
    got = {r[0]: tuple(r[1:]) for r in minhash.near_duplicates(docs, words).collect()}
    assert got == brute.near_components(pairs_of(docs), words, 80)


def test_near_duplicates_of_given_documents(given):
    got = {r[0]: tuple(r[1:]) for r in minhash.near_duplicates(given, 5).collect()}
    assert got == brute.near_components(pairs_of(given), 5, 80)


def test_near_duplicates_odd_rows(odd, none):
    out = minhash.near_duplicates(odd, 5)
    assert out.count() == odd.count() and minhash.near_duplicates(none, 5).count() == 0
    assert all(r.kept and r.component_id is None for r in out.where("doc_id is null").collect())


def test_group_with_copies_of_every_distance(spark):
    rng = np.random.default_rng(3)
    base, rows = [f"b{i}" for i in range(60)], []
    for d in range(150):
        w = list(base)
        for i in rng.choice(60, d % 16, replace=False):
            w[i] = f"n{d}_{i}"
        rows.append((d, " ".join(w)))
    got = {r[0]: tuple(r[1:]) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 2).collect()}
    assert got == brute.near_components(rows, 2, 80)


def test_group_of_copies_that_are_not_similar_is_not_paired(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base, rows = [f"b{i}" for i in range(100)], []
    for d in range(160):
        w = list(base)
        for i in rng.choice(100, 4, replace=False):
            w[i] = f"n{d}_{i}"
        rows.append((d, " ".join(w)))
    rows += [(1000 + d, text + " end") for d, text in rows[:20]]
    compared, verified = [], minhash._verified

    def counted(pairs, *args):
        compared.append(pairs.count())
        return verified(pairs, *args)

    monkeypatch.setattr(minhash, "_verified", counted)
    got = {r[0]: tuple(r[1:]) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 2).collect()}
    assert got == brute.near_components(rows, 2, 80) and got[1000][1] == got[0][1]
    assert compared[-1] < 0.2 * len(rows) * (len(rows) - 1) / 2


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_links_across_components(spark, percent):
    rng = np.random.default_rng(percent)
    sets = []
    for size in (5, 40, 150):
        for _ in range(60):
            changed = rng.random(size) < rng.choice([0, 0.02, 0.1, 0.3, 0.9])
            sets.append(sorted({int(s) for s in np.where(changed, rng.integers(1000, 1000 + 2 * size, size), np.arange(size))}))
    sets = [list(s) for s in sorted({tuple(s) for s in sets})]
    root = [i if i % 3 else 0 for i in range(len(sets))]
    frame = spark.createDataFrame([(i, len(s), s) for i, s in enumerate(sets)], "node bigint, n bigint, shingles array<bigint>")
    apart = spark.createDataFrame([(i % 2, i, r) for i, r in enumerate(root)] + [(7, i, root[i]) for i in (0, 1)], "key bigint, node bigint, root bigint")
    links = [tuple(r) for r in minhash._across(apart, frame.unionByName(frame.limit(9)), percent).collect()]

    def similar(x, y):
        both = len(set(sets[x]) & set(sets[y]))
        return 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both)

    def parts(pairs):
        up = list(root)
        for x, y in pairs:
            a, b = up[x], up[y]
            up = [min(a, b) if r in (a, b) else r for r in up]
        return up

    assert links and all(similar(x, y) and root[x] != root[y] for x, y in links) and len(set(links)) == len(links)
    assert parts(links) == parts((x, y) for x in range(len(sets)) for y in range(x) if similar(x, y))


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 8), (7, 3), (20, 21), (21, 22), (22, 23), (23, 24), (20, 24)], "x bigint, y bigint")
    assert {tuple(r) for r in components.connect(links).collect()} == {(2, 1), (3, 1), (7, 1), (9, 8), (21, 20), (22, 20), (23, 20), (24, 20)}
    assert components.connect(links.limit(0)).count() == 0


@pytest.mark.parametrize("window", [5, 35])
def test_repeated_words(odd, window):
    got = sorted((tuple(r) for r in recompression.repeat_digest(odd, window).collect()), key=str)
    assert got == brute.repeated_words(pairs_of(odd), window)


def test_repeated_words_of_given_documents(given, none):
    got = sorted((tuple(r) for r in recompression.repeat_digest(given).collect()), key=str)
    assert got == brute.repeated_words(pairs_of(given), 35)
    assert recompression.repeat_digest(none).count() == 0 and recompression.remove_repeats(none).count() == 0


def test_remove_repeats_keeps_columns_and_texts(docs):
    got = {r.doc_id: r for r in recompression.remove_repeats(docs, 35).collect()}
    want = {r[0]: r for r in brute.repeated_words(pairs_of(docs), 35)}
    for r in docs.collect():
        assert set(got[r.doc_id].asDict()) == set(r.asDict())
        left = brute.tokens(got[r.doc_id].text)
        assert hashlib.sha256(" ".join(left).encode()).hexdigest() == want[r.doc_id][3]
        if not want[r.doc_id][2]:
            assert got[r.doc_id].text == r.text
        assert got[r.doc_id].n_chars == (None if r.text is None else len(got[r.doc_id].text))


def test_earlier_bytes(odd, none):
    got = sorted((tuple(r) for r in suffix.shared_digest(odd).collect()), key=str)
    assert got == brute.earlier_bytes(pairs_of(odd), 50)
    assert suffix.shared_digest(none).count() == 0


def test_earlier_bytes_of_given_documents(given):
    got = sorted((tuple(r) for r in suffix.shared_digest(given).collect()), key=str)
    assert got == brute.earlier_bytes(pairs_of(given), 50)


@pytest.mark.parametrize("n", [9, 200, 3000])
def test_interval_expansion(n):
    text = np.random.default_rng(n).integers(1, 3, n).astype(np.uint8)
    text[n // 2 : n // 2 + n // 4] = text[: n // 4]
    text[-1] = 0
    order, packed = suffix.sort_suffixes(text, 50)
    whole = text.tobytes()
    for length in (8, 12, 30):
        want = [True] + [whole[b : b + length] != whole[a : a + length] for a, b in zip(order, order[1:])]
        assert suffix.equal_prefix_starts(text, order, packed, length).tolist() == want


def test_fingerprints(odd, none):
    rows = sorted(((2**63 if d is None else d, t or "", d) for d, t in pairs_of(odd)), key=lambda r: r[:2])
    want = []
    for (_, text, d), (_, after, _) in zip(rows, rows[1:] + rows[:1]):
        k = len(text) // 4
        want.append((d, len(text), hashlib.sha256((text[: len(text) - k] + after[:k]).encode()).hexdigest()))
    out = simhash.edited_fingerprints(odd).collect()
    assert sorted((tuple(r[:3]) for r in out), key=str) == sorted(want, key=str)
    by_text = {}
    for (_, text, d), _ in zip(rows, rows):
        by_text.setdefault(text, set()).update(r.fingerprint for r in out if r.doc_id == d and d is not None)
    assert by_text[brute.LOREM].__len__() == 1 and simhash.edited_fingerprints(none).count() == 0


def test_likeness_separates(given):
    out = simhash.edited_fingerprints(given).toPandas()
    assert out.near_edited.mean() > 0.7 > 0.55 > out.near_next.mean()


def test_votes():
    texts = ["a b c d " * 200, "a b", "", "q"]
    got = simhash.fingerprint_texts(texts)
    assert got[2].sum() == 0 and got[1].any() and got.shape == (4, 16)
    assert (simhash.fingerprint_texts(["a b"]) == got[1]).all()


def test_near_fingerprints(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 256, 16).astype(np.uint8)
    names = {base.tobytes().hex()}
    for flips in (1, 2, 3, 4, 6):
        for _ in range(6):
            bits = np.unpackbits(base)
            bits[rng.choice(128, flips, replace=False)] ^= 1
            names.add(np.packbits(bits).tobytes().hex())
    names = sorted(names)
    apart = lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1")
    want = {(a, b, apart(a, b)) for a in names for b in names if a < b and apart(a, b) <= 3}
    df = spark.createDataFrame([(n,) for n in [*names, names[0], None]], "fingerprint string")
    assert {tuple(r) for r in simhash.near_fingerprints(df).collect()} == want


@pytest.mark.parametrize("length", [16, 17, 140, 1000])
def test_earlier_bytes_of_other_lengths(spark, length):
    rng = np.random.default_rng(length)
    passage = "".join(rng.choice(list("abcdefg "), 3 * length))
    texts = ["".join(rng.choice(list("abcdefg "), n)) + passage[n : n + 2 * length] for n in (0, 7, 40, 300, 5)] + [passage, passage, None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = sorted((tuple(r) for r in suffix.shared_digest(df, length).collect()), key=str)
    assert got == brute.earlier_bytes(pairs_of(df), length) and sum(r[2] for r in got) > length


def test_lengths_without_meaning_are_refused(none):
    for length in (15, 30_001):
        with pytest.raises(ValueError):
            suffix.shared_digest(none, length)


@pytest.mark.parametrize("kind", [np.int32, np.int64])
def test_packed_numbers_come_back(kind):
    edge = np.iinfo(kind)
    for numbers in ([], [0], [edge.max, edge.min, 0, -1, 1, edge.min, edge.max], list(range(-300, 70_000, 7))):
        numbers = np.array(numbers, kind)
        assert exchange.from_steps(exchange.steps(numbers), kind).tolist() == numbers.tolist()
        assert exchange.from_planes(exchange.planes(numbers), kind).tolist() == numbers.tolist()

"""Counts, classifiers, languages, neighbours, mixing and packing."""

import math
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexmart.llm import crosspolytope, language, mixing, packing, quality, token_count
from tests.llm import brute
from tests.llm.conftest import SF


def test_token_counts_match_a_tokenizer(spark, given, odd, none):
    tokenizers = pytest.importorskip("tokenizers")
    if not os.path.exists(token_count.VOCABULARY):
        pytest.skip("needs a vocabulary file")
    pieces = token_count.read_vocabulary()
    bytes_ = [(f"<0x{b:02X}>", 0.0) for b in range(256)]
    model = tokenizers.Tokenizer(tokenizers.models.Unigram([("<unk>", 0.0), *bytes_, *pieces], 0, True))
    model.pre_tokenizer = None
    space = token_count.SPACE
    for df in (given, odd):
        texts = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect() if r.doc_id is not None]
        want = Counter((d, len(model.encode(space + t.replace(" ", space)).tokens) if t else 0) for d, t in texts)
        assert Counter(tuple(r) for r in token_count.count_tokens(df.where("doc_id is not null")).collect()) == want
    assert token_count.count_tokens(none).count() == 0


def test_token_count_ties_and_crossing_pieces(spark):
    pieces = (("▁a", -1.0), ("b", -1.0), ("▁ab", -2.0), ("▁", -1.0), ("a", -1.0), ("ab", -1.0), ("a▁b", -0.5))
    plain = token_count.Counter(pieces[:-1])
    assert [plain.of(t) for t in ("ab", "ab  ab", "", None, "é", "aé日")] == [1, 3, 0, 0, 1 + 2, 1 + 2 + 3]
    assert not token_count.Counter(pieces).by_word and token_count.Counter(pieces).of("a b") == 2


def test_mixing_reaches_targets(spark, given, odd, none):
    for df in (given, odd):
        out = mixing.mix_sources(df).collect()
        assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in df.collect())
        assert Counter((r.doc_id, r["size"]) for r in out) == Counter((r.doc_id, len(brute.tokens(r.text))) for r in df.collect())
        by = defaultdict(list)
        for r in out:
            by[r.source].append(r)
            assert r.taken <= 3 * r["size"] and r.taken == r.repeats * r["size"]
        total = sum(r["size"] for r in out)
        assert sum(v[0].target for v in by.values()) == pytest.approx(total)
        for source, v in by.items():
            assert abs(sum(r.taken for r in v) - v[0].target) <= max(r["size"] for r in v) / 2 + 1e-6
            assert v[0].target <= 3 * v[0].source_size
    assert mixing.mix_sources(none).count() == 0 and mixing.take_mix(none).count() == 0


def test_water_filling(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, None: 200}
    weights = {"a": 1, "b": 2, "c": 3, None: 1}
    got = {r.source: r.target for r in mixing.water_fill(mixing.cycled_weights(spark.createDataFrame(list(sizes.items()), "source string, source_size bigint"))).collect()}
    target, capped = {}, set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        share = sum(w for s, w in weights.items() if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else left * w / share for s, w in weights.items()}
        over = {s for s in sizes if s not in capped and target[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    assert got == pytest.approx(target)


def test_take_mix_repeats_rows(odd):
    counts = Counter()
    for r in mixing.mix_sources(odd).collect():
        counts[(r.doc_id, r["size"])] += r.repeats
    taken = mixing.take_mix(odd)
    assert taken.columns == odd.columns
    assert Counter((r.doc_id, len(brute.tokens(r.text))) for r in taken.collect()) == +counts


def test_packing(spark, given, odd, none):
    copies = given.unionByName(given).unionByName(given)
    for df, capacity, per_source in ((given, 500, 2), (odd, 64, 1), (copies, 300, 2)):
        out = packing.pack(df, capacity, per_source).collect()
        size, source, text = Counter(), defaultdict(Counter), defaultdict(Counter)
        by_id = {r.doc_id: r for r in df.collect()}
        for r in out:
            if r.bin_id is None:
                assert r.length == 0
                continue
            size[r.bin_id] += r.length
            source[r.bin_id][r.source] += 1
            text[r.bin_id][by_id[r.doc_id].text] += 1
        assert max(size.values()) <= capacity
        assert all(max(c.values()) <= per_source for c in source.values()) and all(max(c.values()) == 1 for c in text.values())
        assert Counter({k: v for k, v in _words(out).items()}) == Counter(_sizes(df))
    assert packing.pack(none).count() == 0


def _words(out):
    total = Counter()
    for r in out:
        total[r.doc_id] += r.length
    return total


def _sizes(df):
    total = Counter()
    for r in df.collect():
        total[r.doc_id] += len(brute.tokens(r.text))
    return total


def test_best_fit_takes_the_tightest_compatible_bin():
    pieces = [(6, "a", 1), (5, "b", 2), (4, "b", 1), (5, "c", 3), (3, "d", 2)]
    bins = packing.best_fit(pieces, 10, 1)
    assert bins[1] == bins[3] and bins[0] != bins[2] and bins[4] == bins[0]


def test_quality_held_out(spark, given, odd, none):
    docs, labels = (spark.read.parquet(f"{SF[:-5]}0.01/{t}.parquet") for t in ("documents", "labels"))
    out = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (out.predicted == out.quality).mean() > 0.93
    scores = quality.classify(odd, labels).collect()
    assert len(scores) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scores)
    nothing = labels.where("false")
    assert {r.score for r in quality.classify(odd, nothing).collect()} == {0.5}
    assert quality.classify(none, labels).count() == 0 and quality.keep_good(none, nothing).count() == 0


def test_a_repeated_id_is_sampled_once(spark, monkeypatch):
    """Three hundred rows of one id beside others: as many texts reach the driver as ids are drawn."""
    rows = [(7, f"same id text {i} " * 5) for i in range(300)] + [(i, f"word{i} another text of its own " * 4) for i in range(100, 160)]
    labels = spark.createDataFrame([(7, 1)] + [(i, i % 2) for i in range(100, 160)], "doc_id bigint, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda p, u, prior: (seen.append((len(p), len(u))), quality.Model(np.zeros(quality.FEATURES), 0.0))[1])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    quality.train(docs, labels)
    kept = [d for d in {r[0] for r in rows} if zlib.crc32(str(d).encode()) % 3 != 1]
    assert seen == [(sum(1 for d in kept if d == 7 or d % 2), len(kept))]


def test_non_negative_risk_learns_from_positives_and_unlabelled():
    rng = np.random.default_rng(0)
    positive, unlabelled = rng.normal(1, 1, (2000, 5)), np.concatenate([rng.normal(1, 1, (1200, 5)), rng.normal(-1, 1, (800, 5))])
    model = quality.fit(positive.astype(np.float32), unlabelled.astype(np.float32), 0.6)
    right = (model.score(rng.normal(1, 1, (500, 5))) >= 0.5).mean() + (model.score(rng.normal(-1, 1, (500, 5))) < 0.5).mean()
    assert right / 2 > 0.95


def test_language(spark, odd, none):
    docs = spark.read.parquet(f"{SF[:-5]}0.01/documents.parquet")
    profiles = language.learn(docs)
    out = language.identify(docs, profiles).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (out.lang == out.lang_pred).mean() > 0.97
    got = language.identify(odd, profiles).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == odd.count() and all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (4, 5, 6, 18, 100))
    assert all(0 <= r.score <= 1 for r in got)
    empty = language.learn(none)
    assert {r.lang_pred for r in language.identify(odd, empty).collect()} == {"und"} and language.identify(none, profiles).count() == 0


def test_letters_fold_case_and_blanks():
    data = np.frombuffer("Ab  9c É".encode() + "é".encode(), np.uint8)
    symbols, first = language.letters_of(data, np.array([0, 9, 11]))
    assert symbols[:5].tolist() == [1, 2, 0, 3, 0] and symbols[5] == symbols[6] and first.tolist() == [0, 6, 7]


def test_neighbours(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in vectors.collect()]
    out = defaultdict(list)
    for r in crosspolytope.nearest(vectors, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.score, r.vec_id))
    hits = total = 0
    for q, v in rows:
        if q % 20 == 0:
            want = sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, x in rows if i != q)[:10]
            hits += len({i for _, i in want} & {i for _, i in out[q]})
            total += 10
            assert out[q] == sorted(out[q])
    assert hits / total >= 0.9


def test_queries_with_few_candidates_get_all(spark, monkeypatch):
    """Eight vectors: seven neighbours each, although most buckets are empty; also in blocks."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(8, 64))
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(0, [float(c) for c in x[0]])], "vec_id bigint, embedding array<double>")
    want = {q: [i for _, i in sorted((float(np.sqrt(((x[q] - v) ** 2).sum())), i) for i, v in enumerate(x) if i != q)] for q in (0, 3, 6)}
    for size in (20_000, 3):
        monkeypatch.setattr(crosspolytope, "BUCKET_ROWS", size)
        got = defaultdict(list)
        for r in crosspolytope.nearest(df, F.col("vec_id") % 3 == 0).orderBy("query_id", "rank").collect():
            got[r.query_id].append(r.vec_id)
        assert got == want
    assert crosspolytope.nearest(df.where("vec_id = 0"), F.lit(True)).count() == 0


def test_neighbours_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [0.0, 2.0, 0.0]), (4, None), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 0.0]), (7, [nan, 1.0, 0.0]),
            (8, [inf, 0.0, 0.0]), (9, []), (10, [1.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("query", F.lit("x")).withColumn("part", F.lit(1))
    got = [tuple(r) for r in crosspolytope.nearest(df, F.col("vec_id") == 0).collect()]
    assert got == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 3, math.sqrt(5))]
    assert crosspolytope.nearest(df.limit(0), F.lit(True)).count() == 0


def test_cheapest_keys_are_those_of_the_least_sums():
    rng = np.random.default_rng(3)
    first, second = rng.random((2, 5, 16))
    a, b = crosspolytope.cheapest_keys(first, second, 9)
    for i in range(5):
        sums = sorted((float(x + y), j, k) for j, x in enumerate(first[i]) for k, y in enumerate(second[i]))
        assert {(j, k) for _, j, k in sums[:9]} == set(zip(a[i].tolist(), b[i].tolist()))
    assert crosspolytope.cheapest_keys(first, second, 10_000)[0].shape == (5, 256)


def test_keys_looked_at_do_not_follow_the_size(spark):
    """Rows that are never nearer change no result, however many they are."""
    rng = np.random.default_rng(5)
    near, far = rng.normal(size=(200, 16)), 100 * rng.normal(size=(4000, 16))
    frame = lambda rows: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id bigint, embedding array<double>")
    found = [sorted(map(tuple, crosspolytope.nearest(frame(rows), F.col("vec_id") < 100, k=1, tables=1, probes=64).collect())) for rows in (near, np.concatenate([near, far]))]
    assert found[0] == found[1] and len(found[0]) == 100


def test_share_of_rows_met_is_bounded():
    """Around 40 centres, as rows of a corpus are; the share counts all tables, the recall that of the nearest ten."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 64))
    shares = []
    for n in (2_000, 40_000):
        x = centres[rng.integers(0, 40, n)] + rng.normal(size=(n, 64))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        seen, looks = np.zeros((50, n), bool), crosspolytope.PROBES
        for table in range(crosspolytope.TABLES):
            costs = [crosspolytope.axis_costs(crosspolytope.rotate(x, 2 * table + k)) for k in (0, 1)]
            key = costs[0].argmin(1) * 128 + costs[1].argmin(1)
            a, b = crosspolytope.cheapest_keys(costs[0][:50], costs[1][:50], looks)
            for i in range(50):
                seen[i] |= np.isin(key, a[i] * 128 + b[i])
        distance = ((x[:50, None] - x[None]) ** 2).sum(-1) if n < 5_000 else np.stack([((x - y) ** 2).sum(1) for y in x[:50]])
        distance[np.arange(50), np.arange(50)] = np.inf
        nearest = np.argsort(distance, axis=1)[:, :10]
        assert np.take_along_axis(seen, nearest, 1).mean() >= 0.9
        shares.append(seen.mean())
    assert max(shares) < 0.4


def test_packing_spreads_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 500)
    docs = spark.range(6000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("web").alias("source"), F.lit("a b c").alias("text"), F.col("id").alias("copy"))
    out = packing.pack(docs).collect()
    groups = defaultdict(int)
    for r in out:
        assert (r.doc_id, r.source, r.piece, r.start, r.length) == (7, "web", 0, 0, 3)
        groups[r.bin_id >> 32] += 1
    assert len(out) == 6000 == len({r.bin_id for r in out}) and len(groups) == 13 and max(groups.values()) < 700


def test_mix_takes_the_same_texts_again(spark):
    rows = [(None if i % 2 else 5, f"s{i % 3}", f"word{i} of some text {'x ' * (i % 4)}", i) for i in range(400)]
    taken = []
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id bigint, source string, text string, size bigint").repartition(3 + len(taken))
        taken.append(sorted(map(repr, mixing.take_mix(df).collect())))
    assert taken[0] == taken[1] and len(taken[0]) > 300

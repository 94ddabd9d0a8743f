import random

import pytest
from pyspark.sql import functions as F

from hexmart.operators import hierjoin, rowid, skew
from hexmart.operators.lookup import not_in, standardize_field, unnest_json
from hexmart.operators.rowid import dense_row_id
from hexmart.plans import datamart
from tests import plain


def random_cells(rng, n, lo, hi, tops=7):
    return {plain.make(20, [rng.randrange(tops) if i == 0 else rng.randrange(3) for i in range(rng.randint(lo, hi))]) for _ in range(n)}


def test_adaptive_join_equals_the_cell_by_cell_version(spark, monkeypatch):
    for seed, salt_rows in ((1, 1_000_000), (2, 3)):
        # A tiny salt size makes every ancestor "hot".
        monkeypatch.setattr(hierjoin, "ROWS_PER_SALT", salt_rows)
        rng = random.Random(seed)
        src, tar = random_cells(rng, 200, 1, 6), random_cells(rng, 60, 2, 5, tops=4)
        lo, hi = min(map(plain.res, tar)), max(map(plain.res, tar))
        rows = spark.createDataFrame([(c,) for c in src] * 2, "cell bigint")
        targets = spark.createDataFrame([(c,) for c in tar] * 3, "cell bigint")
        got = [tuple(r) for r in hierjoin.adaptive_join(rows, targets, lo, hi).collect()]
        want = plain.adaptive_pairs(src, tar, lo, hi)
        assert len(got) == len(set(got)) and set(got) == want
        up = {s for s, t in want if plain.res(t) <= plain.res(s)}
        down = {s for s, t in want if plain.res(t) > plain.res(s)}
        assert up and down and src - up - down
        narrowed = hierjoin.adaptive_join(rows, targets, lo, hi, src_res_min=min(map(plain.res, src)))
        assert {tuple(r) for r in narrowed.collect()} == want


def test_profile_finds_heavy_cells(spark):
    hot, other = plain.make(20, [1, 2]), plain.make(20, [1, 2, 3])
    df = spark.createDataFrame([(hot,)] * 50 + [(other,)] * 3 + [(None,)] * 99, "cell bigint")
    profile = skew.cell_profile(df, hot_rows=10)
    assert (profile.lo, profile.hi) == (2, 3) and sorted(map(tuple, profile.cells.collect())) == sorted([(hot, 50), (other, 3)])
    assert [tuple(r) for r in profile.heavy.collect()] == [(hot, 5)]
    assert skew.cell_profile(df).heavy is None


def test_heavy_keys_are_few_at_any_size(spark):
    """A key is heavy above a ten-thousandth of the rows, so their number is bounded however small ``rows_per_task`` is."""
    counts = spark.range(20_000).select(F.col("id").alias("k"), F.lit(100).alias("_n"))
    assert skew.heavy_keys(counts, "k", 1) is None
    one = counts.unionByName(spark.createDataFrame([(-1, 10**9)], "k bigint, _n int"))
    assert [r.k for r in skew.heavy_keys(one, "k", 1).collect()] == [-1]
    assert skew.heavy_keys(counts.limit(0), "k") is None


def test_weighted_join_equals_plain_join(spark):
    left = spark.createDataFrame([(1, i) for i in range(40)] + [(2, 100), (3, 101), (None, 102)], "k int, v int")
    right = spark.createDataFrame([(1, f"{n}") for n in range(30)] + [(2, "c"), (5, "d")], "k int, w string")
    heavy = [skew.heavy_keys(skew.key_counts(df, "k"), "k", 4) for df in (left, right)]
    assert all(h is not None for h in heavy)
    for how, *sides in (("inner", None, None), ("inner", heavy[0], None), ("inner", None, heavy[1]), ("inner", *heavy), ("left", heavy[0], None)):
        want = sorted(map(str, left.join(right, "k", how).collect()))
        assert sorted(map(str, skew.weighted_join(left, right, "k", how, *sides).select("k", "v", "w").collect())) == want
    with pytest.raises(ValueError):
        skew.weighted_join(left, right, "k", "left", *heavy)


def largest_share(joined):
    """The part of all rows that the fullest task has, with partitions as the join makes them."""
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


@pytest.fixture
def plain_shuffles(spark):
    """No merging or splitting of partitions at run time and no broadcast of a whole side, so that only salts can spread a key."""
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_one_key_with_nearly_all_rows_is_spread(spark, plain_shuffles):
    left = spark.range(20_000).select(F.when(F.col("id") < 100, F.col("id")).otherwise(F.lit(7)).alias("k"), F.col("id").alias("v"))
    right = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("w"))
    assert largest_share(left.join(right, "k")) > 0.9
    heavy = skew.heavy_keys(skew.key_counts(left, "k"), "k", 200)
    assert largest_share(skew.weighted_join(left, right, "k", "inner", heavy)) < 0.25
    assert largest_share(skew.weighted_join(left, right, "k", "left", heavy)) < 0.25
    wide = skew.weighted_join(right, left, "k", "inner", None, heavy)
    assert largest_share(wide) < 0.25 and wide.count() == 20_000


def test_context_join_spreads_a_coarse_cell(spark, plain_shuffles, monkeypatch):
    """One context cell above nearly all facts: its links are dealt over tasks."""
    monkeypatch.setattr(datamart, "heavy_keys_of", lambda stored, key: skew.heavy_keys_of(stored, key, 200))
    coarse = plain.make(20, [1])
    fine = [plain.make(20, [1, a, b, c, d, e]) for a in range(7) for b in range(7) for c in range(7) for d in range(7) for e in range(2)]
    facts = spark.createDataFrame([(c, n) for n, c in enumerate(fine)], "cell bigint, n int")
    around = spark.createDataFrame([(coarse, "x"), (plain.make(21, [1]), "y")], "c_cell bigint, label string")
    links = spark.createDataFrame([(c, coarse) for c in fine], "src bigint, tar bigint")
    joined = datamart.context_join(facts, links, around, "cell", "c_cell", skew.cell_profile(facts))
    assert joined.count() == len(fine) and {r[0] for r in joined.select("label").distinct().collect()} == {"x"}
    heavy = skew.heavy_keys(skew.key_counts(links, "tar"), "tar", 200)
    met = skew.weighted_join(links, around.withColumnRenamed("c_cell", "tar"), "tar", "inner", heavy)
    assert largest_share(met) < 0.25 < largest_share(links.join(around.withColumnRenamed("c_cell", "tar"), "tar"))


def test_ancestors_with_many_cells_are_spread(spark, plain_shuffles, monkeypatch):
    monkeypatch.setattr(hierjoin, "ROWS_PER_SALT", 100)
    fine = [plain.make(20, [1, a, b, c, d]) for a in range(7) for b in range(7) for c in range(7) for d in range(7)]
    cells = spark.createDataFrame([(c,) for c in fine], "cell bigint")
    among = spark.createDataFrame([(plain.make(20, [1]),)], "cell bigint")
    chains = hierjoin._ancestors(cells, F.lit(1), F.lit(1))
    assert largest_share(chains.join(among.withColumnRenamed("cell", "anc"), "anc")) == 1.0
    met = hierjoin._meet_ancestors(chains, among, 1, 5)
    assert met.count() == len(fine) and largest_share(met) < 0.3


def test_not_in_follows_sql(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")

    def kept(values):
        other = spark.createDataFrame([(v,) for v in values], "k int")
        return sorted((r[0] for r in not_in(df, other, "k").collect()), key=str)

    assert kept([1]) == [2]
    assert kept([1, None]) == []
    assert kept([]) == [1, 2, None]


def test_dense_row_id(spark):
    df = spark.createDataFrame([(i % 3 if i % 5 else None, i) for i in range(200)], "k int, v int").repartition(7)
    rows = dense_row_id(df, ["k", "v"]).orderBy("id").collect()
    assert [r.id for r in rows] == list(range(1, 201))
    assert [(r.k, r.v) for r in rows] == sorted(((r.k, r.v) for r in rows), key=lambda t: (t[0] is None, t[0] or 0, t[1]))


def test_dense_row_id_ranges_by_short_keys(spark):
    """Long texts do not reach the driver as range bounds, and the order is that of the whole texts."""
    rng = random.Random(4)
    start = "x" * rowid.RANGE_CHARS
    texts = [None, "", "a", start, *[start + "y" * (20_000 + rng.randrange(3)) for _ in range(60)], *[rng.choice("abz") * rng.randrange(1, 200) for _ in range(60)]]
    rows = [(t, [rng.randrange(3)] * rng.randrange(1, 20) if rng.random() < 0.9 else None, i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "t string, a array<int>, i int").repartition(5)
    keys = df.select(*[k.alias(f"k{n}") for n, k in enumerate(rowid._range_keys(df, ["t", "a", "i"]))])
    assert max(len(str(v)) for r in keys.collect() for v in r) <= rowid.RANGE_CHARS
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1] is None, r[1] or [], r[2]))
    got = dense_row_id(df, ["t", "a", "i"]).orderBy("id").collect()
    assert [tuple(r)[1:] for r in got] == want and [r.id for r in got] == list(range(1, len(rows) + 1))


def test_standardize_field_keeps_positions(spark):
    df = spark.createDataFrame([(1, "a", "b", 9), (2, "b", "z", 8)], "id int, first string, second string, n int")
    lookup = spark.createDataFrame([("a", 10), ("b", 20)], "name string, key int")
    out = standardize_field(df, lookup, "name", "key", {"first": 0, "second": 3})
    assert out.columns == ["first", "id", "n", "second"]
    assert sorted(map(tuple, out.collect())) == [(10, 1, 9, 20), (20, 2, 8, None)]


def test_unnest_json_types_and_empty_arrays(spark):
    df = spark.createDataFrame([(1, '[{"a":1,"b":"x"},{"a":null,"b":"y"}]'), (2, "[]"), (3, None)], "id int, j string")
    out = unnest_json(df, "j", {"a": "int", "b": "string"})
    assert out.columns == ["id", "a", "b"] and sorted(map(tuple, out.collect()), key=str) == [(1, 1, "x"), (1, None, "y")]

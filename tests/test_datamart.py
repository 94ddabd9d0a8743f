import itertools
import json
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from hexmart.functions import cells as C
from hexmart.operators import aggregates as A
from hexmart.operators import skew
from hexmart.operators.lookup import unnest_json
from hexmart.plans import datamart
from hexmart.plans.datamart import JsonField, MartSpec, Table, build_datamart, build_facts, write_datamart
from hexmart.plans.select import Children, Join, build_select
from hexmart.plans.spec import Attr
from hexmart.session import fresh_path
from tests import plain
from tests.test_joins import random_cells

RES = 3


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(5)
    fires = [(c, rng.randrange(4), rng.choice([10, 11, 99]), rng.randrange(100), rng.choice(["ab-cd", "x y", None]))
             for c in sorted(random_cells(rng, 40, 1, 5)) for _ in range(3)]
    land = [(c, rng.choice("pqr"), rng.randrange(10)) for c in sorted(random_cells(rng, 25, 2, 4, tops=4)) for _ in range(2)]
    soil = [(c, rng.choice("st")) for c in sorted(random_cells(rng, 15, 2, 3, tops=5))]
    places = [(plain.make(20, [i, j]), f"c{i}") for i in range(5) for j in range(3)]
    dates = [(10, 2001), (11, 2002)]
    return {
        "fires": spark.createDataFrame(fires, "cell bigint, objectid int, begdate int, score int, label string"),
        "land": spark.createDataFrame(land, "cell bigint, cls string, weight int"),
        "soil": spark.createDataFrame(soil, "cell bigint, kind string"),
        "places": spark.createDataFrame(places, "cell bigint, nom string"),
        "dates": spark.createDataFrame(dates, "date_id int, year int"),
    }


def spec_of(inputs, **changes):
    spec = MartSpec(
        tables=[
            Table("f", inputs["fires"], "indicator", ["!objectid", "!date+begdate+year+annee", "sum+score+total", "min+score+low",
                  "array+label+labels", "array_length+label+n_labels", "sum_area_adaptatif+surface", "min_init_cap+label+first_label"]),
            Table("l", inputs["land"], "context", ["!cls", "sum+weight+weights", "sum_area+cell+land_area"]),
            Table("s", inputs["soil"], "context", ["!kind"]),
        ],
        res=RES,
        dates=inputs["dates"],
    )
    for key, value in changes.items():
        setattr(spec, key, value)
    return spec


def capitals(text):
    out, start = "", True
    for ch in text or "":
        out += (ch.upper() if start else ch.lower()) if ch.isalnum() else ch
        start = not ch.isalnum()
    return out if text is not None else None


def by_hand(tables):
    """Join row by row, then group, with none of the reductions."""
    f, l, s = (tables[k].toPandas() for k in ("fires", "land", "soil"))
    years = {10: 2001, 11: 2002}

    def linked(rows):
        tar = set(rows.cell)
        return plain.adaptive_pairs(set(f.cell), tar, min(map(plain.res, tar)), max(map(plain.res, tar)))

    to_land, to_soil = linked(l), linked(s)
    groups = {}
    for row in f.itertuples():
        lands = [x for x in l.itertuples() if (row.cell, x.cell) in to_land] or [None]
        soils = [x for x in s.itertuples() if (row.cell, x.cell) in to_soil] or [None]
        at = [plain.parent(row.cell, RES)] if plain.res(row.cell) >= RES else plain.descendants(row.cell, RES)
        for x in lands:
            for y in soils:
                area = min(C.MEAN_AREA_KM2[plain.res(z)] for z in (row.cell, x and x.cell, y and y.cell) if z is not None)
                for cell in at:
                    key = (cell, row.objectid, years.get(row.begdate), x and x.cls, y and y.kind)
                    groups.setdefault(key, []).append((row, x, area))
    out = {}
    for key, rows in groups.items():
        labels = {r.label if isinstance(r.label, str) else None for r, _, _ in rows}
        shown = sorted(v for v in labels if v is not None)
        out[key] = (
            sum(r.score for r, _, _ in rows), min(r.score for r, _, _ in rows), shown + [None] * (None in labels), len(labels),
            pytest.approx(sum(a for _, _, a in rows)), min((capitals(v) for v in shown), default=None),
            sum(x.weight for _, x, _ in rows) if rows[0][1] is not None else None,
            pytest.approx(sum(C.MEAN_AREA_KM2[plain.res(x.cell)] for _, x, _ in rows)) if rows[0][1] is not None else None,
        )
    return out


def collected(facts):
    rows = facts.select("_cell", "objectid", "annee", "cls", "kind", "total", "low", "labels", "n_labels", "surface",
                        "first_label", "weights", "land_area").collect()
    return {tuple(r[:5]): tuple(r[5:]) for r in rows}


def test_facts_equal_the_row_by_row_join(tables):
    want = by_hand(tables)
    facts, groups = build_facts(spec_of(tables))
    assert groups == ["objectid", "annee", "cls", "kind"]
    assert collected(facts) == want
    assert any(k[3] is None for k in want) and any(k[2] is None for k in want)


def test_context_is_merged_before_the_facts_meet_it(tables, monkeypatch):
    """A coarse cell meets one row per group and level; folding shares the shuffle that places the facts."""
    met = []

    def seen(table, around, prefix):
        merge = real(table, around, prefix)
        return lambda nearby: met.append((nearby.count(), merge(nearby).count())) or merge(nearby)

    real = datamart._merged
    monkeypatch.setattr(datamart, "_merged", seen)
    folded = datamart.fold_facts(small_spec(tables))
    assert met[0][1] < met[0][0]
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Exchange" not in plan[: plan.index("Generate")]
    facts, _ = build_facts(small_spec(tables))
    want = A.json_fold(facts, ["_cell", "annee"], {"id": "objectid", "cls": "cls", "surface": "surface"}, "detail")
    assert sorted(map(tuple, folded.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_expanded_facts_are_not_grouped_again(tables):
    """Rows of one level share no cell, so nothing is grouped after they are expanded; the number of tasks does not follow the bytes before."""
    facts, _ = build_facts(small_spec(tables))
    for df in (facts, datamart.fold_facts(small_spec(tables))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        above = plan[: plan.index("Generate")].replace("ObjectHashAggregate", "")
        assert "HashAggregate" not in above and "REPARTITION_BY_NUM" in plan


def test_pairs_of_facts_and_context_are_made_by_the_last_join(spark, monkeypatch):
    """Forty-nine fine cells below a target of fifty rows, and a coarse cell above it: all that is joined before follows the rows of both sides."""
    top = plain.make(20, [1, 2])
    fine = [plain.make(20, [1, 2, i, j]) for i in range(7) for j in range(7)]
    facts = spark.createDataFrame([(c, n) for n, c in enumerate([*fine, plain.make(20, [1]), plain.make(20, [1]), plain.make(20, [3]), None])], "cell bigint, n int")
    around = spark.createDataFrame([(top, m) for m in range(50)], "c_cell bigint, m int")
    joined = []

    real = datamart.weighted_join
    profile, held = skew.cell_profile(facts), skew.cell_profile(around, "c_cell")
    links = datamart.link_cells(profile.cells, held.cells, held.lo, held.hi, profile.lo, profile.hi)
    monkeypatch.setattr(datamart, "weighted_join", lambda *args, **named: joined.append((args[0].count(), args[1].count())) or real(*args, **named))
    monkeypatch.setattr(datamart, "PAIRS_PER_TASK", 100, raising=False)
    rows = datamart.context_join(facts, links, around, "cell", "c_cell", profile, held).select("n", "m").collect()
    want = [(n, m) for n in range(51) for m in range(50)] + [(51, None), (52, None)]
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert max(max(sizes) for sizes in joined) <= facts.count() + 2 * around.count()


def test_a_cell_of_many_pairs_meets_its_context_in_blocks(spark, monkeypatch):
    """Fifty context rows above sixty facts come eight at a time; equal rows, facts without context and cells of few pairs stay whole."""
    top, small = plain.make(20, [1, 2]), plain.make(20, [4])
    below = [plain.make(20, [1, 2, n % 7]) for n in range(60)]
    facts = spark.createDataFrame([(c, n // 2) for n, c in enumerate(below)] + [(small, 90), (plain.make(20, [3]), 91), (None, 92)], "cell bigint, n int")
    around = spark.createDataFrame([(top, m // 2) for m in range(50)] + [(small, 70)], "c_cell bigint, m int")
    profile, held = skew.cell_profile(facts), skew.cell_profile(around, "c_cell")
    links = datamart.link_cells(profile.cells, held.cells, held.lo, held.hi, profile.lo, profile.hi)
    monkeypatch.setattr(datamart, "PAIRS_PER_TASK", 100)
    monkeypatch.setattr(datamart, "ROWS_MET", 8, raising=False)
    joined = datamart.context_join(facts, links, around, "cell", "c_cell", profile, held)
    rows = joined.select("n", "m", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("at")).orderBy("at").collect()
    want = [(n // 2, m // 2) for n in range(60) for m in range(50)] + [(90, 70), (91, None), (92, None)]
    assert sorted(((r.n, r.m) for r in rows), key=str) == sorted(want, key=str)
    lengths = [len(list(run)) for _, run in itertools.groupby(rows, lambda r: (r.task, r.n))]
    assert max(lengths) <= 2 * 8  # equal facts may follow each other


def test_hot_cells_change_nothing(tables, monkeypatch):
    want = collected(build_facts(spec_of(tables))[0])
    monkeypatch.setattr("hexmart.plans.datamart.cell_profile", lambda df, cell="cell": skew.cell_profile(df, cell, hot_rows=2))
    monkeypatch.setattr("hexmart.plans.datamart.heavy_keys_of", lambda stored, key: skew.heavy_keys_of(stored, key, 2))
    assert collected(build_facts(spec_of(tables))[0]) == want


def small_spec(inputs, **changes):
    return spec_of(inputs, tables=[
        Table("f", inputs["fires"], "indicator", ["!objectid", "!date+begdate+year+annee", "sum_area_adaptatif+surface", "!geom+hex_id+3+geometry"]),
        Table("l", inputs["land"], "context", ["!cls"]),
        Table("p", inputs["places"], "dimension", ["nom AS commune"]),
    ], json=[JsonField("detail", {"id": "objectid", "cls": "cls", "surface": "surface"})], **changes)


def test_mart_folds_and_unfolds(tables):
    facts, _ = build_facts(small_spec(tables))
    places = {k: r.nom for r in tables["places"].collect() for k in plain.descendants(r.cell, RES)}
    want = [(f"{r._cell:x}", r.annee, r.objectid, r.cls, r.surface, places[r._cell]) for r in facts.collect() if r._cell in places]
    whole = build_datamart(small_spec(tables))
    assert whole.columns == ["hex_id", "annee", "detail", "geometry", "commune"]
    keys = [(r.hex_id, r.annee) for r in whole.collect()]
    assert len(keys) == len(set(keys))
    for limit in (100_000, 2):
        mart = build_datamart(small_spec(tables, max_json_items=limit))
        flat = unnest_json(mart.drop("geometry"), "detail", {"id": "int", "cls": "string", "surface": "double"})
        got = [(r.hex_id, r.annee, r.id, r.cls, r.surface, r.commune) for r in flat.collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        if limit == 2:
            assert mart.count() > len(keys)


def test_json_elements_are_sorted_and_keep_nulls(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", None), (None, "c", 1.0)], "k int, n string, v double")
    rows = {r.k: json.loads(r.j) for r in A.json_fold(df, ["k"], {"name": "n", "value": "v"}, "j").collect()}
    assert rows == {1: [{"name": "a", "value": None}, {"name": "b", "value": 2.0}], None: [{"name": "c", "value": 1.0}]}


def test_a_fold_holds_one_group_at_a_time(spark, monkeypatch):
    """No aggregate gathers elements of many groups; rows that stand for a zone are one element of each of its cells, also of a pentagon's."""
    monkeypatch.setattr(A, "FOLD_BYTES", 200, raising=False)
    rng = random.Random(3)
    zones = [plain.make(20, [i, j]) for i in range(3) for j in range(3)] + [plain.make(4, [0, 0]), plain.make(4, [1, 0])]
    rows = [(z, rng.choice([z, *plain.children(z)]), rng.choice([1, 2, None]), n, rng.choice(['a"b', None, "é"])) for n, z in enumerate(zones * 12)]
    rows += [(plain.make(20, [5, 5]), plain.make(20, [5, 5]), 1, n, "x") for n in range(400)]
    df = spark.createDataFrame(rows, "zone bigint, at bigint, k int, n int, s string")
    fields = {"s": "s", "n": "n"}
    got = A.json_fold(df, ["zone", "k"], fields, "j", zones=A.Zones("zone", "at", 3, "cell"))
    expanded = spark.createDataFrame([(c, k, n, s) for z, at, k, n, s in rows for c in (plain.children(z) if at == z else [at])], "cell bigint, k int, n int, s string")
    items = F.sort_array(F.collect_list(F.struct("s", "n")))
    want = expanded.groupBy("cell", "k").agg(F.to_json(items, {"ignoreNullFields": "false"}).alias("j"))
    assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    plain_fold = A.json_fold(expanded, ["cell", "k"], fields, "j")
    assert sorted(map(tuple, plain_fold.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert "ObjectHashAggregate" not in plain_fold._jdf.queryExecution().executedPlan().toString()


def test_wide_rows_are_stored_in_small_row_groups(tables, spark, monkeypatch):
    """Readers hold a row group as plain values, so a few long rows make one; no array takes part in numbering the mart."""
    monkeypatch.setattr(datamart, "WIDE", {**getattr(datamart, "WIDE", {}), "parquet.block.size": "2000"}, raising=False)
    ordered = []
    real = datamart.dense_row_id
    monkeypatch.setattr(datamart, "dense_row_id", lambda df, order, out: ordered.append(df.columns) or real(df, order, out))
    path = fresh_path(spark, "mart")
    mart = write_datamart(small_spec(tables, set_index=True, set_esri=True), path)
    assert ordered and all("detail" not in c for c in ordered)
    assert mart.columns == ["id_esri", "hex_id", "annee", "detail", "geometry", "commune", "srid"]
    rows = [tuple(r) for r in mart.select("hex_id", "annee", "commune", "id_esri").collect()]
    by_keys = sorted(rows, key=lambda r: (r[0], r[1] is None, r[1], r[2]))
    assert [r[3] for r in by_keys] == list(range(1, len(rows) + 1))
    files = [pq.ParquetFile(f.removeprefix("file:")) for f in mart.inputFiles()]
    assert sum(f.num_row_groups for f in files) > len(files)


def test_several_json_columns(tables):
    spec = small_spec(tables)
    spec.json = [*spec.json, JsonField("classes", {"c": "cls", "id": "objectid"})]
    facts, _ = build_facts(spec)
    mart = build_datamart(spec)
    assert mart.filter("detail is null or classes is null").count() == 0
    assert mart.count() == build_datamart(small_spec(tables)).count() and facts.count() > 0


def test_specs_are_checked(tables):
    with pytest.raises(ValueError, match="unknown function"):
        Attr.of("median+x+y")
    bad = spec_of(tables, tables=[Table("f", tables["fires"], "indicator", ["objectid"])])
    with pytest.raises(ValueError, match="group by it"):
        build_facts(bad)
    odd = small_spec(tables)
    odd.tables[2] = Table("p", tables["places"], "dimension", ["sum+nom+x"])
    with pytest.raises(ValueError, match="dimension"):
        build_datamart(odd)


def test_attribute_notation():
    assert Attr.of("!?objectid") == Attr("objectid", column="objectid", group=True, order=True)
    assert Attr.of("nom AS commune") == Attr("commune", column="nom")
    assert Attr.of("!date+begdate+year+annee") == Attr("annee", fn="date", args=("begdate", "year"), group=True)
    assert Attr.of("!geom+hex_id+8+geometry").alias == "geometry" and Attr.of("hex_id_parent+8").args == ("8",)


def test_finer_dimension_joins_by_parent(tables, spark):
    fine = spark.createDataFrame([(plain.make(20, [1, 1, 1, d]), f"d{d}") for d in range(3)], "cell bigint, nom string")
    fires = spark.createDataFrame([(plain.make(20, [1, 1, 1, 0, 2]), 1), (plain.make(20, [2, 2, 2]), 2)], "cell bigint, objectid int")
    mart = build_datamart(MartSpec([Table("f", fires, "indicator", ["!objectid"]), Table("d", fine, "dimension", ["nom"])], RES))
    assert sorted((r.objectid, r.nom) for r in mart.collect()) == [(1, "d0"), (1, "d1"), (1, "d2")]


def test_join_types_are_not_swapped(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(2, 5), (3, 6)], "k int, m int")
    c = spark.createDataFrame([(5, "x"), (7, "y")], "m int, n string")
    out = build_select({"a": a, "b": b, "c": c}, {"a": ["k"], "c": ["n"]}, [Join("a", "!k", "b", "k"), Join("c", "!m", "b", "m")])
    # b already stands in FROM, so c is the newcomer and "!" keeps what is there.
    assert sorted(map(tuple, out.collect()), key=str) == [(1, None), (2, "x")]


def test_null_rules_of_arrays(spark):
    df = spark.createDataFrame([(1, "b"), (1, None), (1, "a"), (1, "b"), (2, "z")], "k int, v string")
    got = {r.k: (r.vs, r.n) for r in df.groupBy("k").agg(A.array_distinct("v").alias("vs"), A.array_length("v").alias("n")).collect()}
    assert got == {1: (["a", "b", None], 3), 2: (["z"], 1)}


def test_children_of_a_spec(spark):
    coarse, fine = plain.make(20, [1]), plain.make(20, [2, 3, 4])
    pentagon = plain.make(4, [])
    df = spark.createDataFrame([("a", coarse), ("b", fine), ("c", pentagon), ("d", None)], "n string, cell bigint")
    want = {(n, k) for n, c in (("a", coarse), ("c", pentagon)) for k in plain.descendants(c, 2)}
    out = build_select({"t": df}, {"t": ["n", "hex_id_children+", "geom_children+"]}, [Children("t", 2, keep=False)])
    rows = out.collect()
    assert {(r.n, int(r.hex_id, 16)) for r in rows} == want and len(rows) == len(want) and all(len(r.geometry) == 7 for r in rows)
    kept = build_select({"t": df}, {"t": ["n", "hex_id_children+"]}, [Children("t", 2)]).collect()
    assert {(r.n, r.hex_id and int(r.hex_id, 16)) for r in kept} == want | {("b", None), ("d", None)}
    level = build_select({"t": df.filter("n in ('a', 'b')")}, {"t": ["n", "hex_id+2", "geom+cell+2"]}, [Children("t", 2)]).collect()
    assert {(r.n, int(r.hex_id, 16)) for r in level} == {k for k in want if k[0] == "a"} | {("b", plain.parent(fine, 2))}
    with pytest.raises(ValueError, match="dates"):
        build_select({"t": df}, {"t": ["date+n+year+y"]})


def test_children_among_listed_cells_are_never_expanded(spark, monkeypatch):
    """A cell eleven levels up has two billion children at the level; the two that are listed are found at once."""
    top, listed = plain.make(20, [1]), [plain.make(20, [1, *digits]) for digits in ([0] * 11, [6, 5, 4, 3, 2, 1, 0, 1, 2, 3, 4])]
    df = spark.createDataFrame([("a", top), ("a2", top), ("self", listed[0]), ("far", plain.make(21, [1])), ("finer", plain.make(20, [1] + [0] * 12)), ("null", None)], "n string, cell bigint")
    others = spark.createDataFrame([(c,) for c in listed * 3 + [plain.make(22, [0] * 12)]], "cell bigint")

    def never(*_, **__):
        raise AssertionError

    monkeypatch.setattr(C, "explode_children", never)
    want = {("a", c) for c in listed} | {("a2", c) for c in listed} | {("self", listed[0])}
    spec = {"t": ["n", "hex_id_children+"]}, [Children("t", 12, keep=False, among="o")]
    rows = build_select({"t": df, "o": others}, *spec).collect()
    assert {(r.n, int(r.hex_id, 16)) for r in rows} == want and len(rows) == len(want)
    kept = build_select({"t": df, "o": others}, spec[0], [Children("t", 12, among="o")]).collect()
    assert {(r.n, r.hex_id and int(r.hex_id, 16)) for r in kept} == want | {("far", None), ("finer", None), ("null", None)}
    assert build_select({"t": df.limit(0), "o": others}, *spec).count() == 0


def test_dimension_of_mixed_levels(tables, spark):
    """Coarse, equal and fine dimension cells meet the mart's cells on one level."""
    dims = [(plain.make(20, [1]), "coarse"), (plain.make(20, [1, 1, 1]), "equal"), (plain.make(20, [1, 1, 1, 4]), "fine"), (plain.make(20, [2]), "other"), (plain.make(20, []), "top")]
    fires = spark.createDataFrame([(plain.make(20, [1, 1, 1, 0, 2]), 1), (plain.make(20, [3, 3, 3]), 2)], "cell bigint, objectid int")
    df = spark.createDataFrame(dims, "cell bigint, nom string")
    mart = build_datamart(MartSpec([Table("f", fires, "indicator", ["!objectid"]), Table("d", df, "dimension", ["nom"])], 3))
    assert sorted((r.objectid, r.nom) for r in mart.collect()) == [(1, "coarse"), (1, "equal"), (1, "fine"), (1, "top"), (2, "top")]


def test_stored_mart_with_its_options(tables, spark):
    spec = small_spec(tables, set_index=True, set_esri=True)
    spec.tables[0].attributes[0] = "!?objectid"
    spec.json = []
    spec.tables[0].attributes[1] = "!date+begdate+year+annee"
    mart = build_datamart(spec)
    rows = mart.collect()
    assert [r.objectid for r in rows] == sorted(r.objectid for r in rows) and [r.id_esri for r in rows] == list(range(1, len(rows) + 1))
    stored = write_datamart(spec, fresh_path(spark, "mart"))
    assert stored.columns == [*mart.columns, "srid"] and stored.count() == len(rows)
    assert {r.srid for r in stored.collect()} == {3163} and sorted(r.id_esri for r in stored.collect()) == list(range(1, len(rows) + 1))
    plain_spec = small_spec(tables)
    assert write_datamart(plain_spec, fresh_path(spark, "mart")).columns == build_datamart(plain_spec).columns

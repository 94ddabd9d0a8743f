import hashlib
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hexmart.functions.text import initcap_words, language, surrogate_key
from hexmart.operators import quality as Q
from hexmart.plans import lambdaview as L
from hexmart.plans import pageviews as P
from hexmart.plans import snapshot as SN
from hexmart.plans.matview import MaterializedView, masked_view, unnest_view
from hexmart.session import fresh_path
from hexmart.sources import incremental as I
from hexmart.sources import sinks
from hexmart.sources.catalog import Catalog, Source, freshness, lookup_table, read_csv
from hexmart.streaming import streams as ST

# Gender per id in the first load and in the update.
SEED = {1: "Male", 2: "Female", 3: "Male", 4: "Female", 5: "Male"}
UPDATE = SEED | {3: "Female", 6: "Female", 7: "Female", 8: "Male", 9: "Male", 10: "Female"}
# order_id, order_date, amount.
ORDERS = [(1, "2020-01-01", 10), (2, "2020-01-01", 20), (3, "2020-01-02", 1), (4, "2020-01-03", 25), (5, "2020-01-03", 17), (6, "2020-01-04", 6)]


def people(spark, rows):
    return spark.createDataFrame(list(rows.items()), "id int, gender string")


def by_gender(df):
    return df.groupBy("gender").agg(F.count("*").alias("num"))


@pytest.mark.parametrize("auto", [False, True])
def test_materialized_view_after_merge(spark, auto):
    state = {"base": people(spark, SEED)}
    view = MaterializedView(f"people_{auto}", lambda: by_gender(state["base"]), auto_refresh=auto)
    assert dict(map(tuple, view.build(spark).collect())) == {"Male": 3, "Female": 2}
    state["base"] = I.merge(state["base"], people(spark, UPDATE), ["id"])
    want = {"Male": 3, "Female": 2} if auto else {"Male": 4, "Female": 6}
    assert dict(map(tuple, view.build(spark).collect())) == want
    assert dict(map(tuple, view.build(spark, full_refresh=True).collect())) == {"Male": 4, "Female": 6}
    expected = spark.createDataFrame([("Female", 6), ("Male", 4)], "gender string, num bigint")
    assert tuple(Q.relation_equality(spark.table(view.name), expected).first()) == (0, 0)


def test_view_takes_the_place_of_a_table(spark):
    path = fresh_path(spark, "table")
    spark.range(3).write.parquet(path)
    spark.sql(f"CREATE TABLE was_a_table USING parquet LOCATION '{path}'")
    MaterializedView("was_a_table", lambda: spark.range(5)).build(spark)
    assert spark.table("was_a_table").count() == 5


def test_snapshot_flags_a_changed_past(spark):
    orders = spark.createDataFrame(ORDERS, "id int, day string, amount int").withColumn("day", F.to_date("day"))

    def revenue(df):
        return df.groupBy(F.col("day").alias("date_day")).agg(F.sum("amount").alias("total_revenue"))

    first = SN.first_snapshot(revenue(orders), "date_day", datetime(2020, 2, 1))
    assert sorted(r.total_revenue for r in first.collect()) == [1, 6, 30, 42]
    same = SN.check_snapshot(first, revenue(orders), "date_day", ["total_revenue"], datetime(2020, 2, 2))
    assert Q.not_null_count(same, "valid_to").first()[0] == 0 and same.count() == 4
    second = SN.check_snapshot(same, revenue(orders.filter("id <> 4")), "date_day", ["total_revenue"], datetime(2020, 2, 3))
    assert Q.not_null_count(second, "valid_to").first()[0] == 1
    third = [(r.total_revenue, r.valid_to) for r in second.filter("date_day = date'2020-01-03'").collect()]
    assert sorted(third, key=str) == [(17, None), (42, datetime(2020, 2, 3))]
    gone = SN.check_snapshot(second, revenue(orders.filter("id <> 3")), "date_day", ["total_revenue"], datetime(2020, 2, 4))
    assert gone.filter("date_day = date'2020-01-02' and valid_to is null").count() == 1
    main, audit = SN.split_invalidated(second, datetime(2020, 2, 5))
    assert Q.not_null_count(main, "valid_to").first()[0] == 0
    assert [(r.total_revenue, r._inserted_at) for r in audit.collect()] == [(42, datetime(2020, 2, 5))]


def test_delete_insert_takes_several_rows_per_key(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    batch = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "k int, v string")
    assert sorted(map(tuple, I.delete_insert(target, batch, "k").collect())) == [(1, "x"), (1, "y"), (2, "c"), (3, "z")]


def test_static_overwrite_empties_listed_partitions(spark):
    days = [date(2024, 1, d) for d in (1, 2, 3)]
    target = spark.createDataFrame([(d, "old") for d in days], "day date, v string")
    batch = spark.createDataFrame([(days[1], "new"), (days[2], "unlisted")], "day date, v string")
    out = I.overwrite_static(target, batch, "day", days[:2])
    assert sorted(map(tuple, out.collect())) == [(days[1], "new"), (days[2], "old")]


def test_merge_partitions_leaves_other_files_alone(spark):
    path = fresh_path(spark, "merge")
    rows = [(1, date(2024, 1, 1), 1), (2, date(2024, 1, 2), 1), (3, date(2024, 1, 2), 1)]
    spark.createDataFrame(rows, "id int, day date, n int").write.partitionBy("day").parquet(path)
    before = set(spark.read.parquet(f"{path}/day=2024-01-01").inputFiles())
    batch = spark.createDataFrame([(3, date(2024, 1, 2), 9), (4, date(2024, 1, 3), 9)], "id int, day date, n int")
    for _ in range(2):  # a second run changes nothing
        I.merge_partitions(path, batch, ["id"], "day")
        got = spark.read.parquet(path).select("id", "n").collect()
        assert sorted(map(tuple, got)) == [(1, 1), (2, 1), (3, 9), (4, 9)]
    assert set(spark.read.parquet(f"{path}/day=2024-01-01").inputFiles()) == before
    with pytest.raises(ValueError):
        I.merge_partitions(path, batch.unionByName(batch), ["id"], "day")


def test_windows_and_high_water(spark):
    df = spark.createDataFrame([(datetime(2024, 1, d),) for d in range(1, 10)], "ts timestamp_ntz")
    assert df.filter(I.batch_window("ts", date(2024, 1, 9), True)).count() == 3
    assert df.filter(I.batch_window("ts", date(2024, 1, 9), False)).count() == 1
    assert I.last_partitions(date(2024, 1, 2), 2) == [date(2024, 1, 1), date(2023, 12, 31)]
    assert I.since_high_water(df, df.filter("ts < timestamp_ntz'2024-01-05'"), "ts").count() == 6
    assert I.since_high_water(df, df.limit(0), "ts").count() == 9


def test_update_table(spark):
    path = fresh_path(spark, "sink")
    df = spark.range(10).withColumn("geom", F.lit("POLYGON"))
    sinks.update_table(df, path, "replace", geometry="geom", types={"id": "int"}, rows_per_file=4)
    sinks.update_table(df.limit(0), path, "append", geometry="geom", types={"id": "int"})
    stored = spark.read.parquet(path)
    assert stored.columns == ["id", "geometry", "srid"] and stored.filter("srid = 3163").count() == 10
    files = stored.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert files <= 4
    sinks.update_table(df.limit(0), path, "replace", geometry="geom", types={"id": "int"})
    assert spark.read.parquet(path).count() == 0


def test_update_table_makes_its_rows_once(spark):
    path, made = fresh_path(spark, "sink"), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    rows = spark.range(100).mapInPandas(count, "id bigint")
    sinks.update_table(rows, path, "append")
    assert made.value == 100 and spark.read.parquet(path).count() == 100
    files = sorted(os.listdir(path.removeprefix("file:")))
    sinks.update_table(rows.filter("id < 0"), path, "append")
    assert sorted(f for f in os.listdir(path.removeprefix("file:")) if not f.startswith(".")) == [f for f in files if not f.startswith(".")]


def test_blocked_load_resumes(spark):
    path = fresh_path(spark, "blocks")
    df = spark.range(1000).withColumn("cell", F.col("id") % 50)
    sinks.blocked_load(df, f"{path}/d", f"{path}/log", 6, start=4, at_once=2)
    assert {r.block for r in spark.read.parquet(f"{path}/log").collect()} == {4, 5, 6}
    # A block written but not logged, as after a crash, is written again without duplicates.
    crashed = df.withColumn("block", (F.pmod(F.xxhash64("cell"), F.lit(6)) + 1).cast("int")).filter("block = 1")
    crashed.write.mode("append").partitionBy("block").parquet(f"{path}/d")
    log = sinks.blocked_load(df, f"{path}/d", f"{path}/log", 6, at_once=2)
    assert sorted(r.block for r in log.collect()) == [1, 2, 3, 4, 5, 6] and log.agg(F.sum("objects")).first()[0] == 1000
    assert sorted(r.id for r in spark.read.parquet(f"{path}/d").collect()) == list(range(1000))


def test_sources(spark, tmp_path):
    (tmp_path / "seed.csv").write_text('lang,title\naf,"Kovalente_binding"\nar,"x, y"\n', encoding="utf-8")
    assert [tuple(r) for r in read_csv(spark, str(tmp_path / "seed.csv"), "lang string, title string").collect()] == [("af", "Kovalente_binding"), ("ar", "x, y")]
    catalog = Catalog({"seed": Source(str(tmp_path / "seed.csv"), "csv", "lang string, title string", {"header": "true"})})
    assert catalog.load(spark, "seed").count() == 2
    spark.range(2).createOrReplaceTempView("known_to_spark")
    assert catalog.load(spark, "known_to_spark").count() == 2
    stamps = spark.createDataFrame([(datetime(2024, 1, 1, 10),), (datetime(2024, 1, 1, 11, 30),)], "at timestamp_ntz")
    assert tuple(freshness(stamps, "at", datetime(2024, 1, 1, 12), 1).first())[1:] == (0.5, False)
    assert freshness(stamps, "at", datetime(2024, 1, 1, 13), 1).first().stale and freshness(stamps.limit(0), "at", datetime(2024, 1, 1), 1).first().stale


def test_checks(spark):
    df = spark.createDataFrame([(1, 3163), (1, 3163), (None, 4326), (None, 3163), (2, None)], "k int, srid int")
    assert tuple(Q.key_and_srid(df, "k", "srid", 3163).first()) == (2, 2, 1)
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (None,), (3,)], "x int")
    assert tuple(Q.relation_equality(a, b).first()) == (1, 1) and tuple(Q.relation_equality(a, a).first()) == (0, 0)


def test_masking(spark):
    df = spark.createDataFrame([(1, "Ann", "everything"), (2, None, "sesame")], "id int, name string, bagel string")
    shown = Q.masked(df, ["name"], ("alice",), "alice").collect()
    hidden = Q.masked(df, ["name"], ("alice",), "bob").collect()
    assert [r.name for r in shown] == ["Ann", None] and [r.bagel for r in hidden] == ["everything", "sesame"]
    assert len(hidden[0].name) == 32 and hidden[1].name is None


def test_text_functions(spark):
    df = spark.createDataFrame([("saint-louis du SUD",), ("l'île_aux  pins",), ("-x2y",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(initcap_words(F.col("t"))).collect()] == ["Saint-Louis Du Sud", "L'Île_Aux  Pins", "-X2y", "", None]
    row = spark.range(1).select(surrogate_key(F.lit("a"), F.lit(None), F.lit(3)), F.md5(F.lit("a--3")), language(F.lit("zh-min-nan.m"))).first()
    assert row[0] == row[1] and row[2] == "zh_min_nan"


def test_lambda_view_modes_and_union(spark):
    split = datetime(2024, 1, 5)
    df = spark.createDataFrame([(f"k{d}", datetime(2024, 1, d)) for d in range(1, 10)], "k string, ts timestamp_ntz")
    past = L.lambda_filter(df, "ts", split, "first")
    tail = L.lambda_filter(df, "ts", split, "view")
    assert (past.count(), tail.count()) == (4, 5)
    assert L.lambda_filter(df, "ts", split, "incremental", df.filter("k = 'k3'")).count() == 2
    both = L.lambda_union(past, tail.withColumn("k", F.when(F.col("k") == "k7", "k2").otherwise(F.col("k"))), split, "k")
    rows = {(r.k, r._lambda_view_source) for r in both.collect()}
    assert ("k2", "new") in rows and ("k2", "historical") not in rows and both.count() == 8
    with pytest.raises(ValueError):
        L.lambda_filter(df, "ts", split, "other")


def test_pages_of_interest_both_ways(spark):
    schema = "lang string, title string"
    seeds = {"a": spark.createDataFrame([("en", "Open-Source"), ("fr", "Libre")], schema), "b": spark.createDataFrame([("fr", "X")], schema)}
    joined = P.pages_of_interest(seeds)
    windowed = P.subject_by_source(P.union_relations(seeds)).select(*joined.columns)
    assert joined.exceptAll(windowed).count() == 0
    assert {(r.title, r.subject) for r in joined.collect()} == {("Open-Source", "open_source"), ("Libre", "open_source"), ("X", None)}


def web_rows(days):
    return [(f"s{d}-{n % 3}", n % 3, '{"data":[{"data":{"id":"v%d"}}]}' % (n % 4), "url", datetime(2024, 1, d, n), datetime(2024, 1, d, n)) for d in days for n in range(6)]


WEB = "domain_sessionid string, domain_userid int, contexts string, page_url string, derived_tstamp timestamp, collector_tstamp timestamp"


def test_streams_equal_batch_after_several_runs(spark):
    path = fresh_path(spark, "stream")
    for days in ([1, 2], [2, 3]):  # the second run meets rows of a day already seen
        spark.createDataFrame(web_rows(days), WEB).coalesce(1).write.mode("append").parquet(f"{path}/in")
        source = ST.read_stream(spark, f"{path}/in", WEB, files_per_trigger=1)
        ST.page_view_stream(source, f"{path}/views", f"{path}/c1").awaitTermination()
        counts = source.groupBy("page_url").agg(F.count("*").alias("num"))
        ST.auto_refresh(counts, f"{path}/counts", f"{path}/c2").awaitTermination()
    batch = L.page_views(spark.read.parquet(f"{path}/in"))
    live = ST.page_views_so_far(spark, f"{path}/views").select(*batch.columns)
    assert tuple(Q.relation_equality(live, batch).first()) == (0, 0) and batch.count() > 5
    assert [tuple(r) for r in ST.latest(spark, f"{path}/counts", ["page_url"]).collect()] == [("url", 24)]


def test_rows_five_days_late_are_counted(spark):
    """Deliveries out of order, history folded in between; reads take the history and what came after it, and nothing else."""
    path = fresh_path(spark, "stream")

    def deliver(days):
        spark.createDataFrame(web_rows(days), WEB).coalesce(1).write.mode("append").parquet(f"{path}/in")
        ST.page_view_stream(ST.read_stream(spark, f"{path}/in", WEB, files_per_trigger=1), f"{path}/views", f"{path}/c").awaitTermination()

    def check():
        batch = L.page_views(spark.read.parquet(f"{path}/in"))
        live = ST.page_views_so_far(spark, f"{path}/views").select(*batch.columns)
        assert tuple(Q.relation_equality(live, batch).first()) == (0, 0)
        return {f.split("/views/")[1].split("/")[0] for f in ST.unfolded(spark, f"{path}/views").inputFiles()}

    deliver([8, 9])
    deliver([9])
    assert len(check()) == 2
    ST.fold_page_views(spark, f"{path}/views", at_least=3)
    assert len(check()) == 2
    ST.fold_page_views(spark, f"{path}/views", at_least=2)
    assert check() == {"base=000000000001"}
    deliver([3, 4])  # five days behind the newest
    assert check() == {"base=000000000001", "batch=000000000002"}
    ST.fold_page_views(spark, f"{path}/views")
    deliver([1])
    ST.fold_page_views(spark, f"{path}/views")
    assert check() == {"base=000000000003"}
    days = {r.page_view_start.day for r in ST.page_views_so_far(spark, f"{path}/views").collect()}
    assert days >= {1, 3, 8}


def test_a_stopped_fold_and_a_stopped_batch_change_nothing(spark):
    path = fresh_path(spark, "stream")
    spark.createDataFrame(web_rows([1, 2]), WEB).write.parquet(f"{path}/in")
    source = ST.read_stream(spark, f"{path}/in", WEB)
    ST.auto_refresh(source.groupBy("page_url").agg(F.count("*").alias("num")), f"{path}/counts", f"{path}/c").awaitTermination()
    spark.createDataFrame([("url", 99)], "page_url string, num bigint").write.parquet(f"{path}/counts/batch=000000000009")
    os.remove(f"{path}/counts/batch=000000000009/_SUCCESS")  # not complete
    assert [tuple(r) for r in ST.latest(spark, f"{path}/counts", ["page_url"]).collect()] == [("url", 12)]
    ST.fold_latest(spark, f"{path}/counts", ["page_url"])
    assert [tuple(r) for r in ST.latest(spark, f"{path}/counts", ["page_url"]).collect()] == [("url", 12)]
    with pytest.raises(ValueError):
        ST.unfolded(spark, f"{path}/nothing")


def test_view_options(spark):
    made = []

    def rows():
        made.append(1)
        return spark.range(1000).select((F.col("id") % 3).alias("k"), F.lit(len(made)).alias("version"))

    start = datetime(2024, 1, 1)
    for kind in ("view", "table"):
        made.clear()
        view = MaterializedView(f"options_{kind}", rows, refresh_minutes=30, cluster_by=["k"], kind=kind)
        versions = [view.build(spark, now=start + timedelta(minutes=m)).first().version for m in (0, 10, 29, 31, 45, 61)]
        assert versions == [1, 1, 1, 2, 2, 3] and view.refreshed_at(spark) == start + timedelta(minutes=61)
        assert view.build(spark, full_refresh=True, now=start).first().version == 4
        assert spark.catalog.getTable(view.name).tableType == ("VIEW" if kind == "view" else "EXTERNAL")
    view = MaterializedView("options_view", rows, kind="table", dist="k", sort=["version"])  # the other kind under the same name
    assert view.build(spark).count() == 1000 and spark.catalog.getTable("options_view").tableType == "EXTERNAL"
    with pytest.raises(ValueError):
        MaterializedView("options_both", rows, cluster_by=["k"], dist="k").build(spark)


def test_hot_cluster_key_fills_several_files(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = lambda: spark.range(8000).select(F.when(F.col("id") < 80, F.col("id")).otherwise(F.lit(5)).alias("k"), "id")
        stored = MaterializedView("hot_key", rows, cluster_by=["k"]).build(spark, full_refresh=True)
        files = stored.groupBy(F.input_file_name()).count().collect()
        assert max(r["count"] for r in files) < 0.4 * 8000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_views_of_the_catalog(spark):
    path = fresh_path(spark, "people")
    df = spark.createDataFrame([(1, "Ann", '[{"a": 1}, {"a": 2}]'), (2, None, "[]"), (3, "Bob", '[{"a": 3}]')], "pid int, name string, detail string")
    df.write.parquet(path)
    spark.sql("DROP TABLE IF EXISTS people_table")
    spark.sql(f"CREATE TABLE people_table USING parquet LOCATION '{path}'")
    me = spark.sql("SELECT current_user()").first()[0]
    hidden = masked_view(spark, "people_hidden", "people_table", ["name", "pid"], ("nobody", "o'brien", "back\\slash"))
    shown = masked_view(spark, "people_shown", "people_table", ["name"], (me,))
    assert {r.name for r in shown.collect()} == {"Ann", "Bob", None}
    assert {r.name for r in hidden.collect()} == {hashlib.md5(b"Ann").hexdigest(), hashlib.md5(b"Bob").hexdigest(), None}
    assert [f.dataType.simpleString() for f in hidden.schema.fields] == ["string", "string", "string"]
    spark.createDataFrame([(4, "Eve", "[]")], df.schema).write.mode("append").parquet(path)
    spark.catalog.refreshTable("people_table")
    assert spark.table("people_shown").filter("name = 'Eve'").count() == 1  # the view is live
    flat = unnest_view(spark, "view_people", "people_table", "detail", {"a": "int"}).drop("name")
    assert sorted(map(tuple, flat.collect())) == [(1, 1, 1), (2, 1, 2), (3, 3, 3)]


def test_snapshot_clean_up_writes_the_audit_first(spark, monkeypatch):
    path = fresh_path(spark, "snapshot")
    rows = [(1, 10, datetime(2020, 1, 1), None), (1, 5, datetime(2019, 1, 1), datetime(2020, 1, 1)), (2, 7, datetime(2019, 1, 1), datetime(2019, 6, 1))]
    df = spark.createDataFrame(rows, "k int, v int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    df.write.parquet(f"{path}/s")
    at = datetime(2020, 2, 5, 1, 2, 3)

    def stop(*_):
        raise OSError

    monkeypatch.setattr(SN.folders, "swap", stop)
    with pytest.raises(OSError):
        SN.clean_up(spark, f"{path}/s", f"{path}/a", at)
    assert spark.read.parquet(f"{path}/s").count() == 3 and spark.read.parquet(f"{path}/a").count() == 2
    monkeypatch.undo()
    assert SN.clean_up(spark, f"{path}/s", f"{path}/a", at) == 2  # run again after the stop: nothing is there twice
    assert [(r.k, r.v) for r in spark.read.parquet(f"{path}/s").collect()] == [(1, 10)]
    assert sorted((r.k, r.v, r._inserted_at) for r in spark.read.parquet(f"{path}/a").collect()) == [(1, 5, at), (2, 7, at)]
    assert SN.clean_up(spark, f"{path}/s", f"{path}/a", at + timedelta(days=1)) == 0 and spark.read.parquet(f"{path}/a").count() == 2


def test_lookup_tables_hold_each_key_once(spark, tmp_path):
    df = spark.createDataFrame([("x", 1), ("y", 2)], "v string, k int")
    assert lookup_table(df, "k").columns == ["k", "v"]
    for bad in (df.unionByName(df), df.unionByName(df.withColumn("k", F.lit(None).cast("int")))):
        with pytest.raises(ValueError):
            lookup_table(bad, "k")

import time
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hexmart.session import fresh_path
from hexmart.sources import incremental as I
from hexmart.sources import sinks
from hexmart.sources.stored import StoredTable

SCHEMA = "id int, day date, n int"
DAYS = [date(2024, 1, d) for d in range(1, 6)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def target(spark):
    """Five days of ten rows, and two rows without a day."""
    table = StoredTable(spark, fresh_path(spark, "stored"), "day", SCHEMA)
    table.overwrite_dynamic(frame(spark, [(10 * k + i, d, 0) for k, d in enumerate(DAYS) for i in range(10)] + [(100, None, 0), (101, None, 0)]))
    return table


def content(table):
    return Counter(tuple(r) for r in table.read().select("id", "day", "n").collect())


def files(table):
    out = {}
    for name in table.read().inputFiles():
        out.setdefault(name.split("day=")[1].split("/")[0], set()).add(name)
    return out


def test_listing_tells_what_is_stored(spark, target):
    assert target.exists() and set(target.partitions()) == {*DAYS, None} and target.newest() == DAYS[-1]
    empty = StoredTable(spark, fresh_path(spark, "stored"), "day", SCHEMA)
    assert not empty.exists() and empty.partitions() == [] and empty.newest() is None and empty.read().count() == 0
    odd = StoredTable(spark, fresh_path(spark, "stored"), "kind", "kind string, n int")
    odd.overwrite_dynamic(spark.createDataFrame([("a/b c=é%", 1), ("", 2), (None, 3)], odd.schema))
    assert set(odd.partitions()) == {"a/b c=é%", None}  # Spark stores an empty string as null


def test_merge_keeps_the_rest_of_the_null_partition(spark, target):
    """A row of the null partition is updated; the other one stays, and no other day is touched."""
    before = files(target)
    target.merge(frame(spark, [(100, None, 5), (7, DAYS[0], 5), (200, date(2024, 2, 1), 5)]), ["id"])
    want = Counter((10 * k + i, d, 5 if (k, i) == (0, 7) else 0) for k, d in enumerate(DAYS) for i in range(10)) + Counter([(100, None, 5), (101, None, 0), (200, date(2024, 2, 1), 5)])
    assert content(target) == want
    after = files(target)
    assert all(after[d] == before[d] for d in map(str, DAYS[1:])) and after[str(DAYS[0])].isdisjoint(before[str(DAYS[0])])
    I.merge_partitions(target.path, frame(spark, [(101, None, 6)]), ["id"], "day")
    assert content(target)[(101, None, 6)] == 1 and content(target)[(100, None, 5)] == 1
    with pytest.raises(ValueError):
        target.merge(frame(spark, [(1, DAYS[0], 1), (1, DAYS[0], 2)]), ["id"])


def test_merge_on_null_keys(spark, target):
    target.merge(frame(spark, [(None, DAYS[0], 1)]), ["id", "day"])
    target.merge(frame(spark, [(None, DAYS[0], 2)]), ["id", "day"])
    assert [k for k in content(target) if k[0] is None] == [(None, DAYS[0], 2)]


def test_delete_insert_follows_keys_to_any_partition(spark, target):
    """Key 7 is stored on day 1 and comes in on day 3; key 30 and 101 leave partitions that the batch never names."""
    before = files(target)
    target.delete_insert(frame(spark, [(7, DAYS[2], 9), (7, DAYS[2], 10), (30, DAYS[2], 9), (101, DAYS[2], 9)]), "id")
    got = content(target)
    assert {k for k in got if k[0] in (7, 30, 101)} == {(7, DAYS[2], 9), (7, DAYS[2], 10), (30, DAYS[2], 9), (101, DAYS[2], 9)} and sum(got.values()) == 53
    after = files(target)
    assert all(after[str(d)] == before[str(d)] for d in (DAYS[1], DAYS[4])) and after[str(DAYS[0])].isdisjoint(before[str(DAYS[0])])


def test_delete_insert_removes_emptied_partitions(spark, target):
    target.delete_insert(frame(spark, [(i, DAYS[0], 1) for i in range(10, 20)] + [(100, DAYS[0], 1), (101, DAYS[0], 1)]), "id")
    assert set(target.partitions()) == {*DAYS[:1], *DAYS[2:]} and sum(content(target).values()) == 52


def test_static_overwrite_touches_the_listed_partitions_alone(spark, target):
    before = files(target)
    batch = frame(spark, [(1, DAYS[0], 7), (2, DAYS[4], 7), (3, None, 7)])
    for _ in range(2):
        target.overwrite_static(batch, [DAYS[0], DAYS[1]])
        assert {k for k in content(target) if k[2] == 7} == {(1, DAYS[0], 7)} and DAYS[1] not in target.partitions()
    after = files(target)
    assert all(after[str(d)] == before[str(d)] for d in DAYS[2:]) and content(target)[(100, None, 0)] == 1
    target.overwrite_static(batch, [None])
    assert {k for k in content(target) if k[1] is None} == {(3, None, 7)}
    target.overwrite_static(batch.limit(0), [None, DAYS[4]])
    assert set(target.partitions()) == {DAYS[0], DAYS[2], DAYS[3]}


def test_dynamic_overwrite_keeps_other_files(spark, target):
    before = files(target)
    target.overwrite_dynamic(frame(spark, [(1, DAYS[2], 7)]))
    after = files(target)
    assert {k for k in content(target) if k[1] == DAYS[2]} == {(1, DAYS[2], 7)} and all(after[str(d)] == before[str(d)] for d in DAYS if d != DAYS[2])


def test_window_follows_the_target(spark, target):
    stamps = spark.createDataFrame([(datetime(2024, 1, d, 5),) for d in range(1, 20)], "ts timestamp_ntz")
    days = lambda table: sorted(r.ts.day for r in stamps.filter(table.due("ts", date(2024, 1, 10), old=3, new=1)).collect())
    assert days(target) == [4, 5, 6, 7, 8, 9]  # five days behind: all of them, not only yesterday
    assert days(StoredTable(spark, fresh_path(spark, "stored"), "day", SCHEMA)) == [7, 8, 9]


def test_pruning_reads_touched_folders_only(target):
    plan = target.read().filter(target.within([DAYS[0], None]))
    assert {f.split("day=")[1].split("/")[0] for f in plan.inputFiles()} <= set(files(target))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "PartitionFilters: []" not in text


@pytest.mark.parametrize("at_once", [None, 2])
def test_blocked_load_reads_its_input_once(spark, at_once, tmp_path):
    """The input counts how often its rows are made."""
    path, made = fresh_path(spark, "blocks"), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    df = spark.range(500).withColumn("cell", F.col("id") % 40).mapInPandas(count, "id bigint, cell bigint")
    log = sinks.blocked_load(df, f"{path}/d", f"{path}/log", 6, at_once=at_once)
    assert sorted(r.block for r in log.collect()) == [1, 2, 3, 4, 5, 6] and log.agg(F.sum("objects")).first()[0] == 500
    assert made.value == 500 and spark.read.parquet(f"{path}/d").count() == 500
    began = time.time()
    assert sinks.blocked_load(df, f"{path}/d", f"{path}/log", 6).count() == 6 and made.value == 500 and time.time() - began < 30

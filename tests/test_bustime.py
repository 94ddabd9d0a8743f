import random
from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from hexmart.functions import bustime as B

# Stamps of the sample tickets and the measures worked out for them.
TICKETS = """
263c7e90 2021-03-24T19:29:23 2021-03-25T08:29:20 1 12 60 0 60
af23d77b 2021-01-04T10:01:34 2021-01-05T09:54:29 1 12 713 600 713
e8b40b51 2021-01-07T19:54:44 2021-01-08T08:58:34 1 12 64 0 64
793a0185 2021-01-04T08:00:00 2021-01-05T09:53:02 1 12 833 720 833
f2721518 2021-02-01T08:00:00 2021-02-02T08:18:24 1 12 738 660 738
8995d903 2021-01-20T13:03:09 2021-01-20T13:29:37 0 0 26 0 26
aa0dfd6e 2021-01-28T17:13:50 2021-01-28T17:27:10 0 0 14 0 14
ee02aaa6 2021-03-17T09:44:29 2021-03-17T09:51:07 0 0 7 0 7
fc7ee5d4 2021-03-12T14:34:40 2021-03-12T14:57:09 0 0 23 0 23
618e94c1 2021-01-27T19:50:06 2021-01-27T19:51:38 0 0 1 0 1
"""


@pytest.fixture(scope="module")
def calendar(spark):
    return B.business_calendar(B.date_spine(spark, date(2020, 12, 1), date(2022, 2, 1))).cache()


def stamps(spark, rows):
    return spark.createDataFrame(rows, "id string, s timestamp_ntz, e timestamp_ntz")


def test_sample_tickets(spark):
    lines = [line.split() for line in TICKETS.strip().splitlines()]
    rows = [(i, datetime.fromisoformat(s), datetime.fromisoformat(e)) for i, s, e, *_ in lines]
    got = {r[0]: tuple(r)[3:] for r in B.ticket_measures(stamps(spark, rows), "s", "e").collect()}
    assert got == {line[0]: tuple(map(int, line[3:])) for line in lines}


def test_worked_example(spark):
    df = stamps(spark, [("14025", datetime(2021, 7, 9, 11, 29), datetime(2021, 7, 12, 14, 46)), ("open", datetime(2021, 7, 9, 11, 29), None)])
    rows = B.ticket_measures(df, "s", "e").orderBy("id").collect()
    assert (rows[0].working_min_subquery, rows[0].business_minutes__2) == (840, 917)
    assert (rows[1].non_working_hours, rows[1].working_min_subquery, rows[1].business_minutes__2, rows[1].business_minutes__1) == (0, 0, 0, None)


def is_open(h):
    dow, day = (h.weekday() + 1) % 7, h.date()
    if day < date(2021, 9, 14) and dow not in (0, 6) and 8 <= h.hour <= 19:
        return True
    if day >= date(2021, 9, 14) and dow == 0 and h.hour >= 19:
        return True
    return day >= date(2021, 9, 1) and (1 <= dow <= 4 or (dow == 5 and h.hour <= 19))


def test_calendar_hour_by_hour(calendar):
    rows = calendar.orderBy("date_hour").collect()
    assert len(rows) == (date(2022, 2, 1) - date(2020, 12, 1)).days * 24
    following = None
    for r in reversed(rows):
        following = r.date_hour if is_open(r.date_hour) else following
        assert r.is_business_hour == is_open(r.date_hour) and r.business_hour == following


def test_working_minutes_equal_the_range_count(spark, calendar):
    rng = random.Random(1)
    start = datetime(2020, 12, 5)
    rows = []
    for i in range(150):
        s = start + timedelta(minutes=rng.randrange(500_000))
        rows.append((str(i), s, s + timedelta(minutes=rng.randrange(-5000, 60_000))))
    df = stamps(spark, [r for r in rows if r[2] < datetime(2022, 1, 31)])
    fast = B.with_working_minutes(df, calendar, "s", "e", "w").select("id", "w")
    hours = calendar.filter("is_business_hour")
    slow = df.join(hours, (F.col("date_hour") > F.date_trunc("hour", "s")) & (F.col("date_hour") < F.date_trunc("hour", "e")), "left")
    slow = slow.groupBy("id").agg((F.count("date_hour") * 60).alias("w"))
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0
    closed = df.select("id", B.working_minutes(F.col("s"), F.col("e")).alias("w"))
    assert closed.exceptAll(slow).count() == 0 and slow.exceptAll(closed).count() == 0
    assert "Join" not in closed._jdf.queryExecution().executedPlan().toString()


def test_closed_form_hour_by_hour(spark):
    """Differences of the running count are the calendar itself, over all changes of the rules and before 1970."""
    for first, last in ((datetime(1969, 12, 20), datetime(1970, 1, 10)), (datetime(2021, 8, 25), datetime(2021, 9, 25))):
        hours = [first + timedelta(hours=n) for n in range(int((last - first).total_seconds() // 3600))]
        df = spark.createDataFrame([(h,) for h in hours], "h timestamp_ntz")
        n = B.hour_number(F.col("h"))
        rows = df.select("h", (B.open_hours_before(n + 1) - B.open_hours_before(n)).alias("n")).collect()
        assert {r.h: r.n for r in rows} == {h: int(is_open(h)) for h in hours}


def test_zone_of_the_rules_not_of_the_session(spark):
    """Tickets across both clock changes, in sessions of three zones: hours are those of the shop's wall clock."""
    paris = ZoneInfo("Europe/Paris")
    wall = [(datetime(2021, 3, 26, 18, 40), datetime(2021, 3, 29, 9, 5)), (datetime(2021, 10, 29, 18, 40), datetime(2021, 11, 1, 9, 5)),
            (datetime(2021, 10, 31, 2, 30, fold=1), datetime(2021, 11, 1, 0, 10)), (datetime(1969, 12, 31, 23, 59, 59, 250_000), datetime(1970, 1, 2, 12, 0))]
    seconds = [[(t.replace(tzinfo=paris) - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1) for t in pair] for pair in wall]
    rows = [(n, *pair) for n, pair in enumerate(seconds)]
    naive = spark.createDataFrame([(str(n), a.replace(fold=0), b) for n, (a, b) in enumerate(wall)], "id string, s timestamp_ntz, e timestamp_ntz")
    want = [tuple(r)[3:] for r in B.ticket_measures(naive, "s", "e").orderBy("id").collect()]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "Europe/Paris", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame(rows, "id int, a bigint, b bigint").select("id", F.timestamp_micros("a").alias("s"), F.timestamp_micros("b").alias("e"))
            got = B.ticket_measures(df, "s", "e", zone="Europe/Paris").orderBy("id").collect()
            assert [tuple(r)[3:] for r in got] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_boundaries_not_elapsed_time(spark):
    df = stamps(spark, [("a", datetime(2021, 1, 1, 11, 29, 31), datetime(2021, 1, 1, 11, 31)), ("b", datetime(2021, 1, 1), datetime(2021, 1, 4))])
    got = df.orderBy("id").select(B.minutes_between(F.col("s"), F.col("e")), B.weeks_between(F.col("s"), F.col("e"))).collect()
    assert [tuple(r) for r in got] == [(2, 0), (4320, 1)]

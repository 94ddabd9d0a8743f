"""Business-hours arithmetic: column functions, working time in closed form, the hour calendar for calendars of one's own."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORKING_START, WORKING_END = 8, 20


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from start to end (not elapsed minutes)."""
    days = F.datediff(end, start).cast("long")
    return days * 1440 + (F.hour(end) - F.hour(start)) * 60 + (F.minute(end) - F.minute(start))


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def _week(day: Column) -> Column:
    """Number of the Monday-based week of a date."""
    return F.floor((F.unix_date(F.to_date(day)) + 3) / 7)


def weeks_between(start: Column, end: Column) -> Column:
    """Monday boundaries crossed from start to end."""
    return _week(end) - _week(start)


def weekdays_between(start: Column, end: Column) -> Column:
    """Weekday nights between two stamps: Friday to Monday is one."""
    next_day = F.date_add(F.to_date(end), 1)
    return days_between(start, end) - weeks_between(start, next_day) - weeks_between(start, end)


def non_business_hours_between(start: Column, end: Column, opens: int = WORKING_START, closes: int = WORKING_END) -> Column:
    """Closed hours between two stamps: nights after weekdays plus whole weekend days; NULL counts 0."""
    weekdays = weekdays_between(start, end)
    closed = weekdays * (24 - (closes - opens)) + (days_between(start, end) - weekdays) * 24
    return F.coalesce(closed, F.lit(0)).cast("long")


def business_minutes_simple(start: Column, end: Column, opens: int = WORKING_START, closes: int = WORKING_END) -> Column:
    return minutes_between(start, end) - non_business_hours_between(start, end, opens, closes) * 60


@dataclass(frozen=True)
class OpeningRule:
    """Open on the given weekdays (0 = Sunday) from ``first_hour`` to ``last_hour``, both included, within a period."""

    weekdays: tuple[int, ...]
    first_hour: int
    last_hour: int
    since: date | None = None
    before: date | None = None

    def holds(self, hour: Column) -> Column:
        day = F.to_date(hour)
        ok = (F.dayofweek(day) - 1).isin(*self.weekdays) & F.hour(hour).between(self.first_hour, self.last_hour)
        if self.since:
            ok = ok & (day >= F.lit(self.since))
        if self.before:
            ok = ok & (day < F.lit(self.before))
        return ok


# The support hours as they were dated.
SUPPORT_HOURS = (
    OpeningRule((1, 2, 3, 4, 5), 8, 19, before=date(2021, 9, 14)),
    OpeningRule((0,), 19, 23, since=date(2021, 9, 14)),
    OpeningRule((1, 2, 3, 4), 0, 23, since=date(2021, 9, 1)),
    OpeningRule((5,), 0, 19, since=date(2021, 9, 1)),
)


def date_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per hour from ``start`` up to but without ``end``."""
    days = spark.range((end - start).days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"))
    first = F.col("day").cast("timestamp_ntz")
    return days.select(F.explode(F.sequence(first, first + F.expr("interval 23 hours"), F.expr("interval 1 hour"))).alias("date_hour"))


def business_calendar(spine: DataFrame, rules: tuple[OpeningRule, ...] = SUPPORT_HOURS) -> DataFrame:
    """``date_hour``, the business hour it counts for (itself or the next one), and whether it is one.

    The look-ahead runs inside each month; across months it needs only one row per month.
    """
    is_open = F.lit(False)
    for rule in rules:
        is_open = is_open | rule.holds(F.col("date_hour"))
    hours = spine.distinct().withColumn("_month", F.trunc("date_hour", "month")).withColumn("_open", F.when(is_open, F.col("date_hour")))
    within = Window.partitionBy("_month").orderBy("date_hour").rowsBetween(1, Window.unboundedFollowing)
    later = Window.orderBy("_month").rowsBetween(1, Window.unboundedFollowing)
    months = hours.groupBy("_month").agg(F.min("_open").alias("_first"))
    months = months.select("_month", F.first("_first", ignorenulls=True).over(later).alias("_later"))
    ahead = F.coalesce(F.first("_open", ignorenulls=True).over(within), F.col("_later"))
    return hours.join(months, "_month").select(
        "date_hour", F.coalesce("_open", ahead).alias("business_hour"), F.col("_open").isNotNull().alias("is_business_hour")
    )


def open_hours_up_to(calendar: DataFrame) -> DataFrame:
    """``date_hour`` and the number of business hours up to and including it, counted per month plus offsets."""
    hours = calendar.withColumn("_month", F.trunc("date_hour", "month"))
    one = F.col("is_business_hour").cast("long")
    before = Window.orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    months = hours.groupBy("_month").agg(F.sum(one).alias("_n"))
    months = months.select("_month", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_month").orderBy("date_hour")
    return hours.join(months, "_month").select("date_hour", (F.col("_before") + F.sum(one).over(within)).alias("open_hours"))


def with_working_minutes(df: DataFrame, calendar: DataFrame, start: str, end: str, out: str) -> DataFrame:
    """60 times the business hours strictly between the hours of two stamps.

    For calendars that no weekly rule describes, as with holidays; :func:`working_minutes` needs none.  Two equi joins on
    the running count take the place of a range join; the calendar must cover the stamps.
    """
    counts = open_hours_up_to(calendar)
    first = F.date_trunc("hour", F.col(start)).cast("timestamp_ntz")
    last = (F.date_trunc("hour", F.col(end)) - F.expr("interval 1 hour")).cast("timestamp_ntz")
    left = counts.select(F.col("date_hour").alias("_from"), F.col("open_hours").alias("_n0"))
    right = counts.select(F.col("date_hour").alias("_to"), F.col("open_hours").alias("_n1"))
    joined = df.withColumn("_f", first).withColumn("_t", last)
    joined = joined.join(left, F.col("_f") == F.col("_from"), "left").join(right, F.col("_t") == F.col("_to"), "left")
    minutes = F.coalesce(F.greatest(F.lit(0), F.col("_n1") - F.col("_n0")), F.lit(0)).cast("long") * 60
    return joined.withColumn(out, minutes).drop("_f", "_t", "_from", "_to", "_n0", "_n1")


def local_time(stamp: Column, zone: str) -> Column:
    """Wall-clock time (timestamp_ntz) in ``zone`` of an instant, whatever the session's zone is.

    It goes by the instant's microseconds, as a cast would go through the session's wall clock, where an hour is ambiguous once a year.
    """
    micros = F.unix_micros(stamp)
    second = F.lit(1_000_000)
    seconds, rest = F.call_function("div", micros - F.pmod(micros, second), second), F.pmod(micros, second)
    day = F.call_function("div", seconds - F.pmod(seconds, F.lit(86_400)), F.lit(86_400))
    start = F.date_add(F.lit(date(1970, 1, 1)), day.cast("int")).cast("timestamp_ntz")
    within = F.pmod(seconds, F.lit(86_400)) + (rest / 1_000_000).cast("decimal(8,6)")
    utc = start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), within)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def hour_number(stamp: Column) -> Column:
    """Hours since 1970-01-01 of the wall clock."""
    return F.unix_date(F.to_date(stamp)).cast("long") * 24 + F.hour(stamp)


# 1970-01-01 was a Thursday; weeks are counted from Sunday.
WEEK, FIRST_HOUR_OF_WEEK = 168, 96


def _eras(rules: tuple[OpeningRule, ...]) -> list[tuple[date | None, date | None, list[int]]]:
    """Periods without a change of rules, with the open hours of their week as 168 zeros and ones."""
    cuts = sorted({d for rule in rules for d in (rule.since, rule.before) if d})
    out = []
    for start, end in zip([None, *cuts], [*cuts, None]):
        open_ = [0] * WEEK
        for rule in rules:
            begun = rule.since is None or (start is not None and rule.since <= start)
            going = rule.before is None or (end is not None and end <= rule.before)
            for day in rule.weekdays if begun and going else ():
                for hour in range(rule.first_hour, rule.last_hour + 1):
                    open_[day * 24 + hour] = 1
        out.append((start, end, open_))
    return out


def open_hours_before(hour: Column, rules: tuple[OpeningRule, ...] = SUPPORT_HOURS) -> Column:
    """Open hours before an hour number, up to a constant: whole weeks plus a look-up in the week's 168 running counts.

    The hour's period picks the week, the counts and an offset that makes the total run on where the rules change.
    """
    cuts, weekly, running, offsets = [], [], [], []
    for start, _, open_ in _eras(rules):
        counts = [sum(open_[:n]) for n in range(WEEK)]
        offset = 0
        if start is not None:
            cut = (start - date(1970, 1, 1)).days * 24
            weeks, place = divmod(cut + FIRST_HOUR_OF_WEEK, WEEK)
            before = offsets[-1] + weeks * weekly[-1] + running[-WEEK + place]
            offset = before - weeks * sum(open_) - counts[place]
            cuts.append(cut)
        weekly.append(sum(open_))
        running += counts
        offsets.append(offset)

    def look_up(values: list[int], n: Column) -> Column:
        return F.get(F.array(*[F.lit(v).cast("long") for v in values]), n)

    period = F.lit(0)
    for cut in cuts:
        period = period + (hour >= cut).cast("int")
    place = F.pmod(hour + FIRST_HOUR_OF_WEEK, F.lit(WEEK)).cast("int")
    weeks = F.call_function("div", hour + FIRST_HOUR_OF_WEEK - place, F.lit(WEEK).cast("long"))
    return weeks * look_up(weekly, period) + look_up(running, period * WEEK + place) + look_up(offsets, period)


def working_minutes(start: Column, end: Column, rules: tuple[OpeningRule, ...] = SUPPORT_HOURS) -> Column:
    """60 times the open hours strictly between the hours of two wall-clock stamps; 0 if either is NULL or the end comes first.

    The wall clock decides: an hour that daylight saving skips or repeats counts once, as it does in a calendar of hours.
    """
    hours = open_hours_before(hour_number(end), rules) - open_hours_before(hour_number(start) + 1, rules)
    return F.greatest(F.lit(0).cast("long"), hours) * 60  # passes over NULL


def business_minutes_by_calendar(start: Column, end: Column, working_minutes: Column) -> Column:
    """Minutes of open time: the working minutes between, plus what is left of the first and used of the last hour."""
    same_hour = F.date_trunc("hour", start) == F.date_trunc("hour", end)
    spread = working_minutes + (F.lit(60) - F.minute(start)) + F.minute(end)
    return F.coalesce(F.when(same_hour, minutes_between(start, end)).otherwise(spread), F.lit(0)).cast("long")


def ticket_measures(
    tickets: DataFrame, start: str, end: str, rules: tuple[OpeningRule, ...] = SUPPORT_HOURS, zone: str | None = None
) -> DataFrame:
    """All measures of both attempts beside the ticket columns, without a join.

    Stamps are wall-clock times (timestamp_ntz); with ``zone`` they are instants, measured by the wall clock of that zone.
    """
    s, e = (F.col(c) if zone is None else local_time(F.col(c), zone) for c in (start, end))
    out = tickets.withColumns({
        "weekdays_to_first_response": weekdays_between(s, e),
        "non_working_hours": non_business_hours_between(s, e),
        "business_minutes__1": business_minutes_simple(s, e),
        "working_min_subquery": working_minutes(s, e, rules),
    })
    return out.withColumn("business_minutes__2", business_minutes_by_calendar(s, e, F.col("working_min_subquery")))

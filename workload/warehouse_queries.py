"""Incremental loads, lambda views, snapshots, materialized views, masking, checks, business hours and streams."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexmart.functions import bustime as B
from hexmart.operators import quality as Q
from hexmart.operators.aggregates import json_fold
from hexmart.operators.lookup import not_in, union_relations
from hexmart.plans import lambdaview as L
from hexmart.plans import pageviews as P
from hexmart.plans import snapshot as SN
from hexmart.plans.matview import MaterializedView, geometry_view, unnest_view
from hexmart.plans.matview import masked_view as masked_view_of
from hexmart.session import fresh_path, materialize
from hexmart.sources import incremental as I
from hexmart.sources import sinks
from hexmart.sources.catalog import Catalog, Source, freshness, read_csv
from hexmart.sources.stored import StoredTable
from hexmart.streaming import streams as ST
from workload import standins as S
from workload.registry import query, table

# Sources and sinks ----------------------------------------------------------------------------------------------


@query("scan_catalog", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def scan_catalog(spark: SparkSession, sf: str) -> DataFrame:
    catalog = Catalog({name: Source(f"{sf}/{name}.parquet") for name in ("nation", "region")})
    nation, region = catalog.load(spark, "nation"), catalog.load(spark, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


@query("scan_csv_typed", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv_typed(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "seed")
    table(spark, sf, "customer").write.option("header", True).csv(path)
    return read_csv(spark, path, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")


@query("scan_lookup", f"WITH {S.DATES} SELECT date, date_id, year FROM dates")
def scan_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """A stored dimension, read by name and indexed by its key."""
    path = fresh_path(spark, "dates")
    S.dates(spark, sf).write.parquet(path)
    return Catalog({"dims.dates": Source(path)}).lookup(spark, "dims.dates", "date_id")


@query("source_freshness", """SELECT max(ts) AS newest, date_sub('second', max(ts), TIMESTAMP '2024-01-31 06:00:00') / 3600.0::DOUBLE AS age_hours,
date_sub('second', max(ts), TIMESTAMP '2024-01-31 06:00:00') / 3600.0::DOUBLE > 1 AS stale FROM events""")
def source_freshness(spark: SparkSession, sf: str) -> DataFrame:
    return freshness(table(spark, sf, "events"), "ts", datetime(2024, 1, 31, 6), 1)


@query("sink_append_replace", """SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderstatus, n FROM orders, (VALUES (1), (2)) v(n) WHERE n = 1 OR o_orderstatus = 'F'""")
def sink_append_replace(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "sink")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    sinks.update_table(orders.withColumn("n", F.lit(0)), path, "replace", types={"o_orderkey": "int"})
    sinks.update_table(orders.withColumn("n", F.lit(1)), path, "replace", types={"o_orderkey": "int"}, rows_per_file=5_000_000)
    finished = orders.filter("o_orderstatus = 'F'").withColumn("n", F.lit(2))
    sinks.update_table(finished, path, "append", types={"o_orderkey": "int"})
    sinks.update_table(finished.filter("o_orderkey is null"), path, "append", types={"o_orderkey": "int"})
    return spark.read.parquet(path)


@query("layout_cluster_by_cell", f"WITH {S.FIRES} SELECT cell, o_orderkey FROM fires")
def layout_cluster_by_cell(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "layout")
    sinks.cluster_by_cell(S.fires(spark, sf).select("cell", "o_orderkey")).write.parquet(path)
    return spark.read.parquet(path)


@query("check_srid_pk", """SELECT CAST(0 AS BIGINT) AS wrong_srid, CAST(count(*) - count(l_orderkey) AS BIGINT) AS null_keys,
CAST(count(l_orderkey) - count(DISTINCT l_orderkey) AS BIGINT) AS duplicate_keys FROM lineitem""")
def check_srid_pk(spark: SparkSession, sf: str) -> DataFrame:
    return Q.key_and_srid(table(spark, sf, "lineitem").withColumn("srid", F.lit(sinks.SRID)), "l_orderkey", "srid", sinks.SRID)


def _load(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    path = fresh_path(spark, "blocks")
    facts = materialize(S.fires(spark, sf).select("cell", "o_orderkey"), "facts")
    sinks.blocked_load(facts, f"{path}/data", f"{path}/log", 8, start=5, at_once=4)
    return path, sinks.blocked_load(facts, f"{path}/data", f"{path}/log", 8, at_once=4)


@query("blocked_load_resume", "SELECT o_orderkey FROM orders")
def blocked_load_resume(spark: SparkSession, sf: str) -> DataFrame:
    path, _ = _load(spark, sf)
    return spark.read.parquet(f"{path}/data").select("o_orderkey")


@query("load_progress", "SELECT CAST(8 AS BIGINT) AS blocks, count(*) AS objects FROM orders")
def load_progress(spark: SparkSession, sf: str) -> DataFrame:
    return _load(spark, sf)[1].agg(F.count("*").alias("blocks"), F.sum("objects").alias("objects"))


# Wiki page views and incremental loads ---------------------------------------------------------------------------

SQL_VIEWS = """views AS (SELECT date_trunc('hour', ts) AS datehour, CASE user_id % 3 WHEN 0 THEN 'en.m' WHEN 1 THEN 'fr' ELSE 'pt-br.z' END AS wiki,
  event_type AS title, CAST(floor(value) AS BIGINT) AS views FROM events),
seeds AS (SELECT DISTINCT CASE WHEN event_type IN ('click', 'view') THEN 'seed_look' ELSE 'seed_act' END AS _source_relation,
  replace(split_part(wiki, '.', 1), '-', '_') AS lang, event_type AS title, event_type IN ('click', 'view') AS look
  FROM (SELECT event_type, CASE user_id % 3 WHEN 0 THEN 'en.m' WHEN 1 THEN 'fr' ELSE 'pt-br.z' END AS wiki FROM events WHERE event_type <> 'error')),
pages AS (SELECT _source_relation, lang, title, CASE WHEN look THEN title END AS shown,
  max(CASE WHEN lang = 'en' THEN lower(replace(title, '-', '_')) END) OVER (PARTITION BY _source_relation) AS subject FROM seeds)"""


def _views(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    wiki = F.when(F.col("user_id") % 3 == 0, "en.m").when(F.col("user_id") % 3 == 1, "fr").otherwise("pt-br.z")
    return e.select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("datehour"),
        wiki.alias("wiki"),
        F.col("event_type").alias("title"),
        F.floor("value").cast("bigint").alias("views"),
    )


def _seeds(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    pages = _views(spark, sf).filter("title <> 'error'").select(P.language(F.col("wiki")).alias("lang"), "title").distinct()
    looks = F.col("title").isin("click", "view")
    return {"seed_look": pages.filter(looks).withColumn("shown", F.col("title")), "seed_act": pages.filter(~looks)}


def _tagged(spark: SparkSession, sf: str, as_of: date, days: int) -> DataFrame:
    return P.tagged_views(_views(spark, sf), P.pages_of_interest(_seeds(spark, sf)), as_of, days)


def _sql_tagged(as_of: str, days: int) -> str:
    return f"""(SELECT v.*, replace(split_part(wiki, '.', 1), '-', '_') AS lang, p.subject FROM views v LEFT JOIN pages p
  ON p.title = v.title AND p.lang = replace(split_part(v.wiki, '.', 1), '-', '_')
  WHERE datehour >= TIMESTAMP '{as_of}' - INTERVAL {days} DAY AND datehour < TIMESTAMP '{as_of}')"""


def _sql_hourly(as_of: str, days: int) -> str:
    return f"""(SELECT md5(strftime(datehour, '%Y-%m-%d %H:%M:%S') || '-' || coalesce(subject, '') || '-' || lang) AS id, datehour AS date_hour, subject, lang,
  CAST(sum(views) AS BIGINT) AS total_views FROM {_sql_tagged(as_of, days)} GROUP BY datehour, subject, lang)"""


def _sql_daily(as_of: str, days: int) -> str:
    return f"""(SELECT md5(CAST(CAST(datehour AS DATE) AS VARCHAR) || '-' || lang || '-' || title) AS id, CAST(datehour AS DATE) AS date_day, lang, title,
  subject, CAST(sum(views) AS BIGINT) AS views FROM {_sql_tagged(as_of, days)} GROUP BY ALL)"""


@query("union_relations", f"WITH {SQL_VIEWS} SELECT _source_relation, lang, title, shown FROM pages")
def q_union_relations(spark: SparkSession, sf: str) -> DataFrame:
    return union_relations(_seeds(spark, sf))


@query("subject_by_source", f"WITH {SQL_VIEWS} SELECT _source_relation, lang, title, shown, subject FROM pages")
def subject_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return P.subject_by_source(union_relations(_seeds(spark, sf)))


@query("pages_of_interest", f"WITH {SQL_VIEWS} SELECT _source_relation, lang, title, shown, subject FROM pages")
def pages_of_interest(spark: SparkSession, sf: str) -> DataFrame:
    return P.pages_of_interest(_seeds(spark, sf))


@query("date_range_filter", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-17' AND ts < TIMESTAMP '2024-01-20'")
def date_range_filter(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").filter(I.day_window("ts", date(2024, 1, 20), 3)).select("event_id", "ts")


@query("tag_left_using", f"WITH {SQL_VIEWS} SELECT datehour, title, lang, views, subject FROM {_sql_tagged('2024-01-31', 40)}")
def tag_left_using(spark: SparkSession, sf: str) -> DataFrame:
    return _tagged(spark, sf, date(2024, 1, 31), 40).select("datehour", "title", "lang", "views", "subject")


@query("pv_aggregated", f"WITH {SQL_VIEWS} SELECT * FROM {_sql_hourly('2024-01-31', 40)}")
def pv_aggregated(spark: SparkSession, sf: str) -> DataFrame:
    return P.hourly_aggregated(_tagged(spark, sf, date(2024, 1, 31), 40))


@query("pv_enriched", f"""WITH {SQL_VIEWS} SELECT md5(strftime(datehour, '%Y-%m-%d %H:%M:%S') || '-' || lang || '-' || title) AS id, datehour AS date_hour, lang, title,
  subject, CAST(sum(views) AS BIGINT) AS views FROM {_sql_tagged('2024-01-31', 40)} GROUP BY datehour, lang, title, subject""")
def pv_enriched(spark: SparkSession, sf: str) -> DataFrame:
    return P.hourly_enriched(_tagged(spark, sf, date(2024, 1, 31), 40))


@query("pv_daily", f"WITH {SQL_VIEWS} SELECT * FROM {_sql_daily('2024-01-31', 40)}")
def pv_daily(spark: SparkSession, sf: str) -> DataFrame:
    return P.daily(_tagged(spark, sf, date(2024, 1, 31), 40))


def _corrected(df: DataFrame, column: str) -> DataFrame:
    """What a later load of the same days would bring: the counts have grown by one."""
    return df.withColumn(column, F.col(column) + 1)


def _hourly_steps(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    first = P.hourly_aggregated(_tagged(spark, sf, date(2024, 1, 20), 40))
    return first, _corrected(P.hourly_aggregated(_tagged(spark, sf, date(2024, 1, 25), 8)), "total_views")


SQL_MERGED = f"""WITH {SQL_VIEWS}, old AS (SELECT * FROM {_sql_hourly('2024-01-20', 40)}),
fresh AS (SELECT * REPLACE (total_views + 1 AS total_views) FROM {_sql_hourly('2024-01-25', 8)})
SELECT * FROM old WHERE id NOT IN (SELECT id FROM fresh) UNION ALL SELECT * FROM fresh"""


@query("inc_merge", SQL_MERGED)
def inc_merge(spark: SparkSession, sf: str) -> DataFrame:
    old, fresh = _hourly_steps(spark, sf)
    return I.merge(old, fresh, ["id"])


@query("inc_merge_clustered", f"SELECT *, CAST(date_hour AS DATE) AS day FROM ({SQL_MERGED})")
def inc_merge_clustered(spark: SparkSession, sf: str) -> DataFrame:
    """On a stored table: only the touched days are rewritten, laid out by id."""
    path = fresh_path(spark, "merge")
    old, fresh = [d.withColumn("day", F.to_date("date_hour")) for d in _hourly_steps(spark, sf)]
    old.write.partitionBy("day").parquet(path)
    I.merge_partitions(path, fresh, ["id"], "day", cluster=["id"])
    return spark.read.schema(old.schema).parquet(path)


SQL_OLD_DAILY, SQL_NEW_DAILY = _sql_daily("2024-01-20", 40), _sql_daily("2024-01-25", 8)


@query("inc_overwrite_dynamic", f"""WITH {SQL_VIEWS}, old AS (SELECT * FROM {SQL_OLD_DAILY}), fresh AS (SELECT * REPLACE (views + 1 AS views) FROM {SQL_NEW_DAILY})
SELECT * FROM old WHERE date_day NOT IN (SELECT date_day FROM fresh) UNION ALL SELECT * FROM fresh""")
def inc_overwrite_dynamic(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "overwrite")
    old = P.daily(_tagged(spark, sf, date(2024, 1, 20), 40))
    I.write_partitions(old, path, "date_day")
    I.write_partitions(_corrected(P.daily(_tagged(spark, sf, date(2024, 1, 25), 8)), "views"), path, "date_day")
    return spark.read.schema(old.schema).parquet(path)


@query("inc_overwrite_static", f"""WITH {SQL_VIEWS}, old AS (SELECT * FROM {SQL_OLD_DAILY}), fresh AS (SELECT * REPLACE (views + 1 AS views) FROM {_sql_daily('2024-01-25', 8)})
SELECT * FROM old WHERE date_day NOT BETWEEN DATE '2024-01-16' AND DATE '2024-01-21'
UNION ALL SELECT * FROM fresh WHERE date_day BETWEEN DATE '2024-01-16' AND DATE '2024-01-21'""")
def inc_overwrite_static(spark: SparkSession, sf: str) -> DataFrame:
    old = P.daily(_tagged(spark, sf, date(2024, 1, 20), 40))
    fresh = _corrected(P.daily(_tagged(spark, sf, date(2024, 1, 25), 8)), "views")
    return I.overwrite_static(old, fresh, "date_day", I.last_partitions(date(2024, 1, 22), 6))


@query("inc_delete_insert", """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
UNION ALL SELECT l_orderkey, l_linenumber, l_quantity + 1 FROM lineitem WHERE l_returnflag = 'R'""")
def inc_delete_insert(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    batch = rows.filter("l_returnflag = 'R'").withColumn("l_quantity", F.col("l_quantity") + 1)
    return I.delete_insert(rows, batch, "l_orderkey").drop("l_returnflag")


@query("inc_bootstrap", """SELECT 'first' AS run, event_id FROM events WHERE ts >= TIMESTAMP '2024-01-17' AND ts < TIMESTAMP '2024-01-20'
UNION ALL SELECT 'later', event_id FROM events WHERE ts >= TIMESTAMP '2024-01-19' AND ts < TIMESTAMP '2024-01-20'""")
def inc_bootstrap(spark: SparkSession, sf: str) -> DataFrame:
    """What a load would take before and after its target exists; the target's listing decides."""
    events = table(spark, sf, "events")
    target = StoredTable(spark, fresh_path(spark, "bootstrap"), "day", "event_id bigint, day date")
    runs = []
    for run in ("first", "later"):
        due = events.filter(target.due("ts", date(2024, 1, 20), old=3, new=0))
        runs.append(due.select(F.lit(run).alias("run"), "event_id"))
        if run == "first":
            target.overwrite_dynamic(due.select("event_id", F.to_date("ts").alias("day")))
    return runs[0].unionByName(runs[1])


DAILY_SCHEMA = "id string, date_day date, lang string, title string, subject string, views bigint"


def _stored_daily(spark: SparkSession, sf: str, tag: str) -> StoredTable:
    """Forty days of daily views up to 2024-01-20, a folder per day."""
    target = StoredTable(spark, fresh_path(spark, tag), "date_day", DAILY_SCHEMA)
    target.overwrite_dynamic(P.daily(_tagged(spark, sf, date(2024, 1, 20), 40)))
    return target


@query("inc_overwrite_static_stored", f"""WITH {SQL_VIEWS}, old AS (SELECT * FROM {SQL_OLD_DAILY}), fresh AS (SELECT * REPLACE (views + 1 AS views) FROM {_sql_daily('2024-01-25', 8)} WHERE date_day <> DATE '2024-01-18')
SELECT * FROM old WHERE date_day NOT BETWEEN DATE '2024-01-16' AND DATE '2024-01-21'
UNION ALL SELECT * FROM fresh WHERE date_day BETWEEN DATE '2024-01-16' AND DATE '2024-01-21'""")
def inc_overwrite_static_stored(spark: SparkSession, sf: str) -> DataFrame:
    """On a stored table; the batch has no row of one of the listed days, whose old rows go."""
    target = _stored_daily(spark, sf, "static")
    fresh = _corrected(P.daily(_tagged(spark, sf, date(2024, 1, 25), 8)), "views").filter("date_day <> date'2024-01-18'")
    target.overwrite_static(fresh, I.last_partitions(date(2024, 1, 22), 6))
    return target.read()


@query("inc_overwrite_newest", f"""WITH {SQL_VIEWS}, old AS (SELECT * FROM {SQL_OLD_DAILY}), fresh AS (SELECT * REPLACE (views + 1 AS views) FROM {_sql_daily('2024-01-25', 99)}
  WHERE date_day >= (SELECT max(date_day) FROM old) - INTERVAL 1 DAY)
SELECT * FROM old WHERE date_day NOT IN (SELECT date_day FROM fresh) UNION ALL SELECT * FROM fresh""")
def inc_overwrite_newest(spark: SparkSession, sf: str) -> DataFrame:
    """The window starts from the newest stored day, so a target that fell behind by five days catches up."""
    target = _stored_daily(spark, sf, "newest")
    first, last = target.window(date(2024, 1, 25), old=40, new=1)
    target.overwrite_dynamic(_corrected(P.daily(_tagged(spark, sf, last, (last - first).days)), "views"))
    return target.read()


@query("inc_merge_null_day", """WITH old AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS day, value FROM events)
SELECT event_id, day, CASE WHEN event_id % 10 = 0 AND (day IS NULL OR day = DATE '2024-01-17') THEN value + 1 ELSE value END AS value FROM old""")
def inc_merge_null_day(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without a day lie in a partition of their own; a merge that touches it keeps its other rows."""
    day = F.when(F.col("event_type") != "error", F.to_date("ts"))
    rows = table(spark, sf, "events").select("event_id", day.alias("day"), "value")
    target = StoredTable(spark, fresh_path(spark, "null-day"), "day", "event_id bigint, day date, value double")
    target.overwrite_dynamic(rows)
    batch = rows.filter("event_id % 10 = 0 and (day is null or day = date'2024-01-17')").withColumn("value", F.col("value") + 1)
    target.merge(batch, ["event_id"])
    return target.read()


@query("inc_delete_insert_stored", """WITH r AS (SELECT l_orderkey, l_linenumber, l_quantity, CAST(date_trunc('month', l_shipdate) AS DATE) AS month FROM lineitem),
hit AS (SELECT DISTINCT l_orderkey FROM r WHERE month = DATE '1995-06-01' AND l_quantity > 40)
SELECT * FROM r WHERE l_orderkey NOT IN (SELECT l_orderkey FROM hit) UNION ALL SELECT * REPLACE (l_quantity + 1 AS l_quantity) FROM r WHERE month = DATE '1995-06-01' AND l_quantity > 40""")
def inc_delete_insert_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The keys of one month's rows go from every month that holds them; months without them keep their files."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.to_date(F.trunc("l_shipdate", "month")).alias("month"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    target = StoredTable(spark, fresh_path(spark, "delete-insert"), "month", schema)
    target.overwrite_dynamic(rows.hint("rebalance", "month"))
    batch = rows.filter("month = date'1995-06-01' and l_quantity > 40").withColumn("l_quantity", F.col("l_quantity") + 1)
    target.delete_insert(batch, "l_orderkey")
    return target.read()


@query("inc_high_water", "SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events WHERE event_type = 'error' AND value > 100)")
def inc_high_water(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    stored = events.filter("event_type = 'error' and value > 100")
    return I.since_high_water(events, stored, "ts").select("event_id", "ts")


@query("last_n_partitions", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-01-19' GROUP BY 1")
def last_n_partitions(spark: SparkSession, sf: str) -> DataFrame:
    listed = table(spark, sf, "events").filter(I.day_window("ts", date(2024, 1, 20), 5)).withColumn("day", F.to_date("ts"))
    return listed.filter(F.col("day").isin(I.last_partitions(date(2024, 1, 20), 5))).groupBy("day").agg(F.count("*").alias("n"))


# Lambda views ---------------------------------------------------------------------------------------------------

SPLIT = datetime(2024, 1, 20, 12)
SQL_EVENTS = """ev AS (SELECT user_id || '-' || strftime(ts, '%Y%m%d') AS session_id, user_id AS anonymous_user_id,
  user_id || '-' || regexp_extract(props, '"k": (\\d+)', 1) || '-' || strftime(ts, '%Y%m%d') AS page_view_id, event_type AS page_url, ts FROM events)"""


def _sql_views(where: str = "true") -> str:
    return f"""(SELECT session_id, anonymous_user_id, page_view_id, page_url, count(*) * 10 AS approx_time_on_page, min(ts) AS page_view_start,
  max(ts) AS collector_tstamp FROM ev WHERE {where} GROUP BY 1, 2, 3, 4)"""


SQL_SESSIONS = """SELECT session_id, anonymous_user_id, count(*) AS page_views, CAST(sum(approx_time_on_page) AS BIGINT) AS total_time,
  min(page_view_start) AS session_start, max(collector_tstamp) AS collector_tstamp FROM {} GROUP BY 1, 2"""
BEFORE, AFTER = "ts < TIMESTAMP '2024-01-20 12:00:00'", "ts >= TIMESTAMP '2024-01-20 12:00:00'"


def web_events(events: DataFrame) -> DataFrame:
    """The event table in the shape of a web tracker, with its context as JSON."""
    day = F.date_format("ts", "yyyyMMdd")
    view = F.concat_ws("-", "user_id", F.get_json_object("props", "$.k"), day)
    return events.select(
        F.concat_ws("-", "user_id", day).alias("domain_sessionid"),
        F.col("user_id").alias("domain_userid"),
        F.concat(F.lit('{"data":[{"data":{"id":"'), view, F.lit('"}}]}')).alias("contexts"),
        F.col("event_type").alias("page_url"),
        F.col("ts").alias("derived_tstamp"),
        F.col("ts").alias("collector_tstamp"),
    )


def _web(spark: SparkSession, sf: str) -> DataFrame:
    return web_events(table(spark, sf, "events"))


@query("json_flatten", f"WITH {SQL_EVENTS} SELECT session_id, page_view_id, ts FROM ev")
def json_flatten(spark: SparkSession, sf: str) -> DataFrame:
    flat = _web(spark, sf).withColumn("c", F.explode(L.json_field_array(F.col("contexts"), "struct<data: struct<id: string>>")))
    return flat.select(F.col("domain_sessionid").alias("session_id"), F.col("c.data.id").alias("page_view_id"), F.col("collector_tstamp").alias("ts"))


@query("page_views", f"WITH {SQL_EVENTS} SELECT * FROM {_sql_views()}")
def page_views(spark: SparkSession, sf: str) -> DataFrame:
    return L.page_views(_web(spark, sf))


@query("sessions", f"WITH {SQL_EVENTS} {SQL_SESSIONS.format(_sql_views())}")
def sessions(spark: SparkSession, sf: str) -> DataFrame:
    return L.sessions(L.page_views(_web(spark, sf)))


@query("lambda_filter", f"""SELECT 'view' AS mode, event_id FROM events WHERE {AFTER} UNION ALL SELECT 'first', event_id FROM events WHERE {BEFORE}
UNION ALL SELECT 'incremental', event_id FROM events WHERE {BEFORE} AND ts >= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-10')""")
def lambda_filter(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    stored = events.filter(F.col("ts") < F.lit(datetime(2024, 1, 10)).cast("timestamp_ntz"))
    out = None
    for mode in ("view", "first", "incremental"):
        part = L.lambda_filter(events, "ts", SPLIT, mode, stored).select(F.lit(mode).alias("mode"), "event_id")
        out = part if out is None else out.unionByName(part)
    return out


def _halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    events = _web(spark, sf)
    past = L.lambda_filter(events, "collector_tstamp", SPLIT, "first")
    return L.page_views(past), L.page_views(L.lambda_filter(events, "collector_tstamp", SPLIT, "view"))


@query("lambda_union", f"""WITH {SQL_EVENTS}, h AS (SELECT * FROM {_sql_views(BEFORE)}), n AS (SELECT * FROM {_sql_views(AFTER)})
SELECT *, 'historical' AS _lambda_view_source, '2024-01-20 12:00:00' AS _last_run_at FROM h WHERE page_view_id NOT IN (SELECT page_view_id FROM n)
UNION ALL SELECT *, 'new', '2024-01-20 12:00:00' FROM n""")
def q_lambda_union(spark: SparkSession, sf: str) -> DataFrame:
    past, tail = _halves(spark, sf)
    return L.lambda_union(past, tail, SPLIT, "page_view_id")


@query("lambda_union_split", f"""WITH {SQL_EVENTS}, h AS (SELECT * FROM {_sql_views()}), n AS (SELECT * FROM {_sql_views(AFTER)})
SELECT *, 'historical' AS _lambda_view_source, '2024-01-20 12:00:00' AS _last_run_at FROM h WHERE collector_tstamp < TIMESTAMP '2024-01-20 12:00:00'
UNION ALL SELECT *, 'new', '2024-01-20 12:00:00' FROM n""")
def lambda_union_split(spark: SparkSession, sf: str) -> DataFrame:
    return L.split_union(L.page_views(_web(spark, sf)), _halves(spark, sf)[1], "collector_tstamp", SPLIT)


@query("lambda_anti", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def lambda_anti(spark: SparkSession, sf: str) -> DataFrame:
    finished = table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    return not_in(table(spark, sf, "customer"), finished, "c_custkey", "o_custkey").select("c_custkey", "c_name")


# Snapshots, materialized views, masking, checks -------------------------------------------------------------------

RUN_1, RUN_2, RUN_3 = datetime(2002, 1, 1), datetime(2002, 2, 1), datetime(2002, 2, 2)
SQL_REVENUE = """rev1 AS (SELECT CAST(o_orderdate AS DATE) AS date_day, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue FROM orders GROUP BY 1),
rev2 AS (SELECT CAST(o_orderdate AS DATE) AS date_day, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY 1),
snap AS (SELECT a.date_day, a.total_revenue, TIMESTAMP '2002-01-01' AS valid_from,
  CASE WHEN b.date_day IS NOT NULL AND b.total_revenue <> a.total_revenue THEN TIMESTAMP '2002-02-01' END AS valid_to FROM rev1 a LEFT JOIN rev2 b USING (date_day)
UNION ALL SELECT b.date_day, b.total_revenue, TIMESTAMP '2002-02-01', NULL::TIMESTAMP FROM rev2 b LEFT JOIN rev1 a USING (date_day)
  WHERE a.date_day IS NULL OR a.total_revenue <> b.total_revenue)"""


def _revenue(orders: DataFrame) -> DataFrame:
    price = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    return orders.groupBy(F.to_date("o_orderdate").alias("date_day")).agg(price.alias("total_revenue"))


def _snapshot(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    state = materialize(SN.first_snapshot(_revenue(orders), "date_day", RUN_1), "snapshot")
    return SN.check_snapshot(state, _revenue(orders.filter("o_orderpriority <> '1-URGENT'")), "date_day", ["total_revenue"], RUN_2)


@query("snapshot_body", f"WITH {SQL_REVENUE} SELECT * FROM rev1")
def snapshot_body(spark: SparkSession, sf: str) -> DataFrame:
    return _revenue(table(spark, sf, "orders"))


@query("scd2_check", f"WITH {SQL_REVENUE} SELECT * FROM snap")
def scd2_check(spark: SparkSession, sf: str) -> DataFrame:
    return _snapshot(spark, sf).select("date_day", "total_revenue", "valid_from", "valid_to")


@query("test_is_null", f"WITH {SQL_REVENUE} SELECT count(valid_to) AS validation_errors FROM snap")
def test_is_null(spark: SparkSession, sf: str) -> DataFrame:
    return Q.not_null_count(_snapshot(spark, sf), "valid_to")


@query("snapshot_cleanup", f"""WITH {SQL_REVENUE} SELECT CASE WHEN valid_to IS NULL THEN 'main' ELSE 'audit' END AS kept_in, date_day, total_revenue, valid_to,
CASE WHEN valid_to IS NOT NULL THEN TIMESTAMP '2002-02-02' END AS _inserted_at FROM snap""")
def snapshot_cleanup(spark: SparkSession, sf: str) -> DataFrame:
    main, audit = SN.split_invalidated(materialize(_snapshot(spark, sf), "snapshot"), RUN_3)
    both = main.withColumn("kept_in", F.lit("main")).unionByName(audit.withColumn("kept_in", F.lit("audit")), allowMissingColumns=True)
    return both.select("kept_in", "date_day", "total_revenue", "valid_to", "_inserted_at")


@query("snapshot_cleanup_stored", f"""WITH {SQL_REVENUE} SELECT CASE WHEN valid_to IS NULL THEN 'main' ELSE 'audit' END AS kept_in, date_day, total_revenue, valid_to,
CASE WHEN valid_to IS NOT NULL THEN TIMESTAMP '2002-02-02' END AS _inserted_at FROM snap""")
def snapshot_cleanup_stored(spark: SparkSession, sf: str) -> DataFrame:
    """As one step on a stored snapshot: audit rows first, then the snapshot without them; a second run moves nothing."""
    path = fresh_path(spark, "cleanup")
    _snapshot(spark, sf).write.parquet(f"{path}/snapshot")
    SN.clean_up(spark, f"{path}/snapshot", f"{path}/audit", RUN_3)
    SN.clean_up(spark, f"{path}/snapshot", f"{path}/audit", RUN_3 + timedelta(days=1))
    main = spark.read.parquet(f"{path}/snapshot").withColumn("kept_in", F.lit("main"))
    audit = spark.read.parquet(f"{path}/audit").withColumn("kept_in", F.lit("audit"))
    return main.unionByName(audit, allowMissingColumns=True).select("kept_in", "date_day", "total_revenue", "valid_to", "_inserted_at")


def _segments(customers: DataFrame) -> DataFrame:
    return customers.groupBy("c_mktsegment").agg(F.count("*").alias("num"))


SQL_SEGMENTS = "SELECT c_mktsegment, count(*) AS num FROM customer GROUP BY 1"


@query("mv_body", SQL_SEGMENTS)
def mv_body(spark: SparkSession, sf: str) -> DataFrame:
    return _segments(table(spark, sf, "customer"))


def fresh_name(tag: str) -> str:
    return f"{tag}_{uuid.uuid4().hex}"


@query("mv_create", SQL_SEGMENTS)
def mv_create(spark: SparkSession, sf: str) -> DataFrame:
    return MaterializedView(fresh_name("mv"), lambda: _segments(table(spark, sf, "customer"))).build(spark)


def _changing(spark: SparkSession, sf: str, auto: bool) -> tuple[MaterializedView, dict]:
    """A view over a base that first has the customers in credit and later all of them."""
    state = {"base": table(spark, sf, "customer").filter("c_acctbal >= 0")}
    view = MaterializedView(fresh_name("mv"), lambda: _segments(state["base"]), auto_refresh=auto, cluster_by=["c_mktsegment"])
    view.build(spark)
    state["base"] = table(spark, sf, "customer")
    return view, state


@query("mv_refresh", SQL_SEGMENTS)
def mv_refresh(spark: SparkSession, sf: str) -> DataFrame:
    view, _ = _changing(spark, sf, auto=False)
    return view.build(spark)


@query("mv_full_refresh", SQL_SEGMENTS)
def mv_full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    view, _ = _changing(spark, sf, auto=True)
    view.build(spark)
    return view.build(spark, full_refresh=True)


@query("mask_column", "SELECT c_custkey, c_name AS shown, md5(c_name) AS hidden FROM customer")
def mask_column(spark: SparkSession, sf: str) -> DataFrame:
    name = F.col("c_name")
    return table(spark, sf, "customer").select("c_custkey", Q.mask(name, ("alice",), "alice").alias("shown"), Q.mask(name, ("alice",), "bob").alias("hidden"))


@query("masked_view", "SELECT c_custkey, md5(c_name) AS c_name, c_nationkey, c_acctbal, md5(c_mktsegment) AS c_mktsegment FROM customer")
def masked_view(spark: SparkSession, sf: str) -> DataFrame:
    return Q.masked(table(spark, sf, "customer"), ["c_name", "c_mktsegment"], ("alice",), "bob")


def _named(spark: SparkSession, df: DataFrame, name: str) -> str:
    """``df`` as a table of the catalog, under a name of its own."""
    name = f"{name}_{uuid.uuid4().hex}"
    path = fresh_path(spark, name)
    df.write.parquet(path)
    spark.sql(f"CREATE TABLE `{name}` USING parquet LOCATION '{path}'")
    return name


@query("masked_live_view", "SELECT c_custkey, md5(c_name) AS c_name, md5(c_nationkey::VARCHAR) AS c_nationkey, c_mktsegment FROM customer")
def masked_live_view(spark: SparkSession, sf: str) -> DataFrame:
    """A view of the catalog; who reads it decides what it shows."""
    source = _named(spark, table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), "customers")
    return masked_view_of(spark, f"{source}_shown", source, ["c_name", "c_nationkey"], ("alice", "o'brien"))


@query("mv_table", SQL_SEGMENTS)
def mv_table(spark: SparkSession, sf: str) -> DataFrame:
    """The result as a table of the catalog, dealt by a key and sorted, refreshed at most hourly."""
    calls = []
    rows = lambda: (calls.append(1), _segments(table(spark, sf, "customer")))[1]
    view = MaterializedView(f"mv_{uuid.uuid4().hex}", rows, kind="table", dist="c_mktsegment", sort=["num"], refresh_minutes=60)
    for minutes in (0, 30):  # the second run finds a version that is young enough
        out = view.build(spark, now=datetime(2024, 1, 1) + timedelta(minutes=minutes))
    assert len(calls) == 1
    return out


@query("unnest_stored_view", """SELECT CAST(row_number() OVER (ORDER BY o_custkey, key, price) AS BIGINT) AS id, o_custkey, key, price FROM (
  SELECT o_custkey, o_orderkey AS key, CAST(round(o_totalprice) AS BIGINT) AS price FROM orders)""")
def unnest_stored_view(spark: SparkSession, sf: str) -> DataFrame:
    """The orders of each customer folded into JSON and taken apart again, numbered, under a view name."""
    orders = table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias("key"), F.round("o_totalprice").cast("bigint").alias("price"))
    folded = json_fold(orders, ["o_custkey"], {"key": "key", "price": "price"}, "detail")
    source = _named(spark, folded, "folded")
    return unnest_view(spark, f"view_{source}", source, "detail", {"key": "bigint", "price": "bigint"})


@query("geometry_stored_view", f"""WITH {S.FIRES} SELECT CAST(row_number() OVER (ORDER BY cell, o_orderkey) AS BIGINT) AS id, {S.sql_hex('cell')} AS hex_id, o_orderkey,
{S.sql_boundary('cell')} AS boundary FROM fires""")
def geometry_stored_view(spark: SparkSession, sf: str) -> DataFrame:
    source = _named(spark, S.fires(spark, sf).select("cell", "o_orderkey"), "fires")
    view = geometry_view(spark, f"view_{source}", source)
    return view.select("id", "hex_id", "o_orderkey", S.boundary_text(F.col("geometry")).alias("boundary"))


@query("relation_equality", """WITH a AS (SELECT l_orderkey, l_linenumber FROM lineitem), b AS (SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 99 ELSE l_linenumber END AS l_linenumber FROM lineitem)
SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS only_left, (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS only_right""")
def relation_equality(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    b = a.withColumn("l_linenumber", F.when(F.col("l_returnflag") == "R", 99).otherwise(F.col("l_linenumber")))
    return Q.relation_equality(a.drop("l_returnflag"), b.drop("l_returnflag"))


# Business hours ---------------------------------------------------------------------------------------------------

SHIFT = 8036  # days; whole weeks, so that the stamps meet both sets of support hours
SQL_TICKETS = f"""tickets AS (SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate + INTERVAL {SHIFT} DAY + to_minutes(o_orderkey % 1440) AS s,
  CASE WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN NULL ELSE l_shipdate + INTERVAL {SHIFT} DAY + to_minutes((l_orderkey * 7 + l_linenumber * 131) % 1440) END AS e
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
_DAY = "date_diff('day', DATE '1970-01-01', ({})::DATE)"


def _week(x: str) -> str:
    return f"CAST(floor(({_DAY.format(x)} + 3) / 7.0) AS BIGINT)"


SQL_WEEKDAYS = f"(date_diff('day', s, e) - ({_week('e + INTERVAL 1 DAY')} - {_week('s')}) - ({_week('e')} - {_week('s')}))"
SQL_CLOSED = f"CAST(coalesce({SQL_WEEKDAYS} * 12 + (date_diff('day', s, e) - {SQL_WEEKDAYS}) * 24, 0) AS BIGINT)"
SQL_SIMPLE = f"(date_diff('minute', s, e) - {SQL_CLOSED} * 60)"
SQL_CALENDAR = """cal AS (SELECT date_hour, (CAST(date_hour AS DATE) < DATE '2021-09-14' AND dayofweek(date_hour) NOT IN (0, 6) AND hour(date_hour) BETWEEN 8 AND 19)
  OR (CAST(date_hour AS DATE) >= DATE '2021-09-14' AND dayofweek(date_hour) = 0 AND hour(date_hour) BETWEEN 19 AND 23)
  OR (CAST(date_hour AS DATE) >= DATE '2021-09-01' AND dayofweek(date_hour) BETWEEN 1 AND 4)
  OR (CAST(date_hour AS DATE) >= DATE '2021-09-01' AND dayofweek(date_hour) = 5 AND hour(date_hour) BETWEEN 0 AND 19) AS is_business_hour
  FROM (SELECT unnest(generate_series((SELECT date_trunc('day', least(min(s), min(e))) FROM tickets), (SELECT date_trunc('day', greatest(max(s), max(e))) FROM tickets) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS date_hour))"""
SQL_WORKING = """counts AS (SELECT date_hour, sum(CASE WHEN is_business_hour THEN 1 ELSE 0 END) OVER (ORDER BY date_hour) AS n FROM cal),
measured AS (SELECT t.*, CAST(coalesce(greatest(0, b.n - a.n), 0) * 60 AS BIGINT) AS working FROM tickets t LEFT JOIN counts a ON a.date_hour = date_trunc('hour', s)
  LEFT JOIN counts b ON b.date_hour = date_trunc('hour', e) - INTERVAL 1 HOUR)"""
SQL_MINUTES_2 = """CAST(coalesce(CASE WHEN date_trunc('hour', s) = date_trunc('hour', e) THEN date_diff('minute', s, e)
  ELSE working + (60 - minute(s)) + minute(e) END, 0) AS BIGINT)"""
_KEYS = "l_orderkey, l_linenumber, l_partkey, s, e"


def _tickets(spark: SparkSession, sf: str) -> DataFrame:
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    def moved(day: str, minutes: Column) -> Column:
        return (F.col(day) + F.make_dt_interval(F.lit(SHIFT), F.lit(0), minutes.cast("int"))).cast("timestamp_ntz")

    end = moved("l_shipdate", (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 131) % 1440)
    unanswered = (F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 7)
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", moved("o_orderdate", F.col("o_orderkey") % 1440).alias("s"),
        F.when(~unanswered, end).alias("e"),
    )


def _spine(spark: SparkSession, tickets: DataFrame) -> DataFrame:
    lo, hi = tickets.agg(F.least(F.min("s"), F.min("e")), F.greatest(F.max("s"), F.max("e"))).first()
    return B.date_spine(spark, lo.date(), hi.date() + timedelta(days=1))


@query("date_spine", f"WITH {SQL_TICKETS}, {SQL_CALENDAR} SELECT date_hour FROM cal")
def date_spine(spark: SparkSession, sf: str) -> DataFrame:
    return _spine(spark, _tickets(spark, sf))


@query("business_calendar", f"""WITH {SQL_TICKETS}, {SQL_CALENDAR}, b AS (SELECT *, CASE WHEN is_business_hour THEN date_hour END AS bh FROM cal)
SELECT date_hour, coalesce(bh, lead(bh IGNORE NULLS) OVER (ORDER BY date_hour)) AS business_hour, is_business_hour FROM b""")
def business_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return B.business_calendar(_spine(spark, _tickets(spark, sf)))


@query("next_business_hour", f"""WITH {SQL_TICKETS}, {SQL_CALENDAR}, b AS (SELECT *, CASE WHEN is_business_hour THEN date_hour END AS bh FROM cal),
n AS (SELECT date_hour, coalesce(bh, lead(bh IGNORE NULLS) OVER (ORDER BY date_hour)) AS next_hour FROM b)
SELECT l_orderkey, l_linenumber, s, next_hour FROM tickets JOIN n ON date_hour = date_trunc('hour', s)""")
def next_business_hour(spark: SparkSession, sf: str) -> DataFrame:
    tickets = _tickets(spark, sf)
    hours = B.business_calendar(_spine(spark, tickets)).select("date_hour", F.col("business_hour").alias("next_hour"))
    at = tickets.withColumn("date_hour", F.date_trunc("hour", "s").cast("timestamp_ntz"))
    return at.join(hours, "date_hour").select("l_orderkey", "l_linenumber", "s", "next_hour")


@query("weekdays_between", f"WITH {SQL_TICKETS} SELECT {_KEYS}, CAST({SQL_WEEKDAYS} AS BIGINT) AS weekdays FROM tickets")
def weekdays_between(spark: SparkSession, sf: str) -> DataFrame:
    return _tickets(spark, sf).withColumn("weekdays", B.weekdays_between(F.col("s"), F.col("e")).cast("bigint"))


@query("non_business_hours", f"WITH {SQL_TICKETS} SELECT {_KEYS}, {SQL_CLOSED} AS closed FROM tickets")
def non_business_hours(spark: SparkSession, sf: str) -> DataFrame:
    return _tickets(spark, sf).withColumn("closed", B.non_business_hours_between(F.col("s"), F.col("e")))


@query("business_minutes_1", f"WITH {SQL_TICKETS} SELECT {_KEYS}, {SQL_SIMPLE} AS minutes FROM tickets")
def business_minutes_1(spark: SparkSession, sf: str) -> DataFrame:
    return _tickets(spark, sf).withColumn("minutes", B.business_minutes_simple(F.col("s"), F.col("e")))


def _calendar(spark: SparkSession, tickets: DataFrame) -> DataFrame:
    return B.business_calendar(_spine(spark, tickets))


@query("working_minutes", f"WITH {SQL_TICKETS}, {SQL_CALENDAR}, {SQL_WORKING} SELECT {_KEYS}, working FROM measured")
def working_minutes(spark: SparkSession, sf: str) -> DataFrame:
    return _tickets(spark, sf).withColumn("working", B.working_minutes(F.col("s"), F.col("e")))


@query("working_minutes_by_calendar", f"WITH {SQL_TICKETS}, {SQL_CALENDAR}, {SQL_WORKING} SELECT {_KEYS}, working FROM measured")
def working_minutes_by_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """The same by joins with a calendar, for calendars of one's own."""
    tickets = _tickets(spark, sf)
    return B.with_working_minutes(tickets, _calendar(spark, tickets), "s", "e", "working")


@query("business_minutes_2", f"WITH {SQL_TICKETS}, {SQL_CALENDAR}, {SQL_WORKING} SELECT {_KEYS}, {SQL_MINUTES_2} AS minutes FROM measured")
def business_minutes_2(spark: SparkSession, sf: str) -> DataFrame:
    measured = working_minutes(spark, sf)
    minutes = B.business_minutes_by_calendar(F.col("s"), F.col("e"), F.col("working"))
    return measured.withColumn("minutes", minutes).drop("working")


@query("fct_support_tickets", f"""WITH {SQL_TICKETS}, {SQL_CALENDAR}, {SQL_WORKING} SELECT {_KEYS}, CAST({SQL_WEEKDAYS} AS BIGINT) AS weekdays_to_first_response,
{SQL_CLOSED} AS non_working_hours, {SQL_SIMPLE} AS business_minutes__1, working AS working_min_subquery, {SQL_MINUTES_2} AS business_minutes__2 FROM measured""")
def fct_support_tickets(spark: SparkSession, sf: str) -> DataFrame:
    out = B.ticket_measures(_tickets(spark, sf), "s", "e")
    return out.withColumn("weekdays_to_first_response", F.col("weekdays_to_first_response").cast("bigint"))


_LAST_SUNDAY = "(make_date(year(moment), {m}, 31) - CAST(dayofweek(make_date(year(moment), {m}, 31)) AS INTEGER))"


@query("local_time", f"""WITH e AS (SELECT event_id, ts + to_days(CAST(event_id % 366 AS INTEGER)) AS moment FROM events)
SELECT event_id, moment + CASE WHEN moment >= {_LAST_SUNDAY.format(m=3)} + INTERVAL 1 HOUR AND moment < {_LAST_SUNDAY.format(m=10)} + INTERVAL 1 HOUR THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS local FROM e""")
def local_time(spark: SparkSession, sf: str) -> DataFrame:
    """Instants over a year on the wall clock of Paris, whatever zone the session has."""
    micros = F.timestamp_diff("MICROSECOND", F.lit(datetime(1970, 1, 1)).cast("timestamp_ntz"), F.col("ts")) + F.col("event_id") % 366 * 86_400_000_000
    return table(spark, sf, "events").select("event_id", B.local_time(F.timestamp_micros(micros), "Europe/Paris").alias("local"))


# Streams ----------------------------------------------------------------------------------------------------------

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@query("mv_auto_stream", "SELECT event_type, count(*) AS num FROM events GROUP BY 1")
def mv_auto_stream(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "stream")
    events = ST.read_stream(spark, sf, EVENT_SCHEMA, "events.parquet")
    ST.auto_refresh(events.groupBy("event_type").agg(F.count("*").alias("num")), f"{path}/data", f"{path}/state").awaitTermination()
    return ST.latest(spark, f"{path}/data", ["event_type"])


@query("page_views_stream", f"WITH {SQL_EVENTS} SELECT * FROM {_sql_views()}")
def page_views_stream(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "stream")
    events = web_events(ST.read_stream(spark, sf, EVENT_SCHEMA, "events.parquet"))
    timed = events.withColumn("collector_tstamp", F.col("collector_tstamp").cast("timestamp"))
    ST.page_view_stream(timed, f"{path}/data", f"{path}/state").awaitTermination()
    return ST.page_views_so_far(spark, f"{path}/data").withColumn("collector_tstamp", F.col("collector_tstamp").cast("timestamp_ntz"))


@query("page_views_late", f"WITH {SQL_EVENTS} SELECT * FROM {_sql_views()}")
def page_views_late(spark: SparkSession, sf: str) -> DataFrame:
    """Events reach the stream in three deliveries, many of them weeks late; history is folded between them."""
    path = fresh_path(spark, "stream")
    events = table(spark, sf, "events").withColumn("_at", F.when(F.to_date("ts") < "2024-01-10", F.col("event_id") % 3).otherwise(F.lit(0)))
    for delivery in range(3):
        events.filter(F.col("_at") == delivery).drop("_at").write.mode("append").parquet(f"{path}/in")
        ST.page_view_stream(web_events(ST.read_stream(spark, f"{path}/in", EVENT_SCHEMA)), f"{path}/data", f"{path}/state").awaitTermination()
        if delivery == 1:
            ST.fold_page_views(spark, f"{path}/data")
    return ST.page_views_so_far(spark, f"{path}/data")

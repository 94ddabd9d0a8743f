"""Page views and sessions from raw events, and views that join a stored past with a live tail."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexmart.operators.lookup import json_field_array, not_in
from hexmart.session import materialize
from hexmart.sources.incremental import since_high_water


def page_views(events: DataFrame) -> DataFrame:
    """One row per session, user, page view and url; every event stands for ten seconds."""
    contexts = events.withColumn("_context", F.explode(json_field_array(F.col("contexts"), "struct<data: struct<id: string>>")))
    return contexts.groupBy(
        F.col("domain_sessionid").alias("session_id"),
        F.col("domain_userid").alias("anonymous_user_id"),
        F.col("_context.data.id").alias("page_view_id"),
        "page_url",
    ).agg(
        (F.count("*") * 10).alias("approx_time_on_page"),
        F.min("derived_tstamp").alias("page_view_start"),
        F.max("collector_tstamp").alias("collector_tstamp"),
    )


def sessions(views: DataFrame) -> DataFrame:
    return views.groupBy("session_id", "anonymous_user_id").agg(
        F.count("*").alias("page_views"),
        F.sum("approx_time_on_page").alias("total_time"),
        F.min("page_view_start").alias("session_start"),
        F.max("collector_tstamp").alias("collector_tstamp"),
    )


def lambda_filter(df: DataFrame, column: str, split: datetime, mode: str, target: DataFrame | None = None) -> DataFrame:
    """The live view takes what is at or after ``split``; the stored table what is before it, from its own newest
    stamp on if it already has rows."""
    at = F.lit(split).cast(df.schema[column].dataType)
    if mode == "view":
        return df.filter(F.col(column) >= at)
    past = df.filter(F.col(column) < at)
    if mode == "incremental":
        if target is None:
            raise ValueError("an incremental run needs its target")
        return since_high_water(past, target, column)
    if mode == "first":
        return past
    raise ValueError("mode is view, incremental or first")


def _tagged(df: DataFrame, source: str, run_at: datetime, prefix: str) -> DataFrame:
    stamp = F.lit(str(run_at))
    return df.withColumn(f"{prefix}lambda_view_source", F.lit(source)).withColumn(f"{prefix}last_run_at", stamp)


def lambda_union(
    historical: DataFrame, new: DataFrame, run_at: datetime, unique_key: str | None = None, prefix: str = "_"
) -> DataFrame:
    """Past and tail; with a key, a row of the tail takes the place of the past rows of that key.

    ``prefix`` goes before the two columns that say where a row comes from and when.
    """
    if unique_key:
        new = materialize(new, "lambda-new")
        historical = not_in(historical, new, unique_key)
    return _tagged(historical, "historical", run_at, prefix).unionByName(_tagged(new, "new", run_at, prefix))


def split_union(historical: DataFrame, current: DataFrame, column: str, run_at: datetime) -> DataFrame:
    """Past strictly before the run, tail from the run on; no key."""
    at = F.lit(run_at).cast(historical.schema[column].dataType)
    return lambda_union(historical.filter(F.col(column) < at), current.filter(F.col(column) >= at), run_at)

"""Wiki page views by subject: pages of interest and the three grains of the view counts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexmart.functions.text import language, surrogate_key
from hexmart.operators.lookup import union_relations
from hexmart.sources.incremental import day_window


def subject_by_source(unioned: DataFrame) -> DataFrame:
    """Each page with the subject of its relation: the largest English title, lower case, '-' as '_'.

    An aggregate of a row per relation joined back by broadcast, in place of a window, which would gather a relation in one task.
    """
    english = F.when(F.col("lang") == "en", F.lower(F.replace(F.col("title"), F.lit("-"), F.lit("_"))))
    subjects = unioned.groupBy(F.col("_source_relation").alias("_source")).agg(F.max(english).alias("subject"))
    found = unioned.join(F.broadcast(subjects), F.col("_source_relation").eqNullSafe(F.col("_source")), "left")  # as few rows as relations
    return found.drop("_source")


def pages_of_interest(relations: dict[str, DataFrame]) -> DataFrame:
    """All pages of some relations, each with the subject of its relation."""
    return subject_by_source(union_relations(relations))


def tagged_views(views: DataFrame, pages: DataFrame, as_of: date, days: int) -> DataFrame:
    """Views of the last ``days`` days with language and, where the page is of interest, its subject."""
    recent = views.filter(day_window("datehour", as_of, days)).withColumn("lang", language(F.col("wiki")))
    return recent.join(pages, ["title", "lang"], "left")


def _stamp(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def hourly_aggregated(tagged: DataFrame) -> DataFrame:
    grouped = tagged.groupBy(F.col("datehour").alias("date_hour"), "subject", "lang").agg(F.sum("views").alias("total_views"))
    return grouped.select(surrogate_key(_stamp("date_hour"), F.col("subject"), F.col("lang")).alias("id"), "*")


def hourly_enriched(tagged: DataFrame) -> DataFrame:
    grouped = tagged.groupBy(F.col("datehour").alias("date_hour"), "lang", "title", "subject").agg(F.sum("views").alias("views"))
    return grouped.select(surrogate_key(_stamp("date_hour"), F.col("lang"), F.col("title")).alias("id"), "*")


def daily(tagged: DataFrame) -> DataFrame:
    days = tagged.withColumn("date_day", F.to_date("datehour"))
    grouped = days.groupBy("date_day", "lang", "title", "subject").agg(F.sum("views").alias("views"))
    return grouped.select(surrogate_key(F.col("date_day"), F.col("lang"), F.col("title")).alias("id"), "*")

"""Text, key and masking functions as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def initcap_words(text: Column) -> Column:
    """Upper-case the first letter of every run of letters and digits, lower-case the rest.

    Spark's initcap starts words at blanks only.  Here each run is cut out on its own, capitalised, and put back
    between the separators that surrounded it.
    """
    words = F.regexp_extract_all(text, F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    gaps = F.split(text, r"[\p{L}\p{N}]+")
    capital = F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2)))))
    return F.array_join(
        F.flatten(F.zip_with(gaps, capital, lambda g, w: F.array(F.coalesce(g, F.lit("")), F.coalesce(w, F.lit(""))))), ""
    )


def surrogate_key(*columns: Column) -> Column:
    """md5 of the columns' text joined by '-', NULL as empty text."""
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))


def language(wiki: Column) -> Column:
    """The language part of a wiki code: before the first dot, with '-' as '_'."""
    return F.replace(F.split_part(wiki, F.lit("."), F.lit(1)), F.lit("-"), F.lit("_"))


def mask(column: Column, allowed: tuple[str, ...], user: str | None = None) -> Column:
    """The value for allowed users, its md5 for everybody else; NULL stays NULL."""
    who = F.lit(user) if user is not None else F.current_user()
    return F.when(who.isin(*allowed), column.cast("string")).otherwise(F.md5(column.cast("string")))

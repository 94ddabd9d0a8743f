"""Replace, filter and expand columns by lookups and JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexmart.session import materialize


def standardize_field(df: DataFrame, lookup: DataFrame, key: str, value: str, positions: dict[str, int]) -> DataFrame:
    """Replace each field by the lookup's ``value`` where it equals ``key``; a field without a match becomes NULL.

    ``positions`` maps a field to its place in the result, counted after the field itself was taken out.  The lookup
    holds one row per key; Spark broadcasts it as long as its measured size allows.
    """
    order = list(df.columns)
    for n, (field, place) in enumerate(positions.items()):
        side = lookup.select(F.col(key).alias(f"_k{n}"), F.col(value).alias(f"_v{n}"))
        df = df.join(side, F.col(field) == F.col(f"_k{n}"), "left").drop(field, f"_k{n}").withColumnRenamed(f"_v{n}", field)
        order.remove(field)
        order.insert(place, field)
    return df.select(*order)


def not_in(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """``df`` where key NOT IN other, by SQL's rules: a NULL in ``other`` empties the result.

    Written as a plain anti join plus two one-row subqueries, so that no side has to be broadcast.  The distinct values
    of ``other`` are stored first, so that it is computed once.
    """
    other_key = other_key or key
    values = materialize(other.select(F.col(other_key).alias(key)).distinct(), "not-in")
    kept = df.join(values.filter(F.col(key).isNotNull()), key, "left_anti")
    holds_null = values.filter(F.col(key).isNull()).exists()
    holds_any = values.exists()
    return kept.filter(~holds_null & (F.col(key).isNotNull() | ~holds_any)).select(*df.columns)


def unnest_json(df: DataFrame, field: str, subfields: dict[str, str]) -> DataFrame:
    """One row per element of a JSON array column: the other columns, then the typed sub-fields."""
    others = [c for c in df.columns if c != field]
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in subfields.items())
    return df.select(*others, F.inline(F.from_json(F.col(field), f"array<struct<{ddl}>>")))


def union_relations(relations: dict[str, DataFrame], source_column: str = "_source_relation") -> DataFrame:
    """Union by name; a column that one relation lacks is NULL there; each row says where it comes from."""
    tagged = [df.select(F.lit(name).alias(source_column), "*") for name, df in relations.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def json_field_array(column: Column, element: str) -> Column:
    """Parse ``{"data": [element, ...]}`` and return the array."""
    return F.from_json(column, f"struct<data: array<{element}>>").getField("data")

"""Materialized aggregates: create, refresh, full refresh, each as a new stored version behind a view."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from hexmart.operators.lookup import unnest_json
from hexmart.operators.rowid import dense_row_id
from hexmart.plans.indexing import geom_view
from hexmart.session import fresh_path
from hexmart.sources.sinks import cluster_by_cell


REFRESHED = "refreshed_at"


@dataclass
class MaterializedView:
    """A stored query result under a view name, or as a table of the catalog with ``kind`` "table".

    A new version is written beside the old one and the view then points to it, so readers see either version whole.
    ``auto_refresh`` leaves refreshing to the stream of :mod:`hexmart.streaming.streams`; ``refresh_minutes`` skips a refresh while the
    stored version is younger.  ``cluster_by`` sets the layout by ranges, ``dist`` deals rows by a key, ``sort`` orders them inside files.
    """

    name: str
    query: Callable[[], DataFrame]
    auto_refresh: bool = False
    cluster_by: list[str] = field(default_factory=list)
    refresh_minutes: int | None = None
    dist: str | None = None
    sort: list[str] = field(default_factory=list)
    kind: str = "view"

    def _laid_out(self, df: DataFrame) -> DataFrame:
        if self.cluster_by and self.dist:
            raise ValueError("rows are dealt by ranges (cluster_by) or by a key (dist), not both")
        if self.cluster_by:
            df = cluster_by_cell(df, *self.cluster_by)
        elif self.dist:
            df = df.hint("rebalance", self.dist)  # splits a key that holds very many rows
        return df.sortWithinPartitions(*self.sort) if self.sort else df

    def _publish(self, spark: SparkSession, at: datetime) -> DataFrame:
        df = self._laid_out(self.query())
        path = fresh_path(spark, self.name.split(".")[-1])
        df.write.parquet(path)
        found = self._found(spark)
        if found not in (None, "VIEW", "TEMPORARY") or (found and self.kind == "table"):
            spark.sql(f"DROP {'VIEW' if found in ('VIEW', 'TEMPORARY') else 'TABLE'} {self._quoted()}")
        stamp = f"TBLPROPERTIES ('{REFRESHED}' = '{at.isoformat()}')"
        if self.kind == "table":
            spark.sql(f"CREATE TABLE {self._quoted()} USING parquet {stamp} LOCATION '{path}'")
        else:
            spark.sql(f"CREATE OR REPLACE VIEW {self._quoted()} {stamp} AS SELECT * FROM parquet.`{path}`")
        return spark.table(self.name)

    def _quoted(self) -> str:
        return ".".join(f"`{part}`" for part in self.name.split("."))

    def _found(self, spark: SparkSession) -> str | None:
        return spark.catalog.getTable(self.name).tableType if spark.catalog.tableExists(self.name) else None

    def refreshed_at(self, spark: SparkSession) -> datetime | None:
        """When the stored version was made."""
        if self._found(spark) is None:
            return None
        held = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {self._quoted()}").collect()}
        return datetime.fromisoformat(held[REFRESHED]) if REFRESHED in held else None

    def build(self, spark: SparkSession, full_refresh: bool = False, now: datetime | None = None) -> DataFrame:
        """Create the view, or refresh it if it exists; what stands under this name gives way once the new version is stored."""
        mine = self.refreshed_at(spark) is not None and (self._found(spark) in ("VIEW", "TEMPORARY")) == (self.kind == "view")
        if not mine or full_refresh:
            return self._publish(spark, now or datetime.now())
        return self.refresh(spark, now)

    def refresh(self, spark: SparkSession, now: datetime | None = None) -> DataFrame:
        """Recompute, unless the view refreshes by itself or its version is younger than ``refresh_minutes``."""
        now, last = now or datetime.now(), self.refreshed_at(spark)
        young = self.refresh_minutes and last and now - last < timedelta(minutes=self.refresh_minutes)
        return spark.table(self.name) if self.auto_refresh or young else self._publish(spark, now)


def live_view(spark: SparkSession, name: str, source: str, select: str) -> DataFrame:
    """A view that is worked out when it is read: ``SELECT select FROM source``."""
    quoted = ".".join(f"`{part}`" for part in name.split("."))
    spark.sql(f"CREATE OR REPLACE VIEW {quoted} AS SELECT {select} FROM {source}")
    return spark.table(name)


def masked_view(spark: SparkSession, name: str, source: str, columns: list[str], allowed: tuple[str, ...]) -> DataFrame:
    """A view of a table that shows some columns to allowed users only, and to others their md5; the reader's name decides."""
    users = ", ".join("'" + user.replace("\\", "\\\\").replace("'", "\\'") + "'" for user in allowed) or "''"
    shown = [f"CASE WHEN current_user() IN ({users}) THEN CAST(`{c}` AS STRING) ELSE md5(CAST(`{c}` AS STRING)) END AS `{c}`" if c in columns else f"`{c}`" for c in spark.table(source).columns]
    return live_view(spark, name, source, ", ".join(shown))


def unnest_view(spark: SparkSession, name: str, source: str, json: str, subfields: dict[str, str]) -> DataFrame:
    """A stored view of a table with a JSON array: a numbered row per element, the other columns, then the typed sub-fields."""

    def rows() -> DataFrame:
        flat = unnest_json(spark.table(source), json, subfields)
        return dense_row_id(flat, flat.columns, "id")

    return MaterializedView(name, rows).build(spark, full_refresh=True)


def geometry_view(spark: SparkSession, name: str, source: str, cell: str = "cell") -> DataFrame:
    """A stored view of a table of cells with a dense id and the boundary of each cell."""
    return MaterializedView(name, lambda: geom_view(spark.table(source), cell)).build(spark, full_refresh=True)

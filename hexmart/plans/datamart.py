"""Data marts: an indicator table of cells, the context around it, and dimensions, at one resolution."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexmart.functions import cells as C
from hexmart.functions import grid as G
from hexmart.functions.text import initcap_words
from hexmart.operators import aggregates as A
from hexmart.operators.hierjoin import children_among, link_cells
from hexmart.operators.quality import key_and_srid
from hexmart.operators.rowid import dense_row_id
from hexmart.operators.skew import CellProfile, cell_profile, heavy_keys, heavy_keys_of, key_counts, weighted_join
from hexmart.plans.spec import Attr
from hexmart.session import WIDE, materialize, ways
from hexmart.sources.sinks import SRID, cluster_by_cell

# A cell where more facts and context rows pair up than this, or than this share of all pairs, is spread over several tasks.
PAIRS_PER_TASK = 10_000_000
MOST_SPLIT = 1_000
# Such a cell's facts meet so many of its context rows at a time, a multiple of eight, so that packed columns of a file repeat byte by byte.
ROWS_MET = 1_000


@dataclass
class Table:
    """One input: ``status`` is indicator, context or dimension; ``cell`` names its long cell-id column."""

    name: str
    df: DataFrame
    status: str
    attributes: list[Attr | str] = field(default_factory=list)
    cell: str = "cell"

    def attrs(self) -> list[Attr]:
        return [Attr.of(a) for a in self.attributes]


@dataclass
class JsonField:
    """A JSON array column: ``fields`` maps names inside the objects to attribute aliases."""

    name: str
    fields: dict[str, str]


@dataclass
class MartSpec:
    tables: list[Table]
    res: int
    json: list[JsonField] = field(default_factory=list)
    dates: DataFrame | None = None
    date_key: str = "date_id"
    geometry: Callable[[Column], Column] = G.boundary
    max_json_items: int | None = None
    set_index: bool = False
    set_esri: bool = False

    def one(self, status: str) -> Table:
        return next(t for t in self.tables if t.status == status)

    def all(self, status: str) -> list[Table]:
        return [t for t in self.tables if t.status == status]


def resolution_range(df: DataFrame, cell: str = "cell") -> tuple[int, int]:
    """Coarsest and finest resolution of a table: one small aggregate."""
    lo, hi = df.agg(F.min(C.resolution(cell)), F.max(C.resolution(cell))).first()
    if lo is None:
        raise ValueError("the table has no cells")
    return lo, hi


def with_dates(df: DataFrame, attrs: list[Attr], dates: DataFrame, date_key: str, how: str = "left") -> DataFrame:
    """Attach one date attribute per ``date`` function: (foreign key, date column) -> alias."""
    for n, attr in enumerate(a for a in attrs if a.fn == "date"):
        foreign, wanted = attr.args
        side = dates.select(F.col(date_key).alias(f"_d{n}"), F.col(wanted).alias(attr.alias))
        df = df.join(side, F.col(foreign) == F.col(f"_d{n}"), how).drop(f"_d{n}")
    return df


def _is_geometry(attr: Attr) -> bool:
    return attr.fn is not None and attr.fn.startswith("geom")


def _check(table: Table) -> None:
    for attr in table.attrs():
        if table.status == "dimension":
            if attr.fn is not None and attr.fn != "date" and not _is_geometry(attr):
                raise ValueError(f"{table.name}: a dimension takes columns, dates and geometry, not {attr.fn}")
            if attr.group:
                raise ValueError(f"{table.name}: dimension attributes are not grouped by")
        elif not (attr.group or attr.aggregate):
            raise ValueError(f"{table.name}.{attr.alias}: group by it (!) or aggregate it")


def _reduced(table: Table, dates: DataFrame | None, date_key: str, prefix: str) -> DataFrame:
    """One row per cell and group: attributes of one table aggregated before any join sees them.

    Sums and minima are carried as partial values, distinct arguments as group columns, and ``<prefix>n`` counts the
    rows behind each, so that the joins multiply counts instead of rows.
    """
    attrs = [a for a in table.attrs() if not _is_geometry(a)]
    if any(a.fn == "date" for a in attrs) and dates is None:
        raise ValueError("date attributes need a date dimension")
    df = with_dates(table.df, attrs, dates, date_key)
    keys: dict[str, Column] = {f"{prefix}cell": F.col(table.cell)}
    partial = [F.count("*").alias(f"{prefix}n")]
    for a in attrs:
        name = f"{prefix}{a.alias}"
        if a.fn == "date":
            keys[name] = F.col(a.alias)
        elif a.fn is None:
            keys[name] = F.col(a.column)
        elif a.fn == "area":
            keys[name] = C.cell_area(table.cell)
        elif a.fn in ("array", "array_length"):
            keys[name] = F.col(a.args[0])
        elif a.fn == "sum":
            partial.append(F.sum(a.args[0]).alias(name))
        elif a.fn == "min":
            partial.append(F.min(a.args[0]).alias(name))
        elif a.fn == "min_init_cap":
            partial.append(F.min(initcap_words(F.col(a.args[0]))).alias(name))
    return df.select("*", *[c.alias(f"_g_{n}") for n, c in keys.items()]).groupBy(
        *[F.col(f"_g_{n}").alias(n) for n in keys]
    ).agg(*partial)


def context_join(
    facts: DataFrame,
    links: DataFrame,
    around: DataFrame,
    cell: str,
    around_cell: str,
    profile: CellProfile,
    around_profile: CellProfile | None = None,
    merged: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """facts LEFT JOIN links LEFT JOIN around: rows without context are kept.  ``links`` come from :func:`link_cells`.

    Both sides meet at one cell.  A fact goes to the one target at or above it, or else stays at its own cell; a context row stays at its
    own cell and is copied to the sources above it that have no such target, at most one per level.  No source is a target there, so the
    two kinds never mix.  What is shuffled follows the rows of both sides; only the last join makes their pairs.  A cell of very many
    pairs is split on both sides: blocks of a few context rows come again for one fact after another, which task and file hold with little
    room.  ``merged`` reduces what stands around each cell ``src`` before the facts meet it.
    """
    if around_profile is None:
        around_profile = cell_profile(around, around_cell)
    above = C.resolution("tar") <= C.resolution("src")
    up, down = links.filter(above), links.filter(~above)
    held = None if around_profile.heavy is None else around_profile.heavy.withColumnRenamed("cell", "tar")
    around = around.withColumn("tar", F.col(around_cell))
    below = weighted_join(down, around, "tar", left_heavy=heavy_keys_of(down, "tar"), right_heavy=held).drop("tar")
    nearby = below.unionByName(around.withColumnRenamed("tar", "src"))
    nearby = materialize(nearby if merged is None else merged(nearby), "context").withColumnRenamed("src", "_met")

    met = F.coalesce("tar", cell)
    heavy = None if profile.heavy is None else profile.heavy.withColumnRenamed("cell", cell)
    placed = weighted_join(facts, up.withColumnRenamed("src", cell), cell, "left", heavy).withColumn("_met", met).drop("tar")
    rows = profile.cells.withColumnRenamed("cell", cell).join(up.withColumnRenamed("src", cell), cell, "left")
    rows = rows.groupBy(met.alias("_met")).agg(F.sum("_n").alias("_n"))
    pairs = rows.join(key_counts(nearby, "_met").withColumnRenamed("_n", "_around"), "_met").select("_met", "_around", (F.col("_n") * F.col("_around")).alias("_n"))
    pairs = materialize(pairs, "pairs-met")
    held = heavy_keys(pairs, "_met", PAIRS_PER_TASK, MOST_SPLIT)
    if held is None:
        return weighted_join(placed, nearby, "_met", "left").drop("_met")
    # All facts of a heavy cell have context, so both sides can be split there, and every block of context meets every share of the facts.
    blocks = F.ceil(F.col("_around") / ROWS_MET)
    held = materialize(held.join(pairs, "_met").select("_met", "_n", blocks.cast("int").alias("_blocks"), F.ceil(F.col("_ways") / blocks).cast("int").alias("_shares")), "pairs-heavy")
    known, made = F.broadcast(held.drop("_n")), held.agg(F.sum("_n")).first()[0]  # fewer than MOST_SPLIT rows
    tasks, keys = max(ways(held.sparkSession), -(-made // PAIRS_PER_TASK)), ["_met", "_block", "_share"]

    def copied(side: DataFrame, own: Column, name: str, number: str, other: str) -> DataFrame:
        side = side.join(known, "_met").withColumn(name, own).withColumn(number, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return side.drop("_blocks", "_shares").repartition(tasks, *keys)

    share = F.pmod(F.xxhash64(*placed.columns), F.col("_shares")).cast("int")
    block = F.floor((F.row_number().over(Window.partitionBy("_met").orderBy(F.xxhash64(*nearby.columns))) - 1) / ROWS_MET).cast("int")
    met = copied(placed, share, "_share", "_block", "_blocks").join(copied(nearby, block, "_block", "_share", "_shares"), keys).drop(*keys)
    light = (side.join(known, "_met", "left_anti") for side in (placed, nearby))
    return weighted_join(*light, "_met", "left").drop("_met").unionByName(met)


def _merged(table: Table, around: DataFrame, prefix: str) -> Callable[[DataFrame], DataFrame]:
    """Context around a cell with one row per group and level: only its counts, partial values and area (that of its level) are asked
    for later, so a coarse cell meets as many rows as it has groups below it, not as many as it has cells."""
    partial = {f"{prefix}{a.alias}": F.min if a.fn in ("min", "min_init_cap") else F.sum for a in table.attrs() if a.fn in ("sum", "min", "min_init_cap")}
    partial |= {f"{prefix}n": F.sum, f"{prefix}cell": F.min}
    kinds = {f.name: f.dataType for f in around.schema}
    keys = [c for c in around.columns if c not in partial]

    def merge(nearby: DataFrame) -> DataFrame:
        grouped = nearby.groupBy("src", *keys, C.resolution(f"{prefix}cell").alias("_level"))
        return grouped.agg(*[f(name).cast(kinds[name]).alias(name) for name, f in partial.items()]).drop("_level")

    return merge


@dataclass
class _Facts:
    """Facts before they come to one level: ``rows`` with a cell ``_at`` at ``res`` or coarser (``lo`` is the coarsest), the group columns, and
    what becomes of the other columns where rows meet."""

    rows: DataFrame
    groups: list[str]
    final: list[Column]
    lo: int
    res: int

    def _apart(self) -> tuple[DataFrame, DataFrame]:
        """The rows grouped, in two tables: by ``_at``, where the rows of the same groups below one coarsest cell are all of one level and so share
        no cell, and by ``_cell`` at ``res``, where they are of several and only meet there.  The first need no grouping once expanded."""
        level, groups = C.resolution("_at"), ["_top", *self.groups]
        dealt = self.rows.withColumn("_top", C.parent("_at", self.lo))
        dealt = dealt.repartition(ways(self.rows.sparkSession), *groups)
        below = Window.partitionBy(*groups)
        dealt = dealt.select("*", F.min(level).over(below).alias("_coarsest"), F.max(level).over(below).alias("_finest"))
        alone, several = F.col("_coarsest") == F.col("_finest"), F.col("_coarsest") < F.col("_finest")
        placed = C.normalize(dealt.filter(several), "_at", self.res, "_cell", self.lo, self.res)

        def grouped(rows: DataFrame, cell: str) -> DataFrame:
            if not self.final:
                return rows.select(cell, *groups).distinct().drop("_top")
            return rows.groupBy(cell, *groups).agg(*self.final).drop("_top")

        return grouped(dealt.filter(alone), "_at"), grouped(placed, "_cell")

    def placed(self) -> DataFrame:
        """Grouped by ``_cell`` at ``res`` and group columns."""
        if self.lo >= self.res:
            rows = self.rows.withColumnRenamed("_at", "_cell")
            return rows.groupBy("_cell", *self.groups).agg(*self.final) if self.final else rows.select("_cell", *self.groups).distinct()
        alone, met = self._apart()
        return C.normalize(alone, "_at", self.res, "_cell", self.lo, self.res).select(*met.columns).unionByName(met)

    def dealt(self, together: list[str], among: list[DataFrame]) -> tuple[DataFrame, A.Zones | None]:
        """:meth:`placed` with rows of one ``_zone``, the parent of a cell, and ``together`` in one task.  Rows that the last level would expand
        stay one row that stands for all cells of its zone, as the zones say; without zones the rows have a ``_cell``.  ``rows`` must be stored.
        Cells that one of the tables ``among`` (cells at ``res``, as ``cell``) lacks may be left out."""
        spark, above, zones = self.rows.sparkSession, self.res - 1, None
        if self.lo >= self.res:
            zoned, zone = self.placed(), "_cell"
            expanded = self.rows.count()
        else:
            alone, met = self._apart()
            zones = A.Zones(zone := "_zone", "_at", self.res, "_cell")
            zoned = C.normalize(alone.unionByName(met.withColumnRenamed("_cell", "_at")), "_at", above, zone, self.lo, self.res)
            zoned = zoned.withColumn("_at", F.when(C.resolution("_at") >= self.res, F.col("_at")).otherwise(F.col(zone)))
            levels = self.rows.groupBy(C.resolution("_at").alias("level")).count().collect()
            expanded = sum(n * 7 ** (self.res - level) for level, n in levels if level is not None)
        for cells in among:
            held = cells.select((F.col("cell") if zones is None else C.parent("cell", above)).alias(zone)).distinct()
            zoned = zoned.join(held, zone, "left_semi")
        return zoned.repartition(ways(spark, expanded), zone, *together), zones

    def cells(self, *groups: str) -> DataFrame:
        """The distinct cells of :meth:`placed`, as ``cell``, and ``groups`` among the group columns."""
        return C.normalize(self.rows.select("_at", *groups).distinct(), "_at", self.res, "cell", self.lo, self.res).select("cell", *groups).distinct()


def build_facts(spec: MartSpec) -> tuple[DataFrame, list[str]]:
    """The grouped fact table (cell at ``spec.res``, group columns, aggregates) and its group columns."""
    facts = _facts(spec)
    return facts.placed(), facts.groups


def fold_facts(spec: MartSpec) -> DataFrame:
    """The facts with the first JSON array of the spec: ``_cell``, the group columns outside the array, and the array."""
    return _folded(_stored(_facts(spec)), spec)


def _stored(facts: _Facts) -> _Facts:
    return replace(facts, rows=materialize(facts.rows, "mart-facts"))


def _folded(facts: _Facts, spec: MartSpec, among: list[DataFrame] = []) -> DataFrame:
    """Facts are dealt out by the keys of the fold, so that nothing expanded is shuffled or stored."""
    inside = list(spec.json[0].fields.values())
    keys = [g for g in facts.groups if g not in inside]
    dealt, zones = facts.dealt(keys, among)
    return A.json_fold(dealt, ["_cell" if zones is None else zones.zone, *keys], spec.json[0].fields, spec.json[0].name, zones=zones)


def _facts(spec: MartSpec) -> _Facts:
    indicator, contexts = spec.one("indicator"), spec.all("context")
    for table in spec.tables:
        _check(table)
    facts = _reduced(indicator, spec.dates, spec.date_key, "i_")
    profile = cell_profile(indicator.df, indicator.cell)
    for n, context in enumerate(contexts):
        prefix = f"c{n}_"
        around = _reduced(context, spec.dates, spec.date_key, prefix)
        around_profile = cell_profile(context.df, context.cell)
        links = link_cells(profile.cells, around_profile.cells, around_profile.lo, around_profile.hi, profile.lo, profile.hi)
        facts = context_join(facts, materialize(links, "pairs"), around, "i_cell", f"{prefix}cell", profile, around_profile, _merged(context, around, prefix))

    # Rows behind a joined row: the product of the counts; an absent context counts once.
    counts = {"i_": F.col("i_n"), **{f"c{n}_": F.coalesce(f"c{n}_n", F.lit(1)) for n in range(len(contexts))}}

    def behind(skip: str | None = None) -> Column:
        return reduce(Column.__mul__, [c for p, c in counts.items() if p != skip], F.lit(1))

    def area_behind(area: Column) -> Column:
        return F.sum(area * behind())

    # Everything is reduced per indicator cell, or its ancestor at the wanted resolution, first and only then moved there, so that a
    # coarse cell is expanded once per group and not once per joined row.
    rolled = F.when(C.resolution("i_cell") > spec.res, C.parent("i_cell", spec.res)).otherwise(F.col("i_cell"))
    facts = facts.withColumn("_at", rolled)
    keys, first, final = [], [], []
    all_cells = ["i_cell", *[f"c{n}_cell" for n in range(len(contexts))]]
    for prefix, table in [("i_", indicator), *[(f"c{n}_", t) for n, t in enumerate(contexts)]]:
        for a in table.attrs():
            name = f"{prefix}{a.alias}"
            if _is_geometry(a):
                continue
            if a.group or a.fn in ("array", "array_length"):
                keys.append(F.col(name).alias(a.alias))
                if a.fn == "array":
                    final.append(A.array_distinct(a.alias).alias(a.alias))
                elif a.fn == "array_length":
                    final.append(A.array_length(a.alias).alias(a.alias))
            elif a.fn == "sum":
                first.append(F.sum(F.col(name) * behind(prefix)).alias(a.alias))
                final.append(F.sum(a.alias).alias(a.alias))
            elif a.fn in ("min", "min_init_cap"):
                first.append(F.min(name).alias(a.alias))
                final.append(F.min(a.alias).alias(a.alias))
            else:
                area = C.cell_area(f"{prefix}cell") if a.fn == "sum_area" else A.nested_area(all_cells)
                first.append(area_behind(area).alias(a.alias))
                final.append(A.area_sum(F.col(a.alias)).alias(a.alias))
    per_cell = facts.groupBy("_at", *keys)
    per_cell = per_cell.agg(*first) if first else facts.select("_at", *keys).distinct()
    groups = [a.alias for t in [indicator, *contexts] for a in t.attrs() if a.group and not _is_geometry(a)]
    return _Facts(per_cell, groups, final, min(profile.lo, spec.res), spec.res)


def _dimensions(spec: MartSpec, facts: _Facts) -> tuple[list[tuple[DataFrame, str]], list[str]]:
    """Dimensions at the mart's cells, each stored, with the name of its cell column; and the names of their attributes."""
    sides, dimension_columns = [], []
    dimensions = [(t, *resolution_range(t.df, t.cell)) for t in spec.all("dimension")]
    cells = facts.cells() if dimensions else None
    for n, (table, lo, hi) in enumerate(dimensions):
        side = with_dates(table.df, table.attrs(), spec.dates, spec.date_key, "inner")
        wanted = [F.col(a.column or a.alias).alias(a.alias) for a in table.attrs() if not _is_geometry(a)]
        dimension_columns += [a.alias for a in table.attrs() if not _is_geometry(a)]
        # Cells of the mart meet the coarse cells above them; a dimension is never expanded to all it covers.
        placed = f"_dim{n}"
        fine = side.filter(C.resolution(table.cell) >= spec.res).withColumn(placed, C.parent(table.cell, spec.res))
        parts = [fine.select(placed, *wanted)] if hi >= spec.res else []
        if lo < spec.res:
            coarse = side.filter(C.resolution(table.cell) < spec.res)
            parts.append(children_among(coarse, cells, table.cell, spec.res, lo, min(hi, spec.res - 1), placed).select(placed, *wanted))
        # Stored, so that Spark knows its size and spares the mart a shuffle where the dimension is small.
        sides.append((materialize(reduce(DataFrame.unionByName, parts), "dimension"), placed))
    return sides, dimension_columns


def _numbers(facts: _Facts, keys: list[str], sides: list[tuple[DataFrame, str]], dimension_columns: list[str], order: list[str]) -> DataFrame:
    """``id_esri`` for the rows of a folded mart, ``_cell`` and ``keys`` with the dimensions but without the array.  Cell and keys decide the array,
    so the order is that of the whole rows, and nothing as long as an array is dealt out, sorted or stored for it."""
    rows = facts.cells(*keys).withColumnRenamed("cell", "_cell")
    for side, placed in sides:
        rows = rows.join(side, F.col("_cell") == F.col(placed)).drop(placed)
    rows = rows.select("_cell", C.to_hex("_cell").alias("hex_id"), *keys, *dimension_columns)
    order = [c for c in order if c in rows.columns]
    numbered = dense_row_id(rows, [*order, *[c for c in rows.columns if c not in (*order, "_cell")]], "id_esri")
    return materialize(numbered.drop("hex_id"), "numbers")  # stored, so that Spark knows its size


def build_datamart(spec: MartSpec) -> DataFrame:
    """The mart: ``hex_id``, group columns, geometry, aggregates or JSON arrays, then dimension attributes.

    With ``max_json_items`` large groups come as several rows, which ``json_part`` numbers.
    """
    reduced = _facts(spec)
    groups = reduced.groups
    folds = spec.json and spec.all("context")
    if folds or spec.all("dimension"):
        reduced = _stored(reduced)
    sides, dimension_columns = _dimensions(spec, reduced)
    order = [a.alias for t in spec.tables for a in t.attrs() if a.order]
    numbers = None
    if folds and len(spec.json) == 1 and spec.max_json_items is None:
        mart = _folded(reduced, spec, [side.select(F.col(placed).alias("cell")) for side, placed in sides])
        if spec.set_esri and "geometry" not in order:
            numbers = _numbers(reduced, [c for c in mart.columns if c not in ("_cell", spec.json[0].name)], sides, dimension_columns, order)
    elif folds:
        facts = materialize(reduced.placed(), "mart-facts")
        folded = {alias for j in spec.json for alias in j.fields.values()}
        keys = ["_cell", *[g for g in groups if g not in folded]]
        marts = [A.json_fold(facts, keys, j.fields, j.name, spec.max_json_items, "json_part") for j in spec.json]
        if spec.max_json_items is not None:
            keys = [*keys, "json_part"]
        mart = marts[0]
        for j, more in zip(spec.json[1:], marts[1:]):
            right = more.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)], j.name)
            same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(keys)])
            both = [F.coalesce(k, f"_r{i}").alias(k) for i, k in enumerate(keys)]
            mart = mart.join(right, same, "full").select(*both, *[c for c in mart.columns if c not in keys], j.name)
    else:
        mart = reduced.placed()
    if numbers is not None:
        same = [mart[k].eqNullSafe(numbers[k]) for k in numbers.columns if k in mart.columns]
        mart = mart.join(numbers, reduce(Column.__and__, same)).select(*[mart[c] for c in mart.columns], *dimension_columns, "id_esri")
    else:
        for side, placed in sides:
            mart = mart.join(side, F.col("_cell") == F.col(placed)).drop(placed)

    # The cell decides the geometry, so it is drawn once per result row and never grouped by or shuffled.
    drawn = any(_is_geometry(a) for t in spec.tables for a in t.attrs())
    body = [c for c in mart.columns if c not in ("_cell", "id_esri") and c not in dimension_columns]
    out = mart.select(
        *(["id_esri"] if numbers is not None else []),
        C.to_hex("_cell").alias("hex_id"),
        *body,
        *([spec.geometry(F.col("_cell")).alias("geometry")] if drawn else []),
        *dimension_columns,
    )
    order = [c for c in order if c in out.columns]
    if spec.set_esri and numbers is None:
        plain = [c for c in out.columns if c not in (*order, "geometry")]
        out = dense_row_id(out, [*order, *plain], "id_esri")
    return out.orderBy(*[F.col(c).asc_nulls_last() for c in order]) if order else out


def write_datamart(spec: MartSpec, path: str) -> DataFrame:
    """Store the mart and return it as stored.

    ``set_index`` lays it out by ``hex_id``, so that look-ups by cell skip files; ``set_esri`` numbers the rows (``id_esri``), stores the SRID
    beside the geometry, and refuses a table whose numbers or SRID a map server would refuse.  Attributes marked ``?`` order the
    rows inside the files if there is no index.
    """
    mart = build_datamart(spec)
    if spec.set_esri:
        mart = mart.withColumn("srid", F.lit(SRID))
    if spec.set_index:
        mart = cluster_by_cell(mart, "hex_id")
    mart.write.options(**WIDE).parquet(path)
    stored = mart.sparkSession.read.schema(mart.schema).parquet(path)
    if spec.set_esri:
        bad = key_and_srid(stored, "id_esri", "srid", SRID).first()
        if any(bad):
            raise ValueError(f"the mart breaks its constraints: {bad.asDict()}")
    return stored

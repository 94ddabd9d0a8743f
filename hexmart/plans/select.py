"""Generic join, projection, grouping and order from a spec."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexmart.functions import cells as C
from hexmart.functions import grid as G
from hexmart.functions.text import initcap_words
from hexmart.operators import aggregates as A
from hexmart.operators.hierjoin import children_among
from hexmart.operators.rowid import dense_row_id
from hexmart.plans.spec import Attr


@dataclass(frozen=True)
class Join:
    """``left.left_key = right.right_key``; a leading ``!`` on the left key keeps all left rows, on the right key all
    right rows, else the join is inner.  The sides keep that meaning when the right table already stands in FROM."""

    left: str
    left_key: str
    right: str
    right_key: str

    @property
    def how(self) -> str:
        if self.left_key.startswith("!"):
            return "left"
        return "right" if self.right_key.startswith("!") else "inner"

    def condition(self) -> Column:
        return F.col(f"{self.left}.{self.left_key.lstrip('!')}") == F.col(f"{self.right}.{self.right_key.lstrip('!')}")


@dataclass(frozen=True)
class Children:
    """The lateral join with the cells of level ``res`` below the cell of each row of ``table`` (its column ``cell``).

    A row finer than ``res`` has none: ``keep`` keeps it with NULL, else it goes.  With ``among``, the name of a table
    whose column ``cell`` holds cells of level ``res``, only children that occur there are made, by an equi join on the cells'
    ancestors; so a very coarse cell costs as many rows as it has children in that table, not all it has.
    """

    table: str
    res: int
    keep: bool = True
    among: str | None = None


def _child(table: str) -> str:
    return f"_children_{table}"


def _with_children(df: DataFrame, name: str, join: Children, tables: dict[str, DataFrame]) -> DataFrame:
    """``df`` with a column of children, no row of which ever holds more than a few hundred of them."""
    out = _child(name)
    if join.among is None:
        below = C.explode_children(df, "cell", join.res, out)
    else:
        lo, hi = df.agg(F.min(C.resolution("cell")), F.max(C.resolution("cell"))).first()
        wanted = tables[join.among].select("cell").distinct()
        below = children_among(df, wanted, "cell", join.res, lo, hi, out) if lo is not None else df.withColumn(out, F.lit(None).cast("long"))
    if not join.keep:
        return below
    # Rows without children: cells finer than the level, or NULL; with ``among``, also those that have none there.
    if join.among is None:
        none = df.filter(F.col("cell").isNull() | (C.resolution("cell") > join.res))
    else:
        none = df.join(below.select(F.col("cell").alias("_has")).distinct(), F.col("cell") == F.col("_has"), "left_anti")
    return below.unionByName(none.withColumn(out, F.lit(None).cast("long")))


def _expression(table: str, attr: Attr) -> Column:
    def arg(i: int) -> Column:
        return F.col(f"{table}.{attr.args[i]}")

    def at(r: int) -> Column:
        """The row's cell at level ``r``: its ancestor, or the child the lateral join put beside it."""
        cell = F.col(f"{table}.cell")
        return F.when(C.resolution(cell) >= r, C.parent(cell, r)).otherwise(F.col(f"{table}.{_child(table)}"))

    if attr.fn is None:
        return F.col(f"{table}.{attr.column}")
    if attr.fn == "area":
        return C.cell_area(arg(0))
    if attr.fn == "sum_area":
        return A.area_sum(C.cell_area(arg(0)))
    if attr.fn == "sum_area_adaptatif":
        return A.sum_area_adaptive(list(attr.args))
    if attr.fn == "sum":
        return F.sum(arg(0))
    if attr.fn == "min":
        return F.min(arg(0))
    if attr.fn == "min_init_cap":
        return F.min(initcap_words(arg(0)))
    if attr.fn == "array":
        return A.array_distinct(f"{table}.{attr.args[0]}")
    if attr.fn == "array_length":
        return A.array_length(f"{table}.{attr.args[0]}")
    if attr.fn == "hex_id_parent":
        return C.to_hex(C.parent(F.col(f"{table}.cell"), int(attr.args[0])))
    if attr.fn == "geom_parent":
        return G.boundary(C.parent(arg(0), int(attr.args[1])))
    if attr.fn == "geom_children":
        return G.boundary(F.col(f"{table}.{_child(table)}"))
    if attr.fn == "hex_id_children":
        return C.to_hex(F.col(f"{table}.{_child(table)}"))
    if attr.fn == "hex_id":
        return C.to_hex(at(int(attr.args[0])))
    if attr.fn == "geom":
        return G.boundary(at(int(attr.args[1])))
    raise ValueError(f"{attr.fn} is no function of a select: join the table of dates and name its column")


def build_select(tables: dict[str, DataFrame], attributes: dict[str, list[Attr | str]], joins: list[Join | Children] | None = None) -> DataFrame:
    """Join ``tables``, project ``attributes``, group by those marked ``!`` and order by those marked ``?``.

    An attribute ``id_esri+`` adds a dense row number to the result.  Attributes of children (``hex_id_children``, ``geom_children``, and
    ``hex_id`` and ``geom`` for rows coarser than their level) need a :class:`Children` join of their table; it acts on the
    table before the other joins, which changes no result, as a child belongs to its row.
    """
    joins = joins or []
    for join in joins:
        if isinstance(join, Children):
            tables = {**tables, join.table: _with_children(tables[join.table], join.table, join, tables)}
    joins = [join for join in joins if isinstance(join, Join)]
    if joins:
        out, seen = tables[joins[0].left].alias(joins[0].left), {joins[0].left}
    else:
        only = next(iter(tables))
        out, seen = tables[only].alias(only), {only}
    for join in joins:
        # As in FROM a JOIN b: the newcomer stands on the right, whichever side names it.
        new = join.right if join.left in seen else join.left
        if new in seen:
            out = out.filter(join.condition())
            continue
        out = out.join(tables[new].alias(new), join.condition(), join.how)
        seen.add(new)

    wanted = [(name, Attr.of(a)) for name, attrs in attributes.items() for a in attrs]
    numbered = any(a.fn == "id_esri" for _, a in wanted)
    wanted = [(name, a) for name, a in wanted if a.fn != "id_esri"]
    groups = [_expression(name, a).alias(a.alias) for name, a in wanted if a.group]
    measures = [_expression(name, a).alias(a.alias) for name, a in wanted if a.aggregate]
    if groups or measures:
        loose = [a.alias for _, a in wanted if not (a.group or a.aggregate)]
        if loose:
            raise ValueError(f"neither grouped nor aggregated: {loose}")
        out = out.groupBy(*groups).agg(*measures) if measures else out.select(*groups).distinct()
        out = out.select(*[a.alias for _, a in wanted])
    else:
        out = out.select(*[_expression(name, a).alias(a.alias) for name, a in wanted])

    order = [a.alias for _, a in wanted if a.order]
    if numbered:
        rest = [a.alias for _, a in wanted if a.alias not in order]
        out = dense_row_id(out, [*order, *rest], "id_esri")
    return out.orderBy(*[F.col(c).asc_nulls_last() for c in order]) if order else out


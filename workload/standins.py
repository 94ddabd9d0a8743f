"""Cell tables derived from the given tables, in Spark and in SQL.

Keys become cells by the same bit arithmetic on both sides, so ids collide along ancestry as real ones do.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexmart.functions import cells as C
from hexmart.functions import grid as G
from workload.registry import table

BASE = 20  # a base cell that is no pentagon


def synthetic_cell(k: Column, r: Column) -> Column:
    """Digit i of the cell is (k div 7^(i-1)) mod 7 down to resolution ``r``.

    The digits of k to base 7, last one first, cut at ``r``, filled up with 7 and read to base 8.
    """
    digits = F.reverse(F.lpad(F.conv(F.coalesce(k, F.lit(0)).cast("string"), 10, 7), 15, "0"))
    body = F.conv(F.rpad(F.substr(digits, F.lit(1), r), F.lit(15), F.lit("7")), 8, 10).cast("bigint")
    head = F.lit(1 << 59).bitwiseOR(F.shiftleft(r.cast("bigint"), 52)).bitwiseOR(F.lit(BASE << 45))
    return F.coalesce(head.bitwiseOR(body), F.lit(0))


def fires(spark: SparkSession, sf: str) -> DataFrame:
    """Indicator: one row per order; resolutions 2..8."""
    o = table(spark, sf, "orders")
    return o.select(
        synthetic_cell(F.col("o_orderkey"), (F.col("o_orderkey") % 7 + 2).cast("int")).alias("cell"),
        F.col("o_custkey").alias("objectid"),
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("begdate"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        "o_orderkey",
    )


def land_cover(spark: SparkSession, sf: str) -> DataFrame:
    """Context: one row per customer; resolutions 3..6, on the part of the grid whose first digit is 0, 1 or 2."""
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select(
        synthetic_cell(k * 7 + k % 3, (F.call_function("div", k, F.lit(3).cast("long")) % 4 + 3).cast("int")).alias("cell"),
        F.col("c_mktsegment").alias("l_class"),
        "c_custkey",
    )


def communes(spark: SparkSession, sf: str) -> DataFrame:
    """Dimension: one resolution-2 cell per nation."""
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    cell = synthetic_cell(F.col("n_nationkey").cast("long"), F.lit(2)).alias("cell")
    return n.select(cell, F.col("n_name").alias("nom"), F.col("r_name").alias("province"))


def dates(spark: SparkSession, sf: str) -> DataFrame:
    """Date dimension over the days that orders mention."""
    d = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    return d.select("date", F.date_format("date", "yyyyMMdd").cast("int").alias("date_id"), F.year("date").alias("year"))


# The same in SQL ------------------------------------------------------------------------------------------------


def sql_cell(k: str, r: str) -> str:
    digits = " | ".join(
        f"((CASE WHEN ({r}) >= {i} THEN (({k}) // {7 ** (i - 1)}) % 7 ELSE 7 END)::BIGINT << {3 * (15 - i)})" for i in range(1, 16)
    )
    return f"({1 << 59} | (({r})::BIGINT << 52) | {BASE << 45} | {digits})"


def sql_res(c: str) -> str:
    return f"((({c}) >> 52) & 15)::INTEGER"


def sql_parent(c: str, r: str) -> str:
    return f"((({c}) & {~(15 << 52)}) | (({r})::BIGINT << 52) | ((1::BIGINT << (3 * (15 - ({r})))) - 1))"


def sql_hex(c: str) -> str:
    return f"lower(to_hex({c}))"


def sql_children(c: str, r: int) -> str:
    """List of descendants at ``r`` of a cell that is not finer and no pentagon."""
    digits = " | ".join(
        f"(CASE WHEN {sql_res(c)} < {i} THEN ((k // {7 ** (r - i)}) % 7)::BIGINT << {3 * (15 - i)} ELSE 0 END)" for i in range(1, r + 1)
    )
    low = f"((1::BIGINT << (3 * (15 - {sql_res(c)}))) - 1)"
    head = f"((({c}) & {~(15 << 52)} & ~{low}) | {r << 52} | {(1 << 3 * (15 - r)) - 1})"
    return f"list_transform(range((7 ** ({r} - {sql_res(c)}))::BIGINT), lambda k: {head} | {digits})"


def sql_area(c: str) -> str:
    values = ", ".join(repr(a) for a in C.MEAN_AREA_KM2)
    return f"([{values}]::DOUBLE[])[{sql_res(c)} + 1]"


def sql_area_sum(expr: str) -> str:
    return f"round(sum({expr}), 7)"


def boundary_text(ring: Column) -> Column:
    """A ring as text in whole metres, which compares across engines."""
    point = lambda p: F.concat_ws(" ", F.round(p.x).cast("bigint"), F.round(p.y).cast("bigint"))
    return F.array_join(F.transform(ring, point), ",")


def _sql_list(values: list) -> str:
    return "[" + ", ".join(_sql_list(v) if isinstance(v, list) else f"{float(v)!r}::DOUBLE" for v in values) + "]"


def sql_boundary(c: str) -> str:
    """The boundary of a planar cell in SQL: base centre, plus an offset per digit, plus six corners."""
    axes = []
    for axis, turn in ((0, math.cos), (1, math.sin)):
        base = f"{_sql_list([p[axis] for p in G.base_centres()])}[((({c}) >> 45) & 127) + 1]"
        digits = " + ".join(
            f"CASE WHEN {sql_res(c)} >= {i} THEN {_sql_list([p[axis] for p in G.digit_offsets(i)])}[((({c}) >> {3 * (15 - i)}) & 7) + 1] ELSE 0 END"
            for i in range(1, 16)
        )
        corners = [
            [G.spacing(r) / math.sqrt(3) * turn(G.turn(r) + math.pi / 6 + k * math.pi / 3) for k in (0, 1, 2, 3, 4, 5, 0)]
            for r in range(16)
        ]
        axes.append((f"{base} + {digits}", f"{_sql_list(corners)}[{sql_res(c)} + 1]"))
    (x, dx), (y, dy) = axes
    return f"""(SELECT array_to_string(list_transform(range(1, 8), lambda n: CAST(round(cx + dx[n]) AS BIGINT)::VARCHAR || ' ' || CAST(round(cy + dy[n]) AS BIGINT)::VARCHAR), ',')
  FROM (SELECT {x} AS cx, {y} AS cy, {dx} AS dx, {dy} AS dy))"""


FIRES = f"""fires AS (SELECT {sql_cell('o_orderkey', 'o_orderkey % 7 + 2')} AS cell, o_custkey AS objectid,
  CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS begdate, o_orderpriority AS priority,
  CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderkey FROM orders)"""
LAND = f"""land AS (SELECT {sql_cell('c_custkey * 7 + c_custkey % 3', '(c_custkey // 3) % 4 + 3')} AS cell,
  c_mktsegment AS l_class, c_custkey FROM customer)"""
COMMUNES = f"""communes AS (SELECT {sql_cell('n_nationkey', '2')} AS cell, n_name AS nom, r_name AS province
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
DATES = """dates AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id,
  CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)"""
# Links of the adaptive join, written from its definition.
LINKS = f"""src AS (SELECT DISTINCT cell FROM fires), tar AS (SELECT DISTINCT cell FROM land),
up AS (SELECT s, max(e) AS e FROM (SELECT s.cell AS s, e FROM src s, range(3, 16) r(e) WHERE e <= {sql_res('s.cell')}) a
  JOIN tar ON tar.cell = {sql_parent('s', 'e')} GROUP BY s),
rest AS (SELECT cell FROM src WHERE cell NOT IN (SELECT s FROM up)),
anc AS (SELECT t.cell AS t, e, {sql_parent('t.cell', 'e')} AS a FROM tar t, range(0, 15) r(e) WHERE e < {sql_res('t.cell')}),
near AS (SELECT t, max(e) AS e FROM anc JOIN tar ON anc.a = tar.cell GROUP BY t),
links AS (SELECT s AS src, {sql_parent('s', 'e')} AS tar FROM up
  UNION ALL SELECT rest.cell, anc.t FROM rest JOIN anc ON rest.cell = anc.a LEFT JOIN near ON near.t = anc.t
  WHERE coalesce(near.e, -1) < {sql_res('rest.cell')})"""

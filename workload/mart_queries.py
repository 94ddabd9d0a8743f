"""Cells, adaptive join and data marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexmart.functions import cells as C
from hexmart.operators import aggregates as A
from hexmart.operators.hierjoin import adaptive_join, link_cells
from hexmart.operators.lookup import standardize_field, unnest_json
from hexmart.operators.rowid import dense_row_id
from hexmart.operators.skew import cell_profile
from hexmart.plans.datamart import JsonField, MartSpec, Table, build_datamart, build_facts, context_join, fold_facts, resolution_range, write_datamart
from hexmart.session import fresh_path, materialize
from hexmart.plans.select import Children, Join, build_select
from workload import standins as S
from workload.registry import query, table

RES = 4


def mart_spec(spark: SparkSession, sf: str, **changes: object) -> MartSpec:
    """Fires per year and land-cover class, at one resolution, with communes and provinces."""
    spec = MartSpec(
        tables=[
            Table("facts.fires", S.fires(spark, sf), "indicator",
                  ["!objectid", "!date+begdate+year+annee", "sum_area_adaptatif+surface", "!geom+hex_id+4+geometry"]),
            Table("facts.land_cover", S.land_cover(spark, sf), "context", ["!l_class"]),
            Table("dims.communes", S.communes(spark, sf), "dimension", ["nom AS commune"]),
            Table("dims.provinces", S.communes(spark, sf), "dimension", ["province"]),
        ],
        res=RES,
        json=[JsonField("classe_n3", {"idfeu": "objectid", "classe": "l_class", "surface": "surface"})],
        dates=S.dates(spark, sf),
    )
    for key, value in changes.items():
        setattr(spec, key, value)
    return spec


SQL_NORMAL = f"unnest(CASE WHEN {S.sql_res('cell')} >= {RES} THEN [{S.sql_parent('cell', str(RES))}] ELSE {S.sql_children('cell', RES)} END)"
SQL_FACTS = f"""{S.FIRES}, {S.LAND}, {S.COMMUNES}, {S.DATES}, {S.LINKS},
joined AS (SELECT f.cell, f.objectid, d.year AS annee, l.l_class, l.cell AS ctx FROM fires f LEFT JOIN links k ON f.cell = k.src
  LEFT JOIN land l ON l.cell = k.tar LEFT JOIN dates d ON f.begdate = d.date_id),
placed AS (SELECT *, {SQL_NORMAL} AS pos FROM joined),
t1 AS (SELECT pos, objectid, annee, l_class,
  {S.sql_area_sum(f"least({S.sql_area('cell')}, {S.sql_area('ctx')})")} AS surface FROM placed GROUP BY ALL),
places AS (SELECT unnest({S.sql_children('cell', RES)}) AS pos, nom AS commune, province FROM communes)"""
SQL_MART = f"""{SQL_FACTS},
t2 AS (SELECT pos, annee, '[' || string_agg('{{"idfeu":' || objectid || ',"classe":' || coalesce('"' || l_class || '"', 'null')
  || ',"surface":' || surface || '}}', ',' ORDER BY objectid, l_class NULLS FIRST, surface) || ']' AS classe_n3
  FROM t1 GROUP BY pos, annee)"""


@query("datamart_fire_landcover", f"""WITH {SQL_MART}
SELECT {S.sql_hex('t2.pos')} AS hex_id, annee, classe_n3, commune, province FROM t2 JOIN places p ON p.pos = t2.pos""")
def datamart_fire_landcover(spark: SparkSession, sf: str) -> DataFrame:
    return build_datamart(mart_spec(spark, sf)).drop("geometry")


@query("unnest_datamart", f"""WITH {SQL_FACTS}
SELECT {S.sql_hex('t1.pos')} AS hex_id, annee, commune, province, objectid AS idfeu, l_class AS classe, surface
FROM t1 JOIN places p ON p.pos = t1.pos""")
def unnest_datamart(spark: SparkSession, sf: str) -> DataFrame:
    mart = build_datamart(mart_spec(spark, sf)).drop("geometry")
    return unnest_json(mart, "classe_n3", {"idfeu": "bigint", "classe": "string", "surface": "double"})


@query("dm_geometry", f"""WITH {SQL_FACTS}, drawn AS (SELECT pos, {S.sql_boundary('pos')} AS boundary FROM (SELECT DISTINCT pos FROM t1))
SELECT {S.sql_hex('t2.pos')} AS hex_id, annee, boundary, commune FROM (SELECT DISTINCT pos, annee FROM t1) t2 JOIN places p ON p.pos = t2.pos JOIN drawn d ON d.pos = t2.pos""")
def dm_geometry(spark: SparkSession, sf: str) -> DataFrame:
    """The mart with its cell boundary; the boundary comes from the cell after the aggregation."""
    return build_datamart(mart_spec(spark, sf)).select("hex_id", "annee", S.boundary_text(F.col("geometry")).alias("boundary"), "commune")


@query("adaptive_join", f"""WITH {S.FIRES}, {S.LAND}, {S.LINKS} SELECT {S.sql_hex('src')} AS hex_id_src, {S.sql_hex('tar')} AS hex_id_tar FROM links""")
def q_adaptive_join(spark: SparkSession, sf: str) -> DataFrame:
    land = S.land_cover(spark, sf)
    links = adaptive_join(S.fires(spark, sf), land, *resolution_range(land))
    return links.select(C.to_hex("src").alias("hex_id_src"), C.to_hex("tar").alias("hex_id_tar"))


@query("dm_context_join", f"""WITH {S.FIRES}, {S.LAND}, {S.LINKS}
SELECT f.o_orderkey, l.c_custkey, l.l_class FROM fires f LEFT JOIN links k ON f.cell = k.src LEFT JOIN land l ON l.cell = k.tar""")
def dm_context_join(spark: SparkSession, sf: str) -> DataFrame:
    fires, land = S.fires(spark, sf), S.land_cover(spark, sf)
    profile, land_profile = cell_profile(fires), cell_profile(land)
    links = link_cells(profile.cells, land_profile.cells, land_profile.lo, land_profile.hi, profile.lo, profile.hi)
    around = land.withColumnRenamed("cell", "c_cell")
    return context_join(fires, materialize(links, "pairs"), around, "cell", "c_cell", profile, land_profile).select("o_orderkey", "c_custkey", "l_class")


@query("agg_sum_area_adaptive", f"""WITH {SQL_FACTS} SELECT {S.sql_hex('pos')} AS hex_id, objectid, annee, l_class, surface FROM t1""")
def agg_sum_area_adaptive(spark: SparkSession, sf: str) -> DataFrame:
    facts, _ = build_facts(mart_spec(spark, sf))
    return facts.select(C.to_hex("_cell").alias("hex_id"), "objectid", "annee", "l_class", "surface")


@query("json_agg", f"""WITH {SQL_MART} SELECT {S.sql_hex('pos')} AS hex_id, annee, classe_n3 FROM t2""")
def json_agg(spark: SparkSession, sf: str) -> DataFrame:
    return fold_facts(mart_spec(spark, sf)).select(C.to_hex("_cell").alias("hex_id"), "annee", "classe_n3")


@query("unnest_json", f"""WITH {SQL_FACTS}
SELECT {S.sql_hex('pos')} AS hex_id, annee, objectid AS idfeu, l_class AS classe, surface FROM t1""")
def q_unnest_json(spark: SparkSession, sf: str) -> DataFrame:
    return unnest_json(json_agg(spark, sf), "classe_n3", {"idfeu": "bigint", "classe": "string", "surface": "double"})


@query("cell_resolution", f"""WITH {S.FIRES} SELECT o_orderkey, {S.sql_res('cell')} AS res FROM fires""")
def cell_resolution(spark: SparkSession, sf: str) -> DataFrame:
    return S.fires(spark, sf).select("o_orderkey", C.resolution("cell").alias("res"))


@query("cell_parent", f"""WITH {S.FIRES} SELECT o_orderkey, {S.sql_hex('cell')} AS hex_id, {S.sql_hex(S.sql_parent('cell', '2'))} AS parent FROM fires""")
def cell_parent(spark: SparkSession, sf: str) -> DataFrame:
    return S.fires(spark, sf).select("o_orderkey", C.to_hex("cell").alias("hex_id"), C.to_hex(C.parent("cell", 2)).alias("parent"))


@query("cell_children", f"""WITH {S.LAND} SELECT c_custkey, {S.sql_hex(f"unnest({S.sql_children('cell', 6)})")} AS child FROM land""")
def cell_children(spark: SparkSession, sf: str) -> DataFrame:
    return S.land_cover(spark, sf).select("c_custkey", F.explode(C.children("cell", 6)).alias("c")).select("c_custkey", C.to_hex("c").alias("child"))


@query("cell_area", f"""WITH {S.FIRES} SELECT o_orderkey, {S.sql_area('cell')} AS area FROM fires""")
def cell_area(spark: SparkSession, sf: str) -> DataFrame:
    return S.fires(spark, sf).select("o_orderkey", C.cell_area("cell").alias("area"))


@query("rollup_parent", f"""WITH {S.FIRES} SELECT {S.sql_hex(S.sql_parent('cell', '2'))} AS hex_id, CAST(sum(price) AS DOUBLE) AS total, count(*) AS n FROM fires GROUP BY 1""")
def rollup_parent(spark: SparkSession, sf: str) -> DataFrame:
    rolled = S.fires(spark, sf).groupBy(C.parent("cell", 2).alias("p")).agg(F.sum("price").cast("double").alias("total"), F.count("*").alias("n"))
    return rolled.select(C.to_hex("p").alias("hex_id"), "total", "n")


@query("normalize_resolution", f"""WITH {S.FIRES} SELECT o_orderkey, {S.sql_hex(SQL_NORMAL)} AS hex_id FROM fires""")
def normalize_resolution(spark: SparkSession, sf: str) -> DataFrame:
    return C.normalize(S.fires(spark, sf), "cell", RES, "at").select("o_orderkey", C.to_hex("at").alias("hex_id"))


@query("children_expand", f"""WITH {S.FIRES},
coarse AS (SELECT o_orderkey, unnest({S.sql_children('cell', RES)}) AS child FROM fires WHERE {S.sql_res('cell')} <= {RES})
SELECT f.o_orderkey, {S.sql_hex('child')} AS child FROM fires f LEFT JOIN coarse c ON f.o_orderkey = c.o_orderkey""")
def children_expand(spark: SparkSession, sf: str) -> DataFrame:
    return S.fires(spark, sf).select("o_orderkey", F.explode_outer(C.children("cell", RES)).alias("c")).select("o_orderkey", C.to_hex("c").alias("child"))


@query("resolution_range", f"""WITH {S.FIRES} SELECT min({S.sql_res('cell')}) AS lo, max({S.sql_res('cell')}) AS hi FROM fires""")
def q_resolution_range(spark: SparkSession, sf: str) -> DataFrame:
    return S.fires(spark, sf).agg(F.min(C.resolution("cell")).alias("lo"), F.max(C.resolution("cell")).alias("hi"))


@query("dm_dimension_join", f"""WITH {S.FIRES}, {S.COMMUNES},
places AS (SELECT unnest({S.sql_children('cell', RES)}) AS pos, nom AS commune FROM communes),
moved AS (SELECT o_orderkey, {SQL_NORMAL} AS pos FROM fires)
SELECT o_orderkey, {S.sql_hex('m.pos')} AS hex_id, commune FROM moved m JOIN places p ON p.pos = m.pos""")
def dm_dimension_join(spark: SparkSession, sf: str) -> DataFrame:
    places = C.normalize(S.communes(spark, sf), "cell", RES, "at").select("at", F.col("nom").alias("commune"))
    rows = C.normalize(S.fires(spark, sf), "cell", RES, "at").select("o_orderkey", "at")
    return rows.join(places, "at").select("o_orderkey", C.to_hex("at").alias("hex_id"), "commune")


@query("dm_date_join", f"""WITH {S.FIRES}, {S.DATES} SELECT o_orderkey, year AS annee FROM fires LEFT JOIN dates ON begdate = date_id""")
def dm_date_join(spark: SparkSession, sf: str) -> DataFrame:
    return build_select(
        {"fires": S.fires(spark, sf), "dates": S.dates(spark, sf)},
        {"fires": ["o_orderkey"], "dates": ["year AS annee"]},
        [Join("fires", "!begdate", "dates", "date_id")],
    )


@query("standardize_field", f"""SELECT o.o_orderkey, o.o_custkey, d.date_id AS o_orderdate, o.o_totalprice
FROM orders o LEFT JOIN (WITH {S.DATES} SELECT * FROM dates) d ON CAST(o.o_orderdate AS DATE) = d.date""")
def q_standardize_field(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice")
    return standardize_field(raw, S.dates(spark, sf), "date", "date_id", {"o_orderdate": 2})


@query("scan_dim_date", f"WITH {S.DATES} SELECT date, date_id, year FROM dates")
def scan_dim_date(spark: SparkSession, sf: str) -> DataFrame:
    return S.dates(spark, sf)


@query("dm_projection", f"""WITH {S.FIRES} SELECT o_orderkey AS id, objectid, {S.sql_area('cell')} AS surface, {S.sql_hex(S.sql_parent('cell', '2'))} AS hex_id FROM fires""")
def dm_projection(spark: SparkSession, sf: str) -> DataFrame:
    return build_select({"fires": S.fires(spark, sf)}, {"fires": ["o_orderkey AS id", "objectid", "area+cell+surface", "hex_id_parent+2"]})


@query("dm_group_by", f"""WITH {S.FIRES} SELECT priority, {S.sql_area('cell')} AS surface, CAST(sum(price) AS DOUBLE) AS total FROM fires GROUP BY 1, 2""")
def dm_group_by(spark: SparkSession, sf: str) -> DataFrame:
    out = build_select({"fires": S.fires(spark, sf)}, {"fires": ["!priority", "!area+cell+surface", "sum+price+total"]})
    return out.withColumn("total", F.col("total").cast("double"))


@query("dm_order_by", f"""WITH {S.FIRES} SELECT objectid, priority, count(*) AS n FROM (SELECT objectid, priority FROM fires) GROUP BY 1, 2 ORDER BY 1, 2""")
def dm_order_by(spark: SparkSession, sf: str) -> DataFrame:
    fires = S.fires(spark, sf).withColumn("one", F.lit(1).cast("long"))
    return build_select({"fires": fires}, {"fires": ["!?objectid", "!?priority", "sum+one+n"]})


@query("agg_sum_min", f"""WITH {S.FIRES} SELECT objectid, CAST(sum(price) AS DOUBLE) AS total, min(priority) AS first_priority FROM fires GROUP BY 1""")
def agg_sum_min(spark: SparkSession, sf: str) -> DataFrame:
    out = build_select({"fires": S.fires(spark, sf)}, {"fires": ["!objectid", "sum+price+total", "min+priority+first_priority"]})
    return out.withColumn("total", F.col("total").cast("double"))


@query("agg_min_initcap", """WITH words AS (SELECT p_brand, lower(p_name) || '-' || lower(p_type) AS label FROM part),
capital AS (SELECT p_brand, array_to_string(list_transform(string_split(label, ' '), lambda w: array_to_string(list_transform(
  string_split(w, '-'), lambda v: upper(v[1]) || lower(v[2:])), '-')), ' ') AS label FROM words)
SELECT p_brand, min(label) AS label FROM capital GROUP BY 1""")
def agg_min_initcap(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_brand", F.concat_ws("-", F.lower("p_name"), F.lower("p_type")).alias("label"))
    return part.groupBy("p_brand").agg(A.min_initcap("label").alias("label"))


SQL_NULLED = "SELECT o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS v FROM orders"


def _nulled(spark: SparkSession, sf: str) -> DataFrame:
    value = F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderpriority"))
    return table(spark, sf, "orders").select("o_custkey", value.alias("v"))


@query("agg_array_distinct", f"""SELECT o_custkey, array_to_string(list_transform(vs, lambda x: coalesce(x, 'NULL')), '|') AS vs
FROM (SELECT o_custkey, list_sort(list(DISTINCT v), 'ASC', 'NULLS LAST') AS vs FROM ({SQL_NULLED}) GROUP BY 1)""")
def agg_array_distinct(spark: SparkSession, sf: str) -> DataFrame:
    grouped = _nulled(spark, sf).groupBy("o_custkey").agg(A.array_distinct("v").alias("vs"))
    return grouped.select("o_custkey", F.array_join("vs", "|", "NULL").alias("vs"))


@query("agg_array_length", f"""SELECT o_custkey, CAST(count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END) AS INTEGER) AS n
FROM ({SQL_NULLED}) GROUP BY 1""")
def agg_array_length(spark: SparkSession, sf: str) -> DataFrame:
    return _nulled(spark, sf).groupBy("o_custkey").agg(A.array_length("v").alias("n"))


@query("agg_sum_area", f"""WITH {S.FIRES} SELECT objectid, {S.sql_area_sum(S.sql_area('cell'))} AS surface FROM fires GROUP BY 1""")
def agg_sum_area(spark: SparkSession, sf: str) -> DataFrame:
    return S.fires(spark, sf).groupBy("objectid").agg(A.sum_area("cell").alias("surface"))


@query("threshold_table", f"""SELECT p_partkey, CAST(r AS INTEGER) AS r, greatest(0.0::DOUBLE, 1.0::DOUBLE - p_size::DOUBLE * p_size::DOUBLE / 1000000.0::DOUBLE
  / ([{', '.join(repr(a) for a in C.MEAN_AREA_KM2)}]::DOUBLE[])[r + 1]) AS tx FROM part, range(16) t(r)""")
def threshold_table(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("unit"), F.explode(F.sequence(F.lit(0), F.lit(15))).alias("r"))
    return part.select("p_partkey", "r", C.threshold("unit", "r").alias("tx"))


@query("spec_join_types", """SELECT o.o_orderkey, c.c_name, n.n_name FROM (SELECT * FROM orders) o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey RIGHT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def spec_join_types(spark: SparkSession, sf: str) -> DataFrame:
    return build_select(
        {"o": table(spark, sf, "orders"), "c": table(spark, sf, "customer"), "n": table(spark, sf, "nation")},
        {"o": ["o_orderkey"], "c": ["c_name"], "n": ["n_name"]},
        [Join("o", "!o_custkey", "c", "c_custkey"), Join("c", "c_nationkey", "n", "!n_nationkey")],
    )


@query("spec_select", """SELECT n_name, o_orderstatus, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, min(o_orderpriority) AS first_priority,
CAST(row_number() OVER (ORDER BY n_name, o_orderstatus) AS BIGINT) AS id_esri
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def spec_select(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("price", F.col("o_totalprice").cast("decimal(18,2)"))
    out = build_select(
        {"o": orders, "c": table(spark, sf, "customer"), "n": table(spark, sf, "nation")},
        {"n": ["!?n_name"], "o": ["!?o_orderstatus", "sum+price+total", "min+o_orderpriority+first_priority", "id_esri+"]},
        [Join("o", "o_custkey", "c", "c_custkey"), Join("c", "c_nationkey", "n", "n_nationkey")],
    )
    return out.withColumn("total", F.col("total").cast("double"))


@query("dense_row_id", """SELECT CAST(row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS BIGINT) AS id, l_orderkey, l_linenumber, l_shipdate FROM lineitem""")
def q_dense_row_id(spark: SparkSession, sf: str) -> DataFrame:
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    rows = table(spark, sf, "lineitem").select(*order)
    return dense_row_id(rows, order).select("id", "l_orderkey", "l_linenumber", "l_shipdate")


@query("children_table", f"""WITH {S.COMMUNES} SELECT nom, {S.sql_hex('cell')} AS hex_id, {S.sql_hex(f"unnest({S.sql_children('cell', 5)})")} AS child FROM communes""")
def children_table(spark: SparkSession, sf: str) -> DataFrame:
    kids = C.explode_children(S.communes(spark, sf), "cell", 5, "kid", step=2)
    return kids.select("nom", C.to_hex("cell").alias("hex_id"), C.to_hex("kid").alias("child"))


@query("select_children", f"""WITH {S.COMMUNES}, kids AS (SELECT nom, unnest({S.sql_children('cell', 5)}) AS kid FROM communes)
SELECT nom, {S.sql_hex('kid')} AS hex_id, {S.sql_boundary('kid')} AS boundary FROM kids""")
def select_children(spark: SparkSession, sf: str) -> DataFrame:
    """The lateral join with all children of a level, their ids and their geometry, from a spec."""
    out = build_select({"c": S.communes(spark, sf)}, {"c": ["nom", "hex_id_children+", "geom_children+"]}, [Children("c", 5, keep=False)])
    return out.select("nom", "hex_id", S.boundary_text(F.col("geometry")).alias("boundary"))


@query("select_children_among", f"""WITH {S.FIRES}, {S.COMMUNES}, kids AS (SELECT nom, unnest({S.sql_children('cell', RES)}) AS kid FROM communes),
seen AS (SELECT DISTINCT {S.sql_parent('cell', str(RES))} AS kid FROM fires WHERE {S.sql_res('cell')} >= {RES})
SELECT nom, {S.sql_hex('kid')} AS hex_id FROM kids SEMI JOIN seen USING (kid)""")
def select_children_among(spark: SparkSession, sf: str) -> DataFrame:
    """The same for the children that occur in another table, met on their ancestors; no commune is expanded."""
    fires = S.fires(spark, sf).filter(C.resolution("cell") >= RES)
    tables = {"c": S.communes(spark, sf), "m": fires.select(C.parent("cell", RES).alias("cell"))}
    return build_select(tables, {"c": ["nom", "hex_id_children+"]}, [Children("c", RES, keep=False, among="m")])


@query("select_at_level", f"""WITH {S.FIRES} SELECT {S.sql_hex(SQL_NORMAL)} AS hex_id, count(*) AS n FROM fires GROUP BY 1""")
def select_at_level(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of mixed levels at one: ancestors of the fine ones, children of the coarse ones."""
    fires = S.fires(spark, sf).withColumn("one", F.lit(1).cast("bigint"))
    return build_select({"f": fires}, {"f": [f"!hex_id+{RES}", "sum+one+n"]}, [Children("f", RES)])


@query("datamart_with_geometry", f"""WITH {SQL_MART}
SELECT {S.sql_hex('t2.pos')} AS hex_id, annee, classe_n3, {S.sql_boundary('t2.pos')} AS boundary, commune, province FROM t2 JOIN places p ON p.pos = t2.pos""")
def datamart_with_geometry(spark: SparkSession, sf: str) -> DataFrame:
    """The whole mart as stored: with its geometry, laid out by cell, numbered and checked for a map server."""
    mart = write_datamart(mart_spec(spark, sf, set_index=True, set_esri=True), fresh_path(spark, "mart"))
    return mart.withColumn("boundary", S.boundary_text(F.col("geometry"))).drop("geometry", "id_esri", "srid")

"""Grid geometry over rectangles that the part table describes."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexmart.functions import cells as C
from hexmart.functions.boxes import Box, cells_in_box
from hexmart.functions import grid as G
from hexmart.functions import projection as PR
from hexmart.operators.rings import EDGE_MARGIN
from hexmart.plans import indexing as X
from hexmart.session import fresh_path
from hexmart.sources.sinks import cluster_by_cell
from workload import standins as S
from workload.registry import query, table

# A rectangle per part, one to a lot of 1500 m, so that they do not overlap.
LOT = 1500


def plots(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    lot_row = F.call_function("div", key, F.lit(3000).cast("bigint")) % 3000
    x0 = (key % 3000 * LOT - 1_500_000 + size % 7 * 10).cast("double")
    y0 = (lot_row * LOT - 1_500_000 + size % 11 * 10).cast("double")
    sides = p.select("p_partkey", "p_brand", x0.alias("x0"), y0.alias("y0"), (x0 + 300 + size * 20).alias("x1"), (y0 + 300 + size * 7 % 50 * 20).alias("y1"))
    corners = [("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0")]
    ring = F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in corners])
    return sides.withColumn("geometry", F.array(F.array(ring)))


def layer(spark: SparkSession, sf: str) -> DataFrame:
    return plots(spark, sf).select("p_partkey", "p_brand", "geometry")


SQL_PLOTS = f"""plots AS (SELECT *, x0 + 300 + p_size * 20 AS x1, y0 + 300 + p_size * 7 % 50 * 20 AS y1 FROM (SELECT p_partkey, p_brand, p_size,
  (p_partkey % 3000 * {LOT} - 1500000 + p_size % 7 * 10)::DOUBLE AS x0, (p_partkey // 3000 % 3000 * {LOT} - 1500000 + p_size % 11 * 10)::DOUBLE AS y0 FROM part))"""


def _f(v: float) -> str:
    return f"({v!r})::DOUBLE"


def sql_near(r: int, reach: float) -> str:
    """CTE ``near``: (plot, lattice cell of even level ``r``) pairs whose centre lies within ``reach`` of the extent."""
    s = G.spacing(r)
    ox, oy = G.ORIGIN
    row = s * math.sqrt(3) / 2
    return f"""rows_of AS (SELECT *, unnest(generate_series(CAST(floor((y0 - {_f(oy)} - {_f(reach)}) / {_f(row)}) AS BIGINT),
  CAST(ceil((y1 - {_f(oy)} + {_f(reach)}) / {_f(row)}) AS BIGINT))) AS j FROM plots),
near AS (SELECT *, {_f(ox)} + {_f(s)} * (i + j / 2.0::DOUBLE) AS cx, {_f(oy)} + {_f(row)} * j AS cy FROM (SELECT *, unnest(generate_series(
  CAST(floor((x0 - {_f(ox)} - {_f(reach)}) / {_f(s)} - j / 2.0::DOUBLE) AS BIGINT), CAST(ceil((x1 - {_f(ox)} + {_f(reach)}) / {_f(s)} - j / 2.0::DOUBLE) AS BIGINT))) AS i FROM rows_of))"""


def sql_ids(r: int, source: str) -> str:
    """CTE ``ids``: (i, j, cell) of the lattice cells in ``source``, one CTE per level going up."""
    steps = [f"at{r} AS (SELECT DISTINCT i, j, i AS pi, j AS pj, 0::BIGINT AS bits FROM {source})"]
    di = "[" + ", ".join(str(a) for a, _ in G.STEPS) + "]"
    dj = "[" + ", ".join(str(b) for _, b in G.STEPS) + "]"
    for level in range(r, 0, -1):
        k = 3 if level % 2 else 5
        digits = [0] * 7
        for d, (a, b) in enumerate(G.STEPS):
            digits[(a + k * b) % 7] = d
        up = ("2 * a - b", "a + 3 * b") if level % 2 else ("3 * a + b", "2 * b - a")
        steps.append(f"""at{level - 1} AS (SELECT i, j, ({up[0]}) // 7 AS pi, ({up[1]}) // 7 AS pj, bits | (d::BIGINT << {3 * (15 - level)}) AS bits FROM (
  SELECT i, j, bits, d, pi - {di}[d + 1] AS a, pj - {dj}[d + 1] AS b FROM (SELECT *, {digits}[((pi + {k} * pj) % 7 + 7) % 7 + 1] AS d FROM at{level})))""")
    number = f"{G.BASE_CELLS}[(pi + {G.ROWS // 2}) * {G.COLS} + pj + {G.COLS // 2} + 1]"
    steps.append(f"ids AS (SELECT i, j, {S.sql_hex(f'({(1 << 59) | (r << 52) | ((1 << 3 * (15 - r)) - 1)} | ({number}::BIGINT << 45) | bits)')} AS hex_id FROM at0)")
    return ", ".join(steps)


def _inside(bounds: list[tuple[float | str, str, str]]) -> str:
    """Length of the part of [0, 1] where every bound holds; a bound (slope, start, limit) asks for start + t * slope <= limit.

    A slope is a number, or a number times a positive column as text with its sign in front.
    """
    low, high = ["0::DOUBLE"], ["1::DOUBLE"]
    for slope, start, limit in bounds:
        if slope == 0:
            high.append(f"CASE WHEN {start} <= {limit} THEN 1::DOUBLE ELSE -1::DOUBLE END")
            continue
        falls = str(slope).startswith("-")
        (low if falls else high).append(f"(({limit}) - ({start})) / ({_f(slope) if isinstance(slope, float) else slope})")
    return f"greatest(0::DOUBLE, least({', '.join(high)}) - greatest({', '.join(low)}))"


def sql_edges(r: int, margin: float = 0.0) -> tuple[str, str]:
    """(area, perimeter) of what a plot and the hexagon of level ``r`` have in common, by plain sums over edges.

    The border of the common part of two convex shapes is made of the edges of each that lie inside the other. An edge's part
    inside is an interval of its parameter, cut by the other's half-planes; the area is half the sum of the cross products of its ends.
    Columns: X0, X1, Y0, Y1, the plot's sides relative to the centre, and W, H, its size.
    """
    half, turn = G.spacing(r) / 2 + margin, G.turn(r)
    clean = lambda v: 0.0 if abs(v) < 1e-12 else v
    normals = [(clean(math.cos(turn + k * math.pi / 3)), clean(math.sin(turn + k * math.pi / 3))) for k in range(6)]
    corner = [(half * 2 / math.sqrt(3) * math.cos(turn + (2 * k + 1) * math.pi / 6), half * 2 / math.sqrt(3) * math.sin(turn + (2 * k + 1) * math.pi / 6)) for k in range(6)]
    area, perimeter = [], []
    for x, y, dx, dy, length in (("X0", "Y0", 1, 0, "W"), ("X1", "Y0", 0, 1, "H"), ("X1", "Y1", -1, 0, "W"), ("X0", "Y1", 0, -1, "H")):
        bounds = []
        for nx, ny in normals:
            along = clean(nx * dx + ny * dy)
            bounds.append((0 if not along else f"{'-' if along < 0 else ''}{_f(abs(along))} * {length}", f"{_f(nx)} * {x} + {_f(ny)} * {y}", _f(half)))
        part = _inside(bounds)
        area.append(f"{part} * ({x} * {dy} - {y} * {dx}) * {length}")
        perimeter.append(f"{part} * {length}")
    for k, (px, py) in enumerate(corner):
        qx, qy = corner[(k + 1) % 6]
        dx, dy = clean(float(f"{qx - px:.9f}")) and qx - px, clean(float(f"{qy - py:.9f}")) and qy - py
        part = _inside([(v, _f(sign * at), limit) for v, at, sign, limit in ((dx, px, 1, "X1"), (-dx, px, -1, "-X0"), (dy, py, 1, "Y1"), (-dy, py, -1, "-Y0"))])
        area.append(f"{part} * {_f(px * dy - py * dx)}")
        perimeter.append(f"{part} * {_f(math.hypot(dx, dy))}")
    return f"({' + '.join(area)}) / 2", " + ".join(perimeter)


def sql_centre(r: int) -> tuple[str, str]:
    (ix, iy), (jx, jy) = G.axial_to_metres(1, 0, r), G.axial_to_metres(0, 1, r)
    return f"{_f(G.ORIGIN[0])} + i * {_f(ix)} + j * {_f(jx)}", f"{_f(G.ORIGIN[1])} + i * {_f(iy)} + j * {_f(jy)}"


SLACK = X.SLACK


def sql_overlap(r: int, source: str = "near", name: str = "overlap") -> str:
    """CTE ``name``: plot, cell of ``source`` and the area and perimeter of what they share, without grazing contact."""
    cx, cy = sql_centre(r)
    area, perimeter = sql_edges(r)
    return f"""{name} AS (SELECT p_partkey, p_brand, i, j, {area} AS area, {perimeter} AS perimeter FROM (
  SELECT p_partkey, p_brand, i, j, x0 - ({cx}) AS X0, x1 - ({cx}) AS X1, y0 - ({cy}) AS Y0, y1 - ({cy}) AS Y1, x1 - x0 AS W, y1 - y0 AS H FROM {source})
  WHERE area > {_f(SLACK * G.cell_area_m2(r))})"""


def sql_children(r: int, source: str) -> str:
    """Select the children (i, j) at level ``r`` of the cells of ``source``, with its other columns."""
    step = "unnest([" + ", ".join(f"{{'a': {a}, 'b': {b}}}" for a, b in G.STEPS) + "]) AS step"
    up = ("3 * i + j", "2 * j - i") if r % 2 else ("2 * i - j", "i + 3 * j")
    return f"SELECT * EXCLUDE (step, i, j, ci, cj), ci + step.a AS i, cj + step.b AS j FROM (SELECT *, {up[0]} AS ci, {up[1]} AS cj, {step} FROM {source})"


def sql_levels(lo: int, hi: int) -> str:
    """CTEs near{r}: plots with all cells whose descendants may touch them, from ``lo`` (even) down to ``hi``."""
    steps = [sql_near(lo, 0.85 * G.spacing(lo)).replace("near AS (", f"near{lo} AS (")]
    for r in range(lo + 1, hi + 1):
        cx, cy = sql_centre(r)
        far = f"sqrt(greatest(x0 - ({cx}), ({cx}) - x1, 0) ** 2 + greatest(y0 - ({cy}), ({cy}) - y1, 0) ** 2)"
        steps.append(f"near{r} AS (SELECT * FROM ({sql_children(r, f'(SELECT p_partkey, p_brand, x0, x1, y0, y1, i, j FROM near{r - 1})')}) WHERE {far} <= {_f(0.85 * G.spacing(r))})")
    return ", ".join(steps)


def sql_found(levels: range, columns: str) -> str:
    """CTEs with ids of the valid cells of each level, and their union."""
    parts = [f"SELECT hex_id, {columns} FROM valid{r} JOIN (WITH {sql_ids(r, f'valid{r}')} SELECT * FROM ids) USING (i, j)" for r in levels]
    return " UNION ALL ".join(parts)


def _hex(df: DataFrame) -> DataFrame:
    return df.withColumn("hex_id", C.to_hex("cell")).drop("cell")


FINE, MID = 10, 8


@query("polyfill", f"""WITH {SQL_PLOTS}, {sql_near(FINE, 0)}, hit AS (SELECT * FROM near WHERE cx > x0 AND cx < x1 AND cy > y0 AND cy < y1), {sql_ids(FINE, 'hit')}
SELECT p_partkey, hex_id FROM hit JOIN ids USING (i, j)""")
def polyfill(spark: SparkSession, sf: str) -> DataFrame:
    return _hex(X.polyfill(layer(spark, sf), FINE, "p_partkey"))


@query("index_uniform", f"""WITH {SQL_PLOTS}, {sql_near(FINE, 0)}, hit AS (SELECT * FROM near WHERE cx > x0 AND cx < x1 AND cy > y0 AND cy < y1), {sql_ids(FINE, 'hit')}
SELECT hex_id, p_partkey, p_brand FROM hit JOIN ids USING (i, j)""")
def index_uniform(spark: SparkSession, sf: str) -> DataFrame:
    return _hex(X.index_uniform(layer(spark, sf), FINE, "p_partkey")).select("hex_id", "p_partkey", "p_brand")


_MARGIN = X.MESH_MARGIN * math.sqrt(G.cell_area_m2(MID))


@query("mesh", f"""WITH {SQL_PLOTS}, {sql_near(MID, 2 * _MARGIN)}, hit AS (SELECT DISTINCT i, j FROM near
WHERE sqrt(greatest(x0 - cx, cx - x1, 0) ** 2 + greatest(y0 - cy, cy - y1, 0) ** 2) <= {_f(_MARGIN)}), {sql_ids(MID, 'hit')} SELECT hex_id FROM ids""")
def mesh(spark: SparkSession, sf: str) -> DataFrame:
    return _hex(X.mesh(layer(spark, sf), MID))


SQL_OVERLAP = f"WITH {SQL_PLOTS}, {sql_near(MID, G.spacing(MID))}, {sql_overlap(MID)}, {sql_ids(MID, 'overlap')}"


@query("overlap_area", f"{SQL_OVERLAP} SELECT p_partkey, hex_id, round(area) AS area FROM overlap JOIN ids USING (i, j)")
def overlap_area(spark: SparkSession, sf: str) -> DataFrame:
    return _hex(X.overlap_area(layer(spark, sf), MID, "p_partkey")).withColumn("area", F.round("area"))


@query("intersection_area", f"""WITH {SQL_PLOTS}, {sql_near(FINE, G.spacing(FINE))}, {sql_overlap(FINE)}, {sql_ids(FINE, 'overlap')}
SELECT p_partkey, hex_id, round(area) AS area FROM overlap JOIN ids USING (i, j)""")
def intersection_area(spark: SparkSession, sf: str) -> DataFrame:
    return _hex(X.overlap_area(layer(spark, sf), FINE, "p_partkey")).withColumn("area", F.round("area"))


@query("spatial_join_cells", f"{SQL_OVERLAP} SELECT p_partkey, hex_id FROM overlap JOIN ids USING (i, j)")
def spatial_join_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of polygon and cell that overlap, found by cutting the polygons into the cells."""
    return _hex(X.overlap_area(layer(spark, sf), MID, "p_partkey")).select("p_partkey", "hex_id")


@query("class_share", f"""{SQL_OVERLAP}, shares AS (SELECT i, j, p_brand, sum(area) / {_f(G.cell_area_m2(MID))} AS share FROM overlap GROUP BY 1, 2, 3)
SELECT hex_id, p_brand, round(share, 5) AS share FROM shares JOIN ids USING (i, j)""")
def class_share(spark: SparkSession, sf: str) -> DataFrame:
    shares = _hex(X.class_share(layer(spark, sf), "p_brand", MID))
    return shares.withColumn("share", F.round("share", 5))


@query("clip_to_cells", f"""{SQL_OVERLAP} SELECT p_partkey, hex_id, round(area) AS area, round(perimeter) AS perimeter, FALSE AS hole FROM overlap JOIN ids USING (i, j)""")
def clip_to_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The clipped rings, told by their area and perimeter."""
    rings = _hex(X.clip_to_cells(layer(spark, sf), MID, "p_partkey"))
    edges = F.zip_with("ring", F.concat(F.slice("ring", 2, F.size("ring") - 1), F.slice("ring", 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    origin = F.get("ring", 0)
    cross = lambda e: (e.a.x - origin.x) * (e.b.y - origin.y) - (e.b.x - origin.x) * (e.a.y - origin.y)
    area = F.abs(F.aggregate(edges, F.lit(0.0), lambda t, e: t + cross(e))) / 2
    perimeter = F.aggregate(edges, F.lit(0.0), lambda t, e: t + F.hypot(e.b.x - e.a.x, e.b.y - e.a.y))
    return rings.select("p_partkey", "hex_id", F.round(area).alias("area"), F.round(perimeter).alias("perimeter"), "hole")


COARSEST, FINEST = 6, 11
_LEVELS = range(COARSEST, FINEST + 1)
_TX = C.thresholds(7)
_COARSE_MARGIN = X.MESH_MARGIN * math.sqrt(G.cell_area_m2(COARSEST))


def _sql_partition() -> str:
    """Decisions level by level: shares of the cells still open, then valid cells, then the children of the rest."""
    steps = [f"""open{COARSEST} AS (SELECT DISTINCT i, j FROM near{COARSEST} WHERE sqrt(greatest(x0 - cx, cx - x1, 0) ** 2 + greatest(y0 - cy, cy - y1, 0) ** 2) <= {_f(_COARSE_MARGIN)})"""]
    for r in _LEVELS:
        tx = _f(_TX[r])
        state = "total >= 0.5 - 1e-9" if r == FINEST else f"total >= 1 - {tx} - 1e-9 AND top >= {tx} - 1e-9"
        steps += [
            sql_overlap(r, f"near{r}", f"overlap{r}"),
            f"share{r} AS (SELECT i, j, p_brand, sum(area) / {_f(G.cell_area_m2(r))} AS share FROM overlap{r} JOIN open{r} USING (i, j) GROUP BY ALL)",
            f"""cell{r} AS (SELECT i, j, sum(share) AS total, max(share) AS top, arg_min(p_brand, {{'s': -round(share, 9), 'b': p_brand}}) AS p_brand
  FROM share{r} WHERE share > {_f(SLACK)} GROUP BY i, j)""",
            f"valid{r} AS (SELECT i, j, p_brand FROM cell{r} WHERE {state})",
        ]
        if r < FINEST:
            left = f"(SELECT i, j FROM cell{r} WHERE total >= 1 - {tx} - 1e-9 AND top < {tx} - 1e-9)"
            steps.append(f"open{r + 1} AS ({sql_children(r + 1, left)})")
    return f"WITH {SQL_PLOTS}, {sql_levels(COARSEST, FINEST)}, {', '.join(steps)} {sql_found(_LEVELS, 'p_brand')}"


@query("index_adaptive_partition", _sql_partition())
def index_adaptive_partition(spark: SparkSession, sf: str) -> DataFrame:
    return _hex(X.index_adaptive_partition(layer(spark, sf), "p_brand", _TX, COARSEST, FINEST))


def _sql_objects() -> str:
    """The same for each plot alone, whose cells are split while the plot touches their widened hexagon."""
    steps = [f"open{COARSEST} AS (SELECT p_partkey, p_brand, x0, x1, y0, y1, i, j FROM near{COARSEST})"]
    for r in _LEVELS:
        full = G.cell_area_m2(r)
        cx, cy = sql_centre(r)
        areas = [sql_edges(r, margin)[0] for margin in (0.0, EDGE_MARGIN * math.sqrt(full))]
        steps.append(f"""cell{r} AS (SELECT *, {areas[0]} AS area, {areas[1]} AS wide FROM (
  SELECT *, x0 - ({cx}) AS X0, x1 - ({cx}) AS X1, y0 - ({cy}) AS Y0, y1 - ({cy}) AS Y1, x1 - x0 AS W, y1 - y0 AS H FROM open{r}))""".replace("SELECT *, x0", "SELECT p_partkey, p_brand, x0 AS px0, x1 AS px1, y0 AS py0, y1 AS py1, i, j, x0"))
        limit = _f((0.5 if r == FINEST else _TX[r]) * full - SLACK * full)
        touched = f"wide > {_f(1e-12 * full)}"
        steps.append(f"valid{r} AS (SELECT p_partkey, p_brand, i, j FROM cell{r} WHERE {touched} AND area >= {limit})")
        if r < FINEST:
            left = f"(SELECT p_partkey, p_brand, px0 AS x0, px1 AS x1, py0 AS y0, py1 AS y1, i, j FROM cell{r} WHERE {touched} AND area < {limit})"
            steps.append(f"open{r + 1} AS ({sql_children(r + 1, left)})")
    found = " UNION ALL ".join(
        f"SELECT hex_id, p_partkey, p_brand FROM valid{r} JOIN (WITH {sql_ids(r, f'valid{r}')} SELECT * FROM ids) USING (i, j)" for r in _LEVELS)
    return f"WITH {SQL_PLOTS}, {sql_near(COARSEST, 0.85 * G.spacing(COARSEST)).replace('near AS (', f'near{COARSEST} AS (')}, {', '.join(steps)} {found}"


@query("index_adaptive_objects", _sql_objects())
def index_adaptive_objects(spark: SparkSession, sf: str) -> DataFrame:
    return _hex(X.index_adaptive_objects(layer(spark, sf), "p_partkey", _TX, COARSEST, FINEST)).select("hex_id", "p_partkey", "p_brand")


# At one resolution the adaptive index of a partition is decided by the shares alone, which SQL can follow.
@query("index_dimension_cells", f"""{SQL_OVERLAP}, shares AS (SELECT i, j, p_brand, sum(area) / {_f(G.cell_area_m2(MID))} AS share FROM overlap GROUP BY 1, 2, 3),
inside AS (SELECT DISTINCT i, j FROM near WHERE sqrt(greatest(x0 - cx, cx - x1, 0) ** 2 + greatest(y0 - cy, cy - y1, 0) ** 2) <= {_f(_MARGIN)}),
ranked AS (SELECT *, round(share, 6) AS s, row_number() OVER (PARTITION BY i, j ORDER BY round(share, 6) DESC, p_brand) AS n FROM shares WHERE share > 0.000000001)
SELECT hex_id, p_brand FROM ranked JOIN ids USING (i, j) JOIN inside USING (i, j) WHERE n = 1""")
def index_dimension_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Dimension tables as the adaptive index at a single resolution without a least cover."""
    return _hex(X.index_adaptive_partition(layer(spark, sf), "p_brand", C.thresholds(7), MID, MID, tx_spatial=0.0))


_RADIUS = G.spacing(MID) / math.sqrt(3)
_CORNERS = [(_RADIUS * math.cos(math.pi / 6 + k * math.pi / 3), _RADIUS * math.sin(math.pi / 6 + k * math.pi / 3)) for k in (0, 1, 2, 3, 4, 5, 0)]
_SQL_RING = " || ',' || ".join(f"CAST(round(cx + {_f(x)}) AS BIGINT)::VARCHAR || ' ' || CAST(round(cy + {_f(y)}) AS BIGINT)::VARCHAR" for x, y in _CORNERS)


@query("cell_boundary", f"""WITH {SQL_PLOTS}, {sql_near(MID, 2 * _MARGIN)}, hit AS (SELECT i, j, any_value(cx) AS cx, any_value(cy) AS cy FROM near
WHERE sqrt(greatest(x0 - cx, cx - x1, 0) ** 2 + greatest(y0 - cy, cy - y1, 0) ** 2) <= {_f(_MARGIN)} GROUP BY i, j), {sql_ids(MID, 'hit')} SELECT hex_id, {_SQL_RING} AS boundary FROM hit JOIN ids USING (i, j)""")
def cell_boundary(spark: SparkSession, sf: str) -> DataFrame:
    """Boundaries of the cells under the plots."""
    cells = X.mesh(layer(spark, sf), MID).withColumn("boundary", S.boundary_text(G.boundary("cell")))
    return _hex(cells).select("hex_id", "boundary")


@query("geom_view", f"""WITH {S.FIRES} SELECT CAST(row_number() OVER (ORDER BY cell, o_orderkey) AS BIGINT) AS id, {S.sql_hex('cell')} AS hex_id, o_orderkey,
{S.sql_boundary('cell')} AS boundary FROM fires""")
def geom_view(spark: SparkSession, sf: str) -> DataFrame:
    view = X.geom_view(S.fires(spark, sf).select("cell", "o_orderkey"))
    return view.select("id", "hex_id", "o_orderkey", S.boundary_text(F.col("geometry")).alias("boundary"))


_T = f"pow((1 - {_f(PR._E)} * sin(phi)) / (1 + {_f(PR._E)} * sin(phi)), {_f(PR._E / 2)})"


def _sql_latitude() -> str:
    inner = f"SELECT p_partkey, dx, dy, t, {_f(math.pi / 2)} - 2 * atan(t) AS phi FROM polar"
    for _ in range(6):
        inner = f"SELECT p_partkey, dx, dy, t, {_f(math.pi / 2)} - 2 * atan(t * {_T}) AS phi FROM ({inner})"
    return inner


_SIGN = math.copysign(1.0, PR._N)


@query("reproject_points", f"""WITH {SQL_PLOTS}, flat AS (SELECT p_partkey, (x0 - {_f(PR.FALSE_EAST)}) * {_f(_SIGN)} AS dx, ({_f(PR._R0 + PR.FALSE_NORTH)} - y0) * {_f(_SIGN)} AS dy FROM plots),
polar AS (SELECT *, pow(sqrt(dx * dx + dy * dy) * {_f(_SIGN)} / {_f(PR.AXIS * PR._SCALE)}, {_f(1 / PR._N)}) AS t FROM flat), deg AS ({_sql_latitude()})
SELECT p_partkey, round(degrees(atan2(dx, dy) / {_f(PR._N)}) + {_f(PR.LON_0)}, 7) AS lon, round(degrees(phi), 7) AS lat FROM deg""")
def reproject_points(spark: SparkSession, sf: str) -> DataFrame:
    lon, lat = PR.to_lonlat(F.col("x0"), F.col("y0"))
    return plots(spark, sf).select("p_partkey", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


@query("bbox_filter", f"WITH {SQL_PLOTS} SELECT p_partkey FROM plots WHERE x0 <= -1100000 AND x1 >= -1480000 AND y0 <= 500000 AND y1 >= -1499000")
def bbox_filter(spark: SparkSession, sf: str) -> DataFrame:
    return X.in_box(layer(spark, sf), -1_480_000, -1_499_000, -1_100_000, 500_000).select("p_partkey")


@query("bbox_layer_stored", f"WITH {SQL_PLOTS} SELECT p_partkey FROM plots WHERE x0 <= -1100000 AND x1 >= -1480000 AND y0 <= 500000 AND y1 >= -1499000")
def bbox_layer_stored(spark: SparkSession, sf: str) -> DataFrame:
    """From a stored layer, by the extents in its files."""
    path = fresh_path(spark, "layer")
    X.store_layer(layer(spark, sf), path)
    return X.layer_in_box(spark.read.parquet(path), -1_480_000, -1_499_000, -1_100_000, 500_000).select("p_partkey")


BOX = Box(-1_480_000, -1_499_000, -1_100_000, 500_000)


def _sql_meets(r: int, box: Box) -> str:
    """Centres (cx, cy) of cells of level ``r`` whose hexagon meets a box, axis by axis."""
    dx, dy = f"(cx - {_f((box.xmin + box.xmax) / 2)})", f"(cy - {_f((box.ymin + box.ymax) / 2)})"
    w, h, s = (box.xmax - box.xmin) / 2, (box.ymax - box.ymin) / 2, G.spacing(r)
    tests = [f"abs({dx}) <= {_f(w + s / 2)}", f"abs({dy}) <= {_f(h + s / math.sqrt(3))}"]
    for k in (1, 2):
        nx, ny = math.cos(k * math.pi / 3), math.sin(k * math.pi / 3)
        tests.append(f"abs({dx} * {_f(nx)} + {dy} * {_f(ny)}) <= {_f(s / 2 + abs(nx) * w + abs(ny) * h)}")
    return " AND ".join(tests)


@query("cells_in_box", f"""WITH {SQL_PLOTS}, {sql_near(MID, 2 * _MARGIN)}, hit AS (SELECT DISTINCT i, j FROM near
WHERE sqrt(greatest(x0 - cx, cx - x1, 0) ** 2 + greatest(y0 - cy, cy - y1, 0) ** 2) <= {_f(_MARGIN)} AND {_sql_meets(MID, BOX)}), {sql_ids(MID, 'hit')} SELECT hex_id FROM ids""")
def q_cells_in_box(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of a stored mesh that meet a box: id ranges prune the scan, an exact test follows."""
    path = fresh_path(spark, "mesh")
    cluster_by_cell(X.mesh(layer(spark, sf), MID)).write.parquet(path)
    return _hex(cells_in_box(spark.read.parquet(path), BOX, MID, MID))

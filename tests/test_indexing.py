import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hexmart.functions import cells as C
from hexmart.functions import grid as G
from hexmart.operators import rings as R
from hexmart.plans import indexing as X
from hexmart.session import shared_dir
from hexmart.sources import folders
from tests import plain

GEOMETRY = "array<array<array<struct<x:double,y:double>>>>"
SQUARE = [(500000, 200000), (503000, 200000), (503000, 204000), (500000, 204000), (500000, 200000)]
HOLE = [(501000, 201000), (501000, 202000), (502000, 202000), (502000, 201000)]
NOTCHED = [(510000, 200000), (510000, 206000), (512000, 201000), (516000, 206000), (514000, 200000)]
ISLAND = [(507000, 207000), (507500, 207900), (506300, 208000)]


def star(x, y, n, seed):
    rng = random.Random(seed)
    return [(x + r * math.cos(a), y + r * math.sin(a)) for a, r in ((2 * math.pi * i / n, rng.uniform(600, 2500)) for i in range(n))]


SHAPES = {1: [[SQUARE, HOLE]], 2: [[NOTCHED], [ISLAND]], 3: [[star(495000, 215000, 60, 1)]], 4: [[star(495800, 215500, 25, 2)]]}


def floats(shape):
    return [[[(float(x), float(y)) for x, y in ring] for ring in polygon] for polygon in shape]


@pytest.fixture(scope="module")
def layer(spark):
    rows = [(k, "ab"[k % 2], floats(shape)) for k, shape in SHAPES.items()]
    return spark.createDataFrame(rows, f"id int, cls string, geometry {GEOMETRY}").cache()


def area_of(ring):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1]))) / 2


def total(shape):
    return sum(area_of(p[0]) - sum(map(area_of, p[1:])) for p in shape)


def covered(shape, x, y):
    inside = np.zeros(len(x), bool)
    for ring in (r for p in shape for r in p):
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if y1 != y2:
                inside ^= ((y1 > y) != (y2 > y)) & (x1 + (y - y1) * (x2 - x1) / (y2 - y1) > x)
    return inside


def gap(shape, x, y):
    best = np.full(len(x), np.inf)
    for ring in (r for p in shape for r in p):
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            dx, dy = x2 - x1, y2 - y1
            t = np.clip(((x - x1) * dx + (y - y1) * dy) / max(dx * dx + dy * dy, 1e-9), 0, 1)
            best = np.minimum(best, np.hypot(x - x1 - t * dx, y - y1 - t * dy))
    return best


def all_cells(spark, r):
    """Every cell of level r around the shapes, with centre, from a dense lattice of points."""
    step = G.spacing(r) / 3
    xs, ys = int(30000 / step), int(30000 / step)
    points = spark.range(xs * ys).select((490000 + F.col("id") % xs * step).alias("x"), (195000 + F.floor(F.col("id") / xs) * step).alias("y"))
    cells = points.select(G.cell_at(F.col("x"), F.col("y"), r).alias("cell")).distinct()
    x, y = G.centre("cell")
    rows = cells.select("cell", x, y).collect()
    return np.array([c[0] for c in rows]), np.array([c[1] for c in rows]), np.array([c[2] for c in rows])


@pytest.mark.parametrize("r", [5, 7, 9])
def test_overlap_keeps_the_area(layer, r):
    got = {k: a for k, a in X.overlap_area(layer, r, "id").groupBy("id").agg(F.sum("area")).collect()}
    assert got == {k: pytest.approx(total(shape), rel=1e-9) for k, shape in SHAPES.items()}


@pytest.mark.parametrize("r", [7, 8])
def test_polyfill_and_mesh_cell_by_cell(spark, layer, r):
    cells, x, y = all_cells(spark, r)
    got = {tuple(t) for t in X.polyfill(layer, r, "id").collect()}
    assert got == {(k, int(c)) for k, shape in SHAPES.items() for c in cells[covered(shape, x, y)]}
    margin = 0.6 * math.sqrt(G.cell_area_m2(r))
    near = np.zeros(len(cells), bool)
    for shape in SHAPES.values():
        near |= covered(shape, x, y) | (gap(shape, x, y) <= margin)
    assert {c[0] for c in X.mesh(layer, r).collect()} == set(map(int, cells[near]))


def test_uniform_index_carries_attributes(layer):
    rows = X.index_uniform(layer, 8, "id")
    assert rows.columns == ["cell", "id", "cls"]
    assert sorted((r.id, r.cell) for r in rows.collect()) == sorted((r.id, r.cell) for r in X.polyfill(layer, 8, "id").collect())
    assert rows.filter("cls <> case when id % 2 = 0 then 'a' else 'b' end").count() == 0


def test_rows_of_one_key_stay_apart(layer):
    one_key = layer.withColumn("id", F.lit(None).cast("int"))
    count = X.index_uniform(layer, 7, "id").count()
    assert X.index_uniform(one_key, 7, "id").count() == X.polyfill(one_key, 7, "id").count() == count


def test_area_by_sampling(spark, layer):
    """Shares against a fine lattice of points, a way that knows nothing of clipping."""
    r, n = 7, 400
    rows = X.overlap_area(layer, r, "id").collect()
    picks = random.Random(4).sample(rows, 12)
    for k, cell, area in picks:
        ring = spark.createDataFrame([(cell,)], "cell bigint").select(G.boundary("cell")).first()[0]
        bx, by = np.array([p.x for p in ring]), np.array([p.y for p in ring])
        gx, gy = np.meshgrid(np.linspace(bx.min(), bx.max(), n), np.linspace(by.min(), by.max(), n))
        hexagon = covered([[list(zip(bx[:-1], by[:-1]))]], gx.ravel(), gy.ravel())
        both = hexagon & covered(SHAPES[k], gx.ravel(), gy.ravel())
        assert area / G.cell_area_m2(r) == pytest.approx(both.sum() / hexagon.sum(), abs=0.01)


def test_clipped_rings_add_up(layer):
    rows = X.clip_to_cells(layer, 8, "id").collect()
    sums = {}
    for r in rows:
        sums[r.id] = sums.get(r.id, 0) + (-1 if r.hole else 1) * area_of([(p.x, p.y) for p in r.ring])
    assert sums == {k: pytest.approx(total(s), rel=1e-6) for k, s in SHAPES.items()}


def test_stages_do_not_matter(layer, monkeypatch):
    want = {(r.id, r.cell): r.area for r in X.overlap_area(layer, 9, "id").collect()}
    monkeypatch.setattr(R, "LEVELS_PER_STAGE", 1)
    monkeypatch.setattr(R, "MAX_POINTS", 50)
    got = {(r.id, r.cell): r.area for r in X.overlap_area(layer, 9, "id").collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-4) for k in got)


def test_cells_are_never_broadcast(layer):
    """Their number is not known before they are cut, so the join with the attributes shuffles both sides."""
    for out in (X.polyfill(layer, 8, "id"), X.index_uniform(layer, 8, "id"), X.overlap_area(layer, 8, "id")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_batches_are_cut_by_points():
    sizes = [5, 7, R.MAX_POINTS, 3, 2 * R.MAX_POINTS, 4, *[1000] * 100]
    values = [np.arange(n, dtype=float) for n in sizes]
    batch = pa.RecordBatch.from_pydict({"xs": pa.array(values, pa.list_(pa.float64())), "ys": pa.array(values, pa.list_(pa.float64()))})
    parts = list(R._slices(batch.slice(1)))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch.slice(1)]))
    assert all(p.num_rows == 1 or len(R._points(p)[0]) <= R.MAX_POINTS for p in parts) and len(parts) < 10
    assert all(R._points(p)[2][-1] == len(R._points(p)[0]) for p in parts) and not list(R._slices(batch.slice(0, 0)))


def recursive_partition(share, start, tx, lo, hi, tx_spatial):
    out, level = {}, sorted(start)
    for r in range(lo, hi + 1):
        following = []
        for cell in level:
            s = share(r).get(cell, {})
            top = max(s.items(), key=lambda kv: (round(kv[1], 9), -ord(kv[0])), default=(None, 0))
            if r < hi:
                if sum(s.values()) < 1 - tx[r] - 1e-9:
                    continue
                if top[1] >= tx[r] - 1e-9:
                    out[cell] = top[0]
                else:
                    following += plain.children(cell)
            elif top[1] > 0 and sum(s.values()) >= tx_spatial:
                out[cell] = top[0]
        level = following
    return out


def test_adaptive_partition_by_recursion(spark, layer):
    apart = layer.filter("id <> 4")  # these do not overlap
    tx, lo, hi = C.thresholds(7), 6, 9
    tx = [*tx[:7], 0.9, 0.9, *tx[9:]]
    tables = {}

    def share(r):
        if r not in tables:
            tables[r] = {}
            for row in X.class_share(apart, "cls", r).collect():
                tables[r].setdefault(row.cell, {})[row.cls] = row.share
        return tables[r]

    start = {r.cell for r in X.mesh(apart, lo).collect()}
    want = recursive_partition(share, start, tx, lo, hi, 0.5)
    got = {r.cell: r.cls for r in X.index_adaptive_partition(apart, "cls", tx, lo, hi).collect()}
    assert got == want and {plain.res(c) for c in got} >= {8, 9}
    # No cell and its ancestor are both valid, and every cell lies below the mesh.
    assert not any(plain.parent(c, r) in got for c in got for r in range(lo, plain.res(c)))
    assert all(plain.parent(c, lo) in start for c in got)
    one = next(iter({plain.parent(c, lo) for c in got}))
    some = X.index_adaptive_partition(apart, "cls", tx, lo, hi, mesh_cells=spark.createDataFrame([(one,)], "cell bigint"))
    assert {r.cell for r in some.collect()} == {c for c in got if plain.parent(c, lo) == one}


def test_a_class_needs_cover(layer):
    cells = X.index_adaptive_partition(layer.filter("id = 1"), "cls", C.thresholds(7), 7, 7, tx_spatial=0.0)
    shares = {r.cell for r in X.class_share(layer.filter("id = 1"), "cls", 7).collect()}
    assert {r.cell for r in cells.collect()} <= shares


@pytest.mark.parametrize("fast", [False, True])
def test_adaptive_objects_by_recursion(layer, fast):
    tx, lo, hi = [0.9] * 16, 6, 9
    areas, wide = {}, {}
    for r in range(lo, hi + 1):
        pieces = R.cut(layer.select("id", "geometry"), ["id"], r, fragments=False)
        for row in pieces.groupBy("id", "cell").agg(F.sum(F.col("sign") * F.col("area")), F.sum(F.col("sign") * F.col("area_wide"))).collect():
            areas[row[0], row[1]], wide[row[0], row[1]] = row[2], row[3]
    want = set()
    for k in SHAPES:
        level = {c for i, c in areas if i == k and plain.res(c) == lo}
        for r in range(lo, hi + 1):
            following = set()
            for c in level:
                a, b = areas.get((k, c), 0), wide.get((k, c), 0)
                if (a if fast else b) <= 1e-12 * G.cell_area_m2(r):
                    continue
                if a / G.cell_area_m2(r) >= (0.5 if r == hi else tx[r]) - 1e-9:
                    want.add((k, c))
                elif r < hi:
                    following |= set(plain.children(c))
            level = following
    got = X.index_adaptive_objects(layer, "id", tx, lo, hi, fast)
    assert got.columns == ["cell", "id", "cls"] and tx == [0.9] * 16
    assert {(r.id, r.cell) for r in got.collect()} == want
    # Objects 3 and 4 overlap, so some cells occur for both.
    assert {c for k, c in want if k == 3} & {c for k, c in want if k == 4}


def test_only_one_level_stays_on_disk(spark, layer):
    """The last level is never stored, and a stored one goes once the next is there."""
    for build in (lambda: X.index_adaptive_objects(layer, "id", [0.9] * 16, 6, 9), lambda: X.index_adaptive_partition(layer, "cls", [0.9] * 16, 6, 9)):
        before = set(folders.subfolders(spark, shared_dir(spark)))
        out = build()
        levels = [f for f in folders.subfolders(spark, shared_dir(spark)) if f not in before and f.startswith("level-")]
        assert [r.level for r in spark.read.parquet(f"{shared_dir(spark)}/{levels[0]}").select("level").distinct().collect()] == [8] and len(levels) == 1
        assert out.count() == out.count() > 0


def test_cells_are_settled_in_one_task(spark, layer, monkeypatch):
    """Once there are cells enough, nothing below them is stored; a cell with too many points goes on level by level.  Either way gives the same."""
    bare = layer.withColumn("cls", F.when(F.col("id") != 4, F.col("cls")))  # a polygon without a class
    builds = {
        "objects": lambda: X.index_adaptive_objects(layer, "id", [0.9] * 16, 6, 9),
        "fast": lambda: X.index_adaptive_objects(layer, "id", [0.9] * 16, 6, 9, fast=True),
        "partition": lambda: X.index_adaptive_partition(bare, "cls", [0.9] * 16, 6, 9),
    }
    want = {k: sorted(map(tuple, build().collect())) for k, build in builds.items()}
    for points, stored in ((1 << 18, 1), (30, 3)):
        monkeypatch.setattr(X, "GROUPS_PER_TASK", 0, raising=False)
        monkeypatch.setattr(X, "GROUP_POINTS", points, raising=False)
        for k, build in builds.items():
            before = set(folders.subfolders(spark, shared_dir(spark)))
            out = build()
            levels = [f for f in folders.subfolders(spark, shared_dir(spark)) if f not in before and f.startswith("level-")]
            found = {r.level for f in levels for r in spark.read.parquet(f"{shared_dir(spark)}/{f}").select("level").distinct().collect()}
            assert 6 in found and 1 <= len(levels) <= stored and (stored > 1 or found == {6})
            assert len(want[k]) > 0 and sorted(map(tuple, out.collect())) == want[k]


def test_wide_area_by_sampling(spark, layer):
    """The margin is a hexagon widened by a tenth of sqrt(area)."""
    r, n = 7, 400
    half = G.spacing(r) / 2 + 0.1 * math.sqrt(G.cell_area_m2(r))
    rows = R.cut(layer.select("id", "geometry"), ["id"], r, fragments=False)
    rows = rows.groupBy("id", "cell").agg(F.first("cx"), F.first("cy"), F.sum(F.col("sign") * F.col("area_wide"))).collect()
    for k, _, cx, cy, area in random.Random(2).sample(rows, 10):
        gx, gy = np.meshgrid(np.linspace(-1.2, 1.2, n) * half, np.linspace(-1.2, 1.2, n) * half)
        inside = np.ones(gx.shape, bool)
        for side in range(6):
            a = G.turn(r) + side * math.pi / 3
            inside &= gx * math.cos(a) + gy * math.sin(a) <= half
        both = inside.ravel() & covered(SHAPES[k], gx.ravel() + cx, gy.ravel() + cy)
        assert area == pytest.approx(both.sum() * (2.4 * half / (n - 1)) ** 2, abs=0.01 * G.cell_area_m2(r))


@pytest.mark.parametrize("box, want", [
    ((0, 0, 1, 1), []), ((501200, 201200, 501500, 201500), []), ((500100, 200100, 500200, 200200), [1]),
    ((512000, 203000, 512100, 203100), []), ((511900, 200100, 512000, 200200), [2]), ((0, 0, 1e6, 1e6), [1, 2, 3, 4]),
    ((502900, 203900, 503100, 204100), [1]), ((500500, 199000, 500600, 205000), [1]),
])
def test_box(layer, box, want):
    assert sorted(r.id for r in X.in_box(layer, *box).collect()) == want


def test_geom_view(spark):
    cells = spark.createDataFrame([(plain.make(20, [1, i]), i) for i in range(6)], "cell bigint, n int")
    rows = X.geom_view(cells).orderBy("id").collect()
    assert [r.id for r in rows] == list(range(1, 7)) and all(len(r.geometry) == 7 for r in rows)
    assert [r.cell for r in rows] == sorted(r.cell for r in rows)


def square(x, y, side):
    return [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]


def frame(spark, shapes):
    return spark.createDataFrame([(k, "c", None if shape is None else floats(shape)) for k, shape in shapes.items()], f"id int, cls string, geometry {GEOMETRY}")


def test_oversize_ring_keeps_its_area(spark):
    """Wider than a base cell: it starts at all base cells that its extent meets."""
    big = square(-3_600_000, -3_700_000, 8_000_000)
    hollow = [big, square(-1_000_000, -1_000_000, 3_000_000)]
    df = frame(spark, {1: [[big]], 2: [hollow], 3: [[SQUARE, HOLE]]})
    want = {1: 64e12, 2: 55e12, 3: total([[SQUARE, HOLE]])}
    for r in (0, 1, 2):
        got = {k: a for k, a in X.overlap_area(df, r, "id").groupBy("id").agg(F.sum("area")).collect()}
        assert got == {k: pytest.approx(a, rel=1e-9) for k, a in want.items()}
    cells = {r.id: r.n for r in X.polyfill(df, 2, "id").groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert cells[1] == pytest.approx(64e12 / G.cell_area_m2(2), rel=0.05) and cells[2] == pytest.approx(55e12 / G.cell_area_m2(2), rel=0.05)


def test_polygons_off_the_grid_are_reported(spark):
    far = square(3e7, 3e7, 40_000)
    edge_x, edge_y = G.axial_to_metres(4, 0, 0)
    edge = square(G.ORIGIN[0] + edge_x, G.ORIGIN[1] + edge_y, 4_000_000)
    nan, inf = float("nan"), float("inf")
    shapes = {1: [[SQUARE, HOLE]], 2: [[far]], 3: [[edge]], 4: [[SQUARE], [far]], 5: None, 6: [], 7: [[]], 8: [[SQUARE[:2]]], 9: [[[(0, 0), (1, 1), (2, 2), (0, 0)]]],
              10: [[[(0, 0), (nan, 1), (1, 1), (0, 0)]]], 11: [[[(0, 0), (inf, 1), (1, 1), (0, 0)]]], 12: [[square(1e300, 1e300, 1e299)]], 13: [[square(-1e16, 3, 1000)]]}
    df = frame(spark, shapes)
    for index in (lambda **k: X.overlap_area(df, 3, "id", **k), lambda **k: X.index_uniform(df, 3, "id", **k), lambda **k: X.mesh(df, 3, **k),
                  lambda **k: X.index_adaptive_objects(df, "id", [0.9] * 16, 2, 3, **k)):
        with pytest.raises(R.OffGrid, match="off grid"):
            index()
        rejects = R.Rejects()
        assert index(rejects=rejects).count() > 0
        told = {(r.id, r.polygon, r.ring, r.reason): r for r in rejects.table.collect()}
        assert set(told) == {(2, 0, 0, "off grid"), (3, 0, 0, "partly off grid"), (4, 1, 0, "off grid"), (5, None, None, "no geometry"), (6, None, None, "no geometry"), (7, 0, None, "no geometry"),
                             (8, 0, 0, "few points"), (9, 0, 0, "no area"), (10, 0, 0, "not finite"), (11, 0, 0, "not finite"), (12, 0, 0, "not finite"), (13, 0, 0, "off grid")}
        assert rejects.count == len(told)
    rejects = R.Rejects()
    areas = {r.id: r.area for r in X.overlap_area(df, 3, "id", rejects=rejects).groupBy("id").agg(F.sum("area").alias("area")).collect()}
    outside = {r.id: r.outside for r in rejects.table.filter("outside is not null").collect()}
    assert set(areas) == {1, 3, 4} and areas[3] + outside[3] == pytest.approx(16e12, rel=1e-9) and outside[2] == pytest.approx(1.6e9, rel=1e-9)
    assert areas[4] == pytest.approx(area_of(SQUARE), rel=1e-9)


def test_clean_layers_need_no_second_look(spark, layer, monkeypatch):
    def never(*_):
        raise AssertionError

    monkeypatch.setattr(R, "_rejected", never)
    assert X.overlap_area(layer, 7, "id").count() > 0


def test_placement_equals_the_column_functions(spark):
    """Ids made in NumPy are those of the column functions, also beyond the base cells."""
    rng = np.random.default_rng(0)
    i, j, level = rng.integers(-40_000, 40_000, 600), rng.integers(-40_000, 40_000, 600), rng.integers(0, 16, 600)
    i[:200], j[:200], level[:200] = i[:200] % 9 - 4, j[:200] % 9 - 4, level[:200] % 4
    df = spark.createDataFrame([tuple(map(int, r)) for r in zip(range(600), i, j, level)], "n int, i bigint, j bigint, level int")
    rows = df.select("n", G.encode(F.struct("i", "j"), F.col("level")).alias("cell")).orderBy("n").collect()
    got = R.encode(i, j, level)
    assert [R.NO_CELL if r.cell is None else r.cell for r in rows] == got.tolist() and (got == R.NO_CELL).any() and (got != R.NO_CELL).sum() > 200


def test_polygons_of_one_key_keep_their_areas(spark, layer):
    """Two rows of one key, equal or not, are two polygons; so are rows without a key."""
    twice = layer.select("id", "geometry").unionByName(layer.select("id", "geometry"))
    once = sorted(r.area for r in X.overlap_area(layer, 7, "id").collect())
    for df in (twice, twice.withColumn("id", F.lit(None).cast("int"))):
        assert sorted(r.area for r in X.overlap_area(df, 7, "id").collect()) == pytest.approx(sorted(once * 2))

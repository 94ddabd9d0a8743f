import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from hexmart.functions import cells as C
from hexmart.functions import grid as G
from hexmart.functions.boxes import Box, cells_in_box
from hexmart.plans import indexing as X
from hexmart.session import fresh_path
from hexmart.sources.sinks import cluster_by_cell
from tests import plain
from tests.test_indexing import GEOMETRY, square

BOXES = [Box(450_000, 250_000, 470_000, 262_000), Box(300_000, 100_000, 900_000, 130_000), Box(500_000, 300_000, 500_001, 300_001), Box(-9e6, -9e6, 9e6, 9e6), Box(3e8, 3e8, 4e8, 4e8)]


@pytest.fixture(scope="module")
def cells(spark):
    """Cells of mixed levels over some 600 km, with their boundaries."""
    points = spark.range(12_000).select((300_000 + F.rand(1) * 600_000).alias("x"), (100_000 + F.rand(2) * 400_000).alias("y"), (F.col("id") % 4 + 5).cast("int").alias("r"))
    return points.select(G.cell_at(F.col("x"), F.col("y"), F.col("r")).alias("cell")).distinct().withColumn("ring", G.boundary("cell")).cache()


def separated(ring, box):
    """Whether some edge of the ring or of the box has both shapes on different sides."""
    p = np.array(ring[:-1])
    q = np.array([(box.xmin, box.ymin), (box.xmax, box.ymin), (box.xmax, box.ymax), (box.xmin, box.ymax)])
    for shape in (p, q):
        for a, b in zip(shape, np.roll(shape, -1, axis=0)):
            normal = np.array([b[1] - a[1], a[0] - b[0]])
            u, v = p @ normal, q @ normal
            if u.max() < v.min() or v.max() < u.min():
                return True
    return False


@pytest.mark.parametrize("box", BOXES)
def test_box_finds_the_cells_that_meet_it(cells, box):
    want = {r.cell for r in cells.collect() if not separated([(p.x, p.y) for p in r.ring], box)}
    for most in (1, 20, 200):
        assert {r.cell for r in cells_in_box(cells, box, 5, 8, most=most).collect()} == want


def test_ranges_are_few_and_hold_whole_families():
    rng = random.Random(3)
    for box in BOXES[:4]:
        for most in (7, 40):
            cover = box.cover(9, most)
            assert len(cover) <= max(most, len(G.BASE_CELLS))
            assert len(box.ranges(7, 9, most)) <= sum(len(box.cover(r, most)) for r in (7, 8, 9))
    cover = BOXES[0].cover(10, 40)
    ranges = BOXES[0].ranges(10, 10, 40)
    inside = lambda c: any(low <= c <= high for low, high in ranges)
    for cell in cover:
        below = plain.make(plain.base(cell), plain.digits(cell) + [rng.randrange(7) for _ in range(10 - plain.res(cell))])
        assert inside(below)
    other = [plain.make(20, [rng.randrange(7) for _ in range(10)]) for _ in range(200)]
    assert [inside(c) for c in other] == [any(plain.parent(c, plain.res(k)) == k for k in cover) for c in other]


def test_a_box_skips_files(spark):
    """On a table laid out by cell the filter reaches the scan, and few files can hold rows of the box."""
    points = spark.range(40_000).select((300_000 + F.rand(5) * 600_000).alias("x"), (100_000 + F.rand(6) * 400_000).alias("y"))
    path = fresh_path(spark, "cells")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cluster_by_cell(points.select(G.cell_at(F.col("x"), F.col("y"), 9).alias("cell"))).write.parquet(path)
        spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    stored, box = spark.read.parquet(path), BOXES[0]
    found = cells_in_box(stored, box, 9, 9)
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(cell," in pushed and "LessThanOrEqual(cell," in pushed
    ranges = box.ranges(9, 9)
    files = [f.removeprefix("file:") for f in stored.inputFiles()]
    stats = [pq.read_metadata(f).row_group(0).column(0).statistics for f in files]
    hit = sum(any(low <= s.max and s.min <= high for low, high in ranges) for s in stats)
    assert len(files) == 40 and 1 <= hit <= 6
    assert found.count() == stored.filter(box.meets("cell")).count() > 0


def test_stored_layer_is_pruned_by_extents(spark):
    rows = [(i, [[[(float(x), float(y)) for x, y in square(300_000 + i % 60 * 10_000, 100_000 + i // 60 * 10_000, 4_000)]]]) for i in range(2400)]
    df = spark.createDataFrame(rows, f"id int, geometry {GEOMETRY}")
    path = fresh_path(spark, "layer")
    X.store_layer(df, path)
    stored = spark.read.parquet(path)
    box = (452_000, 252_000, 471_000, 262_000)
    found = X.layer_in_box(stored, *box)
    assert found.columns == ["id", "geometry"]
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in X.in_box(df, *box).collect()) != []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(xmin," in plan and "GreaterThanOrEqual(ymax," in plan
    assert C.MAX_RES == 15

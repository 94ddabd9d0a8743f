import random

import pytest
from pyspark.sql import functions as F

from hexmart.functions import cells as C
from hexmart.functions import grid as G
from hexmart.functions import projection as P
from tests import plain


def frame(spark, cells):
    return spark.createDataFrame([(c,) for c in cells], "cell bigint")


def sample(n=60, deepest=9, seed=3):
    rng = random.Random(seed)
    bases = [20, 4, 14, 0, 121]
    picks = {plain.make(rng.choice(bases), [rng.choice([0, 0, *range(7)]) for _ in range(rng.randint(0, deepest))]) for _ in range(n)}
    # Digit 1 right after leading zeros does not exist below a pentagon.
    return sorted(c for c in picks if not (plain.base(c) in plain.PENTAGONS and next((d for d in plain.digits(c) if d), 0) == 1))


def test_documented_cell(spark):
    row = spark.createDataFrame([("8928308280fffff",)], "h string").select(
        C.resolution(C.to_cell("h")), C.to_hex(C.parent(C.to_cell("h"), 8)), C.to_hex(C.to_cell("h"))
    ).first()
    assert tuple(row) == (9, "8828308281fffff", "8928308280fffff")


def test_parent_and_resolution(spark):
    cells = sample()
    got = frame(spark, cells).select("cell", C.resolution("cell"), C.parent("cell", F.floor(C.resolution("cell") / 2).cast("int"))).collect()
    for c, r, p in got:
        assert r == plain.res(c) and p == plain.parent(c, r // 2)


@pytest.mark.parametrize("r", [0, 3, 5])
def test_children_at(spark, r):
    cells = [c for c in sample() if plain.res(c) >= r - 5]
    for c, kids in frame(spark, cells).select("cell", C.children("cell", r)).collect():
        assert kids == plain.descendants(c, r)


def test_direct_children(spark):
    for c, kids in frame(spark, sample()).select("cell", C.children("cell")).collect():
        assert kids == plain.children(c)


def test_stepwise_children_equal_the_arrays(spark):
    cells = [c for c in sample() if 1 <= plain.res(c) <= 7]
    got = C.explode_children(frame(spark, cells), "cell", 6, "kid", step=2).groupBy("cell").agg(F.sort_array(F.collect_list("kid"))).collect()
    assert {c: k for c, k in got} == {c: sorted(plain.descendants(c, 6)) for c in cells if plain.res(c) <= 6}


@pytest.mark.parametrize("known", [False, True])
def test_normalize(spark, known):
    cells = [c for c in sample() if not known or plain.res(c) >= 4]
    got = C.normalize(frame(spark, cells), "cell", 4, "at", *((4, 9) if known else ())).select("cell", "at").collect()
    want = [(c, k) for c in cells for k in ([plain.parent(c, 4)] if plain.res(c) >= 4 else plain.descendants(c, 4))]
    assert sorted(map(tuple, got)) == sorted(want)


def test_thresholds():
    tx = C.thresholds(7)
    assert [round(t, 6) for t in tx[6:13]] == [0.999999, 0.999991, 0.999934, 0.999535, 0.996744, 0.977205, 0.840443]
    assert tx[13:] == [0, 0, 0] and all(t > 0.9999998 - 1e-7 for t in tx[:6])


def test_grid_round_trip(spark):
    points = spark.range(2000).select(
        ((F.rand(1) - 0.5) * 4e6).alias("x"), ((F.rand(2) - 0.5) * 4e6).alias("y"), (F.col("id") % 16).cast("int").alias("r")
    )
    cells = points.withColumn("cell", G.cell_at(F.col("x"), F.col("y"), F.col("r")))
    x, y = G.centre("cell")
    far = F.hypot(F.col("x") - x, F.col("y") - y)
    radius = F.get(F.array(*[F.lit(G.spacing(r) / 3**0.5) for r in range(16)]), F.col("r"))
    bad = cells.filter((C.resolution("cell") != F.col("r")) | (far > radius * 1.000001) | C.is_pentagon("cell"))
    assert cells.filter("cell is null").count() == 0 and bad.count() == 0
    again = cells.withColumn("x", x).withColumn("y", y).filter(G.cell_at(F.col("x"), F.col("y"), F.col("r")) != F.col("cell"))
    assert again.count() == 0


def test_boundary_has_the_cell_area(spark):
    cells = spark.createDataFrame([(5e5, 2e5, r) for r in range(3, 14)], "x double, y double, r int")
    rings = cells.select("r", G.boundary(G.cell_at(F.col("x"), F.col("y"), F.col("r"))).alias("b")).collect()
    for r, ring in rings:
        x0, y0 = ring[0]
        area = sum((a.x - x0) * (b.y - y0) - (b.x - x0) * (a.y - y0) for a, b in zip(ring, ring[1:])) / 2
        assert ring[0] == ring[-1] and area == pytest.approx(G.cell_area_m2(r), rel=1e-6)
        if r < 12:
            assert area / 1e6 == pytest.approx(C.MEAN_AREA_KM2[r], rel=1e-3)


def test_projection(spark):
    box = spark.createDataFrame([(536159.0, 156515.0), (571819.0, 190058.0), (400000.0, 300000.0)], "x double, y double")
    lon, lat = P.to_lonlat(F.col("x"), F.col("y"))
    there = box.withColumn("lon", lon).withColumn("lat", lat)
    x, y = P.to_plane(F.col("lon"), F.col("lat"))
    rows = there.select("x", "y", "lon", "lat", x, y).collect()
    for r in rows:
        assert r[4] == pytest.approx(r[0], abs=1e-6) and r[5] == pytest.approx(r[1], abs=1e-6)
    assert (round(rows[0].lon, 2), round(rows[0].lat, 2)) == (167.33, -22.79)
    assert (rows[2].lon, rows[2].lat) == (166.0, pytest.approx(-21.5))

"""The cell index against comparing whole shapes."""

from __future__ import annotations

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shockline.functions import geo
from shockline.operators import cells, geography


def ring(r, cx, cy, radius, n, snap):
    """A star-like ring; with snap its points fall on a grid, so that shapes touch in points and along edges."""
    t = np.sort(r.random(n)) * 2 * math.pi
    d = radius * (0.4 + 0.6 * r.random(n))
    pts = [[float(cx + a * math.cos(x)), float(cy + a * math.sin(x))] for a, x in zip(d, t, strict=True)]
    pts = [[round(x * 4) / 4, round(y * 4) / 4] for x, y in pts] if snap else pts
    return [*pts, pts[0]]


def shapes(seed, n):
    r = np.random.default_rng(seed)
    out = []
    for k in range(n):
        cx, cy, radius = *(r.random(2) * 12 - 6), float(r.choice([0.1, 0.7, 3, 9]))
        kind = k % 5
        if kind == 0:
            p = [round(cx * 4) / 4, round(cy * 4) / 4]
            out.append({"type": "Point", "coordinates": p})
        elif kind == 1:
            out.append({"type": "MultiPolygon", "coordinates": [[ring(r, cx, cy, radius, 9, True)], [ring(r, cx + 3, cy, 1, 5, False)]]})
        else:
            rings = [ring(r, cx, cy, radius, int(r.integers(3, 30)), kind == 2)]
            if kind == 3:
                rings.append([[cx + (x - cx) * 0.3, cy + (y - cy) * 0.3] for x, y in rings[0]])
            out.append({"type": "Polygon", "coordinates": rings})
    return out


def frame(spark, made, name):
    rows = spark.createDataFrame([(k, json.dumps(s)) for k, s in enumerate(made)], f"{name} int, g string")
    return rows.select(name, geo.parse_geojson("g").alias("geometry"))


@pytest.mark.parametrize("size", [0.5, 0.04])
def test_pairs_equal_comparing_all(spark, size):
    a, b = frame(spark, shapes(1, 60), "a"), frame(spark, shapes(2, 60), "b")
    want = sorted(a.withColumnRenamed("geometry", "x").join(b.withColumnRenamed("geometry", "y"), geo.intersects(F.col("x"), F.col("y"))).select("a", "b").collect())
    got = sorted(geography.spatial_pairs(a, b, "a", "b", size).collect())
    assert len(want) > 400 and got == want


@pytest.mark.parametrize("size", [0.5, 0.04])
def test_points_equal_whole_shapes(spark, size):
    a = frame(spark, shapes(3, 40), "a")
    r = np.random.default_rng(5)
    spots = np.concatenate([r.random((500, 2)) * 16 - 8, np.round((r.random((500, 2)) * 16 - 8) * 4) / 4])
    points = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(spots)], "point_id int, lon double, lat double")
    inside = F.exists("geometry", lambda p: geo.in_rings(F.col("lon"), F.col("lat"), p))
    want = {r.point_id: r["n"] for r in points.join(a, inside).groupBy("point_id").agg(F.count("*").alias("n")).collect()}
    areas = a.select(F.concat(F.lit("d"), "a").alias("district_id"), F.lit("s").alias("state_id"), F.lit("v").alias("boundary_version"), "geometry")
    got = {r.point_id: r.mapping_status for r in geography.locate_points(points, areas, size=size).collect()}
    status = {k: "ambiguous" if want.get(k, 0) > 1 else "point_in_polygon" if want.get(k) else "unresolved" for k in range(len(spots))}
    assert len(set(status.values())) == 3 and got == status


def circle(n, radius, cx=0.0, cy=0.0):
    return [[[[cx + radius * math.cos(2 * math.pi * k / n), cy + radius * math.sin(2 * math.pi * k / n)] for k in range(n)]]]


def test_work_is_linear_in_edges_and_cells_are_bounded():
    def size(n, radius):
        rows = list(cells.cell_rows(circle(n, radius), cells.CELL))
        own = [r for r in rows if r[0]]
        most = max(len(p["edges"]) for r in own for p in r[4])
        return len(own), sum(len(p["edges"]) for r in own for p in r[4]), most

    few, many = size(2000, 7), size(20_000, 7)
    assert few[0] == many[0] and many[1] < 11 * few[1] and many[1] < 1.2 * 20_000 and many[2] < 20_000 / 20
    for radius in (0.01, 3, 40, 900, 1e7, 1e300):
        assert size(100, radius)[0] <= 1.3 * cells.MOST
    assert list(cells.cell_rows([[[[math.inf, 0.0], [1.0, 1.0]]]], 0.5)) == [] and list(cells.cell_rows([], 0.5)) == []


def test_shapes_of_many_points(spark):
    """Circles of 30,000 points: two that cross, one inside of another, two apart."""
    made = [(0, circle(30_000, 5.0)), (1, circle(30_000, 5.0, 9.0)), (2, circle(3000, 0.5, 0.5, 0.5)), (3, circle(3000, 2.0, 30.0))]
    rows = spark.createDataFrame(made, "a int, geometry array<array<array<array<double>>>>")
    got = geography.spatial_pairs(rows, rows.withColumnRenamed("a", "b"), "a", "b").where("a < b").collect()
    assert sorted(tuple(r) for r in got) == [(0, 1), (0, 2)]


def test_broadcasts_are_checked_by_bytes(spark):
    rows = spark.range(10).withColumn("text", F.repeat(F.lit("x"), F.lit(1000)))
    plan = lambda df: df._jdf.queryExecution().logical().toString()
    assert "Hint broadcast" in plan(geography.small(rows)) and "Hint broadcast" not in plan(geography.small(rows, most_bytes=5000)) and "Hint broadcast" not in plan(geography.small(rows, most=9))


def test_equal_shapes_are_compared_once(spark, monkeypatch):
    """Forty ids with two shapes, one id with both of them and one without any: the index has each shape once, and each pair comes once."""
    x, y = circle(12, 1.0), circle(12, 1.0, 1.5)
    made = [(k, (x, y)[k % 2]) for k in range(40)] + [(100, x), (100, y), (101, None)]
    rows = spark.createDataFrame(made, "a int, geometry array<array<array<array<double>>>>")
    counted, kept = [], cells.indexed
    monkeypatch.setattr(cells, "indexed", lambda df, *args, **named: counted.append(df.count()) or kept(df, *args, **named))
    got = [tuple(r) for r in geography.spatial_pairs(rows, rows.withColumnRenamed("a", "b"), "a", "b").collect()]
    ids = [*range(40), 100]
    assert sorted(got) == [(i, j) for i in ids for j in ids] and counted == [2, 2]
    shape = '{"type":"Point","coordinates":[0.5,0.5]}'
    floods = spark.createDataFrame([(str(k), shape if k % 4 else "{") for k in range(40)], "event_id string, geometry_json string").selectExpr("*", "timestamp'2024-01-01' as event_time", "'s' as source_event_id")
    areas = spark.createDataFrame([("d", '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,1],[0,0]]]}')], "district_id string, geometry_json string")
    counted.clear()
    met = geography.geometry_flood_shocks(floods, areas).collect()
    assert sorted(r.shock_id for r in met) == sorted(str(k) for k in range(40) if k % 4) and counted == [1, 1]

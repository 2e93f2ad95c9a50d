from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shockline.functions import geo
from shockline.operators import geography

SQUARE = [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]
HOLED = [SQUARE[0], [[1, 1], [3, 1], [3, 3], [1, 3], [1, 1]]]


def poly(rings):
    return json.dumps({"type": "Polygon", "coordinates": rings})


def point(x, y):
    return json.dumps({"type": "Point", "coordinates": [x, y]})


def shifted(rings, dx, dy=0):
    return [[[x + dx, y + dy] for x, y in r] for r in rings]


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [
        (poly(SQUARE), poly(shifted(SQUARE, 2)), True), (poly(SQUARE), poly(shifted(SQUARE, 4)), True), (poly(SQUARE), poly(shifted(SQUARE, 4, 4)), True), (poly(SQUARE), poly(shifted(SQUARE, 5)), False),
        (poly(SQUARE), poly([[[1, 1], [2, 1], [2, 2], [1, 1]]]), True), (poly(HOLED), poly([[[1.5, 1.5], [2, 1.5], [2, 2], [1.5, 1.5]]]), False), (poly(HOLED), point(2, 2), False),
        (poly(HOLED), point(1, 2), True), (poly(SQUARE), point(2, 2), True), (poly(SQUARE), point(4, 2), True), (poly(SQUARE), point(4, 4), True), (point(1, 1), point(1, 1), True), (point(1, 1), point(1, 2), False),
        (json.dumps({"type": "MultiPolygon", "coordinates": [shifted(SQUARE, 50), SQUARE]}), point(1, 1), True), (json.dumps({"type": "MultiPoint", "coordinates": [[9, 9], [2, 2]]}), poly(SQUARE), True),
        (poly([[[-1, 1], [5, 1], [5, 2], [-1, 2], [-1, 1]]]), poly(SQUARE), True),
    ],
)
def test_intersects_both_ways(spark, a, b, want):
    g = lambda s: geo.parse_geojson(F.lit(s))
    r = spark.range(1).select(geo.intersects(g(a), g(b)).alias("x"), geo.intersects(g(b), g(a)).alias("y")).first()
    assert (r.x, r.y) == (want, want)


@pytest.mark.parametrize("text", ["", "{", '{"type":"Blob"}', '{"type":"Point"}', '{"type":"Polygon","coordinates":[]}', '{"type":"Point","coordinates":["a"]}', None])
def test_bad_shapes_are_null(spark, text):
    assert spark.range(1).select(geo.parse_geojson(F.lit(text).cast("string")).alias("g")).first().g is None


def test_projection_origin_and_round_trip(spark):
    r = spark.range(1).select(geo.ConicIndia().inverse(F.lit(4_000_000.0), F.lit(4_000_000.0)).alias("g")).first().g
    assert abs(r.lon - 80) < 1e-10 and abs(r.lat - 24) < 1e-10
    r = spark.range(1).select(geo.ConicIndia().inverse(F.lit(3_800_000.0), F.lit(3_000_000.0)).alias("g")).first().g
    assert 77 < r.lon < 79 and 14 < r.lat < 16
    assert spark.range(1).select(geo.ConicIndia().inverse(F.lit(float("nan")), F.lit(0.0)).alias("g")).first().g is None


def test_points_in_areas(spark):
    rings = [[[73, 19], [75, 19], [75, 21], [73, 21], [73, 19]]]
    area = spark.createDataFrame([("d", "s", "v1", poly(rings))], "district_id string, state_id string, boundary_version string, g string").withColumn("geometry", geo.parse_geojson("g")).drop("g")
    pts = spark.createDataFrame([(1, 74.0, 20.0), (2, 80.0, 20.0), (3, 73.0, 20.0), (4, 75.0, 20.0)], "point_id int, lon double, lat double")
    got = {r.point_id: (r.mapping_status, r.district_id) for r in geography.locate_points(pts, area).collect()}
    assert got == {1: ("point_in_polygon", "d"), 2: ("unresolved", None), 3: ("point_in_polygon", "d"), 4: ("unresolved", None)}
    twice = area.unionByName(area.withColumn("district_id", F.lit("d2")))
    assert geography.locate_points(pts, twice).where("point_id = 1").first().mapping_status == "ambiguous"


@pytest.fixture
def bounds(spark):
    return spark.createDataFrame([("d1", "s", "North", poly(SQUARE)), ("d2", "s", "South", poly(shifted(SQUARE, 10)))], "district_id string, source_state string, source_district string, geometry_json string")


def floods(spark):
    t = dt.datetime(2024, 6, 29)
    rows = [("a", t, "1", None, point(2, 2), None, None), ("b", t, "2", None, point(90, 9), None, None), ("c", t, "3", None, None, None, None), ("d", t, "4", None, "{bad", None, None), ("e", t, "5", "2024-06-01T00:00:00Z", None, " S ", "north"), ("f", t, "6", None, None, "s", "elsewhere"), ("g", t, "7", None, poly([[[3, 1], [12, 1], [12, 2], [3, 2], [3, 1]]]), None, None)]
    return spark.createDataFrame(rows, "event_id string, event_time timestamp, source_event_id string, event_start string, geometry_json string, reported_state string, reported_district string")


def test_each_flood_is_a_shock_or_unresolved(spark, bounds):
    f = floods(spark)
    shocks = geography.geometry_flood_shocks(f, bounds).unionByName(geography.reported_flood_shocks(f, bounds)).collect()
    assert sorted((s.shock_id, s.district_id) for s in shocks) == [("a", "d1"), ("e", "d1"), ("g", "d1"), ("g", "d2")]
    assert next(s for s in shocks if s.shock_id == "e").shock_time == dt.datetime(2024, 6, 1)
    left = {r.event_id: r.mapping_reason for r in geography.unresolved_floods(f, bounds).collect()}
    assert left == {"b": "flood_geometry_did_not_intersect_reference", "c": "missing_flood_geometry", "d": "invalid_flood_geometry", "f": "reported_district_reference_not_found"}


def test_a_double_name_resolves_nothing(spark, bounds):
    twice = bounds.unionByName(bounds.where("district_id = 'd1'").withColumn("district_id", F.lit("d9")))
    w = spark.createDataFrame([("w", dt.datetime(2024, 6, 30), "S", "NORTH", 120.0, "o")], "event_id string, event_time timestamp, state string, district string, rainfall_departure_pct double, imd_object_id string")
    assert geography.weather_shocks(w, bounds).first().shock_severity == 1.0
    assert geography.weather_shocks(w, twice).count() == 0
    assert geography.unresolved_weather(w, twice).count() == 1

from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shockline import observability
from shockline.operators import geography, quality, signal
from shockline.schemas import GOLD

from .test_sources import gold_frame


def features(spark, *names):
    rows = [((n,), json.dumps({"type": "Point", "coordinates": [i, 0]})) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "properties struct<DISTRICT: string>, geometry_json string")


def test_each_market_has_one_boundary(spark):
    m = spark.createDataFrame([("m", " north ")], "market_id string, source_district string")
    assert json.loads(geography.market_features(m, features(spark, "North", "South")).first().geometry_json)["coordinates"] == [0, 0]
    for bad in (features(spark, "South"), features(spark, "North", "NORTH")):
        with pytest.raises(PySparkException):
            geography.market_features(m, bad).collect()


def test_unique_matches_and_candidates(spark):
    ref = spark.createDataFrame([("d1", "A"), ("d2", "B"), ("d3", "b ")], "district_id string, name string")
    rows = spark.createDataFrame([(1, "a"), (2, "B"), (3, "C"), (4, None)], "k int, district string")
    got = {r.k: (r.district_id, r.mapping_reason) for r in geography.unique_match(rows, ref, {"district": "name"}, "district_id", "none", "several").collect()}
    assert got == {1: ("d1", None), 2: (None, "several"), 3: (None, "none"), 4: (None, "none")}
    assert {r.k: r.candidates for r in geography.rank_matches(rows.unionByName(rows.where("k = 1")), "k").collect()} == {1: 2, 2: 1, 3: 1, 4: 1}


def test_spatial_pairs_over_several_cells_are_found_once(spark):
    from shockline.functions.geo import parse_geojson

    square = lambda x, s: json.dumps({"type": "Polygon", "coordinates": [[[x, 0], [x + s, 0], [x + s, s], [x, s], [x, 0]]]})
    shape = lambda rows, k: spark.createDataFrame(rows, f"{k} int, g string").withColumn("geometry", parse_geojson("g"))
    got = geography.spatial_pairs(shape([(1, square(0, 5)), (2, square(20, 1))], "a"), shape([(7, square(3, 4)), (8, square(21, 1)), (9, square(40, 1))], "b"), "a", "b")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 7), (2, 8)]


def test_signals_contract(spark):
    g = gold_frame(spark, ["a"])
    signal.same_schema(g)
    assert g.select(signal.contract_faults().alias("f")).first().f == []
    bad = g.withColumn("shock_id", F.lit(None).cast("string")).withColumn("deviation_pct", F.lit(float("nan")))
    assert bad.select(signal.contract_faults().alias("f")).first().f == ["shock_id", "deviation_pct"]
    assert len(GOLD) == 33 and g.columns == GOLD.fieldNames()
    r = spark.createDataFrame([("x", "x"), ("x", "y"), (None, "x")], "evidence_district_id string, district_id string").select(signal.district_matches().alias("m")).collect()
    assert [x.m for x in r] == [True, False, False]


def test_lookups(spark):
    g = gold_frame(spark, ["a", "b"])
    one = g.where("shock_id = 'a'").first().signal_id
    assert quality.exists_once(g, F.col("signal_id") == one) and not quality.exists_once(g, F.lit(True)) and not quality.exists_once(g, F.lit(False))
    assert quality.dashboard_detail(g, "synthetic_demo", one).first().observed_price == 10.0
    assert quality.dashboard_detail(g, "real_source", one).count() == 0


def test_health_of_an_empty_lake(spark):
    counts = quality.table_counts(spark, {"raw_events": None, "dlq_events": None})
    assert [r.row_count for r in counts.collect()] == [0, 0] and quality.health_warnings(counts).count() == 0


def test_log_lines():
    import logging

    r = logging.LogRecord("n", logging.INFO, "p", 1, "hello %s", ("x",), None)
    r.fields = {"rows": 3}
    out = json.loads(observability.JsonLines().format(r))
    assert (out["message"], out["rows"], out["level"]) == ("hello x", 3, "INFO")

"""What the application measures: counts of each split and late rows, against the tables."""

from __future__ import annotations

import datetime as dt

from shockline import observability
from shockline.config import EventTimePolicy, LookAhead
from shockline.operators import quality
from shockline.schemas import BROKER
from shockline.sources import read
from shockline.streaming import pipeline

from .test_streaming import SQUARE, price, raw


def test_late_rows_measured_equal_those_reconciled(spark, tmp_path):
    lake, when = str(tmp_path), dt.datetime(2024, 9, 1)
    spark.createDataFrame([("m1", "d1", "st", "S", "North", "Yard")], "market_id string, district_id string, state_id string, source_state string, source_district string, source_market string").write.parquet(f"{lake}/reference/markets")
    spark.createDataFrame([("d1", "S", "North", SQUARE)], "district_id string, source_state string, source_district string, geometry_json string").write.parquet(f"{lake}/reference/boundaries")
    weather = raw("w1", "weather_observation", "2024-06-30", {"state": "S", "district": "North", "rainfall_departure_pct": "50", "rainfall_category": "Excess", "imd_object_id": "7"})
    rounds = [
        [("mandi-prices", price("p1", "2024-07-01")), ("mandi-prices", price("p1", "2024-07-01")), ("mandi-prices", "{broken"), ("weather-events", weather)],
        [("mandi-prices", price("p2", "2024-08-20"))],
        [("mandi-prices", price("late1", "2024-07-02")), ("mandi-prices", price("late2", "2024-07-03")), ("mandi-prices", price("p3", "2024-08-21")), ("mandi-prices", price("p1", "2024-07-01"))],
    ]
    policy, ahead, k = EventTimePolicy(24), LookAhead(14), 0
    for rows in rounds:
        for topic, r in rows:
            spark.createDataFrame([(None, r, topic, 0, k, when)], BROKER).coalesce(1).write.mode("append").json(f"{lake}/in")
            k += 1
        for q in pipeline.start(spark, f"{lake}/in", lake, f"{lake}/checkpoints", policy, ahead, once=True):
            q.awaitTermination()
            assert q.exception() is None
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    got = {r["query"]: r for r in pipeline.measured(spark, lake).collect()}
    late = pipeline.late_events(spark, lake)
    assert sorted(r.event_id for r in late.collect()) == ["late1", "late2"]
    # the repeated p1 is behind the watermark too: dropped as late before it can be dropped as known
    repeats = 1
    assert got["silver_mandi_prices"]["late_rows"] == late.count() + repeats
    assert got["silver_mandi_prices"]["observed"]["silver_mandi_prices.rows"] == spark.read.parquet(f"{lake}/silver/mandi_prices").count() == 3
    assert got["bronze_raw_events"]["observed"]["bronze_raw_events.rows"] == got["bronze_raw_events"]["input_rows"] == 9
    assert got["silver_dlq"]["observed"]["silver_dlq.rows"] == 1 and got["silver_mandi_prices"]["state_rows"] <= 2
    assert str(got["silver_mandi_prices"]["watermark"]) == "2024-08-19 00:00:00"  # that of the last batch with rows
    # the join waits for the slowest of its three topics, so it still took what silver was too late for; stream and batch job are whole together
    dims = [read.dimension(spark, f"{lake}/reference/{d}", d) for d in ("markets", "boundaries")]
    found = [*spark.read.parquet(f"{lake}/gold/associations").collect(), *pipeline.reconcile(spark, lake, *dims, policy, ahead).collect()]
    assert sorted((r.shock_id, r.price_event_id) for r in found) == [("w1", "late1"), ("w1", "late2"), ("w1", "p1")]


def test_progress_of_a_batch_that_ran_again_counts_once(spark, tmp_path):
    class Event:
        def __init__(self, **p):
            import json

            self.progress = type("P", (), {"json": json.dumps({"name": "q", "runId": "r", "inputRowsPerSecond": 1.0, **p})})

    counters = observability.Counters()
    t = observability.ProgressTable(spark, f"{tmp_path}/p", every=2, counters=counters)
    state = lambda late: [{"numRowsTotal": 4, "numRowsDroppedByWatermark": late}]
    t.onQueryProgress(Event(batchId=0, timestamp="2024-01-01T00:00:00.000Z", numInputRows=5, stateOperators=state(1), observedMetrics={"a": {"rows": 5}}))
    t.onQueryProgress(Event(batchId=0, timestamp="2024-01-01T01:00:00.000Z", numInputRows=5, stateOperators=state(2), observedMetrics={"a": {"rows": 5, "bad": None}}))
    t.onQueryProgress(Event(batchId=1, timestamp="2024-01-01T02:00:00.000Z", numInputRows=0, stateOperators=state(0)))
    t.onQueryTerminated(None)
    r = observability.totals(observability.read_progress(spark, f"{tmp_path}/p")).first()
    assert (r["batches"], r["input_rows"], r["late_rows"], r["state_rows"], r["observed"]) == (1, 5, 2, 4, {"a.rows": 5})
    assert counters.snapshot() == {"q.input_rows": 10, "q.late_rows": 3}
    assert observability.read_progress(spark, f"{tmp_path}/none").count() == 0


def test_a_table_that_fails_counts_minus_one(spark):
    def broken():
        raise OSError("gone")

    counts = quality.table_counts_or_failed(spark, {"raw_events": lambda: spark.range(3), "dlq_events": lambda: None, "market_shock_signals": broken})
    assert {r["table_name"]: r["row_count"] for r in counts.collect()} == {"raw_events": 3, "dlq_events": 0, "market_shock_signals": -1}
    assert [r["warning"] for r in quality.health_warnings(counts).collect()] == ["table_not_readable"]

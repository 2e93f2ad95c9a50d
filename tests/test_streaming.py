"""Streams run to the end of what is there and are compared with the batch form of the same transforms."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shockline.config import EventTimePolicy, LookAhead
from shockline.operators import validate
from shockline.schemas import BROKER, MANDI
from shockline.sources import read, write
from shockline.streaming import pipeline

POLICY, AHEAD = EventTimePolicy(24 * 30), LookAhead(14)
SQUARE = json.dumps({"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]})


def raw(event_id, kind, day, payload):
    return json.dumps({"event_id": event_id, "event_type": kind, "event_time": f"{day}T00:00:00+00:00", "ingestion_time": "2024-07-02T00:00:00+00:00", "source": "synthetic_failure_injection", "schema_version": "1.0", "payload": payload})


def price(i, day, market="Yard", value=20):
    return raw(i, "mandi_price", day, {"state": "S", "district": "North", "market": market, "commodity": "Rice", "min_price": "10", "modal_price": value, "max_price": "30", "price_unit": "u"})


RECORDS = {
    "mandi-prices": [price("p1", "2024-07-01"), price("p1", "2024-07-01"), price("p2", "2024-07-10"), price("p3", "2024-07-20"), price("p4", "2024-07-02", "Nowhere"), price("p5", "2024-07-02", value=-1), "{broken"],
    "weather-events": [raw("w1", "weather_observation", "2024-06-30", {"state": "s ", "district": "NORTH", "rainfall_departure_pct": "50", "rainfall_category": "Excess", "imd_object_id": "7"}), raw("w2", "weather_observation", "2024-06-30", {"state": "S", "district": "Lost", "rainfall_category": "Excess"})],
    "flood-events": [raw("f1", "flood_event", "2024-06-29", {"source_event_id": "1", "geometry_json": json.dumps({"type": "Point", "coordinates": [1, 1]})}), raw("f2", "flood_event", "2024-06-29", {"source_event_id": "2"})],
}


@pytest.fixture
def lake(spark, tmp_path):
    when, k = dt.datetime(2024, 7, 30), 0
    for topic, raws in RECORDS.items():
        for r in raws:
            spark.createDataFrame([(None, r, topic, 0, k, when)], BROKER).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
            k += 1
    spark.createDataFrame([("m1", "d1", "st", "S", "North", "Yard")], "market_id string, district_id string, state_id string, source_state string, source_district string, source_market string").write.parquet(f"{tmp_path}/reference/markets")
    spark.createDataFrame([("d1", "S", "North", SQUARE)], "district_id string, source_state string, source_district string, geometry_json string").write.parquet(f"{tmp_path}/reference/boundaries")
    return str(tmp_path)


def test_whole_application(spark, lake):
    queries = pipeline.start(spark, f"{lake}/in", lake, f"{lake}/checkpoints", POLICY, AHEAD, once=True)
    for q in queries:
        q.awaitTermination()
        assert q.exception() is None
    got = lambda t: spark.read.parquet(f"{lake}/{t}")
    assert got("bronze/raw_events").count() == 11
    assert sorted(r.event_id for r in got("silver/mandi_prices").collect()) == ["p1", "p2", "p3", "p4"]
    assert sorted(r.payload.reason for r in got("silver/dlq_events").collect()) == ["malformed_json", validate.MANDI_REJECT]
    assert spark.read.json(f"{lake}/dlq_messages").count() == 2
    assert [r.event_id for r in got("silver/unresolved_markets").collect()] == ["p4"]
    assert [r.event_id for r in got("silver/unresolved_weather").collect()] == ["w2"]
    assert [(r.event_id, r.mapping_reason) for r in got("silver/unresolved_flood").collect()] == [("f2", "missing_flood_geometry")]
    pairs = sorted((r.shock_id, r.price_event_id, r.days_after_shock) for r in got("gold/associations").collect())
    assert pairs == [("f1", "p1", 2), ("f1", "p2", 11), ("w1", "p1", 1), ("w1", "p2", 10)]
    # the batch form gives the same, and reconciliation finds nothing that the stream missed
    dims = [read.dimension(spark, f"{lake}/reference/{d}", d) for d in ("markets", "boundaries")]
    records = {n: spark.read.schema(BROKER).json(f"{lake}/in").where(F.col("topic") == t) for n, t in pipeline.TOPICS.items()}
    batch = pipeline.build(records, *dims, POLICY, AHEAD).associations
    assert sorted((r.shock_id, r.price_event_id, r.days_after_shock) for r in batch.collect()) == pairs
    assert pipeline.reconcile(spark, lake, *dims, POLICY, AHEAD).count() == 0
    # a second start from the same checkpoints adds nothing
    for q in pipeline.start(spark, f"{lake}/in", lake, f"{lake}/checkpoints", POLICY, AHEAD, once=True):
        q.awaitTermination()
    assert got("gold/associations").count() == 4 and got("bronze/raw_events").count() == 11


def test_deduplication_state_leaves_with_the_watermark(spark, lake):
    records = read.broker_stream(spark, f"{lake}/in", "mandi-prices", per_trigger=1)
    good = validate.silver(validate.parse_mandi(records, MANDI)[0])
    q = write.append_stream(pipeline.deduplicated(good, EventTimePolicy(24)).select("event_id", "event_time"), f"{lake}/d", f"{lake}/dc", "dedup_within", once=True)
    q.awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(f"{lake}/d").collect()).count("p1") == 1
    state = q.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] <= 4
    exact = pipeline.deduplicated(good, EventTimePolicy(24), exact=True)
    assert exact.isStreaming


def test_topics_and_dead_letter_sink(spark, lake):
    both = read.broker_streams(spark, f"{lake}/in", ["weather-events", "flood-events"])
    q = write.append_stream(validate.bronze(both), f"{lake}/b", f"{lake}/bc", "bronze_two", ["kafka_topic"], once=True)
    q.awaitTermination()
    assert spark.read.parquet(f"{lake}/b").count() == 4
    bad = validate.parse_mandi(read.broker_stream(spark, f"{lake}/in", "mandi-prices"), MANDI)[1]
    q = write.dead_letter_stream(validate.dead_letters(bad), f"{lake}/m", f"{lake}/mc", "dead", once=True)
    q.awaitTermination()
    rows = spark.read.json(f"{lake}/m").collect()
    assert len(rows) == 2 and all(json.loads(r.value)["event_id"] == r.key for r in rows)


def test_daily_windows_on_a_stream(spark, lake):
    from shockline.operators import baseline

    records = read.broker_stream(spark, f"{lake}/in", "mandi-prices")
    s = pipeline.deduplicated(validate.silver(validate.parse_mandi(records, MANDI)[0]), EventTimePolicy(1))
    q = baseline.daily_windows(s).writeStream.format("memory").queryName("daily").outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{lake}/wc").start()
    q.awaitTermination()
    assert spark.table("daily").where("observation_count = 1").count() >= 1


def test_progress_numbers():
    from shockline.observability import Counters, progress

    assert progress(None) == {}
    p = progress({"batchId": 3, "numInputRows": 9, "eventTime": {"watermark": "t"}, "stateOperators": [{"numRowsTotal": 2, "numRowsDroppedByWatermark": 1}]})
    assert (p["batch_id"], p["watermark"], p["state_rows"], p["late_rows"]) == (3, "t", 2, 1)
    c = Counters()
    c.add("x", 2)
    assert c.snapshot() == {"x": 2}
    with pytest.raises(ValueError):
        c.add("x", -1)

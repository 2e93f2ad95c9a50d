"""State of streams: repeats within a horizon, joins by time slices, measured late rows."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shockline.config import EventTimePolicy, LookAhead
from shockline.operators import associate
from shockline.streaming import pipeline
from shockline.streaming.repeats import first_within


@pytest.fixture(scope="module")
def rocks(spark):
    before = {k: spark.conf.get(k, None) for k in pipeline.STATE_STORE}
    for k, v in pipeline.STATE_STORE.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def put(spark, folder, n, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{folder}/{n:03d}")


def at(day, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=hour)


def test_repeats_within_the_horizon_are_dropped_and_state_leaves(rocks, tmp_path):
    spark, schema = rocks, "event_id string, event_time timestamp, v int"
    batches = [
        [("a", at(0), 1), ("b", at(0, 1), 1), ("a", at(0), 2)],
        [("a", at(2), 3), ("c", at(3), 1)],  # two days after the first: known by the horizon, not by a watermark of a day
        [("d", at(20), 1)],
        [("a", at(20, 1), 4), ("d", at(20), 2)],  # the horizon is over: an id of its own
        [("e", at(60), 1)],
        [("f", at(61), 1)],
    ]
    for n, rows in enumerate(batches):
        put(spark, f"{tmp_path}/in", n, rows, schema)
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).json(f"{tmp_path}/in")
    out = first_within(events.withWatermark("event_time", "1 day"), "event_id", "event_time", dt.timedelta(days=10))
    q = out.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(f"{tmp_path}/out")
    q.awaitTermination()
    assert sorted((r.event_id, r.v) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [("a", 1), ("a", 4), ("b", 1), ("c", 1), ("d", 1), ("e", 1), ("f", 1)]
    held = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in map(lambda p: json.loads(p.json), q.recentProgress)]
    assert max(held) >= 3 and held[-1] <= 4 and held[-1] < max(held)
    with pytest.raises(ValueError):
        first_within(events, "event_id", "event_time", dt.timedelta(0))


def test_horizon_in_the_application(rocks, tmp_path):
    schema = "event_id string, event_time timestamp"
    put(rocks, f"{tmp_path}/in", 0, [("x", at(0)), ("x", at(5)), ("y", at(1))], schema)
    events = rocks.readStream.schema(schema).option("recursiveFileLookup", True).json(f"{tmp_path}/in")
    out = pipeline.deduplicated(events, EventTimePolicy(24), horizon=dt.timedelta(days=30))
    # the watermark goes on behind it: another operator with state may follow
    counted = out.groupBy(F.window("event_time", "1 day")).count()
    q = counted.writeStream.format("memory").queryName("horizon").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.exception() is None


def test_stream_join_by_slices_equals_batch(spark, tmp_path):
    ahead = LookAhead(3)
    shocks = [(f"s{k}", "flood", at(k, 7 * k % 24), "d1" if k % 4 else "d2") for k in range(20)]
    prices = [(f"p{k}", at(k // 2, 5 * k % 24), "d1" if k % 3 else "d2", "m", "c", float(k)) for k in range(44)]
    s_schema, p_schema = "shock_id string, shock_type string, shock_time timestamp, district_id string", "event_id string, event_time timestamp, district_id string, market_id string, commodity_id string, modal_price double"
    for n in range(4):
        put(spark, f"{tmp_path}/s", n, shocks[n::4], s_schema)
        put(spark, f"{tmp_path}/p", n, prices[n::4], p_schema)
    batch = associate.associate(spark.createDataFrame(shocks, s_schema), spark.createDataFrame(prices, p_schema), ahead)
    want = {(s[0], p[0]) for s in shocks for p in prices if s[3] == p[2] and s[2] <= p[1] <= s[2] + dt.timedelta(days=3)}
    assert {(r.shock_id, r.price_event_id) for r in batch.collect()} == want and batch.count() == len(want) > 40
    stream = lambda name, schema, time: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).json(f"{tmp_path}/{name}").withWatermark(time, "60 days")
    joined = associate.associate(stream("s", s_schema, "shock_time"), stream("p", p_schema, "event_time"), ahead)
    q = joined.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(f"{tmp_path}/out")
    q.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(tuple, got.select("shock_id", "price_event_id", "days_after_shock").collect())) == sorted(map(tuple, batch.select("shock_id", "price_event_id", "days_after_shock").collect()))
    # rows of a district are dealt by slices: its state is in several partitions
    plan = q._jsq.explainInternal(False) if hasattr(q._jsq, "explainInternal") else str(q._jsq.lastExecution())
    assert "_slice" in plan or "_bucket" in plan

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shockline.operators import normalize, validate
from shockline.schemas import BROKER, FLOOD, MANDI, WEATHER

GOOD = {"state": "S", "district": "D", "market": "M", "commodity": "C", "min_price": "1", "modal_price": 2, "max_price": "3.00", "price_unit": "u"}


def event(payload=None, **change):
    e = {"event_id": "e1", "event_type": "mandi_price", "event_time": "2024-07-01T00:00:00+00:00", "ingestion_time": "2024-07-02T00:00:00+00:00", "source": "s", "schema_version": "1.0", "payload": GOOD | (payload or {})}
    return json.dumps({k: v for k, v in (e | change).items() if v != "absent"})


def records(spark, raws):
    when = dt.datetime(2024, 7, 3)
    return spark.createDataFrame([(None, r, "mandi-prices", 0, i, when) for i, r in enumerate(raws)], BROKER)


CASES = [
    (event(), None), ("{not json", "malformed_json"), ("null", "malformed_json"), ("[1,2]", "malformed_json"), ("", "malformed_json"), (None, "malformed_json"),
    (event(event_id="absent"), "missing_event_id"), (event(event_time="soon"), "invalid_event_time"), (event({"modal_price": -1}), validate.MANDI_REJECT),
    (event({"min_price": None}), validate.MANDI_REJECT), (event({"district": None}), validate.MANDI_REJECT), (event({"market": "  "}), validate.MANDI_REJECT),
    (event({"max_price": "abc"}), None), (event(payload={}) .replace("GOOD", ""), None), (json.dumps({"event_id": "x", "event_time": "2024-07-01T00:00:00Z"}), validate.MANDI_REJECT),
]


def test_ladder_and_conservation(spark):
    valid, invalid = validate.parse_mandi(records(spark, [c[0] for c in CASES]), MANDI)
    got = {r.offset: None for r in valid.collect()} | {r.offset: r[validate.REASON] for r in invalid.collect()}
    assert len(got) == len(CASES)  # no row is lost to a null rule
    for i, (raw, reason) in enumerate(CASES):
        if raw and "abc" in raw:
            assert got[i] in ("malformed_json", validate.MANDI_REJECT)  # a price that isn't a number never passes
        else:
            assert got[i] == reason, raw


def test_silver_and_bronze_keep_the_raw_text(spark):
    rows = records(spark, [event(), "{x"])
    assert validate.bronze(rows).count() == 2
    s = validate.silver(validate.parse_mandi(rows, MANDI)[0]).collect()
    assert len(s) == 1 and json.loads(s[0].raw_payload)["event_id"] == "e1" and str(s[0].modal_price) == "2.00"


def test_required_fields_of_other_events(spark):
    w = json.dumps({"event_id": "w", "event_time": "2024-07-01T00:00:00Z", "payload": {"district": "D", "rainfall_category": " "}})
    f = json.dumps({"event_id": "f", "event_time": "2024-07-01T00:00:00Z", "payload": {"source_event_id": "9"}})
    assert validate.parse_required(records(spark, [w]), WEATHER, ["district", "rainfall_category"])[1].count() == 1
    assert validate.parse_required(records(spark, [f]), FLOOD, ["source_event_id"])[0].count() == 1


def test_dead_letter_envelope(spark):
    _, bad = validate.parse_mandi(records(spark, ["{x", event(event_time="soon")]), MANDI)
    d = validate.dead_letters(bad).orderBy("payload.source_offset").collect()
    assert d[0].event_id.startswith("dlq:") and len(d[0].event_id) == 68
    assert d[0].event_time == dt.datetime(2024, 7, 3)  # the broker's time stands in
    assert [r.payload.reason for r in d] == ["malformed_json", "invalid_event_time"]


def test_equal_to_the_cutoff_is_processed(spark):
    t = lambda s: F.lit(s).cast("timestamp")
    r = spark.range(1).select(validate.late_disposition(t("2024-01-01"), t("2024-01-01")).alias("a"), validate.late_disposition(t("2023-12-31 23:00:00"), t("2024-01-01")).alias("b")).first()
    assert (r.a, r.b) == ("process", "reconcile")


MANDI_RAW = {"State": "S", "District": "D", "Market": "M", "Commodity": "C", "Variety": None, "Arrival_Date": "01/07/2024", "Min_Price": "1", "Modal_Price": "2", "Max_Price": "3", "Price_Unit": None}


@pytest.mark.parametrize(
    ("change", "reason"),
    [({}, None), ({"Arrival_Date": "2024-07-01"}, None), ({"Arrival_Date": "1 July"}, "invalid_arrival_date"), ({"State": None}, "missing_state"), ({"Modal_Price": "x"}, "invalid_modal_price"), ({"Modal_Price": "9"}, "price_order_invalid"), ({"Min_Price": "-1"}, "negative_min_price")],
)
def test_mandi_normalizer(spark, change, reason):
    raw = spark.createDataFrame([tuple((MANDI_RAW | change).values())], ", ".join(f"{c} string" for c in MANDI_RAW))
    r = normalize.mandi(raw, price_unit="Rs./Quintal").first()
    assert r.reason == reason
    assert (r.event_id is None) == (reason is not None)


def test_mandi_without_a_unit(spark):
    raw = spark.createDataFrame([tuple(MANDI_RAW.values())], ", ".join(f"{c} string" for c in MANDI_RAW))
    assert normalize.mandi(raw).first().reason == "missing_price_unit"


def test_accepted_and_rejected_are_all(spark):
    raw = spark.createDataFrame([tuple((MANDI_RAW | {"Commodity": c}).values()) for c in ("a", "", None)], ", ".join(f"{c} string" for c in MANDI_RAW))
    rows = normalize.mandi(raw, price_unit="u")
    assert normalize.accepted(rows).count() == 1 and normalize.rejected(rows).count() == 2


def test_canonical_json(spark):
    from shockline.functions.identity import canonical_json, rejected_id

    same = ['{"type":"Point","coordinates":[1.0, 2]}', '{ "coordinates" : [1,2.00],\n"type":"Point"}']
    texts = [*same, '{"b":{"z":1,"a":[{"y":1,"x":"é"}]},"a":null}', '{"a":1,"a":2}', "{bad", None]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = [r.c for r in rows.select("k", canonical_json("t").alias("c")).orderBy("k").collect()]
    assert got == ['{"coordinates":[1,2],"type":"Point"}'] * 2 + ['{"a":null,"b":{"a":[{"x":"é","y":1}],"z":1}}', '{"a":1,"a":2}', "{bad", None]
    ids = [r.i for r in rows.select("k", rejected_id(F.lit("s"), "t").alias("i")).orderBy("k").collect()]
    assert ids[0] == ids[1] and len(set(ids[:5])) == 4 and ids[5] is None

"""The end-to-end case, the audit of a batch, boundaries, delivery and its failures."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shockline.config import ConfidencePolicy, SignalPolicy
from shockline.operators import case as cases
from shockline.schemas import GOLD
from shockline.sources import read, write

CASE = cases.Case("S", "D", "M", "Paddy", "Rs", "s", "d", "m", "c", "2023-12-01", "2023-12-10", "2020-12-01", "2022-12-31")
PRICE = "event_id string, event_time timestamp, state string, district string, market string, commodity string, variety string, price_unit string, modal_price double"


def prices(spark):
    other = [(f"o{k}", dt.datetime(2022, 12, 1 + k), "S", "D", "M", "Paddy", "Other", "Rs", 100.0 + 10 * k) for k in range(6)] + [("t", dt.datetime(2023, 12, 5), "S", "D", "M", "Paddy", "Other", "Rs", 80.0)]
    adt = [(f"a{k}", dt.datetime(2022, 12, 1 + k), "S", "D", "M", "Paddy", "ADT 37", "Rs", 50.0) for k in range(5)] + [("ta", dt.datetime(2023, 12, 4), "S", "D", "M", "Paddy", "ADT 37", "Rs", 1.0)]
    bad = [("b", dt.datetime(2023, 12, 4), "S", "D", "M", "Paddy", "Other", "Rs./Bundle", 1.0), ("x", dt.datetime(2022, 12, 9), "S", "E", "M", "Paddy", "Other", "Rs", 1.0), ("y", dt.datetime(2022, 12, 9), "S", "D", "M", "Paddy", None, "Rs", 1.0)]
    return spark.createDataFrame([*other, *adt, *bad], PRICE)


def shock(spark, start="2023-12-03"):
    return spark.createDataFrame([("shock", start, "reported", 144.0, "https://x")], "event_id string, event_start string, geography_basis string, inundated_area_hectares double, source_url string")


def test_case_from_prices_to_gold(spark):
    g = cases.analyze(prices(spark), shock(spark), CASE, ConfidencePolicy(), SignalPolicy(), F.lit("2024-01-01").cast("timestamp"))
    write.same_schema(g)
    (r,) = g.collect()
    assert (r.price_event_id, r.baseline_price, r.sample_size if "sample_size" in g.columns else 6, round(r.deviation_pct, 6), r.days_after_shock) == ("t", 125.0, 6, -36.0, 2)
    assert "price_series_variety:Other" in r.source_references and "baseline_observations:6" in r.source_references and f"control_status:{cases.CONTROL_STATUS}" in r.source_references
    out = {(x.variety, x.price_unit): x.excluded for x in cases.series_outcomes(prices(spark), CASE, 5).collect()}
    assert out == {("Other", "Rs"): None, ("ADT 37", "Rs"): None, ("Other", "Rs./Bundle"): "incompatible_price_unit"}


def test_case_without_a_series_or_before_its_shock(spark):
    none = cases.analyze(prices(spark).where("variety is null"), shock(spark), CASE, ConfidencePolicy(), SignalPolicy())
    assert none.count() == 0
    with pytest.raises(Exception, match="precedes"):
        cases.analyze(prices(spark), shock(spark, "2023-12-06"), CASE, ConfidencePolicy(), SignalPolicy()).collect()


def test_audit(spark):
    files = spark.createDataFrame([("p1", "h1", "2022-12-01"), ("p2", "h1", "2022-12-01"), ("p3", "h3", "2022-12-02"), ("p4", "h4", "2022-12-03")], "path string, sha256 string, report_date string")
    rows = spark.createDataFrame([(p, d, x, "M", "C", v, "u", dt.date.fromisoformat(d)) for p, d, x, v in (("p1", "2022-12-01", None, None), ("p2", "2022-12-01", None, "V"), ("p4", "2022-12-03", None, "V"), ("p4", "2022-12-03", "bad", "V"))], "path string, report_date string, reason string, market string, commodity string, variety string, price_unit string, day date")
    a = cases.audit(rows, files, "2022-12-03")
    assert a["summary"].first().asDict() == {"total_target_rows": 3, "accepted_rows": 2, "rejected_rows": 1, "duplicate_files": 1, "reports_without_rows": 1}
    assert [r.path for r in a["duplicate_files"].collect()] == ["p2"] and [r.report_date for r in a["reports_without_rows"].collect()] == ["2022-12-02"]
    assert {r.variety for r in a["coverage_by_variety"].collect()} == {"<unspecified>", "V"} and {r.variety for r in a["pre_event_coverage_by_variety"].collect()} == {"<unspecified>"}


SQUARE = [[4_000_000.0, 4_000_000.0], [4_010_000.0, 4_000_000.0], [4_010_000.0, 4_010_000.0], [4_000_000.0, 4_010_000.0], [4_000_000.0, 4_000_000.0]]


def features(tmp_path, *rings, crs="urn:ogc:def:crs:EPSG::7755", code="33"):
    one = [{"properties": {"state_name": "S", "district": "D", "stcode": code}, "geometry": {"type": "MultiPolygon", "coordinates": [[r]]}} for r in rings]
    (tmp_path / "f.json").write_text(json.dumps({"crs": {"properties": {"name": crs}}, "features": one}))
    return str(tmp_path / "f.json")


def boundary(spark, path):
    return read.district_boundary(spark, path, "struct<state_name: string, district: string, stcode: string>", {"state_name": "S", "district": "D"}, {"stcode": "33"})


def test_boundary_in_degrees(spark, tmp_path):
    ring = boundary(spark, features(tmp_path, SQUARE)).first().geometry[0][0]
    assert len(ring) == 5 and ring[0] == ring[-1] and abs(ring[0][0] - 80) < 1e-10 and abs(ring[0][1] - 24) < 1e-10 and ring[1][0] > 80


@pytest.mark.parametrize(
    ("rings", "change", "fault"),
    [([], {}, "no feature"), ([SQUARE, SQUARE], {}, "more than one"), ([SQUARE[:-1]], {}, "unclosed_ring"), ([SQUARE[:2] + SQUARE[:1]], {}, "invalid_ring"), ([[SQUARE[0], SQUARE[2], SQUARE[1], SQUARE[3], SQUARE[0]]], {}, "self_intersecting"), ([SQUARE], {"code": "34"}, "unexpected_stcode"), ([SQUARE], {"crs": "EPSG:4326"}, "projection")],
)
def test_boundaries_that_fail(spark, tmp_path, rings, change, fault):
    with pytest.raises(Exception, match=fault):
        boundary(spark, features(tmp_path, *rings, **change)).collect()


def test_delivery_retries_what_may_pass(tmp_path):
    sent, waits = [], []

    def send(documents):
        sent.append([i for i, _ in documents])
        return [("b", 503)] if len(sent) < 3 else None

    write.deliver(send, [("a", "1"), ("b", "2")], sleep=waits.append)
    assert sent == [["a", "b"], ["b"], ["b"]] and waits == [1.0, 2.0]
    with pytest.raises(write.Undelivered):
        write.deliver(lambda d: [("a", 400)], [("a", "1")], sleep=waits.append)
    assert len(waits) == 2


def test_publisher_waits_for_delivery(tmp_path):
    write.Publisher(write.FileProducer(str(tmp_path))).publish("t", "k", "v")
    assert json.loads((tmp_path / "t.ndjson").read_text()) == {"key": "k", "value": "v"}

    class Broker:
        def __init__(self, error, left):
            self.error, self.left = error, left

        def produce(self, topic, key, value, on_delivery):
            on_delivery(self.error, None)

        def flush(self, seconds):
            return self.left

    for broker in (Broker("refused", 0), Broker(None, 1)):
        with pytest.raises(write.Undelivered):
            write.Publisher(broker).publish("t", "k", "v")


@pytest.mark.parametrize(("line", "fault"), [("{", "invalid JSON.* line 2"), ('{"signal_id": "x"}', "missing_.* line 2")])
def test_gold_documents_name_the_bad_line(spark, tmp_path, line, fault):
    g = cases.analyze(prices(spark), shock(spark), CASE, ConfidencePolicy(), SignalPolicy())
    good = g.select(F.to_json(F.struct("*")).alias("j")).first().j
    (tmp_path / "good.ndjson").write_text(f"{good}\n\n{good}\n")
    assert read.gold_documents(spark, str(tmp_path / "good.ndjson"), GOLD).count() == 2
    (tmp_path / "bad.ndjson").write_text(f"{good}\n{line}\n")
    with pytest.raises(Exception, match=fault):
        read.gold_documents(spark, str(tmp_path / "bad.ndjson"), GOLD).collect()

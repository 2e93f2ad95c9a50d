from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shockline import cli
from shockline.operators import quality
from shockline.schemas import GOLD, MANDI
from shockline.sources import read, write

REPORT = '''﻿"Market-wise daily report on {day} State/UT : Some State"

Commodity,Arrivals,Unit of Arrivals,Variety,Minimum Prices,Maximum Prices,Modal Prices,Unit of Price
Market Name : First Yard
Commodity Group Name : Cereals
Paddy,4.43,Tonnes,Fine,10,12,11,Rs./Quintal
,,Tonnes,Other,20,22,21,Rs./Quintal
Wheat,1,Tonnes,W,1,1
Market Name : Second Yard
,,Tonnes,Orphan,5,5,5,Rs./Quintal
'''


def put(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")


def test_report_parsing(spark, tmp_path):
    put(tmp_path, "a.csv", REPORT.format(day="04-Dec-2023"))
    titled = read.report_titles(read.report_files(spark, str(tmp_path)))
    t = titled.first()
    assert (t.report_date, t.report_state, t.title_reason) == (dt.date(2023, 12, 4), "Some State", None)
    rows = read.report_rows(titled).orderBy("line_no").collect()
    assert [(r.Market, r.Commodity, r.Variety) for r in rows if not r.parse_error] == [("First Yard", "Paddy", "Fine"), ("First Yard", "Paddy", "Other"), ("Second Yard", None, "Orphan")]
    assert [r.parse_error for r in rows if r.parse_error] == ["unexpected_column_count"]


@pytest.mark.parametrize(("text", "reason"), [("x", "report_too_short"), ("no title\n\nh\nx,1", "unrecognized_report_title"), ('"on 99-Dec-2023 State/UT : S"\n\nh\nx', "invalid_report_date")])
def test_report_titles_that_fail(spark, tmp_path, text, reason):
    put(tmp_path, "a.csv", text)
    assert read.report_titles(read.report_files(spark, str(tmp_path))).first().title_reason == reason


def test_staging(spark, tmp_path):
    for name, day in (("a.csv", "02-Dec-2022"), ("b.csv", "02-Dec-2022"), ("c.csv", "09-Dec-2022")):
        put(tmp_path, name, REPORT.format(day=day))
    put(tmp_path, "d.csv", REPORT.format(day="02-Dec-2022") + "more\n")
    d = lambda s: F.lit(s).cast("date")
    staged = read.stage_reports(read.report_titles(read.report_files(spark, str(tmp_path))), "some state", d("2022-12-01"), d("2022-12-03"))
    assert {r.path.rsplit("/", 1)[1]: r.outcome for r in staged.collect()} == {"a.csv": "kept", "b.csv": "duplicate", "c.csv": "ignored", "d.csv": "conflict"}
    gaps = quality.missing_days(staged.where("outcome = 'kept'"), "report_date", d("2022-12-01"), d("2022-12-03"))
    assert sorted(str(r.missing_day) for r in gaps.collect()) == ["2022-12-01", "2022-12-03"]


def snapshot(**change):
    m = {"source_state": "Some State", "source_district": "Dist", "source_market": "First Yard", "state_id": "s", "district_id": "d", "market_id": "m", "evidence_url": "https://example.org/x", "retrieved_at": "2026-01-01T00:00:00Z"}
    return {"reference_scope": "case", "markets": [m | change]}


def test_import_reports_end_to_end(spark, tmp_path):
    (tmp_path / "r").mkdir()
    put(tmp_path / "r", "a.csv", REPORT.format(day="04-Dec-2023").replace("21,Rs./Quintal", "21,Rs./Bundle"))
    put(tmp_path, "m.json", json.dumps(snapshot()))
    rows = cli.import_reports(spark, str(tmp_path / "r"), str(tmp_path / "m.json"), "case", "First Yard", "Paddy", "Rs./Quintal")
    assert sorted((r.Variety or "", r.reason) for r in rows.collect()) == [("Fine", None), ("Other", "incompatible_price_unit"), ("W", "unexpected_column_count")]
    write.import_artifacts(rows, str(tmp_path / "out"), {"market": "First Yard"})
    m = spark.read.json(str(tmp_path / "out/manifest")).first()
    assert m.row_count == m.accepted_count + m.rejected_count and m.accepted_count == 1
    assert spark.read.json(str(tmp_path / "out/replay")).first().source == "replayed_historical"


@pytest.mark.parametrize("change", [{"evidence_url": "http://example.org"}, {"market_id": " "}, {"state_id": None}])
def test_bad_snapshots_fail(spark, tmp_path, change):
    put(tmp_path, "m.json", json.dumps(snapshot(**change)))
    with pytest.raises(PySparkException):
        read.market_snapshot(spark, str(tmp_path / "m.json"), "case").collect()


def test_snapshot_scope_and_double_markets(spark, tmp_path):
    s = snapshot()
    put(tmp_path, "m.json", json.dumps(s))
    assert read.market_snapshot(spark, str(tmp_path / "m.json"), "case").count() == 1
    with pytest.raises(PySparkException):
        read.market_snapshot(spark, str(tmp_path / "m.json"), "other").collect()
    put(tmp_path, "n.json", json.dumps(s | {"markets": [*s["markets"], s["markets"][0] | {"source_market": " FIRST yard"}]}))
    with pytest.raises(PySparkException):
        read.market_snapshot(spark, str(tmp_path / "n.json"), "case").collect()


def replay(event_id, price=1, source="replayed_historical"):
    return json.dumps({"event_id": event_id, "event_type": "mandi_price", "event_time": "2024-01-01T00:00:00Z", "ingestion_time": "x", "source": source, "schema_version": "1.0", "payload": {"modal_price": price}})


def test_replay_folder(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    put(tmp_path, "a.replayed.ndjson", f"{replay('b')}\n{replay('a')}\n")
    put(tmp_path / "deep", "b.replayed.ndjson", f"{replay('a')}\n")
    put(tmp_path, "other.ndjson", "{broken")
    assert [r.event_id for r in read.replay_folder(spark, str(tmp_path), MANDI).collect()] == ["a", "b"]
    put(tmp_path / "deep", "c.replayed.ndjson", f"{replay('a', 2)}\n")
    with pytest.raises(PySparkException):
        read.replay_folder(spark, str(tmp_path), MANDI).collect()


def test_replay_needs_its_label(spark, tmp_path):
    put(tmp_path, "a.json", replay("a", source="live"))
    with pytest.raises(PySparkException):
        read.replay_events(spark, str(tmp_path), MANDI).collect()
    put(tmp_path, "a.json", replay("a", source="synthetic_failure_injection"))
    assert read.replay_events(spark, str(tmp_path), MANDI).count() == 1


def test_json_arrays_and_features(spark, tmp_path):
    put(tmp_path, "a.json", json.dumps({"records": [{"State": "S"}, {"State": "T"}]}, indent=1))
    assert read.json_array(spark, str(tmp_path / "a.json"), "struct<State: string>", "records").count() == 2
    put(tmp_path, "b.json", json.dumps({"State": "S"}))
    assert read.json_array(spark, str(tmp_path / "b.json"), "struct<State: string>").count() == 1
    with pytest.raises(PySparkException):
        read.json_array(spark, str(tmp_path / "b.json"), "struct<State: string>", "records").collect()
    f = {"type": "FeatureCollection", "crs": {"properties": {"name": "urn:ogc:def:crs:EPSG::7755"}}, "features": [{"properties": {"district": "D"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]}
    put(tmp_path, "c.json", json.dumps(f, indent=1))
    r = read.geojson_features(spark, str(tmp_path / "c.json"), "struct<district: string>", "7755").first()
    assert r.properties.district == "D" and json.loads(r.geometry_json)["type"] == "Point"
    with pytest.raises(PySparkException):
        read.geojson_features(spark, str(tmp_path / "c.json"), "struct<district: string>", "4326").collect()


def test_page_addresses():
    assert "limit=10" in read.page_query("https://x", "k", 10, 0)
    for key, limit, offset in (("", 1, 0), ("k", 0, 0), ("k", 101, 0), ("k", 1, -1)):
        with pytest.raises(ValueError):
            read.page_query("https://x", key, limit, offset)


def gold_frame(spark, ids, level="LOW"):
    from shockline.operators import signal

    t = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame([(i, "p", "s", "d", "m", "c", "flood", t, t, 10.0, 9.0, 1, 0.5) for i in ids], "shock_id string, price_event_id string, state_id string, district_id string, market_id string, commodity_id string, shock_type string, shock_time timestamp, price_event_time timestamp, observed_price double, median_price double, days_after_shock int, shock_severity double")
    from shockline.config import ConfidencePolicy, SignalPolicy

    rows = rows.withColumns({"mad": F.lit(1.0), "sample_size": F.lit(9), "trading_days": F.lit(9)})
    return signal.gold(signal.scored(rows, ConfidencePolicy(), SignalPolicy()), "synthetic_demo", F.lit(t))


def test_documents(spark, tmp_path):
    g = gold_frame(spark, ["a", "a", "b"])
    write.index_documents(g, path=str(tmp_path / "docs"))
    back = read.gold_documents(spark, str(tmp_path / "docs"), GOLD)
    assert back.count() == 2 and back.first().data_confidence.is_sufficient
    with pytest.raises(PySparkException):
        write.index_documents(g.withColumn("fixture_kind", F.lit("?")), path=str(tmp_path / "bad"))
    with pytest.raises(ValueError):
        write.index_documents(g.drop("location"), path=str(tmp_path / "bad"))
    (tmp_path / "empty").mkdir()
    put(tmp_path / "empty", "x.json", "")
    with pytest.raises(ValueError):
        read.gold_documents(spark, str(tmp_path / "empty"), GOLD)


def test_retry_and_publisher():
    p, waits = write.MemoryPublisher(failures=2), []
    write.with_retry(lambda: p.publish("t", "k", "v"), lambda e: isinstance(e, ConnectionError), sleep=waits.append)
    assert p.messages == [("t", "k", "v")] and waits == [1.0, 2.0]
    with pytest.raises(KeyError):
        write.with_retry(lambda: {}["x"], lambda e: isinstance(e, ConnectionError), sleep=waits.append)
    with pytest.raises(ValueError):
        write.pace(0)
    with pytest.raises(ValueError):
        write.append_stream(None, "p", "c", "bronze", additive=True)


def test_conflicts(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", 1, None), ("b", 1, "x"), ("b", 2, "x")], "id string, v int, w string")
    assert [r.id for r in quality.conflicting_ids(rows, "id").collect()] == ["b"]
    assert quality.collapse_identical(rows.where("id = 'a'"), "id").count() == 1
    with pytest.raises(PySparkException):
        quality.collapse_identical(rows, "id").collect()


def test_series_choice_ignores_prices(spark):
    rows = spark.createDataFrame([("c", "Other", "u", 6, 1), ("c", "ADT", "u", 5, 1), ("c", "Best", "u", 9, 0), ("c", "Bundle", "b", 50, 1), ("c", "Few", "u", 4, 1)], "case string, variety string, price_unit string, baseline_rows int, event_rows int")
    assert [r.variety for r in quality.select_series(rows, ["case"], "u", 5).collect()] == ["Other"]
    why = {r.variety: r.why for r in rows.select("variety", quality.eligibility("u", 5).alias("why")).collect()}
    assert why == {"Other": None, "ADT": None, "Best": "not_observed_in_event_window", "Bundle": "incompatible_price_unit", "Few": "insufficient_historical_baseline"}
    keyed = quality.require_series_key(spark.createDataFrame([("s", "d", "m", "c", None, "u"), ("s", "x", "m", "c", "v", "u"), ("s", "d", "m", "c", "v", "u")], "state string, district string, market string, commodity string, variety string, price_unit string"), "s", "d")
    assert [r.key_reason for r in keyed.collect()] == ["missing_variety", "outside_case", None]


def test_a_report_of_many_splits_equals_one_task(spark, tmp_path):
    import random

    r = random.Random(4)
    lines = ["Daily report on 03-Dec-2023 State/UT : Tamil Nadu", "head", "Commodity,Arrivals,Unit"]
    for k in range(400):
        what = r.random()
        if what < 0.08:
            lines.append(f'"Market Name : M{k}, x"' + "," * 7)
        elif what < 0.1:
            lines.append("Commodity Group Name : Cereals" + "," * 7)
        elif what < 0.13:
            lines.append("," * 7)
        elif what < 0.15:
            lines.append("short,row")
        else:
            lines.append(f"{r.choice(['', '', '', f'C{k}'])},{k}.5,Tonnes,V,1,3,2,Rs")
    folder = tmp_path / "reports"
    folder.mkdir()
    put(folder, "a.csv", "\n".join(lines))
    put(folder, "b.csv", "\n".join([lines[0].replace("03-Dec", "04-Dec"), *lines[1:150]]))
    put(folder, "untitled.csv", "\n".join(lines[1:]))
    put(folder, "short.csv", lines[0])
    fields = ["report_date", "report_state", "Market", "Commodity", *read.REPORT[1:], "parse_error"]
    whole = read.report_rows(read.report_titles(read.report_files(spark, str(folder))))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        split = read.large_report_rows(spark, str(folder))
        got, splits = split.select(*fields).collect(), split.select("path", "split_start").distinct().count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = whole.select(*fields).collect()
    key = lambda row: str(tuple(row))
    assert splits > 15 and len(want) > 400 and sorted(got, key=key) == sorted(want, key=key)
    assert len({x.Market for x in want}) > 20


def test_fill_over_parts_of_a_file(spark):
    import itertools

    choices = [(None, None), ("m", None), (None, "c"), ("n", "d")]
    rows = [(f, 10 * f + k, k // 2, *x) for f, row in enumerate(itertools.product(choices, repeat=4)) for k, x in enumerate(row)]
    lines = spark.createDataFrame(rows, "file int, line int, part int, market string, commodity string")
    plain = quality.fill_context(lines, "file", "line", "market", "commodity").collect()
    assert sorted(map(str, quality.fill_context(lines, "file", "line", "market", "commodity", "part").collect())) == sorted(map(str, plain))

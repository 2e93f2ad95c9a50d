"""The paged source against a small server on this machine."""

from __future__ import annotations

import json
import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.errors import PySparkException

from shockline import cli
from shockline.operators import normalize
from shockline.sources import pages


class Server(ThreadingHTTPServer):
    """Serves `records`; counts how often each offset was asked for; fails the first time at the offsets in `fails`."""

    def __init__(self):
        self.records, self.asked, self.fails, self.short = [], Counter(), set(), False
        super().__init__(("127.0.0.1", 0), Handler)

    @property
    def url(self):
        return f"http://127.0.0.1:{self.server_port}/resource"


class Handler(BaseHTTPRequestHandler):
    def do_GET(self):
        q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
        s, at, limit = self.server, int(q["offset"]), int(q["limit"])
        if q.get("api-key") != "k" or at in s.fails:
            s.fails.discard(at)
            self.send_error(503)
            return
        if limit > 1:
            s.asked.update(range(at, min(at + limit, len(s.records))))
        found = s.records[at : at + limit]
        body = json.dumps({"total": len(s.records), "records": found[:-1] if s.short and limit > 1 else found}).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


@pytest.fixture
def server():
    s = Server()
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield s
    s.shutdown()


def record(k):
    return {"state": "S", "District": "D", "market": "M", "commodity": f"C{k}", "arrival_date": "03/12/2023", "min_price": k, "modal_price": k + 1, "max_price": "x" if k % 10 == 0 else k + 2}


def test_a_batch_reads_every_record_once(spark, server):
    server.records, server.fails = [record(k) for k in range(253)], {40, 100}
    df = pages.pages(spark, server.url, "k", limit=20, pages=3)
    assert df.rdd.getNumPartitions() == 5
    server.asked.clear()
    got = df.collect()
    assert sorted(r.offset for r in got) == list(range(253)) and set(server.asked.values()) == {1}
    assert json.loads(next(r.record for r in got if r.offset == 7)) == record(7)
    rows = normalize.mandi(pages.price_records(df), price_unit="Rs")
    assert rows.where("reason is null").count() == 227 and {r.reason for r in rows.where("reason is not null").collect()} == {"invalid_max_price"}
    server.records = []
    assert pages.pages(spark, server.url, "k").count() == 0


def test_a_short_page_is_an_error(spark, server):
    server.records, server.short = [record(k) for k in range(30)], True
    with pytest.raises(PySparkException, match="29 of 30"):
        pages.pages(spark, server.url, "k", limit=50).collect()
    for key, limit in (("", 10), ("k", 101)):
        with pytest.raises((PySparkException, ValueError)):
            pages.pages(spark, server.url, key, limit=limit).collect()


def test_a_restart_reads_each_page_once(spark, server, tmp_path):
    server.records = [record(k) for k in range(90)]

    def run():
        df = pages.pages(spark, server.url, "k", stream=True, limit=20, pages=2, start=10)
        q = df.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").start(f"{tmp_path}/out")
        q.processAllAvailable()
        q.stop()
        return sorted(r.offset for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert run() == list(range(10, 90))
    server.records += [record(k) for k in range(90, 135)]
    assert run() == list(range(10, 135))
    assert run() == list(range(10, 135))
    assert set(server.asked.values()) == {1} and set(server.asked) == set(range(10, 135))


def test_fetch_command(spark, server, tmp_path, monkeypatch, capsys):
    server.records = [record(k) for k in range(25)]
    monkeypatch.setenv("PAGES_KEY", "k")
    assert cli.main(["fetch-pages", "--url", server.url, "--unit", "Rs", "--limit", "10", "--out", str(tmp_path)]) == 0
    assert spark.read.json(f"{tmp_path}/replay").count() == 22 and spark.read.json(f"{tmp_path}/rejected").count() == 3
    audit = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (audit["row_count"], audit["accepted_count"], audit["rejected_count"], audit["market_values"]) == (25, 22, 3, ["M"])
    monkeypatch.delenv("PAGES_KEY")
    with pytest.raises(ValueError):
        cli.main(["fetch-pages", "--url", server.url, "--unit", "Rs", "--out", str(tmp_path)])


def test_preflight_names_what_is_missing(spark, tmp_path, monkeypatch, capsys):
    for name in ("SHOCK_SOURCE", "SHOCK_LAKE", "SHOCK_CHECKPOINTS", "SHOCK_WATERMARK_HOURS", "SHOCK_LOOKAHEAD_DAYS"):
        monkeypatch.delenv(name, raising=False)
    assert cli.main(["preflight"]) == 1
    assert "settings" in json.loads(capsys.readouterr().out.strip().splitlines()[-1])["failed"]
    for name, value in {"SHOCK_SOURCE": f"{tmp_path}/in", "SHOCK_LAKE": str(tmp_path), "SHOCK_CHECKPOINTS": f"{tmp_path}/c", "SHOCK_WATERMARK_HOURS": "24", "SHOCK_LOOKAHEAD_DAYS": "14"}.items():
        monkeypatch.setenv(name, value)
    assert cli.main(["preflight"]) == 1
    assert set(json.loads(capsys.readouterr().out.strip().splitlines()[-1])["failed"]) == {"reference_markets", "reference_boundaries", "source"}
    (tmp_path / "in").mkdir()
    spark.createDataFrame([("m1", "d1", "st", "S", "North", "Yard")], "market_id string, district_id string, state_id string, source_state string, source_district string, source_market string").write.parquet(f"{tmp_path}/reference/markets")
    spark.createDataFrame([("d1", "S", "North", '{"type":"Point","coordinates":[1,1]}'), ("d2", "S", "North", "{")], "district_id string, source_state string, source_district string, geometry_json string").write.parquet(f"{tmp_path}/reference/boundaries")
    assert cli.main(["preflight"]) == 1
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["failed"] == {"boundary_names": "1 names of several rows", "boundary_shapes": "1 shapes that can't be read"}
    spark.createDataFrame([("d1", "S", "North", '{"type":"Point","coordinates":[1,1]}')], "district_id string, source_state string, source_district string, geometry_json string").write.mode("overwrite").parquet(f"{tmp_path}/reference/boundaries")
    assert cli.main(["preflight"]) == 0

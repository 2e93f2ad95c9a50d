"""python -m shockline.cli COMMAND: preflight, stream, reconcile, health, replay, fetch-pages, audit-reports, import-reports, boundary, case, merge-gold, compact-gold, index."""

from __future__ import annotations

import argparse
import json
import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import ConfidencePolicy, EventTimePolicy, LookAhead, Settings, SignalPolicy
from .functions.geo import parse_geojson
from .functions.identity import place_key
from .operators import case, geography, normalize, quality
from .schemas import GOLD, MANDI
from .sources import pages, read, write
from .sources.committed import CommittedTable
from .streaming import pipeline

TABLES = {
    "raw_events": "bronze/raw_events", "mandi_prices": "silver/mandi_prices", "weather_events": "silver/weather_events", "flood_events": "silver/flood", "dlq_events": "silver/dlq_events",
    "unresolved_markets": "silver/unresolved_markets", "associations": "gold/associations", "market_shock_signals": "gold/market_shock_signals",
}


def session(name: str) -> SparkSession:
    b = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC")
    for k, v in pipeline.STATE_STORE.items():
        b = b.config(k, v)
    return b.getOrCreate()


def import_reports(spark: SparkSession, files: str, snapshot: str, scope: str, market: str, commodity: str, unit: str) -> DataFrame:
    """Rows of a market's commodity as envelopes; rejects in order: broken row, unit, geography, normalizer."""
    rows = read.report_rows(read.report_titles(read.report_files(spark, files)))
    rows = rows.where((F.col("Market") == market) & (F.col("Commodity") == commodity) | F.col("parse_error").isNotNull())
    rows = rows.withColumn("State", F.col("report_state")).withColumn("Arrival_Date", F.date_format("report_date", "dd/MM/yyyy"))
    markets = read.market_snapshot(spark, snapshot, scope).withColumnRenamed("source_district", "District")
    placed = geography.unique_match(rows, markets, {"State": "source_state", "Market": "source_market"}, "District", "case_reference_not_found", "ambiguous_case_reference")
    made = normalize.mandi(placed, source="agmarknet_2_state_daily_report").withColumnRenamed("reason", "_normalizer")
    first = F.coalesce("parse_error", F.when(~F.coalesce(F.col("Price_Unit") == unit, F.lit(False)), "incompatible_price_unit"), F.col("mapping_reason"), F.col("_normalizer"))
    return made.withColumn("reason", first).drop("_normalizer")


def preflight(spark: SparkSession) -> dict[str, str]:
    """What has to be mended before a stream is started, by the name of the check; empty if nothing has."""
    try:
        c = Settings.from_environment()
    except ValueError as e:
        return {"settings": str(e)}
    failed, dims = {}, {}
    for kind in ("markets", "boundaries"):
        try:
            dims[kind] = read.dimension(spark, f"{c.lake}/reference/{kind}", kind)
            if dims[kind].isEmpty():
                failed[f"reference_{kind}"] = "no rows"
        except AnalysisException as e:
            failed[f"reference_{kind}"] = str(e).splitlines()[0]
    if c.source_format != "kafka" and write._table(spark, c.source, "text") is None:
        failed["source"] = f"{c.source} can't be read"
    for kind, keys in (("markets", ["source_state", "source_district", "source_market"]), ("boundaries", ["source_state", "source_district"])):
        if kind in dims:
            n = dims[kind].groupBy(*(place_key(k) for k in keys)).count().where("count > 1").count()
            if n:
                failed[f"{kind[:-3] + 'y' if kind == 'boundaries' else 'market'}_names"] = f"{n} names of several rows"
    if "boundaries" in dims:
        n = dims["boundaries"].where(parse_geojson("geometry_json").isNull()).count()
        if n:
            failed["boundary_shapes"] = f"{n} shapes that can't be read"
    return failed


def main(args: Sequence[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="shockline", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("stream")
    s.add_argument("--once", action="store_true")
    sub.add_parser("reconcile")
    h = sub.add_parser("health")
    h.add_argument("--max-dead-rate", type=float, default=0.05)
    r = sub.add_parser("replay")
    for o in ("--files", "--topic", "--out"):
        r.add_argument(o, required=True)
    r.add_argument("--per-second", type=float, default=10.0)
    b = sub.add_parser("boundary")
    for o in ("--source", "--state", "--district", "--out"):
        b.add_argument(o, required=True)
    c = sub.add_parser("case")
    for o in ("--prices", "--shocks", "--case", "--out"):
        c.add_argument(o, required=True)
    for name in ("audit-reports", "import-reports"):
        a = sub.add_parser(name)
        a.add_argument("--files", required=True)
        if name == "audit-reports":
            for o in ("--state", "--first", "--last", "--out"):
                a.add_argument(o, required=True)
            for o in ("--snapshot", "--scope", "--market", "--commodity", "--unit", "--pre-event-end"):
                a.add_argument(o)
        else:
            for o in ("--snapshot", "--scope", "--market", "--commodity", "--unit", "--out"):
                a.add_argument(o, required=True)
    for name in ("merge-gold", "index"):
        a = sub.add_parser(name)
        a.add_argument("--documents", required=True)
        a.add_argument("--out", required=True)
    sub.add_parser("preflight")
    sub.add_parser("compact-gold")
    f = sub.add_parser("fetch-pages")
    for o in ("--url", "--unit", "--out"):
        f.add_argument(o, required=True)
    f.add_argument("--limit", type=int, default=100)
    o = p.parse_args(args)
    spark = session(f"shockline-{o.command}")
    if o.command == "preflight":
        failed = preflight(spark)
        print(json.dumps({"failed": failed}))
        return int(bool(failed))
    if o.command == "compact-gold":
        print(json.dumps({"version": CommittedTable(spark, f"{Settings.from_environment().lake}/{TABLES['market_shock_signals']}").compact()}))
        return 0
    if o.command == "fetch-pages":
        rows = normalize.mandi(pages.price_records(pages.pages(spark, o.url, os.environ.get("PAGES_KEY", ""), limit=o.limit)), price_unit=o.unit).persist()
        write.import_artifacts(rows, o.out, {"url": o.url, "price_unit": o.unit})
        named = rows.withColumnsRenamed({c: c.lower() for c in pages.FIELDS})
        report = quality.coverage_report(named.withColumn("day", F.to_date("event_time")), "day", ["state", "district", "market", "commodity"], ["variety", "modal_price"]).first()
        print(json.dumps(report.asDict(), default=str))
        rows.unpersist()
        return 0
    if o.command in ("stream", "reconcile", "health"):
        c = Settings.from_environment()
        policy, ahead = EventTimePolicy(c.watermark_hours), LookAhead(c.lookahead_days)
        if o.command == "stream":
            queries = pipeline.start(spark, c.source, c.lake, c.checkpoints, policy, ahead, c.source_format, o.once)
            if o.once:
                for q in queries:
                    q.awaitTermination()
            else:
                pipeline.supervise(spark)
        elif o.command == "reconcile":
            dims = [read.dimension(spark, f"{c.lake}/reference/{d}", d) for d in ("markets", "boundaries")]
            pipeline.reconcile(spark, c.lake, *dims, policy, ahead).write.mode("append").partitionBy("shock_type").parquet(f"{c.lake}/gold/reconciled_associations")
        else:
            opened = lambda n, t: lambda: write.signals_at(spark, f"{c.lake}/{t}") if n == "market_shock_signals" else write._table(spark, f"{c.lake}/{t}", "parquet")
            counts = quality.table_counts_or_failed(spark, {n: opened(n, t) for n, t in TABLES.items()})
            warnings = [r["warning"] for r in quality.health_warnings(counts, o.max_dead_rate).collect()]
            late = {r["query"]: r["late_rows"] for r in pipeline.measured(spark, c.lake).where("late_rows > 0").collect()}
            print(json.dumps({"counts": {r["table_name"]: r["row_count"] for r in counts.collect()}, "late_rows": late, "warnings": warnings}))
            return int(bool(warnings))
    elif o.command == "audit-reports":
        staged = read.stage_reports(read.report_titles(read.report_files(spark, o.files)), o.state, F.lit(o.first).cast("date"), F.lit(o.last).cast("date"))
        gaps = quality.missing_days(staged.where("outcome = 'kept'"), "report_date", F.lit(o.first).cast("date"), F.lit(o.last).cast("date"))
        made = {"outcomes": staged.groupBy("outcome").count(), "missing_days": gaps}
        if o.market:
            rows = import_reports(spark, o.files, o.snapshot, o.scope, o.market, o.commodity, o.unit)
            rows = rows.withColumnsRenamed({"Market": "market", "Commodity": "commodity", "Variety": "variety", "Price_Unit": "price_unit"}).withColumn("day", F.col("report_date"))
            made |= case.audit(rows, staged.select("path", "sha256", "report_date"), o.pre_event_end or o.first)
        for name, df in made.items():
            df.coalesce(1).write.mode("overwrite").json(f"{o.out}/{name}")
    elif o.command == "replay":
        publisher, wait = write.Publisher(write.FileProducer(o.out)), write.pace(o.per_second)
        for row in read.replay_folder(spark, o.files, MANDI).select("event_id", F.to_json(F.struct("*")).alias("value")).toLocalIterator():
            write.with_retry(lambda row=row: publisher.publish(o.topic, row["event_id"], row["value"]), write.transient)
            wait()
    elif o.command == "boundary":
        found = read.district_boundary(spark, o.source, "struct<state_name: string, district: string>", {"state_name": o.state, "district": o.district}, {})
        found.select("properties", F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.col("geometry").alias("coordinates"))).alias("geometry_json")).coalesce(1).write.mode("overwrite").json(o.out)
    elif o.command == "case":
        about = case.Case(**json.loads(spark.read.text(o.case, wholetext=True).first()["value"]))
        events = read.replay_folder(spark, o.prices, MANDI).where("event_type = 'mandi_price'").select("event_id", "event_time", "payload.*")
        shock = spark.read.json(o.shocks).select("event_id", "payload.*")
        write.merge_signals(case.analyze(events, shock, about, ConfidencePolicy(), SignalPolicy.from_environment()), o.out)
    elif o.command == "import-reports":
        rows = import_reports(spark, o.files, o.snapshot, o.scope, o.market, o.commodity, o.unit)
        write.import_artifacts(rows, o.out, {"market": o.market, "commodity": o.commodity, "price_unit": o.unit})
    elif o.command == "merge-gold":
        write.merge_signals(read.gold_documents(spark, o.documents, GOLD), o.out)
    else:
        write.index_documents(read.gold_documents(spark, o.documents, GOLD), path=o.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

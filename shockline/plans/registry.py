"""Registered queries, each beside its DuckDB twin."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ConfidencePolicy, LookAhead, SignalPolicy
from ..functions import geo, identity, scoring
from ..operators import associate, baseline, geography, normalize, quality, signal, tally, validate
from ..schemas import MANDI
from .tables import PRICES_SQL, REASON_SQL, SHOCKS_SQL, broker_records, prices, shocks, table

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}
CONFIDENCE, SIGNAL, AHEAD = ConfidencePolicy(), SignalPolicy(), LookAhead(14)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


# ---- identities and associations ------------------------------------------------------------------


@query("SELECT o_orderkey, sha256(concat_ws('|', o_orderkey, o_custkey, '1.0')) AS signal_id FROM orders")
def signal_id_hash(spark, d):
    ids = table(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("a"), F.col("o_custkey").cast("string").alias("b"))
    return ids.select("o_orderkey", identity.signal_id("a", "b").alias("signal_id"))


@query("SELECT event_id, sha256(concat('test|k', event_id, '|', strftime(ts, '%Y-%m-%dT%H:%M:%S'), CASE WHEN date_trunc('second', ts) = ts THEN '' ELSE strftime(ts, '.%f') END, '+00:00')) AS stable_id FROM events")
def event_id_hash(spark, d):
    return table(spark, d, "events").select("event_id", identity.event_id(F.lit("test"), F.concat(F.lit("k"), F.col("event_id").cast("string")), "ts").alias("stable_id"))


_ASSOCIATED = f"""{PRICES_SQL}, {SHOCKS_SQL}, assoc AS (
  SELECT s.shock_id, s.shock_time, s.shock_severity, p.event_id AS price_event_id, p.event_time AS price_event_time, s.district_id, p.market_id, p.commodity_id, p.modal_price,
         CAST(date_diff('day', CAST(s.shock_time AS DATE), CAST(p.event_time AS DATE)) AS INTEGER) AS days_after_shock
  FROM shocks s JOIN prices p ON p.district_id = s.district_id AND p.event_time BETWEEN s.shock_time AND s.shock_time + INTERVAL 14 DAY)"""


@query(f"WITH {_ASSOCIATED} SELECT shock_id, price_event_id, district_id, market_id, commodity_id, modal_price, days_after_shock FROM assoc")
def shock_price_associations(spark, d):
    out = associate.associate(shocks(spark, d), prices(spark, d), AHEAD)
    return out.select("shock_id", "price_event_id", "district_id", "market_id", "commodity_id", "modal_price", "days_after_shock")


# ---- baselines --------------------------------------------------------------------------------------


_GROUPED = "SELECT district_id, commodity_id, median(modal_price) AS median_price, count(*) AS sample_size, mad(modal_price) AS mad FROM prices"


@query(f"WITH {PRICES_SQL} {_GROUPED} WHERE event_time < TIMESTAMP '1999-01-01' GROUP BY 1, 2 HAVING count(*) >= 5")
def fixed_window_baseline_mad(spark, d):
    history = prices(spark, d).where("event_time < timestamp'1999-01-01'")
    return baseline.group_median_mad(history, ["district_id", "commodity_id"], "modal_price", 5)


_SEASONAL = """seasonal AS (
  SELECT t.district_id, t.commodity_id, t.target_day, median(h.modal_price) AS median_price, mad(h.modal_price) AS mad, CAST(count(*) AS INTEGER) AS sample_size,
         CAST(count(DISTINCT CAST(h.event_time AS DATE)) AS INTEGER) AS trading_days
  FROM (SELECT DISTINCT district_id, commodity_id, CAST(event_time AS DATE) AS target_day FROM %s) t
  JOIN prices h ON h.district_id = t.district_id AND h.commodity_id = t.commodity_id AND month(h.event_time) = month(t.target_day) AND CAST(h.event_time AS DATE) < t.target_day
  GROUP BY ALL HAVING count(*) >= 5)"""


@query(f"WITH {PRICES_SQL}, {_SEASONAL % 'prices'} SELECT district_id, commodity_id, target_day, median_price, mad, sample_size FROM seasonal")
def seasonal_baseline_per_target(spark, d):
    p = prices(spark, d)
    return baseline.seasonal_baseline(p, p, ["district_id", "commodity_id"], "event_time", "modal_price", 5).drop("season")


@query(f"WITH {PRICES_SQL}, {_SEASONAL % 'prices'} SELECT p.event_id, s.median_price, s.mad, s.sample_size FROM prices p JOIN seasonal s ON s.district_id = p.district_id AND s.commodity_id = p.commodity_id AND s.target_day = CAST(p.event_time AS DATE)")
def running_seasonal_baseline(spark, d):
    rows = baseline.running_baseline(prices(spark, d), ["district_id", "commodity_id"], "event_time", "modal_price")
    return rows.where("sample_size >= 5").select("event_id", "median_price", "mad", "sample_size")


@query(f"WITH {PRICES_SQL} SELECT 'all' AS series, median(modal_price) AS median_price, count(*) AS sample_size, mad(modal_price) AS mad FROM prices")
def one_series_median_mad(spark, d):
    """All prices as one group, dealt out over tasks."""
    return baseline.group_median_mad(prices(spark, d).select(F.lit("all").alias("series"), "modal_price"), ["series"], "modal_price", most=8192)


_ANOMALY = "(p.modal_price - s.median_price) / s.median_price * 100 AS deviation_pct, CASE WHEN s.mad <> 0 THEN (p.modal_price - s.median_price) / (1.4826 * s.mad) END AS robust_z_score"


def _anomalies(spark, d) -> DataFrame:
    p = prices(spark, d)
    base = baseline.group_median_mad(p, ["district_id", "commodity_id"], "modal_price", 5)
    rows = p.join(base, ["district_id", "commodity_id"])
    return rows.withColumn("deviation_pct", scoring.deviation_pct("modal_price", "median_price")).withColumn("robust_z_score", scoring.robust_z("modal_price", "median_price", "mad"))


@query(f"WITH {PRICES_SQL}, s AS ({_GROUPED} GROUP BY 1, 2 HAVING count(*) >= 5) SELECT p.event_id, {_ANOMALY} FROM prices p JOIN s ON s.district_id = p.district_id AND s.commodity_id = p.commodity_id")
def price_anomaly(spark, d):
    return _anomalies(spark, d).select("event_id", "deviation_pct", "robust_z_score")


@query(f"""WITH {PRICES_SQL}, s AS ({_GROUPED} GROUP BY 1, 2 HAVING count(*) >= 5), a AS (SELECT p.event_id, p.district_id, p.commodity_id, {_ANOMALY} FROM prices p JOIN s ON s.district_id = p.district_id AND s.commodity_id = p.commodity_id),
  c AS (SELECT commodity_id, median(deviation_pct) AS mid FROM a WHERE ascii(right(district_id, 1)) % 2 = 1 GROUP BY 1)
  SELECT event_id, deviation_pct - mid AS control_difference_pct FROM a LEFT JOIN c ON c.commodity_id = a.commodity_id WHERE ascii(right(district_id, 1)) % 2 = 0""")
def control_difference(spark, d):
    a = _anomalies(spark, d)
    odd = F.ascii(F.right("district_id", F.lit(1))) % 2 == 1
    return baseline.control_difference(a.where(~odd), a.where(odd), ["commodity_id"]).select("event_id", "control_difference_pct")


@query(f"WITH {PRICES_SQL} SELECT CAST(event_time AS DATE) AS day, state_id AS state, district_id AS district, market_id AS market, commodity_id AS commodity, count(*) AS observation_count, round(avg(modal_price), 6) AS avg_modal_price FROM prices GROUP BY ALL")
def daily_price_windows(spark, d):
    rows = prices(spark, d).select("event_time", F.col("state_id").alias("state"), F.col("district_id").alias("district"), F.col("market_id").alias("market"), F.col("commodity_id").alias("commodity"), "modal_price")
    out = baseline.daily_windows(rows)
    return out.select(F.to_date("window.start").alias("day"), "state", "district", "market", "commodity", "observation_count", F.round("avg_modal_price", 6).alias("avg_modal_price"))


# ---- signals ----------------------------------------------------------------------------------------


def judged_prices(spark, d) -> DataFrame:
    """A price has one baseline and one judgement, whatever shocks come before it."""
    p = baseline.with_baseline(prices(spark, d), ["district_id", "commodity_id"], "event_time", "modal_price", 5)
    return signal.judged(p.withColumns({"observed_price": F.col("modal_price"), "trading_days": F.col("sample_size")}), CONFIDENCE)


def signals(spark, d) -> DataFrame:
    """Associations with seasonal baselines, scored: the end-to-end slice."""
    rows = associate.associate(shocks(spark, d), judged_prices(spark, d), AHEAD, ["observed_price", "median_price", "deviation_pct", "robust_z_score", "data_confidence"])
    return signal.scored(rows, CONFIDENCE, SIGNAL)


_PARTS = """scored AS (
  SELECT *, sample_size >= 5 AS enough, 20 * shock_severity AS w, 30 * least(greatest(-coalesce(deviation_pct, 0), 0) / 30, 1) AS pr, 20 * least(greatest(-coalesce(robust_z_score, 0), 0) / 3, 1) AS ro,
         10 * greatest(0, 1 - days_after_shock / 14.0) AS te
  FROM (SELECT a.*, s.median_price, coalesce(s.sample_size, 0) AS sample_size, (a.modal_price - s.median_price) / s.median_price * 100 AS deviation_pct,
               CASE WHEN s.mad <> 0 THEN (a.modal_price - s.median_price) / (1.4826 * s.mad) END AS robust_z_score
        FROM assoc a LEFT JOIN seasonal s ON s.district_id = a.district_id AND s.commodity_id = a.commodity_id AND s.target_day = CAST(a.price_event_time AS DATE)))"""
_STRENGTH = "CASE WHEN enough THEN round(w + pr + ro + te, 2) END"
_LEVEL = f"CASE WHEN NOT enough THEN 'INSUFFICIENT_EVIDENCE' WHEN {_STRENGTH} >= 70 THEN 'HIGH' WHEN {_STRENGTH} >= 40 THEN 'MEDIUM' ELSE 'LOW' END"
_CONF = "round((least(sample_size / 20.0, 1) + least(sample_size / 10.0, 1) + 1 + 1 + 1 + 0 + 1 + CASE WHEN enough THEN 1 ELSE 0 END) / 8, 3)"
_SIGNALS = f"WITH {_ASSOCIATED}, {_SEASONAL % 'prices'}, {_PARTS}"


@query(f"""{_SIGNALS} SELECT sha256(concat_ws('|', shock_id, price_event_id, '1.0')) AS signal_id, shock_id, price_event_id, median_price AS baseline_price, deviation_pct, robust_z_score, days_after_shock,
  {_STRENGTH} AS signal_strength, {_LEVEL} AS signal_level, {_CONF} AS confidence FROM scored""")
def market_shock_signals(spark, d):
    s = signals(spark, d)
    return s.select(
        identity.signal_id().alias("signal_id"), "shock_id", "price_event_id", F.col("median_price").alias("baseline_price"), "deviation_pct", "robust_z_score", "days_after_shock",
        "signal_strength", "signal_level", F.col("data_confidence.value").alias("confidence"),
    )


@query(f"{_SIGNALS} SELECT shock_id, price_event_id, round(w, 2) AS shock_severity, round(pr, 2) AS price_decline, round(ro, 2) AS robust_abnormality, round(te, 2) AS temporal_proximity, CAST(0 AS DOUBLE) AS control_difference FROM scored WHERE enough")
def signal_components(spark, d):
    s = signals(spark, d).where("data_confidence.is_sufficient")
    return s.select("shock_id", "price_event_id", *(F.col("component_scores")[c].alias(c) for c in ("shock_severity", "price_decline", "robust_abnormality", "temporal_proximity", "control_difference")))


@query(f"{_SIGNALS} SELECT {_LEVEL} AS signal_level, count(*) AS n FROM scored GROUP BY 1")
def signal_level_counts(spark, d):
    return tally.level_counts(shocks(spark, d), judged_prices(spark, d), AHEAD, SIGNAL)


@query(f"{_SIGNALS} SELECT shock_id, price_event_id, concat_ws('|', CASE WHEN NOT enough THEN 'insufficient_historical_baseline' END, CASE WHEN NOT enough THEN 'required_fields_missing' END, 'control_comparison_unavailable') AS reasons, enough AS is_sufficient FROM scored")
def confidence_reasons(spark, d):
    s = signals(spark, d)
    return s.select("shock_id", "price_event_id", F.array_join("data_confidence.reasons", "|").alias("reasons"), F.col("data_confidence.is_sufficient").alias("is_sufficient"))


_QUALITY = """q AS (SELECT p_partkey, p_size AS obs, p_size % 13 AS days, (p_partkey % 5) / 10.0 AS miss, (p_partkey % 3) / 10.0 AS dup, p_partkey % 7 <> 0 AS geo, p_partkey % 2 = 0 AS ctl, p_partkey % 11 <> 0 AS known, p_partkey % 17 <> 0 AS fields FROM part)"""


@query(f"""WITH {_QUALITY} SELECT p_partkey, round((least(obs / 20.0, 1) + least(days / 10.0, 1) + (1 - miss) + (1 - dup) + CAST(geo AS INT) + CAST(ctl AS INT) + CAST(known AS INT) + CAST(fields AS INT)) / 8, 3) AS value,
  obs >= 5 AND geo AND known AND fields AS is_sufficient, concat_ws(',', CASE WHEN obs < 5 THEN 'insufficient_historical_baseline' END, CASE WHEN NOT geo THEN 'geography_not_canonicalized' END, CASE WHEN NOT known THEN 'shock_time_unknown' END,
  CASE WHEN NOT fields THEN 'required_fields_missing' END, CASE WHEN NOT ctl THEN 'control_comparison_unavailable' END, CASE WHEN miss > 0.2 THEN 'missing_data_rate_exceeds_policy' END, CASE WHEN dup > 0.1 THEN 'duplicate_rate_exceeds_policy' END) AS reasons FROM q""")
def data_confidence(spark, d):
    k = F.col("p_partkey")
    c = scoring.confidence(CONFIDENCE, F.col("p_size"), F.col("p_size") % 13, (k % 5) / 10, (k % 3) / 10, k % 7 != 0, k % 2 == 0, k % 11 != 0, k % 17 != 0)
    return table(spark, d, "part").select("p_partkey", c.alias("c")).select("p_partkey", "c.value", "c.is_sufficient", F.array_join("c.reasons", ",").alias("reasons"))


def gold_rows(spark, d) -> DataFrame:
    rows = signals(spark, d).where("median_price is not null")
    return signal.gold(rows, "replayed_historical", F.lit("2024-01-01 00:00:00").cast("timestamp"))


@query(f"""{_SIGNALS} SELECT sha256(concat_ws('|', shock_id, price_event_id, '1.0')) AS signal_id, CASE WHEN length(shock_id) % 2 = 1 THEN commodity_id ELSE ' ' END AS commodity, modal_price AS observed_price, {_LEVEL} AS signal_level,
  CASE WHEN median_price IS NULL THEN 'baseline_price,deviation_pct' ELSE '' END AS faults, CASE WHEN length(shock_id) % 2 = 1 THEN '' ELSE 'missing_commodity' END AS document_reason FROM scored""")
def gold_signals(spark, d):
    rows = signals(spark, d).withColumn("commodity", F.when(F.length("shock_id") % 2 == 1, F.col("commodity_id")).otherwise(" "))
    g = signal.gold(rows, "replayed_historical", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return g.select("signal_id", "commodity", "observed_price", "signal_level", F.array_join(signal.contract_faults(), ",").alias("faults"), F.coalesce(validate.document_reason(), F.lit("")).alias("document_reason"))


@query(f"""{_SIGNALS} SELECT round(avg({_STRENGTH}), 6) AS avg_signal_strength, round(avg({_CONF}), 6) AS avg_confidence, round(avg(deviation_pct), 6) AS avg_deviation_pct, round(avg(robust_z_score), 6) AS avg_robust_z_score
  FROM scored WHERE median_price IS NOT NULL""")
def dashboard_metrics(spark, d):
    m = tally.metrics(shocks(spark, d), judged_prices(spark, d).where("median_price is not null"), AHEAD, SIGNAL)
    return m.select(*(F.round(c, 6).alias(c) for c in m.columns))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS signal_id, o_custkey FROM orders WHERE o_orderkey % 3 <> 0""")
def gold_merge_insert_only(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("signal_id"), "o_custkey", "o_orderkey")
    batch = o.unionByName(o.where("o_orderkey % 2 = 0"))
    return signal.to_insert(batch, o.where("o_orderkey % 3 = 0")).select("signal_id", "o_custkey")


# ---- validation -------------------------------------------------------------------------------------


def _checked(spark, d) -> DataFrame:
    return validate.with_reason(validate.parse(broker_records(spark, d), MANDI), validate.mandi_rule(), validate.MANDI_REJECT)


@query(f"SELECT CASE WHEN r IS NULL THEN 'valid' ELSE 'invalid' END AS side, count(*) AS n FROM (SELECT {REASON_SQL} AS r FROM lineitem) GROUP BY 1")
def validate_split_counts(spark, d):
    valid, invalid = validate.split(_checked(spark, d))
    return valid.select(F.lit("valid").alias("side")).unionByName(invalid.select(F.lit("invalid").alias("side"))).groupBy("side").agg(F.count("*").alias("n"))


@query(f"SELECT \"offset\", r AS reason FROM (SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS \"offset\", {REASON_SQL} AS r FROM lineitem) WHERE r IS NOT NULL")
def dlq_reason_ladder(spark, d):
    return validate.split(_checked(spark, d))[1].select("offset", F.col(validate.REASON).alias("reason"))


_RAW_SQL = """CASE k WHEN 0 THEN '{not json' WHEN 1 THEN '[1,2]' WHEN 2 THEN 'null' ELSE
  '{' || CASE WHEN k <> 3 THEN '"event_id":"' || concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) || '",' ELSE '' END || '"event_type":"mandi_price","event_time":"'
  || CASE WHEN k = 4 THEN 'no time' ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' END || '","ingestion_time":"2024-01-01T00:00:00+00:00","source":"test","schema_version":"1.0","payload":{"state":"S","district":"'
  || CASE WHEN k = 5 THEN '  ' ELSE 'D' END || '",' || CASE WHEN k <> 6 THEN '"market":"M",' ELSE '' END || '"commodity":"' || l_returnflag || '",' || CASE WHEN k <> 7 THEN '"min_price":"1.00",' ELSE '' END
  || '"modal_price":"' || CASE WHEN k = 8 THEN '-1' ELSE CAST(l_linenumber AS VARCHAR) END || '","max_price":"7.00","price_unit":"u"}}' END"""


@query(f"""SELECT 'dlq:' || sha256(concat_ws('|', 'mandi-prices', 0, o, raw)) AS event_id, l_shipdate AS event_time, 'dead_letter_event' AS event_type, 'spark_validation' AS stage, reason
  FROM (SELECT *, CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS o, {_RAW_SQL} AS raw, {REASON_SQL} AS reason FROM (SELECT *, l_orderkey % 12 AS k FROM lineitem)) WHERE reason IS NOT NULL""")
def dead_letter_envelopes(spark, d):
    dead = validate.dead_letters(validate.split(_checked(spark, d))[1])
    return dead.select("event_id", F.col("event_time").cast("timestamp_ntz").alias("event_time"), "event_type", "payload.stage", "payload.reason")


@query("""SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_id % 6 = 0 THEN 'malformed_json' WHEN event_id % 6 = 1 THEN 'missing_event_id' WHEN event_id % 6 = 2 THEN 'invalid_event_time'
  WHEN event_id % 6 IN (3, 4) THEN 'required_payload_missing_or_invalid' END AS reason FROM events""")
def required_payload_rule(spark, d):
    k = F.col("event_id") % 6
    payload = F.struct(F.when(k != 3, "S").alias("state"), F.when(k == 4, " ").otherwise("D").alias("district"))
    event = F.struct(F.when(k != 1, F.col("event_id").cast("string")).alias("event_id"), F.when(k == 2, "soon").otherwise("2024-06-30T00:00:00+00:00").alias("event_time"), F.lit("t").alias("source"), payload.alias("payload"))
    records = table(spark, d, "events").select(F.col("event_id").cast("string").alias("own"), F.when(k == 0, "{").otherwise(F.to_json(event)).alias("raw_json"))
    rows = validate.parse(records, T.StructType([T.StructField(f, T.StringType()) for f in ("state", "district")]))
    checked = validate.with_reason(rows, validate.required_rule(["state", "district"]), validate.REQUIRED_REJECT)
    return checked.select(F.col("own").alias("event_id"), F.col(validate.REASON).alias("reason"))


@query("SELECT c_custkey, c_nationkey % 3 = 0 AS matches FROM customer")
def district_match(spark, d):
    k = F.col("c_nationkey")
    rows = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("d"), k).alias("district_id"), F.when(k % 3 == 0, F.concat(F.lit("d"), k)).when(k % 3 == 1, "x").alias("evidence_district_id"))
    return rows.select("c_custkey", signal.district_matches().alias("matches"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 7 = 1 THEN 'missing_market' WHEN p_partkey % 7 = 2 THEN 'missing_commodity' WHEN p_partkey % 7 = 3 THEN 'missing_variety' WHEN p_partkey % 7 = 4 THEN 'missing_price_unit'
  WHEN p_partkey % 7 = 5 THEN 'outside_case' END AS key_reason FROM part""")
def series_key_guard(spark, d):
    k = F.col("p_partkey") % 7
    rows = table(spark, d, "part").select(
        "p_partkey", F.lit("S").alias("state"), F.when(k == 5, "E").otherwise("D").alias("district"), F.when(k != 1, "m").alias("market"), F.when(k == 2, " ").otherwise(F.col("p_type")).alias("commodity"),
        F.when(k != 3, F.col("p_brand")).alias("variety"), F.when(k == 4, "").otherwise("u").alias("price_unit"),
    )
    return quality.require_series_key(rows, "S", "D").select("p_partkey", "key_reason")


@query("SELECT 'm' || s_suppkey AS market_id, n_nationkey AS feature FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def market_boundary(spark, d):
    n = table(spark, d, "nation")
    features = n.select(F.struct(F.col("n_name").alias("DISTRICT"), F.lit(None).cast("string").alias("name")).alias("properties"), F.col("n_nationkey").alias("feature"), F.lit("{}").alias("geometry_json"))
    markets = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("m"), "s_suppkey").alias("market_id"), F.lower("n_name").alias("source_district"))
    return geography.market_features(markets, features).where("geometry_json is not null").select("market_id", "feature")


@query(f"{_SIGNALS} SELECT modal_price AS observed_price, median_price AS baseline_price FROM scored WHERE sha256(concat_ws('|', shock_id, price_event_id, '1.0')) = (SELECT min(sha256(concat_ws('|', shock_id, price_event_id, '1.0'))) FROM scored WHERE median_price IS NOT NULL)")
def dashboard_detail(spark, d):
    g = gold_rows(spark, d)
    one = g.agg(F.min(F.struct("signal_id", "fixture_kind", "observed_price", "baseline_price")).alias("least")).select("least.*")  # in one pass
    return quality.dashboard_detail(one, "replayed_historical", F.col("signal_id"))


@query("SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS kafka_offset, CASE WHEN l_orderkey % 12 > 3 THEN concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) END AS source_event_id, CASE WHEN l_orderkey % 12 IN (0, 1, 2, 4) THEN NULL ELSE CAST(l_shipdate AS DATE) END AS source_event_date FROM lineitem")
def bronze_projection(spark, d):
    return validate.bronze(broker_records(spark, d)).select("kafka_offset", "source_event_id", "source_event_date")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type, ts AS event_time FROM events")
def json_envelope_parse(spark, d):
    e = table(spark, d, "events")
    raw = F.to_json(F.struct(F.col("event_id").cast("string").alias("event_id"), "event_type", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("event_time"), F.from_json("props", "k bigint").alias("payload")))
    rows = validate.parse(e.select(F.col("event_id").alias("key"), raw.alias("raw_json")), T.StructType([T.StructField("k", T.LongType())]))
    return rows.select(F.col("key").alias("event_id"), "payload.k", "event_type", F.col("event_time").cast("timestamp_ntz").alias("event_time"))


@query("SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'reconcile' ELSE 'process' END AS disposition FROM orders")
def late_event_disposition(spark, d):
    return table(spark, d, "orders").select("o_orderkey", validate.late_disposition("o_orderdate", F.lit("1998-01-01").cast("timestamp")).alias("disposition"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'missing_event_id' WHEN o_orderkey % 7 = 0 THEN 'missing_source' WHEN o_orderkey % 11 = 0 THEN 'missing_ingestion_time' END AS reason FROM orders""")
def envelope_validation(spark, d):
    k, ok = F.col("o_orderkey"), F.lit("x")
    rows = table(spark, d, "orders").select(
        k, F.when(k % 5 != 0, ok).alias("event_id"), ok.alias("event_type"), F.when(k % 7 != 0, ok).otherwise(" ").alias("source"), ok.alias("schema_version"), F.col("o_orderdate").alias("event_time"), F.when(k % 11 != 0, F.col("o_orderdate")).alias("ingestion_time")
    )
    return rows.select("o_orderkey", validate.envelope_reason().alias("reason"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount > 0.05 THEN 'shock_severity_out_of_range' WHEN l_quantity - 5 < 0 THEN 'observed_price_negative' WHEN l_suppkey % 9 = 0 THEN 'baseline_price_not_positive'
  WHEN l_linenumber - 2 < 0 THEN 'days_after_shock_negative' END AS reason FROM lineitem""")
def evidence_validation(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_discount") > 0.05, 2.0).otherwise(0.5).alias("shock_severity"), (F.col("l_quantity") - 5).alias("observed_price"), F.when(F.col("l_suppkey") % 9 == 0, 0.0).otherwise(1.0).alias("baseline_price"),
        (F.col("l_linenumber") - 2).alias("days_after_shock"), *(F.lit("x").alias(c) for c in ("district_id", "commodity_id", "shock_type")),
    )
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", validate.evidence_reason().alias("reason"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 6 = 1 THEN 'missing_district' WHEN p_partkey % 6 = 2 THEN 'invalid_min_price' WHEN p_partkey % 6 = 3 THEN 'negative_modal_price' WHEN p_partkey % 6 = 4 THEN 'price_order_invalid' END AS reason FROM part""")
def price_validation_reasons(spark, d):
    k = F.col("p_partkey") % 6
    rows = table(spark, d, "part").select(
        "p_partkey", F.when(k == 1, " ").otherwise("d").alias("district"), F.lit("m").alias("market"), F.col("p_type").alias("commodity"),
        F.when(k == 2, "abc").when(k == 5, F.lit(None)).otherwise("1").alias("min_price"), F.when(k == 3, "-2").when(k == 4, "9").otherwise("2").alias("modal_price"), F.lit("3").alias("max_price"),
    )
    return normalize.price_reason(rows).select("p_partkey", "reason")


@query("""WITH r AS (SELECT o_orderkey, o_orderkey % 9 AS k, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE o_orderkey % 9 WHEN 1 THEN 'invalid_arrival_date' WHEN 2 THEN 'missing_market' WHEN 3 THEN 'invalid_modal_price' WHEN 4 THEN 'missing_price_unit'
    WHEN 5 THEN 'negative_min_price' WHEN 6 THEN 'price_order_invalid' END AS reason FROM orders)
  SELECT o_orderkey, reason, CASE WHEN reason IS NULL THEN sha256('ogd_agmarknet|S|D|M|' || o_orderkey || '|' || CASE WHEN k = 7 THEN '' ELSE 'V' END || '|Rs|' || day || '|' || day || 'T00:00:00+00:00') END AS event_id FROM r""")
def normalize_mandi(spark, d):
    k = F.col("o_orderkey") % 9
    day = F.when(k == 1, "31/31/1999").when(k == 8, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    raw = table(spark, d, "orders").select(
        "o_orderkey", F.lit(" S ").alias("State"), F.lit("D").alias("District"), F.when(k == 2, "").otherwise("M").alias("Market"), F.col("o_orderkey").cast("string").alias("Commodity"), F.when(k == 7, F.lit(None)).otherwise("V").alias("Variety"),
        day.alias("Arrival_Date"), F.when(k == 5, "-1").otherwise("1").alias("Min_Price"), F.when(k == 3, "x").when(k == 6, "8").otherwise("2").alias("Modal_Price"), F.lit("3").alias("Max_Price"), F.when(k == 4, F.lit(None)).otherwise("Rs").alias("Price_Unit"),
    )
    return normalize.mandi(raw).select("o_orderkey", "reason", "event_id")


@query("""WITH r AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 1 THEN 'missing_district' WHEN 2 THEN 'invalid_daily_departure_pct' WHEN 3 THEN 'negative_rainfall' END AS reason FROM customer)
  SELECT c_custkey, reason, CASE WHEN reason IS NULL THEN sha256('imd|' || c_custkey || '|2024-06-30|2024-06-30T00:00:00+00:00') END AS event_id, CASE WHEN reason IS NULL THEN CAST(45.5 AS DOUBLE) END AS departure FROM r""")
def normalize_weather(spark, d):
    k = F.col("c_custkey") % 5
    raw = table(spark, d, "customer").select(
        "c_custkey", F.col("c_custkey").cast("string").alias("OBJ_ID"), F.lit("S").alias("State"), F.when(k != 1, "D").alias("District"), F.lit("30/06/2024").alias("Date"), F.when(k == 3, "-1").otherwise("9.5").alias("Daily Actual"), F.lit("5").alias("Daily Normal"),
        F.when(k == 2, "much").otherwise("45.5%").alias("Daily Departure Per"), F.lit("Excess").alias("Daily Category"),
    )
    n = normalize.weather(raw)
    return n.select("c_custkey", "reason", "event_id", F.when(F.col("reason").isNull(), F.col("payload.rainfall_departure_pct").cast("double")).alias("departure"))


@query("""SELECT s_suppkey, CASE s_suppkey % 4 WHEN 1 THEN 'missing_eventid' WHEN 2 THEN 'invalid_fromdate' END AS reason, CASE WHEN s_suppkey % 4 IN (0, 3) THEN sha256('gdacs|' || s_suppkey || '|2024-06-29T00:00:00+00:00') END AS event_id FROM supplier""")
def normalize_flood(spark, d):
    k = F.col("s_suppkey") % 4
    props = F.struct(F.when(k != 1, F.col("s_suppkey").cast("string")).alias("eventid"), F.when(k == 2, "soon").otherwise("2024-06-29").alias("fromdate"), F.lit("2024-07-02").alias("todate"), F.lit("Orange").alias("alertlevel"))
    rows = table(spark, d, "supplier").select("s_suppkey", props.alias("properties"), F.lit('{"type":"Point","coordinates":[1,2]}').alias("geometry_json"))
    return normalize.flood(rows).select("s_suppkey", "reason", "event_id")


@query("""SELECT s_suppkey, CASE s_suppkey % 6 WHEN 1 THEN 'severity_not_supported' WHEN 2 THEN 'invalid_event_window' WHEN 3 THEN 'invalid_source_url' WHEN 4 THEN 'invalid_artifact_sha256' END AS reason,
  CASE WHEN s_suppkey % 6 IN (0, 5) THEN sha256('nrsc_ndem_rapid_assessment|' || s_suppkey || '|S|D|2023-12-05|2023-12-05T00:00:00+00:00') END AS event_id FROM supplier""")
def normalize_observed_flood(spark, d):
    k = F.col("s_suppkey") % 6
    rows = table(spark, d, "supplier").select(
        "s_suppkey", F.col("s_suppkey").cast("string").alias("map_id"), *(F.lit(v).alias(c) for c, v in (("source_provider", "P"), ("source_report_title", "T"), ("state", "S"), ("district", "D"), ("observation_date", "2023-12-05"), ("event_window_start", "2023-12-01"), ("inundated_area_hectares", "12.5"))),
        F.when(k == 2, "2023-12-04").otherwise("2023-12-06").alias("event_window_end"), F.when(k == 3, "http://ndem.nrsc.gov.in/x").otherwise("https://ndem.nrsc.gov.in/x").alias("source_url"), F.when(k == 4, "ff").otherwise(F.repeat(F.lit("a"), 64)).alias("artifact_sha256"), F.when(k == 1, 0.5).alias("severity"),
    )
    return normalize.observed_flood(rows).select("s_suppkey", "reason", "event_id")


# ---- geography --------------------------------------------------------------------------------------


def _markets(spark, d) -> DataFrame:
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).where("s_suppkey % 7 <> 0")
    one = s.select(F.concat(F.lit("m"), "s_suppkey").alias("market_id"), F.concat(F.lit("d"), "n_nationkey").alias("district_id"), F.lit("st").alias("state_id"), F.lit("state").alias("source_state"), F.lower("n_name").alias("source_district"), F.concat(F.lit(" "), "s_name").alias("source_market"), "s_suppkey")
    again = one.where("s_suppkey % 11 = 0").withColumn("market_id", F.concat("market_id", F.lit("x")))
    return one.unionByName(again).drop("s_suppkey")


def _price_places(spark, d) -> DataFrame:
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select("s_suppkey", F.lit(" State").alias("state"), F.col("n_name").alias("district"), F.col("s_name").alias("market"), F.lit(" Rice ").alias("commodity"))


_RESOLVED = """SELECT s_suppkey, CASE WHEN s_suppkey % 7 <> 0 AND s_suppkey % 11 <> 0 THEN 'm' || s_suppkey END AS market_id, CASE WHEN s_suppkey % 7 <> 0 AND s_suppkey % 11 <> 0 THEN 'd' || s_nationkey END AS district_id, sha256('RICE') AS commodity_id,
  CASE WHEN s_suppkey % 7 = 0 THEN 'market_reference_not_found' WHEN s_suppkey % 11 = 0 THEN 'ambiguous_market_reference' END AS mapping_reason FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


@query(_RESOLVED)
def market_resolution(spark, d):
    return geography.resolve_markets(_price_places(spark, d), _markets(spark, d)).select("s_suppkey", "market_id", "district_id", "commodity_id", "mapping_reason")


@query(f"SELECT s_suppkey, mapping_reason FROM ({_RESOLVED}) WHERE market_id IS NULL")
def unresolved_market(spark, d):
    return geography.resolve_markets(_price_places(spark, d), _markets(spark, d)).where("mapping_status = 'unresolved'").select("s_suppkey", "mapping_reason")


@query("""SELECT c_custkey, CASE WHEN c_nationkey % 5 NOT IN (0, 1) THEN 'd' || c_nationkey END AS district_id, CASE c_nationkey % 5 WHEN 0 THEN 'case_reference_not_found' WHEN 1 THEN 'ambiguous_case_reference' END AS mapping_reason FROM customer""")
def unique_match_resolution(spark, d):
    n = table(spark, d, "nation").where("n_nationkey % 5 <> 0").select(F.concat(F.lit("d"), "n_nationkey").alias("district_id"), F.upper("n_name").alias("source_district"), "n_nationkey")
    ref = n.unionByName(n.where("n_nationkey % 5 = 1")).drop("n_nationkey")
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("district"))
    return geography.unique_match(rows, ref, {"district": "source_district"}, "district_id", "case_reference_not_found", "ambiguous_case_reference").select("c_custkey", "district_id", "mapping_reason")


def _boundaries(spark, d) -> DataFrame:
    """Nations as unit squares on a line; the last ones are missing."""
    k = F.col("n_nationkey")
    ring = F.format_string('{"type":"Polygon","coordinates":[[[%d,0],[%d,0],[%d,1],[%d,1],[%d,0]]]}', k, k + 1, k + 1, k, k)
    return table(spark, d, "nation").where("n_nationkey < 20").select(F.concat(F.lit("d"), k).alias("district_id"), F.lit("s").alias("source_state"), F.col("n_name").alias("source_district"), ring.alias("geometry_json"))


def _weather(spark, d) -> DataFrame:
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(F.col("c_custkey").cast("string").alias("event_id"), F.lit("2024-06-30").cast("timestamp").alias("event_time"), F.lit("S").alias("state"), F.lower("n_name").alias("district"), (F.col("c_acctbal") / 50).alias("rainfall_departure_pct"), F.lit("o").alias("imd_object_id"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS shock_id, 'd' || c_nationkey AS district_id, CAST(least(1.0, greatest(0.0, c_acctbal / 50 / 100)) AS DOUBLE) AS shock_severity FROM customer WHERE c_nationkey < 20")
def weather_severity_shocks(spark, d):
    return geography.weather_shocks(_weather(spark, d), _boundaries(spark, d)).select("shock_id", "district_id", "shock_severity")


@query("SELECT CAST(c_custkey AS VARCHAR) AS event_id, 'district_reference_not_found' AS mapping_reason FROM customer WHERE c_nationkey >= 20")
def unresolved_weather(spark, d):
    return geography.unresolved_weather(_weather(spark, d), _boundaries(spark, d)).select("event_id", "mapping_reason")


def _floods(spark, d) -> DataFrame:
    """By the key: a district's name; neither name nor shape; a broken shape; else a small square around a point."""
    k, m = F.col("c_custkey"), F.col("c_custkey") % 5
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    x, y = k % 30 - 2, k % 4 - 1
    shape = F.format_string('{"type":"MultiPolygon","coordinates":[[[[%d.25,%d.25],[%d.75,%d.25],[%d.75,%d.75],[%d.25,%d.75],[%d.25,%d.25]]]]}', x, y, x, y, x, y, x, y, x, y)
    return rows.select(
        k.cast("string").alias("event_id"), F.lit("2024-06-29").cast("timestamp").alias("event_time"), F.lit("f").alias("source_event_id"), F.when(m == 0, "2024-06-28").alias("event_start"),
        F.when(m == 2, '{"type":"Blob"}').when(m > 2, shape).alias("geometry_json"), F.when(m == 0, "S").alias("reported_state"), F.when(m == 0, F.col("n_name")).alias("reported_district"),
    )


@query("SELECT CAST(c_custkey AS VARCHAR) AS shock_id, 'd' || c_nationkey AS district_id, DATE '2024-06-28' AS shock_day FROM customer WHERE c_custkey % 5 = 0 AND c_nationkey < 20")
def district_reported_shocks(spark, d):
    return geography.reported_flood_shocks(_floods(spark, d), _boundaries(spark, d)).select("shock_id", "district_id", F.to_date("shock_time").alias("shock_day"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS shock_id, 'd' || (c_custkey % 30 - 2) AS district_id FROM customer WHERE c_custkey % 5 > 2 AND c_custkey % 4 = 1 AND c_custkey % 30 - 2 BETWEEN 0 AND 19")
def polygon_intersects(spark, d):
    return geography.geometry_flood_shocks(_floods(spark, d), _boundaries(spark, d)).select("shock_id", "district_id")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS event_id, CASE WHEN c_custkey % 5 = 0 THEN 'reported_district_reference_not_found' WHEN c_custkey % 5 = 1 THEN 'missing_flood_geometry' WHEN c_custkey % 5 = 2 THEN 'invalid_flood_geometry' ELSE 'flood_geometry_did_not_intersect_reference' END AS mapping_reason
  FROM customer WHERE CASE WHEN c_custkey % 5 = 0 THEN c_nationkey >= 20 WHEN c_custkey % 5 < 3 THEN true ELSE NOT (c_custkey % 4 = 1 AND c_custkey % 30 - 2 BETWEEN 0 AND 19) END""")
def unresolved_floods(spark, d):
    return geography.unresolved_floods(_floods(spark, d), _boundaries(spark, d)).select("event_id", "mapping_reason")


@query("""WITH p AS (SELECT p_partkey, p_partkey % 260 / 10.0 AS lon, p_size / 40.0 AS lat FROM part), h AS (SELECT *, lon >= 0 AND lon < 20 AND lat >= 0 AND lat < 1 AS inside FROM p)
  SELECT p_partkey, CASE WHEN inside AND floor(lon) <> 3 THEN 'd' || CAST(floor(lon) AS INTEGER) END AS district_id, CASE WHEN NOT inside THEN 'unresolved' WHEN floor(lon) = 3 THEN 'ambiguous' ELSE 'point_in_polygon' END AS mapping_status FROM h""")
def point_in_polygon(spark, d):
    areas = _boundaries(spark, d).select("district_id", F.lit("s").alias("state_id"), F.lit("v1").alias("boundary_version"), geo.parse_geojson("geometry_json").alias("geometry"))
    areas = areas.unionByName(areas.where("district_id = 'd3'"))
    points = table(spark, d, "part").select("p_partkey", (F.col("p_partkey") % 260 / 10).alias("lon"), (F.col("p_size") / 40).alias("lat"))
    return geography.locate_points(points, areas, "p_partkey").select("p_partkey", "district_id", "mapping_status")


@query("""SELECT p_partkey, s_suppkey FROM part JOIN supplier ON (p_size - s_nationkey) * (p_size - s_nationkey) + (p_partkey % 40 - s_suppkey % 40) * (p_partkey % 40 - s_suppkey % 40) <= 1.15 * 1.15""")
def polygon_pairs_many_vertices(spark, d):
    """Circles of 240 points each; by their radii two meet where the distance of their centres is at most 1.15."""
    def circle(x, y, radius: float):
        angle = lambda i: i * (2 * math.pi / 240)
        return F.array(F.array(F.transform(F.sequence(F.lit(0), F.lit(239)), lambda i: F.array(x + radius * F.cos(angle(i)), y + radius * F.sin(angle(i))))))

    a = table(spark, d, "part").select("p_partkey", circle(F.col("p_size"), F.col("p_partkey") % 40, 0.45).alias("geometry"))
    b = table(spark, d, "supplier").select("s_suppkey", circle(F.col("s_nationkey"), F.col("s_suppkey") % 40, 0.7).alias("geometry"))
    return geography.spatial_pairs(a, b, "p_partkey", "s_suppkey")


_CONIC = geo.ConicIndia()


@query(f"""WITH RECURSIVE places AS (
  SELECT p_partkey, p_size * 10000.0 AS dx, {_CONIC.rho0!r} + p_partkey % 100 * 10000.0 AS dy, pow(sqrt(pow(p_size * 10000.0, 2) + pow({_CONIC.rho0!r} + p_partkey % 100 * 10000.0, 2)) / {_CONIC.reach!r}, 1 / {_CONIC.n!r}) AS t FROM part
), step AS (
  SELECT *, pi() / 2 - 2 * atan(t) AS phi, 0 AS i FROM places
  UNION ALL SELECT p_partkey, dx, dy, t, pi() / 2 - 2 * atan(t * pow((1 - {_CONIC.e!r} * sin(phi)) / (1 + {_CONIC.e!r} * sin(phi)), {_CONIC.e!r} / 2)), i + 1 FROM step WHERE i < 12
) SELECT p_partkey, round({_CONIC.LON0!r} + degrees(atan2(dx, dy) / {_CONIC.n!r}), 9) AS lon, round(degrees(phi), 9) AS lat FROM step WHERE i = 12""")
def lcc_inverse(spark, d):
    at = _CONIC.inverse(4_000_000.0 + F.col("p_size") * 10_000, F.lit(4_000_000.0) - (F.col("p_partkey") % 100) * 10_000)
    return table(spark, d, "part").select("p_partkey", at.alias("g")).select("p_partkey", F.round("g.lon", 9).alias("lon"), F.round("g.lat", 9).alias("lat"))


# ---- quality ----------------------------------------------------------------------------------------


@query("""WITH c AS (SELECT p_brand AS variety, p_type, count(*) FILTER (l_shipdate < TIMESTAMP '2000-01-01') AS b, count(*) FILTER (l_shipdate >= TIMESTAMP '2000-01-01') AS e FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
  SELECT p_type, variety, b AS baseline_rows, e AS event_rows FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY b DESC, lower(variety), variety) AS r FROM c WHERE e > 0 AND b >= 5) WHERE r = 1""")
def series_selection_top1(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select("p_type", F.col("p_brand").alias("variety"), F.lit("u").alias("price_unit"), F.col("l_shipdate").alias("t"))
    day = lambda s: F.lit(s).cast("timestamp")
    c = quality.series_coverage(rows, ["p_type", "variety", "price_unit"], "t", (day("1900-01-01"), day("1999-12-31 23:59:59.999999")), (day("2000-01-01"), day("2100-01-01")))
    return quality.select_series(c, ["p_type"], "u", 5).select("p_type", "variety", "baseline_rows", "event_rows")


@query("""SELECT l_suppkey, l_orderkey FROM (SELECT l_suppkey, l_orderkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey) AS r FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-06-30') WHERE r = 1""")
def first_target_in_window(spark, d):
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_shipdate")
    return quality.first_in_window(rows, ["l_suppkey"], "l_shipdate", "l_orderkey", F.lit("1999-01-01").cast("timestamp"), F.lit("1999-06-30").cast("timestamp")).select("l_suppkey", "l_orderkey")


@query("""SELECT coalesce(CASE WHEN p_size > 25 THEN p_brand END, '<unspecified>') AS variety, count(*) AS row_count, count(DISTINCT CAST(l_shipdate AS DATE)) AS day_count, min(CAST(l_shipdate AS DATE)) AS first_day, max(CAST(l_shipdate AS DATE)) AS last_day
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def coverage_by_variety(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return quality.coverage(rows.select(F.when(F.col("p_size") > 25, F.col("p_brand")).alias("variety"), F.to_date("l_shipdate").alias("day")), "variety", "day")


@query("""SELECT count(*) AS row_count, count(*) FILTER (o_orderkey % 4 <> 0) AS accepted_count, count(*) FILTER (o_orderkey % 4 = 0) AS rejected_count, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day,
  array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS status_values, count(*) FILTER (o_custkey % 3 = 0) / count(*) AS name_missing_rate FROM orders""")
def coverage_report_missing_rates(spark, d):
    rows = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"), F.col("o_orderstatus").alias("status"), F.when(F.col("o_custkey") % 3 == 0, " ").otherwise("n").alias("name"), F.when(F.col("o_orderkey") % 4 == 0, "bad").alias("reason"))
    return quality.coverage_report(rows, "day", ["status"], ["name"]).withColumn("status_values", F.array_join("status_values", ","))


@query("""SELECT CAST(d AS DATE) AS missing_day FROM (SELECT unnest(generate_series(DATE '1990-01-01', DATE '2009-12-31', INTERVAL 1 DAY)) AS d) WHERE CAST(d AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderdate IS NOT NULL)""")
def missing_dates(spark, d):
    rows = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"))
    return quality.missing_days(rows, "day", F.lit("1990-01-01").cast("date"), F.lit("2009-12-31").cast("date"))


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS content_hash, count(*) AS copies FROM documents GROUP BY text")
def content_hash_dedup(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("content_hash"))
    return docs.groupBy("content_hash").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query("SELECT l_orderkey, count(DISTINCT concat_ws('|', l_suppkey, l_linenumber)) AS variants FROM lineitem GROUP BY 1 HAVING count(DISTINCT concat_ws('|', l_suppkey, l_linenumber)) > 1")
def conflicting_identity(spark, d):
    return quality.conflicting_ids(table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber"), "l_orderkey")


@query("""SELECT o_orderkey, CASE WHEN r = 1 THEN 'kept' WHEN o_orderstatus = f THEN 'duplicate' ELSE 'conflict' END AS outcome FROM (SELECT o_orderkey, o_orderstatus, row_number() OVER w AS r, first(o_orderstatus) OVER w AS f FROM orders WINDOW w AS (PARTITION BY o_orderdate ORDER BY o_orderkey))""")
def keep_first_per_date(spark, d):
    return quality.keep_first(table(spark, d, "orders"), ["o_orderdate"], ["o_orderkey"], "o_orderstatus").select("o_orderkey", "outcome")


@query("""WITH r AS (SELECT conv_id, turn, role, text, CASE WHEN role = 'user' THEN role || coalesce(CAST(turn AS VARCHAR), '-') END AS market, CASE WHEN turn % 3 = 1 THEN 'c' || turn END AS commodity FROM conversations),
  m AS (SELECT *, count(market) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST ROWS UNBOUNDED PRECEDING) AS seg FROM r)
  SELECT conv_id, turn, last_value(market IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST ROWS UNBOUNDED PRECEDING) AS market,
    last_value(commodity IGNORE NULLS) OVER (PARTITION BY conv_id, seg ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST ROWS UNBOUNDED PRECEDING) AS commodity FROM m""")
def forward_fill_context(spark, d):
    turn = F.col("turn").cast("string")
    rows = table(spark, d, "conversations").select(
        "conv_id", "turn", F.struct("turn", "role", "text").alias("line"), F.when(F.col("role") == "user", F.concat("role", F.coalesce(turn, F.lit("-")))).alias("market"), F.when(F.col("turn") % 3 == 1, F.concat(F.lit("c"), turn)).alias("commodity")
    )
    return quality.fill_context(rows, "conv_id", "line", "market", "commodity").drop("line")


_LINES = """r AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 97 < 2 THEN 'm' || l_suppkey END AS market, CASE WHEN l_quantity > 40 THEN 'c' || l_partkey END AS commodity,
  row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS line FROM lineitem)"""


@query(f"""WITH {_LINES}, m AS (SELECT *, count(market) OVER (ORDER BY line ROWS UNBOUNDED PRECEDING) AS seg FROM r)
  SELECT l_orderkey, l_linenumber, l_partkey, last_value(market IGNORE NULLS) OVER (ORDER BY line ROWS UNBOUNDED PRECEDING) AS market,
    last_value(commodity IGNORE NULLS) OVER (PARTITION BY seg ORDER BY line ROWS UNBOUNDED PRECEDING) AS commodity FROM m""")
def forward_fill_one_file(spark, d):
    """All line items as one file whose splits are ranges of orders."""
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.lit("all").alias("file"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("line"), F.expr("l_orderkey div 4096").alias("part"),
        F.when(F.col("l_partkey") % 97 < 2, F.concat(F.lit("m"), "l_suppkey")).alias("market"), F.when(F.col("l_quantity") > 40, F.concat(F.lit("c"), "l_partkey")).alias("commodity"),
    )
    return quality.fill_context(rows, "file", "line", "market", "commodity", "part").drop("file", "line", "part")


@query("""WITH g AS (SELECT c_custkey, '{"coordinates":[' || c_nationkey || '.5,' || c_custkey || '],"properties":{"name":"' || c_name || '","of":[' || c_nationkey || ',' || c_custkey || ',null]},"type":"Point"}' AS geometry FROM customer)
  SELECT c_custkey, geometry, 'rejected:' || sha256('s' || geometry) AS rejected_id FROM g""")
def canonical_geometry(spark, d):
    """The same shapes in different orders of keys, spaces and forms of numbers."""
    k, n, name = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_name")
    plain = F.format_string('{"type":"Point","coordinates":[%d.5,%d],"properties":{"of":[%d,%d,null],"name":"%s"}}', n, k, n, k, name)
    spaced = F.format_string('{ "properties" : {"name": "%s", "of": [%d, %d.0, null]},\n "coordinates": [%d.50, %d.00],  "type":"Point" }', name, n, k, n, k)
    raw = F.when(F.bit_count(k) > 4, spaced).otherwise(plain)
    return table(spark, d, "customer").select("c_custkey", identity.canonical_json(raw).alias("geometry"), identity.rejected_id(F.lit("s"), raw).alias("rejected_id"))


@query("SELECT l_suppkey, sha256(string_agg(k, '|' ORDER BY k)) AS lineage FROM (SELECT l_suppkey, CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS k FROM lineitem) GROUP BY 1")
def baseline_lineage_hash(spark, d):
    rows = table(spark, d, "lineitem").select("l_suppkey", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("k"))
    return rows.groupBy("l_suppkey").agg(identity.lineage("k").alias("lineage"))


@query("SELECT * FROM (SELECT 'raw_events' AS table_name, (SELECT count(*) FROM lineitem) AS row_count UNION ALL SELECT 'dlq_events', (SELECT count(*) FROM orders) UNION ALL SELECT 'unresolved_weather', 0)")
def health_summary(spark, d):
    return quality.table_counts(spark, {"raw_events": table(spark, d, "lineitem"), "dlq_events": table(spark, d, "orders"), "unresolved_weather": None})


@query("SELECT 'dead_letter_rate_above_limit' AS warning FROM (SELECT (SELECT count(*) FROM orders) / (SELECT count(*) FROM lineitem) AS r) WHERE r > 0.05 UNION ALL SELECT 'unresolved_geography' FROM (SELECT count(*) AS n FROM supplier) WHERE n > 0")
def health_warnings(spark, d):
    counts = quality.table_counts(spark, {"raw_events": table(spark, d, "lineitem"), "dlq_events": table(spark, d, "orders"), "unresolved_markets": table(spark, d, "supplier")})
    return quality.health_warnings(counts)


@query("SELECT o_orderkey, any_value(o_orderstatus) AS o_orderstatus FROM orders GROUP BY 1")
def collapse_identical(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return quality.collapse_identical(o.unionByName(o), "o_orderkey")


@query("SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events")
def distinct_union(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", F.to_date("ts").alias("day"))
    return e.unionByName(e).distinct()

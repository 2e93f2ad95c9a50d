from __future__ import annotations

import datetime as dt
import statistics

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shockline.config import ConfidencePolicy, EventTimePolicy, LookAhead, Settings, SignalPolicy
from shockline.functions import identity, scoring
from shockline.operators import baseline, signal

UTC = dt.UTC


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


def test_golden_signal_id(spark):
    r = one(spark, a=identity.signal_id(F.lit("smoke-weather-dhemaji-2024-06-30"), F.lit("smoke-mandi-dhemaji-rice-2024-07-01")), b=identity.signal_id(F.lit(""), F.lit("x")))
    assert r.a == "d63e43c17095a70ff7628fb416598be085adb0bad6c9fd861e598db8dacdf68c"
    assert r.b is None


def test_null_part_keeps_its_place_in_a_hash(spark):
    r = one(spark, a=identity.sha256(F.lit("a"), F.lit(None), F.lit("b")), b=identity.sha256(F.lit("a"), F.lit("b")))
    assert r.a != r.b


def test_iso_has_offset_and_microseconds_only_if_any(spark):
    r = one(spark, a=identity.iso_utc(F.lit("2024-06-30 00:00:00").cast("timestamp")), b=identity.iso_utc(F.lit("2024-06-30 00:00:00.25").cast("timestamp")))
    assert (r.a, r.b) == ("2024-06-30T00:00:00+00:00", "2024-06-30T00:00:00.250000+00:00")


def signal_of(spark, severity, dev, z, days, control):
    p = SignalPolicy()
    parts = scoring.components(p, *(F.lit(x).cast("double") for x in (severity, dev, z)), F.lit(days), F.lit(control).cast("double"))
    s = scoring.strength(parts, F.lit(True))
    return one(spark, s=s, level=scoring.level(p, s), parts=scoring.component_map(parts, F.lit(True)))


def test_golden_strengths(spark):
    r = signal_of(spark, 1.0, -20.0, -2.0, 1, -12.0)
    assert (r.s, r.level) == (74.62, "HIGH")
    r = signal_of(spark, None, 61.6964, 6.3659, 1, None)
    assert (r.s, r.level, r.parts["temporal_proximity"]) == (9.29, "LOW", 9.29)


def test_without_evidence_there_is_no_strength(spark):
    p = SignalPolicy()
    parts = scoring.components(p, F.lit(1.0), F.lit(-50.0), F.lit(-9.0), F.lit(0), F.lit(None).cast("double"))
    s = scoring.strength(parts, F.lit(False))
    r = one(spark, s=s, level=scoring.level(p, s), m=scoring.component_map(parts, F.lit(False)))
    assert (r.s, r.level, r.m) == (None, "INSUFFICIENT_EVIDENCE", {})


def test_zero_mad_gives_no_z_and_missing_departure_no_severity(spark):
    r = one(spark, z=scoring.robust_z(F.lit(80.0), F.lit(100.0), F.lit(0.0)), s=scoring.rainfall_severity(F.lit(None)), t=scoring.rainfall_severity(F.lit(250)), d=scoring.deviation_pct(F.lit(80.0), F.lit(125.0)))
    assert (r.z, r.s, r.t, r.d) == (None, 0.0, 1.0, -36.0)


def test_confidence_order_and_value(spark):
    yes, no = F.lit(True), F.lit(False)
    c = scoring.confidence(ConfidencePolicy(), F.lit(22), F.lit(22), F.lit(0.0), F.lit(0.0), yes, no, yes, yes)
    r = one(spark, c=c).c
    assert (r.value, r.is_sufficient, r.reasons) == (0.875, True, ["control_comparison_unavailable"])
    c = scoring.confidence(ConfidencePolicy(), F.lit(1), F.lit(1), F.lit(0.5), F.lit(0.5), no, no, no, no)
    assert one(spark, c=c).c.reasons == [
        "insufficient_historical_baseline", "geography_not_canonicalized", "shock_time_unknown", "required_fields_missing",
        "control_comparison_unavailable", "missing_data_rate_exceeds_policy", "duplicate_rate_exceeds_policy",
    ]


def test_policies_reject_what_cannot_be():
    for make in (lambda: SignalPolicy(severity=21), lambda: SignalPolicy(severity=-20, price=70), lambda: SignalPolicy(lookahead_days=0), lambda: SignalPolicy(high=30), lambda: ConfidencePolicy(min_observations=0), lambda: ConfidencePolicy(max_missing_rate=2), lambda: EventTimePolicy(0), lambda: LookAhead(0)):
        with pytest.raises(ValueError):
            make()
    with pytest.raises(ValueError):
        SignalPolicy.from_environment({})
    env = {f"SIGNAL_{k.upper()}": str(v) for k, v in SignalPolicy().__dict__.items()}
    assert SignalPolicy.from_environment(env) == SignalPolicy()
    with pytest.raises(ValueError, match="SHOCK_WATERMARK_HOURS"):
        Settings.from_environment({})


def days(spark, rows):
    return spark.createDataFrame([("s", dt.datetime.fromisoformat(d), float(v)) for d, v in rows], "series string, event_time timestamp, price double")


def test_seasonal_baseline_takes_the_month_of_earlier_days(spark):
    h = days(spark, [("2025-01-03", 100), ("2025-01-05", 110), ("2025-01-20", 120), ("2025-02-01", 1), ("2026-01-10", 500)])
    r = baseline.seasonal_baseline(h.where("event_time = timestamp'2026-01-10'"), h, ["series"], "event_time", "price", 3).collect()
    assert [(x.median_price, x.mad, x.sample_size) for x in r] == [(110.0, 10.0, 3)]
    assert baseline.seasonal_baseline(h, h, ["series"], "event_time", "price", 4).count() == 0
    with pytest.raises(ValueError):
        baseline.seasonal_baseline(h, h, ["series"], "event_time", "price", 0)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 800), st.integers(1, 50), st.sampled_from("ab")), min_size=1, max_size=40))
def test_seasonal_baselines_equal_brute_force(spark, rows):
    start = dt.datetime(2024, 1, 1)
    each = [(k, start + dt.timedelta(days=d), float(v)) for d, v, k in rows]
    h = spark.createDataFrame([*each, (None, start, 1.0), ("a", start, None), ("a", None, 1.0)], "series string, event_time timestamp, price double")
    want = set()
    for k, t, _ in each:
        past = [v for s, u, v in each if s == k and u.month == t.month and u < t]
        if past:
            middle = statistics.median(past)
            want.add((k, t.date(), middle, statistics.median(abs(v - middle) for v in past), len(past)))
    got = baseline.seasonal_baseline(h, h, ["series"], "event_time", "price", 1).select("series", "target_day", "median_price", "mad", "sample_size").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    running = baseline.running_baseline(h, ["series"], "event_time", "price").where("sample_size > 0").select("series", F.to_date("event_time"), "median_price", "mad", "sample_size").collect()
    assert set(map(tuple, running)) == want and len(running) == sum((k, t.date()) in {w[:2] for w in want} for k, t, _ in each)


def test_case_of_six_prices(spark):
    h = days(spark, [(f"2022-12-{k + 1:02d}", 100 + 10 * k) for k in range(6)])
    r = baseline.group_median_mad(h, ["series"], "price", 5).first()
    assert (r.median_price, r.mad, r.sample_size) == (125.0, 15.0, 6)


def test_insert_only(spark):
    old = spark.createDataFrame([("a", 1)], "signal_id string, v int")
    new = spark.createDataFrame([("a", 2), ("b", 3), ("b", 3)], "signal_id string, v int")
    assert [tuple(r) for r in signal.to_insert(new, old).collect()] == [("b", 3)]
    assert signal.to_insert(new, None).count() == 2

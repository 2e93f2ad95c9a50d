"""Signals: what belongs to a price is joined before the association, and levels need no rounding of each pair."""

from __future__ import annotations

from pyspark.sql import functions as F

from shockline.config import SignalPolicy
from shockline.functions import scoring
from shockline.plans import registry

from .conftest import SF


def joins(df):
    """Join nodes of the plan, from the top."""
    return [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in line]


def test_nothing_is_joined_behind_the_association(spark):
    for name in ("market_shock_signals", "confidence_reasons", "signal_components", "signal_level_counts", "gold_signals", "dashboard_metrics"):
        assert "_slice" in joins(registry.queries()[name](spark, SF))[0], name


def test_detail_associates_once(spark):
    found = joins(registry.queries()["dashboard_detail"](spark, SF))
    assert "_slice" in found[0] and sum("_slice" in j for j in found) == 1


def test_levels_of_points_are_those_of_rounded_strengths(spark):
    p = SignalPolicy()
    sums = [b + k * 1e-3 + s for b in (p.high, p.medium, 0.0) for k in range(-12, 13) for s in (0.0, 1e-12, -1e-12, 4e-14, -4e-14)] + [None, 69.995, 39.995, 69.99499999999999, 69.99500000000001]
    rows = spark.createDataFrame([(x, e) for x in sums for e in (True, False, None)], "x double, e boolean")
    parts = {"a": F.col("x")}
    out = rows.select("x", "e", scoring.level(p, scoring.strength(parts, F.col("e"))).alias("want"), scoring.level_of_points(p, parts, F.col("e")).alias("got")).collect()
    assert [r for r in out if r.want != r.got] == [] and {r.got for r in out} == {"HIGH", "MEDIUM", "LOW", "INSUFFICIENT_EVIDENCE"}

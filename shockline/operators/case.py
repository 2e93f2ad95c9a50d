"""One replayed case from its prices and its shock to a Gold row, and the audit of a batch of reports before it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ConfidencePolicy, SignalPolicy
from ..functions.identity import lineage
from . import baseline, quality, signal

SERIES = ["market", "commodity", "variety", "price_unit"]
# Texts of the case document.
PROVIDER = "Directorate of Marketing & Inspection (AGMARKNET 2.0)"
CONTROL_STATUS = "unavailable_no_authoritative_unaffected_market_evidence"


@dataclass(frozen=True)
class Case:
    """What a case is about, stated before any price is seen. Days are ISO dates, windows include both ends."""

    state: str
    district: str
    market: str
    commodity: str
    price_unit: str
    state_id: str
    district_id: str
    market_id: str
    commodity_id: str
    event_first: str
    event_last: str
    history_first: str
    history_last: str

    def window(self, kind: str) -> tuple[Column, Column]:
        return tuple(F.lit(getattr(self, f"{kind}_{end}")).cast("date") for end in ("first", "last"))


def case_rows(prices: DataFrame, case: Case) -> DataFrame:
    """The case's prices with their day; rows outside the case or without a whole series key go."""
    keyed = quality.require_series_key(prices, case.state, case.district).where(F.col("key_reason").isNull())
    return keyed.where((F.col("market") == case.market) & (F.col("commodity") == case.commodity)).withColumn("day", F.to_date("event_time")).drop("key_reason")


def series_outcomes(prices: DataFrame, case: Case, least: int) -> DataFrame:
    """Each series of the case with its rows in both windows and why it can't be used, null if it can."""
    covered = quality.series_coverage(case_rows(prices, case), SERIES, "day", case.window("history"), case.window("event"))
    return covered.withColumn("excluded", quality.eligibility(case.price_unit, least))


def analyze(prices: DataFrame, shock: DataFrame, case: Case, confidence: ConfidencePolicy, policy: SignalPolicy, processing_time: Column | None = None) -> DataFrame:
    """The case's signal in the Gold contract: one row, or none if no series qualifies.

    prices: event_id, event_time, state, district, market, commodity, variety, price_unit, modal_price.
    shock: one row of event_id, event_start, geography_basis, inundated_area_hectares, source_url. The series is
    chosen by coverage, the target is its earliest price of the event window, so no price decides either.
    An area isn't a severity, so that adds nothing; there are no controls. A target before the shock is an error.
    """
    rows = case_rows(prices, case)
    covered = quality.series_coverage(rows, SERIES, "day", case.window("history"), case.window("event"))
    chosen = quality.select_series(covered, ["market", "commodity"], case.price_unit, confidence.min_observations)
    own = rows.join(F.broadcast(chosen.select(*SERIES)), SERIES)  # one row
    history = own.where(F.col("day").between(*case.window("history")))
    target = quality.first_in_window(own, SERIES, "day", "event_id", *case.window("event"))
    base = baseline.seasonal_baseline(target, history, SERIES, "event_time", "modal_price", confidence.min_observations)
    about = history.groupBy(*SERIES).agg(F.countDistinct("day").cast("int").alias("trading_days"), lineage("event_id").alias("lineage"))
    found = target.join(base.drop("season", "target_day"), SERIES).join(about, SERIES)
    s = shock.select(F.col("event_id").alias("shock_id"), F.to_timestamp("event_start").alias("shock_time"), "geography_basis", F.col("inundated_area_hectares").cast("string").alias("hectares"), "source_url")
    found = found.crossJoin(F.broadcast(s))  # one row of the case, one shock
    after = F.datediff("day", F.to_date("shock_time"))
    # The keys of the document's references.
    notes = {
        "environmental_event_id": F.col("shock_id"), "environmental_association": F.col("geography_basis"), "environmental_observed_inundation_hectares": F.col("hectares"), "environmental_source": F.col("source_url"),
        "price_series_variety": F.col("variety"), "price_unit": F.col("price_unit"), "price_provider": F.lit(PROVIDER), "price_target_event_id": F.col("event_id"),
        "baseline_period": F.lit(f"{case.history_first}:{case.history_last}"), "baseline_observations": F.col("sample_size").cast("string"), "baseline_event_ids_sha256": F.col("lineage"), "control_status": F.lit(CONTROL_STATUS),
    }
    found = found.withColumns({
        "price_event_id": F.col("event_id"), "price_event_time": F.col("event_time"), "observed_price": F.col("modal_price").cast("double"), "shock_type": F.lit("flood"), "shock_severity": F.lit(0.0),
        "days_after_shock": F.when(after >= 0, after).otherwise(F.raise_error(F.lit("the target precedes the shock"))), "spatial_relationship": F.lit("same_district"),
        **{c: F.lit(getattr(case, c)) for c in ("state_id", "district_id", "market_id", "commodity_id")},
        "source_references": F.array(*(F.concat(F.lit(f"{k}:"), F.coalesce(v, F.lit("None"))) for k, v in notes.items())),
    })
    return signal.gold(signal.scored(found, confidence, policy), "replayed_historical", processing_time)


def audit(rows: DataFrame, files: DataFrame, pre_event_end: str) -> dict[str, DataFrame]:
    """What a batch of reports covers, without a look at prices.

    rows: imported rows of the target series with path, report_date, reason, market, commodity, variety, price_unit, day;
    files: path, sha256, report_date of all reports. Of files with equal bytes the first path counts.
    Gives summary (one row), duplicate_files, reports_without_rows, coverage, coverage_by_variety, pre_event_coverage_by_variety.
    """
    ranked = files.withColumn("_r", F.row_number().over(Window.partitionBy("sha256").orderBy("path")))
    kept, again = ranked.where("_r = 1").drop("_r"), ranked.where("_r > 1").select("path")
    own = rows.join(kept.select("path"), "path", "left_semi")
    good = own.where("reason is null")
    without = kept.join(own.select("path").distinct(), "path", "left_anti").select("report_date")
    one = lambda df, name: df.agg(F.count("*").alias(name))
    counts = [one(own, "total_target_rows"), one(good, "accepted_rows"), one(own.where("reason is not null"), "rejected_rows"), one(again, "duplicate_files"), one(without, "reports_without_rows")]
    return {
        "summary": reduce(lambda a, b: a.crossJoin(b), counts),  # one row each
        "duplicate_files": again, "reports_without_rows": without,
        "coverage": good.select("market", "commodity", "variety", "price_unit", "day"),
        "coverage_by_variety": quality.coverage(good, "variety", "day"),
        "pre_event_coverage_by_variety": quality.coverage(good.where(F.col("day") < F.lit(pre_event_end).cast("date")), "variety", "day"),
    }

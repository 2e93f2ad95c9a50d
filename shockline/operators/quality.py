"""Coverage, gaps, conflicts, choice of series, health, and the dashboard's numbers."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UNSPECIFIED = "<unspecified>"


def coverage(rows: DataFrame, by: str, day: str) -> DataFrame:
    """Rows, distinct days, first and last day for each value; null is a value of its own."""
    return rows.groupBy(F.coalesce(F.col(by), F.lit(UNSPECIFIED)).alias(by)).agg(
        F.count("*").alias("row_count"), F.countDistinct(day).alias("day_count"), F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )


def coverage_report(rows: DataFrame, day: str, dimensions: list[str], critical: list[str], reason: str = "reason") -> DataFrame:
    """One row: counts, range of days, sorted distinct values, and missing rates (null without rows)."""
    blank = lambda c: (F.length(F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))) == 0).cast("double")
    return rows.agg(
        F.count("*").alias("row_count"), F.count_if(F.col(reason).isNull()).alias("accepted_count"), F.count_if(F.col(reason).isNotNull()).alias("rejected_count"),
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), *(F.sort_array(F.collect_set(d)).alias(f"{d}_values") for d in dimensions),
        *(F.avg(blank(c)).alias(f"{c}_missing_rate") for c in critical),
    )


def missing_days(rows: DataFrame, day: str, first: Column, last: Column) -> DataFrame:
    """Days of the inclusive range that no row has."""
    spark = rows.sparkSession
    return spark.range(1).select(F.explode(F.sequence(first, last)).alias("missing_day")).join(rows.select(F.col(day).alias("missing_day")).distinct(), "missing_day", "left_anti")


def keep_first(rows: DataFrame, by: list[str], order: list[str], content: str) -> DataFrame:
    """Adds outcome: the first row of each key is kept; later ones are a duplicate (same content) or a conflict."""
    w = Window.partitionBy(*by).orderBy(*order)
    first = F.first(content).over(w)
    outcome = F.when(F.row_number().over(w) == 1, "kept").when(F.col(content).eqNullSafe(first), "duplicate").otherwise("conflict")
    return rows.withColumn("outcome", outcome)


def content_hash(columns: list[str]) -> Column:
    """Of a row's content; fields are told apart from their neighbours and null from empty."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def conflicting_ids(rows: DataFrame, ident: str) -> DataFrame:
    """Ids with more than one distinct content, and how many."""
    rest = [c for c in rows.columns if c != ident]
    return rows.groupBy(ident).agg(F.countDistinct(content_hash(rest)).alias("variants")).where("variants > 1")


def collapse_identical(rows: DataFrame, ident: str) -> DataFrame:
    """One row for each id; equal repetitions collapse, different content is an error when the rows are evaluated."""
    rest = [c for c in rows.columns if c != ident]
    one = rows.groupBy(ident).agg(F.countDistinct(content_hash(rest)).alias("_n"), *(F.any_value(c).alias(c) for c in rest))
    checked = F.when(F.col("_n") == 1, F.col(ident)).otherwise(F.raise_error(F.concat(F.lit("conflicting rows for id "), F.col(ident).cast("string"))))
    return one.withColumn(ident, checked).select(*rows.columns)


def series_coverage(rows: DataFrame, series: list[str], day: str, baseline: tuple, event: tuple) -> DataFrame:
    """Rows of each series in the baseline window and in the event window (both inclusive)."""
    return rows.groupBy(*series).agg(F.count_if(F.col(day).between(*baseline)).alias("baseline_rows"), F.count_if(F.col(day).between(*event)).alias("event_rows"))


def eligibility(unit: str, least: int) -> Column:
    """Why a series can't be used, null if it can; tests in a fixed order."""
    return (
        F.when(~F.coalesce(F.col("price_unit") == unit, F.lit(False)), "incompatible_price_unit")
        .when(F.col("event_rows") == 0, "not_observed_in_event_window")
        .when(F.col("baseline_rows") < least, "insufficient_historical_baseline")
    )


def select_series(covered: DataFrame, case: list[str], unit: str, least: int) -> DataFrame:
    """The eligible series with most baseline rows, then by name, for each case; prices play no part."""
    w = Window.partitionBy(*case).orderBy(F.desc("baseline_rows"), F.lower("variety"), "variety")
    return covered.where(eligibility(unit, least).isNull()).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def require_series_key(rows: DataFrame, state: str, district: str) -> DataFrame:
    """The rows with key_reason: a missing part of the key, or a place outside the case."""
    missing = [(c, F.coalesce(F.length(F.trim(c)) == 0, F.lit(True))) for c in ("market", "commodity", "variety", "price_unit")]
    outside = ~F.coalesce((F.col("state") == state) & (F.col("district") == district), F.lit(False))
    return rows.withColumn("key_reason", F.coalesce(*(F.when(m, f"missing_{c}") for c, m in missing), F.when(outside, "outside_case")))


def first_in_window(rows: DataFrame, by: list[str], time: str, ident: str, start: Column, end: Column) -> DataFrame:
    """The earliest row within the window for each key, ties by id."""
    w = Window.partitionBy(*by).orderBy(time, ident)
    return rows.where(F.col(time).between(start, end)).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def fill_context(lines: DataFrame, file: str, line: str, market: str, commodity: str, split: str | None = None) -> DataFrame:
    """Carries market and commodity down a file; a new market clears the commodity. Null is what has to be filled.

    split: a column that orders parts of a file, each of which holds lines before all of the next one. Then a part is filled by
    itself, what stands at its end is one row, these rows are filled in the same way, and each part takes what
    comes down from those before it. So a file of any size is dealt out over tasks; without it a file is one task.
    """
    part = [file] if split is None else [file, split]
    down = Window.partitionBy(*part).orderBy(line).rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumn("_segment", F.count(market).over(down)).withColumn(market, F.last(market, ignorenulls=True).over(down))
    inside = Window.partitionBy(*part, "_segment").orderBy(line).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn(commodity, F.last(commodity, ignorenulls=True).over(inside))
    if split is None:
        return rows.drop("_segment")
    ends = rows.groupBy(*part).agg(F.max_by(F.struct(F.col(market).alias("_m"), F.col(commodity).alias("_c")), line).alias("_e")).select(*part, "_e._m", "_e._c")
    before = Window.partitionBy(file).orderBy(split)
    carried = fill_context(ends, file, split, "_m", "_c").select(*part, F.lag("_m").over(before).alias("_m"), F.lag("_c").over(before).alias("_c"))
    first = F.col("_segment") == 0  # before the part's own first market
    out = rows.join(carried, part).withColumn(market, F.when(first, F.col("_m")).otherwise(F.col(market)))
    return out.withColumn(commodity, F.when(first, F.coalesce(commodity, "_c")).otherwise(F.col(commodity))).select(*lines.columns)


def table_counts(spark: SparkSession, tables: dict[str, DataFrame | None]) -> DataFrame:
    """(table_name, row_count); a table that doesn't exist counts 0."""
    parts = [(spark.range(0) if t is None else t).agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, t in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def table_counts_or_failed(spark: SparkSession, tables: dict[str, Callable[[], DataFrame | None]]) -> DataFrame:
    """As table_counts(), of tables that may fail to open or to be read: such a table counts -1, and the others are counted all the same."""
    made = []
    for name, opened in tables.items():
        try:
            t = opened()
            n = 0 if t is None else t.count()
        except Exception:  # noqa: BLE001  a report of what works and what doesn't
            n = -1
        made.append((name, n))
    return spark.createDataFrame(made, "table_name string, row_count long")


def health_warnings(counts: DataFrame, most_dead: float = 0.05) -> DataFrame:
    """(warning) rows: share of dead letters above the limit, tables of unresolved rows that aren't empty, and tables that can't be read (a count of -1)."""
    n = lambda name: F.sum(F.when(F.col("table_name") == name, F.col("row_count")).otherwise(0))
    counts = counts.withColumn("_failed", F.col("row_count") < 0).withColumn("row_count", F.greatest("row_count", F.lit(0)))
    sums = counts.agg(F.count_if("_failed").alias("failed"), n("dlq_events").alias("dead"), n("raw_events").alias("all"), F.sum(F.when(F.col("table_name").startswith("unresolved"), F.col("row_count")).otherwise(0)).alias("open"))
    found = F.array_compact(F.array(F.when((F.col("all") > 0) & (F.col("dead") / F.nullif(F.col("all"), F.lit(0)) > most_dead), "dead_letter_rate_above_limit"), F.when(F.col("open") > 0, "unresolved_geography"), F.when(F.col("failed") > 0, "table_not_readable")))
    return sums.select(F.explode(found).alias("warning"))


def dashboard_metrics(signals: DataFrame, kind: str) -> DataFrame:
    return signals.where(F.col("fixture_kind") == kind).agg(
        F.avg("signal_strength").alias("avg_signal_strength"), F.avg("data_confidence.value").alias("avg_confidence"),
        F.avg("deviation_pct").alias("avg_deviation_pct"), F.avg("robust_z_score").alias("avg_robust_z_score"),
    )


def dashboard_detail(signals: DataFrame, kind: str, signal: str | Column) -> DataFrame:
    return signals.where((F.col("fixture_kind") == kind) & (F.col("signal_id") == signal)).select("observed_price", "baseline_price").limit(1)


def exists_once(rows: DataFrame, condition: Column) -> bool:
    """Whether exactly one row fits, without counting further than two."""
    return rows.where(condition).limit(2).count() == 1

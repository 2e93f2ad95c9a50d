"""Source records to event envelopes. Each normalizer gives every row either an envelope or a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import canonical_json, event_id, joined

DECIMAL = "decimal(18,2)"


def text(c: Column | str) -> Column:
    """Trimmed; empty counts as missing."""
    t = F.trim((F.col(c) if isinstance(c, str) else c).cast("string"))
    return F.when(F.length(t) > 0, t)


def day(c: Column | str) -> Column:
    """dd/MM/yyyy, then yyyy-MM-dd, at midnight UTC."""
    t = text(c)
    return F.coalesce(*(F.when(t.rlike(shape), F.try_to_timestamp(t, F.lit(form))) for shape, form in ((r"^\d{2}/\d{2}/\d{4}$", "dd/MM/yyyy"), (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"))))


def number(c: Column | str, kind: str = DECIMAL) -> Column:
    return text(c).try_cast(kind)


def first_fault(faults: list[tuple[str, Column]]) -> Column:
    return F.coalesce(*(F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in faults))


def price_faults(low: Column, modal: Column, high: Column, raw: dict[str, Column]) -> list[tuple[str, Column]]:
    """Missing prices are skipped; present ones must be numbers, not negative, and in order."""
    found = {"min_price": low, "modal_price": modal, "max_price": high}
    out = []
    for name, value in found.items():
        out.append((f"invalid_{name}", raw[name].isNotNull() & value.isNull()))
        out.append((f"negative_{name}", F.coalesce(value < 0, F.lit(False))))
    return [*out, ("price_order_invalid", F.coalesce((low > modal) | (modal > high), F.lit(False)))]


def price_reason(rows: DataFrame) -> DataFrame:
    """Adds reason for rows of district, market, commodity and three prices (text or numbers)."""
    raw = {c: text(c) for c in ("min_price", "modal_price", "max_price")}
    low, modal, high = (number(c) for c in raw)
    faults = [(f"missing_{c}", text(c).isNull()) for c in ("district", "market", "commodity")]
    return rows.withColumn("reason", first_fault(faults + price_faults(low, modal, high, raw)))


def _envelope(rows: DataFrame, kind: str, source: str, key: Column, payload: Column, faults: list[tuple[str, Column]], hashed_as: str | None = None) -> DataFrame:
    made = rows.withColumn("reason", first_fault(faults)).withColumn("payload", payload)
    ok = F.col("reason").isNull()
    return made.withColumns({
        "event_id": F.when(ok, event_id(F.lit(hashed_as or source), key, "event_time")), "event_type": F.lit(kind), "source": F.lit(source),
        "schema_version": F.lit("1.0"), "ingestion_time": F.current_timestamp(),
    })


def mandi(raw: DataFrame, price_unit: str | None = None, source: str = "ogd_agmarknet") -> DataFrame:
    """Columns State, District, Market, Commodity, Variety, Arrival_Date, three prices[, Price_Unit]."""
    for c in ("Variety", "Price_Unit"):
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit(None).cast("string"))
    unit = F.coalesce(text("Price_Unit"), text(F.lit(price_unit)))
    prices = {n: number(c) for n, c in (("min_price", "Min_Price"), ("modal_price", "Modal_Price"), ("max_price", "Max_Price"))}
    rows = raw.withColumn("event_time", day("Arrival_Date"))
    faults = [("missing_arrival_date", text("Arrival_Date").isNull()), ("invalid_arrival_date", F.col("event_time").isNull())]
    faults += [(f"missing_{c.lower()}", text(c).isNull()) for c in ("State", "District", "Market", "Commodity")]
    faults += [(f"invalid_{n}", v.isNull()) for n, v in prices.items()] + [("missing_price_unit", unit.isNull())]
    faults += [(f"negative_{n}", v < 0) for n, v in prices.items()] + [("price_order_invalid", ~((prices["min_price"] <= prices["modal_price"]) & (prices["modal_price"] <= prices["max_price"])))]
    names = {c.lower(): text(c) for c in ("State", "District", "Market", "Commodity", "Variety")}
    payload = F.struct(*(v.alias(n) for n, v in names.items()), *(v.alias(n) for n, v in prices.items()), unit.alias("price_unit"))
    key = joined(*names.values(), unit, F.date_format("event_time", "yyyy-MM-dd"))
    return _envelope(rows, "mandi_price", source, key, payload, faults)


def weather(raw: DataFrame) -> DataFrame:
    """Columns OBJ_ID, State, District, Date, Daily Actual, Daily Normal, Daily Departure Per, Daily Category."""
    rows = raw.withColumn("event_time", day("Date"))
    actual, normal = number("Daily Actual", "decimal(12,2)"), number("Daily Normal", "decimal(12,2)")
    departure = number(F.regexp_replace(F.col("Daily Departure Per").cast("string"), "%", ""), "decimal(12,2)")
    faults = [("missing_date", text("Date").isNull()), ("invalid_date", F.col("event_time").isNull()), ("missing_district", text("District").isNull())]
    faults += [("invalid_daily_actual", actual.isNull()), ("invalid_daily_normal", normal.isNull()), ("invalid_daily_departure_pct", departure.isNull())]
    faults += [("missing_daily_category", text("Daily Category").isNull()), ("negative_rainfall", (actual < 0) | (normal < 0))]
    payload = F.struct(
        text("State").alias("state"), text("District").alias("district"), actual.alias("rainfall_actual_mm"), normal.alias("rainfall_normal_mm"),
        departure.alias("rainfall_departure_pct"), text("Daily Category").alias("rainfall_category"), text("OBJ_ID").alias("imd_object_id"),
    )
    key = joined(F.coalesce(text("OBJ_ID"), text("District")), F.date_format("event_time", "yyyy-MM-dd"))
    return _envelope(rows, "weather_observation", "imd", key, payload, faults)


def flood(features: DataFrame) -> DataFrame:
    """GeoJSON features: properties (eventid, fromdate, todate, alertlevel) and geometry_json, the geometry's text, which becomes canonical."""
    p = F.col("properties")
    rows = features.withColumn("event_time", day(p["fromdate"]))
    faults = [
        ("invalid_geojson_feature", p.isNull() | F.col("geometry_json").isNull()), ("missing_eventid", text(p["eventid"]).isNull()),
        ("missing_fromdate", text(p["fromdate"]).isNull()), ("invalid_fromdate", F.col("event_time").isNull()),
    ]
    payload = F.struct(
        text(p["eventid"]).alias("source_event_id"), F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ssxxx").alias("event_start"), p["todate"].cast("string").alias("event_end"),
        p["alertlevel"].cast("string").alias("alert_level"), canonical_json("geometry_json").alias("geometry_json"),
    )
    return _envelope(rows, "flood_event", "gdacs", text(p["eventid"]), payload, faults)


def observed_flood(rows: DataFrame) -> DataFrame:
    """District rows of a rapid flood assessment: dated, sourced, without any severity."""
    when, start, end = (day(c) for c in ("observation_date", "event_window_start", "event_window_end"))
    area = number("inundated_area_hectares", "decimal(18,4)")
    named = ("source_provider", "source_report_title", "map_id", "state", "district")
    faults = [("severity_not_supported", F.col("severity").isNotNull() if "severity" in rows.columns else F.lit(False))]
    faults += [(f"missing_{c}", text(c).isNull()) for c in named]
    faults += [
        ("invalid_observation_date", when.isNull()), ("invalid_event_window", ~((start <= when) & (when <= end))),
        ("invalid_source_url", ~((F.try_parse_url("source_url", F.lit("PROTOCOL")) == "https") & (F.lower(F.try_parse_url("source_url", F.lit("HOST"))) == "ndem.nrsc.gov.in"))),
        ("invalid_artifact_sha256", ~F.lower(text("artifact_sha256")).rlike("^[0-9a-f]{64}$")), ("invalid_inundated_area", ~(area >= 0)),
    ]
    made = rows.withColumn("event_time", when)
    payload = F.struct(
        text("map_id").alias("source_event_id"), F.date_format(start, "yyyy-MM-dd'T'HH:mm:ssxxx").alias("event_start"), F.date_format(end, "yyyy-MM-dd'T'HH:mm:ssxxx").alias("event_end"),
        text("state").alias("reported_state"), text("district").alias("reported_district"), F.lit("source_reported_district").alias("geography_basis"),
        F.lit("day").alias("event_time_precision"), area.cast("string").alias("inundated_area_hectares"), text("map_id").alias("source_map_id"),
    )
    key = joined(text("map_id"), text("state"), text("district"), F.date_format(when, "yyyy-MM-dd"))
    return _envelope(made, "flood_event", "replayed_historical", key, payload, faults, hashed_as="nrsc_ndem_rapid_assessment")


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where("reason is null")


def rejected(rows: DataFrame) -> DataFrame:
    return rows.where("reason is not null")

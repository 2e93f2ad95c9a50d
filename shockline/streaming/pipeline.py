"""The streaming application: bronze, silver, dead letters, geography and associations, from the batch transforms.

Rows that are in the state of a deduplication leave it with the watermark, or with a horizon behind it (exact=True keeps ids for good).
Dead letters go to one query with two sinks, so the source isn't read again for each.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import EventTimePolicy, LookAhead
from ..observability import ProgressTable, counted, read_progress, totals
from ..operators import associate, geography, validate
from ..schemas import FLOOD, MANDI, WEATHER
from ..sources import read, write
from .repeats import first_within

#: Topic names and the fields that each needs.
TOPICS = {"mandi": "mandi-prices", "weather": "weather-events", "flood": "flood-events"}
WEATHER_REQUIRED, FLOOD_REQUIRED = ["district", "rainfall_category"], ["source_event_id"]
PROGRESS_TABLE = "_progress"
_listeners: list[ProgressTable] = []
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def deduplicated(events: DataFrame, policy: EventTimePolicy, exact: bool = False, horizon: timedelta | None = None) -> DataFrame:
    """Watermark and one row for each event_id. A batch has no watermark: there it is one row for each id.

    On a stream repetitions are known for the watermark's delay; with a horizon for that long after the first, by state with
    timers; with exact for good, and the state never leaves.
    """
    if not events.isStreaming:
        return events.dropDuplicates(["event_id"])
    marked = events.withWatermark("event_time", policy.duration)
    if horizon is not None:
        return first_within(marked, "event_id", "event_time", horizon)
    return marked.dropDuplicates(["event_id"]) if exact else marked.dropDuplicatesWithinWatermark(["event_id"])


@dataclass
class Flow:
    """Every table of the application as a frame, for streams and batches."""

    bronze: DataFrame
    silver: dict[str, DataFrame]
    dead: DataFrame
    prices: DataFrame
    shocks: DataFrame
    unresolved: dict[str, DataFrame]
    associations: DataFrame


def build(records: dict[str, DataFrame], markets: DataFrame, boundaries: DataFrame, policy: EventTimePolicy, ahead: LookAhead, exact: bool = False, horizon: timedelta | None = None) -> Flow:
    """records: mandi, weather and flood broker rows. Weather comes first in the union of shocks."""
    mandi, bad_mandi = validate.parse_mandi(records["mandi"], MANDI)
    weather, bad_weather = validate.parse_required(records["weather"], WEATHER, WEATHER_REQUIRED)
    flood, bad_flood = validate.parse_required(records["flood"], FLOOD, FLOOD_REQUIRED)
    silver = {n: deduplicated(validate.silver(v), policy, exact, horizon) for n, v in (("mandi", mandi), ("weather", weather), ("flood", flood))}
    dead = validate.dead_letters(bad_mandi).unionByName(validate.dead_letters(bad_weather)).unionByName(validate.dead_letters(bad_flood))
    placed = geography.resolve_markets(silver["mandi"], markets)
    prices = placed.where("mapping_status = 'resolved'")
    shocks = geography.weather_shocks(silver["weather"], boundaries).unionByName(geography.geometry_flood_shocks(silver["flood"], boundaries)).unionByName(geography.reported_flood_shocks(silver["flood"], boundaries))
    unresolved = {"markets": placed.where("mapping_status = 'unresolved'"), "weather": geography.unresolved_weather(silver["weather"], boundaries)}
    if not silver["flood"].isStreaming:
        unresolved["flood"] = geography.unresolved_floods(silver["flood"], boundaries)
    if shocks.isStreaming:
        # a stream may have one event-time column: shock_time, which has the watermark from the first branch
        shocks = shocks.drop("event_time")
    all_records = records["mandi"].unionByName(records["weather"]).unionByName(records["flood"])
    return Flow(validate.bronze(all_records), silver, dead, prices, shocks, unresolved, associate.associate(shocks, prices, ahead))


def start(spark: SparkSession, source: str, lake: str, checkpoints: str, policy: EventTimePolicy, ahead: LookAhead, format: str = "json", once: bool = False, horizon: timedelta | None = None) -> list[StreamingQuery]:
    """All queries. Unresolved floods need an anti-join with themselves, so each batch of silver floods settles its own."""
    records = {n: read.broker_stream(spark, source, t, format) for n, t in TOPICS.items()}
    markets, boundaries = (read.dimension(spark, f"{lake}/reference/{d}", d) for d in ("markets", "boundaries"))
    flow = build(records, markets, boundaries, policy, ahead, horizon=horizon)
    if not any(isinstance(x, ProgressTable) and x.path == f"{lake}/{PROGRESS_TABLE}" for x in _listeners):
        _listeners.append(ProgressTable(spark, f"{lake}/{PROGRESS_TABLE}"))
        spark.streams.addListener(_listeners[-1])

    def out(df: DataFrame, path: str, by: list[str], additive: bool = False) -> StreamingQuery:
        name = path.replace("/", "_")
        return write.append_stream(counted(df, name), f"{lake}/{path}", f"{checkpoints}/{path}", name, by, additive, once=once)

    def floods(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        batch.write.mode("overwrite").parquet(f"{lake}/silver/flood/batch_id={batch_id}")
        geography.unresolved_floods(batch, boundaries).write.mode("overwrite").parquet(f"{lake}/silver/unresolved_flood/batch_id={batch_id}")
        batch.unpersist()

    def dead(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        batch.write.mode("overwrite").parquet(f"{lake}/silver/dlq_events/batch_id={batch_id}")
        write.as_messages(batch).write.mode("overwrite").json(f"{lake}/dlq_messages/batch_id={batch_id}")
        batch.unpersist()

    def each(df: DataFrame, name: str, action) -> StreamingQuery:
        w = counted(df, name).writeStream.foreachBatch(action).option("checkpointLocation", f"{checkpoints}/{name}").queryName(name)
        return (w.trigger(availableNow=True) if once else w).start()

    return [
        out(flow.bronze, "bronze/raw_events", ["kafka_topic", "source_event_date"]),
        out(flow.silver["mandi"], "silver/mandi_prices", ["source"]),
        out(flow.silver["weather"], "silver/weather_events", ["source"]),
        each(flow.silver["flood"], "silver_flood", floods),
        each(flow.dead, "silver_dlq", dead),
        out(flow.unresolved["markets"], "silver/unresolved_markets", ["source"], True),
        out(flow.unresolved["weather"], "silver/unresolved_weather", ["source"]),
        out(flow.associations, "gold/associations", ["shock_type"], True),
    ]


def measured(spark: SparkSession, lake: str) -> DataFrame:
    """Sums of all micro-batches so far, by query."""
    for listener in _listeners:
        listener.flush()
    return totals(read_progress(spark, f"{lake}/{PROGRESS_TABLE}"))


def late_events(spark: SparkSession, lake: str, topic: str = "mandi") -> DataFrame:
    """Events of bronze that are valid and that silver lacks: those that came behind the watermark. Their number is the measured one.

    A repetition of an event that silver has isn't late; of a late event that is repeated each row counts, as in the measurement.
    """
    schema, fields = {"mandi": (MANDI, None), "weather": (WEATHER, WEATHER_REQUIRED)}[topic]
    rows = _bronze_records(spark, lake).where(F.col("topic") == TOPICS[topic])
    valid = validate.silver((validate.parse_mandi(rows, schema) if fields is None else validate.parse_required(rows, schema, fields))[0])
    known = write._table(spark, f"{lake}/silver/{'mandi_prices' if topic == 'mandi' else 'weather_events'}", "parquet")
    return valid if known is None else valid.join(known.select("event_id").distinct(), "event_id", "left_anti")


def supervise(spark: SparkSession) -> None:
    """Until any query ends; if one failed, the others are stopped and its error is raised."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for q in spark.streams.active:
            q.stop()


def _bronze_records(spark: SparkSession, lake: str) -> DataFrame:
    b = spark.read.parquet(f"{lake}/bronze/raw_events")
    return b.select("kafka_key", F.col("raw_payload").alias("raw_json"), F.col("kafka_topic").alias("topic"), F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"), "kafka_timestamp")


def reconcile(spark: SparkSession, lake: str, markets: DataFrame, boundaries: DataFrame, policy: EventTimePolicy, ahead: LookAhead) -> DataFrame:
    """Associations of all of bronze, late events too, less those that the stream has written: the batch job for late data."""
    rows = _bronze_records(spark, lake)
    flow = build({n: rows.where(F.col("topic") == t) for n, t in TOPICS.items()}, markets, boundaries, policy, ahead)
    known = write._table(spark, f"{lake}/gold/associations", "parquet")
    return flow.associations if known is None else flow.associations.join(known.select("shock_id", "price_event_id"), ["shock_id", "price_event_id"], "left_anti")

"""Sinks: append streams, dead letters, insert-only signals, serving documents, dimensions, import artifacts."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.signal import same_schema
from ..operators.validate import document_reason
from .committed import CommittedTable, Merge
from .evolution import register

#: Sinks whose tables may gain columns.
ADDITIVE = frozenset({"silver_unresolved_markets", "silver_flood", "gold_associations"})


def append_stream(df: DataFrame, path: str, checkpoint: str, name: str, partition_by: list[str] | None = None, additive: bool = False, format: str = "parquet", once: bool = False) -> StreamingQuery:
    """A named append query with a checkpoint of its own. once: all that is there, then stop.

    The columns are checked before the start: with additive, for names on the list, the table may gain columns and wider types;
    others are fixed by their first start. read_governed() reads the rows of all versions.
    """
    if additive and name not in ADDITIVE:
        raise ValueError(f"{name} may not gain columns")
    register(df.sparkSession, path, df.schema, additive)
    w = df.writeStream.format(format).outputMode("append").option("checkpointLocation", checkpoint).queryName(name)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if once:
        w = w.trigger(availableNow=True)
    return w.start(path)


def as_messages(envelopes: DataFrame) -> DataFrame:
    """key and value of broker messages."""
    fields = ("event_id", "event_type", "event_time", "ingestion_time", "source", "schema_version", "payload")
    return envelopes.select(F.col("event_id").alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def dead_letter_stream(dead: DataFrame, location: str, checkpoint: str, name: str, format: str = "json", once: bool = False, **options: str) -> StreamingQuery:
    w = as_messages(dead).writeStream.format(format).outputMode("append").option("checkpointLocation", checkpoint).queryName(name).options(**options)
    if once:
        w = w.trigger(availableNow=True)
    return w.start(location) if format != "kafka" else w.option("kafka.bootstrap.servers", location).start()


def _table(spark, path: str, format: str) -> DataFrame | None:
    try:
        return spark.read.format(format).load(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def merge_signals(batch: DataFrame, path: str, batch_id: int | None = None, writer: str = "signals") -> Merge:
    """Insert-only merge by signal_id into a table with commits; call from foreachBatch, with any number of writers.

    A batch that was written in part has no commit and is no part of the table; a batch that has one is left out when it is repeated.
    """
    return CommittedTable(batch.sparkSession, path).merge(batch, writer, batch_id)


def signals_at(spark: SparkSession, path: str) -> DataFrame | None:
    return CommittedTable(spark, path).read()


def overwrite_dimension(rows: DataFrame, path: str, format: str = "parquet") -> None:
    rows.write.format(format).mode("overwrite").save(path)


def index_documents(signals: DataFrame, send: Callable[[list[tuple[str, str]]], None] | None = None, path: str | None = None) -> None:
    """Serving documents, each id once, checked against the contract first: as JSON lines, or through send in batches.

    send(list of (id, document)) runs on the executors, once for up to 500 documents. It may return (id, status) of the
    documents that failed. Transient errors, and documents that failed with 429 or from 500 on, are sent again; others are raised.
    """
    same_schema(signals)
    reason = document_reason()
    fault = F.when(reason.isNull(), F.col("signal_id")).otherwise(F.raise_error(F.concat(F.lit("invalid document: "), reason)))
    docs = signals.dropDuplicates(["signal_id"]).withColumn("signal_id", fault).select("signal_id", F.to_json(F.struct(*signals.columns)).alias("document"))
    if path:
        docs.select("document").write.mode("overwrite").text(path)
    if send:

        def post(rows) -> None:
            held = []
            for r in rows:
                held.append((r["signal_id"], r["document"]))
                if len(held) == 500:
                    deliver(send, held)
                    held = []
            if held:
                deliver(send, held)

        docs.foreachPartition(post)


class Undelivered(RuntimeError):
    """Documents or messages that weren't taken; again: whether another attempt may help."""

    def __init__(self, what: str, again: bool = False):
        super().__init__(what)
        self.again = again


def transient(error: Exception) -> bool:
    status = getattr(error, "status_code", None)
    return getattr(error, "again", False) or isinstance(error, TimeoutError | OSError) or isinstance(status, int) and (status == 429 or status >= 500)


def deliver(send: Callable[[list], object], documents: list[tuple[str, str]], **retry) -> None:
    """Send, and send again what failed for the time being."""
    left = list(documents)

    def once() -> None:
        nonlocal left
        failed = dict(send(left) or ())
        left = [d for d in left if d[0] in failed]
        if left:
            raise Undelivered(f"{len(left)} documents failed: {sorted(set(failed.values()))}", all(s == 429 or s >= 500 for s in failed.values()))

    with_retry(once, transient, **retry)


def with_retry(action: Callable[[], object], transient: Callable[[Exception], bool], attempts: int = 5, first: float = 1.0, sleep: Callable[[float], None] = time.sleep):
    """Calls action again after transient errors, waiting twice as long each time; others, and the last, are raised."""
    if attempts < 1:
        raise ValueError("attempts must be positive")
    for k in range(attempts):
        try:
            return action()
        except Exception as e:  # noqa: BLE001
            if k == attempts - 1 or not transient(e):
                raise
            sleep(first * 2**k)


class MemoryPublisher:
    """Keeps messages in a list; can fail its first calls, for tests of retries."""

    def __init__(self, failures: int = 0):
        self.messages: list[tuple[str, str, str]] = []
        self.failures = failures

    def publish(self, topic: str, key: str, value: str) -> None:
        if self.failures:
            self.failures -= 1
            raise ConnectionError("injected")
        self.messages.append((topic, key, value))


class Publisher:
    """Publishes one message at a time through a producer of the broker's interface, and waits until it is taken.

    producer: produce(topic, key=, value=, on_delivery=) and flush(seconds) -> messages still on their way.
    """

    #: No message twice and none lost, which implies that all replicas acknowledge; the rest is the deployment's.
    SETTINGS = {"enable.idempotence": True}

    def __init__(self, producer, wait: float = 10):
        self.producer, self.wait = producer, wait

    @classmethod
    def to_broker(cls, servers: str, **settings: object) -> Publisher:
        from confluent_kafka import Producer  # where that library is installed

        return cls(Producer({"bootstrap.servers": servers, **settings, **cls.SETTINGS}))

    def publish(self, topic: str, key: str, value: str) -> None:
        errors: list[object] = []
        self.producer.produce(topic, key=key.encode(), value=value.encode(), on_delivery=lambda error, _: errors.append(error))
        left = self.producer.flush(self.wait)
        if left:
            raise Undelivered(f"{left} messages are still on their way after {self.wait} s", True)
        if failed := [e for e in errors if e is not None]:
            raise Undelivered(str(failed[0]))


class FileProducer:
    """A producer that appends messages to a JSON file for each topic, in place of a broker."""

    def __init__(self, folder: str):
        self.folder, self.held = folder, []

    def produce(self, topic: str, key: bytes, value: bytes, on_delivery: Callable[[object, object], None]) -> None:
        self.held.append((topic, {"key": key.decode(), "value": value.decode()}, on_delivery))

    def flush(self, seconds: float) -> int:
        while self.held:
            topic, message, told = self.held.pop(0)
            with open(f"{self.folder}/{topic}.ndjson", "a") as f:
                f.write(json.dumps(message) + "\n")
            told(None, message)
        return 0


def pace(per_second: float, sleep: Callable[[float], None] = time.sleep) -> Callable[[], None]:
    if per_second <= 0:
        raise ValueError("per_second must be positive")
    return lambda: sleep(1 / per_second)


def import_artifacts(rows: DataFrame, folder: str, lineage: dict[str, str]) -> None:
    """Accepted rows as replay NDJSON, rejected ones with their reasons, and a one-row manifest."""
    ok = rows.where("reason is null")
    fields = ("event_id", "event_type", "event_time", "ingestion_time", "schema_version", "payload")
    ok.select(*fields, F.lit("replayed_historical").alias("source")).write.mode("overwrite").json(f"{folder}/replay")
    rows.where("reason is not null").write.mode("overwrite").json(f"{folder}/rejected")
    manifest = rows.agg(F.count("*").alias("row_count"), F.count_if(F.col("reason").isNull()).alias("accepted_count"), F.count_if(F.col("reason").isNotNull()).alias("rejected_count"), F.min("event_time").alias("first_time"), F.max("event_time").alias("last_time"))
    manifest.select("*", *(F.lit(v).alias(k) for k, v in lineage.items())).coalesce(1).write.mode("overwrite").json(f"{folder}/manifest")

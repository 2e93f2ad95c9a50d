"""Counters, progress of streaming queries, JSON log lines."""

from __future__ import annotations

import json
import logging
import uuid
from collections import Counter
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .sources.committed import Files

#: Columns of the progress table: one row a micro-batch of a query.
PROGRESS = "query string, run_id string, batch_id long, at timestamp, input_rows long, input_rows_per_second double, processed_rows_per_second double, watermark timestamp, state_rows long, late_rows long, observed map<string, long>"


class Counters:
    """Named counters that only go up."""

    def __init__(self) -> None:
        self._n: Counter[str] = Counter()

    def add(self, name: str, by: int = 1) -> None:
        if by < 0:
            raise ValueError("counters only go up")
        self._n[name] += by

    def snapshot(self) -> dict[str, int]:
        return dict(self._n)


def progress(p) -> dict:
    """The numbers of a StreamingQueryProgress that are watched; an absent one is null."""
    if p is None:
        return {}
    get = p.get if isinstance(p, dict) else lambda k, d=None: getattr(p, k, d)
    state = get("stateOperators") or []
    value = lambda s, k: s.get(k, 0) if isinstance(s, dict) else getattr(s, k, 0)
    return {
        "batch_id": get("batchId"), "input_rows": get("numInputRows"), "input_rows_per_second": get("inputRowsPerSecond"), "processed_rows_per_second": get("processedRowsPerSecond"),
        "watermark": (get("eventTime") or {}).get("watermark"), "state_rows": sum(value(s, "numRowsTotal") for s in state), "late_rows": sum(value(s, "numRowsDroppedByWatermark") for s in state),
    }


def counted(df: DataFrame, name: str, **more: Column) -> DataFrame:
    """Counts the rows that pass here, in the same pass: each micro-batch reports `rows` and the further sums under the name."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *(F.coalesce(c, F.lit(0)).cast("long").alias(n) for n, c in more.items()))


class ProgressTable(StreamingQueryListener):
    """Writes the numbers of every micro-batch to a table of JSON files: what progress() watches and what counted() counts.

    Spark calls it on the driver with a few numbers a batch; they are held until there are `every` rows or a query ends, so the
    table has few files. Batches without rows, late ones included, aren't written. counters: also gets the sums, by query.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 20, counters: Counters | None = None):
        self.files, self.path, self.every, self.held = Files(spark), path, every, []
        self.counters = counters

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        self.flush()

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        n = progress(p)
        seen = {f"{name}.{k}": int(v) for name, row in (p.get("observedMetrics") or {}).items() for k, v in row.items() if v is not None}
        if not (n["input_rows"] or n["late_rows"] or any(seen.values())):
            return
        if self.counters is not None:
            for k, by in (("input_rows", n["input_rows"]), ("late_rows", n["late_rows"])):
                self.counters.add(f"{p['name']}.{k}", by)
        self.held.append({"query": p["name"], "run_id": p["runId"], "at": p["timestamp"], **n, "observed": seen})
        if len(self.held) >= self.every:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        rows, self.held = self.held, []
        if rows:
            self.files.write(f"{self.path}/{uuid.uuid4().hex}.json", "".join(json.dumps(r) + "\n" for r in rows))


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The progress table; a batch that was run again after a failure counts by its last run."""
    if not Files(spark).names(path):
        return spark.createDataFrame([], PROGRESS)
    rows = spark.read.schema(PROGRESS).json(path)
    last = rows.groupBy("query", "batch_id").agg(F.max_by(F.struct("*"), "at").alias("r"))
    return last.select("r.*")


def totals(progress_rows: DataFrame) -> DataFrame:
    """query, batches, input_rows, late_rows, last watermark and state, and the observed sums of each query."""
    whole = progress_rows.groupBy("query").agg(F.count("*").alias("batches"), F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"), F.max("watermark").alias("watermark"), F.max_by("state_rows", "at").alias("state_rows"))
    seen = progress_rows.select("query", F.explode("observed").alias("name", "n")).groupBy("query", "name").agg(F.sum("n").alias("n"))
    seen = seen.groupBy("query").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "n")))).alias("observed"))  # a few names a query
    return whole.join(seen, "query", "left")


class JsonLines(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        out = {"time": datetime.fromtimestamp(record.created, UTC).isoformat(), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        if record.exc_info:
            out["error"] = self.formatException(record.exc_info)
        return json.dumps(out | getattr(record, "fields", {}), default=str)

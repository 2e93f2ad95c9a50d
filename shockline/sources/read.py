"""Scans: broker, replay files, tables, reports, and nested JSON. Formats are parameters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.identity import place_key
from ..operators.quality import collapse_identical, fill_context
from ..schemas import BOUNDARIES, BROKER, MARKETS, envelope

REPLAY_LABELS = ("replayed_historical", "synthetic_failure_injection")


def broker_stream(spark: SparkSession, location: str, topic: str, format: str = "json", per_trigger: int | None = None, **options: str) -> DataFrame:
    """Records of a topic as a stream in the broker contract: format kafka (location: servers), or files of such records."""
    if format == "kafka":
        raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", location).option("subscribe", topic).option("startingOffsets", "earliest").options(**options).load()
        return raw.selectExpr("CAST(key AS STRING) AS kafka_key", "CAST(value AS STRING) AS raw_json", "topic", "partition", "offset", "timestamp AS kafka_timestamp")
    reader = spark.readStream.format(format).schema(BROKER).options(**options)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(location).where(F.col("topic") == topic)


def broker_streams(spark: SparkSession, location: str, topics: list[str], **options) -> DataFrame:
    streams = [broker_stream(spark, location, t, **options) for t in topics]
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s)
    return out


def static_table(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    return spark.read.format(format).load(path)


def dimension(spark: SparkSession, path: str, kind: str, format: str = "parquet") -> DataFrame:
    schema = {"markets": MARKETS, "boundaries": BOUNDARIES}[kind]
    return static_table(spark, path, format).select(*(F.col(f.name).cast(f.dataType) for f in schema))


def replay_events(spark: SparkSession, root: str, payload: T.StructType, stream: bool = False, per_trigger: int = 1) -> DataFrame:
    """Envelopes from NDJSON; a source that isn't labelled as replay is an error. Files per trigger set a stream's pace."""
    e = T.StructType([f for f in envelope(payload) if f.name != "_corrupt_record"])
    reader = (spark.readStream.option("maxFilesPerTrigger", per_trigger) if stream else spark.read).schema(e).option("mode", "FAILFAST")
    rows = reader.json(root)
    bad = F.raise_error(F.concat(F.lit("not a replay source: "), F.coalesce("source", F.lit("null"))))
    return rows.withColumn("source", F.when(F.col("source").isin(*REPLAY_LABELS), F.col("source")).otherwise(bad))


def replay_folder(spark: SparkSession, root: str, payload: T.StructType) -> DataFrame:
    """*.replayed.ndjson below a folder, historical only, by id; equal repetitions collapse, conflicts are an error."""
    e = T.StructType([f for f in envelope(payload) if f.name != "_corrupt_record"])
    rows = spark.read.schema(e).option("recursiveFileLookup", True).option("pathGlobFilter", "*.replayed.ndjson").option("mode", "FAILFAST").json(root)
    bad = F.raise_error(F.concat(F.lit("not historical: "), F.coalesce("source", F.lit("null"))))
    rows = rows.withColumn("source", F.when(F.col("source") == "replayed_historical", F.col("source")).otherwise(bad))
    return collapse_identical(rows, "event_id").orderBy("event_id")


def gold_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Serving documents, one a line, checked against the contract. A bad line fails the read, and the error names
    the file, the line and the fault; an empty file is an error of its own. A file is one task, as lines are counted."""
    from ..operators.validate import document_reason

    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("_path"), F.posexplode(F.split("value", "\r?\n")).alias("_line", "_raw")).where("trim(_raw) <> ''")
    if text.isEmpty():
        raise ValueError(f"no documents in {path}")
    got = text.withColumn("d", F.from_json("_raw", T.StructType([*schema, T.StructField("_bad", T.StringType())]), {"columnNameOfCorruptRecord": "_bad"}))
    where = F.concat(F.lit(" in "), F.col("_path"), F.lit(" line "), (F.col("_line") + 1).cast("string"))
    broken = F.col("d").isNull() | F.col("_bad").isNotNull()
    rows = got.select("_path", "_line", "_raw", "d.*").withColumn("d", F.lit(True))
    reason = F.when(broken, "invalid JSON").otherwise(document_reason())
    checked = F.when(reason.isNull(), F.col("signal_id")).otherwise(F.raise_error(F.concat(reason, where)))
    return rows.withColumn("signal_id", checked).select(*(f.name for f in schema))


def json_array(spark: SparkSession, path: str, schema: str, field: str | None = None) -> DataFrame:
    """Rows of an array in one JSON document: the document itself, or its field (records, features, markets).

    The document must have the array, else the read is an error.
    """
    text = spark.read.text(path, wholetext=True)
    if field:
        got = F.from_json("value", f"struct<{field}: array<{schema}>>")[field]
    else:
        one = F.array(F.from_json("value", schema))
        got = F.when(F.ltrim("value").startswith("["), F.from_json("value", f"array<{schema}>")).otherwise(one)
    got = F.when(got.isNotNull(), got).otherwise(F.raise_error(F.lit(f"no array {field or ''} in {path}")))
    return text.select(F.explode(got).alias("r")).select("r.*")


def page_query(base: str, key: str, limit: int, offset: int) -> str:
    """Address of a page of an open-data API."""
    from urllib.parse import urlencode

    if not key:
        raise ValueError("a key is required")
    if not 1 <= limit <= 100 or offset < 0:
        raise ValueError("limit must be 1 to 100 and offset not negative")
    return f"{base}?{urlencode({'api-key': key, 'format': 'json', 'limit': limit, 'offset': offset})}"


def geojson_features(spark: SparkSession, path: str, properties: str, crs: str | None = None) -> DataFrame:
    """(properties, geometry_json) of a feature collection; with crs, that of the file must contain it."""
    text = spark.read.text(path, wholetext=True)
    e = F.from_json("value", f"struct<crs: struct<properties: struct<name: string>>, features: array<struct<properties: {properties}, geometry: string>>>")
    feats = e["features"]
    bad = F.raise_error(F.lit(f"no features, or another projection, in {path}"))
    ok = feats.isNotNull() & (F.lit(True) if crs is None else F.coalesce(F.contains(e["crs"]["properties"]["name"], F.lit(crs)), F.lit(False)))
    return text.select(F.explode(F.when(ok, feats).otherwise(bad)).alias("f")).select("f.properties", F.col("f.geometry").alias("geometry_json"))


def district_boundary(spark: SparkSession, path: str, properties: str, wanted: dict[str, str], expected: dict[str, str], crs: str = "7755") -> DataFrame:
    """properties, geometry: the one feature whose properties are `wanted`, its rings in degrees.

    Another projection, none or several such features, other values than `expected` in it, and rings that
    aren't closed, cross themselves or lie outside of the globe are errors.
    """
    from ..functions.geo import ConicIndia, parse_geojson, ring_fault

    found = geojson_features(spark, path, properties, crs).where(reduce(lambda a, b: a & b, (F.col(f"properties.{k}") == v for k, v in wanted.items())))
    n = found.limit(2).count()
    if n != 1:
        raise ValueError(f"{'no' if not n else 'more than one'} feature {wanted} in {path}")
    wrong = F.coalesce(F.lit(None).cast("string"), *(F.when(~F.coalesce(F.trim(F.col(f"properties.{k}")) == v, F.lit(False)), F.lit(f"unexpected_{k}")) for k, v in expected.items()))
    rows = found.withColumn("geometry", ConicIndia().rings(parse_geojson("geometry_json")))
    kind = F.when(F.get_json_object("geometry_json", "$.type") != "MultiPolygon", "expected_multipolygon")
    fault = F.coalesce(kind, wrong, ring_fault(F.col("geometry")))
    return rows.select("properties", F.when(fault.isNull(), F.col("geometry")).otherwise(F.raise_error(fault)).alias("geometry"))


def market_snapshot(spark: SparkSession, path: str, scope: str) -> DataFrame:
    """Markets of a curated snapshot: right scope, full fields, https evidence, each market once; otherwise an error."""
    fields = ("source_state", "source_district", "source_market", "state_id", "district_id", "market_id", "evidence_url", "retrieved_at")
    text = spark.read.text(path, wholetext=True)
    e = F.from_json("value", f"struct<reference_scope: string, markets: array<struct<{', '.join(f'{f}: string' for f in fields)}>>>")
    rows = text.select(e.alias("e")).select(F.col("e.reference_scope").alias("_scope"), F.explode_outer("e.markets").alias("m")).select("_scope", "m.*")
    key = F.concat_ws("|", place_key("source_state"), place_key("source_market"))
    twice = rows.groupBy(key.alias("_k")).agg(F.count("*").alias("_n"))
    rows = rows.withColumn("_k", key).join(twice, "_k")
    full = F.coalesce(*(F.when(~F.coalesce(F.length(F.trim(f)) > 0, F.lit(False)), F.lit(f"missing {f}")) for f in fields))
    safe = (F.try_parse_url("evidence_url", F.lit("PROTOCOL")) == "https") & F.try_parse_url("evidence_url", F.lit("HOST")).isNotNull()
    fault = F.coalesce(F.when(~F.coalesce(F.col("_scope") == scope, F.lit(False)), "wrong scope"), full, F.when(~F.coalesce(safe, F.lit(False)), "evidence is not https"), F.when(F.col("_n") > 1, "market listed twice"))
    return rows.withColumn("market_id", F.when(fault.isNull(), F.col("market_id")).otherwise(F.raise_error(fault))).select(*fields)


# ---- daily state reports ---------------------------------------------------------------------------

#: The report's layout. The title ends "on dd-MMM-yyyy State/UT : name".
TITLE = r"(?i)on\s+([0-9]{2}-[a-z]{3}-[0-9]{4})\s+State/UT\s*:\s*([^\"]*[^\"\s])"
REPORT = ("Commodity", "Arrivals", "Arrival_Unit", "Variety", "Min_Price", "Max_Price", "Modal_Price", "Price_Unit")


def report_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, content) of report files, the byte order mark removed."""
    raw = spark.read.format("binaryFile").load(path)
    return raw.select("path", F.sha2("content", 256).alias("sha256"), F.regexp_replace(F.decode("content", "utf-8"), "^﻿", "").alias("content"))


def report_titles(files: DataFrame, title: str = TITLE) -> DataFrame:
    """Adds report_date, report_state and title_reason from the first line."""
    lines = F.split("content", "\r?\n")
    first = F.trim(F.get(lines, F.lit(0)))
    day, state = F.regexp_extract(first, title, 1), F.trim(F.regexp_extract(first, title, 2))
    date = F.to_date(F.try_to_timestamp(day, F.lit("dd-MMM-yyyy")))
    reason = F.when(F.size(lines) < 3, "report_too_short").when(day == "", "unrecognized_report_title").when(date.isNull(), "invalid_report_date")
    return files.withColumns({"report_date": F.when(day != "", date), "report_state": F.when(state != "", state), "title_reason": reason})


def report_rows(titled: DataFrame) -> DataFrame:
    """Data rows of the reports from the fourth line on, with market and commodity carried down and parse_error."""
    lines = titled.where("title_reason is null").select("path", "sha256", "report_date", "report_state", F.posexplode(F.split("content", "\r?\n")).alias("line_no", "line"))
    return _data_rows(lines.where("line_no >= 3"), "line_no")


def large_report_rows(spark: SparkSession, path: str, title: str = TITLE) -> DataFrame:
    """As report_rows() for reports of any size: a file is read in Spark's splits, each by a task of its own, and never held whole.

    A line's number is its split's start and its place there: (split_start, line_no). sha256 is null.
    """
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split_start"), F.col("value").alias("line"))
    text = text.withColumn("line_no", F.monotonically_increasing_id())
    firsts = text.groupBy("path").agg(F.min_by("line", F.struct("split_start", "line_no")).alias("content"), F.min(F.when(F.col("split_start") == 0, F.col("line_no"))).alias("_first"), F.count("*").alias("_n"))
    # the title needs the first line only; the count of lines stands in for them
    heads = report_titles(firsts.withColumn("content", F.concat("content", F.repeat(F.lit("\n"), F.least(F.col("_n"), F.lit(3)).cast("int") - 1))), title)
    heads = heads.where("title_reason is null").select("path", F.lit(None).cast("string").alias("sha256"), "report_date", "report_state", "_first")
    lines = text.join(heads, "path").where((F.col("split_start") > 0) | (F.col("line_no") - F.col("_first") >= 3)).drop("_first")
    return _data_rows(lines, "line_no", "split_start")


def _data_rows(lines: DataFrame, order: str, split: str | None = None) -> DataFrame:
    cells = F.from_csv("line", ", ".join(f"c{i} string" for i in range(10)))
    rows = lines.where("trim(replace(line, ',', '')) <> ''").withColumn("c", cells)
    count = F.size(F.split(F.regexp_replace("line", '"[^"]*"', "x"), ",", -1))
    head = F.trim("c.c0")
    is_market, is_group = F.lower(head).rlike(r"^market name\s*:"), F.lower(head).rlike(r"^commodity group name\s*:")
    rows = rows.withColumn("_kind", F.when(is_market, "market").when(is_group, "group").otherwise("data")).withColumn("_count", count)
    rows = rows.withColumn("Market", F.when(is_market, F.trim(F.substring_index(F.expr("substring(trim(c.c0), instr(c.c0, ':') + 1)"), ",", 1))))
    good = (F.col("_kind") == "data") & (F.col("_count") == len(REPORT))
    rows = rows.withColumn("Commodity", F.when(good & (F.length(head) > 0), head))
    rows = fill_context(rows, "path", order, "Market", "Commodity", split).where("_kind = 'data'")
    cols = [F.trim(f"c.c{i}").alias(n) for i, n in enumerate(REPORT) if i]
    place = [order] if split is None else [split, order]
    return rows.select("path", "sha256", *place, "report_date", "report_state", "Market", "Commodity", *cols, F.when(F.col("_count") != len(REPORT), "unexpected_column_count").alias("parse_error"))


def stage_reports(titled: DataFrame, state: str, first: Column, last: Column) -> DataFrame:
    """Adds outcome to each file: kept, duplicate, conflict, or ignored (another state, outside the window, no title)."""
    from ..operators.quality import keep_first

    fits = F.col("title_reason").isNull() & (F.lower("report_state") == state.lower()) & F.col("report_date").between(first, last)
    fits = F.coalesce(fits, F.lit(False))
    inside = keep_first(titled.where(fits), ["report_date"], ["path"], "sha256")
    return inside.unionByName(titled.where(~fits).withColumn("outcome", F.lit("ignored")))

"""The driver's tables in the roles of the domain. Timestamps without a zone become UTC here, once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import sha256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*(F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else F.col(c) for c, t in df.dtypes))


def day_text(c: str):
    return F.date_format(c, "yyyy-MM-dd")


def prices(spark: SparkSession, d: str) -> DataFrame:
    """A line item as a price observation: nation as district, supplier as market, part type as commodity."""
    line, supplier, nation, part = (table(spark, d, t) for t in ("lineitem", "supplier", "nation", "part"))
    places = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    # the larger join first, so that its shuffle has no names of places
    rows = line.join(part, F.col("l_partkey") == F.col("p_partkey")).join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.select(
        sha256("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day_text("l_shipdate")).alias("event_id"), F.col("l_shipdate").alias("event_time"),
        F.col("n_regionkey").cast("string").alias("state_id"), F.col("n_name").alias("district_id"), F.col("s_name").alias("market_id"), F.col("p_type").alias("commodity_id"),
        F.col("p_brand").alias("variety"), F.lit("unit").alias("price_unit"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("modal_price"),
    )


def shocks(spark: SparkSession, d: str) -> DataFrame:
    """Urgent pending orders as shocks of the customer's nation."""
    orders, customer, nation = (table(spark, d, t) for t in ("orders", "customer", "nation"))
    rows = orders.where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'").join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(
        F.col("o_orderkey").cast("string").alias("shock_id"), F.lit("order_shock").alias("shock_type"), F.col("o_orderdate").alias("shock_time"), F.col("o_orderdate").alias("event_time"),
        F.col("n_name").alias("district_id"), F.lit("same_district").alias("spatial_relationship"), F.least(F.lit(1.0), F.col("o_totalprice") / 500000).alias("shock_severity"),
        F.col("o_orderkey").cast("string").alias("source_reference"),
    )


#: The same in DuckDB SQL, as common table expressions.
PRICES_SQL = """prices AS (
  SELECT sha256(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d'))) AS event_id, l_shipdate AS event_time, CAST(n_regionkey AS VARCHAR) AS state_id,
         n_name AS district_id, s_name AS market_id, p_type AS commodity_id, p_brand AS variety, 'unit' AS price_unit, l_extendedprice / l_quantity AS modal_price
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)"""
SHOCKS_SQL = """shocks AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS shock_id, o_orderdate AS shock_time, n_name AS district_id, least(1.0, o_totalprice / 500000) AS shock_severity
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')"""


def broker_records(spark: SparkSession, d: str) -> DataFrame:
    """Line items as broker records of JSON envelopes; by the order key some are broken, each in its own way."""
    line = table(spark, d, "lineitem")
    k = F.col("l_orderkey") % 12
    payload = F.struct(
        F.lit("S").alias("state"), F.when(k == 5, "  ").otherwise("D").alias("district"), F.when(k == 6, F.lit(None)).otherwise("M").alias("market"), F.col("l_shipmode" if "l_shipmode" in line.columns else "l_returnflag").alias("commodity"),
        F.when(k == 7, F.lit(None)).otherwise(F.lit("1.00")).alias("min_price"), F.when(k == 8, "-1").otherwise(F.col("l_linenumber").cast("string")).alias("modal_price"), F.lit("7.00").alias("max_price"), F.lit("u").alias("price_unit"),
    )
    event = F.struct(
        F.when(k != 3, F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")).alias("event_id"), F.lit("mandi_price").alias("event_type"),
        F.when(k == 4, "no time").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ssxxx")).alias("event_time"), F.lit("2024-01-01T00:00:00+00:00").alias("ingestion_time"),
        F.lit("test").alias("source"), F.lit("1.0").alias("schema_version"), payload.alias("payload"),
    )
    raw = F.when(k == 0, "{not json").when(k == 1, "[1,2]").when(k == 2, "null").otherwise(F.to_json(event))
    return line.select(
        F.lit(None).cast("string").alias("kafka_key"), raw.alias("raw_json"), F.lit("mandi-prices").alias("topic"), F.lit(0).alias("partition"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("offset"), F.col("l_shipdate").alias("kafka_timestamp"),
    )


REASON_SQL = """CASE WHEN l_orderkey % 12 IN (0, 1, 2) THEN 'malformed_json' WHEN l_orderkey % 12 = 3 THEN 'missing_event_id' WHEN l_orderkey % 12 = 4 THEN 'invalid_event_time'
       WHEN l_orderkey % 12 IN (5, 6, 7, 8) OR l_linenumber NOT BETWEEN 1 AND 7 THEN 'mandi_schema_or_price_validation_failed' END"""

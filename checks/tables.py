"""How the given tables play flow, event and reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens import Roles

FLOW = Roles(
    src="src", dst="dst", src_port="src_port", dst_port="dst_port", proto="proto",
    service="service", state="state", src_bytes="src_bytes", dst_bytes="dst_bytes",
    duration="duration", ts="ts", label="label", category="category", attack="attack_type",
    count="conn_count", srv_count="srv_count", dst_host_count="dst_host_count",
    serror_rate="serror_rate", rerror_rate="rerror_rate",
)
FLOW_ORDER = ("duration", "flow_id", "src_port", "dst", "src", "price")

EVENT = Roles(
    src="src", ts="ts", epoch="stime", category="category", attack="attack_type",
    duration="duration", src_bytes="src_bytes", dst_bytes="dst_bytes", dst_port="dst_port",
)
EVENT_ORDER = ("ts", "event_id")


# Declared, so that no job has to look for them in the files.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their orders as a flow table."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    items = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    price, priority = F.col("l_extendedprice"), F.col("o_orderpriority")
    attack = (
        F.when(priority == "1-URGENT", "neptune.")
        .when((priority == "2-HIGH") & (F.col("o_orderstatus") != "P"), "mystery")
        .when(priority == "3-MEDIUM", "normal")
        .when(priority == "4-NOT SPECIFIED", "normal.")
        .when(priority == "5-LOW", "ipsweep.")
    )
    category = (
        F.when(priority == "1-URGENT", "DoS")
        .when(priority == "2-HIGH", "Exploits")
        .when(priority == "3-MEDIUM", "Normal")
        .when(priority == "5-LOW", "Reconnaissance")
    )
    urgent = (F.col("o_orderstatus") == "F") & (priority == "1-URGENT")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("flow_id"),
        F.col("l_suppkey").alias("src"),
        F.col("l_partkey").alias("dst"),
        F.col("l_linenumber").alias("src_port"),
        (F.col("l_partkey") % 1024).cast("int").alias("dst_port"),
        F.col("l_returnflag").alias("proto"),
        F.col("l_linestatus").alias("state"),
        priority.alias("service"),
        price.alias("price"),
        F.col("l_quantity").alias("duration"),
        F.floor(price).alias("src_bytes"),
        F.floor(price * F.col("l_discount")).alias("dst_bytes"),
        F.when(F.col("l_tax") < 0.08, F.floor(price)).cast("int").alias("load_bytes"),
        F.col("l_shipdate").alias("ts"),
        category.alias("attack_cat"),
        F.coalesce(F.when(category != "Normal", category), F.lit("normal")).alias("category"),
        attack.alias("attack_type"),
        F.when(urgent, 1).otherwise(0).alias("label"),
        F.col("l_quantity").cast("int").alias("conn_count"),
        F.col("l_linenumber").alias("srv_count"),
        F.floor("o_totalprice").alias("dst_host_count"),
        F.col("l_discount").alias("serror_rate"),
        F.col("l_tax").alias("rerror_rate"),
    )


FLOWS_SQL = """
flows AS (
  SELECT *, CASE WHEN attack_cat IS NULL OR attack_cat = 'Normal' THEN 'normal'
                 ELSE attack_cat END AS category
  FROM (
    SELECT l_orderkey AS flow_id, l_suppkey AS src, l_partkey AS dst,
           l_linenumber AS src_port, CAST(l_partkey % 1024 AS INTEGER) AS dst_port,
           l_returnflag AS proto, l_linestatus AS state, o_orderpriority AS service,
           l_extendedprice AS price, l_quantity AS duration,
           CAST(floor(l_extendedprice) AS BIGINT) AS src_bytes,
           CAST(floor(l_extendedprice * l_discount) AS BIGINT) AS dst_bytes,
           CASE WHEN l_tax < 0.08 THEN CAST(floor(l_extendedprice) AS INTEGER) END AS load_bytes,
           l_shipdate AS ts,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'DoS' WHEN '2-HIGH' THEN 'Exploits'
             WHEN '3-MEDIUM' THEN 'Normal' WHEN '5-LOW' THEN 'Reconnaissance' END AS attack_cat,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'neptune.'
             WHEN o_orderpriority = '2-HIGH' AND o_orderstatus <> 'P' THEN 'mystery'
             WHEN o_orderpriority = '3-MEDIUM' THEN 'normal'
             WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'normal.'
             WHEN o_orderpriority = '5-LOW' THEN 'ipsweep.' END AS attack_type,
           CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
             THEN 1 ELSE 0 END AS label,
           CAST(l_quantity AS INTEGER) AS conn_count, l_linenumber AS srv_count,
           CAST(floor(o_totalprice) AS BIGINT) AS dst_host_count,
           l_discount AS serror_rate, l_tax AS rerror_rate
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey))
"""


def event_columns() -> list:
    """Columns of the event table, the same for rows at rest and on a stream."""
    port = F.get_json_object("props", "$.k").cast("int")
    return [
        F.col("event_id"),
        F.col("user_id").alias("src"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("stime"),
        F.col("event_type").alias("attack_type"),
        F.when(F.col("event_type") == "error", "error").otherwise("normal").alias("category"),
        F.col("value").alias("duration"),
        F.floor("value").alias("src_bytes"),
        port.cast("bigint").alias("dst_bytes"),
        port.alias("dst_port"),
    ]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return table(spark, sf_dir, "events").select(*event_columns())


EVENTS_SQL = """
evt AS (
  SELECT event_id, user_id AS src, ts, CAST(floor(epoch(ts)) AS BIGINT) AS stime,
         event_type AS attack_type,
         CASE WHEN event_type = 'error' THEN 'error' ELSE 'normal' END AS category,
         value AS duration, CAST(floor(value) AS BIGINT) AS src_bytes,
         CAST(json_extract(props, '$.k') AS BIGINT) AS dst_bytes,
         CAST(json_extract(props, '$.k') AS INTEGER) AS dst_port
  FROM events)
"""

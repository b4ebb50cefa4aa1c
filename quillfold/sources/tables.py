"""The registered tables, and views of them in the shape of a document platform's records.

events are change-feed entries; orders are processing requests; lineitems are batch items and their files; customers
are Sources, nations tenants, suppliers Resources; parts are methods; conversations are attempts at an item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillfold.functions.codecs import position


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed entries: position, kind, document_uid, source_id, occurred_us, value."""
    e = load(spark, sf_dir, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return e.select(
        position(us, F.col("event_id")).alias("position"),
        F.col("event_type").alias("kind"),
        F.concat(F.lit("doc_"), F.col("user_id").cast("string")).alias("document_uid"),
        (F.col("user_id") % 20).alias("source_id"),
        us.alias("occurred_us"),
        "event_id",
        "value",
    )


#: The same view for the SQL twins.
FEED_SQL = """feed AS (
    SELECT printf('%016x', epoch_us(ts)) || printf('%016x', event_id) AS position, event_type AS kind,
           'doc_' || user_id AS document_uid, user_id % 20 AS source_id, epoch_us(ts) AS occurred_us, event_id, value
    FROM events)"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests: request_id, document_id, state, priority, created_day (days since 1970), cost."""
    o = load(spark, sf_dir, "orders")
    state = F.when(F.col("o_orderstatus") == "O", "queued").when(F.col("o_orderstatus") == "P", "processing").otherwise("ended")
    return o.select(
        F.col("o_orderkey").alias("request_id"),
        F.col("o_custkey").alias("document_id"),
        state.alias("state"),
        F.when(F.col("o_orderpriority") == "5-LOW", "low").otherwise("normal").alias("priority"),
        F.unix_date(F.col("o_orderdate").cast("date")).cast("long").alias("created_day"),
        F.col("o_totalprice").alias("cost"),
    )


REQUESTS_SQL = """requests AS (
    SELECT o_orderkey AS request_id, o_custkey AS document_id,
           CASE o_orderstatus WHEN 'O' THEN 'queued' WHEN 'P' THEN 'processing' ELSE 'ended' END AS state,
           CASE WHEN o_orderpriority = '5-LOW' THEN 'low' ELSE 'normal' END AS priority,
           CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS created_day, o_totalprice AS cost
    FROM orders)"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch items: batch_id, idx, document_id, path, size, status."""
    li = load(spark, sf_dir, "lineitem")
    status = F.when(F.col("l_returnflag") == "R", "rejected").when(F.col("l_returnflag") == "A", "unchanged").otherwise(F.when(F.col("l_linestatus") == "O", "declared").otherwise("queued"))
    return li.select(
        F.col("l_orderkey").alias("batch_id"),
        F.col("l_linenumber").cast("long").alias("idx"),
        F.col("l_partkey").alias("document_id"),
        F.concat(F.lit("part/"), F.col("l_suppkey").cast("string"), F.lit(".pdf")).alias("path"),
        F.col("l_quantity").cast("long").alias("size"),
        status.alias("status"),
        F.unix_date(F.col("l_shipdate").cast("date")).cast("long").alias("day"),
    )


ITEMS_SQL = """items AS (
    SELECT l_orderkey AS batch_id, CAST(l_linenumber AS BIGINT) AS idx, l_partkey AS document_id,
           'part/' || l_suppkey || '.pdf' AS path, CAST(l_quantity AS BIGINT) AS size,
           CASE WHEN l_returnflag = 'R' THEN 'rejected' WHEN l_returnflag = 'A' THEN 'unchanged'
                WHEN l_linestatus = 'O' THEN 'declared' ELSE 'queued' END AS status,
           CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) AS day
    FROM lineitem)"""

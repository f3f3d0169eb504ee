"""Ids, newest versions and new rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventweft.checks.registry import CUSTOMERS, EVENTS, day, query, sql_day, sql_hash, sql_stamp, sql_uuid, stamp, with_parts
from eventweft.functions import identity as I
from eventweft.models import orders as M
from eventweft.operators import dedup as D
from eventweft.plans.run import open_batch
from eventweft.sources.corpus import order_events, table


@query(
    "record_hash",
    f"""SELECT o_orderkey, {sql_hash("o_orderkey", "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END", "CAST(o_totalprice AS DECIMAL(12,2))", "CAST(o_orderdate AS DATE)")} AS hash,
    {sql_hash("o_orderkey", "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus ELSE '~' END")} AS hash_with_token FROM orders""",
)
def record_hash(spark, sf_dir):
    status = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus"))
    key, total, date = F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(12,2)"), F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        I.record_hash([key, status, total, date]).alias("hash"),
        I.record_hash([key, status], null_token="~").alias("hash_with_token"),
    )


@query("uuid_v5", f"SELECT c_custkey, {sql_uuid('c_name')} AS id, {sql_uuid(sql_hash('c_name', 'c_mktsegment'))} AS key_id FROM customer")
def uuid_v5(spark, sf_dir):
    name = F.col("c_name")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", I.uuid_v5(name).alias("id"), I.row_id([name, F.col("c_mktsegment")], F.col("c_custkey")).alias("key_id")
    )


@query(
    "latest_per_id",
    f"""{with_parts(EVENTS, CUSTOMERS)}
    SELECT id, custkey, source_id, {sql_stamp("received_at")} AS received_at FROM cu WHERE NOT rejected
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY received_at DESC, source_id DESC) = 1""",
)
def latest_per_id(spark, sf_dir):
    """Every order event carries its customer; the newest version of each stays."""
    rows = open_batch(order_events(spark, sf_dir), M.ORDERS).succeeded("customer")
    return rows.select("id", F.col("custKey").alias("custkey"), "source_id", stamp("received_at").alias("received_at"))


@query(
    "new_only_anti_join",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o
    WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_quantity > 40)""",
)
def new_only_anti_join(spark, sf_dir):
    batch = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    stored = table(spark, sf_dir, "lineitem").filter("l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey"))
    return D.new_only(batch, stored, key="o_orderkey")


@query(
    "sort_latest",
    f"SELECT o_orderkey, {sql_day('o_orderdate')} AS ordered_on FROM orders ORDER BY o_orderdate DESC, o_orderkey",
)
def sort_latest(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return D.newest_first(rows, "o_orderdate", "o_orderkey").select("o_orderkey", day("o_orderdate").alias("ordered_on"))


@query(
    "time_override",
    f"""{with_parts(EVENTS)}
    SELECT source_id, {sql_stamp("CAST(o_orderdate AS TIMESTAMP)")} AS received_at, 'Open' AS code FROM ev WHERE kind < 3
    UNION ALL SELECT source_id, {sql_stamp("CAST(o_orderdate AS TIMESTAMP) + INTERVAL 2 DAY")},
      CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Fulfilled' ELSE 'Pending' END FROM ev""",
)
def time_override(spark, sf_dir):
    """Status rows take their own time, not the event's."""
    rows = open_batch(order_events(spark, sf_dir), M.ORDERS).all_rows("statusChange")
    return rows.select("source_id", stamp("received_at").alias("received_at"), "code")



"""Registration, and the SQL pieces the answers share.

Times, dates and money leave a query as text or double, so that both engines show them alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweft.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def stamp(value: Column | str) -> Column:
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSS")


def day(value: Column | str) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def sql_stamp(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d %H:%M:%S.%g')"


def sql_day(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d')"


def sql_hash(*values: str) -> str:
    return f"sha256(concat_ws('|', {', '.join(f'CAST({v} AS VARCHAR)' for v in values)}))"


def sql_uuid(name: str) -> str:
    s = f"sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode({name}))"
    return (
        f"(substr({s},1,8) || '-' || substr({s},9,4) || '-5' || substr({s},14,3) || '-' || "
        f"translate(substr({s},17,1),'0123456789abcdef','89ab89ab89ab89ab') || substr({s},18,3) || '-' || substr({s},21,12))"
    )


def sql_id(*values: str) -> str:
    return sql_uuid(sql_hash(*values))


# The events and rows of the order model, told from the star tables.
EVENTS = """
ev AS (
  SELECT o.*, c.*, n.n_name, k.n AS kind, k.name AS event_name, o_orderkey * 10 + k.n AS source_id,
         CAST(o_orderdate AS TIMESTAMP) + INTERVAL (k.n - 1) DAY + INTERVAL 29239 SECOND
           + INTERVAL (o_orderkey % 1000) MILLISECOND AS received_at
  FROM orders o JOIN customer c ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n_nationkey
  JOIN (VALUES (1, 'orderCreate'), (2, 'orderModify'), (3, 'orderCancel')) k(n, name)
    ON k.n = 1 OR (k.n = 2 AND o_orderkey % 10 = 0) OR (k.n = 3 AND o_orderstatus = 'F'))"""

CUSTOMERS = f"""
cu AS (
  SELECT {sql_id("c_custkey", "c_name", "CASE WHEN kind < 3 THEN c_mktsegment END")} AS id,
         c_custkey AS custkey, c_name AS name, CASE WHEN kind < 3 THEN c_mktsegment END AS segment,
         CASE WHEN kind < 3 THEN c_acctbal > 0 END AS vip, CASE WHEN kind < 3 THEN n_name END AS nation_name,
         received_at, source_id, c_name LIKE '%007%' AS rejected
  FROM ev)"""

PURCHASES = f"""
pu0 AS (
  SELECT ev.*, CASE WHEN NOT cu.rejected THEN cu.id END AS customer_id,
         CASE WHEN kind < 3 THEN CAST(o_orderdate AS DATE) END AS placed_date,
         CASE WHEN kind < 3 THEN CAST(o_totalprice AS DECIMAL(12,2)) END AS total,
         CASE WHEN kind < 3 AND o_orderkey % 7 <> 0 THEN o_orderpriority END AS placed_priority
  FROM ev JOIN cu ON ev.source_id = cu.source_id),
pu AS (
  SELECT {sql_id("o_orderkey", "customer_id", "event_name", "placed_date", "total")} AS id, *
  FROM pu0)"""

ITEM_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "CAST(l_quantity AS INT)", "CAST(l_extendedprice AS DECIMAL(12,2))")
ITEMS = f"""
it AS (
  SELECT {sql_id(*ITEM_KEY)} AS id, ev.source_id, ev.received_at, l.*,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         row_number() OVER (PARTITION BY ev.source_id ORDER BY l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT),
           CAST(l_extendedprice AS DECIMAL(12,2)), strftime(l_shipdate, '%d/%m/%Y'), l_returnflag, l_linestatus,
           l_discount, l_tax) - 1 AS ord
  FROM ev JOIN lineitem l ON o_orderkey = l_orderkey WHERE kind < 3)"""

REFERENCES = f"""
re AS (
  SELECT {sql_id("number", "source")} AS id, * FROM (
    SELECT 'R' || o_orderkey AS number, 'web' AS source, source_id, received_at FROM ev WHERE kind < 3
    UNION ALL SELECT NULL, 'desk', source_id, received_at FROM ev WHERE kind < 3 AND o_orderkey % 5 = 0
    UNION ALL SELECT 'R' || o_orderkey || '-s', 'store', source_id, received_at FROM ev WHERE kind < 3 AND o_orderkey % 3 = 0))"""

_LABEL = "CASE lower(raw_code) WHEN 'o' THEN 'Open' WHEN 'f' THEN 'Fulfilled' WHEN 'p' THEN 'Pending' ELSE raw_code END"
STATUSES = f"""
st AS (
  SELECT {sql_id("o_orderkey", "strftime(happened, '%Y-%m-%d %H:%M:%S')", "raw_code")} AS id, *, {_LABEL} AS code FROM (
    SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS happened, 'o' AS raw_code, source_id FROM ev WHERE kind < 3
    UNION ALL SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 2 DAY, o_orderstatus, source_id FROM ev))"""

CHARGES = f"""
ch AS (
  SELECT {sql_id("kind", "amount")} AS id, * FROM (
    SELECT 'discount' AS kind, CAST(l_discount AS DECIMAL(5,2)) AS amount, it.id AS item_id, source_id, received_at
    FROM it WHERE l_discount > 0
    UNION ALL SELECT 'tax', CAST(l_tax AS DECIMAL(5,2)), it.id, source_id, received_at FROM it WHERE l_tax > 0))"""


def with_parts(*parts: str) -> str:
    return "WITH " + ",".join(parts)

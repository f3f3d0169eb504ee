"""The hospitality model over orders told as hotel stays."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from eventweft.checks.registry import query, sql_id
from eventweft.models.hospitality import HOSPITALITY
from eventweft.operators import quality as Q
from eventweft.plans import shred as S
from eventweft.plans.run import open_batch
from eventweft.sources.corpus import stay_events

_STAYS = f"""
sv AS (
  SELECT o.*, c.*, n.*, k.n AS kind, k.name AS event_name, o_orderkey * 10 + k.n AS source_id,
    n_nationkey % 7 <> 0 AND n_nationkey <> 3 AS hotel_ok, strftime(o_orderdate, '%Y-%m-%d') AS d0,
    strftime(CAST(o_orderdate AS TIMESTAMP) + INTERVAL 2 DAY, '%Y-%m-%d') AS d2
  FROM orders o JOIN customer c ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n_nationkey
  JOIN (VALUES (1, 'reservationCreate'), (2, 'reservationCheckIn'), (3, 'reservationCancel')) k(n, name)
    ON k.n = 1 OR (k.n = 2 AND o_orderstatus = 'O') OR (k.n = 3 AND o_orderstatus = 'F')),
hk AS (SELECT *, CASE WHEN hotel_ok THEN {sql_id("n_nationkey", "'H' || n_nationkey")} END AS hid,
  {sql_id("d0", "d2", "o_orderkey % 400")} AS rid FROM sv),
rv AS (SELECT *, {sql_id(
    "CASE WHEN kind = 1 THEN o_orderkey END", "hid", "event_name", "CASE WHEN kind < 3 THEN d0 END",
    "CASE WHEN kind < 3 THEN d2 END", "rid", "CASE WHEN kind = 1 THEN CAST(o_totalprice AS DECIMAL(12,2)) END",
)} AS id FROM hk)"""


@query(
    "stays_reservations",
    f"WITH {_STAYS} SELECT source_id, id, hid AS hotel_id, rid AS room_id, hid IS NOT NULL AS valid FROM rv",
)
def stays_reservations(spark, sf_dir):
    """Reservations of three event types with their hotel and room; test hotels and unfit hotels fail them."""
    rows = open_batch(stay_events(spark, sf_dir), HOSPITALITY).all_rows("reservation")
    return rows.select(
        "source_id", "id", F.col("hotels_id").alias("hotel_id"), F.col("reservedRoom").alias("room_id"), Q.passes().alias("valid")
    )


_TABLES = ("hotel", "confirmationNumber", "reservationStatus", "customer", "contact", "contactPurpose", "reservedRoom", "creditCard", "guarantee", "reservationItem", "paymentMethod", "reservation")


@query(
    "stays_counts",
    f"""WITH {_STAYS}, t AS (SELECT count(*) AS n, count_if(kind = 1) AS made, count_if(kind < 3) AS kept, count_if(hotel_ok) AS ok FROM sv)
    SELECT 'hotel' AS table_name, n AS n_rows, ok AS n_valid, n - ok AS n_failed FROM t
    UNION ALL SELECT 'confirmationNumber', n, n, 0 FROM t UNION ALL SELECT 'reservationStatus', kept, kept, 0 FROM t
    UNION ALL SELECT 'customer', n, n, 0 FROM t UNION ALL SELECT 'contact', 2 * n, 2 * n, 0 FROM t
    UNION ALL SELECT 'contactPurpose', n, n, 0 FROM t UNION ALL SELECT 'reservedRoom', n, n, 0 FROM t
    UNION ALL SELECT 'creditCard', 2 * made, 2 * made, 0 FROM t UNION ALL SELECT 'guarantee', made, made, 0 FROM t
    UNION ALL SELECT 'reservationItem', made, made, 0 FROM t UNION ALL SELECT 'paymentMethod', made, made, 0 FROM t
    UNION ALL SELECT 'travelAgent', 0, 0, 0 UNION ALL SELECT 'company', 0, 0, 0
    UNION ALL SELECT 'reservation', n, ok, n - ok FROM t""",
)
def stays_counts(spark, sf_dir):
    return open_batch(stay_events(spark, sf_dir), HOSPITALITY).counts(*_TABLES)


@query(
    "stays_links",
    f"""WITH {_STAYS}, p AS (
      SELECT 'reservationCustomerLink' AS table_name, id AS l, {sql_id("c_name", "'Ada'", "CASE WHEN kind = 1 THEN TRUE END")} AS r FROM rv WHERE hid IS NOT NULL
      UNION ALL SELECT 'contactContactPurposeLink', {sql_id("'c' || c_custkey || '@example.com'", "TRUE")}, {sql_id("'home'")} FROM rv
      UNION ALL SELECT 'contactContactPurposeLink', {sql_id("FALSE")}, {sql_id("'home'")} FROM rv)
    SELECT DISTINCT table_name, l AS left_id, r AS right_id FROM p""",
)
def stays_links(spark, sf_dir):
    names = ("reservationCustomerLink", "contactContactPurposeLink")
    batch = open_batch(stay_events(spark, sf_dir), S.for_links(HOSPITALITY, *names), stage="documents")
    parts = []
    for name in names:
        ln = HOSPITALITY.table(name)
        parts.append(batch.succeeded(name).select(F.lit(name).alias("table_name"), F.col(ln.left_column).alias("left_id"), F.col(ln.right_column).alias("right_id")))
    return reduce(lambda a, b: a.unionByName(b), parts)

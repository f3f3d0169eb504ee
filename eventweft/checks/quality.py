"""Rows set aside, with reasons, and their counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventweft.checks.registry import CUSTOMERS, EVENTS, PURCHASES, REFERENCES, query, with_parts
from eventweft.models import orders as M
from eventweft.operators import quality as Q
from eventweft.plans.run import open_batch
from eventweft.sources.corpus import order_events, part_events, table
from eventweft.spec import Reject


@query(
    "nullability_split",
    f"""{with_parts(EVENTS, REFERENCES)}
    SELECT source_id, source, number IS NOT NULL AS valid, CASE WHEN number IS NULL THEN 'null:number' ELSE '' END AS reasons FROM re""",
)
def nullability_split(spark, sf_dir):
    rows = open_batch(order_events(spark, sf_dir), M.ORDERS).all_rows("reference")
    return rows.select("source_id", "source", Q.passes().alias("valid"), F.concat_ws(",", Q.REASONS).alias("reasons"))


@query(
    "nonfinite_split",
    """SELECT l_orderkey, l_linenumber, l_discount > 0 AND l_tax > 0 AS valid FROM lineitem""",
)
def nonfinite_split(spark, sf_dir):
    """Tax per discount is NaN or infinite where a discount is zero, its inverse where a tax is."""
    ratio = F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(F.col("l_tax") / F.col("l_discount"))
    inverse = F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.lit(1.0))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", ratio.alias("ratio"), inverse.alias("inverse"))
    judged = rows.withColumn(Q.REASONS, Q.reasons(F.col, finite=["ratio", "inverse"]))
    return judged.select("l_orderkey", "l_linenumber", Q.passes().alias("valid"))


@query(
    "reject_pattern",
    """SELECT p_partkey, p_name, CASE WHEN lower(p_name) LIKE '%ring%' THEN 'rejected:p_name' ELSE '' END AS reasons FROM part""",
)
def reject_pattern(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    judged = rows.withColumn(Q.REASONS, Q.reasons(F.col, rejects=[Reject("p_name", "RING")]))
    return judged.select("p_partkey", "p_name", F.concat_ws(",", Q.REASONS).alias("reasons"))


@query(
    "missing_time",
    f"""{with_parts(EVENTS)}
    SELECT source_id, CASE WHEN o_orderkey % 9 = 0 THEN 'null:received_at' ELSE '' END AS reasons FROM ev WHERE c_name NOT LIKE '%007%'""",
)
def missing_time(spark, sf_dir):
    """Rows of an event without a time are failures with a reason, not lost."""
    events = order_events(spark, sf_dir)
    at = F.when(F.floor(F.col("id") / 10) % 9 != 0, F.col("event_timestamp"))
    rows = open_batch(events.withColumn("event_timestamp", at), M.ORDERS).all_rows("customer")
    return rows.filter(~F.array_contains(Q.REASONS, "rejected:name")).select(
        "source_id", F.concat_ws(",", Q.REASONS).alias("reasons")
    )


RECONCILE_SQL = f"""{with_parts(EVENTS, CUSTOMERS, PURCHASES, REFERENCES)}
    SELECT 'customer' AS table_name, count(*) AS n_rows, count_if(NOT rejected) AS n_valid, count_if(rejected) AS n_failed FROM cu
    UNION ALL SELECT 'purchase', count(*), count(customer_id), count(*) - count(customer_id) FROM pu
    UNION ALL SELECT 'reference', count(*), count(number), count(*) - count(number) FROM re
    UNION ALL SELECT 'statusChange', CAST(sum(CASE WHEN kind < 3 THEN 2 ELSE 1 END) AS BIGINT), CAST(sum(CASE WHEN kind < 3 THEN 2 ELSE 1 END) AS BIGINT), 0 FROM ev
    UNION ALL SELECT 'item', count(*), count(*), 0 FROM ev JOIN lineitem ON o_orderkey = l_orderkey WHERE kind < 3
    UNION ALL SELECT 'charge', count(*), count(*), 0 FROM ev JOIN (
        SELECT l_orderkey FROM lineitem WHERE l_discount > 0 UNION ALL SELECT l_orderkey FROM lineitem WHERE l_tax > 0) c
        ON o_orderkey = c.l_orderkey WHERE kind < 3
    UNION ALL SELECT 'product', count(*), count(*), 0 FROM part"""


@query("reconcile_counts", RECONCILE_SQL)
def reconcile_counts(spark, sf_dir):
    landed = order_events(spark, sf_dir).unionByName(part_events(spark, sf_dir))
    return open_batch(landed, M.ORDERS).counts()


@query(
    "failed_rows",
    f"""{with_parts(EVENTS, CUSTOMERS, PURCHASES, REFERENCES)}
    SELECT 'customer' AS table_name, id, source_id, 'rejected:name' AS reasons FROM cu WHERE rejected
    UNION ALL SELECT 'purchase', id, source_id, 'null:customer_id' FROM pu WHERE customer_id IS NULL
    UNION ALL SELECT 'reference', id, source_id, 'null:number' FROM re WHERE number IS NULL""",
)
def failed_rows(spark, sf_dir):
    batch = open_batch(order_events(spark, sf_dir), M.ORDERS)
    parts = [
        batch.failed(t).select(F.lit(t).alias("table_name"), "id", "source_id", F.concat_ws(",", Q.REASONS).alias("reasons"))
        for t in ("customer", "purchase", "reference")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "null_guard",
    f"""{with_parts(EVENTS)}
    SELECT source_id AS id, CASE WHEN source_id % 50 = 1 THEN '{{}}' ELSE 'text' END AS raw_kind FROM ev WHERE o_orderkey % 11 <> 0""",
)
def null_guard(spark, sf_dir):
    events = order_events(spark, sf_dir)
    holes = events.select(
        F.when(F.floor(F.col("id") / 10) % 11 != 0, F.col("id")).alias("id"), F.when(F.col("id") % 50 != 1, F.col("raw")).alias("raw")
    )
    guarded = Q.null_guard(holes)
    return guarded.select("id", F.when(F.col("raw") == "{}", "{}").otherwise("text").alias("raw_kind"))


@query(
    "reject_cascade",
    f"""{with_parts(EVENTS)}
    SELECT table_name, count(*) AS n_rows, count_if(c_name LIKE '%007%') AS n_failed FROM ev
    JOIN (VALUES ('customer'), ('purchase')) t(table_name) ON TRUE GROUP BY 1
    UNION ALL SELECT 'statusChange', CAST(sum(n) AS BIGINT), CAST(sum(CASE WHEN c_name LIKE '%007%' THEN n ELSE 0 END) AS BIGINT)
    FROM (SELECT c_name, CASE WHEN kind < 3 THEN 2 ELSE 1 END AS n FROM ev)""",
)
def reject_cascade(spark, sf_dir):
    """With cascading, a rejected customer takes every row of its event along."""
    batch = open_batch(order_events(spark, sf_dir), M.ORDERS_CASCADING)
    return batch.counts("purchase", "statusChange").select("table_name", "n_rows", "n_failed")



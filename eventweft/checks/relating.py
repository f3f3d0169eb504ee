"""Foreign keys and links."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventweft.checks.registry import (
    CHARGES, CUSTOMERS, EVENTS, ITEMS, PURCHASES, REFERENCES, query, sql_id, sql_stamp, stamp, with_parts,
)
from eventweft.models import orders as M
from eventweft.operators import relate as R
from eventweft.plans.run import open_batch
from eventweft.sources.corpus import order_events, table
from eventweft.spec import ForeignKey, Link


@query(
    "fk_resolve",
    f"""{with_parts(EVENTS, CUSTOMERS, PURCHASES)}
    SELECT source_id, event_name, o_orderkey AS orderkey, id, customer_id FROM pu""",
)
def fk_resolve(spark, sf_dir):
    """Purchases take the id of their event's customer; the row's own id then rests on it."""
    rows = open_batch(order_events(spark, sf_dir), M.ORDERS).all_rows("purchase")
    return rows.select("source_id", F.col("eventInfo_name").alias("event_name"), F.col("orderKey").alias("orderkey"), "id", "customer_id")


_ORDER_FK = ForeignKey("line", "order", "order_id")


@query(
    "fk_join_frames",
    f"""SELECT l_orderkey AS source_id, l_linenumber, l_partkey, {sql_id("o_orderkey", "o_orderstatus")} AS order_id
    FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey""".replace(
        sql_id("o_orderkey", "o_orderstatus"), f"CASE WHEN o_orderkey IS NOT NULL THEN {sql_id('o_orderkey', 'o_orderstatus')} END"
    ),
)
def fk_join_frames(spark, sf_dir):
    """The frame form: tables that no longer come with their documents are joined on the event id."""
    from eventweft.functions.identity import row_id

    parents = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'")
    keyed = parents.select(
        F.col("o_orderkey").alias("source_id"), row_id([F.col("o_orderkey"), F.col("o_orderstatus")], F.col("o_orderkey")).alias("id")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("source_id"), "l_linenumber", "l_partkey", F.lit(None).cast("string").alias("order_id")
    )
    return R.resolve_parent(lines, keyed, _ORDER_FK)


@query(
    "fk_missing_parent",
    "SELECT l_orderkey AS source_id, l_linenumber, l_partkey, CAST(NULL AS VARCHAR) AS order_id FROM lineitem",
)
def fk_missing_parent(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("source_id"), "l_linenumber", "l_partkey")
    return R.resolve_parent(lines, None, _ORDER_FK)


@query(
    "link_event_scope",
    f"""{with_parts(EVENTS, CUSTOMERS, PURCHASES, REFERENCES)}
    SELECT {sql_id("pu.id", "re.id")} AS id, pu.id AS purchase_id, re.id AS reference_id, pu.source_id
    FROM pu JOIN re ON pu.source_id = re.source_id WHERE pu.customer_id IS NOT NULL AND re.number IS NOT NULL""",
)
def link_event_scope(spark, sf_dir):
    rows = open_batch(order_events(spark, sf_dir), M.ORDERS).all_rows("purchaseReferenceLink")
    return rows.select("id", "purchase_id", "reference_id", "source_id")


@query(
    "link_path_scope",
    f"""{with_parts(EVENTS, ITEMS, CHARGES)}
    SELECT {sql_id("item_id", "id")} AS id, item_id, id AS charge_id, source_id, {sql_stamp("received_at")} AS received_at FROM ch""",
)
def link_path_scope(spark, sf_dir):
    """Charges pair with the item they stand below, not with every item of the order."""
    rows = open_batch(order_events(spark, sf_dir), M.ORDERS).all_rows("itemChargeLink")
    return rows.select("id", "item_id", "charge_id", "source_id", stamp("received_at").alias("received_at"))


_NATION_LINK = Link("customerNationLink", "customer", "nation", "customer_id", "nation_id")


@query(
    "link_identity",
    f"""WITH c AS (SELECT {sql_id("c_custkey", "c_name")} AS cid, c_nationkey FROM customer),
    n AS (SELECT {sql_id("n_nationkey", "n_name")} AS nid, n_nationkey FROM nation)
    SELECT {sql_id("cid", "nid")} AS id, cid AS customer_id, nid AS nation_id, CAST(n_nationkey AS BIGINT) AS source_id
    FROM c JOIN n ON c_nationkey = n_nationkey""",
)
def link_identity(spark, sf_dir):
    """The frame form of a link, with its identity made of both foreign keys."""
    from eventweft.functions.identity import row_id

    def keyed(name: str, key: str, on: str):
        k = F.col(key)
        return table(spark, sf_dir, name).select(
            F.col(on).cast("bigint").alias("source_id"),
            row_id([k, F.col(key.replace("custkey", "name").replace("nationkey", "name"))], k).alias("id"),
            F.lit("2002-01-01").cast("timestamp").alias("received_at"),
        )

    pairs = R.link_frames(keyed("customer", "c_custkey", "c_nationkey"), keyed("nation", "n_nationkey", "n_nationkey"), _NATION_LINK)
    return pairs.select("id", "customer_id", "nation_id", "source_id")

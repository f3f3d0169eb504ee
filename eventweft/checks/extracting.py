"""Paths, rows out of documents, and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventweft.checks.registry import (
    CHARGES, EVENTS, ITEMS, REFERENCES, day, query, sql_day, sql_stamp, stamp, with_parts,
)
from eventweft.functions import paths
from eventweft.models import orders as M
from eventweft.operators import extract as E
from eventweft.operators import quality as Q
from eventweft.plans import shred as S
from eventweft.plans.run import open_batch
from eventweft.sources import corpus
from eventweft.sources.corpus import damaged, order_events, part_events
from eventweft.spec import Column, Entity, Source


def documents(spark, sf_dir, *reads: str):
    """Order events with a document holding what the paths read."""
    return paths.with_document(order_events(spark, sf_dir), "raw", paths.shape(reads))


@query(
    "path_scalar",
    f"""{with_parts(EVENTS)}
    SELECT source_id AS id, event_name, '1.0' AS version, CASE WHEN kind < 3 THEN n_name END AS nation,
           CASE WHEN kind < 3 AND o_orderkey % 7 <> 0 THEN o_orderpriority END AS priority FROM ev""",
)
def path_scalar(spark, sf_dir):
    reads = ("eventInfo.name", "eventInfo.version", "order.customer.nation.name", "order.placed.priority")
    doc = documents(spark, sf_dir, *reads)
    names = ("event_name", "version", "nation", "priority")
    return doc.select("id", *[paths.scalar("doc", p).alias(n) for p, n in zip(reads, names)])


@query(
    "path_all",
    f"""{with_parts(EVENTS, REFERENCES)}
    SELECT source_id AS id, count(*) AS n_sources, count(number) AS n_numbers,
           string_agg(source, ',' ORDER BY CASE source WHEN 'web' THEN 1 WHEN 'desk' THEN 2 ELSE 3 END) AS sources
    FROM re GROUP BY source_id""",
)
def path_all(spark, sf_dir):
    doc = documents(spark, sf_dir, "order.refs[].number", "order.refs[].source")
    sources, numbers = (paths.every("doc", f"order.refs[].{k}") for k in ("source", "number"))
    return doc.select(
        "id",
        F.size(sources).cast("bigint").alias("n_sources"),
        F.coalesce(F.size(numbers), F.lit(0)).cast("bigint").alias("n_numbers"),
        F.concat_ws(",", sources).alias("sources"),
    ).filter("n_sources > 0")


@query(
    "path_index",
    f"""{with_parts(EVENTS)}
    SELECT source_id AS id, 'R' || o_orderkey AS first_number, o_orderstatus AS second_status, CAST(NULL AS VARCHAR) AS tenth_status
    FROM ev WHERE kind < 3""",
)
def path_index(spark, sf_dir):
    reads = ("order.refs[0].number", "order.statuses[1].code", "order.statuses[9].code")
    doc = documents(spark, sf_dir, *reads).filter("event_name <> 'orderCancel'")
    names = ("first_number", "second_status", "tenth_status")
    return doc.select("id", *[paths.scalar("doc", p).alias(n) for p, n in zip(reads, names)])


@query(
    "path_nested",
    f"""{with_parts(EVENTS, ITEMS, CHARGES)}
    SELECT it.source_id AS id, CAST(count(*) AS BIGINT) AS n_flags, string_agg(l_returnflag, '' ORDER BY ord) AS flags,
           (SELECT count(*) FROM ch WHERE ch.source_id = it.source_id) AS n_charges
    FROM it GROUP BY it.source_id""",
)
def path_nested(spark, sf_dir):
    reads = ("order.items[].charges[].kind", "order.items[].ship.flags[0]")
    doc = documents(spark, sf_dir, *reads)
    charges, flags = (paths.every("doc", p) for p in reads)
    return doc.select(
        "id",
        F.size(flags).cast("bigint").alias("n_flags"),
        F.concat_ws("", flags).alias("flags"),
        F.coalesce(F.size(charges), F.lit(0)).cast("bigint").alias("n_charges"),
    ).filter("n_flags > 0")


@query(
    "malformed_json",
    f"""{with_parts(EVENTS)}
    SELECT event_name, count(*) AS n_events, count_if(o_orderkey % 13 < 3 OR o_orderkey % 17 < 8) AS n_malformed FROM ev GROUP BY event_name""",
)
def malformed_json(spark, sf_dir):
    """Text cut off, and text that goes on after the document as members, documents, the end of an array
    or a forged check, is no document."""
    events = damaged(order_events(spark, sf_dir))
    ends = (', "b":"2"', ', "order":{"customer":{"custKey":9}}', ',"_whole":{"a":"2"}', " trailing", '{"a":"2"}', ',{"a":"2"}', "],[1", ',{"_check":1}')
    tail = F.get(F.array(*[F.lit(t) for t in ends]), (F.floor(F.col("id") / 10) % 17).cast("int"))
    events = events.withColumn("raw", F.concat("raw", F.coalesce(tail, F.lit(""))))
    events = S.working_events(events, M.ORDERS, ["customer"])
    raw_names = F.when(F.col("source_id") % 10 == 2, "orderModify").otherwise(F.col("event_name"))
    return events.groupBy(raw_names.alias("event_name")).agg(
        F.count(F.lit(1)).alias("n_events"), F.count_if(F.col("doc").isNull()).alias("n_malformed")
    )


@query(
    "extract_single",
    f"""{with_parts(EVENTS)}
    SELECT source_id, {sql_stamp("received_at")} AS received_at, c_custkey AS custkey, c_name AS name,
           CASE WHEN kind < 3 THEN c_mktsegment END AS segment, CASE WHEN kind < 3 THEN c_acctbal > 0 END AS vip,
           CASE WHEN kind < 3 THEN n_name END AS nation_name FROM ev""",
)
def extract_single(spark, sf_dir):
    events = S.working_events(order_events(spark, sf_dir), M.ORDERS, ["customer"])
    rows = E.with_provenance(E.extract(events, M.CUSTOMER), M.CUSTOMER)
    return rows.select(
        "source_id", stamp("received_at").alias("received_at"), F.col("custKey").alias("custkey"),
        "name", "segment", "vip", "nation_name",
    )


EXTRACT_ARRAY_SQL = f"""{with_parts(EVENTS, ITEMS)}
    SELECT source_id, CAST(ord AS BIGINT) AS ord, l_orderkey AS orderkey, CAST(l_linenumber AS BIGINT) AS line, l_partkey AS partkey,
           l_suppkey AS suppkey, CAST(l_quantity AS BIGINT) AS qty, CAST(price AS DOUBLE) AS price,
           {sql_day("l_shipdate")} AS ship_date, l_returnflag AS return_flag FROM it"""


@query("extract_array", EXTRACT_ARRAY_SQL)
def extract_array(spark, sf_dir):
    """The line item table rebuilt from nested order events."""
    events = S.working_events(order_events(spark, sf_dir), M.ORDERS, ["item"])
    return E.extract(events, M.ITEM).select(
        "source_id",
        F.get(E.ORD, F.lit(0)).cast("bigint").alias("ord"),
        F.col("orderKey").alias("orderkey"),
        F.col("line").cast("bigint").alias("line"),
        F.col("partKey").alias("partkey"),
        F.col("suppKey").alias("suppkey"),
        F.col("qty").cast("bigint").alias("qty"),
        F.col("price").cast("double").alias("price"),
        day("ship_date").alias("ship_date"),
        "return_flag",
    )


_ZIPPED = Entity(
    "reference",
    (Column("number"), Column("source")),
    key=("number", "source"),
    sources=(
        Source(
            "orderCreate", "", {"number": "order.refs[].number", "source": "order.refs[].source"}, align="compact"
        ),
    ),
)


@query(
    "extract_zip",
    f"""{with_parts(EVENTS, REFERENCES)},
    placed AS (SELECT *, CASE source WHEN 'web' THEN 1 WHEN 'desk' THEN 2 ELSE 3 END AS place FROM re),
    s AS (SELECT source_id, source, row_number() OVER (PARTITION BY source_id ORDER BY place) - 1 AS ord FROM placed),
    n AS (SELECT source_id, number, row_number() OVER (PARTITION BY source_id ORDER BY place) - 1 AS ord FROM placed
          WHERE number IS NOT NULL)
    SELECT s.source_id, CAST(s.ord AS BIGINT) AS ord, n.number, s.source FROM s LEFT JOIN n ON s.source_id = n.source_id AND s.ord = n.ord""",
)
def extract_zip(spark, sf_dir):
    events = paths.with_document(
        order_events(spark, sf_dir).select(
            F.col("id").alias("source_id"),
            S.canonical_name(F.col("event_name"), M.ALIASES).alias("event_name"),
            F.col("event_timestamp").alias("event_time"),
            "raw",
        ),
        "raw",
        E.model_shape([_ZIPPED]),
    )
    rows = E.extract(events, _ZIPPED)
    return rows.select("source_id", F.get(E.ORD, F.lit(0)).cast("bigint").alias("ord"), "number", "source")


_PEOPLE_AND_NATIONS = Entity(
    "party",
    (Column("name"),),
    key=("name",),
    sources=(
        Source("orderCreate", "order.customer", {"name": "order.customer.name"}),
        Source("orderCreate", "order.refs[]", {"name": "order.refs[].source"}),
        Source("orderCancel", "cancellation.customer", {"name": "cancellation.customer.name"}),
    ),
)


@query(
    "extract_multi_source",
    f"""{with_parts(EVENTS, REFERENCES)}
    SELECT source_id, c_name AS name FROM ev UNION ALL SELECT source_id, source FROM re""",
)
def extract_multi_source(spark, sf_dir):
    """Two places of one event type fill one table."""
    events = paths.with_document(
        order_events(spark, sf_dir).select(
            F.col("id").alias("source_id"),
            S.canonical_name(F.col("event_name"), M.ALIASES).alias("event_name"),
            F.col("event_timestamp").alias("event_time"),
            "raw",
        ),
        "raw",
        E.model_shape([_PEOPLE_AND_NATIONS]),
    )
    return E.extract(events, _PEOPLE_AND_NATIONS).select("source_id", "name")


@query(
    "spec_kind",
    f"""{with_parts(EVENTS)},
    spec(event, table_name, kind) AS (VALUES
      ('orderCreate', 'customer', 'single'), ('orderCancel', 'customer', 'single'), ('orderCreate', 'purchase', 'single'),
      ('orderCancel', 'purchase', 'single'), ('orderCreate', 'item', 'array'), ('orderCreate', 'charge', 'array'),
      ('orderCreate', 'reference', 'array'), ('orderCreate', 'statusChange', 'array'), ('orderCancel', 'statusChange', 'single'),
      ('partUpdate', 'product', 'single')),
    n AS (SELECT CASE kind WHEN 3 THEN 'orderCancel' ELSE 'orderCreate' END AS event, count(*) AS n_events FROM ev GROUP BY 1
          UNION ALL SELECT 'partUpdate', count(*) FROM part)
    SELECT spec.table_name, spec.kind, CAST(sum(n_events) AS BIGINT) AS n_events FROM spec JOIN n USING (event) GROUP BY ALL""",
)
def spec_kind(spark, sf_dir):
    """Events of the data by the table they feed and whether that takes one row or many."""
    events = order_events(spark, sf_dir).unionByName(part_events(spark, sf_dir))
    per_type = events.groupBy(S.canonical_name(F.col("event_name"), M.ALIASES).alias("event")).count()
    kinds = M.ORDERS.source_frame(spark).select("event", "table_name", "kind").distinct()
    return per_type.join(kinds, "event").groupBy("table_name", "kind").agg(F.sum("count").alias("n_events"))


@query(
    "event_alias",
    f"""{with_parts(EVENTS)}
    SELECT event_name, CASE kind WHEN 2 THEN 'orderCreate' ELSE event_name END AS described_as, count(*) AS n_events
    FROM ev GROUP BY ALL""",
)
def event_alias(spark, sf_dir):
    name = F.col("event_name")
    return (
        order_events(spark, sf_dir)
        .groupBy("event_name", S.canonical_name(name, M.ALIASES).alias("described_as"))
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


@query(
    "conform_schema",
    f"""{with_parts(EVENTS, REFERENCES)}
    SELECT re.id, number, source, {sql_stamp("received_at")} AS received_at, source_id, CAST(NULL AS VARCHAR) AS note FROM re""",
)
def conform_schema(spark, sf_dir):
    """A column the rows lack becomes a typed NULL, one the target lacks is left out."""
    rows = open_batch(order_events(spark, sf_dir), M.ORDERS).all_rows("reference")
    target = M.REFERENCE.schema().add("note", "string")
    return E.conform(rows, target).withColumn("received_at", stamp("received_at"))


@query(
    "provenance",
    f"""{with_parts(EVENTS)}
    SELECT event_name, source_id, {sql_stamp("received_at")} AS received_at, o_orderkey AS orderkey FROM ev""",
)
def provenance(spark, sf_dir):
    events = S.working_events(order_events(spark, sf_dir), M.ORDERS, ["purchase"])
    rows = E.with_provenance(E.extract(events, M.PURCHASE), M.PURCHASE)
    return rows.select(
        F.col("eventInfo_name").alias("event_name"), "source_id", stamp("received_at").alias("received_at"),
        F.col("orderKey").alias("orderkey"),
    )


@query(
    "predicate_compose",
    """SELECT o_orderkey, o_orderpriority FROM orders
    WHERE (o_orderpriority LIKE '%URGENT%' OR regexp_matches(o_orderpriority, '^[23]-')) AND o_totalprice > 100000
      AND NOT (o_orderstatus = 'F' OR o_orderdate IS NULL)""",
)
def predicate_compose(spark, sf_dir):
    urgent = Q.any_of([F.col("o_orderpriority").contains("URGENT"), F.col("o_orderpriority").rlike("^[23]-")])
    closed = Q.any_of([F.col("o_orderstatus") == "F", F.col("o_orderdate").isNull()])
    keep = Q.all_of([urgent, F.col("o_totalprice") > 100000, ~closed])
    return corpus.table(spark, sf_dir, "orders").filter(keep).select("o_orderkey", "o_orderpriority")


@query("distinct_types", f"{with_parts(EVENTS)} SELECT DISTINCT event_name FROM ev UNION ALL SELECT 'partUpdate' FROM part GROUP BY 1")
def distinct_types(spark, sf_dir):
    events = order_events(spark, sf_dir).unionByName(part_events(spark, sf_dir))
    return events.select("event_name").distinct()


@query(
    "route_events",
    f"""{with_parts(EVENTS, REFERENCES)}
    SELECT 'customer' AS table_name, event_name, count(*) AS n_rows FROM ev GROUP BY ALL
    UNION ALL SELECT 'reference', event_name, count(*) FROM re JOIN ev USING (source_id) GROUP BY ALL
    UNION ALL SELECT 'product', 'partUpdate', count(*) FROM part""",
)
def route_events(spark, sf_dir):
    """One scan serves every event type of every table: each event holds the rows it yields."""
    landed = order_events(spark, sf_dir).unionByName(part_events(spark, sf_dir))
    part = M.ORDERS.only("customer", "reference", "product")
    wide = S.shred(S.working_events(landed, part), part)
    original = F.when(F.col("source_id") % 10 == 2, "orderModify").otherwise(F.col("event_name"))
    sizes = F.array(
        *[
            F.struct(F.lit(t).alias("table_name"), F.coalesce(F.size(t), F.lit(0)).alias("n"))
            for t in ("customer", "reference", "product")
        ]
    )
    flat = wide.select(original.alias("event_name"), F.inline_outer(sizes))
    return flat.groupBy("table_name", "event_name").agg(F.sum("n").alias("n_rows")).filter("n_rows > 0")


@query(
    "unrouted_events",
    "SELECT event_type AS event_name, 'unknown event type' AS reason, count(*) AS n_events FROM events GROUP BY ALL",
)
def unrouted_events(spark, sf_dir):
    """Event types that no table describes are reported, not passed over."""
    stream = corpus.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        F.col("event_type").alias("event_name"),
        F.col("props").alias("raw"),
    )
    away = open_batch(stream, M.ORDERS).turned_away()
    return away.groupBy("event_name", "reason").agg(F.count(F.lit(1)).alias("n_events"))


@query(
    "union_by_name",
    f"""{with_parts(EVENTS)}
    SELECT source_id, c_name AS name, CASE WHEN kind < 3 THEN c_mktsegment END AS segment FROM ev""",
)
def union_by_name(spark, sf_dir):
    """Tables of two event types, with columns in another order and one missing, put together."""
    events = S.working_events(order_events(spark, sf_dir), M.ORDERS, ["customer"])
    made = E.extract(events.filter("event_name = 'orderCreate'"), M.CUSTOMER).select("source_id", "name", "segment")
    cancelled = E.extract(events.filter("event_name = 'orderCancel'"), M.CUSTOMER).select("name", "source_id")
    return made.unionByName(cancelled, allowMissingColumns=True)


@query(
    "scan_parquet",
    "SELECT l_returnflag AS flag, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01' GROUP BY 1",
)
def scan_parquet(spark, sf_dir):
    lines = corpus.table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return lines.groupBy(F.col("l_returnflag").alias("flag")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("qty")
    )



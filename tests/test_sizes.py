"""What moves between tasks and what is stored must grow no faster than the input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventweft.checks import QUERIES
from eventweft.functions import paths
from eventweft.models.orders import ORDERS
from eventweft.plans import shred as S
from eventweft.plans.run import open_batch
from eventweft.sources import corpus, families
from eventweft.sources import landing as L
from eventweft.streaming import ingest


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def star(spark, tmp_path):
    """Five orders, one of them without a customer, of up to three line items each."""
    day = dt.datetime(1995, 1, 1)
    tables = {
        "nation": ([(1, "FRANCE")], "n_nationkey int, n_name string"),
        "customer": ([(7, "Customer#7", 1, 10.0, "AUTO")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "orders": (
            [(k, 7 if k < 5 else 9, "F", 100.0, day, "1-URGENT") for k in range(1, 6)],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
        ),
        "lineitem": (
            [(k, 3, 4, n, 1.0, 5.0, 0.1, 0.0, "N", "O", day) for k in range(1, 4) for n in range(k)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_nested_items_are_never_dealt_again(spark, star):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(corpus.make_order_events(spark, star))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # customers meet short orders: no shuffle stands above the join with the gathered items
    above = text[: text.index("LeftOuter")]
    assert "Exchange" not in above
    assert "Exchange" not in text[text.index("collect_list") : text.rindex("collect_list")]


def test_partitions_of_documents_follow_the_tables(spark, star, monkeypatch):
    monkeypatch.setattr(corpus, "PART_BYTES", 100)
    bytes_ = sum(corpus._version(spark, star, t)[1] for t in ("orders", "lineitem"))
    assert corpus.document_parts(spark, star, "orders", "lineitem") == -(-bytes_ // 100)
    assert corpus.make_order_events(spark, star).count() == 8


def test_landing_files_are_compressed_and_read_all_the_same(spark, star, tmp_path):
    base = str(tmp_path / "landing")
    events = corpus.make_order_events(spark, star)
    L.write_landing(events, base, 10, "2024-01-30", parts=3)
    files = [r["key"] for r in L.manifest(spark, base).collect()]
    assert files and all(f.endswith(".csv.gz") for f in files)
    want = sorted((r["id"], r["raw"]) for r in events.collect())
    assert sorted((r["id"], r["raw"]) for r in L.scan_csv(spark, base + "/*/*/*/*").collect()) == want
    out = str(tmp_path / "out")
    ingest.run_available(ingest.landing_stream(spark, base), str(tmp_path / "state"), ingest.write_numbered(out))
    assert spark.read.parquet(out).agg(F.count("id")).first()[0] == len(want)


def test_a_filter_on_the_document_parses_it_once(spark):
    events = spark.createDataFrame([(1, '{"a":{"b":["x","y"]}}'), (2, '{"a":{}}')], "id long, raw string")
    held = paths.with_document(events, "raw", paths.shape(["a.b[].c", "a.d"]))
    kept = held.select("id", F.size(paths.every("doc", "a.b[].c")).alias("n"), paths.scalar("doc", "a.d").alias("d")).filter("n > 0 OR d IS NULL")
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert sorted(r["id"] for r in kept.collect()) == [1, 2]


def test_text_that_does_not_parse_is_tried_once_per_form(spark):
    raws = ["{", '{"a":1', '{""a"":""1""}', '"{""a"":""1""}"', '"{"a":"1"}"', '{"a":""}', '{"a":"1"}"', '{"a":"1"} x']
    rows = spark.createDataFrame(list(enumerate(raws)), "id long, raw string")
    sql = paths.repaired_variant_sql("raw")
    assert sql.count("try_parse_json") == 3 and " <> u THEN" in sql and "u <> `raw`" in sql
    got = {r["id"]: r["a"] for r in rows.selectExpr("id", f"try_variant_get({sql}, '$.a', 'string') AS a").collect()}
    assert got == {0: None, 1: None, 2: "1", 3: "1", 4: "1", 5: "", 6: "1", 7: None}


def test_sink_parquet_stores_the_references_of_all_orders(spark, star):
    got = {r["status"]: (r["n_rows"], r["n_folders"]) for r in QUERIES["sink_parquet"](spark, star).collect()}
    assert got == {"succeeded": (5, 1)}  # four numbers of the web, one of the store


@pytest.mark.parametrize("name", [e.name for e in ORDERS.entities])
def test_rows_get_types_and_ids_outside_lambdas_and_agree_with_the_wide_frame(spark, star, name):
    events = corpus.make_order_events(spark, star)
    batch = open_batch(events, ORDERS)
    rows = batch.all_rows(name)
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    if name != "purchase":  # which takes its parents' ids, made inside the event
        assert "sha1" not in text[text.index("Generate") :]  # ids are made above the generator, row by row
    wide = S.entity_rows(S.shred(S.working_events(events, ORDERS), ORDERS), ORDERS.entity(name))
    assert rows.columns == wide.columns and sorted(map(str, rows.collect())) == sorted(map(str, wide.collect()))
    told = open_batch(events, ORDERS, stage="documents")
    assert sorted(map(str, told.all_rows(name).collect())) == sorted(map(str, wide.collect()))


def versions(spark, star):
    """Order events, and all of them again a day later under other ids."""
    events = corpus.make_order_events(spark, star)
    later = events.withColumns({"id": F.col("id") + 1000, "event_timestamp": F.col("event_timestamp") + F.expr("INTERVAL 1 DAY")})
    return events.unionByName(later)


def test_only_the_bytes_of_both_sides_ids_of_a_link_move(spark, star):
    events = versions(spark, star)
    for link in ORDERS.links:
        rows = open_batch(events, ORDERS).succeeded(link.name)
        text = plan(rows)
        at = text.index("Exchange hashpartitioning(" + link.left_column)
        # ids of the sides are packed below the shuffle, the link's own is made above it
        assert "unhex(replace(" in text[at:] and "unhex(replace(" not in text[:at] and "sha1" in text[:at]
        wide = open_batch(events, ORDERS, stage=True).succeeded(link.name)
        assert sorted(map(str, rows.collect())) == sorted(map(str, wide.collect())) != []


@pytest.mark.parametrize("name", [e.name for e in ORDERS.entities if e.name != "product"])
def test_versions_are_told_by_the_text_of_their_id_which_is_made_once(spark, star, name):
    events = versions(spark, star)
    rows = open_batch(events, ORDERS).succeeded(name)
    text = plan(rows)
    at = text.index("Exchange hashpartitioning")
    assert "sha1" in text[:at] and (name == "purchase" or "sha1" not in text[at:])  # a purchase holds its customer's id
    wide = open_batch(events, ORDERS, stage=True).succeeded(name)
    assert sorted(map(str, rows.collect())) == sorted(map(str, wide.collect())) != []


def test_ids_alone_need_no_other_columns(spark, star):
    part, events = S.for_ids(ORDERS), versions(spark, star)
    holed = events.withColumn("raw", F.when(F.col("id") % 20 == 11, F.regexp_replace("raw", '"(name|number|partKey|at|amount)":', '"no":')).otherwise(F.col("raw")))
    batch, whole = open_batch(holed, part, stage="documents"), open_batch(holed, ORDERS, stage=True)
    read = batch.documents.schema["doc"].dataType.simpleString()
    assert "partKey" in read and "ship" not in read and "vip" not in read and "priority" not in read
    for e in ORDERS.entities:
        ids = [sorted(map(str, b.succeeded(e.name).select("id", "source_id").collect())) for b in (batch, whole)]
        assert ids[0] == ids[1] and (ids[0] or e.name == "product")


def test_counts_off_rows_agree_with_the_wide_frame(spark, star):
    events = corpus.make_order_events(spark, star)
    wide = S.shred(S.working_events(events, ORDERS), ORDERS)
    got = open_batch(events, ORDERS).counts()
    assert got.schema.simpleString() == S.counts(wide, ORDERS).schema.simpleString()
    assert sorted(got.collect()) == sorted(S.counts(wide, ORDERS).collect())
    assert open_batch(events.limit(0), ORDERS).counts().count() == 0


def test_documents_of_a_small_file_are_made_in_many_tasks(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "FRANCE")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(1,)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    parts = spark.range(0, 2500, 25).selectExpr("id + 1 AS p_partkey", "'a' AS p_name")
    parts.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(families, "PART_ROWS", 5)
    events = families.family_events(spark, str(tmp_path), "inventory")
    assert events.rdd.getNumPartitions() == 2 * 20  # two kinds of events over 100 rows, 5 to a task
    assert events.filter("event_name = 'inventoryBatch'").count() == 100

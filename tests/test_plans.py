"""Plans: what is not allowed to creep in."""

import pytest

from eventweft.models import orders as M
from eventweft.operators import dedup as D
from eventweft.operators import extract as E
from eventweft.plans import shred as S
from eventweft.plans.run import open_batch

SCHEMA = "id long, event_timestamp timestamp, event_name string, raw string"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


@pytest.mark.parametrize("name", M.ORDERS.write_order)
def test_rows_need_no_shuffle_no_join_no_python(stored, name):
    text = plan(open_batch(stored, M.ORDERS).all_rows(name))
    for unwanted in ("Exchange", "Join", "Python", "ArrowEval"):
        assert unwanted not in text
    assert "from_json" in text


def test_one_shuffle_per_table_and_few_rows_per_key_in_it(stored):
    text = plan(open_batch(stored, M.ORDERS).succeeded("customer"))
    assert text.count("Exchange hashpartitioning") == 1
    partial, final = text.rindex("WindowGroupLimit"), text.index("WindowGroupLimit")
    assert final < text.index("Exchange") < partial


def test_the_parse_reads_only_what_the_table_needs(stored):
    text = plan(E.extract(S.working_events(stored, M.ORDERS, ["reference"]), M.REFERENCE))
    assert "number" in text and "custKey" not in text and "items" not in text


def test_small_batches_leave_the_store_in_place(spark, tmp_path):
    path = str(tmp_path / "store")
    spark.range(10).selectExpr("cast(id as string) id", "id v").write.parquet(path)
    batch = spark.range(5).selectExpr("cast(id as string) id")
    text = plan(D.new_only(batch, spark.read.parquet(path)))
    store = text[text.index("BroadcastHashJoin") :]
    assert "ReadSchema: struct<id:string>" in store and "LeftSemi" in store


def test_staged_tables_load_their_own_column_only(spark, stored):
    batch = open_batch(stored, M.ORDERS, stage=True)
    text = plan(batch.all_rows("itemChargeLink"))
    schema = text[text.index("ReadSchema") :]
    assert "item:array<struct<id:" in schema
    assert "customer" not in text and "partKey" not in text and "qty" not in text

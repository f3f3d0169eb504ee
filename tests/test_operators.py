"""Extraction, quality, relations and newest versions on small frames."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from eventweft.operators import dedup as D
from eventweft.operators import extract as E
from eventweft.operators import prefix
from eventweft.operators import quality as Q
from eventweft.operators import relate as R
from eventweft.plans.run import open_batch
from eventweft.spec import Column, Entity, ForeignKey, Link, Model, Reject, Source

T0 = dt.datetime(2025, 1, 1, 12)


def landed(spark, docs):
    rows = [(i, T0 + dt.timedelta(hours=i), kind, d if isinstance(d, str) or d is None else json.dumps(d)) for i, (kind, d) in enumerate(docs)]
    return spark.createDataFrame(rows, "id long, event_timestamp timestamp, event_name string, raw string")


def one(align="element", keep_empty=False, **more):
    fields = {"t": "items[].t", "n": "items[].n", "who": "who"}
    rows_from = "items[]" if align == "element" else ""
    return Entity(
        "thing", (Column("t"), Column("n", "int"), Column("who")), ("t", "n"), (Source("e", rows_from, fields, align, keep_empty),), **more
    )


def rows(spark, entity, docs, cols=("t", "n", "who")):
    batch = open_batch(landed(spark, docs), Model((entity,)))
    return [tuple(r[c] for c in cols) for r in batch.all_rows(entity.name).orderBy("source_id", E.ORD).collect()]


DOC = {"who": "Ada", "items": [{"t": "A", "n": 1}, {"n": 2}, {"t": "D", "n": None}, {}]}


def test_rows_are_elements(spark):
    got = rows(spark, one(), [("e", DOC), ("e", {"who": "Bo", "items": []}), ("e", {}), ("other", DOC)])
    # The last element has the document's column only; such a column alone does make a row.
    assert got == [("A", 1, "Ada"), (None, 2, "Ada"), ("D", None, "Ada"), (None, None, "Ada")]


def test_compact_alignment_moves_values_up(spark):
    assert rows(spark, one("compact"), [("e", DOC)]) == [("A", 1, "Ada"), ("D", 2, None)]


def test_empty_elements_are_left_out_unless_kept(spark):
    plain = lambda keep: Entity("thing", (Column("t"),), ("t",), (Source("e", "items[]", {"t": "items[].t"}, keep_empty=keep),))
    docs = [("e", {"items": [{}, {"t": "x"}, {"t": " "}]})]
    assert rows(spark, plain(False), docs, ["t"]) == [("x",)]
    assert rows(spark, plain(True), docs, ["t"]) == [(None,), ("x",), (None,)]


def test_extract_agrees_with_the_wide_form(spark):
    from eventweft.plans import shred as S

    model = Model((one(),))
    events = S.working_events(landed(spark, [("e", DOC)]), model)
    got = [tuple(r) for r in E.extract(events, one()).orderBy(E.ORD).select("t", "n", "who").collect()]
    assert got == rows(spark, one(), [("e", DOC)])


def test_a_path_that_leaves_its_rows_is_refused(spark):
    bad = Entity("x", (Column("a"),), ("a",), (Source("e", "items[]", {"a": "others[].a"}),))
    with pytest.raises(ValueError):
        rows(spark, bad, [("e", {})], ["a"])


def test_events_that_yield_nothing_are_told(spark):
    docs = [("e", "{broken"), (None, {}), ("strange", {}), ("e", None), ("e", {})]
    got = open_batch(landed(spark, docs), Model((one(),))).turned_away().orderBy("source_id").collect()
    assert [(r["source_id"], r["reason"]) for r in got] == [(0, "malformed document"), (1, "no event type"), (2, "unknown event type")]


def test_conform(spark):
    frame = spark.createDataFrame([("1", "x")], "b string, extra string")
    from pyspark.sql import types as T

    target = T.StructType([T.StructField("a", T.DateType()), T.StructField("b", T.IntegerType())])
    got = E.conform(frame, target)
    assert got.schema["a"].dataType == T.DateType() and [tuple(r) for r in got.collect()] == [(None, 1)]


# Quality


def test_every_reason_is_given_and_nothing_is_lost(spark):
    entity = Entity(
        "t",
        (Column("name", required=True), Column("d", "date", True), Column("n", "int", True)),
        ("name",),
        (Source("e", "", {"name": "name", "d": "d", "n": "n"}),),
        rejects=(Reject("name", "test"),),
    )
    docs = [("e", {"name": "ok", "d": "2025-01-05", "n": 1}), ("e", {"name": "A TeSt", "d": "soon", "n": 1}), ("e", {"n": 3000000000, "d": "x"})]
    batch = open_batch(landed(spark, docs), Model((entity,)))
    got = {r["source_id"]: r[Q.REASONS] for r in batch.all_rows("t").collect()}
    assert got == {0: [], 1: ["null:d", "rejected:name"], 2: ["null:name", "null:d", "null:n"]}
    assert batch.succeeded("t").count() + batch.failed("t").count() == 3
    assert [tuple(r) for r in batch.counts().collect()] == [("t", 3, 1, 2)]


def test_failures_sharing_an_id_all_stay(spark):
    entity = Entity("t", (Column("a"), Column("b", required=True)), ("a",), (Source("e", "", {"a": "a", "b": "b"}),))
    batch = open_batch(landed(spark, [("e", {"a": 1}), ("e", {"a": 1})]), Model((entity,)))
    assert batch.failed("t").count() == 2


def test_null_guard(spark):
    frame = spark.createDataFrame([(1, None), (None, "{}"), (2, "x")], "id long, raw string")
    assert sorted(tuple(r) for r in Q.null_guard(frame).collect()) == [(1, "{}"), (2, "x")]


def test_not_finite(spark):
    frame = spark.createDataFrame([(1.0,), (float("nan"),), (float("-inf"),), (None,)], "v double")
    got = frame.select(F.size(Q.reasons(F.col, finite=["v"]))).collect()
    assert [r[0] for r in got] == [0, 1, 1, 0]


# Relations


def family(multi="fanout", scope="event", required=True):
    parent = Entity("parent", (Column("p", required=True),), ("p",), (Source("e", "ps[]", {"p": "ps[].p"}),), rejects=(Reject("p", "bad"),))
    child = Entity("child", (Column("c"), Column("parent_id", required=required)), ("c", "parent_id"), (Source("e", "", {"c": "c"}),))
    toy = Entity("toy", (Column("t"),), ("t",), (Source("e", "ps[].ts[]", {"t": "ps[].ts[].t"}),))
    return Model(
        (child, parent, toy), (ForeignKey("child", "parent", "parent_id", multi),), (Link("own", "parent", "toy", "parent_id", "toy_id", scope),)
    )


FAMILY = {"c": "kid", "ps": [{"p": "x", "ts": [{"t": 1}, {"t": 2}]}, {"p": "y", "ts": [{"t": 3}]}, {"p": "bad", "ts": [{"t": 4}]}]}


@pytest.mark.parametrize("multi, want", [("fanout", (2, 0)), ("first", (1, 0)), ("error", (0, 1))])
def test_several_parents(spark, multi, want):
    batch = open_batch(landed(spark, [("e", FAMILY)]), family(multi))
    assert (batch.lookup("child").count(), batch.failed("child").count()) == want
    if multi == "error":
        assert "several parents:parent_id" in batch.failed("child").first()[Q.REASONS]


def test_missing_and_rejected_parents(spark):
    docs = [("e", {"c": 1}), ("e", {"c": 2, "ps": [{"p": "bad"}]})]
    batch = open_batch(landed(spark, docs), family())
    assert batch.lookup("child").count() == 0
    assert {tuple(r[Q.REASONS]) for r in batch.failed("child").collect()} == {("null:parent_id",)}
    assert open_batch(landed(spark, docs), family(required=False)).lookup("child").count() == 2


@pytest.mark.parametrize("scope, want", [("event", 2 * 4), ("path", 3)])
def test_link_scopes(spark, scope, want):
    batch = open_batch(landed(spark, [("e", FAMILY)]), family(scope=scope))
    links = batch.succeeded("own")
    assert links.count() == want
    ids = {r["id"] for r in batch.lookup("parent").collect()}
    assert {r["parent_id"] for r in links.collect()} == ids


def test_cascade_takes_the_whole_event(spark):
    from dataclasses import replace

    docs = [("e", FAMILY), ("e", {"c": 1, "ps": [{"p": "fine", "ts": [{"t": 1}]}]})]
    counts = {r["table_name"]: (r["n_valid"], r["n_failed"]) for r in open_batch(landed(spark, docs), replace(family(), cascade=True)).counts().collect()}
    assert counts == {"parent": (1, 3), "child": (1, 2), "toy": (1, 4)}


@pytest.mark.parametrize("scope", ["event", "path"])
@pytest.mark.parametrize("cascade", [False, True])
@pytest.mark.parametrize("stage", [False, "documents"])
def test_links_and_counts_off_documents_agree_with_the_wide_form(spark, scope, cascade, stage):
    from dataclasses import replace

    from eventweft.plans import shred as S

    model = replace(family(scope=scope), cascade=cascade)
    model = replace(model, links=(*model.links, Link("kin", "child", "parent", "child_id", "parent_id")))
    docs = [("e", FAMILY), ("e", {"c": 1, "ps": [{"p": "fine", "ts": [{"t": 1}, {}]}]}), ("e", {"c": 2}), ("e", {"ps": [{"ts": [{"t": 1}]}]}), ("e", None), ("x", FAMILY)]
    events = landed(spark, docs)
    wide = S.shred(S.working_events(events, model), model)
    batch = open_batch(events, model, stage=stage)
    slim = open_batch(events, S.for_links(model), stage=stage)
    key = lambda f: sorted((r["id"], r["source_id"], r["received_at"]) for r in f.collect())
    for link in model.links:
        want = key(S.link_rows(wide, link, model))
        assert want and key(batch.all_rows(link.name)) == want == key(slim.all_rows(link.name))
    count = lambda f: sorted(tuple(r[c] for c in ("table_name", "n_rows", "n_valid", "n_failed")) for r in f.collect())
    assert count(batch.counts()) == count(S.counts(wide, model))
    for e in model.entities:
        want = sorted((r["id"], tuple(r[Q.REASONS])) for r in S.entity_rows(wide, e).collect())
        assert sorted((r["id"], tuple(r[Q.REASONS])) for r in batch.all_rows(e.name).collect()) == want


def test_values_of_a_link_are_made_once(spark):
    plan = open_batch(landed(spark, [("e", FAMILY)]), family()).succeeded("own")._jdf.queryExecution().executedPlan().toString()
    # no filter was moved below what makes the ids, where it would make them again
    assert all("sha1" not in line for line in plan.splitlines() if "Filter" in line)


def test_frame_form_agrees_with_the_arrays_form(spark):
    batch = open_batch(landed(spark, [("e", FAMILY), ("e", {"c": 2})]), family())
    parents = batch.lookup("parent")
    bare = spark.createDataFrame([(0, "kid"), (1, "2")], "source_id long, c string").withColumn("parent_id", F.lit(None).cast("string"))
    got = R.resolve_parent(bare, parents, ForeignKey("child", "parent", "parent_id"))
    assert sorted((r["source_id"], r["parent_id"] is None) for r in got.collect()) == [(0, False), (0, False), (1, True)]
    first = R.resolve_parent(bare, parents, ForeignKey("child", "parent", "parent_id", "first"))
    assert first.count() == 2
    clash = R.resolve_parent(bare, parents, ForeignKey("child", "parent", "parent_id", "error")).filter("source_id = 0").first()
    assert clash["parent_id"] is None and clash[R.AMBIGUOUS]
    link = batch.model.table("own")
    frames = R.link_frames(parents, batch.lookup("toy"), link)
    assert {r["id"] for r in frames.collect()} == {r["id"] for r in batch.succeeded("own").collect()}


# Newest versions, new rows, running totals


def versions(spark, n=3000):
    rnd = random.Random(5)
    # One key holds a third of the rows.
    data = [("hot" if i % 3 == 0 else f"k{rnd.randrange(40)}", rnd.randrange(50), i) for i in range(n)]
    return data, spark.createDataFrame(data, "id string, at int, seq int").repartition(7)


def test_latest_is_order_independent_and_idempotent(spark):
    data, frame = versions(spark)
    want = {}
    for k, at, seq in data:
        want[k] = max(want.get(k, (-1, -1)), (at, seq))
    latest = D.latest_per_key(frame, ["id"], ["at", "seq"])
    as_dict = lambda f: {r["id"]: (r["at"], r["seq"]) for r in f.collect()}
    assert as_dict(latest) == want
    assert as_dict(D.latest_per_key(latest, ["id"], ["at", "seq"])) == want


def test_rows_without_time_come_last(spark):
    frame = spark.createDataFrame([("a", None, 1), ("a", 5, 2)], "id string, at int, seq int")
    assert D.latest_per_key(frame, ["id"], ["at", "seq"]).first()["seq"] == 2
    assert [r["seq"] for r in D.newest_first(frame, "at", "seq").collect()] == [2, 1]


def test_new_only(spark):
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "id string, v int")
    stored = spark.createDataFrame([("b",), ("c",)], "id string")
    fresh = D.new_only(batch, stored)
    assert [tuple(r) for r in fresh.collect()] == [("a", 1)]
    assert D.new_only(fresh, batch).count() == 0


def test_running_total(spark):
    rnd = random.Random(3)
    data = [(rnd.choice([7, rnd.randrange(10_000)]), i, rnd.randrange(9)) for i in range(5000)]
    frame = spark.createDataFrame(data, "a int, b int, v int").repartition(5)
    got = {(r["a"], r["b"]): r["s"] for r in prefix.running_total(frame, ["a", "b"], "v", "s").collect()}
    total, want = 0, {}
    for a, b, v in sorted(data):
        total += v
        want[(a, b)] = total
    assert got == want


def test_running_total_of_nothing(spark):
    assert prefix.running_total(spark.createDataFrame([], "a int, v int"), ["a"], "v", "s").count() == 0


# Descriptions


def test_write_order_puts_parents_first():
    assert family().write_order == ["parent", "toy", "child", "own"]


def test_circles_and_unknown_names_are_refused():
    a = Entity("a", (Column("b_id"),), (), ())
    b = Entity("b", (Column("a_id"),), (), ())
    with pytest.raises(ValueError):
        Model((a, b), (ForeignKey("a", "b", "b_id"), ForeignKey("b", "a", "a_id")))
    with pytest.raises(KeyError):
        Model((a,), (ForeignKey("a", "nowhere", "b_id"),))
    with pytest.raises(ValueError):
        Model((a, b), (ForeignKey("a", "b", "no_column"),))
    with pytest.raises(ValueError):
        Model((a, a))


def test_only_keeps_what_a_table_rests_on():
    part = family().only("own")
    assert {e.name for e in part.entities} == {"parent", "toy"} and not part.foreign_keys
    assert {e.name for e in family().only("child").entities} == {"parent", "child"}


def test_validate_names_gaps():
    e = Entity("t", (Column("a", required=True), Column("b")), ("a", "zz", "b"), (Source("x", "", {"b": "b", "q": "q"}),))
    notes = "\n".join(Model((e,)).validate())
    for part in ("zz is not in the table", "q is not in the table", "a is never filled", "key column a is not mapped"):
        assert part in notes

"""Column functions on literal cases."""

import datetime as dt
import decimal
import json
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventweft.functions import coerce as C
from eventweft.functions import identity as I
from eventweft.functions import paths as P
from eventweft.functions import text as X


def apply(spark, texts, fn):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in rows.select("i", fn(F.col("t")).alias("v")).orderBy("i").collect()]


D = decimal.Decimal
CASES = {
    "string": [(" x ", "x"), ("", None), ("NULL", None), (" n/a ", None), ("None", None), ("true", "true"), ('{"a":1}', '{"a":1}'), (None, None)],
    "int": [("1,234", 1234), ("1.9", 1), ("-1.9", -1), ("1e3", None), ("true", None), ("false", None), ("3000000000", None), ("abc", None), (" 7 ", 7), ("n/a", None)],
    "bigint": [("3000000000", 3000000000), ("9007199254740993.7", 9007199254740993), ("-0.5", 0), ("99999999999999999999", None)],
    "decimal(12,2)": [("$1,234.5", D("1234.50")), ("1.235", D("1.24")), ("1.245", D("1.25")), ("999999999999", None), ("NaN", None), ("€5", D("5.00")), ("£ 5", D("5.00")), ("x", None)],
    "boolean": [(w, True) for w in C.TRUE_WORDS] + [(w.upper(), False) for w in C.FALSE_WORDS] + [("2", None), ("0.0", None), ("maybe", None), ("none", None)],
    "date": [(t, dt.date(2025, 1, 5)) for t in ("2025-01-05", "2025-1-5", "2025/01/05", "05-01-2025", "5/1/2025", "20250105", "2025-01-05T10:00:00Z", "2025-01-05 10:00:00.5+05:00")]
    + [("03/04/2025", dt.date(2025, 4, 3)), ("12/25/2025", dt.date(2025, 12, 25)), ("12-25-2025", dt.date(2025, 12, 25)), ("2025-13-01", None), ("soon", None), ("2025", None), ("2025-02-30", None)],
    "binary": [("6869", b"hi"), ("aGk=", b"hi"), ("hello world", b"hello world"), ("n/a", None)],
}


@pytest.mark.parametrize("kind", CASES)
def test_coerce(spark, kind):
    texts, want = zip(*CASES[kind])
    got = apply(spark, texts, lambda t: C.coerce(t, kind))
    got = [bytes(g) if isinstance(g, bytearray) else g for g in got]
    assert list(zip(texts, got)) == list(zip(texts, want))


def test_coerce_timestamp(spark):
    cases = [
        ("2025-12-29 08:07:192Z", "2025-12-29 08:07:19.200"),
        ("2025-12-29 08:07:19192Z", "2025-12-29 08:07:19.192"),
        ("2025-12-29 08:07:19", "2025-12-29 08:07:19.000"),
        ("2025-12-29T08:07:19", "2025-12-29 08:07:19.000"),
        ("2025-12-29T08:07:19.192", "2025-12-29 08:07:19.192"),
        ("2025/12/29 08:07:19", "2025-12-29 08:07:19.000"),
        ("29-12-2025 08:07:19", "2025-12-29 08:07:19.000"),
        ("12-29-2025 08:07:19", "2025-12-29 08:07:19.000"),
        ("2025-12-29T08:07:19+05:00", "2025-12-29 03:07:19.000"),
        ("2025-12-29T08:07:19Z", "2025-12-29 08:07:19.000"),
        ("1767000000", None),
        ("2025-12-29 at noon", "2025-12-29 00:00:00.000"),
        ("noon", None),
        ("", None),
        ("999999999999", None),
    ]
    texts, want = zip(*cases)
    got = apply(spark, texts, lambda t: F.date_format(C.coerce(t, "timestamp"), "yyyy-MM-dd HH:mm:ss.SSS"))
    assert list(zip(texts, got)) == list(zip(texts, want))


def test_coerce_unknown_type():
    with pytest.raises(ValueError):
        C.from_text(None, "interval")


def test_header_time_drops_the_zone(spark):
    cases = [
        ("2025-12-29 08:07:192Z", "2025-12-29 08:07:19.200"),
        ("2025-12-29T08:07:19.192+05:00", "2025-12-29 08:07:19.192"),
        ("2025-12-29 08:07:19", "2025-12-29 08:07:19.000"),
        ("later", None),
    ]
    texts, want = zip(*cases)
    got = apply(spark, texts, lambda t: F.date_format(X.header_time(t), "yyyy-MM-dd HH:mm:ss.SSS"))
    assert got == list(want)


def test_repair_raw(spark):
    sound, empty = '{"a":"x","b":1}', '{"a":"","b":1}'
    doubled = lambda s: s.replace('"', '""')
    texts = [sound, empty, doubled(sound), f'"{doubled(empty)}"', '{"a":', None, "{}"]
    assert apply(spark, texts, lambda _: X.repair_raw("t")) == [sound, empty, sound, empty, '{"a":', None, "{}"]


def test_abbreviate_and_normalise(spark):
    names = ["Grand River Plus Inn", "Grand River", "Grand 1st Inn", None]
    assert apply(spark, names, X.abbreviate_name) == ["GR Plus Inn", "Grand River", "Grand 1st Inn", None]
    codes = ["InHouse", "other", None]
    assert apply(spark, codes, lambda c: X.normalise_code(c, {"inhouse": "In House"})) == ["In House", "other", None]


# Paths


def read(spark, docs, path, fn):
    rows = spark.createDataFrame([(i, json.dumps(d) if not isinstance(d, str) else d) for i, d in enumerate(docs)], "i int, raw string")
    doc = P.with_document(rows, "raw", P.shape([path]))
    return [r[1] for r in doc.select("i", fn("doc", path).alias("v")).orderBy("i").collect()]


def test_scalar_paths(spark):
    docs = [{"a": {"b": 1}}, {"a": {}}, {"a": None}, {"a": {"b": None}}, {"a": [1]}, {"a": {"b": {"c": 1}}}, {"a": {"b": True}}, "{oops"]
    assert read(spark, docs, "a.b", P.scalar) == ["1", None, None, None, None, '{"c":1}', "true", None]


def test_every_element(spark):
    docs = [{"a": [{"b": 1}, {}, {"b": None}, {"b": 2}]}, {"a": []}, {"a": {"b": 3}}, {"a": [5, {"b": 4}]}, {}, {"a": "x"}]
    assert read(spark, docs, "a[].b", P.every) == [["1", "2"], None, ["3"], ["4"], None, None]


def test_index(spark):
    docs = [{"a": ["x", "y"]}, {"a": ["x"]}, {"a": []}, {"a": [None, "z"]}]
    assert read(spark, docs, "a[1]", P.scalar) == ["y", None, None, "z"]


def test_nested_arrays_keep_document_order(spark):
    docs = [{"a": [{"b": [{"c": 1}, {"c": 2}]}, {"b": []}, {}, {"b": [{"c": 3}]}]}, {"a": [{"b": {"c": 9}}]}]
    assert read(spark, docs, "a[].b[].c", P.every) == [["1", "2", "3"], ["9"]]


def test_positions(spark):
    rows = spark.createDataFrame([('{"a":[{"b":[1,2]},{},{"b":[3]}]}',)], "raw string")
    doc = P.with_document(rows, "raw", P.shape(["a[].b[]"]))
    got = doc.select(P.nodes("doc", "a[].b[]").alias("n")).first()["n"]
    assert [(n["node"], n["ord"]) for n in got] == [("1", [0, 0]), ("2", [0, 1]), ("3", [2, 0])]


def test_a_misfit_elsewhere_loses_nothing(spark):
    """One element of the wrong kind must not void its siblings."""
    rows = spark.createDataFrame([('{"a":[1,{"b":"x"}],"c":{"d":"y"},"e":{"f":1}}',)], "raw string")
    doc = P.with_document(rows, "raw", P.shape(["a[].b", "c.d", "e"]))
    got = doc.select(P.every("doc", "a[].b"), P.scalar("doc", "c.d"), P.scalar("doc", "e")).first()
    assert tuple(got) == (["x"], "y", '{"f":1}')


def test_repeated_key_keeps_the_last(spark):
    assert read(spark, ['{"a":1,"a":2}', '{"a":1,"a":2,"z":[}'], "a", P.scalar) == ["2", None]


def test_conflicting_paths_are_refused():
    with pytest.raises(ValueError):
        P.shape(["a[].b", "a.b"])
    with pytest.raises(ValueError):
        P.shape(["a", "a.b"])
    with pytest.raises(ValueError):
        P.steps("a.b[x]")
    with pytest.raises(ValueError):
        P.scalar("x", "a[]")


# Identity


def test_uuid_equals_python(spark):
    names = ["", "a", "Zürich ☃", "x" * 300, None, "0|1"]
    want = [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) if n else None for n in names]
    assert apply(spark, names, I.uuid_v5) == want


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",)), min_size=1, max_size=40), min_size=40, max_size=40))
def test_uuid_equals_python_on_any_text(spark, names):
    assert apply(spark, names, I.uuid_v5) == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names]


def test_nulls_in_a_key(spark):
    rows = spark.createDataFrame([("a", None, "b"), ("a", "b", None), (None, None, None)], "x string, y string, z string")
    key = [F.col(c) for c in "xyz"]
    got = rows.select(I.record_hash(key).alias("h"), I.record_hash(key, "~").alias("t"), I.row_id([], F.lit(7)).alias("f")).collect()
    assert got[0]["h"] == got[1]["h"] and got[0]["t"] != got[1]["t"]
    assert len({r["f"] for r in got}) == 1


def test_text_after_the_document_makes_it_malformed(spark):
    texts = ['{"a":"1"}', ' {"a":"1"}\n', '{"a":"1"} trailing', '{"a":"1"}{"a":"2"}', '{"a":"1"},{"a":"2"}', '{"a":"1"}}', '{"a":"1"', "", None]
    texts += ['{"a":"1"}, "b":"2"', '{"a":"1"}, "a":"9"', '{"a":"1"},"_whole":{"a":"2"}', '[{"a":"1"}]', '{"a":"1"}],[1', '{"a":"1"}]', '{"a":"1"},']
    texts += ['{"a":"1"},{"_check":1}', '{"a":"1"},{"_check":1}],[{"a":"2"}', "5", "null", "[]", '{"a":"1"},null']
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw string")
    doc = P.with_document(rows, "raw", P.shape(["a"])).orderBy("i")
    assert [r["doc"]["a"] if r["doc"] else None for r in doc.collect()] == ["1", "1"] + [None] * (len(texts) - 2)
    mended = rows.orderBy("i").select(X.repair_raw("raw").alias("m")).collect()
    assert [r["m"] for r in mended] == texts


def test_a_value_that_does_not_fit_voids_nothing_else(spark):
    texts = ['{"a":"1","l":{"k":"2"}}', '{"a":"1","l":[{"k":"2"},5]}', '{"a":{"x":1},"l":[]}']
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw string")
    doc = P.with_document(rows, "raw", P.shape(["a", "l[].k"])).orderBy("i")
    found = [(r["doc"]["a"], [x and x["k"] for x in r["doc"]["l"] or []]) for r in doc.collect()]
    assert found == [("1", ["2"]), ("1", ["2", None]), ('{"x":1}', [])]


def test_lossy_parsing_is_refused(spark):
    spark.conf.set(P.PARTIAL, "true")
    try:
        with pytest.raises(ValueError, match="enablePartialResults"):
            P.with_document(spark.createDataFrame([("{}",)], "raw string"), "raw", P.shape(["a"]))
    finally:
        spark.conf.set(P.PARTIAL, "false")

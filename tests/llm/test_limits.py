"""Long headers, deep folders, empty tables: nothing is cut."""

import random

import pytest

from eventweft.llm import urls, warc

LABELS = "doc_id long, quality int, toxic int"
PAGES = "page_id long, url string, html string"


def _judged(spark, pages, marks):
    got = urls.filter_urls(spark.createDataFrame(pages, PAGES), spark.createDataFrame(marks, LABELS)).collect()
    return {r["page_id"]: r["verdict"] for r in got}


@pytest.mark.parametrize("form", ["https://h.net/{}/a/b/x", "https://h.net/a/b/{}/x", "https://h.net/a/b/c/d/e/f/g/h/i/j/k/{}/x", "https://h.net/a?a&b&c&d&e&f&g&h&i&j&k&l&m&{}"])
def test_a_telling_token_counts_wherever_it_is(spark, form):
    pages = [(i, form.format("casino" if i % 2 else "news"), None) for i in range(120)]
    got = _judged(spark, pages, [(i, 1 - i % 2, 0) for i in range(80)])
    assert got == {i: "block" if i % 2 else "allow" for i in range(120)}


def test_null_urls_repeated_rows_and_no_labels(spark):
    pages = [(1, None, None), (1, None, None), (2, "no scheme", None), (None, "https://example.org/es/x", None)]
    got = urls.filter_urls(spark.createDataFrame(pages, PAGES).selectExpr("*", "1 AS tokens", "2 AS rule"), spark.createDataFrame([], LABELS)).collect()
    assert sorted((r["page_id"] or 0, r["rule"], r["verdict"]) for r in got) == [
        (0, "example.org/es/", "block"), (1, None, "allow"), (1, None, "allow"), (2, None, "allow"),
    ]
    assert _judged(spark, [], []) == {}


def test_a_long_header_is_read_back(spark, tmp_path):
    noise = "".join(random.Random(5).choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=2 << 20))
    pages = spark.createDataFrame([(1, f"https://a.org/{noise}", "x"), (2, "https://a.org/", "y" * (3 << 20))], PAGES)
    rows = warc.read(warc.write(pages, f"file://{tmp_path}/archive")).collect()
    assert sorted((r["record_id"], r["payload_bytes"], r["digest_ok"]) for r in rows) == [
        (warc.record_name(1), 1, True), (warc.record_name(2), 3 << 20, True),
    ]

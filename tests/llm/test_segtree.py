"""Stored trees against encoding anew."""

import random

import public_tokenizers

from eventweft.llm import segtree

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
EDITS = "row long, edits array<struct<start:int,end:int,text:string>>"


def _after(text, edits):
    text = text or ""
    for e in edits or []:
        start, end, new = (e[0] or 0), (e[1] or 0), (e[2] or "")
        start = max(0, min(start, len(text)))
        end = max(start, min(end, len(text)))
        text = text[:start] + new + text[end:]
    return text


def _store(spark, texts):
    rows = [(None if i % 5 == 0 else i % 3, t, 0) for i, t in enumerate(texts)]
    return segtree.built(spark.createDataFrame(rows, "doc_id long, text string, row int"), PATH, PATTERN, ["doc_id", "text"])


def _check(store, want):
    count = segtree.encoder(PATH, PATTERN).encode_ordinary
    got = {r["row"]: (r["n_tokens"], r["n_chars"]) for r in store.totals().collect()}
    assert got == {row: (len(count(t)), len(t)) for row, t in want.items()}
    # the leaves that a tree names, in its order, are the text
    for r in store.whole().collect():
        texts = {x["id"]: x["text"] for x in r["leaves"]}
        assert len(texts) == len(r["leaves"]) and "".join(texts[i] for i in r["tree"]["ids"]) == want[r["row"]]


def test_two_generations_of_edits(spark):
    rng = random.Random(12)
    words = ["a", "the", " ", "  ", "\n", "1", "!", "'s", "é", " b", " word", "😀"]
    texts = [None, "", "x" * 3000, None, "one", "one"] + ["".join(rng.choices(words, k=rng.randint(0, 6000))) for _ in range(40)]
    store = _store(spark, texts)
    want = {r["row"]: r["kept"]["text"] or "" for r in store.whole().collect()}
    _check(store, want)
    for _ in range(2):
        edits = {}
        for row, text in want.items():
            own = []
            for _ in range(rng.choice([0, 1, 1, 3, 8])):
                start = rng.randint(-2, len(text) + 9)
                own.append((start, start + rng.choice([-1, 0, 1, 9, 1500]), "".join(rng.choices(words, k=rng.choice([0, 2, 2, 900])))))
            edits[row] = own
        first = sorted(want)[:3]
        edits[first[0]], edits[first[1]] = None, [(None, None, None), (None, 1, "q")]
        del edits[first[2]]
        store = segtree.edited(store, spark.createDataFrame(list(edits.items()), EDITS))
        want = {row: _after(text, edits.get(row)) for row, text in want.items()}
        _check(store, want)
        touched = {r["row"] for r in store.totals().collect() if r["encoded_leaves"] or r["encoded_chars"]}
        assert touched == {row for row, e in edits.items() if e}


def test_one_edit_encodes_little(spark):
    text = " ".join(["several", "words", "of", "prose"] * 5000)
    store = _store(spark, [text])
    edits = spark.createDataFrame([(store.totals().first()["row"], [(60_000, 60_005, "other")])], EDITS)
    after = segtree.edited(store, edits)
    took = after.totals().first()
    assert 0 < took["encoded_chars"] < len(text) // 50
    assert sum(len(x["text"]) for x in after.layers[-1].first()["leaves"]) == took["encoded_chars"]
    _check(after, {edits.first()["row"]: text[:60_000] + "other" + text[60_005:]})


def test_empty_tables(spark):
    empty = segtree.built(spark.createDataFrame([], "doc_id long, text string"), PATH, PATTERN, ["doc_id"])
    after = segtree.edited(empty, spark.createDataFrame([], EDITS))
    assert empty.totals().count() == after.totals().count() == 0


def test_edits_of_no_tree_are_passed_over(spark):
    after = segtree.edited(_store(spark, ["a b"]), spark.createDataFrame([(12345, [(0, 1, "c")])], EDITS))
    assert [(r["n_chars"], r["encoded_leaves"]) for r in after.totals().collect()] == [(3, 0)]


def test_the_query_counts_like_encoding_anew(spark, tmp_path):
    rows = [(1, None, None, None), (None, "", "en", "web"), (2, "word " * 900, "en", "web"), (2, "word " * 900, "en", "web"), (3, "é" * 2000, "fr", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    edits = segtree.derived_edits(*[frame[c] for c in ("text", "lang", "source")])
    count = segtree.encoder(PATH, PATTERN).encode_ordinary
    want = []
    for r in frame.select("doc_id", "text", edits.alias("edits")).collect():
        now = _after(r["text"], r["edits"])
        want.append((r["doc_id"] or 0, len(count(r["text"] or "")), len(count(now)), len(now)))
    got = [(r["doc_id"] or 0, r["before"], r["after"], r["chars_after"]) for r in segtree.op5_segtree(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)

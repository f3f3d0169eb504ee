"""Each operator beside a brute-force version, and on NULL, empty, long, repeated and clashing rows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventweft.llm import fm, hamming, lsa, pieces, pii, rules, segtree, simhash, urls, warc
from eventweft.llm.common import scratch, table

SF = "/root/testdata/sf0.001"
LABELS = "doc_id long, quality int, toxic int"
COUNT = 8


def test_pieces_match_the_library(spark, docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    rng = random.Random(1)
    texts = ["", " ", "▁▁a", "a" * 99, " " * 40 + "t", "日本語 é\x00😀", *("".join(rng.choices(["a", "th", "e", " ", "  ", "\n", "é", "1"], k=30)) for _ in range(400))]
    model = pieces.pieces(pieces.model_path())
    ids, offset = model.encode(texts)
    own = [ids[a:b].tolist() for a, b in zip(offset[:-1], offset[1:])]
    assert own == library.encode(texts, add_eos=True)
    assert model.decode(ids, offset) == [library.decode(i) for i in own]
    rows = pieces.coded(docs, pieces.model_path(), ["doc_id", "text"]).collect()
    assert len(rows) == COUNT and all(r.decoded == (r.text or "") for r in rows)


def test_links_match_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = {int(b) for b in base}
    for b in base[:12]:
        for _ in range(20):
            b = b ^ np.uint64(1 << int(rng.integers(64)))
            prints.add(int(b))
    prints = sorted(np.array(sorted(prints), np.uint64).view(np.int64).tolist())
    root = {p: p for p in prints}
    values = np.array(prints, np.int64).view(np.uint64)

    def find(x):
        return x if root[x] == x else find(root[x])

    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values ^ v) <= 2):
            a, b = find(prints[i]), find(prints[j])
            root[max(a, b)] = min(a, b)
    frame = spark.createDataFrame([(p,) for p in prints], "print long")
    for bound in (2048,):
        got = {r.node: r.root for r in simhash.components(simhash.link_prints(frame, bound)).collect()}
        assert {p: got.get(p, p) for p in prints} == {p: find(p) for p in prints}


def test_near_duplicates_edges(docs):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == COUNT
    assert {r.fingerprint for r in rows if r.doc_id in (1, None)} == {"0" * 16}
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len({r.fingerprint for r in rows})


def test_pipeline_keeps_one_of_near_copies(spark):
    import corpus_pipeline

    rng = random.Random(36)
    word = lambda: "".join(rng.choices("bcdfghklmnprstvw", k=4)) + rng.choice("aeiou")
    texts = []
    for size in (1, 4, 6, 12, 25, 60, 150, 400, 900):
        for _ in range(3):
            words = [word() for _ in range(size)]
            texts += [" ".join(words)] * 2
            for changes in {1, 2, size // 100, size // 60, size // 45, size // 30}:
                other = list(words)
                for _ in range(changes):
                    at = rng.randrange(len(other))
                    other[at : at + rng.randint(0, 1)] = [word()]
                texts.append(" ".join(other))
    line = [word() for _ in range(40)]
    texts += [" ".join([*line, *(word() for _ in range(20))]) for _ in range(12)] + [None, "", " "]
    rng.shuffle(texts)
    sets = []
    for t in texts:
        words = (t or "").split()
        sets.append({" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    near = lambda a, b: a == b or len(a & b) >= 0.8 * len(a | b) > 0
    label = list(range(len(texts)))
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if near(sets[i], sets[j])]
    assert sum(sets[i] != sets[j] for i, j in pairs) > 50
    while (again := [min(label[k] for k in (i, *(x for p in pairs if i in p for x in p))) for i in range(len(texts))]) != label:
        label = again
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = corpus_pipeline.near_duplicates(spark, frame, "")
    assert got.columns == frame.columns and sorted(r.doc_id for r in got.collect()) == sorted(set(label))


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], pii.BASE.index(s[2])))


def test_base_spans_match_the_patterns(docs):
    rng = random.Random(2)
    parts = ["1", "2", "45", "@", ".", "a", "-", "+", " ", "(", ")", "b.c", "4111111111111111", "é", "\n"]
    for _ in range(5000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 24)))
        assert pii.base_spans(text) == plain_spans(text)
    field = pii.fit(docs)
    rows = docs.select("text", pii.spans(F.col("text"), field).alias("f"), pii.masked(F.col("text"), field).alias("m")).collect()
    assert len(rows) == COUNT and all((r.m is None) == (r.text is None) for r in rows)
    assert any("<CARD>" in (r.m or "") for r in rows)


def test_field_adds_secrets_and_contacts():
    rng = random.Random(5)
    number = lambda n: "".join(rng.choices("0123456789", k=n))
    texts = [f"so token = \"{''.join(rng.choices('abcdef0123456789', k=40))}\" on" for _ in range(60)]
    texts += [f"he was at +1 ({number(3)}) 555-{number(4)} for that" for _ in range(60)]
    field = pii.train(texts)
    kinds = lambda t: [k for _, _, k in pii.all_spans(t, field)]
    assert kinds("is token = \"" + "0a1b2c3d4e" * 4 + "\" the") == ["secret"]
    assert kinds("call (499) 555-6503 for") == ["contact"]
    assert kinds("on 2024-01-02 the") == []


@pytest.mark.parametrize("rows", [[], [(0, 1, 0)], [(i % 7, i % 2, i % 2) for i in range(14)]])
def test_classifiers_edges(spark, docs, rows):
    labels = spark.createDataFrame(rows, LABELS)
    scored = rules.scored(docs, rules.fit(docs, labels, "quality", F.lit(True)), "__s").collect()
    assert len(scored) == COUNT and all(0 <= r["__s"] <= 1 for r in scored)
    model = fm.fit(docs, labels, "toxic", F.lit(True))
    got = docs.select(fm.score(F.col("text"), model).alias("s")).collect()
    assert len(got) == COUNT and all(0 <= r.s <= 1 for r in got)


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    labels = table(spark, sf, "labels")
    both = rules.op3_rules(spark, sf).filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in both]) >= 0.9
    both = fm.op7_fm(spark, sf).filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.toxic for r in both]) >= 0.85


def test_latent_axes_come_from_all_documents(spark):
    rows = [(i, f"left{i} right{i % 3} " * 12) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    block = lsa.Block.of([(0, [w.encode() for i in range(40) for w in (f"left{i}", f"right{i % 3}")])])
    weight = np.ones(len(block.vocabulary))
    sketch = lsa.sketch
    asked = lsa.latent_axes(docs, block, weight)
    # the same sums in one place, over every text
    rank = min(lsa.RANK + lsa.OVERSAMPLE, len(weight))
    test = np.random.default_rng(5).normal(size=(len(weight), rank))
    corpus = sketch(lsa.numbers([t for _, t in rows], block.vocabulary), weight, test)
    own = sketch([c for _, c in block.cases], weight, test)
    z = own + corpus * (np.linalg.norm(own) / np.linalg.norm(corpus))
    value, vector = np.linalg.eigh((test.T @ z + (test.T @ z).T) / 2)
    fine = value > value.max() * 1e-9
    want = np.linalg.svd(z @ (vector[:, fine] / np.sqrt(value[fine])), full_matrices=False)[0][:, : lsa.RANK]
    assert asked.shape == want.shape
    assert np.allclose(np.abs(asked[:, :2].T @ want[:, :2]), np.eye(2), atol=1e-2)
    assert not hasattr(lsa, "FIT_DOCS")


def test_an_early_bound_loses_no_common_subsequence():
    rng = random.Random(4)
    for _ in range(200):
        item, near = ([rng.randrange(12) for _ in range(n)] for n in (rng.randrange(1, 20), rng.randrange(40)))
        table = [[0] * (len(near) + 1) for _ in range(len(item) + 1)]
        for i, a in enumerate(item):
            for j, b in enumerate(near):
                table[i + 1][j + 1] = table[i][j] + 1 if a == b else max(table[i][j + 1], table[i + 1][j])
        places = lsa.places_of(item)
        common = [places[w] for w in near if w in places]
        assert lsa.common_subsequence(len(item), common) == table[-1][-1]


def test_benchmark_passages_are_found(spark, docs):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("bcdfghklmnprstvw", k=4)) + rng.choice("aeiou")
    items = [(i, " ".join(word() for _ in range(30))) for i in range(5)]
    noise = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, noise(60) + " " + items[i][1] + " " + noise(60)) for i in range(5)] + [(9, noise(200)), (10, None), (11, "")]
    near = items[0][1].split()
    near[3:6] = [word(), word(), word()]
    rows.append((12, noise(30) + " " + " ".join(near) + " " + noise(30)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([*items, (7, None), (8, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in lsa.contaminated(frame, benchmark).collect()}
    assert got == {*((i, i) for i in range(5)), (12, 0)}
    assert {r.doc_id for r in lsa.clean(frame, benchmark).collect()} == {9, 10, 11}
    assert lsa.contaminated(docs, benchmark.limit(0)).count() == 0
    assert lsa.clean(docs, benchmark).columns == docs.columns


def test_an_item_of_a_third_of_all_rows_is_found(spark):
    rng = random.Random(16)
    word = lambda: "".join(rng.choices("bcdfghklmnprstvw", k=4)) + rng.choice("aeiou")
    noise = lambda n: " ".join(word() for _ in range(n))
    items = [(0, noise(30)), (1, noise(30))]
    rare = items[1][1].split()
    rows = [(i, noise(60)) for i in range(80)]
    # between single words of another item, which are rare and so weigh more than all of the frequent item
    rows += [(100 + i, f"{noise(20)} {rare[i % 30]} {items[0][1]} {rare[-i % 30]} {noise(20)}") for i in range(39)]
    near = items[0][1].split()
    near[3], near[12], near[20] = word(), word(), word()
    rows += [(200, noise(9) + " " + " ".join(near))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = {(i, 0) for i, _ in rows if i >= 100}
    assert {(r.doc_id, r.item_id) for r in lsa.contaminated(frame, benchmark).collect()} == want
    assert {r.doc_id for r in lsa.clean(frame, benchmark).collect()} == set(range(80))


def test_long_items_and_later_places(spark):
    rng = random.Random(26)
    word = lambda: "".join(rng.choices("bcdfghklmnprstvw", k=4)) + rng.choice("aeiou")
    noise = lambda n: " ".join(word() for _ in range(n))
    long, short = noise(130), noise(50)
    words = short.split()
    # a part of 0.6 without the answer, then one of 0.58 with it
    twice = " ".join([noise(40), *words[:30], noise(200), *words[16:20], *words[25:50], noise(40)])
    rows = [(1, " ".join([noise(40), *long.split()[:90], noise(40)])), (2, twice), (3, noise(300))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, long), (2, short)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in lsa.contaminated(frame, benchmark).collect()}
    assert got == {(1, 1), (2, 2)}


def test_edited_counts_match_encoding_anew():
    import public_tokenizers

    code = segtree.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).encode_ordinary
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choices(["a", "the", " ", "  ", "\n", "1", "!", "'s", "é", " b", " word"], k=rng.randint(0, 900)))
        tree = segtree.Tree.of(text, lambda p: len(code(p)))
        for _ in range(4):
            a = rng.randint(0, len(text) + 2)
            b, new = a + rng.choice([0, 1, 9]), "".join(rng.choices([" ", "a", "\n", "'s"], k=3))
            tree.edit(a, b, new)
            text = text[:a] + new + text[max(min(a, len(text)), b):]
            assert tree.total == len(code(text)) and tree.length == len(text)


def test_archives_round_trip(spark):
    rows = [(1, "http://a/\r\nx", "same"), (2, None, "same"), (3, "http://c", None), (4, "u", ""), (None, "n", "same"), (5, "l", "é" * 70_000), (5, "l", "é" * 70_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc.write(pages, scratch(spark, "warc-test"))
    for split in (50, 1000, 1 << 25):
        got = warc.read(manifest, split, payload=True).collect()
        assert len(got) == len(rows) and all(r.digest_ok is not False for r in got)
        by = {}
        for r in got:
            by.setdefault(r.record_id, []).append((r.record_type, r.payload_bytes, r.refers_to))
        assert by["<urn:x-page:1>"] == [("revisit", 4, "<urn:x-page:2>")] == by["<urn:x-page:none>"]
        assert by["<urn:x-page:2>"] == [("response", 4, None)]
        assert by["<urn:x-page:3>"] == [("revisit", 0, "<urn:x-page:4>")]
        assert by["<urn:x-page:5>"] == [("response", 140_000, None)] * 2
    assert warc.read(warc.write(pages.limit(0), scratch(spark, "warc-test"))).count() == 0


def test_url_rules(spark):
    rows = [(1, "http://A.example.ORG/es/x"), (2, "https://example.org/en/12?q"), (3, "x.com/fr/"), (4, "ftp://b.com/de/a#z"), (5, None), (6, "http://com"), (7, "http://notexample.org/es/")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(pages, spark.createDataFrame([], LABELS)).collect()}
    assert got[1] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[2][2:] == ("example.org/en/1", "block") and got[4][2:] == ("com/de/", "block")
    assert got[3][:3] == ("", "", None) == got[5][:3] and got[6][2] is None and got[7][2:] == ("org/", "allow")


def test_top_k_matches_all_distances(spark):
    rng = np.random.default_rng(8)
    vectors = [(i, rng.normal(size=64).tolist()) for i in range(150)] + [(200, None), (300, [1.0])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    bits = {i: np.array(v) > 0 for i, v in vectors[:150]}
    for probes in (hamming.PROBES, 1):
        got = hamming.top_k(frame, F.col("vec_id") % 100 == 0, 5, probes).collect()
        want = {(q, n + 1, i, d) for q in (0, 100) for n, (d, i) in enumerate(sorted((int((bits[q] != b).sum()), i) for i, b in bits.items())[:5])}
        assert {(r.query, r["rank"], r.vec_id, r.distance) for r in got} == want
    assert hamming.top_k(frame.limit(0), F.lit(True)).count() == 0


def test_top_k_over_shards_blocks_copies_and_ids_of_several_vectors(spark):
    rng = np.random.default_rng(9)
    for dims in (5, 64, 130):
        rows = [(i % 120, rng.normal(size=dims).tolist()) for i in range(150)]
        rows += [(1000 + i, rows[0][1]) for i in range(30)] + rows[:3]
        bits = {(i, tuple(np.array(v) > 0)) for i, v in rows}
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        want = set()
        for q in {i for i, _ in bits if i % 100 == 0}:
            pairs = sorted((sum(x != y for x, y in zip(a, b)), i) for p, a in bits if p == q for i, b in bits)
            want |= {(q, n + 1, i, d) for n, (d, i) in enumerate(pairs[:5])}
        for probes, shard, block in ((hamming.PROBES, hamming.SHARD, hamming.BLOCK), (hamming.PROBES, 20, 1), (1, 20, 1)):
            got = hamming.top_k(frame, F.col("vec_id") % 100 == 0, 5, probes, shard, block).collect()
            assert {(r.query, r["rank"], r.vec_id, r.distance) for r in got} == want


def test_near_copies_of_larger_texts(spark):
    """Near copies, many copies of one text, and a template that unlike documents share: none of these is linked."""
    from eventweft.llm import copies

    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    template = [word() for _ in range(120)]
    rows = [(i, " ".join(template + [word() for _ in range(40)]), "t") for i in range(120)]
    keep = set(range(120))
    for i in range(40):
        own = [word() for _ in range(300)]
        other = list(own)
        for _ in range(i % 5 + 1):
            other[rng.randrange(300)] = word()
        rows += [(1000 + 2 * i, " ".join(own), "n"), (1001 + 2 * i, " ".join(other), "n")]
        keep.add(1000 + 2 * i)
    rows += [(5000 - i, " ".join(template), "c") for i in range(300)] + [(None, " ".join(template) + " end", "c")]
    keep.add(4701)
    frame = spark.createDataFrame(rows, "doc_id long, text string, sketch string").repartition(6)
    kept = copies.one_of_each(frame)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == keep
    assert copies.one_of_each(frame.limit(0)).count() == 0


def test_one_long_vector_leaves_the_others(spark):
    rng = random.Random(3)
    rows = [(i, [rng.random() - 0.5 for _ in range(64)]) for i in range(200)] + [(500, [0.5] * 65), (None, [0.5] * 64), (600, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = hamming.top_k(frame, F.col("vec_id") % 100 == 0, 10).collect()
    assert len(got) == 20 and {r["query"] for r in got} == {0, 100}

"""Spelling variants beside a brute-force comparison of all words."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from eventweft.llm import variants


def near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def family(rng, letters, size, count):
    out = {"".join(rng.choices(letters, k=rng.randint(5, size))) for _ in range(count)}
    for word in list(out):
        for _ in range(2):
            at = rng.randrange(len(word) + 1)
            out.add(word[:at] + rng.choice([rng.choice(letters), ""]) + word[at + rng.randint(0, 1) :])
    return sorted(w for w in out if len(w) >= 5)


def test_places_equal_brute_force():
    rng = random.Random(1)
    for letters, size, count in (("ab", 7, 60), ("abcdé", 9, 150), ("aàÿ", 6, 200), ("ab", 130, 40)):
        words = family(rng, letters, size, count)
        x, y = variants.near_places(words)
        want = {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if near(words[i], words[j])}
        assert set(zip(x.tolist(), y.tolist())) == want


def test_pairs_equal_brute_force_whatever_the_cell_bound(spark):
    rng = random.Random(2)
    words = family(rng, "abc", 8, 150) + ["q" * 3000, "q" * 3001, "r" * 700]
    words += ["samehead" + w for w in family(rng, "xy", 6, 60)]
    frame = spark.createDataFrame([(w, i + 3) for i, w in enumerate(words)], "word string, n long")
    want = {(a, b) for a in words for b in words if near(a, b)}
    for bound in (2048, 4):
        got = [(r.word, r.near) for r in variants.near_words(frame, bound).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    sizes = variants.cells(frame, 4).groupBy("cell").count().agg(F.max("count")).first()[0]
    assert sizes <= 4 + 3 * 3 * 3  # what can't be parted has one open letter, two in the longer words


def brute(rows):
    seen = Counter()
    for doc_id, text, *_ in rows:
        lower = str.maketrans(variants.UPPER, variants.LOWER)
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(lower)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    words = {w: n for w, n in seen.items() if len(w) >= 5 and n >= 3}
    out = {}
    for w, n in words.items():
        others = [x for x in words if near(w, x)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form = best if best and words[best] >= 2 * n else None
        out[w] = [form, w, n, len(others), words[form] if form else None]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def test_variants_equal_brute_force(spark):
    rng = random.Random(3)
    chain = [w for k in range(5) for w in ["k" * (5 - k) + "l" * (k + 1)] * (3 << k)]
    tie = ["zzzzz"] * 3 + ["zzzzy"] * 6 + ["zzzza"] * 6 + ["zzzzé"] * 6
    pool = family(rng, "abé", 7, 40)
    rows = [(None if i == 4 else i, " ".join(rng.choices(pool, k=200)), "x", 1) for i in range(30)]
    rows += [(99, " ".join(chain + tie), "word", 0), (98, None, "", 0), (97, "", "", 0), (96, "ÀÉ Émile ÉMILE émile ×÷ ", None, 0)] + [(95, "Émile émile " + "y" * 50_000, "", 0)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n int")
    got = variants.variants(variants.vocabulary(variants.occurrences(docs)), 16).collect()
    want = brute(rows)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want and len(got) == len(want)
    assert want["kkkkkl"][1] == "klllll" and want["zzzzz"][0] == "zzzza"


def test_variants_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert variants.variants(variants.vocabulary(variants.occurrences(docs))).collect() == []

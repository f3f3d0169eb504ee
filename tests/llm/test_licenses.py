"""License scans beside a brute-force scan of all blocks and templates."""

import random

import pytest

from eventweft.llm import licenses


def brute(text, templates=licenses.TEMPLATES, least=licenses.LEAST):
    words = licenses.words_of(text or "")
    base = [
        (i, label)
        for i in range(len(words))
        for phrase, label in licenses.PHRASES
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    labels, score = set(), 0.0
    for low in range(0, len(words), licenses.STRIDE):
        block = set(words[low : low + licenses.BLOCK])
        for label, template in templates:
            own = set(licenses.words_of(template))
            share = len(own & block) / len(own)
            if len(own & block) >= licenses.needed(len(own), least):
                labels.add(label)
                score = max(score, share)
    return len(words), base, labels, score


def texts():
    rng = random.Random(11)
    filler = [w for _, t in licenses.TEMPLATES for w in licenses.words_of(t)] + ["alpha", "beta", "über", "İ", "ſ", "K"]
    out = [None, "", " ", "x" * 50_000, "MIT\nLicense", "mit-license mit license", "The K MIT LICENSE", "General public\tlicense!"]
    for label, template in licenses.TEMPLATES:
        words = template.split()
        out.append(" ".join(rng.choices(filler, k=rng.randrange(80))) + " " + template + " tail " * rng.randrange(80))
        for drop in (1, 2, 4):
            kept = list(words)
            for _ in range(min(drop, len(kept) - 1)):
                kept.pop(rng.randrange(len(kept)))
            out.append(" ".join(["lead"] * rng.randrange(70) + kept))
        spaced = [x for w in words for x in (w, *rng.choices(["pad", "of"], k=rng.randrange(3)))]
        out.append(" ".join(spaced))
    out += [" ".join(rng.choices(filler, k=400)) for _ in range(40)]
    return out


@pytest.mark.parametrize("least", [0.9, 0.6])
def test_scan_equals_brute_force(spark, least):
    rows = [(None if i == 3 else i % 50, t, "label", 7) for i, t in enumerate(texts())] + [(1, "MIT License", "x", 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string, mark long")
    key = lambda r: repr(r)
    got = sorted(((r.doc_id, r.n_words, [(b.pos, b.label) for b in r.base], sorted(r.labels), r.score) for r in licenses.scan(docs, least=least).collect()), key=key)
    want = []
    for doc_id, text, *_ in rows:
        n, base, labels, score = brute(text, least=least)
        want.append((doc_id, n, base, sorted(labels), score))
    assert got == sorted(want, key=key)
    assert sum(bool(w[3]) for w in want) > len(licenses.TEMPLATES)


def test_scan_of_nothing(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_no_template_hides_another_license():
    """A short grant names its license in full: it needs all of its words."""
    for _, text in licenses.TEMPLATES:
        size = len(set(licenses.words_of(text)))
        assert size <= licenses.STRIDE
        if size < 10:
            assert licenses.needed(size, licenses.LEAST) == size

"""The factorization machine learns what no sum of word weights can."""

import numpy as np

from eventweft.llm import fm


def _texts(rng, rows):
    """Class 1 holds exactly one of two words, among words that say nothing."""
    filler = [f"word{i}" for i in range(60)]
    texts, y = [], []
    for i in range(rows):
        has = (i % 2, i // 2 % 2)
        words = list(rng.choice(filler, 8)) + [w for w, h in zip(("quince", "marble"), has) if h]
        rng.shuffle(words)
        texts.append(" ".join(words))
        y.append(has[0] ^ has[1])
    order = rng.permutation(rows)
    return [texts[i] for i in order], np.array(y, float)[order]


def test_pairs_weigh_more_than_their_sum():
    rng = np.random.default_rng(3)
    texts, y = _texts(rng, 2_000)
    passage, term, text = fm.Terms().passages(texts)
    model = fm.fit_terms(term, passage, text, y)
    texts, y = _texts(rng, 400)
    passage, term, text = fm.Terms().passages(texts)
    right = lambda m: ((m.margins(term, passage, len(text)) > 0) == (y == 1)).mean()
    assert right(model) >= 0.95
    assert right(fm.FmModel(model.base, model.linear, np.zeros_like(model.factor))) <= 0.8


def test_few_rows_and_one_class():
    passage, term, text = fm.Terms().passages(["good day", "bad day"])
    model = fm.fit_terms(term, passage, text, np.array([0.0, 1.0]))
    assert np.isfinite(model.margins(term, passage, 2)).all()
    model = fm.fit_terms(term, passage, text, np.array([1.0, 1.0]))
    assert not model.linear.any() and model.base > 0


def test_terms_of_passages_are_distinct_and_sorted_without_a_hash_table(monkeypatch):
    monkeypatch.setattr(np, "unique", None)
    texts = ["one two one", "", "two " * 200]
    passage, term, text = fm.Terms().passages(texts)
    monkeypatch.undo()
    key = passage << fm.BITS | term
    assert (np.diff(key) > 0).all()
    names = {w: {fm.xxhash.xxh64_intdigest(f"w{w}", 0) & ((1 << fm.BITS) - 1)} for w in ("one", "two")}
    want = {0: names["one"] | names["two"], 1: set()}
    got = {i: set(term[text[passage] == i].tolist()) for i in range(3)}
    assert got[0] == want[0] and got[1] == want[1] and got[2] == names["two"]
    assert text.tolist() == [0, 1] + [2] * 6
    passage, term, text = fm.Terms().passages(["", ""])
    assert not len(term) and text.tolist() == [0, 1]

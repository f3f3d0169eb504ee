"""Toxicity: a factorization machine over hashed terms.

score = sigmoid(base + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), x over the hashed terms of a text:
its words and their beginnings (which words of one stem share), each counted as present or not. The
factors let pairs of terms weigh more than their sum, as an insult beside a mention of a group does.
A long text is scored in passages of ``PASSAGE`` words and keeps the score of its worst passage, so one
insult is not thinned out by what surrounds it. The fit reads at most ``ROWS`` labelled rows, chosen by
the hash of the id, half of them of each class if there are enough. Linear weights start from the log odds of clear
terms, factors from small random values; both then move together, each at a rate of its own. Rates and number of
epochs are those of ``RATES`` and up to ``EPOCHS`` with the least loss on every fifth row, left out for that; the
model is then fitted on all rows. The factors are never switched off.

Defined results: NULL text reads as empty and is scored by the base; labels other than 0 and 1 are
passed over; without labelled rows or with one class only every text gets the smoothed share of class
1 (0.5 without rows). Repeated rows are scored alike. Other columns are not inputs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold_id, hashed_sample, record_batch, sliced, spread, table, texts_of

#: Labelled rows that a fit reads at most, per class.
ROWS = 1_500
BITS = 18
FACTORS = 4
PASSAGE = 64
STEMS = (4, 5)
FOLDS = 4
CUT = 0.3
#: Rates of linear weights and of factors that the left-out rows choose from.
RATES = ((0.02, 0.02), (0.1, 0.1))
EPOCHS = 8
RIDGE = 1e-3
#: Spread of the factors at the start.
SPREAD = 0.01
STORE = 300_000

_WORD = re.compile(r"\w+")


class Terms:
    """Hashed terms of words, kept per worker; only those marked in ``alive`` if it is given."""

    def __init__(self, alive: np.ndarray | None = None) -> None:
        self.alive = alive
        self._reset()

    def _reset(self) -> None:
        self.store: dict[str, int] = {}
        self.flat = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)

    def _of(self, word: str) -> list[int]:
        names = ["w" + word] + [f"{k}{word[:k]}" for k in STEMS if len(word) > k]
        terms = [xxhash.xxh64_intdigest(n, 0) & ((1 << BITS) - 1) for n in names]
        return terms if self.alive is None else [t for t in terms if self.alive[t]]

    def passages(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct terms of each passage of the whole texts: (passage, term) sorted by passage, and the
        text of each passage. Passages start every half of their length."""
        words = [_WORD.findall(t.lower()) for t in texts]
        flat = [w for ws in words for w in ws]
        if len(self.store) > STORE:
            self._reset()
        new = [w for w in dict.fromkeys(flat) if w not in self.store]
        if new:
            found = [self._of(w) for w in new]
            count = np.array([len(f) for f in found], np.int64)
            self.store.update((w, len(self.store)) for w in new)
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(count) - count])
            self.length = np.concatenate([self.length, count])
            self.flat = np.concatenate([self.flat, np.array([t for f in found for t in f], np.int64)])
        size = np.array([len(w) for w in words], np.int64)
        half = PASSAGE // 2
        parts = np.maximum(1, -(-(size - half) // half))
        first = np.cumsum(parts) - parts
        row = np.fromiter(map(self.store.__getitem__, flat), np.int64, len(flat))
        text = np.repeat(np.arange(len(texts)), size)
        place = (np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)) // half
        length = self.length[row]
        some = length > 0
        row, text, place, length = row[some], text[some], place[some], length[some]
        term = self.flat[spread(self.start[row], length)]
        text, place = np.repeat(text, length), np.repeat(place, length)
        both = [(place, term, text), (place - 1, term, text)]
        key = np.concatenate([
            ((first[t] + p) << BITS | w)[(p >= 0) & (p < parts[t])] for p, w, t in both
        ])
        key.sort()  # much faster than the hash table of np.unique, which then sorts too
        key = key[np.r_[True, key[1:] != key[:-1]][: len(key)]]
        return key >> BITS, key & ((1 << BITS) - 1), np.repeat(np.arange(len(texts)), parts)


@dataclass
class FmModel:
    base: float
    linear: np.ndarray
    factor: np.ndarray

    def margins(self, terms: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
        """Margin of each group of terms."""
        v = self.factor[terms]
        total = np.zeros((groups, v.shape[1]))
        square = np.zeros(groups)
        first = np.bincount(group, weights=self.linear[terms], minlength=groups)
        for k in range(v.shape[1]):
            total[:, k] = np.bincount(group, weights=v[:, k], minlength=groups)
            square += total[:, k] ** 2 - np.bincount(group, weights=v[:, k] ** 2, minlength=groups)
        return self.base + first + 0.5 * square


class _Fit:
    """One run of training over the rows in ``use``: AdaGrad on the worst passage of each text, picked anew in
    every epoch, with equal weight of both classes."""

    def __init__(self, terms: np.ndarray, passage: np.ndarray, text: np.ndarray, y: np.ndarray, use: np.ndarray, rates: tuple[float, float]) -> None:
        size = 1 << BITS
        self.y, self.text, self.rates, self.rng = y, text, rates, np.random.default_rng(11)
        self.rows = np.flatnonzero(use)
        # a term counts once per text
        key = np.unique(text[passage].astype(np.int64) << BITS | terms)
        of, term = key >> BITS, key & (size - 1)
        of, term = of[use[of]], term[use[of]]
        known = y[use]
        ones = np.bincount(term, weights=y[of], minlength=size)
        zeros = np.bincount(term, minlength=size) - ones
        common = ones + zeros >= min(5, max(2, len(known) // 100))
        p1, p0 = (ones + 0.5) / (known.sum() + 1), (zeros + 0.5) / ((1 - known).sum() + 1)
        spread = np.sqrt(1 / (ones + 0.5) + 1 / (zeros + 0.5))
        odds = np.log(p1 / p0)
        clear = common & (np.abs(odds) > 3 * spread)
        self.model = model = FmModel(-2.0, np.zeros(size), np.zeros((size, FACTORS)))
        model.linear[clear] = np.sign(odds[clear]) * (np.abs(odds[clear]) - 2 * spread[clear])
        model.factor[common] = self.rng.normal(0, SPREAD, (int(common.sum()), FACTORS))
        keep = common[terms]
        self.terms, self.passage = terms[keep], passage[keep]
        self.begin = np.searchsorted(self.passage, np.arange(len(text) + 1))
        self.first = np.searchsorted(text, np.arange(len(y)))
        self.seen_w, self.seen_v, self.seen_b = np.full(size, 1e-2), np.full((size, FACTORS), 1e-2), 1e-2
        self.weight = np.where(y == 1, 0.5 / known.mean(), 0.5 / (1 - known.mean()))

    def worst(self) -> tuple[np.ndarray, np.ndarray]:
        """The worst passage of each text and its margin."""
        margin = self.model.margins(self.terms, self.passage, len(self.text))
        best = np.maximum.reduceat(margin, self.first)
        hit = margin == best[self.text]
        return np.flatnonzero(hit)[np.searchsorted(self.text[hit], np.arange(len(self.y)))], best

    def loss(self, rows: np.ndarray) -> float:
        """Weighted log loss of some rows."""
        margin = np.clip(self.worst()[1][rows], -30, 30)
        return float((self.weight[rows] * np.logaddexp(0, np.where(self.y[rows] == 1, -margin, margin))).mean())

    def epoch(self) -> None:
        model, (rate, factor_rate) = self.model, self.rates
        worst, _ = self.worst()
        order = self.rng.permutation(self.rows)
        for at in range(0, len(order), 64):
            batch = order[at : at + 64]
            parts = [self.terms[self.begin[i] : self.begin[i + 1]] for i in worst[batch]]
            flat = np.concatenate(parts)
            group = np.repeat(np.arange(len(batch)), [len(r) for r in parts])
            now = np.clip(model.margins(flat, group, len(batch)), -30, 30)
            error = (1 / (1 + np.exp(-now)) - self.y[batch]) * self.weight[batch]
            v = model.factor[flat]
            total = np.stack([np.bincount(group, weights=v[:, k], minlength=len(batch)) for k in range(FACTORS)], 1)
            own, place = np.unique(flat, return_inverse=True)
            g_w = np.bincount(place, weights=error[group], minlength=len(own)) + RIDGE * model.linear[own]
            pull = error[group][:, None] * (total[group] - v)
            g_v = np.stack([np.bincount(place, weights=pull[:, k], minlength=len(own)) for k in range(FACTORS)], 1)
            g_v += RIDGE * model.factor[own]
            g_b = error.sum()
            self.seen_w[own] += g_w**2
            self.seen_v[own] += g_v**2
            self.seen_b += g_b**2
            model.linear[own] -= rate * g_w / np.sqrt(self.seen_w[own])
            model.factor[own] -= factor_rate * g_v / np.sqrt(self.seen_v[own])
            model.base -= rate * g_b / np.sqrt(self.seen_b)


def fit_terms(terms: np.ndarray, passage: np.ndarray, text: np.ndarray, y: np.ndarray) -> FmModel:
    """Weights from the terms of passages. ``passage`` gives each term's passage, ``text`` each passage's
    text, ``y`` each text's class. With too few rows to leave some out, the first rates and half of the epochs hold."""
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return FmModel(float(np.log(share / (1 - share))), np.zeros(1 << BITS), np.zeros((1 << BITS, FACTORS)))
    left_out = np.arange(len(y)) % 5 == 4
    rates, epochs = RATES[0], EPOCHS // 2
    if min(y[left_out].sum(), (1 - y[left_out]).sum()) >= 5 and 0 < y[~left_out].mean() < 1:
        tried = []
        for candidate in RATES:
            run = None  # one run's terms at a time
            run = _Fit(terms, passage, text, y, ~left_out, candidate)
            for n in range(1, EPOCHS + 1):
                run.epoch()
                tried.append((run.loss(np.flatnonzero(left_out)), candidate, n))
        _, rates, epochs = min(tried)
        run = None
    run = _Fit(terms, passage, text, y, np.ones(len(y), bool), rates)
    for _ in range(epochs):
        run.epoch()
    return run.model


def fit(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, rows: int = ROWS) -> FmModel:
    """A model from at most ``rows`` labelled rows of each class whose doc_id passes ``allowed``."""
    known = labels.filter(allowed & F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("y"))
    parts = [hashed_sample(known.filter(F.col("y") == c), rows, "doc_id", "y") for c in (0, 1)]
    known = parts[0].unionByName(parts[1]).withColumnRenamed("doc_id", "__id")
    joined = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("__id"))
    joined = hashed_sample(joined.select("doc_id", "y", "text"), 2 * rows, "doc_id", "y", "text")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Terms()
        for batch, texts in texts_of(batches, 1 << 20):
            passage, term, text = own.passages(texts)
            count = np.bincount(passage, minlength=len(text)).astype(np.int32)
            cut = np.searchsorted(text, np.arange(len(texts) + 1))
            ends = np.r_[0, np.cumsum(count)][cut]
            yield record_batch([
                ("y", batch.column("y"), pa.int32()),
                ("terms", [term[i:j].astype(np.int32).tobytes() for i, j in zip(ends[:-1], ends[1:])], pa.binary()),
                ("sizes", [count[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])], pa.binary()),
            ])

    data = joined.mapInArrow(gather, "y int, terms binary, sizes binary").toPandas()
    data = data.sort_values(["y", "terms"], kind="stable")
    sizes = [np.frombuffer(x, np.int32) for x in data["sizes"]]
    terms = [np.frombuffer(x, np.int32) for x in data["terms"]]
    text = np.repeat(np.arange(len(sizes), dtype=np.int32), [len(x) for x in sizes])
    size = np.concatenate(sizes) if sizes else np.zeros(0, np.int32)
    flat = np.concatenate(terms) if terms else np.zeros(0, np.int32)
    return fit_terms(flat, np.repeat(np.arange(len(size), dtype=np.int32), size), text, data["y"].to_numpy(float))


def score(text: Column, model: FmModel) -> Column:
    """Score of the worst passage of the whole text."""
    shared = SparkSession.active().sparkContext.broadcast((model.base, model.linear.astype(np.float32), model.factor.astype(np.float32)))

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        base, linear, factor = shared.value
        own = FmModel(base, linear, factor)
        terms = Terms((linear != 0) | (factor != 0).any(1))
        for batch in batches:
            out = [np.zeros(0)]
            for part in sliced(batch, 1 << 21):
                passage, term, text = terms.passages([t or "" for t in part.to_pylist()])
                margin = own.margins(term, passage, len(text))
                worst = np.maximum.reduceat(margin, np.searchsorted(text, np.arange(len(part))))
                out.append(1 / (1 + np.exp(-np.clip(worst, -30, 30))))
            yield pa.array(np.concatenate(out), pa.float64())

    return run(text)


def held_out(key: Column) -> Column:
    return fold_id(key, FOLDS) == 2


def op7_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"), "toxic", ~held_out(F.col("doc_id")))
    scored = docs.select("doc_id", score(F.col("text"), model).alias("score"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )

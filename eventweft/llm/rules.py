"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics are Spark column expressions over the whole text. Trees grown on a bounded sample of
labelled rows give their paths as conjunctive rules (``statistic <= cut and ...``); a lasso logistic
fit keeps few of them; what is kept compiles to one Spark column expression, so scoring never leaves
the JVM. The sample, of at most ``ROWS`` rows, is chosen by the hash of the id and is all that reaches
the driver, as numbers.

Defined results: NULL text reads as empty and is scored like any other; labels other than 0 and 1 are
passed over; without labelled rows, or with one class only, every text gets the smoothed share of class
1 (0.5 without rows). Repeated rows are scored alike. Other columns are not inputs and pass untouched.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold_id, hashed_sample, table

#: Labelled rows that a fit reads at most.
ROWS = 20_000
TREES = 16
DEPTH = 3
BINS = 32
LASSO = 2e-3
FOLDS = 5
CUT = 0.3


def statistics(text: Column) -> dict[str, Column]:
    """Numbers that describe a text; each is 0 for the empty text."""
    whole = F.coalesce(text, F.lit(""))
    words = F.split(whole, r"\s+")
    lines = F.split(whole, "\n")
    chars = F.greatest(F.length(whole), F.lit(1)).cast("double")
    return {
        "chars": F.log1p(F.length(whole).cast("double")),
        "word_chars": F.length(whole) / F.size(words),
        "line_chars": F.log1p(F.length(whole) / F.size(lines)),
        "new_words": F.size(F.array_distinct(words)) / F.size(words),
        "new_lines": F.size(F.array_distinct(lines)) / F.size(lines),
        "word_repeats": F.regexp_count(whole, F.lit(r"(?<!\S)(\S++) \1(?!\S)")) / F.size(words),
        "upper": F.regexp_count(whole, F.lit(r"\p{Lu}")) / chars,
        "digits": F.regexp_count(whole, F.lit(r"[0-9]")) / chars,
        "symbols": F.regexp_count(whole, F.lit(r"[^\p{L}\p{N}\s.,]")) / chars,
        "symbol_words": F.regexp_count(whole, F.lit(r"(?<!\S)[^\p{L}\p{N}\s]+(?!\S)")) / F.size(words),
        "sentences": F.regexp_count(whole, F.lit(r"[.?!](?!\S)")) / F.size(words),
        "shouts": F.regexp_count(whole, F.lit(r"!!|\?\?")) / F.size(words),
    }


@dataclass
class RuleModel:
    """score = sigmoid(base + sum of the weights of the rules that hold)."""

    base: float = 0.0
    #: (weight, ((statistic, is_upper_bound, cut), ...))
    rules: list[tuple[float, tuple[tuple[str, bool, float], ...]]] = field(default_factory=list)

    def score(self, stats: str = "stats") -> Column:
        total = F.lit(float(self.base))
        for weight, parts in self.rules:
            holds = F.lit(True)
            for name, upper, cut in parts:
                value = F.col(stats)[name]
                holds = holds & ((value <= F.lit(cut)) if upper else (value > F.lit(cut)))
            total = total + F.when(holds, F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def tree_paths(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = TREES, depth: int = DEPTH, seed: int = 7):
    """Paths of trees, each grown on half of the rows and half of the statistics."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    code = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    found: dict[tuple, None] = {}

    def grow(rows: np.ndarray, columns: np.ndarray, path: tuple) -> None:
        if path:
            found[tuple(sorted(path))] = None
        total, ones = len(rows), y[rows].sum()
        if len(path) == depth or total < 20 or ones in (0, total):
            return
        best = (1e-9, -1, -1)
        for j in columns:
            bins = len(cuts[j]) + 1
            n = np.cumsum(np.bincount(code[rows, j], minlength=bins))[:-1]
            p = np.cumsum(np.bincount(code[rows, j], weights=y[rows], minlength=bins))[:-1]
            fine = (n >= 5) & (total - n >= 5)
            if not fine.any():
                continue
            gain = np.where(fine, p * p / np.maximum(n, 1) + (ones - p) ** 2 / np.maximum(total - n, 1), 0) - ones**2 / total
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), int(j), k)
        _, j, k = best
        if j < 0:
            return
        below = code[rows, j] <= k
        cut = float(cuts[j][k])
        grow(rows[below], columns, path + ((names[j], True, cut),))
        grow(rows[~below], columns, path + ((names[j], False, cut),))

    for _ in range(trees):
        rows = rng.permutation(len(y))[: max(1, len(y) // 2)] if len(y) > 200 else np.arange(len(y))
        columns = rng.permutation(x.shape[1])[: max(2, (x.shape[1] + 1) // 2)]
        grow(np.sort(rows), np.sort(columns), ())
    return list(found)


def holds(x: np.ndarray, names: list[str], path: tuple) -> np.ndarray:
    out = np.ones(len(x), bool)
    for name, upper, cut in path:
        value = x[:, names.index(name)]
        out &= (value <= cut) if upper else (value > cut)
    return out


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float = LASSO, rounds: int = 400):
    """Weights and base by accelerated proximal gradient steps."""
    step = 4.0 * len(y) / (np.linalg.norm(z, 2) ** 2 + len(y))
    w, base = np.zeros(z.shape[1]), float(np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9)))
    v, vb, t = w.copy(), base, 1.0
    for _ in range(rounds):
        error = (1 / (1 + np.exp(-(z @ v + vb))) - y) / len(y)
        moved = v - step * (z.T @ error)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        new_base = vb - step * error.sum()
        ahead = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / ahead * (new - w), new_base + (t - 1) / ahead * (new_base - base)
        w, base, t = new, new_base, ahead
    return w, base


def fit_arrays(x: np.ndarray, y: np.ndarray, names: list[str]) -> RuleModel:
    if len(y) == 0:
        return RuleModel()
    share = (y.sum() + 1) / (len(y) + 2)
    if y.min() == y.max():
        return RuleModel(float(np.log(share / (1 - share))))
    paths = tree_paths(x, y, names)
    if not paths:
        return RuleModel(float(np.log(share / (1 - share))))
    z = np.stack([holds(x, names, p) for p in paths], 1).astype(float)
    w, base = lasso_logistic(z, y)
    return RuleModel(base, [(float(a), p) for a, p in zip(w, paths) if a != 0])


def fit(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, rows: int = ROWS) -> RuleModel:
    """A model from at most ``rows`` labelled rows whose doc_id passes ``allowed``."""
    known = labels.filter(allowed & F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("double").alias("y"))
    known = hashed_sample(known, rows, "doc_id", "y").withColumnRenamed("doc_id", "__id")
    named = statistics(F.col("text"))
    joined = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("__id"))
    # documents may repeat an id: the bound holds for the joined rows too
    joined = joined.select("doc_id", "y", *[c.alias(n) for n, c in named.items()])
    data = hashed_sample(joined, rows, "doc_id", "y", *named).select("y", *named).toPandas().to_numpy(float)
    return fit_arrays(data[:, 1:], data[:, 0], list(named))


def scored(docs: DataFrame, model: RuleModel, score: str = "score") -> DataFrame:
    """``docs`` with one more column."""
    names = docs.columns
    stats = F.struct(*[c.cast("double").alias(n) for n, c in statistics(F.col("text")).items()])
    # made by explode, so that a filter on the score is not moved below the statistics, which would then
    # be computed once per rule
    inner = docs.select(F.struct(*names).alias("row"), F.explode(F.array(stats)).alias("stats"))
    return inner.select(*[F.col("row")[n].alias(n) for n in names], model.score().alias(score))


def held_out(key: Column) -> Column:
    return fold_id(key, FOLDS) == 0


def quality_model(docs: DataFrame, labels: DataFrame) -> RuleModel:
    return fit(docs, labels, "quality", ~held_out(F.col("doc_id")))


def op3_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )

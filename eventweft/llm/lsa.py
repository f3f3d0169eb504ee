"""Benchmark decontamination by latent semantic retrieval.

The words of the benchmark are the vocabulary. Document frequencies are counted over all documents.
Passages of ``WINDOW`` words, by half of that apart, are TF-IDF rows of unit length; a randomised SVD
(sketch rows of A^T A W summed by Spark, then a small Nystroem eigenproblem) gives ``RANK`` directions.
Its rows are the passages of all documents and, as heavy in sum, those of the benchmark. Every passage of every whole document is then projected and compared with all
benchmark passages; those with a cosine of ``COSINE`` or more are candidates. So is every place with
``GRAM`` words in a row of an item (all words of a shorter one), whatever their weights: an item that is
itself in many documents has frequent words only, which tell little in the latent space. No word weighs 0.
A candidate's surroundings
must hold a longest common subsequence of ``SURE`` of the item's words, or of ``LIKELY`` together with
the item's answer (its last words). Items over ``CASE`` words are checked case by case.

The benchmark is the query set: it is read in blocks of at most ``BLOCK_WORDS`` words, each a pass over
the documents, so nothing that is broadcast grows with the input.

Defined results: NULL or empty texts and items match nothing; repeated rows each get their result;
items that share an id each give a row with the id; other columns pass untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import record_batch, sliced, spread, table, texts_of

WINDOW = 24
RANK = 96
OVERSAMPLE = 16
#: Least cosine in the latent space, and least share of a passage's length that lies in it.
COSINE = 0.65
WITHIN = 0.1
#: Words in a row that make a place a candidate whatever the latent space says.
GRAM = 3
SURE = 0.75
LIKELY = 0.55
ANSWER_WORDS = 5
ANSWER = 0.8
CASE = 96
BLOCK_WORDS = 16_000

#: ASCII signs other than letters, digits and _ part words, as white space does.
_PARTS = bytes(c if c >= 128 or chr(c).isalnum() or c == 95 else 32 for c in range(256))
HIT = "array<struct<item:int,lcs:double,cosine:double,answer:boolean>>"


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_PARTS).split()


@dataclass
class Block:
    """Items of one block as word numbers, cut into cases."""

    items: list
    vocabulary: dict[bytes, int]
    cases: list[tuple[int, np.ndarray]]

    @classmethod
    def of(cls, rows: list[tuple[object, list[bytes]]]) -> Block:
        vocabulary: dict[bytes, int] = {}
        cases = []
        for k, (_, words) in enumerate(rows):
            ids = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int64)
            parts = -(-len(ids) // CASE)
            cases += [(k, part) for part in np.array_split(ids, parts)]
        return cls([i for i, _ in rows], vocabulary, cases)


def blocks(benchmark: DataFrame, bound: int = BLOCK_WORDS) -> Iterator[Block]:
    rows, total = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        words = words_of(row.text or "")
        if not words:
            continue
        if total and total + len(words) > bound:
            yield Block.of(rows)
            rows, total = [], 0
        rows.append((row.item_id, words))
        total += len(words)
    if rows:
        yield Block.of(rows)


def frequencies(docs: DataFrame, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, int]:
    """Documents with each word, over all documents, and the number of documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        seen, rows = np.zeros(len(known), np.int64), 0
        for _, texts in texts_of(batches):
            rows += len(texts)
            found = [known[w] for t in texts for w in known.keys() & set(words_of(t))]
            seen += np.bincount(np.array(found, np.int64), minlength=len(known))
        at = np.flatnonzero(seen)
        yield record_batch([("word", np.r_[-1, at], pa.int64()), ("n", np.r_[rows, seen[at]], pa.int64())])

    total = docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    out, rows = np.zeros(len(vocabulary)), 0
    for row in total.toLocalIterator():
        if row.word < 0:
            rows = row.n
        else:
            out[row.word] = row.n
    return out, rows


def passages(ids: list[np.ndarray], weight: np.ndarray, factors: np.ndarray):
    """Of texts as word numbers (-1: unknown): the sums of ``factors`` of each passage, its TF-IDF length,
    its text and its first word."""
    half = WINDOW // 2
    size = np.array([len(i) for i in ids], np.int64)
    halves = np.maximum(1, -(-size // half))
    first = np.cumsum(halves) - halves
    flat = np.concatenate(ids)
    text = np.repeat(np.arange(len(ids)), size)
    part = first[text] + (np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)) // half
    known = flat >= 0
    known[known] = weight[flat[known]] > 0
    flat, part = flat[known], part[known]
    sums = np.zeros((int(halves.sum()), factors.shape[1]), np.float32)
    # the k-th words of all halves at once: a half has few, so that few additions do
    slot = np.arange(len(part)) - np.searchsorted(part, part)
    for k in range(half):
        at = np.flatnonzero(slot == k)
        sums[part[at]] += factors[flat[at]]
    square = np.bincount(part, weights=weight[flat] ** 2, minlength=len(sums))
    # a passage is two halves; the last half of a text has no other behind it
    last = np.zeros(len(sums), bool)
    last[first + halves - 1] = True
    go = ~last | np.repeat(halves == 1, halves)
    at = np.flatnonzero(go)
    follows = np.where(last[at], at, at + 1)
    both = sums[at] + np.where(last[at], 0, 1)[:, None].astype(np.float32) * sums[follows]
    norm = np.sqrt(square[at] + np.where(last[at], 0, square[follows]))
    of = np.repeat(np.arange(len(ids)), halves)[at]
    return both, norm, of, (at - first[of]) * half, (at, follows, part, flat)


def sketch(ids: list[np.ndarray], weight: np.ndarray, test: np.ndarray) -> np.ndarray:
    """A^T A W of the passages of some texts, W = ``test``."""
    both, norm, _, _, (at, follows, part, flat) = passages(ids, weight, (weight[:, None] * test).astype(np.float32))
    both /= (np.maximum(norm, 1e-9)[:, None] ** 2).astype(np.float32)
    per_half = np.zeros((int(max(at.max(), follows.max())) + 1 if len(at) else 0, test.shape[1]), np.float32)
    # a half begins one passage at most and ends one at most
    per_half[at] = both
    two = follows != at
    per_half[follows[two]] += both[two]
    out = np.zeros((len(weight), test.shape[1]))
    if len(flat):
        order = np.argsort(flat, kind="stable")
        own, begin = np.unique(flat[order], return_index=True)
        out[own] = np.add.reduceat(per_half[part[order]], begin, axis=0) * weight[own, None]
    return out


def latent_axes(docs: DataFrame, block: Block, weight: np.ndarray) -> np.ndarray:
    """Words x RANK: the leading directions of the TF-IDF passages."""
    count = len(block.vocabulary)
    rank = min(RANK + OVERSAMPLE, count)
    test = np.random.default_rng(5).normal(size=(count, rank))
    shared = docs.sparkSession.sparkContext.broadcast((block.vocabulary, weight, test))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, idf, w = shared.value
        total = np.zeros((len(idf), w.shape[1]))
        for _, texts in texts_of(batches, 1 << 20):
            total += sketch(numbers(texts, known), idf, w)
        at = np.flatnonzero(total.any(1))
        yield record_batch([("word", at, pa.int64()), ("row", list(total[at]), pa.list_(pa.float64()))])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for word, row in zip(batch.column("word").to_pylist(), batch.column("row")):
                value = np.asarray(row.values)
                sums[word] = sums[word] + value if word in sums else value
        yield record_batch([("word", list(sums), pa.int64()), ("row", list(sums.values()), pa.list_(pa.float64()))])

    kind = "word long, row array<double>"
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    summed = docs.select("text").mapInArrow(part, kind).repartition(parts, "word").mapInArrow(add, kind)
    corpus = np.zeros((count, rank))
    for row in summed.toLocalIterator():
        corpus[row.word] = row.row
    own = sketch([c for _, c in block.cases], weight, test)
    size = np.linalg.norm(corpus), np.linalg.norm(own)
    z = own + corpus * (size[1] / size[0] if size[0] > 0 else 0)
    # Nystroem: A^T A ~ z (test^T z)^-1 z^T
    core = test.T @ z
    value, vector = np.linalg.eigh((core + core.T) / 2)
    fine = value > max(value.max(), 1e-12) * 1e-9
    root = z @ (vector[:, fine] / np.sqrt(value[fine]))
    axes, _, _ = np.linalg.svd(root, full_matrices=False)
    return axes[:, :RANK]


def numbers(texts: list[str], known: dict[bytes, int]) -> list[np.ndarray]:
    get = known.get
    return [np.array([get(w, -1) for w in words_of(t)], np.int64) for t in texts]


def places_of(item: list[int]) -> dict[int, int]:
    """The places of each word of an item, as bits of one number."""
    at: dict[int, int] = {}
    for i, w in enumerate(item):
        at[w] = at.get(w, 0) | 1 << i
    return at


def common_subsequence(size: int, places: list[int]) -> int:
    """Length of the longest common subsequence of an item of ``size`` words and a text, given as the places in the item
    of each of its words that the item has."""
    full = (1 << size) - 1
    rest = full
    for at in places:
        u = rest & at
        if u:
            rest = ((rest + u) | (rest - u)) & full
    return size - rest.bit_count()


def gram_keys(ids: np.ndarray, n: int, count: int) -> np.ndarray:
    """A number for each ``n`` words in a row of a vocabulary of ``count``; -1 if one of them is unknown."""
    places = max(0, len(ids) - n + 1)
    key, known = np.zeros(places, np.int64), np.ones(places, bool)
    for k in range(n):
        key = key * count + ids[k : k + places]
        known &= ids[k : k + places] >= 0
    return np.where(known, key, -1)


def gram_table(block: Block) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: the sorted grams of all cases and the case of each."""
    own: dict[int, list[tuple[np.ndarray, int]]] = {}
    for case, (_, words) in enumerate(block.cases):
        n = min(GRAM, len(words))
        own.setdefault(n, []).append((np.unique(gram_keys(words, n, len(block.vocabulary))), case))
    out = {}
    for n, found in own.items():
        key = np.concatenate([k for k, _ in found])
        case = np.repeat([c for _, c in found], [len(k) for k, _ in found])
        order = np.argsort(key, kind="stable")
        out[n] = key[order], case[order]
    return out


@dataclass
class Index:
    """What a worker needs to find the items of a block in texts."""

    block: Block
    weight: np.ndarray
    factors: np.ndarray
    targets: np.ndarray
    target_case: np.ndarray
    grams: dict[int, tuple[np.ndarray, np.ndarray]]
    places: list[dict[int, int]]

    def find(self, texts: list[str]) -> list[list[tuple[int, float, float, bool]]]:
        ids = numbers(texts, self.block.vocabulary)
        both, norm, of, start, _ = passages(ids, self.weight, self.factors)
        best: list[dict[int, tuple]] = [{} for _ in texts]
        step = 8192
        for low in range(0, len(both), step):
            part = both[low : low + step]
            length = np.linalg.norm(part, axis=1)
            part, length = np.where((length > WITHIN * norm[low : low + step])[:, None], part, 0), np.maximum(length, 1e-9)
            cosine = (part / length[:, None]) @ self.targets.T
            at, target = np.nonzero(cosine >= COSINE)
            score = cosine[at, target]
            # best first, each passage and case once: a second comparison would find the same
            order = np.argsort(-score, kind="stable")
            _, once = np.unique(at[order] * len(self.block.cases) + self.target_case[target[order]], return_index=True)
            for k in order[np.sort(once)].tolist():
                row = low + int(at[k])
                self._verify(ids, best, int(of[row]), int(start[row]), int(self.target_case[target[k]]), float(score[k]))
        self._by_grams(ids, best, both, of)
        out = []
        for found in best:
            items: dict[int, tuple] = {}
            for case, (lcs, cosine, answer, sure) in found.items():
                item = self.block.cases[case][0]
                if sure and (item not in items or lcs > items[item][0]):
                    items[item] = (lcs, cosine, answer)
            out.append([(i, *v) for i, v in sorted(items.items())])
        return out

    def _by_grams(self, ids: list[np.ndarray], best: list[dict], both: np.ndarray, of: np.ndarray) -> None:
        """Verifies the places that share a gram with a case."""
        half = WINDOW // 2
        row_of = np.searchsorted(of, np.arange(len(ids)))
        last = np.searchsorted(of, np.arange(len(ids)), side="right") - 1
        size = np.array([len(i) for i in ids], np.int64)
        first = np.cumsum(size) - size
        text = np.repeat(np.arange(len(ids)), size)
        flat = np.concatenate(ids)
        for n, (keys, cases) in self.grams.items():
            key = gram_keys(flat, n, len(self.block.vocabulary))
            at = np.flatnonzero((key >= 0) & (text[: len(key)] == text[n - 1 :]))
            low = np.searchsorted(keys, key[at])
            many = np.searchsorted(keys, key[at], side="right") - low
            at, low, many = at[many > 0], low[many > 0], many[many > 0]
            place = np.repeat(at, many)
            of_place = text[place]
            start = (place - first[of_place]) // half * half
            case = cases[spread(low, many)]
            for t, c, s in np.unique(np.stack([of_place, case, start], 1), axis=0).tolist():
                known = best[t].get(c)
                if known is None or not known[3]:
                    row = both[min(int(row_of[t]) + s // half, int(last[t]))]
                    near = self.targets[self.target_case == c] @ row / max(float(np.linalg.norm(row)), 1e-9)
                    self._verify(ids, best, t, s, c, float(near.max(initial=0.0)))

    def _verify(self, ids: list[np.ndarray], best: list[dict], text: int, start: int, case: int, score: float) -> None:
        known = best[text].get(case)
        if known is not None and known[3]:
            return
        words, places = self.block.cases[case][1], self.places[case]
        size = len(words)
        near = ids[text][max(0, start - size) : start + WINDOW + size].tolist()
        common = [places[w] for w in near if w in places]
        # places of the item whose word is near: no common subsequence is longer
        seen = 0
        for at in common:
            seen |= at
        if seen.bit_count() / size < LIKELY:
            return
        lcs = common_subsequence(size, common) / size
        if lcs < LIKELY:
            return
        tail = places_of(words[-ANSWER_WORDS:].tolist())
        ends = min(size, ANSWER_WORDS)
        answer = common_subsequence(ends, [tail[w] for w in near if w in tail]) >= ANSWER * ends
        sure = lcs >= SURE or (lcs >= LIKELY and answer)
        if sure or known is None or lcs > known[0]:
            best[text][case] = (lcs, score, answer, sure)


def build(docs: DataFrame, block: Block) -> Index:
    seen, rows = frequencies(docs, block.vocabulary)
    weight = np.log1p(rows / (seen + 1.0))  # above 0 even for a word of all documents
    axes = latent_axes(docs, block, weight)
    factors = (weight[:, None] * axes).astype(np.float32)
    cases = [c for _, c in block.cases]
    both, _, of, _, _ = passages(cases, weight, factors)
    length = np.linalg.norm(both, axis=1)
    keep = length > 0
    places = [places_of(c.tolist()) for c in cases]
    return Index(block, weight, factors, both[keep] / length[keep, None], of[keep], gram_table(block), places)


def hits(text: Column, index: Index) -> Column:
    """Items of the index's block in each whole text."""
    shared = SparkSession.active().sparkContext.broadcast(index)

    @F.arrow_udf(HIT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        kind = pa.list_(pa.struct([("item", pa.int32()), ("lcs", pa.float64()), ("cosine", pa.float64()), ("answer", pa.bool_())]))
        names = [f.name for f in kind.value_type]
        for batch in batches:
            parts = [pa.array([], kind)]
            for values in sliced(batch, 1 << 20):
                found = own.find([t or "" for t in values.to_pylist()])
                parts.append(pa.array([[dict(zip(names, h)) for h in hs] for hs in found], kind))
            yield pa.concat_arrays(parts)

    return run(text)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, lcs, cosine, answer): the items found in each document."""
    docs = docs.select("doc_id", "text")
    out = None
    for block in blocks(benchmark):
        found = docs.select("doc_id", F.explode(hits(F.col("text"), build(docs, block))).alias("h"))
        kind = benchmark.schema["item_id"].dataType
        names = docs.sparkSession.createDataFrame(list(enumerate(block.items)), f"item int, item_id {kind.simpleString()}")
        found = found.select("doc_id", "h.*").join(F.broadcast(names), "item")  # a block's ids: bounded by its words
        found = found.select("doc_id", "item_id", "lcs", "cosine", "answer")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.join(benchmark.select("item_id"), F.lit(False)).select(
            "doc_id", "item_id", *[F.lit(0.0).alias(n) for n in ("lcs", "cosine")], F.lit(False).alias("answer")
        )
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item of the benchmark is found."""
    names = docs.columns
    for block in blocks(benchmark):
        index = build(docs, block)
        kept = docs.select(F.struct(*names).alias("row"), F.size(hits(F.col("text"), index)).alias("n")).filter("n = 0")
        docs = kept.select(*[F.col("row")[n].alias(n) for n in names])
    return docs


def op4_latent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

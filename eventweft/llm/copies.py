"""SimHash near copies of similarity 0.8 and more by pivot distance tables, whatever the edits.

1. A document's set: XXH64 of every ``SHINGLE`` words in a row (the whole of a shorter text), made in one pass that
   also gives the set's node (its hash) and its SimHash fingerprint of ``WORDS`` words (``simhash.wide_print``).
   Copies are one node, aggregated on the map side.
2. Sets of similarity s and like sizes differ in a share of acos(2s/(1+s))/pi of the bits on average, 0.152 for 0.8; small
   sets a little more, ``FLIPPED`` at most, but for those of ``TINY`` shingles. Fingerprints that agree on all bits of
   a band meet in a cell. The number of sets gives the width of a band, so that unlike ones leave a cell at some ``CELL`` members;
   the width gives the number of bands, so that a pair of similarity 0.8 meets nowhere with probability ``MISSED``
   (0.85: some 2e-5 for 200,000 sets); a group is lost only if all its links are. Keys per set grow with the
   number of sets, with its power 0.24.
3. Beside them, sets up to ``SMALL`` / ``LEAST`` shingles have exact keys: two sets of similarity ``LEAST`` differ in at most a
   (1-LEAST)/(1+LEAST) share of the sum of their sizes. Sets of one size level (powers of 1/LEAST; each set is dealt to
   its own and the next) are cut by hash into more segments than that, so one segment at least agrees whole.
   Segments without shingles are dealt only by sets whose other segments may all differ.
4. In a cell the first ``HEAD`` words are compared by a pivot distance table (``simhash.near_pairs``): pivots are members of
   the cell, far from each other; what the triangle inequality leaves is verified bit by bit. Sets near no other leave
   the cell, the others stay in components, each a cell of its own.
5. The sets of such a cell are first compared with its smallest. What is then still in different components
   of a cell is compared inside the cell's task, by pivots again, of which a forest leaves it. Both take whole fingerprints:
   over ``RADIUS`` differing bits is no link. What is left is decided by the exact Jaccard similarity of the
   two sets, each made once from its text: pairs with the smallest of a cell by joins, the others
   inside the task of their group of alike sets, which again only a forest leaves.
6. Components of the links, as in ``simhash``.

No text is staged, and none is in a row of pairs: texts move once per comparing round, one for each set still in question.
Defined results: NULL and empty texts have the empty set and are copies of each other; repeated rows and
NULL ids are as in ``simhash``; texts of one 64-bit hash count as one. The radii lie five standard deviations and more
above what similarity 0.8 gives. The bit comparisons of steps 4 and 5 (not their rows) grow
with the square of the unlike documents that share a key. A task holds the fingerprints of one cell and compares them in blocks;
in the last comparison it holds the sets of one group of alike sets that are not yet linked, whatever their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import record_batch, sliced, staged, texts_of
from .simhash import SEED, WORDS, components, joined, near_pairs, smallest_of_each, wide_print

SHINGLE = 5
LEAST = 0.8
#: Segments for each shingle in which two sets may differ.
SPARE = 1.1
#: Sets up to this size also have segments as keys.
SMALL = 64
#: Share of the bits in which fingerprints of similarity LEAST differ at most, but for sets of up to TINY shingles.
FLIPPED = 0.155
#: Share of such pairs that may share no band.
MISSED = 6e-4
#: Sets in a cell on average, at most.
CELL = 256
#: Differing bits of a link at most, five standard deviations and more above those of similarity LEAST.
RADIUS = 224
TINY, TINY_RADIUS = 4, 260
#: First words, compared in the cells, and their differing bits at most.
HEAD, HEAD_RADIUS = 3, 64
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def shingles(text: str) -> np.ndarray:
    """The sorted set of a text."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    places = max(1, len(words) - SHINGLE + 1)
    return np.unique(np.array([digest(b" ".join(words[i : i + SHINGLE]), SEED) for i in range(places)], np.uint64))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def segment_keys(own: np.ndarray, least: float = LEAST) -> np.ndarray:
    """The cells of a set."""
    n, out = len(own), []
    if not n:
        return own
    base = math.floor(math.log(n) / math.log(1 / least))
    share = (1 - least) / (1 + least)
    for level in (base, base + 1):
        most = (1 / least) ** (level + 1)
        count = int(SPARE * 2 * most * share) + 2
        segment = (own >> np.uint64(20)) % np.uint64(count)
        order = np.argsort(segment, kind="stable")
        filled, begin = np.unique(segment[order], return_index=True)
        sums = np.add.reduceat(own[order], begin)
        # shingles in which a set of this level may differ
        differ = int((n + min(n / least, most)) * share + 1e-6)
        if len(filled) <= differ:
            empty = np.setdiff1d(np.arange(count, dtype=np.uint64), filled)
            filled, sums = np.r_[filled, empty], np.r_[sums, np.zeros(len(empty), np.uint64)]
        out.append((sums * MIX[0]) ^ (filled * MIX[1] + np.uint64(level) * MIX[2]))
    return np.concatenate(out)


def bands(sets: int) -> np.ndarray:
    """Places of the bits of each band, a row per band, for so many sets."""
    width = max(4, math.ceil(math.log2(max(1, sets) / CELL)))
    count = math.ceil(math.log(MISSED) / math.log(1 - (1 - FLIPPED) ** width))
    rng = np.random.default_rng(SEED)
    places: list[np.ndarray] = []
    free = np.zeros(0, np.int64)
    for _ in range(count):  # no bit twice before each was used once
        if len(free) < width:
            free = rng.permutation(64 * WORDS)
        places.append(free[:width])
        free = free[width:]
    return np.stack(places)


def _words(prints: pa.Array | list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and sizes of the sets."""
    values = prints if isinstance(prints, list) else prints.to_pylist()
    rows = np.frombuffer(b"".join(values), np.uint64).reshape(-1, WORDS + 1)
    return rows[:, :WORDS], rows[:, WORDS].astype(np.int64)


def radius_of(size: np.ndarray) -> np.ndarray:
    return np.where(size <= TINY, TINY_RADIUS, RADIUS)


def dealt(prints: DataFrame) -> DataFrame:
    """(key, node, h0, h1, h2): the cells of each set, with the first words of its fingerprint."""
    places = bands(prints.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.int64(1) << np.arange(places.shape[1], dtype=np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                node = np.asarray(batch.column("node"), np.int64)
                words, _ = _words(batch.column("print"))
                bits = np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=1)
                value = np.stack([bits[:, p] @ weight for p in places], 1).astype(np.uint64)
                key = (value * MIX[0]) ^ (np.arange(1, len(places) + 1, dtype=np.uint64) * MIX[1])
                more = batch.column("keys").to_pylist()
                row = np.r_[np.repeat(np.arange(len(node)), len(places)), np.repeat(np.arange(len(node)), [len(m) for m in more])]
                key = np.r_[key.reshape(-1).view(np.int64), np.array([k for m in more for k in m], np.int64)]
                head = words[row, :HEAD].view(np.int64)
                yield record_batch([("key", key, pa.int64()), ("node", node[row], pa.int64())] + [
                    (f"h{i}", np.ascontiguousarray(head[:, i]), pa.int64()) for i in range(HEAD)
                ])

    return prints.mapInArrow(run, "key long, node long, " + ", ".join(f"h{i} long" for i in range(HEAD)))


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, mark, node, print, keys); copies within a batch are read once, and only one has print and keys."""
    for batch, texts in texts_of(batches, 1 << 21):
        known: dict[int, int] = {}
        node, prints, keys = [], [], []
        for mark, text in zip(batch.column("mark").to_pylist(), texts):
            if mark in known:
                node.append(known[mark])
                prints.append(None)
                keys.append(None)
                continue
            own = shingles(text)
            print_ = xxhash.xxh64_intdigest(own.tobytes(), SEED)
            known[mark] = print_ - (1 << 64) if print_ >= 1 << 63 else print_
            node.append(known[mark])
            prints.append(np.r_[wide_print(own), np.uint64(len(own))].tobytes())
            keys.append(segment_keys(own).view(np.int64) if len(own) <= SMALL / LEAST else [])
        yield record_batch([
            ("doc_id", batch.column("doc_id"), None), ("mark", batch.column("mark"), None), ("node", node, pa.int64()),
            ("print", prints, pa.binary()), ("keys", pa.array(keys, pa.list_(pa.int64())), None),
        ])


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node, least): the sets of each cell that are near another one by the first words of their fingerprints,
    in cells of their own, in a partition sorted by key and node."""

    def several(key: np.ndarray, node: np.ndarray, head: np.ndarray) -> pa.RecordBatch:
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
        size = np.diff(np.r_[begin, len(key)])
        least = np.arange(len(key))
        for at, n in zip(begin[size > 1].tolist(), size[size > 1].tolist()):
            label = np.arange(n)
            for x, y in near_pairs(head[at : at + n], np.full(n, HEAD_RADIUS), label):
                joined(label, x, y)
            least[at : at + n] = at + label
        many = np.bincount(least, minlength=len(key))[least] > 1
        first = node[least[many]]
        own = key[many] ^ (first.view(np.uint64) * MIX[2]).view(np.int64)
        return record_batch([("key", own, pa.int64()), ("node", node[many], pa.int64()), ("least", first, pa.int64())])

    key, node, head = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, HEAD), np.uint64)
    for batch in batches:
        key = np.r_[key, np.asarray(batch.column("key"), np.int64)]
        node = np.r_[node, np.asarray(batch.column("node"), np.int64)]
        words = [np.asarray(batch.column(f"h{i}"), np.int64).view(np.uint64) for i in range(HEAD)]
        head = np.r_[head, np.stack(words, 1)]
        cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
        yield several(key[:cut], node[:cut], head[:cut])
        key, node, head = key[cut:], node[cut:], head[cut:]
    yield several(key, node, head)


def _joined(label: list[int], a: int, b: int) -> bool:
    """Joins two places of a forest; False if they were joined before."""
    while label[a] != a:
        label[a] = label[label[a]]
        a = label[a]
    while label[b] != b:
        label[b] = label[label[b]]
        b = label[b]
    label[max(a, b)] = min(a, b)
    return a != b


def _cells(batches: Iterator[pa.RecordBatch], key: str, columns: tuple[str, ...]) -> Iterator[list[list]]:
    """The columns of each key's rows, in a partition sorted by key."""
    last, rows = None, [[] for _ in columns]
    for batch in batches:
        for at, *values in zip(*[batch.column(c).to_pylist() for c in (key, *columns)]):
            if at != last and rows[0]:
                yield rows
                rows = [[] for _ in columns]
            last = at
            for column, value in zip(rows, values):
                column.append(value)
    if rows[0]:
        yield rows


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    return record_batch([("a", [r[0] for r in rows], pa.int64()), ("b", [r[1] for r in rows], pa.int64())])


def _crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest (a, b) of the alike sets of each cell, fewer rows than the cell has sets."""
    for node, root, prints in _cells(batches, "key", ("node", "root", "print")):
        words, size = _words(prints)
        label = np.arange(len(node))
        for x, y in near_pairs(words, radius_of(size), np.array(root, np.int64)):
            fit = _sizes_fit(size[x], size[y])
            joined(label, x[fit], y[fit])
        yield _pairs([(node[i], node[j]) for i, j in enumerate(label.tolist()) if i != j])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) that join the components of a group of alike sets, each compared by its whole set."""
    for node, root, prints, own in _cells(batches, "alike", ("node", "root", "print", "own")):
        words, size = _words(prints)
        roots = {r: i for i, r in enumerate(sorted(set(root)))}
        label, out = list(range(len(roots))), []
        sets = [np.frombuffer(o, np.uint64) for o in own]
        for x, y in near_pairs(words, radius_of(size), np.array(root, np.int64)):
            fit = _sizes_fit(size[x], size[y])
            for i, j in zip(x[fit].tolist(), y[fit].tolist()):
                if similarity(sets[i], sets[j]) >= LEAST and _joined(label, roots[root[i]], roots[root[j]]):
                    out.append((node[j], node[i]))
        yield _pairs(out)


def _sizes_fit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum(a, b) >= LEAST * np.maximum(a, b)


def alike(pairs: DataFrame, prints: DataFrame) -> DataFrame:
    """Pairs without those whose fingerprints or sizes differ too much."""

    @F.arrow_udf("boolean")
    def near(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            (a, m), (b, n) = _words(left), _words(right)
            differ = np.bitwise_count(a ^ b).sum(1, dtype=np.int64)
            yield pa.array((differ <= np.maximum(radius_of(m), radius_of(n))) & _sizes_fit(m, n))

    one = pairs.join(prints.select(F.col("node").alias("a"), F.col("print").alias("pa")), "a")
    both = one.join(prints.select(F.col("node").alias("b"), F.col("print").alias("pb")), "b")
    return both.filter(near("pa", "pb")).select("a", "b")


def held(nodes: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, own): the sets of these nodes, each made once. ``sets`` names a text of each node, ``texts`` has
    (mark, text)."""

    @F.arrow_udf("binary")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in sliced(batch):
                yield pa.array([shingles(t.as_py() or "").tobytes() for t in part], pa.binary())

    asked = nodes.select("node").distinct().join(sets.select("node", "mark"), "node")
    found = texts.join(asked, "mark").groupBy("node").agg(F.min("text").alias("text"))
    return staged(found.select("node", made("text").alias("own")), "held")


def links(pairs: DataFrame, sets: DataFrame, texts: DataFrame, least: float = LEAST) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are similar enough."""

    @F.arrow_udf("boolean")
    def near(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            out = [similarity(np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)) >= least for a, b in zip(left, right)]
            yield pa.array(out, pa.bool_())

    own = held(pairs.select(F.explode(F.array("a", "b")).alias("node")), sets, texts)
    one = pairs.join(own.select(F.col("node").alias("a"), F.col("own").alias("x")), "a")
    both = one.join(own.select(F.col("node").alias("b"), F.col("own").alias("y")), "b")
    return both.filter(near("x", "y")).select("a", "b")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their component; of repeated rows any one."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    kind = docs.schema["doc_id"].dataType.simpleString()
    marked = docs.select("doc_id", mark.alias("mark"), "text").mapInArrow(
        _marked, f"doc_id {kind}, mark long, node long, print binary, keys array<long>"
    )
    marked = staged(marked, "marked")
    texts = docs.select(mark.alias("mark"), "text")
    sets = staged(marked.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.min("mark").alias("mark")), "sets")
    read = marked.filter("print IS NOT NULL").groupBy("node")
    prints = staged(read.agg(F.max("print").alias("print"), F.max("keys").alias("keys")), "prints")
    cells = dealt(prints).repartition(parts, "key").sortWithinPartitions("key", "node")
    prints = prints.select("node", "print")
    members = staged(cells.mapInArrow(_members, "key long, node long, least long"), "members")
    first = members.filter("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    first = staged(first, "first")
    edges = staged(links(staged(alike(first, prints), "alike"), sets, texts), "links")
    roots = staged(components(edges), "roots")
    named = members.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    named = staged(named, "named")
    parted = named.groupBy("key").agg(F.min("root").alias("m"), F.max("root").alias("n")).filter("m <> n").select("key")
    left = named.join(parted, "key", "left_semi").join(prints, "node")
    left = left.repartition(parts, "key").sortWithinPartitions("key", "node")
    # groups of sets that may be joined: each pair still in question lies in one of them
    groups = components(staged(left.mapInArrow(_crossed, "a long, b long"), "cross"))
    groups = groups.unionByName(groups.select("root").distinct().select(F.col("root").alias("node"), "root"))
    groups = staged(groups.select("node", F.col("root").alias("alike")), "groups")
    asked = groups.join(prints, "node").join(held(groups, sets, texts), "node").join(roots, "node", "left")
    asked = asked.select("alike", "node", F.coalesce("root", "node").alias("root"), "print", "own")
    more = asked.repartition(parts, "alike").sortWithinPartitions("alike", "node").mapInArrow(_verified, "a long, b long")
    roots = components(edges.unionByName(staged(more, "more")))
    rooted = sets.select("node", "first_id").join(roots, "node", "left")
    rooted = staged(rooted.select("node", "first_id", F.coalesce("root", "node").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = rooted.join(least, "root").select("node", "root", "component_id")
    by_mark = marked.select("mark", "node").distinct().join(known, "node")
    return smallest_of_each(docs, mark, by_mark.select(F.col("mark").alias("print"), "root", "component_id"))

"""SimHash near-duplicates by pivot distance tables.

1. Fingerprint: 64 bits, each the majority of that bit over the XXH64 of all 3-word shingles.
2. Equal fingerprints become one class, aggregated on the map side: copies cost nothing further.
3. Candidates: fingerprints that differ in at most 2 of 64 bits agree on at least 2 of 4 segments, so
   each distinct fingerprint is dealt under 6 keys. A key with more than ``CELL`` fingerprints is dealt
   again under 3 parts of the bits it leaves open, one of which must agree, until 2**open bits is below
   the bound: the cells are exact and bounded, whatever the data.
4. In a cell every fingerprint has a row of Hamming distances to ``PIVOTS`` reference fingerprints. By
   the triangle inequality a pair whose rows differ by more than 2 in some coordinate is no link; the
   surviving pairs are verified bit by bit. Of the links of a cell only a spanning forest leaves it.
5. Components of the links: alternating large and small stars, written to the shared folder per round.

That is op6, as contracted. Sets of shingles whose similarity is only 0.8 differ in some 15 % of the bits: for them
(``copies``) there are ``WORDS`` words of fingerprint, segments of the width that the data asks for, and pivots that are
members of the cell, since fingerprints of their own never lie far enough apart to prune at such a radius.

Defined results: NULL and empty texts have fingerprint zero and link like any other; a component's id is
its smallest doc_id that is not NULL, NULL if there is none; repeated rows stay, one result row each;
columns other than ``doc_id`` and ``text`` are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table

SEED = 42
SHINGLE = 3
RADIUS = 2
#: Reference fingerprints of the distance table.
PIVOTS = 16
#: Distinct fingerprints compared in one cell at most.
CELL = 2048
#: Pairs held in memory at once.
PAIRS = 1 << 20
#: Words of 64 bits of a wide fingerprint.
WORDS = 16
SALTS = np.array([xxhash.xxh64_intdigest(f"word {i}".encode(), SEED) for i in range(WORDS)], np.uint64)
#: Members of a cell for each member that is taken as its pivot, up to PIVOTS.
SHARE = 64


def fingerprint_of(text: str) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = text.encode().lower().split()  # of bytes: lower-cases A-Z only, splits at ASCII white space
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= SHINGLE:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        start = np.cumsum(size) - size
        end = (start + size - 1)[SHINGLE - 1 :]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED) for a, b in zip(start.tolist(), end.tolist())]
    values = np.array(hashes, np.uint64).astype(">u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(values), 1 << 14):
        ones += np.unpackbits(values[at : at + (1 << 14)].view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(values))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprint(text: Column) -> Column:
    @F.arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array((fingerprint_of(t.as_py() or "") for t in batch), pa.int64())

    return run(text)


def pivots(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: hashes of their numbers."""
    return np.array([xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(count)], np.uint64)


def wide_print(own: np.ndarray) -> np.ndarray:
    """The ``WORDS`` words of a set of hashes: each bit the majority of that bit over the mixed hashes."""
    ones = np.zeros(64 * WORDS, np.int64)
    for at in range(0, len(own), 128):
        z = own[at : at + 128, None] ^ SALTS
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
        ones += np.unpackbits(z.view(np.uint8), axis=1).sum(0, dtype=np.uint8)  # 128 rows fit in a byte
    return np.packbits(2 * ones > len(own)).view(np.uint64)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of each row of ``a`` and each of ``b``."""
    total = np.zeros((len(a), len(b)), np.int16)
    for word in range(a.shape[1]):
        total += np.bitwise_count(a[:, None, word] ^ b[None, :, word])
    return total


def pivot_table(prints: np.ndarray, count: int) -> tuple[list[int], np.ndarray]:
    """The members taken as pivots, each the one farthest from those before it, and all distances to them."""
    chosen, columns = [], []
    least = np.full(len(prints), np.iinfo(np.int16).max, np.int16)
    for _ in range(count):
        chosen.append(int(least.argmax()) if chosen else 0)
        columns.append(_distances(prints, prints[chosen[-1:]])[:, 0])
        least = np.minimum(least, columns[-1])
    return chosen, np.stack(columns, 1) if columns else np.zeros((len(prints), 0), np.int16)


def near_pairs(prints: np.ndarray, radius: np.ndarray, apart: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of a cell's pairs that differ in at most ``radius`` bits (the larger of the two) and in ``apart``, in
    parts. ``apart`` is read anew for each part: places that the caller has joined since are not compared again.

    Pairs with a pivot are read off the table. Of the others those are compared bit by bit whose rows
    differ by no more than the radius anywhere: by the triangle inequality the rest is farther apart."""
    n = len(prints)
    chosen, rows = pivot_table(prints, min(PIVOTS, n // SHARE))
    for place, row in zip(chosen, rows.T):
        y = np.flatnonzero((row <= np.maximum(radius, radius[place])) & (apart != apart[place]))
        if len(y):
            yield np.full(len(y), place), y
    widest = int(radius.max())
    # neighbours in this order have like rows, so that whole blocks are far from others
    order = np.lexsort((rows.min(1), rows.argmin(1), apart)) if chosen else np.arange(n)
    step = max(1, min(PAIRS // n, SHARE))
    for low in range(0, n, step):
        x, y = order[low : low + step], order[low:]
        if chosen:
            near = (rows[y] >= rows[x].min(0) - widest) & (rows[y] <= rows[x].max(0) + widest)
            behind = np.arange(low, n)[near.all(1)]
        else:
            behind = np.arange(low, n)
        if (apart[x] == apart[x[0]]).all():
            behind = behind[apart[order[behind]] != apart[x[0]]]
        y = order[behind]
        if not len(y):
            continue
        differ = _distances(prints[x], prints[y]).reshape(-1)
        found = np.flatnonzero(differ <= widest)
        i, j = np.divmod(found, len(y))
        fine = (behind[j] > low + i) & (apart[x[i]] != apart[y[j]]) & (differ[found] <= np.maximum(radius[x[i]], radius[y[j]]))
        if fine.any():
            yield x[i[fine]], y[j[fine]]


def joined(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Gives the components that the pairs join the smallest of their labels, in place."""
    n = len(label)
    a, b = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
    a, b = np.divmod(np.unique(a[a != b] * n + b[a != b]), n)
    least = np.arange(n)
    while len(a):
        before = least.copy()
        np.minimum.at(least, a, least[b])
        np.minimum.at(least, b, least[a])
        least = least[least]
        if (least == before).all():
            break
    label[:] = least[label]


def links_in_cells(start: np.ndarray, size: np.ndarray, prints: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Links (fingerprint, smallest fingerprint joined to it in its cell) over cells of ``prints``."""
    reference = pivots(PIVOTS)
    out = []
    # cells are taken together while their pairs fit in memory
    pairs_of = size * (size - 1) // 2
    ends = np.searchsorted(np.cumsum(pairs_of), np.arange(PAIRS, int(pairs_of.sum()) + PAIRS, PAIRS), side="right")
    low = 0
    for high in np.unique(np.r_[ends, len(size)]):
        if high <= low:
            continue
        s, n = start[low:high], size[low:high]
        low = high
        rows = np.concatenate([np.arange(a, a + k) for a, k in zip(s.tolist(), n.tolist())])
        member = prints[rows]
        place = np.arange(len(rows))
        last = np.repeat(np.cumsum(n), n)  # one behind the cell of each row
        more = last - place - 1
        left = np.repeat(place, more)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(more) - more, more)
        for p in reference:  # the table's columns, one at a time: later ones see survivors only
            if not len(left):
                break
            row = np.bitwise_count(member ^ p).astype(np.int8)
            near = np.abs(row[left] - row[right]) <= radius
            left, right = left[near], right[near]
        near = np.bitwise_count(member[left] ^ member[right]) <= radius
        left, right = left[near], right[near]
        if not len(left):
            continue
        label = place.copy()
        while True:  # smallest place reached; cells are small and their links short
            before = label.copy()
            np.minimum.at(label, left, label[right])
            np.minimum.at(label, right, label[left])
            label = label[label]
            if (label == before).all():
                break
        moved = np.flatnonzero(label != place)
        out.append(np.stack([member[moved], member[label[moved]]], 1))
    return np.concatenate(out) if out else np.zeros((0, 2), np.uint64)


def _cell_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the cells in a partition sorted by ``cell``; a cell may span batches."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(cell: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        begin = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]).any(1)]) if len(cell) else np.zeros(0, int)
        size = np.diff(np.r_[begin, len(cell)])
        many = size > 1
        found = links_in_cells(begin[many], size[many], prints.view(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], schema=schema)

    rest_cell, rest_print = np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
    for batch in batches:
        cell = np.stack([np.asarray(batch.column(n), np.int64) for n in ("kind", "value")], 1)
        prints = np.asarray(batch.column("print"), np.int64)
        cell, prints = np.concatenate([rest_cell, cell]), np.concatenate([rest_print, prints])
        if not len(cell):
            continue
        cut = int(np.flatnonzero((cell != cell[-1]).any(1))[-1]) + 1 if (cell != cell[-1]).any() else 0
        yield from links(cell[:cut], prints[:cut])
        rest_cell, rest_print = cell[cut:].copy(), prints[cut:].copy()
    yield from links(rest_cell, rest_print)


def _mask(bits: range | list[int]) -> int:
    return sum(1 << b for b in bits)


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask).cast("long")


def cells(prints: DataFrame, bound: int = CELL) -> DataFrame:
    """(kind, value, print): each pair of ``print`` values within the radius meets in some cell, and no
    cell has more than ``bound`` values. ``kind`` names the bits on which a cell's members agree."""
    segments = [list(range(16 * i, 16 * i + 16)) for i in range(4)]
    agreed = [segments[i] + segments[j] for i in range(4) for j in range(i)]
    level = [(k, sorted(bits)) for k, bits in enumerate(agreed)]
    rows = prints.select("print", F.explode(F.array(*[
        F.struct(F.lit(k).cast("long").alias("kind"), F.col("print").bitwiseAND(_signed(_mask(bits))).alias("value"))
        for k, bits in level
    ])).alias("c")).select("c.kind", "c.value", "print")
    done = None
    while True:
        open_bits = 64 - min(len(bits) for _, bits in level)
        if 1 << open_bits <= bound:
            return rows if done is None else done.unionByName(rows)
        rows = staged(rows, "cells")
        hot = staged(rows.groupBy("kind", "value").count().filter(F.col("count") > bound).select("kind", "value"), "hot")
        if hot.isEmpty():
            return rows if done is None else done.unionByName(rows)
        cool = rows.join(hot, ["kind", "value"], "left_anti")
        done = cool if done is None else done.unionByName(cool)
        deeper, parts = [], None
        for kind, bits in level:
            left = [b for b in range(64) if b not in bits]
            third = -(-len(left) // 3)
            for i in range(3):
                deeper.append((kind * 3 + i + 1000, sorted(bits + left[i * third : (i + 1) * third])))
        masks = F.create_map(*[x for k, b in deeper for x in (F.lit(k).cast("long"), _signed(_mask(b)))])
        parts = F.explode(F.array(*[F.col("kind") * 3 + i + 1000 for i in range(3)]))
        rows = rows.join(hot, ["kind", "value"], "left_semi").select("print", parts.alias("kind"))
        rows = rows.select("kind", F.col("print").bitwiseAND(masks[F.col("kind")]).alias("value"), "print")
        level = deeper


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) but the roots: root is the smallest node joined."""
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = staged(edges, "edges")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = staged(large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        # each node links its smallest neighbour, and each other neighbour links that one too
        moved = large.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small")
        total = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if tuple(total) == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(total)


def link_prints(prints: DataFrame, bound: int = CELL) -> DataFrame:
    """Spanning links (a, b) between distinct values of ``print``."""
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cells(prints, bound).repartition(parts, "kind", "value").sortWithinPartitions("kind", "value")
    return dealt.mapInArrow(_cell_links, "a long, b long")


def classes(docs: DataFrame, bound: int = CELL) -> tuple[DataFrame, DataFrame]:
    """(doc_id, print) of every row, and (print, root, component_id) of every distinct fingerprint."""
    marked = staged(docs.select("doc_id", fingerprint(F.col("text")).alias("print")), "prints")
    first = staged(marked.groupBy("print").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = components(link_prints(first.select("print"), bound))
    rooted = first.join(roots.withColumnRenamed("node", "print"), "print", "left")
    rooted = staged(rooted.select("print", "first_id", F.coalesce("root", "print").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return marked, rooted.join(least, "root").select("print", "root", "component_id")


def near_duplicates(docs: DataFrame, bound: int = CELL) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row."""
    marked, known = classes(docs, bound)
    return marked.join(known, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, bound: int = CELL) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their component; of repeated rows any one."""
    _, known = classes(docs, bound)
    return smallest_of_each(docs, fingerprint(F.col("text")), known)


def smallest_of_each(docs: DataFrame, print_of: Column, known: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the component_id of their print in ``known`` (print, root, component_id)."""
    names = docs.columns
    known = staged(known, "known")
    mark = docs.select(F.struct(*names).alias("row"), print_of.alias("print"))
    kept = mark.join(known, "print").filter(F.col("row.doc_id").eqNullSafe(F.col("component_id")))
    # several rows of one id in one component, which ids alone can't part
    groups = staged(kept.groupBy("root").count().filter("count > 1").select("root"), "repeats")
    if groups.isEmpty():
        return kept.select(*[F.col("row")[n].alias(n) for n in names])
    again = kept.join(groups, "root", "left_semi").dropDuplicates(["root"])
    single = kept.join(groups, "root", "left_anti")
    return single.unionByName(again).select(*[F.col("row")[n].alias(n) for n in names])


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))

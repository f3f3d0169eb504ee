"""Edit-aware token counts: stored segment trees of pre-token runs, one per document.

The text is cut into leaves at places where a pre-token starts in whatever text stands around: before a
space that follows a sign which is no white space and is followed by a letter. A leaf is the run of
pre-tokens up to the first such place after ``LEAF`` characters; its tokens don't depend on its
neighbours. ``built`` encodes a table of documents once and writes, in the shared folder, a row per document: its leaves and a
tree, that is the ids of the leaves in order and, in heap order, the characters and tokens below every node.

``edited`` applies a table of edits to such a store. An edit finds its leaves by descending the character
sums. The leaves it touches are a block, with the neighbour on a side where it reaches the signs that make the boundary (a
broken boundary ends there at the latest); edits that meet are one block. Only the texts of blocks leave the JVM;
inside a block only touched leaves, and a neighbour whose boundary broke, are encoded again. What they become is written as
new leaves in a layer of its own, other leaves keep their ids and stay where they are; trees get the new ids and the sums
on the way to the root, or, if the number of leaves changes, sums made again from leaf sums, without encoding. The layers
are a store again.

Defined results: NULL reads as empty; an empty text has one empty leaf and no tokens; edits apply in the
order of their list, each to the text that the former left; positions before the start or NULL mean the start, beyond the
end the end; NULL lists, and rows without edits, change nothing; every row has a tree of its own, so repeated rows are
counted alike and NULL ids are ids like others; columns not asked to be kept are not read.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sliced, staged, table

LEAF = 512
#: A pre-token starts at the space of such a place, whatever stands around.
_CUT = re.compile(r"(?<=\S)(?= [^\W\d_])")
EDIT = "array<struct<start:int,end:int,text:string>>"
TREE = "struct<ids:array<long>,chars:array<long>,tokens:array<long>>"
MADE = f"struct<tree:{TREE},leaves:array<struct<id:long,text:string,tokens:long>>,encoded_chars:long,encoded_leaves:long>"
BLOCKS = f"array<struct<first:int,last:int,edits:{EDIT}>>"
#: Bits of a leaf's id below its generation.
GENERATION = 40


@functools.lru_cache(maxsize=2)
def encoder(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def leaves_of(text: str, size: int = LEAF) -> list[str]:
    out, at = [], 0
    while len(text) - at > size:
        m = _CUT.search(text, at + size)
        if m is None:
            break
        out.append(text[at : m.start()])
        at = m.start()
    out.append(text[at:])
    return out


class Sums:
    """Sums in heap order over a row of numbers: node i has the children 2i and 2i + 1."""

    def __init__(self, values: list[int]) -> None:
        self.size = len(values)
        self.width = 1
        while self.width < self.size:
            self.width *= 2
        self.heap = [0] * (2 * self.width)
        self.heap[self.width : self.width + self.size] = values
        for i in range(self.width - 1, 0, -1):
            self.heap[i] = self.heap[2 * i] + self.heap[2 * i + 1]

    @classmethod
    def stored(cls, heap: list[int], size: int) -> Sums:
        sums = cls.__new__(cls)
        sums.heap, sums.size, sums.width = list(heap), size, len(heap) // 2
        return sums

    @property
    def total(self) -> int:
        return self.heap[1]

    @property
    def values(self) -> list[int]:
        return self.heap[self.width : self.width + self.size]

    def find(self, place: int) -> tuple[int, int]:
        """Number that holds the ``place``, as counted by the sums (the last one at the end), and where it starts."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if place >= start + self.heap[node] and self.heap[node + 1] > 0:
                start += self.heap[node]
                node += 1
        return min(node - self.width, self.size - 1), start

    def replaced(self, first: int, last: int, values: list[int]) -> Sums:
        """Sums with other numbers from ``first`` to ``last``: along the paths if their count stays, else made again."""
        if len(values) != last + 1 - first:
            own = self.values
            return Sums(own[:first] + values + own[last + 1 :])
        for place, value in enumerate(values, first):
            node = self.width + place
            more = value - self.heap[node]
            while node:
                self.heap[node] += more
                node //= 2
        return self


class Tree:
    """Leaves and the sums over them; only what is new to it is encoded. ``old``: places of leaves that were there at first."""

    def __init__(self, leaves: list[str], tokens: list[int], count: Callable[[str], int]) -> None:
        self.count, self.leaves = count, leaves
        self.old: list[int | None] = list(range(len(leaves)))
        self.chars, self.tokens = Sums([len(p) for p in leaves]), Sums(tokens)
        self.encoded_chars, self.encoded_leaves = 0, 0

    @classmethod
    def of(cls, text: str, count: Callable[[str], int]) -> Tree:
        leaves = leaves_of(text)
        return cls(leaves, [count(p) for p in leaves], count)

    @property
    def total(self) -> int:
        return self.tokens.total

    @property
    def length(self) -> int:
        return self.chars.total

    def edit(self, start: int, end: int, text: str) -> None:
        """Replaces the characters from ``start`` to ``end``."""
        start, end = clamped(start, end, self.length)
        first, begin = self.chars.find(start)
        last, _ = self.chars.find(end)
        new = "".join(self.leaves[first : last + 1])
        new = new[: start - begin] + text + new[end - begin :]
        # context: a border holds only while a pre-token is sure to start there
        while first > 0 and not _CUT.match(self.leaves[first - 1][-1:] + new[:2], 1):
            first -= 1
            new = self.leaves[first] + new
        while last + 1 < len(self.leaves) and not _CUT.match(new[-1:] + self.leaves[last + 1][:2], 1):
            last += 1
            new += self.leaves[last]
        parts = leaves_of(new)
        self.encoded_chars += len(new)
        self.encoded_leaves += len(parts)
        self.leaves[first : last + 1], self.old[first : last + 1] = parts, [None] * len(parts)
        self.chars = self.chars.replaced(first, last, [len(p) for p in parts])
        self.tokens = self.tokens.replaced(first, last, [self.count(p) for p in parts])


def clamped(start: int, end: int, length: int) -> tuple[int, int]:
    start = max(0, min(start, length))
    return start, max(start, min(end, length))


def listed(edits: list[dict] | None) -> list[tuple[int, int, str]]:
    return [(e["start"] or 0, e["end"] or 0, e["text"] or "") for e in edits or [] if e]


def blocks_of(chars: Sums, edits: list[tuple[int, int, str]]) -> list[dict]:
    """Blocks of leaves that edits touch, with the edits as places in the block."""
    # parts of the text: first leaf, last leaf, characters before the edits, edits within
    parts = [(i, i, n, []) for i, n in enumerate(chars.values)]
    sums = Sums.stored(chars.heap, chars.size)
    for start, end, text in edits:
        start, end = clamped(start, end, sums.total)
        (first, begin), (last, last_begin) = sums.find(start), sums.find(end)
        sizes = sums.values
        # a boundary is the sign before it and the two after it
        if first > 0 and start < begin + 2:
            first -= 1
        if last + 1 < sums.size and end >= last_begin + sizes[last]:
            last += 1
        begin, met, own, at = sum(sizes[:first]), parts[first : last + 1], [], sum(p[2] for p in parts[first : last + 1])
        # parts edited before do not touch each other: from the last one on, no edit moves one still to come
        for part in reversed(met):
            at -= part[2]
            own += [(s + at, e + at, t) for s, e, t in part[3]]
        own.append((start - begin, end - begin, text))
        parts[first : last + 1] = [(met[0][0], met[-1][1], sum(p[2] for p in met), own)]
        sums = sums.replaced(first, last, [sum(sizes[first : last + 1]) + len(text) - (end - start)])
    return [
        {"first": a, "last": b, "edits": [{"start": s, "end": e, "text": t} for s, e, t in own]} for a, b, _, own in parts if own
    ]


@dataclass(frozen=True)
class Store:
    """``layers``, one per generation, a row per document: row id ``row``, the kept columns as ``kept``, ``tree``, the
    ``leaves`` that this generation has made, and what that took: ``n_before`` tokens before, ``encoded_chars``,
    ``encoded_leaves``. The trees of the last layer hold; leaves that none of them names are left over."""

    layers: tuple[DataFrame, ...]
    path: str
    pattern: str

    def totals(self) -> DataFrame:
        """n_tokens, n_chars, n_leaves and the columns of the last layer but tree and leaves: no text is read."""
        last = self.layers[-1]
        names = [F.col(c) for c in last.columns if c not in ("tree", "leaves")]
        return last.select(
            *names, F.get("tree.tokens", F.lit(1)).alias("n_tokens"), F.get("tree.chars", F.lit(1)).alias("n_chars"),
            F.size("tree.ids").cast("long").alias("n_leaves"),
        )

    def whole(self) -> DataFrame:
        """row, kept, tree and all leaves. One layer is read as it lies; more are joined by row."""
        out = self.layers[-1].select("row", "kept", "tree", "leaves")
        for n, layer in enumerate(self.layers[:-1]):
            out = out.join(layer.select("row", F.col("leaves").alias(f"leaves{n}")), "row")
        older = [F.col(f"leaves{n}") for n in range(len(self.layers) - 1)]
        return out.select("row", "kept", "tree", F.concat(*older, F.col("leaves")).alias("leaves"))


_TREE = pa.struct([(n, pa.list_(pa.int64())) for n in ("ids", "chars", "tokens")])
_LEAVES = pa.list_(pa.struct([("id", pa.int64()), ("text", pa.string()), ("tokens", pa.int64())]))
_EDITS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))
_BLOCKS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("edits", _EDITS)]))
_MADE = pa.struct([("tree", _TREE), ("leaves", _LEAVES), ("encoded_chars", pa.int64()), ("encoded_leaves", pa.int64())])


def _rows(kind: pa.DataType, own: Callable[..., list], *arrays: pa.Array) -> pa.Array:
    """What ``own`` makes of the values of some columns, part by part of the first one's bytes."""
    out, at = [pa.array([], kind)], 0
    for part in sliced(arrays[0], 1 << 22):
        out.append(pa.array([own(*row) for row in zip(*[a.slice(at, len(part)).to_pylist() for a in arrays])], kind))
        at += len(part)
    return pa.concat_arrays(out)


def _cut(text: Column, path: str, pattern: str) -> Column:
    """Tree and leaves of whole texts, encoded."""

    @F.arrow_udf(MADE)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder(path, pattern).encode_ordinary

        def one(text: str | None) -> dict:
            tree = Tree.of(text or "", lambda p: len(encode(p)))
            leaves = [{"id": i, "text": p, "tokens": n} for i, (p, n) in enumerate(zip(tree.leaves, tree.tokens.values))]
            sums = {"ids": list(range(len(leaves))), "chars": tree.chars.heap, "tokens": tree.tokens.heap}
            return {"tree": sums, "leaves": leaves, "encoded_chars": tree.length, "encoded_leaves": len(leaves)}

        for batch in batches:
            yield _rows(_MADE, one, batch)

    return run(text)


def _planned(tree: Column, edits: Column) -> Column:
    """Blocks that edits touch."""

    @F.arrow_udf(BLOCKS)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch, changes in batches:
            yield _rows(_BLOCKS, lambda t, e: blocks_of(Sums.stored(t["chars"], len(t["ids"])), listed(e)), batch, changes)

    return run(tree, edits)


def _mended(blocks: Column, tree: Column, generation: int, path: str, pattern: str) -> Column:
    """Trees after the edits of their blocks, which hold their leaves, and the leaves that are new."""

    @F.arrow_udf(MADE)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        encode = encoder(path, pattern).encode_ordinary

        def one(blocks: list[dict], old: dict) -> dict:
            ids, fresh, chars_encoded, leaves_encoded = old["ids"], [], 0, 0
            chars, tokens = Sums.stored(old["chars"], len(ids)), Sums.stored(old["tokens"], len(ids))
            # from the last block on, so that the places of those before it stay
            for b in reversed(blocks):
                first, last = b["first"], b["last"]
                part = Tree([x["text"] for x in b["leaves"]], [x["tokens"] for x in b["leaves"]], lambda p: len(encode(p)))
                for change in listed(b["edits"]):
                    part.edit(*change)
                now = []
                for text, n, place in zip(part.leaves, part.tokens.values, part.old):
                    if place is None:
                        now.append(generation << GENERATION | len(fresh))
                        fresh.append({"id": now[-1], "text": text, "tokens": n})
                    else:
                        now.append(ids[first + place])
                ids[first : last + 1] = now
                chars = chars.replaced(first, last, part.chars.values)
                tokens = tokens.replaced(first, last, part.tokens.values)
                chars_encoded += part.encoded_chars
                leaves_encoded += part.encoded_leaves
            sums = {"ids": ids, "chars": chars.heap, "tokens": tokens.heap}
            return {"tree": sums, "leaves": fresh, "encoded_chars": chars_encoded, "encoded_leaves": leaves_encoded}

        for batch, trees in batches:
            yield _rows(_MADE, one, batch, trees)

    return run(blocks, tree)


def built(docs: DataFrame, path: str, pattern: str, keep: list[str]) -> Store:
    """The store of ``docs``, with the columns ``keep`` beside each tree: every text is encoded once."""
    made = docs.select(F.struct(*keep).alias("kept"), _cut(F.col("text"), path, pattern).alias("made"))
    layer = made.select(F.monotonically_increasing_id().alias("row"), "kept", F.lit(0).cast("long").alias("n_before"), "made.*")
    return Store((staged(layer, "trees"),), path, pattern)


def edited(store: Store, edits: DataFrame | Column) -> Store:
    """The store after edits: a list for each tree, a table (row, edits) with one row per tree at most, or a column over the
    store's own columns, which needs no join. Few edits are broadcast where Spark measures them as few."""
    docs = store.whole()
    if isinstance(edits, DataFrame):
        docs = docs.join(edits.select("row", F.col("edits").alias("edits")), "row", "left")
    else:
        docs = docs.withColumn("edits", edits)
    docs = docs.withColumn("blocks", _planned(F.col("tree"), F.col("edits")))

    def leaves(block: Column) -> Column:
        ids = F.slice("tree.ids", block["first"] + 1, block["last"] - block["first"] + 1)
        return F.transform(ids, lambda i: F.get("leaves", (F.array_position("leaves.id", i) - 1).cast("int")))

    blocks = F.transform(
        "blocks",
        lambda b: F.struct(b["first"].alias("first"), b["last"].alias("last"), b["edits"].alias("edits"), leaves(b).alias("leaves")),
    )
    made = _mended(blocks, F.col("tree"), len(store.layers), store.path, store.pattern)
    layer = docs.select("row", "kept", F.get("tree.tokens", F.lit(1)).alias("n_before"), made.alias("made"))
    layer = staged(layer.select("row", "kept", "n_before", "made.*"), "trees")
    return Store((*store.layers, layer), store.path, store.pattern)


def derived_edits(text: Column, lang: Column, source: Column) -> Column:
    """Three edits that follow from the document: its source put in front of a place, a stretch taken
    out, a stretch replaced by its language. Places come from the text's hash."""
    size = F.length(F.coalesce(text, F.lit("")))

    def place(salt: int) -> Column:
        return F.pmod(F.xxhash64(text, F.lit(salt)), F.greatest(size, F.lit(1)).cast("long")).cast("int")

    def change(start: Column, length: int, new: Column) -> Column:
        return F.struct(start.alias("start"), (start + length).alias("end"), F.coalesce(new, F.lit("")).alias("text"))

    return F.array(
        change(place(1), 0, F.concat(F.lit(" "), source)), change(place(2), 24, F.lit("")), change(place(3), 9, lang)
    )


def op5_segtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    docs = docs.withColumn("edits", derived_edits(F.col("text"), F.col("lang"), F.col("source")))
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    store = built(docs, path, public_tokenizers.PATTERN, ["doc_id", "edits"])
    after = edited(store, F.col("kept.edits"))
    return after.totals().select(
        "kept.doc_id", F.col("n_before").alias("before"), F.col("n_tokens").alias("after"), F.col("n_chars").alias("chars_after"),
        F.col("n_leaves").alias("leaves"), F.col("encoded_chars").alias("reencoded_chars"), "encoded_leaves",
    )

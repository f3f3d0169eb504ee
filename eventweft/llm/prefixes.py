"""A trie of conversation prefixes by ROLLUP over positional turn columns.

1. Turns get their place in the conversation by a range sort over all turns and one count per conversation and
   range; a conversation may span many ranges. A turn is named by 128 bits of the SHA-256 of its role and text,
   with the text's code points; texts go no further.
2. Conversations are rebuilt: some start with the first turns of another one.
3. Blocks: ``WIDTH`` turns of a conversation are the columns t1, t2, ... of one row. A block's key names the node in
   which the prior block ends: the XOR of two 64-bit hashes of (place, turn) over all turns before, which needs
   no order and so no walk along the conversation.
4. ROLLUP over (key, t1, t2, ...) makes all prefixes of all blocks together; grouping_id tells the depth. Rows
   whose last column is empty though not rolled up are conversations that ended before, no nodes.
5. Sums over subtrees: a node's own share is given to its smallest member, at its depth. Summed from the end of
   each conversation, and over a node's members by a second ROLLUP, the shares are those of its subtree.
6. Ends: ids that end in a node are sorted by ranges, joined to texts of ``IDS`` ids in tasks, and these are
   fed to one SHA-256 per node in order, which holds no more than a text at a time.

Windows run within ``CHUNK`` blocks of one conversation, and over the chunks of one conversation, one narrow row
for each CHUNK * WIDTH turns. Joins on a node with very many children are split by adaptive execution.

Defined results: turns with equal or NULL numbers are ordered NULL first, then by the hash that names them; repeated rows
are turns of their own; NULL roles and texts read as empty; rows without conv_id are no conversation;
a conversation without turns is a member of the root alone, where it ends; an empty table has no nodes; other columns
are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import record_batch, staged, table
from .variants import crc32_sql

#: Turn columns of one block.
WIDTH = 8
#: Blocks of a conversation that one window holds.
CHUNK = 512
#: Ids in one piece of text.
IDS = 400
#: Conversations whose first turns may be shared, and how many turns at most.
FAMILY, SHARED = 100, 5

TURN = "struct<id:binary,chars:int>"
COLUMNS = [f"t{i + 1}" for i in range(WIDTH)]
NODE = ["depth", "n1", "n2"]


def named_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, id, chars)"""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    name = F.unhex(F.substring(whole, 1, 32))
    return turns.filter("conv_id IS NOT NULL").select("conv_id", "turn", name.alias("id"), F.char_length(text).alias("chars"))


def sequences(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, part, at, id, chars) with the place ``at`` within a range, and (conv_id, part, n, before) per range."""
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("id")]
    ranged = named_turns(turns).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    number = F.monotonically_increasing_id()
    seen = staged(ranged.select("conv_id", "id", "chars", number.alias("at")), "turns").withColumn("part", F.shiftright("at", 33))
    spans = seen.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return seen, staged(spans.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "spans")


def plain(spans: DataFrame) -> DataFrame:
    """(conv_id, own_from, base, given) for conversations as they are."""
    return spans.select("conv_id").distinct().select("conv_id", F.lit(0).alias("own_from"), F.col("conv_id").alias("base"), F.lit(0).alias("given"))


def rebuilt(spans: DataFrame) -> DataFrame:
    """As ``plain``: of each conversation the first turns are those of the first one of its family."""
    totals = spans.groupBy("conv_id").agg(F.sum("n").alias("total"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (SHARED + 1)).cast("int")
    own = totals.select("conv_id", h.alias("own_from"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    bases = totals.select(F.col("conv_id").alias("base"), F.least("total", F.lit(SHARED)).cast("int").alias("has"))
    own = own.join(bases.filter(F.col("base") % FAMILY == 0), "base", "left")
    return own.select("conv_id", "own_from", "base", F.least("own_from", F.coalesce("has", F.lit(0))).alias("given"))


def places(seen: DataFrame, spans: DataFrame, start: DataFrame) -> DataFrame:
    """(conv_id, place from 1, turn) of the conversations that ``start`` describes; place 0 for each conversation."""
    start = staged(start, "start")
    spans = spans.join(start, "conv_id")
    rows = seen.join(spans.drop("n"), ["conv_id", "part"])
    rows = rows.select(
        "conv_id", (F.col("before") + F.col("at") - F.col("first") + 1).alias("old"), "own_from", "given", F.struct("id", "chars").alias("turn")
    )
    own = rows.filter("old > own_from").select("conv_id", (F.col("given") + F.col("old") - F.col("own_from")).alias("place"), "turn")
    heads = rows.filter(f"old <= {SHARED} and conv_id % {FAMILY} = 0").select(F.col("conv_id").alias("base"), F.col("old").alias("place"), "turn")
    given = start.filter("given > 0").join(heads, "base").filter("place <= given").select("conv_id", "place", "turn")
    empty = start.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit(None).cast(TURN).alias("turn"))
    return own.unionByName(given).unionByName(empty)


def lane(seed: int, place: Column, turn: Column) -> Column:
    """Hash of a turn at its place; 0 where there is none."""
    return F.when(turn.isNotNull(), F.xxhash64(F.lit(seed), place.cast("long"), turn["id"])).otherwise(F.lit(0).cast("long"))


def _before(rows: DataFrame, sums: dict[str, Column], names: list[str], order: Column, chunk_order: Column) -> DataFrame:
    """Adds, for each name, the aggregate ``sums`` over the rows of the same conversation before this one, NULL if
    there is none: within the chunk, and over chunks."""
    inner = Window.partitionBy("conv_id", "chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("conv_id").orderBy(chunk_order).rowsBetween(Window.unboundedPreceding, -1)
    chunks = rows.groupBy("conv_id", "chunk").agg(*[sums[n].alias(f"all_{n}") for n in names])
    far = chunks.select("conv_id", "chunk", *[a.over(outer).alias(f"far_{n}") for n, a in ((n, _again(sums[n], n)) for n in names)])
    far = far.filter(" or ".join(f"far_{n} is not null" for n in names))
    near = rows.select("*", *[sums[n].over(inner).alias(f"near_{n}") for n in names])
    return near.join(far, ["conv_id", "chunk"], "left")


def _again(total: Column, name: str) -> Column:
    return F.bit_xor(f"all_{name}") if name.startswith("x") else F.sum(f"all_{name}")


def blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, chunk, block, k1, k2, x1, x2, filled, t1, t2, ...)"""
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.greatest(F.col("place") - 1, F.lit(0))
    rows = turns.select(
        "conv_id", F.expr(f"greatest(place - 1, 0) div {WIDTH * CHUNK}").alias("chunk"), F.expr(f"greatest(place - 1, 0) div {WIDTH}").alias("block"),
        (at % WIDTH).cast("int").alias("slot"), "turn", lane(1, F.col("place"), F.col("turn")).alias("x1"), lane(2, F.col("place"), F.col("turn")).alias("x2"),
    )
    rows = rows.repartition(parts, "conv_id", "chunk").groupBy("conv_id", "chunk", "block").agg(
        F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.count("turn").alias("filled"),
        *[F.max(F.when(F.col("slot") == i, F.col("turn"))).alias(c) for i, c in enumerate(COLUMNS)],
    )
    rows = staged(rows, "slots")
    rows = _before(rows, {"x1": F.bit_xor("x1"), "x2": F.bit_xor("x2")}, ["x1", "x2"], F.col("block"), F.col("chunk"))
    zero = F.lit(0).cast("long")
    keys = [F.coalesce(f"near_x{i}", zero).bitwiseXOR(F.coalesce(f"far_x{i}", zero)).alias(f"k{i}") for i in (1, 2)]
    return staged(rows.select("conv_id", "chunk", "block", *keys, "x1", "x2", "filled", *COLUMNS), "blocks")


def _nodes_of(grouped: DataFrame) -> DataFrame:
    """The nodes among the rows of a ROLLUP over (key, t1, ...) with ``rolled``, its grouping_id: adds depth, n1 and
    n2 (the node) and p1 and p2 (its parent), level and last (its last turn)."""
    level = (F.lit(WIDTH) - F.bit_count("rolled")).cast("int")
    rows = grouped.filter(F.col("rolled") < 1 << WIDTH).withColumn("level", level)
    rows = rows.withColumn("last", F.get(F.array(*COLUMNS), F.col("level") - 1))
    rows = rows.filter((F.col("level") > 0) & F.col("last").isNotNull() | (F.col("level") == 0) & (F.col("key.block") == 0))
    first = F.col("key.block") * WIDTH
    out = rows.withColumn("depth", first + F.col("level"))
    for i in (1, 2):
        hashes = [lane(i, first + k + 1, F.col(c)) for k, c in enumerate(COLUMNS)]
        out = out.withColumn(f"n{i}", functools.reduce(lambda a, b: a.bitwiseXOR(b), hashes, F.col(f"key.k{i}")))
        out = out.withColumn(f"p{i}", F.col(f"n{i}").bitwiseXOR(lane(i, F.col("depth"), F.col("last"))))
    return out


def _rolled(rows: DataFrame, *sums: Column) -> DataFrame:
    keyed = rows.withColumn("key", F.struct("block", "k1", "k2"))
    return _nodes_of(keyed.rollup("key", *COLUMNS).agg(F.grouping_id().alias("rolled"), *sums))


def nodes(block: DataFrame) -> DataFrame:
    """depth, n1, n2, conv_id, parent_conv_id, n_convs, n_children, chars of every node."""
    rows = _rolled(block, F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    rows = rows.select(*NODE, "p1", "p2", "conv_id", "n_convs", F.coalesce("last.chars", F.lit(0)).cast("long").alias("chars"))
    rows = staged(rows, "nodes")
    below = rows.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("n1"), F.col("p2").alias("n2"))
    rows = rows.join(below.agg(F.count("*").alias("n_children")), NODE, "left")
    parents = rows.select((F.col("depth") + 1).alias("depth"), F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    rows = staged(rows.withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "children")
    return staged(rows.join(parents, ["depth", "p1", "p2"], "left").drop("p1", "p2"), "family")


def subtrees(block: DataFrame, node: DataFrame) -> DataFrame:
    """depth, n1, n2, n_leaves, saved_tokens of every node."""
    own = {"leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("chars")}
    slot = F.when(F.col("depth") == 0, 0).otherwise((F.col("depth") - 1) % WIDTH + 1)
    shares = node.select("conv_id", F.expr(f"greatest(depth - 1, 0) div {WIDTH}").alias("block"), slot.alias("slot"), *[c.alias(n) for n, c in own.items()])
    shares = shares.groupBy("conv_id", "block").agg(*[
        F.sum(F.when(F.col("slot") == i, F.col(n)).otherwise(0)).alias(f"{n}{i}") for n in own for i in range(WIDTH + 1)
    ])
    rows = block.join(shares, ["conv_id", "block"], "left")
    zero = F.lit(0).cast("long")
    rows = rows.select(
        "conv_id", "chunk", "block", "k1", "k2", *COLUMNS, *[F.coalesce(f"{n}{i}", zero).alias(f"{n}{i}") for n in own for i in range(WIDTH + 1)]
    )
    for n in own:
        rows = rows.withColumn(n, functools.reduce(lambda a, b: a + b, [F.col(f"{n}{i}") for i in range(WIDTH + 1)]))
    rows = staged(rows, "shares")
    rows = _before(rows, {n: F.sum(n) for n in own}, list(own), F.col("block").desc(), F.col("chunk").desc())
    sums = []
    for n in own:
        total, ends = F.coalesce(f"near_{n}", zero) + F.coalesce(f"far_{n}", zero), []
        for i in range(WIDTH, -1, -1):
            total = total + F.col(f"{n}{i}")
            ends.append(total)
        rows = rows.withColumn(f"{n}_from", F.array(*reversed(ends)))
        sums += [F.sum(F.get(f"{n}_from", F.lit(i))).alias(f"{n}_from{i}") for i in range(WIDTH + 1)]
    rows = rows.select("block", "k1", "k2", *COLUMNS, *[f"{n}_from" for n in own])
    tree = _rolled(rows, *sums)
    at = [F.get(F.array(*[f"{n}_from{i}" for i in range(WIDTH + 1)]), F.col("level")) for n in own]
    return tree.select(*NODE, at[0].alias("n_leaves"), at[1].alias("saved_tokens"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of the ids of a node, of up to ``IDS`` ids, in a partition sorted by node and id."""

    def batch_of(rows: list) -> pa.RecordBatch:
        names = (*NODE, "first")
        return record_batch([*[(n, [r[0][i] for r in rows], pa.int64()) for i, n in enumerate(names)], ("ids", [",".join(r[1]) for r in rows], pa.string())])

    rows: list = []
    for batch in batches:
        for *node, conv in zip(*[batch.column(c).to_pylist() for c in (*NODE, "conv_id")]):
            if rows and rows[-1][0][:3] == node and len(rows[-1][1]) < IDS:
                rows[-1][1].append(str(conv))
            else:
                rows.append(([*node, conv], [str(conv)]))
        yield batch_of(rows[:-1])
        rows = rows[-1:]
    yield batch_of(rows)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's texts, in a partition sorted by node and first id."""

    def batch_of(rows: list) -> pa.RecordBatch:
        return record_batch([*[(n, [r[0][i] for r in rows], pa.int64()) for i, n in enumerate(NODE)], ("ends_sha256", [r[1] for r in rows], pa.string())])

    node, digest = None, None
    for batch in batches:
        done = []
        for *now, ids in zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids")]):
            if now == node:
                digest.update(b"," + ids.encode())
                continue
            if node is not None:
                done.append((node, digest.hexdigest()))
            node, digest = now, hashlib.sha256(ids.encode())
        yield batch_of(done)
    yield batch_of([] if node is None else [(node, digest.hexdigest())])


def ends(block: DataFrame) -> DataFrame:
    """depth, n1, n2, ends_sha256 of the nodes in which conversations end."""
    parts = int(block.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = block.groupBy("conv_id").agg(
        F.max(F.col("block") * WIDTH + F.col("filled")).alias("depth"), F.bit_xor("x1").alias("n1"), F.bit_xor("x2").alias("n2")
    )
    last = last.select(*NODE, F.col("conv_id").cast("long").alias("conv_id"))
    pieces = last.repartitionByRange(parts, *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    pieces = pieces.mapInArrow(_joined, "depth long, n1 long, n2 long, first long, ids string")
    pieces = pieces.repartition(parts, *NODE).sortWithinPartitions(*NODE, "first")
    return pieces.mapInArrow(_digests, "depth long, n1 long, n2 long, ends_sha256 string")


def trie(turns: DataFrame, start=plain) -> DataFrame:
    """One row per node; ``start`` says how conversations begin."""
    seen, spans = sequences(turns)
    block = blocks(places(seen, spans, start(spans)))
    node = nodes(block)
    out = node.join(subtrees(block, node), NODE).join(ends(block), NODE, "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def op13_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), rebuilt)


OP13_SQL = f"""
WITH t AS (SELECT conv_id, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))[:32] AS id, length(coalesce(text, '')) AS chars, turn
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'id': id, 'chars': chars}} ORDER BY turn NULLS FIRST, id) AS l FROM t GROUP BY conv_id),
h AS (SELECT conv_id, l, conv_id - conv_id % {FAMILY} AS base, ({crc32_sql("conv_id::VARCHAR")} % {SHARED + 1})::BIGINT AS h FROM own),
c AS (SELECT h.conv_id, list_concat(coalesce(b.l[1 : h.h], []), h.l[h.h + 1 :]) AS l FROM h LEFT JOIN own b ON b.conv_id = h.base),
p AS (SELECT conv_id, l, len(l) AS n, unnest(range(len(l) + 1)) AS d FROM c),
q AS (SELECT conv_id, d, n, list_transform(l[1 : d], lambda x: x.id) AS k, CASE WHEN d > 0 THEN l[d].chars ELSE 0 END AS chars FROM p),
node AS (SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256 FROM q GROUP BY d, k),
child AS (SELECT d - 1 AS d, k[1 : d - 1] AS k, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (d, k)),
up AS (SELECT *, unnest(range(d + 1)) AS a FROM full_node),
tree AS (SELECT a AS d, k[1 : a] AS k, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens FROM up GROUP BY a, k[1 : a])
SELECT n.conv_id, n.d::BIGINT AS depth, f.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM full_node n JOIN tree USING (d, k) LEFT JOIN node f ON f.d = n.d - 1 AND f.k = n.k[1 : n.d - 1]
"""

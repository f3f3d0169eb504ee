"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has one bit per dimension (is it above zero?), in one 64-bit number per 64 dimensions.
Equal codes are one row of the index, which keeps their ``k`` smallest ids: more can't be in an answer. Equal
codes among the queries are asked once. Codes and asked codes are dealt by hash to shards of about ``SHARD`` codes,
at least one per core, and to blocks of about ``BLOCK`` queries; a task gets one shard and one block.

There the codes are cut into segments of at most 16 bits and filed under each segment's value. A query starts
with radius 0 in no segment; each step lets the radius of one segment grow, in turn: it looks up the values at just
that distance from its own, verifies the whole distance of the codes filed there, and keeps a count per distance. A
code that step s has not found differs in every segment by more than its radius, so by more than s in all: the query
is done as soon as its k-th distance is at most s. A step that would look up more than ``PROBES`` values compares the query
with the whole shard instead, which is as exact. Candidates never become rows: a shard returns k rows for a query.

Defined results: answers are by (distance, id); a query finds itself and its copies like any other row;
fewer than k rows give shorter answers; repeated
rows count once; an id with several vectors asks and is found by each of them; NULL ids, NULL vectors and vectors of another length than most (of equally frequent
lengths the longest) are no rows of the index and, as queries, have no answer; other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import spread, staged, table

TOP = 10
EVERY = 100
SEGMENT_BITS = 16
#: Values that one step of a query may look up; beyond it the query is compared with its shard.
PROBES = 20_000
#: Codes and queries that meet in one task, on average.
SHARD = 1 << 16
BLOCK = 1 << 14
#: Tasks that shards and blocks are dealt to at most.
TASKS = 20_000
#: Parts of the queries that share one code when answers are given back to them.
SALTS = 16


def code(vector: Column, dims: int) -> Column:
    """Array of 64-bit numbers, bit i of them set where the dimension is above zero."""
    words = []
    for low in range(0, dims, 64):
        bits = [
            F.when(F.get(vector, F.lit(i)) > 0, F.lit(1 << (i - low) if i - low < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long"))
            for i in range(low, min(dims, low + 64))
        ]
        total = bits[0]
        for b in bits[1:]:
            total = total.bitwiseOR(b)
        words.append(total)
    return F.array(*words)


def segments(dims: int, bits: int) -> list[tuple[int, int, int]]:
    """(word, first bit, width) of each segment; none crosses a word."""
    out = []
    for low in range(0, dims, 64):
        width = min(64, dims - low)
        parts = -(-width // bits)
        size = -(-width // parts)
        out += [(low // 64, s, min(size, width - s)) for s in range(0, width, size)]
    return out


@functools.lru_cache(maxsize=None)
def masks(width: int, r: int) -> np.ndarray:
    """The numbers of ``width`` bits of which ``r`` are set."""
    numbers = np.arange(1 << width)
    return numbers[np.bitwise_count(numbers) == r]


class Shard:
    """Codes filed under the value of each segment."""

    def __init__(self, codes: np.ndarray, dims: int) -> None:
        self.codes, self.parts = codes, segments(dims, SEGMENT_BITS)
        self.files = []
        for word, low, width in self.parts:
            value = self.value(codes, word, low, width)
            starts = np.r_[0, np.cumsum(np.bincount(value, minlength=1 << width))]
            self.files.append((np.argsort(value, kind="stable"), starts))

    @staticmethod
    def value(codes: np.ndarray, word: int, low: int, width: int) -> np.ndarray:
        return (codes[..., word] >> np.uint64(low)).astype(np.int64) & ((1 << width) - 1)

    def distances(self, asked: np.ndarray, rows: np.ndarray | slice) -> np.ndarray:
        return np.bitwise_count(self.codes[rows] ^ asked).sum(1, dtype=np.int64)

    def nearest(self, asked: np.ndarray, sizes: np.ndarray, k: int, probes: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows, with their distances, that hold the k nearest ids; row i holds ``sizes[i]`` ids."""
        m = len(self.parts)
        seen = np.zeros(len(self.codes), bool)
        counts, rows, far = np.zeros(dims + 1), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        kth = dims
        for step in range(m * (SEGMENT_BITS + 1)):
            segment, r = step % m, step // m
            word, low, width = self.parts[segment]
            near = masks(width, r)
            if len(near) > probes:
                found = np.flatnonzero(~seen)
                seen[:] = True
            else:
                order, starts = self.files[segment]
                value = self.value(asked, word, low, width) ^ near
                found = order[spread(starts[value], starts[value + 1] - starts[value])]
                found = found[~seen[found]]
                seen[found] = True
            if len(found):
                gap = self.distances(asked, found)
                rows.append(found)
                far.append(gap)
                counts += np.bincount(gap, weights=sizes[found], minlength=dims + 1)
                held = np.cumsum(counts)
                kth = int(np.searchsorted(held, k)) if held[-1] >= k else dims
            if kth <= step or len(near) > probes:
                break
        row, gap = np.concatenate(rows), np.concatenate(far)
        keep = gap <= kth
        return row[keep], gap[keep]


def searcher(dims: int, k: int, probes: int, answer: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Answers of one block of asked codes in one shard: k rows each at most."""

    def words(column: pa.ChunkedArray) -> np.ndarray:
        flat = pc.list_flatten(column).to_numpy().astype(np.int64)
        return flat.view(np.uint64).reshape(len(column), -1)

    def run(index: pa.Table, asked: pa.Table) -> pa.Table:
        if not index.num_rows or not asked.num_rows:
            return answer.empty_table()
        shard = Shard(words(index["code"]), dims)
        ids = pc.list_flatten(index["ids"]).combine_chunks()
        sizes = pc.list_value_length(index["ids"]).to_numpy().astype(np.int64)
        first = np.cumsum(sizes) - sizes
        place = np.empty(len(ids), np.int64)
        place[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        query, chosen, gaps = [], [], []
        for n, own in enumerate(words(asked["asked"])):
            row, gap = shard.nearest(own, sizes, k, probes, dims)
            # a code behind k others by (distance, smallest id) has no id among the k nearest
            order = np.lexsort((place[first[row]], gap))[:k]
            row, gap = row[order], gap[order]
            held, gap = spread(first[row], sizes[row]), np.repeat(gap, sizes[row])
            order = np.lexsort((place[held], gap))[:k]
            query.append(np.full(len(order), n))
            chosen.append(held[order])
            gaps.append(gap[order])
        picked = asked["asked"].take(pa.array(np.concatenate(query)))
        return pa.Table.from_arrays(
            [picked, ids.take(pa.array(np.concatenate(chosen))), pa.array(np.concatenate(gaps), pa.int32())], names=answer.names
        ).cast(answer)

    return run


def top_k(vectors: DataFrame, chosen: Column, k: int = TOP, probes: int = PROBES, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(query, rank, vec_id, distance) of the rows that pass ``chosen``, against all rows."""
    spark = vectors.sparkSession
    size = F.size("embedding")
    common = vectors.filter(size > 0).groupBy(size.alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = common["dims"] if common else 0
    kind = vectors.schema["vec_id"].dataType.simpleString()
    if dims <= 0:
        return spark.createDataFrame([], f"query {kind}, rank int, vec_id {kind}, distance int")
    coded = staged(codes_of(vectors, dims), "codes")
    # k smallest ids of each code: rank 1..k is cut before the shuffle
    order = Window.partitionBy("code").orderBy("vec_id")
    kept = coded.distinct().withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k)
    index = staged(kept.groupBy("code").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "index")
    queries = coded.filter(chosen).select(F.col("vec_id").alias("query"), F.col("code").alias("asked")).distinct()
    asked = staged(queries.select("asked").distinct(), "asked")
    shards = max(spark.sparkContext.defaultParallelism, -(-index.count() // shard))
    blocks = max(1, -(-asked.count() // block))

    def dealt(key: str, parts: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")

    left = index.select("code", "ids", dealt("code", shards).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = asked.select("asked", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), dealt("asked", blocks).alias("block"))
    schema = f"asked array<long>, vec_id {kind}, distance int"
    answer = pa.schema([("asked", pa.list_(pa.int64())), ("vec_id", _arrow_type(vectors)), ("distance", pa.int32())])
    # few bytes make much work here: a number of its own, which adaptive execution does not make less
    tasks = min(shards * blocks, TASKS)
    left, right = left.repartition(tasks, "shard", "block"), right.repartition(tasks, "shard", "block")
    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(searcher(dims, k, probes, answer), schema)
    nearest = Window.partitionBy("asked").orderBy("distance", "vec_id")
    top = found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
    # many queries may have asked one code: they are dealt to salts
    top = top.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    queries = queries.withColumn("salt", dealt("query", SALTS))
    # an id may have several vectors
    own = Window.partitionBy("query").orderBy("distance", "vec_id")
    pairs = queries.join(top.drop("rank"), ["asked", "salt"]).withColumn("rank", F.row_number().over(own))
    return pairs.filter(F.col("rank") <= k).select("query", "rank", "vec_id", "distance")


def _arrow_type(vectors: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(vectors.schema["vec_id"].dataType)


def codes_of(vectors: DataFrame, dims: int) -> DataFrame:
    fine = vectors.filter((F.size("embedding") == dims) & F.col("vec_id").isNotNull())
    return fine.select("vec_id", code(F.col("embedding"), dims).alias("code"))


def op9_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % EVERY == 0)


OP9_SQL = """
WITH c AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x > 0) AS b FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) = 64),
d AS (SELECT q.vec_id AS query, c.vec_id, len(list_filter(list_zip(q.b, c.b), lambda z: z[1] <> z[2]))::INT AS distance
  FROM c q, c WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, vec_id)::INT AS rank FROM d)
SELECT query, rank, vec_id, distance FROM r WHERE rank <= 10
"""

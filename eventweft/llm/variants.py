"""Spelling variants by a bit-sliced position index.

1. Vocabulary: words counted over all texts, with map-side sums.
2. Cells: of two words that differ by one inserted, deleted or replaced letter, the shorter of m letters, either
   the first m // 2 letters agree or the last m - m // 2. A word of n letters is dealt under both, for m = n and
   m = n - 1. A cell with more than ``CELL`` words is dealt again: its letters still open are halved in
   the same way, until one open letter is left, so that cells are exact and bounded by the alphabet.
3. Index: whole cells are taken together up to ``BATCH`` words. Per position and letter the index has a bitset
   over these words. All words ask at once: letter by letter, the set Z of words that agree so far (no error), the
   set S of words with one replaced letter and the set I of words with one letter more than the
   asking word are advanced, 64 words per machine word; S compares position i with i, I position i with i + 1.
   Ends are padded, so lengths need no case of their own. A deletion is the insertion that the other word sees.
4. Pairs that met in several cells become one; each word keeps the count of its near words and the most
   frequent of them. Forms are followed by pointer doubling: a form is at least twice as
   frequent as its word, so paths are short and have no circle.

A word's near words are bounded by its length and the alphabet. The texts are read once; the loops run over the
vocabulary, written to the shared folder in each round.

Defined results: NULL and empty texts have no words; a NULL id counts as empty text in the hash; repeated
rows count each; among equally frequent near words the smallest in code-point order is the form; a word without
form is its own root; an empty table gives an empty answer; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import record_batch, staged, table

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One of so many occurrences loses a letter; letters and occurrences that a word needs at least.
DAMAGE, LETTERS, SEEN = 97, 5, 3
#: A form is at least so many times as frequent.
TIMES = 2
#: Words in one cell at most, and words of whole cells compared together.
CELL, BATCH = 2048, 1024
#: Machine words of one bitset table at most; the asking words are taken in turns beyond it.
TABLE = 1 << 18


def occurrences(docs: DataFrame) -> DataFrame:
    """The word of each run of letters, one of ``DAMAGE`` without one letter, as its hash says."""
    low = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(low, F.lit(RUN), F.lit(0))).alias("run"))
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    runs = runs.select("run", F.crc32(key.cast("binary")).alias("h"))
    place = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), place), F.substring(F.col("run"), place + 2, F.char_length("run")))
    return runs.select(F.when(F.col("h") % DAMAGE == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, letters: int = LETTERS, seen: int = SEEN) -> DataFrame:
    """(word, n)"""
    counted = words.filter(F.char_length("word") >= letters).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= seen)


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds the cell of rows (word, n, m, a, z): their first ``a`` and last ``z`` letters agree."""
    head = F.substring(F.col("word"), F.lit(1), F.col("a"))
    tail = F.when(F.col("z") > 0, F.substring(F.col("word"), F.char_length("word") - F.col("z") + 1, F.col("z"))).otherwise("")
    return rows.withColumn("cell", F.xxhash64("m", "a", "z", head, F.lit(0), tail))


def _halved(rows: DataFrame) -> DataFrame:
    """Each row twice: with the first half of its open letters agreed, and with the second."""
    half = F.expr("(m - a - z) div 2").cast("int")
    first = F.struct((F.col("a") + half).alias("a"), F.col("z").alias("z"))
    second = F.struct(F.col("a").alias("a"), (F.col("m") - F.col("a") - half).cast("int").alias("z"))
    return rows.select("word", "n", "m", F.explode(F.array(first, second)).alias("part")).select("word", "n", "m", "part.a", "part.z")


def cells(words: DataFrame, bound: int = CELL) -> DataFrame:
    """(cell, word, n): two near words meet in some cell; none that can be parted has over ``bound`` words."""
    size = F.char_length("word")
    rows = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m"), F.lit(0).alias("a"), F.lit(0).alias("z"))
    rows, done = _keyed(_halved(rows)), None
    while True:
        rows = staged(rows, "cells")
        # with one open letter (two in the longer words) a cell is as small as the alphabet allows
        large = rows.filter("m - a - z > 1").groupBy("cell", "m", "a", "z").count().filter(F.col("count") > bound)
        large = staged(large.select("cell", "m", "a", "z"), "large")
        if large.isEmpty():
            rest = rows.select("cell", "word", "n")
            return rest if done is None else done.unionByName(rest)
        on = ["cell", "m", "a", "z"]
        small = rows.join(large, on, "left_anti").select("cell", "word", "n")
        done = small if done is None else done.unionByName(small)
        rows = _keyed(_halved(rows.join(large, on, "left_semi")))


def near_places(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places (x, y) of words that differ by one letter, each pair once; words are distinct."""
    count = len(words)
    size = np.fromiter(map(len, words), np.int64, count)
    signs = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    letters, code = np.unique(signs, return_inverse=True)
    begin = np.cumsum(size) - size
    wide = -(-count // 64)
    pad, most = len(letters), int(size.max(initial=0))

    def column(at: int) -> np.ndarray:
        out = np.full(count, pad, np.int64)
        has = np.flatnonzero(size > at)
        out[has] = code[begin[has] + at]
        return out

    def bitsets(letter: np.ndarray) -> np.ndarray:
        """Row c: the words with letter c at a position."""
        bits = np.zeros((pad + 1, wide * 64), np.uint8)
        bits[letter, np.arange(count)] = 1
        return np.packbits(bits, 1, bitorder="little").view(np.uint64)

    left, right = [], []
    step = max(1, TABLE // wide)
    for low in range(0, count, step):
        asking = slice(low, min(count, low + step))
        rows = asking.stop - low
        zero = np.full((rows, wide), ~np.uint64(0))
        one, more = np.zeros_like(zero), np.zeros_like(zero)
        here = column(0)
        bits = bitsets(here)
        for at in range(most + 1):
            later = column(at + 1)
            next_bits = bitsets(later)
            asked = here[asking]
            same, shifted = bits[asked], next_bits[asked]
            one = (one & same) | (zero & ~same)
            more = (more | zero) & shifted
            zero &= same
            here, bits = later, next_bits
        found = np.unpackbits((one | more).view(np.uint8), 1, count=wide * 64, bitorder="little")[:, :count]
        x, y = np.nonzero(found)
        x = x + low
        left.append(x)
        right.append(y)
    x, y = np.concatenate(left), np.concatenate(right)
    apart = x != y
    x, y = x[apart], y[apart]
    pair = np.unique(np.minimum(x, y) * count + np.maximum(x, y))
    return pair // count, pair % count


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs, both ways, of a partition sorted by ``cell`` and ``word``."""

    def pairs(cell: list[int], words: list[str], seen: list[int]) -> Iterator[pa.RecordBatch]:
        count = len(cell)
        key = np.asarray(cell, np.int64)
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if count else np.zeros(0, np.int64)
        ends = np.r_[begin[1:], count] if count else begin
        many = ends - begin > 1
        low = 0
        starts, stops = begin[many].tolist(), ends[many].tolist()
        while low < len(starts):
            high, total = low, 0
            while high < len(starts) and (not total or total + stops[high] - starts[high] <= BATCH):
                total += stops[high] - starts[high]
                high += 1
            # a word is in several cells; those of one batch need it once
            chosen = {words[i]: seen[i] for k in range(low, high) for i in range(starts[k], stops[k])}
            # of like lengths side by side
            own = sorted(chosen, key=len)
            cut = [0, *[i for i in range(1, len(own)) if len(own[i]) > len(own[i - 1]) + 1], len(own)]
            for a, b in zip(cut[:-1], cut[1:]):
                part = own[a:b]
                x, y = near_places(part)
                x, y = np.r_[x, y].tolist(), np.r_[y, x].tolist()
                yield record_batch([
                    ("word", [part[i] for i in x], pa.string()),
                    ("near", [part[i] for i in y], pa.string()),
                    ("near_n", [chosen[part[i]] for i in y], pa.int64()),
                ])
            low = high

    cell, words, seen = [], [], []
    for batch in batches:
        cell += batch.column("cell").to_pylist()
        words += batch.column("word").to_pylist()
        seen += batch.column("n").to_pylist()
        cut = len(cell)
        while cut and cell[cut - 1] == cell[-1]:
            cut -= 1
        yield from pairs(cell[:cut], words[:cut], seen[:cut])
        cell, words, seen = cell[cut:], words[cut:], seen[cut:]
    yield from pairs(cell, words, seen)


def near_words(words: DataFrame, bound: int = CELL) -> DataFrame:
    """(word, near, near_n): both ways, each pair of near words once."""
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cells(words, bound).repartition(parts, "cell").sortWithinPartitions("cell", "word")
    return dealt.mapInArrow(_near, "word string, near string, near_n long").distinct()


def followed(forms: DataFrame) -> DataFrame:
    """Adds ``root`` to (word, form): the end of the path of forms, the word itself without one."""
    state = staged(forms.withColumn("root", F.coalesce("form", "word")), "paths")
    while True:
        step = state.select(F.col("word").alias("at"), F.col("root").alias("further"))
        moved = state.join(step, F.col("root") == F.col("at")).drop("at")
        again = staged(moved.withColumn("moved", F.col("further") != F.col("root")), "paths")
        state = again.withColumn("root", F.col("further")).drop("further", "moved")
        if again.filter("moved").isEmpty():
            return state


def variants(words: DataFrame, bound: int = CELL) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word of (word, n)."""
    near = near_words(words, bound)
    # the most frequent; of equals the smallest: strings compare by UTF-8 bytes, that is by code points
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    both = words.join(near, "word", "left")
    form_n = -F.col("best.less")
    known = form_n >= TIMES * F.col("n")
    both = both.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(known, F.col("best.form")).alias("form"), F.when(known, form_n).alias("form_n"),
    )
    return followed(both).select("word", "form", "root", "n", "n_near", "form_n")


def op12_bitslice(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants(staged(vocabulary(occurrences(docs)), "vocabulary"))


def crc32_sql(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of an SQL text expression."""
    byte = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || hex(encode({text}))[2 * i + 1 : 2 * i + 2])::BIGINT)"
    turn = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {byte}), lambda c, b: {turn}))"


OP12_SQL = f"""
WITH RECURSIVE runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
grouped AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS k, run, count(*) AS c FROM runs GROUP BY ALL),
hashed AS (SELECT run, c, {crc32_sql("k")} AS h FROM grouped),
damaged AS (SELECT CASE WHEN h % {DAMAGE} = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, c FROM hashed),
v AS (SELECT word, sum(c)::BIGINT AS n FROM damaged WHERE length(word) >= {LETTERS} GROUP BY word HAVING sum(c) >= {SEEN}),
gaps AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
gapped AS (SELECT word, n, i, left(word, i::INT - 1) AS head, substr(word, i::INT + 1) AS tail FROM gaps),
pairs AS (SELECT a.word, b.word AS near, b.n AS near_n FROM gapped a JOIN gapped b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT g.word, v.word, v.n FROM gapped g JOIN v ON v.word = g.head || g.tail
  UNION SELECT v.word, g.word, g.n FROM gapped g JOIN v ON v.word = g.head || g.tail),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS form, max(near_n) AS form_n FROM pairs GROUP BY word),
formed AS (SELECT v.word, CASE WHEN form_n >= {TIMES} * n THEN form END AS form, n, coalesce(n_near, 0)::BIGINT AS n_near,
  CASE WHEN form_n >= {TIMES} * n THEN form_n END::BIGINT AS form_n FROM v LEFT JOIN best USING (word)),
path AS (SELECT word, word AS at FROM formed UNION ALL SELECT p.word, f.form FROM path p JOIN formed f ON f.word = p.at WHERE f.form IS NOT NULL),
ends AS (SELECT p.word, p.at AS root FROM path p JOIN formed f ON f.word = p.at WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""

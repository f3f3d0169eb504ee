"""SentencePiece (BPE kind) encoding and decoding by vectorised merge rounds.

A text is cut into units, runs of spaces with the word behind them. No merge crosses a unit, so each
distinct unit is merged once per worker and its ids are reused. All new units of a batch are merged
together: one flat array of symbols; per round the best pair of every word (segmented minimum of the
merge ranks), all its leftmost non-overlapping places joined at once, the array compacted, until no
word has a pair left. Where pieces share one rank only the leftmost place is joined, since the pair
that this makes may come next. Symbols without a piece become bytes. Decoding gathers the bytes of the
pieces into one flat array and cuts it by document.

Defined results: a NULL or empty text has the end id alone and decodes to empty text; NULL ids decode
to empty text; other columns pass through untouched, whatever their names. In hand-made ids, bytes on
both sides of a control id count as neighbours.
"""

from __future__ import annotations

import codecs
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import sliced, spread, table, texts_of

#: Fixed values of the model format: the sign for a space, and the last rank.
SPACE = "▁"
NO_PAIR = np.int64(1) << 40

_UNITS = re.compile(r" *[^ ]+| +")
#: Units kept per worker before the store is emptied.
STORE_UNITS = 150_000


class Pieces:
    """Vocabulary, merge table and unit store of one model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.eos, self.bos, self.unk = model.eos_id(), model.bos_id(), model.unk_id()
        self.size = size
        names = [model.id_to_piece(i) for i in range(size)]
        self.is_byte = np.array([model.is_byte(i) for i in range(size)])
        self.is_control = np.array([model.is_control(i) for i in range(size)])
        plain = [i for i in range(size) if not (self.is_byte[i] or self.is_control[i] or i == self.unk)]
        ids = {names[i]: i for i in plain}
        self.byte_id = np.full(256, self.unk, np.int32)
        for i in np.flatnonzero(self.is_byte):
            self.byte_id[int(names[i][3:-1], 16)] = i
        # characters: their piece, or a number behind the vocabulary if only longer pieces hold them
        self.char_id = np.full(0x110000, -1, np.int32)
        extra = size
        for name in (names[i] for i in plain):
            for c in name:
                if self.char_id[ord(c)] < 0:
                    self.char_id[ord(c)] = ids.get(c, extra)
                    extra += c not in ids
        self.extra = extra
        symbol = dict(ids)
        for name in (names[i] for i in plain):
            for c in name:
                symbol.setdefault(c, int(self.char_id[ord(c)]))
        # pairs of symbols whose joined text is a piece, and the rank of that piece
        scores = np.array([model.get_score(i) for i in range(size)])
        order = np.unique(-scores[plain], return_inverse=True)[1] if plain else np.zeros(0, int)
        self.rank = np.zeros(size, np.int64)
        self.rank[plain] = order
        counts = np.bincount(order) if plain else np.zeros(1, int)
        self.tied = counts > 1
        pairs = {}
        bigrams = set()
        for i in plain:
            name = names[i]
            for k in range(1, len(name)):
                left, right = symbol.get(name[:k]), symbol.get(name[k:])
                bigrams.add((int(self.char_id[ord(name[k - 1])]), int(self.char_id[ord(name[k])])))
                if left is not None and right is not None:
                    pairs[left * (extra + 1) + right] = i
        self.pair_key = np.array(sorted(pairs), np.int64)
        self.pair_id = np.array([pairs[k] for k in self.pair_key.tolist()], np.int64)
        self.bigram = np.array(sorted(a * (extra + 1) + b for a, b in bigrams), np.int64)
        # bytes of each piece for decoding
        raw = []
        for i in range(size):
            if self.is_byte[i]:
                raw.append(bytes([int(names[i][3:-1], 16)]))
            elif self.is_control[i]:
                raw.append(b"")
            elif i == self.unk:
                raw.append(" ⁇ ".encode())
            else:
                raw.append(names[i].replace(SPACE, " ").encode())
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_length = np.array([len(r) for r in raw], np.int64)
        self.raw_start = np.cumsum(self.raw_length) - self.raw_length
        self.raw_first_space = np.array([r[:1] == b" " and not self.is_byte[i] for i, r in enumerate(raw)])
        self.spaces_max = max((len(n) for n in ids if n and not n.strip(SPACE)), default=1)
        # a long run of spaces is cut into runs of the longest such piece if merging does the same
        longest = SPACE * self.spaces_max
        runs = [SPACE * r + end for r in range(1, self.spaces_max + 2) for end in ("", *"ta")]
        whole = [self.merge([longest * 2 + r])[0].tolist() for r in runs]
        self.cut_spaces = whole == [self.merge([longest])[0].tolist() * 2 + self.merge([r])[0].tolist() for r in runs]
        self._reset()

    def _reset(self) -> None:
        self.store: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two symbols join to, or -1."""
        key = left.astype(np.int64) * (self.extra + 1) + right
        key[(left < 0) | (right < 0)] = -1
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_id[at], -1)

    def merge(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, flat, and the number of ids of each. Units hold the space sign for spaces."""
        code = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int64)
        unit_length = np.fromiter(map(len, units), np.int64, len(units))
        unit = np.repeat(np.arange(len(units)), unit_length)
        symbol = self.char_id[code].astype(np.int64)
        # a word ends where no piece holds the two characters side by side
        key = symbol[:-1] * (self.extra + 1) + symbol[1:]
        at = np.minimum(np.searchsorted(self.bigram, key), max(0, len(self.bigram) - 1))
        apart = np.ones(len(code), bool)
        if len(code) > 1:
            joined = (self.bigram[at] == key) if len(self.bigram) else np.zeros(len(key), bool)
            apart[1:] = ~joined | (unit[1:] != unit[:-1]) | (symbol[:-1] < 0) | (symbol[1:] < 0)
        word = np.cumsum(apart) - 1
        place = np.arange(len(code))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        merged = np.full(len(symbol), -1, np.int64)
        rank = np.full(len(symbol), NO_PAIR)
        touched = np.arange(len(symbol))
        while len(symbol):
            # the pairs that the last round made or broke
            inner = touched[touched < len(symbol) - 1]
            inner = inner[word[inner] == word[inner + 1]]
            merged[touched], rank[touched] = -1, NO_PAIR
            merged[inner] = self._lookup(symbol[inner], symbol[inner + 1])
            rank[inner] = np.where(merged[inner] >= 0, self.rank[merged[inner]], NO_PAIR)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(rank, first)
            size = np.diff(np.r_[first, len(symbol)])
            keep = best < NO_PAIR
            if not keep.all():
                live = np.repeat(keep, size)
                done.append((place[~live], symbol[~live]))
                symbol, word, place, merged, rank = (x[live] for x in (symbol, word, place, merged, rank))
                best, size = best[keep], size[keep]
                first = np.cumsum(size) - size
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == (best[0] if len(best) == 1 else np.repeat(best, size)))
            opens = np.r_[True, at[1:] != at[:-1] + 1]
            run = np.maximum.accumulate(np.where(opens, at, 0))
            take = (at - run) % 2 == 0
            tied = self.tied[rank[at]]
            if tied.any():
                take &= ~tied | np.r_[True, word[at[1:]] != word[at[:-1]]]
            at = at[take]
            symbol[at] = merged[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            symbol, word, place, merged, rank = (x[keep] for x in (symbol, word, place, merged, rank))
            now = at - np.arange(len(at))
            touched = np.unique(np.r_[now, np.maximum(now - 1, 0)])
        if done:
            place = np.concatenate([p for p, _ in done])
            order = np.argsort(place, kind="stable")
            place, symbol = place[order], np.concatenate([s for _, s in done])[order]
        # symbols without a piece turn into the bytes of their character
        bare = (symbol < 0) | (symbol >= self.size)
        char = code[place]
        width = np.where(bare, 1 + (char >= 0x80) + (char >= 0x800) + (char >= 0x10000), 1)
        start = np.cumsum(width) - width
        out = np.empty(int(width.sum()), np.int32)
        out[start[~bare]] = symbol[~bare]
        for n in range(1, 5):
            rows = np.flatnonzero(bare & (width == n))
            c = char[rows]
            for k in range(n):
                bits = (c >> (6 * (n - 1 - k))) & 0x3F
                lead = (c if n == 1 else (0xF00 >> n & 0xFF) | (c >> (6 * (n - 1)))) if k == 0 else 0x80 | bits
                out[start[rows] + k] = self.byte_id[lead]
        count = np.bincount(unit[place], weights=width, minlength=len(units)).astype(np.int64)
        return out, count

    def _units(self, text: str) -> list[str]:
        """The units of a text without the first space of each."""
        if not text:
            return []
        if SPACE in text:
            text = text.replace(SPACE, " ")
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        out = []
        for unit in _UNITS.findall(" " + text):
            if self.cut_spaces and unit.startswith(" " * (self.spaces_max + 1)):
                bare = unit.lstrip(" ")
                spaces = len(unit) - len(bare)
                full = (spaces - 1) // self.spaces_max
                out += [" " * (self.spaces_max - 1)] * full
                unit = " " * (spaces - full * self.spaces_max) + bare
            out.append(unit[1:])
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts with the end id after each, and their offsets."""
        units = [self._units(t) for t in texts]
        flat = [u for us in units for u in us]
        if len(self.store) > STORE_UNITS:
            self._reset()
        new = [u for u in dict.fromkeys(flat) if u not in self.store]
        if new:
            out, count = self.merge([SPACE + u.replace(" ", SPACE) for u in new])
            base = len(self.store)
            self.store.update((u, base + i) for i, u in enumerate(new))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(count) - count])
            self.length = np.concatenate([self.length, count])
            self.flat = np.concatenate([self.flat, out])
        index = np.fromiter(map(self.store.__getitem__, flat), np.int64, len(flat))
        length = self.length[index]
        per_text = np.fromiter(map(len, units), np.int64, len(units))
        text = np.repeat(np.arange(len(texts)), per_text)
        count = np.bincount(text, weights=length, minlength=len(texts)).astype(np.int64) + 1
        offset = np.r_[0, np.cumsum(count)]
        ids = np.empty(int(offset[-1]), np.int32)
        ids[offset[1:] - 1] = self.eos
        body = np.ones(len(ids), bool)
        body[offset[1:] - 1] = False
        ids[body] = self.flat[spread(self.start[index], length)]
        return ids, offset

    def decode(self, ids: np.ndarray, offset: np.ndarray) -> list[str]:
        """The text of each run of ids between two offsets."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError("an id is outside the vocabulary")
        length = self.raw_length[ids]
        start = self.raw_start[ids]
        rows = np.flatnonzero(np.diff(offset) > 0)
        # the space that encoding put before the text goes: of the first piece that isn't a control
        shown = np.where(self.is_control[ids], len(ids), np.arange(len(ids)))
        first = np.minimum.reduceat(shown, offset[rows]) if len(rows) else np.zeros(0, int)
        first = first[first < len(ids)]
        first = first[self.raw_first_space[ids[first]] & (ids[first] != self.unk)]
        start[first] += 1
        length[first] -= 1
        data = self.raw[spread(start, length)].tobytes()
        ends = np.r_[0, np.cumsum(length)][offset].tolist()
        return [text_of(data[a:b]) for a, b in zip(ends[:-1], ends[1:])]


codecs.register_error("eventweft_each_byte", lambda e: ("�", e.start + 1))


def text_of(data: bytes) -> str:
    """UTF-8 text in which each byte that is not part of a character stands as U+FFFD."""
    return data.decode("utf-8", "eventweft_each_byte")


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode(text: Column, path: str) -> Column:
    """Ids of the text, the end id last, as an array column."""

    @F.arrow_udf(returnType=ArrayType(IntegerType(), False))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = pieces(path)
        for batch in batches:
            parts = [pa.array([], pa.list_(pa.int32()))]
            for values in sliced(batch, 1 << 21):
                ids, offset = model.encode([t or "" for t in values.to_pylist()])
                parts.append(pa.ListArray.from_arrays(pa.array(offset, pa.int32()), pa.array(ids, pa.int32())))
            yield pa.concat_arrays(parts)

    return run(text)


def decode(ids: Column, path: str) -> Column:
    """The text of an array of ids."""

    @F.arrow_udf(returnType=StringType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = pieces(path)
        for batch in batches:
            parts = [pa.array([], pa.string())]
            for values in sliced(batch, 1 << 21):
                count = np.asarray(values.value_lengths().fill_null(0), np.int64)
                flat = np.asarray(values.flatten(), np.int64)
                parts.append(pa.array(model.decode(flat, np.r_[0, np.cumsum(count)]), pa.string()))
            yield pa.concat_arrays(parts)

    return run(ids)


def coded(docs: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """The columns ``keep``, the ids of each whole text and the text that they decode to. One worker per
    task does both and hands on small batches, so that its memory doesn't follow Spark's batch size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch, texts in texts_of(batches, 1 << 21, 0):
            ids, offset = model.encode(texts)
            arrays = [
                *batch.columns[1:],
                pa.ListArray.from_arrays(pa.array(offset, pa.int32()), pa.array(ids, pa.int32())),
                pa.array(model.decode(ids, offset), pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "ids", "decoded"])

    kinds = {f.name: f.dataType for f in docs.schema.fields}
    schema = StructType([StructField(n, kinds[n]) for n in keep])
    schema.add("ids", ArrayType(IntegerType(), True)).add("decoded", StringType())
    # the kept columns may be named like the text: they are told apart by place
    return docs.select("text", *keep).mapInArrow(run, schema)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = coded(docs, model_path(), ["doc_id"])
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )

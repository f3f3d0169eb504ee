"""Personal data by a semi-Markov conditional random field over fixed base patterns.

Base spans (email, ip, card, phone) follow fixed rules and always stay. The field scores whole segments:
a text's neighbourhoods of digits and at-signs are cut into tokens, candidate segments of at most
``LONGEST`` tokens get features of the whole span (digits, separators, groups, Luhn sum, what stands
around), and a dynamic program over bounded segments picks boundaries and types together. It is trained
here by likelihood (forward and backward sums over all segmentations) on at most ``REGIONS``
neighbourhoods, chosen by hash and marked by the base rules, by the seed rule for secrets, by phone
numbers rewritten without their plus sign, and by days and other numbers put in their place. What it finds beside base spans is added: ``secret`` (keys
and tokens) and ``contact`` (phone numbers of other forms).

Defined results: NULL text reads as empty; empty texts have no spans; without training neighbourhoods
nothing is added; repeated rows get the same spans; columns besides ``text`` pass untouched.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hashed_sample, record_batch, sliced, table, texts_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "contact")
ADDED = ("secret", "contact")
LONGEST = 14
REGIONS = 1200
#: Characters of a neighbourhood that the fit reads; spans are looked for in whole texts.
REGION_CHARS = 2_000
EPOCHS = 5

# The base patterns, in forms that never look at a character twice
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_ANCHOR = re.compile(r"[0-9@]+")
_TOKEN = re.compile(r"[^\W_]+|\s|[^\s]")
_SEED = re.compile(r"""(?:token|key|secret|password)["']?\s*[=:]\s*["']?([A-Za-z0-9_-]{16,})""", re.IGNORECASE)
AROUND = 32
SPAN = "array<struct<kind:string,start:int,end:int>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by the fixed rules, by start, then in the order of the kinds."""
    out = []
    if "@" in text:
        last = 0
        for m in _DOMAIN.finditer(text):
            at = m.start()
            low = max(last, text.rfind("@", last, at) + 1)
            start = low + len(text[low:at].rstrip(_LOCAL))
            if start < at:
                out.append((start, m.end(), "email"))
                last = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], BASE.index(s[2])))


def regions(text: str) -> list[tuple[int, int]]:
    """Neighbourhoods of digits and at-signs."""
    out: list[list[int]] = []
    for m in _ANCHOR.finditer(text):
        low, high = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        if out and low <= out[-1][1]:
            out[-1][1] = high
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


def _bucket(n: int) -> int:
    return n if n < 8 else 8 if n < 12 else 9 if n < 16 else 10 if n < 20 else 11


class Lattice:
    """Tokens of a neighbourhood and its candidate segments (first token, last token + 1, features)."""

    def __init__(self, text: str):
        spans = [m.span() for m in _TOKEN.finditer(text)]
        self.spans, n = spans, len(spans)
        digits = [sum(c in "0123456789" for c in text[a:b]) for a, b in spans]
        self.segments: list[tuple[int, int, list[str]]] = []
        word = [text[a].isalnum() for a, b in spans]
        before = ""
        for i, (a, b) in enumerate(spans):
            if word[i] or text[a] in "+(":
                left = text[a - 1] if a else " "
                got, at = 0, False
                for j in range(i, min(n, i + LONGEST)):
                    c, d = spans[j]
                    if text[c] in "\n\r":
                        break
                    got += digits[j]
                    at |= text[c] == "@"
                    if word[j] and (got >= 7 or at or (d - c >= 16 and got)):
                        self.segments.append((i, j + 1, self._features(text[a:d], left, text[d : d + 1] or " ", before, got, j - i + 1)))
            if word[i]:
                before = text[a:b].lower()

    @staticmethod
    def _features(span: str, left: str, right: str, before: str, digits: int, tokens: int) -> list[str]:
        letters = sum(c.isalpha() for c in span)
        marks = "".join(sorted({c for c in span if not c.isalnum()}))
        groups = [len(g) for g in re.findall(r"[0-9]+", span)]
        sum_ok = letters == 0 and 12 <= digits <= 19 and luhn("".join(c for c in span if c in "0123456789"))
        parts = span.split(".")
        quad = len(parts) == 4 and letters == 0 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
        size = _bucket(digits)
        body = f"{marks}|{min(letters, 1)}"
        return [
            "bias", f"marks {marks}", f"digits {size}", f"body {body}|{size}", f"sum {sum_ok} {len(groups)}", f"quad {quad}",
            f"left {left if not left.isalnum() else 'a'}", f"right {right if not right.isalnum() else 'a'}|{min(letters, 1)}",
            f"before {before}", f"first {span[0] if not span[0].isalpha() else 'a'}|{groups[:1]}", f"groups {groups[-3:]}",
            f"at {span.count('@')} {min(span.count('.'), 3)}", f"one {tokens == 1} {min(len(span) // 8, 6)} {letters > 0 and digits > 0}",
        ]


class Field:
    """Weights of (feature, kind); the empty kind scores 0."""

    def __init__(self, weights: dict[str, list[float]] | None = None):
        self.weights = weights or {}

    def scores(self, lattice: Lattice) -> list[list[float]]:
        out = []
        for _, _, features in lattice.segments:
            total = [0.0] * len(KINDS)
            for f in features:
                row = self.weights.get(f)
                if row is not None:
                    for k in range(len(KINDS)):
                        total[k] += row[k]
            out.append(total)
        return out

    def best(self, text: str) -> list[tuple[int, int, str]]:
        """The best segmentation's segments as (start, end, kind)."""
        lattice = Lattice(text)
        if not self.weights or not lattice.segments:
            return []
        n = len(lattice.spans)
        at: list[list[tuple[int, float, int]]] = [[] for _ in range(n + 1)]
        for (i, j, _), score in zip(lattice.segments, self.scores(lattice)):
            k = max(range(len(KINDS)), key=score.__getitem__)
            if score[k] > 0:
                at[j].append((i, score[k], k))
        value, back = [0.0] * (n + 1), [None] * (n + 1)
        for j in range(1, n + 1):
            value[j] = value[j - 1]
            for i, score, k in at[j]:
                if value[i] + score > value[j]:
                    value[j], back[j] = value[i] + score, (i, k)
        out, j = [], n
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                i, k = back[j]
                out.append((lattice.spans[i][0], lattice.spans[j - 1][1], KINDS[k]))
                j = i
        return out[::-1]

    def step(self, lattice: Lattice, gold: set[tuple[int, int, int]], rate: float, ridge: float = 1e-3) -> None:
        """One step up the likelihood of ``gold`` (first token, end, kind)."""
        n, scores = len(lattice.spans), self.scores(lattice)
        ends: list[list[int]] = [[] for _ in range(n + 1)]
        starts: list[list[int]] = [[] for _ in range(n + 1)]
        total = []
        for s, (i, j, _) in enumerate(lattice.segments):
            ends[j].append(s)
            starts[i].append(s)
            total.append(_log_sum(scores[s]))
        ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            ahead[j] = _log_sum([ahead[j - 1], *(ahead[lattice.segments[s][0]] + total[s] for s in ends[j])])
        for i in range(n - 1, -1, -1):
            behind[i] = _log_sum([behind[i + 1], *(behind[lattice.segments[s][1]] + total[s] for s in starts[i])])
        for s, (i, j, features) in enumerate(lattice.segments):
            outer = ahead[i] + behind[j] - ahead[n]
            pull = [float((i, j, k) in gold) - math.exp(min(0.0, outer + scores[s][k])) for k in range(len(KINDS))]
            if max(map(abs, pull)) < 1e-4:
                continue
            for f in features:
                row = self.weights.setdefault(f, [0.0] * len(KINDS))
                for k in range(len(KINDS)):
                    row[k] += rate * (pull[k] - ridge * row[k])


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def decoys(d: str) -> list[str]:
    """Numbers that are no contact: days, moments, plain and grouped numbers of the same digits."""
    year, month, day = 1990 + int(d[:2]) % 40, 1 + int(d[2:4]) % 12, 1 + int(d[4:6]) % 28
    group = f"{d[:4]} {d[4:8]} {d[1:5]} {d[2:6]}"
    out = [f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}", f"{d[:3]},{d[3:6]},{d[6:9]}.{d[:2]}", d[:10], d[:12]]
    out.append(f"{year}-{month:02}-{day:02} {int(d[:2]) % 24:02}:{int(d[2:4]) % 60:02}:{int(d[4:6]) % 60:02}")
    return out if luhn(group.replace(" ", "")) else [*out, group]


def marked(text: str) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Training forms of a neighbourhood with their marks."""
    base = base_spans(text)
    seeds = [(m.start(1), m.end(1), "secret") for m in _SEED.finditer(text)]
    spans: list[tuple[int, int, str]] = []
    for s in sorted(base + seeds, key=lambda s: s[0] - s[1]):
        if all(s[1] <= a or s[0] >= b for a, b, _ in spans):
            spans.append(s)
    out = [(text, spans)]
    for a, b, kind in spans:
        if kind != "phone":
            continue
        bare = re.sub(r"^\+[0-9]{1,3}[ .-]?", "", text[a:b])
        number = re.sub(r"[^0-9]+", "-", bare).strip("-")
        for form in (bare, number, "00" + text[a + 1 : b]):
            if sum(c.isdigit() for c in form) >= 9:
                out.append((text[:a] + form + text[b:], [(a, a + len(form), "contact")]))
        for form in decoys("".join(c for c in text[a:b] if c in "0123456789")):
            out.append((text[:a] + form + text[b:], []))
    return out


def train(texts: list[str], epochs: int = EPOCHS) -> Field:
    field, data = Field(), []
    for text in texts:
        for form, spans in marked(text):
            lattice = Lattice(form)
            first = {a: i for i, (a, _) in enumerate(lattice.spans)}
            last = {b: i + 1 for i, (_, b) in enumerate(lattice.spans)}
            gold = {(first[a], last[b], KINDS.index(k)) for a, b, k in spans if a in first and b in last}
            if lattice.segments:
                data.append((lattice, gold))
    order = np.random.default_rng(3)
    for epoch in range(epochs):
        for i in order.permutation(len(data)).tolist():
            field.step(*data[i], rate=0.2 / (1 + epoch))
    return field


def fit(docs: DataFrame, rows: int = REGIONS) -> Field:
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in texts_of(batches):
            yield record_batch([("region", [t[a:b][:REGION_CHARS] for t in texts for a, b in regions(t)], pa.string())])

    found = docs.select("text").mapInArrow(gather, "region string")
    return train([r.region for r in hashed_sample(found, rows, "region").collect()])


def all_spans(text: str, field: Field) -> list[tuple[int, int, str]]:
    base = base_spans(text)
    out = list(base)
    for low, high in regions(text):
        for a, b, kind in field.best(text[low:high]):
            if kind in ADDED and all(low + b <= s or low + a >= e for s, e, _ in base):
                out.append((low + a, low + b, kind))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def spans(text: Column, field: Field) -> Column:
    """All spans of each whole text, by start; ends are exclusive, in code points."""
    shared = SparkSession.active().sparkContext.broadcast(field.weights)

    @F.arrow_udf(SPAN)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Field(shared.value)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            parts = [pa.array([], kind)]
            for values in sliced(batch):
                found = [all_spans(t or "", own) for t in values.to_pylist()]
                parts.append(pa.array([[{"kind": k, "start": a, "end": b} for a, b, k in f] for f in found], kind))
            yield pa.concat_arrays(parts)

    return run(text)


def masked(text: Column, field: Field) -> Column:
    """The text with each span replaced by its kind in angle brackets; NULL stays NULL. Of overlapping
    spans the whole stretch goes, under the first one's kind."""
    shared = SparkSession.active().sparkContext.broadcast(field.weights)

    def mask(text: str, own: Field) -> str:
        out, last = [], 0
        for a, b, kind in all_spans(text, own):
            if a >= last:
                out += [text[last:a], f"<{kind.upper()}>"]
            last = max(last, b)
        return "".join([*out, text[last:]])

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Field(shared.value)
        for batch in batches:
            yield pa.array([None if t.as_py() is None else mask(t.as_py(), own) for t in batch], pa.string())

    return run(text)


def of_kinds(found: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(found, lambda s: s["kind"].isin(*kinds))


def joined(found: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of spans of some kinds, comma-joined."""
    return F.array_join(F.transform(of_kinds(found, kinds), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op2_semicrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", spans(F.col("text"), fit(docs)).alias("found"))
    # the added kinds are others, so these count base spans
    count = [F.size(of_kinds(F.col("found"), (k,))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select(
        "doc_id", *count,
        F.sha2(joined(F.col("found"), BASE).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found"), KINDS).alias("spans"),
    )

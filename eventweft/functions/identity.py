"""Deterministic row identity: a hash over the business key, named into a version 5 UUID."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventweft.functions.bind import let

# The DNS name space of RFC 4122 and the separator between key values.
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"
KEY_SEPARATOR = "|"


def record_hash(values: Sequence[Column], null_token: str | None = None) -> Column:
    """SHA-256 over the joined values. NULLs are passed over unless a token stands in for them."""
    return F.sha2(_joined(values, null_token), 256)


def _joined(values: Sequence[Column], null_token: str | None) -> Column:
    texts = [v.cast("string") for v in values]
    if null_token is not None:
        texts = [F.coalesce(t, F.lit(null_token)) for t in texts]
    return F.concat_ws(KEY_SEPARATOR, *texts)


def uuid_v5(name: Column, namespace: str = DNS_NAMESPACE) -> Column:
    """Name-based UUID, equal to Python's ``uuid.uuid5``; NULL or empty text gives NULL."""
    return _named(F.nullif(name, F.lit("")), namespace)


def _named(name: Column, namespace: str, flat: bool = False) -> Column:
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))

    def laid_out(d: Column) -> Column:
        variant = F.translate(F.substring(d, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
        parts = [F.substring(d, 1, 8), F.substring(d, 9, 4), F.concat(F.lit("5"), F.substring(d, 14, 3))]
        parts += [F.concat(variant, F.substring(d, 18, 3)), F.substring(d, 21, 12)]
        # concat keeps NULL; behind a condition generated code would not share the digest
        return F.concat(*[x for p in parts for x in (F.lit("-"), p)][1:])

    return laid_out(digest) if flat else let(digest, laid_out)


def row_id(values: Sequence[Column], fallback: Column, null_token: str | None = None, flat: bool = False) -> Column:
    """Id from the key values; from the fallback (the event id) where a table has no key column.

    ``flat`` is for rows of a frame: generated code then shares the digest by itself. Inside a lambda it does not.
    """
    return keyed_id(key_text(values, fallback, null_token), flat)


def key_text(values: Sequence[Column], fallback: Column, null_token: str | None = None) -> Column:
    """The text that ``row_id`` makes an id of: rows have one id where they have one text."""
    return _joined(values or [fallback], null_token)


def keyed_id(text: Column, flat: bool = False) -> Column:
    return _named(F.sha2(text, 256), DNS_NAMESPACE, flat)


def packed(row: Column) -> Column:
    """An id's 16 bytes, as it moves between tasks: its text is random, so no compression makes it that short."""
    return F.unhex(F.replace(row, F.lit("-"), F.lit("")))


def unpacked(data: Column) -> Column:
    """The id of ``packed`` bytes, as text."""
    digits = F.lower(F.hex(data))
    parts = [F.substring(digits, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(*[x for p in parts for x in (F.lit("-"), p)][1:])

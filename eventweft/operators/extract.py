"""Rows out of documents: one per event, one per array element, or lists paired by position.

Events enter as a frame with ``source_id``, ``event_name``, ``event_time`` and the document ``doc``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventweft.functions import coerce as C
from eventweft.functions import paths
from eventweft.spec import Entity, Source

ORD = "_ord"


def model_shape(entities: Iterable[Entity]) -> T.StructType:
    """What the documents of these tables look like, as far as the tables read them."""
    read = [(p, e, name) for e in entities for s in e.sources for name, p in s.fields.items() if p]
    kept = {p for p, e, name in read if C.kind_counts(_kinds(e)[name])}
    return paths.shape(sorted({p for p, _, _ in read}), kept)


def _kinds(entity: Entity) -> dict[str, str]:
    return {c.name: c.kind for c in entity.columns}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _source_rows_sql(doc: str, source: Source, kinds: dict[str, str]) -> str:
    """``array<struct<ord, text of each column>>`` of one source; unmapped columns give NULL.

    A column whose path lies outside the row is read from the document and repeats on every row.
    """

    def text(name: str) -> str:
        path = source.fields.get(name)
        if path is None:
            return "cast(NULL AS string)"
        rest = source.relative(path)
        if rest is None and paths.fans_out(path):
            raise ValueError(f"{name}: {path!r} leaves the rows of {source.rows_from!r}; use another source")
        leaf = paths.scalar_sql(doc, path) if rest is None else paths.scalar_sql("n.node", rest)
        return C.json_text_sql(leaf, kinds[name])

    columns = ", ".join(f"{_quoted(n)}, {text(n)}" for n in kinds)
    return f"transform({paths.nodes_sql(doc, source.rows_from)}, n -> named_struct('{ORD}', n.ord, {columns}))"


def _compact_rows_sql(doc: str, source: Source, kinds: dict[str, str]) -> str:
    """Each column's values as a list without gaps, paired by position and padded with NULL.

    A value after a gap moves up, and the value of a path without ``[]`` fills only the first row.
    Offered for tables that were filled that way before.
    """
    empty = "cast(array() AS array<string>)"

    def values(name: str) -> str:
        path = source.fields.get(name)
        if path is None:
            return empty
        if paths.fans_out(path):
            texts = f"transform({paths.every_sql(doc, path)}, x -> {C.json_text_sql('x', kinds[name])})"
            return f"coalesce(filter({texts}, t -> t IS NOT NULL), {empty})"
        one = C.json_text_sql(paths.scalar_sql(doc, path), kinds[name])
        return f"CASE WHEN {one} IS NOT NULL THEN array({one}) ELSE {empty} END"

    # Zipped by index, which keeps the column names out of the zip itself.
    zipped = f"arrays_zip({', '.join(values(n) for n in kinds)})"
    columns = ", ".join(f"{_quoted(n)}, z.`{k}`" for k, n in enumerate(kinds))
    return f"transform({zipped}, (z, i) -> named_struct('{ORD}', array(i), {columns}))"


def text_rows(doc: str, event: str, entity: Entity) -> Column:
    """Text rows of one table from all its event types, picked by one CASE in one scan.

    Several sources in one event type are joined end to end.
    """
    names = entity.column_names
    kinds = {n: _kinds(entity)[n] for n in names}
    by_event: dict[str, list[Source]] = {}
    for s in entity.sources:
        by_event.setdefault(s.event, []).append(s)
    branches = []
    for name, group in by_event.items():
        parts = [(_compact_rows_sql if s.align == "compact" else _source_rows_sql)(doc, s, kinds) for s in group]
        rows = f"flatten(filter(array({', '.join(parts)}), p -> p IS NOT NULL))" if len(parts) > 1 else parts[0]
        branches.append(f"WHEN `{event}` = {_quoted(name)} THEN {rows}")
    if not branches:
        return F.lit(None).cast(T.ArrayType(_text_struct(names)))
    return F.expr(f"CASE {' '.join(branches)} END")


def _text_struct(names: Sequence[str]) -> T.StructType:
    return T.StructType(
        [T.StructField(ORD, T.ArrayType(T.IntegerType())), *[T.StructField(n, T.StringType()) for n in names]]
    )


def inlined(frame: DataFrame, rows: str, carried: Sequence[str]) -> DataFrame:
    """One row per element of an array of structs.

    The outer form, with its empty rows filtered after: for the inner form the optimizer adds a
    filter on the array's size below the projection that makes it, which computes it again.
    """
    return frame.select(*carried, F.inline_outer(rows)).filter(F.col(ORD).isNotNull())


def kept(frame: DataFrame, when: Column, carried: Sequence[str], *columns: Column) -> DataFrame:
    """The rows that pass a condition over computed columns, which are computed once.

    A plain filter would be moved below the projections that make the columns, and make them all again there.
    """
    whole = F.struct(F.lit(True).alias("_kept"), *columns)
    return frame.select(*carried, F.inline_outer(F.when(when, F.array(whole)))).filter("_kept IS NOT NULL").drop("_kept")


def passing(frame: DataFrame, when: Column) -> DataFrame:
    """The rows that pass a condition over computed columns, as ``kept`` has them, with all columns: those that nobody
    uses later are not made."""
    return frame.select("*", F.inline_outer(F.when(when, F.array(F.struct(F.lit(True).alias("_kept")))))).filter("_kept IS NOT NULL").drop("_kept")


def cleaned(get: Callable[[str], Column], names: Sequence[str]) -> list[Column]:
    return [C.to_text(get(n)).alias(n) for n in names]


def typed(get: Callable[[str], Column], entity: Entity) -> list[Column]:
    """Each mapped column coerced from its cleaned text; the others as typed NULL."""
    mapped = {c for s in entity.sources for c in s.fields}
    return [
        (C.from_text(get(c.name), c.kind) if c.name in mapped else F.lit(None).cast(c.kind)).alias(c.name)
        for c in entity.columns
    ]


def filled(get: Callable[[str], Column], entity: Entity) -> Column:
    """True where some mapped column has text."""
    mapped = {c for s in entity.sources for c in s.fields}
    cols = [get(n) for n in entity.column_names if n in mapped]
    return F.coalesce(*cols).isNotNull() if cols else F.lit(True)


def keeps_empty(event: Column, entity: Entity) -> Column:
    names = sorted({s.event for s in entity.sources if s.keep_empty})
    return event.isin(*names) if names else F.lit(False)


def extract(events: DataFrame, entity: Entity) -> DataFrame:
    """Typed rows of one table, with provenance; rows without any value are left out."""
    event = F.col("event_name")
    carried = ["source_id", "event_name", "event_time"]
    names = entity.column_names
    wanted = events.filter(event.isin(*sorted({s.event for s in entity.sources})))
    texts = inlined(wanted.select(*carried, text_rows("doc", "event_name", entity).alias("_rows")), "_rows", carried)
    # Filtered before columns get their types: a filter over the typed columns would be moved
    # below them by the optimizer and compute every coercion a second time.
    clean = texts.select(*carried, ORD, *cleaned(F.col, names))
    some = clean.filter(filled(F.col, entity) | keeps_empty(event, entity))
    return some.select(*carried, ORD, *typed(F.col, entity))


def with_provenance(rows: DataFrame, entity: Entity) -> DataFrame:
    """``received_at`` from the event, or from the table's own time column."""
    at = F.col(entity.time_column) if entity.time_column else F.col("event_time")
    return rows.withColumn("received_at", at)


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Target columns in order and in type; missing ones as typed NULL, others left out."""
    have = set(rows.columns)
    return rows.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )

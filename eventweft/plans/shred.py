"""Compile a model to one wide frame: a row per event, a column of finished rows per table.

Everything about an event happens inside its row: extraction, coercion, foreign keys, ids and
reasons need no join and no shuffle, and each document is parsed once for all tables. Tables are
then read off the wide frame, each loading only its own column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventweft.functions import paths
from eventweft.functions.bind import let
from eventweft.functions.identity import keyed_id, packed, unpacked
from eventweft.operators import dedup as D
from eventweft.operators import extract as E
from eventweft.operators import quality as Q
from eventweft.operators import relate as R
from eventweft.spec import Entity, ForeignKey, Link, Model

CARRIED = ["source_id", "event_name", "event_time"]
BAD_EVENT = "_event_reason"
ID_TEXT = "_id_text"


def working_events(landed: DataFrame, model: Model, tables: Sequence[str] | None = None) -> DataFrame:
    """Landing rows (id, event_timestamp, event_name, raw) to working events with a parsed document.

    Naming tables narrows the parse to what they read.
    """
    named = landed.select(
        F.col("id").alias("source_id"),
        canonical_name(F.col("event_name"), model.aliases).alias("event_name"),
        F.col("event_timestamp").alias("event_time"),
        "raw",
    )
    wanted = model.entities if tables is None else [model.entity(t) for t in tables]
    return paths.with_document(named, "raw", E.model_shape(wanted))


def canonical_name(name: Column, aliases: Mapping[str, str]) -> Column:
    """Event types that share the description of another type take its name."""
    if not aliases:
        return name
    pairs = [F.lit(t) for pair in aliases.items() for t in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), name)


def event_reason(known: Sequence[str]) -> Column:
    """Why a whole event yields no rows, or NULL."""
    return (
        F.when(F.col("doc").isNull(), F.lit("malformed document"))
        .when(F.col("event_name").isNull(), F.lit("no event type"))
        .when(~F.col("event_name").isin(*known), F.lit("unknown event type"))
    )


def shred(events: DataFrame, model: Model, known: Sequence[str] | None = None) -> DataFrame:
    """The wide frame. Tables of later levels are added after the parents they take ids from.

    ``known`` names the event types that count as known, where the model is only a part.
    """
    wide = events.withColumn(BAD_EVENT, event_reason(known or model.events))
    entities = list(model.entities)
    wide = wide.select(*CARRIED, BAD_EVENT, *[_typed_rows(e).alias(e.name) for e in entities])
    for level in model.levels:
        here = [e for e in entities if e.name in level]
        if not here:
            continue
        done = {e.name: _finished(e, model) for e in here}
        wide = wide.withColumns(done)
    if model.cascade:
        wide = _cascade(wide, model)
    return wide


def _typed_rows(e: Entity) -> Column:
    event, names = F.col("event_name"), e.column_names
    texts = F.transform(
        E.text_rows("doc", "event_name", e), lambda r: F.struct(r[E.ORD].alias(E.ORD), *E.cleaned(r.getField, names))
    )
    some = F.filter(texts, lambda r: E.filled(r.getField, e) | E.keeps_empty(event, e))
    return F.transform(some, lambda r: F.struct(r[E.ORD].alias(E.ORD), *E.typed(r.getField, e)))


def _with_parent(rows: Column, e: Entity, parent: Entity, fk: ForeignKey) -> Column:
    """Each row once for every parent id it takes.

    Event types that do not yield the parent leave the column as mapped, which is mostly NULL.
    """
    mapped = any(fk.column in s.fields for s in e.sources)
    yielding = sorted({s.event for s in parent.sources})

    def filled(r: Column, parent_id: Column) -> Column:
        taken = F.when(F.col("event_name").isin(*yielding), parent_id).otherwise(r[fk.column]) if mapped else parent_id
        cols = [(taken if n == fk.column else r[n]).alias(n) for n in e.column_names]
        return F.struct(r[E.ORD].alias(E.ORD), *cols)

    return let(
        R.parent_choices(R.ids(F.col(fk.parent)), fk),
        lambda choices: F.flatten(F.transform(rows, lambda r: F.transform(choices, lambda p: filled(r, p)))),
    )


def _finished(e: Entity, model: Model) -> Column:
    """Rows with parent ids, own id, derived columns, provenance and reasons."""
    rows, event, source_id = F.col(e.name), F.col("event_name"), F.col("source_id")
    parents = model.parents(e.name)
    for fk in parents:
        rows = _with_parent(rows, e, model.entity(fk.parent), fk)

    def identified(r: Column) -> Column:
        cols = [
            (e.derived[n][1](r[e.derived[n][0]]) if n in e.derived else r[n]).alias(n) for n in e.column_names
        ]
        at = r[e.time_column] if e.time_column else F.col("event_time")
        return F.struct(
            R.identify(r.getField, model, e, event, source_id).alias("id"),
            *cols,
            at.cast("timestamp").alias("received_at"),
            source_id.alias("source_id"),
            r[E.ORD].alias(E.ORD),
        )

    clashes = [
        F.when(F.size(R.ids(F.col(fk.parent))) > 1, F.lit(f"several parents:{fk.column}"))
        for fk in parents
        if fk.multi == "error"
    ]
    needed = [n for n in e.required if n not in ("id", "source_id")]

    def judged(r: Column) -> Column:
        kept = ["id", *e.column_names, "received_at", "source_id", E.ORD]
        why = Q.reasons(r.getField, needed, rejects=e.rejects, more=clashes)
        return F.struct(*[r[n].alias(n) for n in kept], why.alias(Q.REASONS))

    return F.transform(F.transform(rows, identified), judged)


def _cascade(wide: DataFrame, model: Model) -> DataFrame:
    """A row turned away by a rule takes every other row of its event with it."""
    hit = Q.any_of(
        F.exists(F.col(e.name), lambda r: F.exists(r[Q.REASONS], lambda w: w.startswith("rejected:")))
        for e in model.entities
        if e.rejects
    )
    marked = wide.withColumn("_hit", F.coalesce(hit, F.lit(False)))

    def turned(e: Entity) -> Column:
        return F.when(
            F.col("_hit"),
            F.transform(
                e.name,
                lambda r: r.withField(
                    Q.REASONS, F.when(F.size(r[Q.REASONS]) > 0, r[Q.REASONS]).otherwise(F.array(F.lit("event rejected")))
                ),
            ),
        ).otherwise(F.col(e.name))

    return marked.withColumns({e.name: turned(e) for e in model.entities}).drop("_hit")


# One table without the wide frame


def _side(e: Entity, i: int) -> str:
    return f"_parent_{e.name}_{i}"


def _slim(e: Entity, model: Model) -> Entity:
    """The entity with the columns only that make its sound rows' ids, where a required value tells that a row is one."""
    fks = {fk.column for fk in model.parents(e.name)}
    needed = {*e.required, *e.used_key, *fks, *[r.column for r in e.rejects]} | ({e.time_column} if e.time_column else set())
    needed |= {e.derived[n][0] for n in needed & set(e.derived)}
    telling = {n for n in e.required if n not in fks and n not in e.derived}
    if not all(telling & set(s.fields) for s in e.sources):
        return e
    return _narrowed(e, needed)


def _narrowed(e: Entity, names: set[str]) -> Entity:
    sources = tuple(replace(s, fields={n: p for n, p in s.fields.items() if n in names}) for s in e.sources)
    return replace(e, columns=tuple(c for c in e.columns if c.name in names), sources=sources)


def for_links(model: Model, *names: str) -> Model:
    """The part of a model that makes these links, or all of them, without what tells nothing about their rows:
    documents are parsed, stored and read for this alone."""
    return for_ids(model, *(names or [ln.name for ln in model.links]))


def for_ids(model: Model, *names: str) -> Model:
    """The part of a model that makes the ids of the sound rows of these tables, or of all, with the events they come from."""
    part = model.only(*names) if names else model
    return replace(part, entities=tuple(_slim(e, part) for e in part.entities))


def _ids(parent: str) -> str:
    return f"_ids_{parent}"


def with_parent_ids(events: DataFrame, model: Model) -> DataFrame:
    """Working events with what rows of several tables need of others: the ids of the sound rows they take as parents,
    an array for each parent, and whether a rule turns the event's rows away."""
    parents = sorted({fk.parent for fk in model.foreign_keys})
    hit, whole = _hit(model)
    made = _finished_above(events, model, sorted({*parents, *whole}), whole)
    ids = [R.ids(F.col(p)).alias(_ids(p)) for p in parents]
    return made.select(*events.columns, *ids, *([hit.alias("_hit")] if model.cascade else []))


def _hit(model: Model) -> tuple[Column, set[str]]:
    """Whether a rule turns a row of the event away, and the tables whose finished rows tell it."""
    ruled = [e for e in model.entities if e.rejects] if model.cascade else []
    # a rule on a parent's id needs the finished row
    whole = {e.name for e in ruled if {r.column for r in e.rejects} & {fk.column for fk in model.parents(e.name)}}
    return F.coalesce(Q.any_of(_rejects_some(e, model, e.name in whole) for e in ruled), F.lit(False)), whole


def _finished_above(events: DataFrame, model: Model, names: Sequence[str], whole: set[str]) -> DataFrame:
    """Events with the finished rows of these tables, as arrays."""
    if not names:
        return events
    above = replace(model.only(*names), cascade=False)
    above = replace(above, entities=tuple(e if e.name in whole else _slim(e, above) for e in above.entities))
    events = events.withColumns({p.name: _typed_rows(p) for p in above.entities})
    for level in above.levels:
        here = {p.name: _finished(p, above) for p in above.entities if p.name in level}
        events = events.withColumns(here) if here else events
    return events


def _held(events: DataFrame, model: Model, *entities: Entity) -> tuple[DataFrame, list[str]]:
    """Events that fill all of these tables, with the names of the columns that their rows are to carry: the ids of
    the rows' parents, made inside the event's row as arrays, and ``_hit`` where the model cascades."""
    names = set.intersection(*[{s.event for s in e.sources} for e in entities])
    held = events.filter(F.col("event_name").isin(*sorted(names)) if names else F.lit(False))
    fks = {_side(e, i): fk for e in entities for i, fk in enumerate(model.parents(e.name))}
    parents = {fk.parent for fk in fks.values()}
    stored = {p for p in parents if _ids(p) in events.columns}
    hit, whole = _hit(model) if "_hit" not in events.columns else (F.col("_hit"), set())
    held = _finished_above(held, model, sorted((parents - stored) | whole), whole)
    ids = {p: F.col(_ids(p)) if p in stored else R.ids(F.col(p)) for p in parents}
    carried = {f"_{c}": F.col(c) for c in CARRIED} | {n: ids[fk.parent] for n, fk in fks.items()}
    if model.cascade:
        carried["_hit"] = hit
    rows = {f"_rows_{e.name}": E.text_rows("doc", "event_name", e) for e in entities}
    return held.select(*[c.alias(n) for n, c in (carried | rows).items()]), list(carried)


def _rejects_some(e: Entity, model: Model, finished: bool) -> Column:
    """Whether a rule turns away some row of this table."""
    if finished:
        return F.exists(F.col(e.name), lambda r: F.exists(r[Q.REASONS], lambda w: w.startswith("rejected:")))

    def value(r: Column, name: str) -> Column:
        return e.derived[name][1](r[e.derived[name][0]]) if name in e.derived else r[name]

    ruled = {r.column for r in e.rejects}
    e = _narrowed(e, ruled | {e.derived[n][0] for n in ruled & set(e.derived)})
    return F.exists(_typed_rows(e), lambda r: Q.any_of(F.coalesce(Q.turned_away(lambda n: value(r, n), x), F.lit(False)) for x in e.rejects))


def _leave(held: DataFrame, model: Model, e: Entity, carried: Sequence[str], here: Column | None = None) -> tuple[DataFrame, dict]:
    """Rows of one entity out of their events, with the texts their ids are made of, beside the carried columns; and
    what to judge them by.

    They leave the event first and get types and ids as rows: in generated code, and only the columns that are used,
    where the lambdas of the wide frame are interpreted for each element. ``here`` picks rows by their place.
    """
    parents = model.parents(e.name)
    event, source_id = F.col("_event_name"), F.col("_source_id")
    texts = E.inlined(held, f"_rows_{e.name}", carried)
    texts = texts if here is None else texts.filter(here)
    clean = texts.select(*carried, E.ORD, *E.cleaned(F.col, e.column_names))
    some = clean.filter(E.filled(F.col, e) | E.keeps_empty(event, e))
    typed = some.select(*carried, E.ORD, *E.typed(F.col, e))
    for i, fk in enumerate(parents):
        typed = typed.select("*", F.explode_outer(R.parent_choices(F.col(_side(e, i)), fk)).alias("_taken"))
        yielding = sorted({s.event for s in model.entity(fk.parent).sources})
        mapped = any(fk.column in s.fields for s in e.sources)
        taken = F.when(event.isin(*yielding), F.col("_taken")).otherwise(F.col(fk.column)) if mapped else F.col("_taken")
        typed = typed.withColumn(fk.column, taken).drop("_taken") if fk.column in e.column_names else typed.drop("_taken")
    at = F.col(e.time_column) if e.time_column else F.col("_event_time")
    told = typed.select(
        R.identifying_text(F.col, model, e, event, source_id).alias(ID_TEXT),
        *[(e.derived[n][1](F.col(e.derived[n][0])) if n in e.derived else F.col(n)).alias(n) for n in e.column_names],
        at.cast("timestamp").alias("received_at"),
        source_id.alias("source_id"),
        E.ORD,
        *carried,
    )
    clashes = [
        F.when(F.size(_side(e, i)) > 1, F.lit(f"several parents:{fk.column}")) for i, fk in enumerate(parents) if fk.multi == "error"
    ]
    needed = [n for n in e.required if n not in ("id", "source_id")]
    return told, {"required": needed, "rejects": e.rejects, "more": clashes}


def _identified(rows: DataFrame) -> DataFrame:
    """Rows with an id in place of its text."""
    return rows.select(keyed_id(F.col(ID_TEXT), flat=True).alias("id"), *[c for c in rows.columns if c != ID_TEXT])


def _sound(model: Model, rules: dict) -> Column:
    own = Q.sound(F.col, **rules)
    return own & ~F.col("_hit") if model.cascade else own


def flat_rows(events: DataFrame, model: Model, entity: Entity) -> DataFrame:
    """All rows of one entity off working events, as ``entity_rows`` gives them off the wide frame."""
    held, carried = _held(events, model, entity)
    rows, rules = _leave(held, model, entity, carried)
    why = Q.reasons(F.col, **rules)
    if model.cascade:
        why = F.when(F.col("_hit") & Q.sound(F.col, **rules), F.array(F.lit("event rejected"))).otherwise(why)
    return _identified(rows).withColumn(Q.REASONS, why).drop(*carried)


def flat_newest(events: DataFrame, model: Model, entity: Entity, order: Sequence[str]) -> DataFrame:
    """The newest version of each sound row. Versions are told by the text of their id, which is made once the newest
    is found: a text is shorter where it moves, and a key that comes often is digested once."""
    held, carried = _held(events, model, entity)
    rows, rules = _leave(held, model, entity, carried)
    sound = E.passing(rows, _sound(model, rules)).drop(*carried)
    return _identified(D.latest_per_key(sound, [ID_TEXT], order))


def flat_links(events: DataFrame, model: Model, link: Link) -> DataFrame:
    """All rows of one link off working events, as ``link_rows`` gives them off the wide frame."""
    return R.finish_link(_pairs(events, model, link), link)


def newest_links(events: DataFrame, model: Model, link: Link, order: Sequence[str]) -> DataFrame:
    """The newest version of each link with a time. Only the bytes of both sides' ids move: the link's own id is made of them, once
    the newest is found."""
    sides = [link.left_column, link.right_column]
    pairs = _pairs(events, model, link).filter("received_at IS NOT NULL")
    small = pairs.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in sides)).withColumns({c: packed(F.col(c)) for c in sides})
    newest = D.latest_per_key(small, sides, order)
    return R.finish_link(newest.withColumns({c: unpacked(F.col(c)) for c in sides}), link)


def _pairs(events: DataFrame, model: Model, link: Link) -> DataFrame:
    """Pairs of ids of one link, before the link has its own.

    A sound left row leaves its event with the event's right rows, which then leave it in turn: what is done
    for each pair is in generated code, and no join is needed.
    """
    left, right = (_slim(model.entity(n), model) for n in (link.left, link.right))
    held, carried = _held(events, model, left, right)
    rights = f"_rows_{right.name}"
    # where both sides are one table, its rows are there once
    outer, rules = _leave(held.withColumn("_rights", F.col(rights)), model, left, [*carried, "_rights"])
    outer = E.kept(_identified(outer), _sound(model, rules), [*carried, "_rights"], F.col("id").alias("_left_id"), F.col(E.ORD).alias("_left_ord"))
    outer = outer.withColumnRenamed("_rights", rights)
    here = None
    if link.scope == "path":
        depth = R.shared_depth(model, link, F.col("_event_name"))
        here = F.slice(F.col(E.ORD), F.lit(1), depth) == F.slice(F.col("_left_ord"), F.lit(1), depth)
    rows, rules = _leave(outer, model, right, [*carried, "_left_id", "_left_ord"], here)
    return E.kept(
        _identified(rows),
        _sound(model, rules),
        [],
        F.col("_left_id").alias(link.left_column),
        F.col("id").alias(link.right_column),
        F.col("received_at"),
        F.col("source_id"),
    )


def flat_counts(events: DataFrame, model: Model) -> DataFrame:
    """``counts`` off working events; no rows where there are no events."""
    named = events.limit(1).select(F.explode(F.array(*[F.lit(e.name) for e in model.entities])).alias("table_name"), F.lit(None).cast("boolean").alias("valid"))

    def judged(e: Entity) -> DataFrame:
        held, carried = _held(events, model, e)
        rows, rules = _leave(held, model, e, carried)
        return rows.select(F.lit(e.name).alias("table_name"), _sound(model, rules).alias("valid"))

    total, valid = F.count("valid"), F.count_if("valid")
    return reduce(DataFrame.unionByName, map(judged, model.entities), named).groupBy("table_name").agg(
        total.alias("n_rows"), valid.alias("n_valid"), (total - valid).alias("n_failed")
    )


# Reading tables off the wide frame


def entity_rows(wide: DataFrame, entity: Entity) -> DataFrame:
    """All rows of one entity, sound and failed, with reasons."""
    return E.inlined(wide, entity.name, [])


def link_rows(wide: DataFrame, link: Link, model: Model, stored: bool = False) -> DataFrame:
    """All rows of one link table: pairs of sound rows of one event, by identity."""
    depth = R.shared_depth(model, link, F.col("event_name")) if link.scope == "path" else None
    found = wide.select("source_id", F.inline_outer(R.pairs(F.col(link.left), F.col(link.right), depth, stored)))
    named = found.select(
        F.col("left_id").alias(link.left_column), F.col("right_id").alias(link.right_column), "received_at", "source_id"
    )
    return R.finish_link(named, link)


def turned_away(wide: DataFrame) -> DataFrame:
    """Events that yield no rows, with the reason."""
    return wide.filter(F.col(BAD_EVENT).isNotNull()).select(*CARRIED, F.col(BAD_EVENT).alias("reason"))


def counts(wide: DataFrame, model: Model, stored: bool = False) -> DataFrame:
    """Rows, sound and failed, per entity: one pass over the wide frame for all of them."""

    def why(e: Entity) -> Column:
        return F.col(e.name)[Q.REASONS] if stored else F.transform(e.name, lambda r: r[Q.REASONS])

    per_event = F.array(
        *[
            F.struct(
                F.lit(e.name).alias("table_name"),
                let(why(e), lambda w: F.struct(F.size(F.filter(w, lambda x: F.size(x) == 0)), F.size(w))).alias("n"),
            )
            for e in model.entities
        ]
    )
    flat = wide.select(F.inline_outer(per_event))
    valid, total = (F.coalesce(F.sum(F.greatest(F.col(f"n.{c}"), F.lit(0))), F.lit(0)) for c in ("col1", "col2"))
    return flat.groupBy("table_name").agg(
        total.alias("n_rows"), valid.alias("n_valid"), (total - valid).alias("n_failed")
    )

"""Foreign keys and links between tables that came from the same event.

The arrays form works inside one event's row and needs no join; it is what a model run uses. The
frame form joins tables that exist apart from their documents, on the event id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventweft.functions.bind import let
from eventweft.functions.identity import key_text, keyed_id, row_id
from eventweft.operators.extract import ORD
from eventweft.operators.quality import REASONS
from eventweft.spec import Entity, ForeignKey, Link, Model

AMBIGUOUS = "_ambiguous"


_SLIM = f"array<struct<id:string,received_at:timestamp,{ORD}:array<int>,{REASONS}:array<string>>>"


def valid(rows: Column, stored: bool = False) -> Column:
    """The sound rows of an array.

    From stored rows, the fields that relations need are taken out one by one and put together
    again, so that the scan loads these only. Rows still being made would be made once per field.
    """
    if stored:
        rows = F.arrays_zip(rows["id"], rows["received_at"], rows[ORD], rows[REASONS]).cast(_SLIM)
    return F.filter(rows, lambda r: F.size(r[REASONS]) == 0)


def ids(rows: Column) -> Column:
    """Ids of the sound rows of an array, in document order."""
    return F.transform(valid(rows), lambda r: r["id"])


# Inside one event


def parent_choices(parent_ids: Column, fk: ForeignKey) -> Column:
    """``array<string>`` of the ids a child row takes, one child row for each; NULL without a parent."""
    none = F.array(F.lit(None).cast("string"))
    known = F.coalesce(parent_ids, F.array().cast("array<string>"))
    if fk.multi == "first":
        return F.slice(F.concat(known, none), 1, 1)
    enough = (lambda ids: F.size(ids) == 1) if fk.multi == "error" else (lambda ids: F.size(ids) > 0)
    return let(known, lambda ids: F.when(enough(ids), ids).otherwise(none))


def pairs(left: Column, right: Column, depth: Column | None = None, stored: bool = False) -> Column:
    """Id pairs of two row arrays of one event; with a depth, only those sharing that many positions."""

    def slim(rows: Column) -> Column:
        place = lambda r: F.concat_ws(",", F.slice(r[ORD], 1, depth).cast("array<string>"))
        return F.transform(
            valid(rows, stored),
            lambda r: F.struct(
                r["id"].alias("id"),
                r["received_at"].alias("received_at"),
                (F.lit(None).cast("string") if depth is None else place(r)).alias("place"),
            ),
        )

    def with_rights(a: Column, rights: Column) -> Column:
        if depth is not None:
            rights = F.filter(rights, lambda b: b["place"] == a["place"])
        return F.transform(
            rights,
            lambda b: F.struct(a["id"].alias("left_id"), b["id"].alias("right_id"), b["received_at"].alias("received_at")),
        )

    return let(slim(right), lambda rights: F.flatten(F.transform(slim(left), lambda a: with_rights(a, rights))))


def shared_depth(model: Model, link: Link, event: Column) -> Column:
    """How many array levels the two tables of a link share, by event type."""
    by_depth: dict[int, list[str]] = {}
    for name in model.events:
        lefts, rights = model.sources(name, link.left), model.sources(name, link.right)
        if lefts and rights:
            depth = min(_common_depth(a.rows_from, b.rows_from) for a in lefts for b in rights)
            by_depth.setdefault(depth, []).append(name)
    pick = F.lit(0)
    for depth, names in by_depth.items():
        pick = F.when(event.isin(*names), F.lit(depth)).otherwise(pick)
    return pick


def _common_depth(a: str, b: str) -> int:
    depth = 0
    for x, y in zip(a.split("."), b.split(".")):
        if x != y:
            break
        depth += x.endswith("[]")
    return depth


# Between frames


def resolve_parent(child: DataFrame, parent: DataFrame | None, fk: ForeignKey, on: str = "source_id") -> DataFrame:
    """The child with the parent's id in its column; NULL where the event has no sound parent.

    Parents are cut to distinct ids, or to one, before the join, so that a key with many parent
    copies is combined on the map side; adaptive skew handling splits a hot child key.
    """
    base = child.drop(fk.column)
    if parent is None:
        return base.withColumn(fk.column, F.lit(None).cast("string"))
    slim = parent.select(on, F.col("id").alias(fk.column))
    if fk.multi == "fanout":
        return base.join(slim.distinct(), on, "left")
    one = slim.groupBy(on).agg(F.min(fk.column).alias(fk.column), F.max(fk.column).alias("_other"))
    if fk.multi == "error":
        clash = F.col(fk.column) != F.col("_other")
        one = one.select(on, F.when(~clash, F.col(fk.column)).alias(fk.column), clash.alias(AMBIGUOUS))
        return base.join(one, on, "left")
    return base.join(one.drop("_other"), on, "left")


def link_frames(left: DataFrame, right: DataFrame, link: Link, on: str = "source_id") -> DataFrame:
    """Link rows of two tables that share an event; both sides cut to distinct ids first."""
    a = left.select(on, F.col("id").alias(link.left_column)).distinct()
    b = right.groupBy(on, F.col("id").alias(link.right_column)).agg(F.max("received_at").alias("received_at"))
    return finish_link(a.join(b, on).withColumnRenamed(on, "source_id"), link)


def finish_link(found: DataFrame, link: Link) -> DataFrame:
    """Identity of a link from its two foreign keys; pairs with a missing side are left out."""
    sides = [F.col(link.left_column), F.col(link.right_column)]
    return found.filter(sides[0].isNotNull() & sides[1].isNotNull()).select(
        link_id(*sides).alias("id"), *sides, "received_at", "source_id"
    )


def link_id(left: Column, right: Column) -> Column:
    return row_id([left, right], F.lit(None).cast("string"), flat=True)


def identify(
    get: Callable[[str], Column], model: Model, entity: Entity, event: Column, source_id: Column, flat: bool = False
) -> Column:
    """Id from the business key; from the event id in events that fill no key column at all. ``flat`` as in ``row_id``."""
    return keyed_id(identifying_text(get, model, entity, event, source_id), flat)


def identifying_text(get: Callable[[str], Column], model: Model, entity: Entity, event: Column, source_id: Column) -> Column:
    """The text that ``identify`` makes an id of."""
    from_key = key_text([get(k) for k in entity.used_key], source_id, entity.null_token)
    parents = {fk.column for fk in model.parents(entity.name)}
    by_event: dict[str, set[str]] = {}
    for s in entity.sources:
        by_event.setdefault(s.event, set(parents)).update(s.fields)
    keyless = sorted(e for e, cols in by_event.items() if not cols & set(entity.used_key))
    if not keyless or not entity.used_key:
        return from_key
    return F.when(event.isin(*keyless), key_text([], source_id)).otherwise(from_key)

"""Table descriptions: what a model of entities, foreign keys and links is made of.

A model is data. ``eventweft.plans`` compiles it to DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Column as SparkColumn
from pyspark.sql import types as T

from eventweft.functions import paths

SYSTEM_COLUMNS = ("id", "received_at", "source_id")


@dataclass(frozen=True)
class Column:
    name: str
    kind: str = "string"
    required: bool = False


@dataclass(frozen=True)
class Source:
    """Where rows of one entity come from in one event type.

    ``fields`` maps column to path. A path inside ``rows_from`` is read per row; any other is read
    from the document and repeated on every row. ``align="compact"`` instead collects each column
    into its own list, passing over gaps, and pairs the lists by position.
    """

    event: str
    rows_from: str
    fields: Mapping[str, str]
    align: str = "element"
    keep_empty: bool = False

    def __post_init__(self):
        if self.align not in ("element", "compact"):
            raise ValueError(f"unknown alignment {self.align!r}")

    def relative(self, path: str) -> str | None:
        """The rest of the path below ``rows_from``; None if it lies elsewhere in the document."""
        if self.rows_from == "":
            return path
        if path == self.rows_from:
            return ""
        return path[len(self.rows_from) + 1 :] if path.startswith(self.rows_from + ".") else None

    @property
    def kind(self) -> str:
        return "array" if any(paths.fans_out(p) for p in [self.rows_from, *self.fields.values()]) else "single"


@dataclass(frozen=True)
class Reject:
    """Rows whose column contains the text, in any case, are set aside."""

    column: str
    text: str


@dataclass(frozen=True)
class Entity:
    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...]
    sources: tuple[Source, ...]
    time_column: str | None = None
    rejects: tuple[Reject, ...] = ()
    # column -> (input column, function); applied after the id is made
    derived: Mapping[str, tuple[str, Callable[[SparkColumn], SparkColumn]]] = field(default_factory=dict)
    null_token: str | None = None

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required] + list(SYSTEM_COLUMNS)

    @property
    def used_key(self) -> list[str]:
        """Key columns the table has; a key column it lacks counts as NULL."""
        have = set(self.column_names)
        return [k for k in self.key if k in have]

    def schema(self) -> T.StructType:
        inner = [T.StructField(c.name, T._parse_datatype_string(c.kind), not c.required) for c in self.columns]
        return _with_system(inner)


@dataclass(frozen=True)
class ForeignKey:
    """The child's column takes the id of the parent row of the same event.

    ``multi`` says what several parents do: ``fanout`` repeats the child, ``first`` takes the
    first in document order (between frames, which have no such order, the least id), ``error``
    leaves NULL and gives the child a reason.
    """

    child: str
    parent: str
    column: str
    multi: str = "fanout"

    def __post_init__(self):
        if self.multi not in ("fanout", "first", "error"):
            raise ValueError(f"unknown multi {self.multi!r}")


@dataclass(frozen=True)
class Link:
    """Pairs of rows of one event; ``scope="path"`` keeps only pairs below the same array element."""

    name: str
    left: str
    right: str
    left_column: str
    right_column: str
    scope: str = "event"

    def __post_init__(self):
        if self.scope not in ("event", "path"):
            raise ValueError(f"unknown scope {self.scope!r}")

    def schema(self) -> T.StructType:
        return _with_system([T.StructField(c, T.StringType(), False) for c in (self.left_column, self.right_column)])


def _with_system(inner: list[T.StructField]) -> T.StructType:
    return T.StructType(
        [
            T.StructField("id", T.StringType(), False),
            *inner,
            T.StructField("received_at", T.TimestampType(), False),
            T.StructField("source_id", T.LongType(), False),
        ]
    )


@dataclass(frozen=True)
class Model:
    entities: tuple[Entity, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()
    links: tuple[Link, ...] = ()
    aliases: Mapping[str, str] = field(default_factory=dict)
    cascade: bool = False

    def __post_init__(self):
        names = [t.name for t in (*self.entities, *self.links)]
        twice = {n for n in names if names.count(n) > 1}
        if twice:
            raise ValueError(f"tables described twice: {sorted(twice)}")
        for fk in self.foreign_keys:
            if fk.column not in self.entity(fk.child).column_names:
                raise ValueError(f"{fk.child} has no column {fk.column!r} for its parent {fk.parent}")
            self.entity(fk.parent)
        for link in self.links:
            self.entity(link.left), self.entity(link.right)
        _ = self.levels

    @cached_property
    def _by_name(self) -> dict[str, Entity | Link]:
        return {t.name: t for t in (*self.entities, *self.links)}

    def table(self, name: str) -> Entity | Link:
        try:
            return self._by_name[name]
        except KeyError:
            raise KeyError(f"no table {name!r}; known: {sorted(self._by_name)}") from None

    def entity(self, name: str) -> Entity:
        found = self.table(name)
        if not isinstance(found, Entity):
            raise ValueError(f"{name!r} is a link, not an entity")
        return found

    def parents(self, child: str) -> list[ForeignKey]:
        return [fk for fk in self.foreign_keys if fk.child == child]

    def canonical(self, event: str) -> str:
        return self.aliases.get(event, event)

    @property
    def events(self) -> list[str]:
        return sorted({s.event for e in self.entities for s in e.sources})

    def sources(self, event: str, table: str) -> list[Source]:
        """Extraction of one table from one event type, through its alias."""
        event = self.canonical(event)
        return [s for s in self.entity(table).sources if s.event == event]

    @cached_property
    def levels(self) -> list[list[str]]:
        """Entities by distance from tables without parents, then the links."""
        depth: dict[str, int] = {}

        def visit(name: str, trail: tuple[str, ...]) -> int:
            if name in trail:
                raise ValueError(f"foreign keys form a circle: {' > '.join((*trail, name))}")
            if name not in depth:
                depth[name] = 1 + max((visit(fk.parent, (*trail, name)) for fk in self.parents(name)), default=-1)
            return depth[name]

        for e in self.entities:
            visit(e.name, ())
        out = [[e.name for e in self.entities if depth[e.name] == d] for d in range(max(depth.values(), default=-1) + 1)]
        return out + ([[ln.name for ln in self.links]] if self.links else [])

    def only(self, *names: str) -> Model:
        """The part of the model that these tables rest on: themselves, their parents, their sides."""
        wanted: set[str] = set()

        def add(name: str):
            t = self.table(name)
            wanted.add(name)
            for other in (t.left, t.right) if isinstance(t, Link) else [fk.parent for fk in self.parents(name)]:
                add(other)

        for name in names:
            add(name)
        if self.cascade:
            for e in self.entities:
                if e.rejects:
                    add(e.name)
        return replace(
            self,
            entities=tuple(e for e in self.entities if e.name in wanted),
            foreign_keys=tuple(fk for fk in self.foreign_keys if fk.child in wanted),
            links=tuple(ln for ln in self.links if ln.name in wanted),
        )

    @property
    def write_order(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def validate(self) -> list[str]:
        """Descriptions that cannot do what they seem to say."""
        notes = []
        for e in self.entities:
            have, filled = set(e.column_names), {fk.column for fk in self.parents(e.name)} | set(e.derived)
            for k in e.key:
                if k not in have:
                    notes.append(f"{e.name}: key column {k} is not in the table and is ignored")
            by_event: dict[str, set[str]] = {}
            for s in e.sources:
                for name in sorted(set(s.fields) - have):
                    notes.append(f"{e.name} from {s.event}: mapped column {name} is not in the table")
                by_event.setdefault(s.event, set()).update(s.fields)
            for event, mapped in sorted(by_event.items()):
                for c in e.columns:
                    if c.required and c.name not in mapped | filled:
                        notes.append(f"{e.name} from {event}: required column {c.name} is never filled, every row fails")
                for k in e.used_key:
                    if k not in mapped | filled:
                        notes.append(f"{e.name} from {event}: key column {k} is not mapped, ids differ between events")
        return notes

    # The description itself as frames, to join against or to publish.

    def source_frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (s.event, e.name, column, path, s.rows_from, s.kind)
            for e in self.entities
            for s in e.sources
            for column, path in s.fields.items()
        ]
        return spark.createDataFrame(
            rows, "event string, table_name string, column_name string, path string, rows_from string, kind string"
        )

    def order_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(name, d, i) for d, level in enumerate(self.levels) for i, name in enumerate(level)]
        return spark.createDataFrame(rows, "table_name string, level int, place int")

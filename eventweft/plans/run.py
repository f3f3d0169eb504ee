"""One batch: landing rows in, finished tables out, written in dependency order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweft.operators import dedup as D
from eventweft.operators import extract as E
from eventweft.operators import quality as Q
from eventweft.plans import shred as S
from eventweft.session import staged
from eventweft.spec import Entity, Link, Model

VERSION_ORDER = ["received_at", "source_id"]


@dataclass(frozen=True)
class Batch:
    """The tables of one batch, read lazily: off the staged wide frame, or straight off the events or their staged
    documents."""

    model: Model
    landed: DataFrame
    staged: DataFrame | None = None
    documents: DataFrame | None = None

    def wide(self, *names: str) -> DataFrame:
        """The wide frame, narrowed to what the named tables rest on where it is not staged."""
        if self.staged is not None:
            return self.staged
        part = self.model.only(*names) if names else self.model
        return S.shred(self.working_events(part), part, known=self.model.events)

    def working_events(self, part: Model) -> DataFrame:
        return S.working_events(self.landed, part) if self.documents is None else self.documents

    @property
    def _flat(self) -> bool:
        """Whether a table is read without a wide frame: none is staged."""
        return self.staged is None

    def all_rows(self, name: str) -> DataFrame:
        table = self.model.table(name)
        if isinstance(table, Link):
            return self._links(table).withColumn(Q.REASONS, Q.reasons(F.col, ["received_at"]))
        if self._flat:
            part = self.model.only(name)
            return S.flat_rows(self.working_events(part), part, table)
        return S.entity_rows(self.wide(name), table)

    def _links(self, link: Link) -> DataFrame:
        if not self._flat:
            return S.link_rows(self.staged, link, self.model, True)
        part = self.model.only(link.name)
        return S.flat_links(self.working_events(part), part, link)

    def lookup(self, name: str) -> DataFrame:
        """Sound rows as extracted, so that children can refer to rows stored long before."""
        return E.conform(self.all_rows(name).filter(Q.passes()), self.model.table(name).schema())

    def succeeded(self, name: str, stored: DataFrame | None = None) -> DataFrame:
        """Newest version of each sound row, without those stored before."""
        table = self.model.table(name)
        # Newest version first: each map task keeps one row per id, so a hot id is small in the join.
        rows = self._newest(table)
        if stored is not None:
            rows = D.new_only(rows, stored)
        return E.conform(rows, table.schema())

    def _newest(self, table: Entity | Link) -> DataFrame:
        order = VERSION_ORDER if isinstance(table, Link) else [*VERSION_ORDER, E.ORD]
        if self._flat:
            part = self.model.only(table.name)
            newest = S.newest_links if isinstance(table, Link) else S.flat_newest
            return newest(self.working_events(part), part, table, order)
        rows = self._links(table).filter("received_at IS NOT NULL") if isinstance(table, Link) else self.all_rows(table.name).filter(Q.passes())
        return D.latest_per_key(rows, ["id"], order)

    def failed(self, name: str) -> DataFrame:
        """Every failed row with its reasons; two failures that share an id both stay."""
        rows = self.all_rows(name).filter(~Q.passes())
        schema = self.model.table(name).schema()
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema], Q.REASONS)

    def turned_away(self) -> DataFrame:
        return S.turned_away(self.wide())

    def counts(self, *names: str) -> DataFrame:
        """Rows, sound and failed, per entity, of all entities or those named and their parents."""
        part = self.model.only(*names) if names else self.model
        if self._flat:
            events = staged(S.with_parent_ids(self.working_events(part), part), "documents") if self.documents is None else self.documents
            return S.flat_counts(events, part)
        return S.counts(self.wide(*names), part, True)


def open_batch(landed: DataFrame, model: Model, stage: bool | str = False) -> Batch:
    """Landing rows to a batch. ``stage`` writes the wide frame once to the shared folder, ``stage="documents"``
    the parsed documents.

    Stage when several tables are read: documents are then parsed once, and a table's job reads
    its own column of the staged files only. Staged documents cost less where tables are read once each.
    """
    batch = Batch(model, Q.null_guard(landed))
    if stage == "documents":
        return Batch(model, batch.landed, documents=staged(S.with_parent_ids(batch.working_events(model), model), "documents"))
    return Batch(model, batch.landed, staged(batch.wide(), "wide")) if stage else batch

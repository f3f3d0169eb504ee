"""Rows that break a rule are set aside together with the reasons, never dropped."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventweft.spec import Reject

REASONS = "_reasons"


def all_of(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def any_of(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def reasons(
    get: Callable[[str], Column],
    required: Sequence[str] = (),
    finite: Sequence[str] = (),
    rejects: Sequence[Reject] = (),
    more: Sequence[Column] = (),
) -> Column:
    """Every reason a row fails, as one array; empty for a sound row."""
    found = _found(get, required, finite, rejects, more)
    return F.filter(F.array(*found), lambda r: r.isNotNull()) if found else F.array().cast("array<string>")


def sound(
    get: Callable[[str], Column], required: Sequence[str] = (), rejects: Sequence[Reject] = (), more: Sequence[Column] = ()
) -> Column:
    """Whether ``reasons`` is empty, without making it: no lambda, so that generated code can hold it."""
    return all_of(r.isNull() for r in _found(get, required, (), rejects, more))


def turned_away(get: Callable[[str], Column], reject: Reject) -> Column:
    return F.lower(get(reject.column)).contains(reject.text.lower())


def _found(
    get: Callable[[str], Column], required: Sequence[str], finite: Sequence[str], rejects: Sequence[Reject], more: Sequence[Column]
) -> list[Column]:
    found = [F.when(get(c).isNull(), F.lit(f"null:{c}")) for c in required]
    found += [F.when(not_finite(get(c)), F.lit(f"not finite:{c}")) for c in finite]
    found += [F.when(turned_away(get, r), F.lit(f"rejected:{r.column}")) for r in rejects]
    return found + list(more)


def not_finite(value: Column) -> Column:
    """NaN or an infinity in a double."""
    return F.isnan(value) | value.isin(float("inf"), float("-inf"))


def passes() -> Column:
    return F.size(REASONS) == 0


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sound rows without the reason column, failed rows with it."""
    return rows.filter(passes()).drop(REASONS), rows.filter(~passes())


def reconcile(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows, sound and failed, counted in one pass."""
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(passes()).alias("n_valid"),
        F.count_if(~passes()).alias("n_failed"),
    )


def null_guard(events: DataFrame, raw: str = "raw", key: str = "id") -> DataFrame:
    """Events without an id are left out; an event without text counts as an empty document."""
    return events.filter(F.col(key).isNotNull()).na.fill({raw: "{}"})

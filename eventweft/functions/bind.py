"""Name a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once.

    Generated code shares repeated subexpressions by itself, but not inside the lambda of a
    higher-order function; there, a value used several times would be computed several times.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))

"""Small expression helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fence(df: DataFrame) -> DataFrame:
    """Keep the computed columns of ``df`` computed once per row.

    A filter on a computed column is normally pushed through the projection by copying the
    expression, so a long rule set or a JSON parse would run again for the filter. A one-row
    generator stops that copy and stays inside whole-stage code generation.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))

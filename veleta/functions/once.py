"""Evaluate an expensive expression once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def add_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns through a one-row generator.

    The optimiser moves a filter below a plain projection by copying the projected
    expression into it; a chain of pattern replacements would then run once for the filter
    and once for the output.  It never moves a filter through a generator, so the value is
    computed once per row.  Replaces columns of the same name.
    """
    rest = [c for c in df.columns if c not in columns]
    return df.select(*[F.col(f"`{c}`") for c in rest],
                     F.inline(F.array(F.struct(*[e.alias(n) for n, e in columns.items()]))))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated a single time inside higher-order functions.

    Without it an expression used inside a lambda is evaluated again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))

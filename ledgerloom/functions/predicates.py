"""Predicates that treat nulls as data: membership is never null."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_in(c: Column, values: Iterable) -> Column:
    """Whether c is one of the values; a null c is in them only if they hold None."""
    values = list(values)
    there = [v for v in values if v is not None]
    found = F.coalesce(c.isin(there), F.lit(False)) if there else F.lit(False)
    return found | c.isNull() if len(there) < len(values) else found


def not_in(c: Column, values: Iterable) -> Column:
    return ~is_in(c, values)


def is_true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def is_false(c: Column) -> Column:
    return F.coalesce(~c, F.lit(False))


def same(a: Column, b: Column) -> Column:
    """Equal, or both null."""
    return a.eqNullSafe(b)

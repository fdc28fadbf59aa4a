"""Filter predicates. A NULL in the column never matches."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_list(value) -> list:
    """A scalar becomes a one-element list."""
    if isinstance(value, (list, tuple, set, frozenset)):
        return list(value)
    return [value]


def in_list(column: Column, values) -> Column:
    """Membership in a Python list, or in an array column."""
    if isinstance(values, Column):
        return F.array_contains(values, column)
    return column.isin(list(values))


def equals(column: Column, value) -> Column:
    return column == F.lit(value)


def between(column: Column, low, high) -> Column:
    """Both ends included; ``low > high`` matches nothing."""
    return column.between(F.lit(low), F.lit(high))


def contains_ci(column: Column, word: str, literal: bool = False) -> Column:
    """``word`` occurs in the column, in any case.

    ``%`` and ``_`` in the word act as wildcards unless ``literal`` is set. A
    backslash is always a plain character, so it is doubled for ILIKE.
    """
    if literal:
        return F.contains(F.lower(column), F.lower(F.lit(word)))
    return column.ilike("%" + word.replace("\\", "\\\\") + "%")


def conjunction(tests: Iterable[Column]) -> Column | None:
    tests = list(tests)
    return reduce(and_, tests) if tests else None

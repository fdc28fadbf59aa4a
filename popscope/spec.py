"""Description of a population table: which column plays which part.

Every operator takes a ``PopulationSpec``, so the same code serves any table.
The spec also holds the argument checks, which run before a plan is built.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from popscope.functions import keys, predicates


@dataclass(frozen=True)
class ColumnRole:
    """One filterable column.

    ``kind`` is ``categorical``, ``range`` or ``freetext`` and decides the filter
    key: the column name, ``<column>_range`` or ``<column>_contains``.
    """

    name: str
    kind: str
    description: str = ""
    values: tuple = ()  # known values, shown by describe
    closed: bool = False  # one value only, refused when not in ``values``
    bounds: tuple | None = None  # widest range a caller may ask for
    whole: bool = False  # range ends must be integers
    list_values: bool = True  # describe shows all values that occur
    literal: bool = False  # treat % and _ in a search word as plain characters

    @property
    def key(self) -> str:
        return self.name + {"categorical": "", "range": "_range", "freetext": "_contains"}[self.kind]

    def predicate(self, value) -> Column | None:
        """The test for ``value``, or None when it sets no constraint."""
        if self.kind == "freetext":
            if not isinstance(value, str):
                raise ValueError(f"{self.key} must be a string, got {value!r}")
            return predicates.contains_ci(F.col(self.name), value, literal=self.literal)
        if self.kind == "range":
            low, high = self._range_ends(value)
            return predicates.between(F.col(self.name), low, high)
        if self.closed:
            if value not in self.values:
                raise ValueError(f"{self.key} must be one of {list(self.values)}, got {value!r}")
            return predicates.equals(F.col(self.name), value)
        wanted = predicates.as_list(value)
        return predicates.in_list(F.col(self.name), wanted) if wanted else None

    def _range_ends(self, value):
        if isinstance(value, str) or not isinstance(value, Sequence) or len(value) != 2:
            raise ValueError(f"{self.key} must be a pair (low, high), got {value!r}")
        for end in value:
            if isinstance(end, bool) or not isinstance(end, int if self.whole else (int, float)):
                raise ValueError(f"{self.key} ends must be {'integers' if self.whole else 'numbers'}, got {value!r}")
        low, high = value
        if self.bounds and (low < self.bounds[0] or high > self.bounds[1]):
            raise ValueError(f"{self.key} must lie within {list(self.bounds)}, got {value!r}")
        return low, high


def categorical(name, description="", values=(), closed=False, list_values=True) -> ColumnRole:
    return ColumnRole(name, "categorical", description, tuple(values), closed, list_values=list_values)


def number_range(name, description="", bounds=None, whole=False) -> ColumnRole:
    return ColumnRole(name, "range", description, bounds=bounds, whole=whole)


def freetext(name, description="", literal=False) -> ColumnRole:
    return ColumnRole(name, "freetext", description, literal=literal)


@dataclass(frozen=True)
class Dimension:
    """A grouping: a column as it is, or the decades of a whole-number column."""

    column: str
    decades: bool = False
    suffix: str = ""

    def key(self) -> Column:
        """Grouping key of a panel stratum."""
        return keys.decade(F.col(self.column)) if self.decades else F.col(self.column)

    def label(self) -> Column:
        """Text shown as the bucket's value."""
        if self.decades:
            return keys.decade_label(F.col(self.column), self.suffix)
        return F.col(self.column).cast("string")


@dataclass(frozen=True)
class PopulationSpec:
    id: str | tuple[str, ...]  # several columns where only samples and panels are drawn
    columns: tuple[ColumnRole, ...] = ()
    strata: Mapping[str, Dimension] = field(default_factory=dict)
    dimensions: Mapping[str, Dimension] = field(default_factory=dict)
    passage: tuple[str, ...] = ()  # texts joined into the passage to index
    summary: tuple[str, ...] = ()  # sex, age, province, district, occupation or their like
    schema: StructType | None = None
    data_version: str = ""
    citation: str = ""

    def predicate(self, filters: Mapping | None) -> Column | None:
        """All given filters ANDed; None when nothing is constrained."""
        roles = {role.key: role for role in self.columns}
        tests = []
        for key, value in (filters or {}).items():
            if key not in roles:
                raise ValueError(f"unknown filter {key!r}; known: {sorted(roles)}")
            if value is not None:
                tests.append(roles[key].predicate(value))
        return predicates.conjunction(test for test in tests if test is not None)

    def stratum(self, name: str) -> Dimension:
        return _pick(self.strata, name, "stratify_by")

    def dimension(self, name: str) -> Dimension:
        return _pick(self.dimensions, name, "group_by")

    @property
    def id_columns(self) -> tuple[str, ...]:
        """The columns that tell rows apart; ``id`` may name one or several."""
        return (self.id,) if isinstance(self.id, str) else tuple(self.id)


def checked_count(n: int, name: str = "n") -> int:
    if isinstance(n, bool) or not isinstance(n, int) or n < 1:
        raise ValueError(f"{name} must be a whole number from 1 on, got {n!r}")
    return n


def checked_seed(seed: int | None) -> int | None:
    if seed is not None and (isinstance(seed, bool) or not isinstance(seed, int)):
        raise ValueError(f"seed must be an integer, got {seed!r}")
    return seed


def _pick(choices, name, argument):
    if name not in choices:
        raise ValueError(f"{argument} must be one of {sorted(choices)}, got {name!r}")
    return choices[name]

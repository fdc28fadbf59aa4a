"""Rows that match a filter, and how many there are."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscope.spec import PopulationSpec


def matching(population: DataFrame, spec: PopulationSpec, filters: Mapping | None = None) -> DataFrame:
    test = spec.predicate(filters)
    return population if test is None else population.where(test)


def count_matching(population: DataFrame, spec: PopulationSpec, filters: Mapping | None = None) -> DataFrame:
    """One row, column ``n``."""
    return matching(population, spec, filters).agg(F.count(F.lit(1)).alias("n"))

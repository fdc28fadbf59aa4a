"""How the population is distributed over one dimension."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscope.operators.filtering import matching
from popscope.spec import PopulationSpec, checked_count


def stats(
    population: DataFrame,
    spec: PopulationSpec,
    group_by: str,
    filters: Mapping | None = None,
    limit: int | None = None,
) -> DataFrame:
    """The largest buckets, or all without ``limit``, as ``value``, ``count``; equal counts by value."""
    dimension = spec.dimension(group_by)
    buckets = (
        matching(population, spec, filters)
        .groupBy(dimension.label().alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    ordered = buckets.orderBy(F.desc("count"), F.asc_nulls_last("value"))
    return ordered if limit is None else ordered.limit(checked_count(limit, "limit"))

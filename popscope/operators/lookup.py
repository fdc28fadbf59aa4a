"""Rows by id, and the rows behind a ranked list of ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscope.operators.filtering import matching
from popscope.spec import PopulationSpec


def get_by_id(population: DataFrame, spec: PopulationSpec, id) -> DataFrame:
    """The row with this id, or no row."""
    return population.where(F.col(spec.id) == F.lit(id)).limit(1)


def get_by_ids(
    population: DataFrame,
    spec: PopulationSpec,
    ids: Sequence | DataFrame,
    filters: Mapping | None = None,
) -> DataFrame:
    """All rows with these ids that pass the filters, in no particular order.

    ``ids`` is a Python sequence, or a one-column DataFrame of any size. Ids are compared as the
    population's type; one that is none of that type matches nothing.
    """
    kind = population.schema[spec.id].dataType
    if not isinstance(ids, DataFrame):
        ids = population.sparkSession.createDataFrame([(None if i is None else str(i),) for i in ids], "id string")
    ids = ids.toDF(spec.id).select(F.col(spec.id).cast("string").try_cast(kind).alias(spec.id))
    rows = matching(population, spec, filters)
    # Distinct first: an id that is listed very often must not fill one task of the join.
    return rows.join(ids.toDF(spec.id).distinct(), spec.id, "left_semi")


def duplicate_ids(population: DataFrame, spec: PopulationSpec) -> DataFrame:
    """Ids that occur more than once; empty for a sound population."""
    counts = population.groupBy(spec.id).agg(F.count(F.lit(1)).alias("count"))
    return counts.where("count > 1")

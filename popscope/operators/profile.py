"""What can be filtered, and by which values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscope.spec import PopulationSpec


def describe_filters(
    population: DataFrame, spec: PopulationSpec, exact: bool = True
) -> DataFrame:
    """One row per filterable column, measured on the data.

    ``name``, ``type``, ``description``, ``allowed_values`` (of columns with
    ``list_values``), ``range_min`` and ``range_max``, ``cardinality`` (categories), ``total_records``,
    ``data_version``, ``citation``. With ``exact=False`` cardinalities are estimated
    in a single pass and values are listed only where the spec names them.
    """
    ranges = [role.name for role in spec.columns if role.kind == "range"]
    categories = [role.name for role in spec.columns if role.kind == "categorical"]
    measures = [F.count(F.lit(1)).alias("total_records")]
    for name in ranges:
        measures += [F.min(name).cast("double").alias(f"min_{name}"), F.max(name).cast("double").alias(f"max_{name}")]
    if not exact:
        measures += [F.approx_count_distinct(name).alias(f"card_{name}") for name in categories]
    totals = population.agg(*measures)
    entry = F.explode(F.array(*[_entry(role, exact) for role in spec.columns])).alias("entry")
    rows = totals.select(entry, "total_records").select("entry.*", "total_records")
    if exact and categories:
        listed = [role.name for role in spec.columns if role.kind == "categorical" and role.list_values]
        found = _categories(population, categories, listed)
        rows = rows.withColumnRenamed("cardinality", "none").join(found, "name", "left")
        counted = F.when(F.col("type") == "categorical", F.coalesce("cardinality", F.lit(0)))
        rows = rows.withColumn("cardinality", counted.cast("long"))
        rows = rows.withColumn("allowed_values", F.coalesce("values", "allowed_values"))
    return rows.select(
        "name", "type", "description", "allowed_values", "range_min", "range_max", "cardinality",
        "total_records", F.lit(spec.data_version).alias("data_version"), F.lit(spec.citation).alias("citation"),
    )


def _entry(role, exact):
    nothing = F.lit(None)
    values = F.array(*[F.lit(str(v)) for v in role.values]) if role.values else nothing
    is_range = role.kind == "range"
    estimated = not exact and role.kind == "categorical"
    return F.struct(
        F.lit(role.name).alias("name"),
        F.lit(role.kind).alias("type"),
        F.lit(role.description).alias("description"),
        values.cast("array<string>").alias("allowed_values"),
        (F.col(f"min_{role.name}") if is_range else nothing.cast("double")).alias("range_min"),
        (F.col(f"max_{role.name}") if is_range else nothing.cast("double")).alias("range_max"),
        (F.col(f"card_{role.name}") if estimated else nothing.cast("long")).alias("cardinality"),
    )


def _categories(population: DataFrame, names: list[str], listed: list[str]) -> DataFrame:
    """``name``, ``cardinality`` and the sorted ``values`` of the ``listed`` columns.

    Values are counted per column first, so what is shuffled is distinct values and not rows.
    A column whose values are too many to list should be declared with ``list_values=False``.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("string").alias("value")) for n in names])
    )
    values = population.select(pairs.alias("pair")).select("pair.*").where("value IS NOT NULL").distinct()
    shown = F.when(F.col("name").isin(listed), F.col("value"))
    lists = values.groupBy("name").agg(F.count("value").alias("cardinality"), F.sort_array(F.collect_list(shown)).alias("values"))
    return lists.withColumn("values", F.when(F.size("values") > 0, F.col("values")))

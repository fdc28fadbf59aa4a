"""Repeatable random samples and panels.

On a table straight from files, up to ``lowest.TOP_N`` rows are picked over narrow columns and
then read whole from their files (``plans.late_rows``). The rows are the same either way.
"""

from __future__ import annotations

import random
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscope.functions.keys import random_key
from popscope.operators.filtering import matching
from popscope.operators.ranking import first_per_group
from popscope.plans.late_rows import FILE, PLACE, read_picked, with_place
from popscope.plans.lowest import TOP_N, lowest
from popscope.spec import PopulationSpec, checked_count, checked_seed

KEY, INNER, STRATUM, RANK = "_popscope_key", "_popscope_inner", "_popscope_stratum", "_popscope_rank"


def sample(
    population: DataFrame,
    spec: PopulationSpec,
    n: int,
    filters: Mapping | None = None,
    seed: int | None = None,
) -> DataFrame:
    """min(n, matches) rows drawn uniformly without replacement.

    Rows that share an id share their place in the order; give the spec an id of several
    columns where one does not tell the rows apart. A null id is an id like others.
    """
    n, seed = checked_count(n), _seed(seed)

    def pick(rows, ties):
        # The key is a column, not a sort expression, so it is hashed once per row.
        keyed = matching(rows, spec, filters).withColumn(KEY, random_key(spec.id_columns, seed))
        return lowest(keyed, KEY, [*spec.id_columns, *ties], n)

    return _whole(population, n, pick)


def panel(
    population: DataFrame,
    spec: PopulationSpec,
    n: int,
    stratify_by: str | None = None,
    filters: Mapping | None = None,
    seed: int | None = None,
) -> DataFrame:
    """n rows spread over the strata: one random row of each, then a second, ...

    Strata come in random order within a round, by a key that is independent of
    the one inside the strata; with one key for both, large strata would come first.
    """
    if stratify_by is None:
        return sample(population, spec, n, filters, seed)
    n, seed, stratum = checked_count(n), _seed(seed), spec.stratum(stratify_by)

    def pick(rows, ties):
        rows = matching(rows, spec, filters)
        deepest = n if n <= TOP_N else _rounds(rows.groupBy(stratum.key().alias(STRATUM)).count(), n)
        keyed = rows.withColumns({STRATUM: stratum.key(), INNER: random_key(spec.id_columns, seed, "a")})
        # No row past that rank of its stratum can be among the first n of all.
        ranked = first_per_group(keyed, [STRATUM], [INNER, *spec.id_columns, *ties], deepest, RANK)
        across = ranked.withColumn(KEY, random_key(spec.id_columns, seed, "b"))
        # Round and key as one text, so that a large n is found by its first digits.
        across = across.withColumn(KEY, F.concat(F.lpad(F.lower(F.hex(RANK)), 16, "0"), KEY))
        return lowest(across, KEY, [*spec.id_columns, *ties], n)

    return _whole(population, n, pick)


def _rounds(sizes: DataFrame, n: int) -> int:
    """How often each stratum must be asked until n rows are found; n if they run out before."""
    # Strata of one size are alike: what comes to the driver is one row per size.
    alike = sorted((row["count"], row["strata"]) for row in sizes.groupBy("count").agg(F.count(F.lit(1)).alias("strata")).collect())
    left, done, open_ = n, 0, sum(strata for _, strata in alike)
    for size, strata in alike:
        if (size - done) * open_ >= left:
            return done + -(-left // open_)
        left -= (size - done) * open_
        done, open_ = size, open_ - strata
    return n


def _seed(seed: int | None) -> int:
    """The seed, or one drawn now: a plan of several passes must see one order."""
    seed = checked_seed(seed)
    return random.getrandbits(62) if seed is None else seed


def _whole(population: DataFrame, n: int, pick) -> DataFrame:
    placed = with_place(population) if n <= TOP_N else None
    if placed is None:
        return pick(population, []).select(population.columns)
    return read_picked(population, pick(placed, [FILE, PLACE]).select(FILE, PLACE))


def sample_late(population: DataFrame, spec: PopulationSpec, n: int, filters: Mapping | None = None, seed: int | None = None) -> DataFrame:
    """``sample``, which reads late by itself; kept for callers of the older name."""
    return sample(population, spec, n, filters, seed)


def panel_late(
    population: DataFrame, spec: PopulationSpec, n: int, stratify_by: str | None = None, filters: Mapping | None = None, seed: int | None = None
) -> DataFrame:
    """``panel``, which reads late by itself; kept for callers of the older name."""
    return panel(population, spec, n, stratify_by, filters, seed)

"""Reading whole rows only for the few that were picked.

A sample of 20 rows needs the ids and filter columns of the whole table, but the
long text columns of 20 rows only. So the pick runs over narrow columns and notes
the file and the place in it of each picked row; then those files alone are read in full.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

FILE, PLACE, POSITION = "_popscope_file", "_popscope_place", "_popscope_position"


def with_place(rows: DataFrame) -> DataFrame | None:
    """``rows`` with each row's file and its number there; None if they are not straight from files."""
    try:
        return rows.withColumns({FILE: F.col("_metadata.file_path"), PLACE: F.col("_metadata.row_index")})
    except AnalysisException:
        return None


def read_picked(population: DataFrame, picked: DataFrame) -> DataFrame:
    """Whole rows of ``picked`` (``FILE``, ``PLACE`` and columns to add), in its order.

    ``picked`` must end in a limit of at most ``lowest.TOP_N``: its rows come to the driver, to be
    named in the second scan. There the file paths decide which files are opened at all.
    """
    added = [field for field in picked.schema.fields if field.name not in (FILE, PLACE)]
    rows = picked.collect()
    if not rows:
        empty = population.where(F.lit(False))
        return empty.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in added])
    files = sorted({row[FILE] for row in rows})
    place = StructType([StructField(FILE, StringType()), StructField(PLACE, LongType()), *added, StructField(POSITION, LongType())])
    places = [(row[FILE], row[PLACE], *[row[f.name] for f in added], at) for at, row in enumerate(rows)]
    local = population.sparkSession.createDataFrame(places, place)
    found = with_place(population.where(F.col("_metadata.file_path").isin(files)))
    # As few rows as were picked.
    found = found.join(F.broadcast(local), [FILE, PLACE]).orderBy(POSITION).limit(len(rows))
    return found.select(*population.columns, *[f.name for f in added])

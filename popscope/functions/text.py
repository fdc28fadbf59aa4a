"""Text built from row fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The one-line summary format.
SUMMARY_FORMAT = "[%s] %s %s세 / %s %s / %s"
SUMMARY_ID_CHARS = 8


def row_summary(id_column: Column, fields: Sequence[str]) -> Column:
    """One line per row from five fields: sex, age, province, district, occupation."""
    if len(fields) != 5:
        raise ValueError(f"a summary needs five columns, got {list(fields)}")
    head = F.substring(id_column.cast("string"), 1, SUMMARY_ID_CHARS)
    return F.format_string(SUMMARY_FORMAT, head, *[F.col(c).cast("string") for c in fields])


def passage_text(fields: Sequence[str]) -> Column:
    """The fields joined by a space, leaving out NULL and empty ones."""
    return F.concat_ws(" ", *[F.nullif(F.col(c).cast("string"), F.lit("")) for c in fields])


def with_prefix(prefix: str, text: Column) -> Column:
    return F.concat(F.lit(prefix), text)


def row_json(columns: Sequence[str]) -> Column:
    """The row as a JSON object; NULL fields stay in it as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})

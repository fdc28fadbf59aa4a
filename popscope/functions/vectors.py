"""Vector expressions that stay in the JVM: float elements, double arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_norm(vector: Column) -> Column:
    squares = F.aggregate(
        vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    return F.sqrt(squares)


def l2_normalize(vector: Column) -> Column:
    """The vector at length one; NULL for a vector of length zero."""
    norm = l2_norm(vector)
    return F.when(
        norm > 0, F.transform(vector, lambda x: (x.cast("double") / norm).cast("float"))
    )


def cosine(a: Column, b: Column) -> Column:
    norms = l2_norm(a) * l2_norm(b)
    return F.when(norms > 0, dot(a, b) / norms)


def checked_width(vector: Column, dim: int) -> Column:
    """The packed vector, failing the job on any row of another width."""
    width = F.octet_length(vector) / 4
    message = F.format_string(f"vector width mismatch: expected {dim}, found %.0f; rebuild the index", width)
    return F.when(vector.isNull() | (width == dim), vector).otherwise(F.raise_error(message))

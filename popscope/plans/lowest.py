"""The n rows with the smallest keys, for any n."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP_N = 10_000  # so many rows may meet in one task and travel to the driver
DIGITS = 4  # of the key, per round of counting
KEY_DIGITS = 32


def lowest(rows: DataFrame, key: str, ties: list[str], n: int, top_n: int = TOP_N) -> DataFrame:
    """The n rows with the smallest ``key``, a hash in hex, in the order of key and ties.

    Up to ``top_n`` rows every task keeps its own n. Beyond, rows are counted by the first digits
    of the key. All rows below the digits at which the n-th row falls are in, wherever they
    are, and only the rows with those digits are put in order to find the rest.
    """
    if n <= top_n:
        return rows.orderBy(key, *ties).limit(n)
    edge, below = "", 0
    while len(edge) < KEY_DIGITS:
        first = F.substring(key, 1, len(edge) + DIGITS)
        inside = rows.where(F.col(key).startswith(edge)) if edge else rows
        counts = inside.groupBy(first.alias("digits")).agg(F.count(F.lit(1)).alias("rows")).collect()  # 16 ** DIGITS at most
        for row in sorted(counts, key=lambda row: row["digits"]):
            if below + row["rows"] >= n:
                break
            below += row["rows"]
        else:  # fewer than n rows in all
            return rows.orderBy(key, *ties)
        edge = row["digits"]
        if row["rows"] <= top_n:
            break
    rest = rows.where(F.col(key).startswith(edge)).orderBy(key, *ties).limit(n - below)
    return rows.where(F.col(key) < edge).unionByName(rest).orderBy(key, *ties)

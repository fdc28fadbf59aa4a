"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target of words. A source whose target is r times its words gives every
document floor(r) certain copies, and the rest by Pareto order sampling: documents are
ranked by the odds of a random number over the odds of their inclusion, and a fixed amount
of words is taken from the front of that order. The random number is a hash of seed and
id, so reruns agree. One closing document, the one whose size is nearest to what is still
missing, brings the amount to the target.

The front is found without sorting a source: words are summed per bin of the rank, and only
the bin in which the target falls is put in order.

Null and empty texts have size 0 and count as documents without words. A null source is a
source of its own and comes last. Rows of one id share their rank and are taken or left
together. A null id has one random number for all its rows. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popscope.llm.common import small, stored, word_count

WEIGHTS = (5, 2, 1)  # by rank of the source's name, repeating
TOTAL = 1.5  # words of the mix by words of the corpus
CAP = 2  # a source gives at most so many times its words
SEED = 7
BIN_ROWS = 1024  # documents of a source per bin of the rank, on average


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, total: float = TOTAL, cap: int = CAP) -> DataFrame:
    """``sources`` (source, source_size, n) with ``target``.

    Shares by weight, stopped at ``cap`` times the source's size; what is cut off goes to
    the others by weight until none is above. In the order of cap over weight, sources are
    capped as long as their cap lies below the level that the rest would have.
    One row per source passes through one task here.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    weighted = sources.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1).cast("long")
    ).withColumn("cap", F.col("source_size") * cap)
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    everywhere = Window.partitionBy()
    levels = weighted.select(
        "*",
        F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)).alias("rest"),
        F.sum("source_size").over(everywhere).alias("all"),
    ).withColumn("level", (F.lit(float(total)) * F.col("all") - F.col("before")) / F.col("rest"))
    capped = F.col("cap") / F.col("weight") <= F.col("level")
    level = F.max(F.when(~capped, F.col("level"))).over(everywhere)
    target = F.when(capped, F.col("cap").cast("double")).otherwise(level * F.col("weight"))
    return levels.select("source", "source_size", "n", target.alias("target"))


def uniform(id: Column, seed: int = SEED) -> Column:
    """A number between 0 and 1, of seed and id alone."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), id.cast("string")))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    return (bits + 0.5) / F.lit(float(1 << 52))


def _rank() -> Column:
    """Random odds over inclusion odds; null where nothing is to be drawn."""
    odds = F.col("u") / (1 - F.col("u"))
    return F.when(F.col("p") > 0, odds / (F.col("p") / (1 - F.col("p"))))


def _bin() -> Column:
    q = F.col("q")
    return F.least(F.floor(q / (1 + q) * F.col("bins")), F.col("bins") - 1)


def plan(sized: DataFrame, **shares) -> DataFrame:
    """What each source gives, from ``sized`` (doc_id, source, size, u), which should be stored.

    source, source_size, target, whole (certain copies), p, bins, last_bin and last_q (the
    end of the front), closing_q (the closing document, or null).
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plans = stored(
        source_targets(per_source, **shares)
        .withColumn("whole", F.floor(ratio))
        .withColumn("draw", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("p", F.when(F.col("source_size") > 0, F.col("draw") / F.col("source_size")).otherwise(0.0))
        .withColumn("bins", F.ceil(F.col("n") / BIN_ROWS)),
        "plans",
    )
    ranked = _joined(sized, plans).withColumn("q", _rank()).where("q IS NOT NULL").withColumn("bin", _bin())

    words = ranked.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("draw").alias("draw"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bin"))
    crossing = stored(
        words.withColumn("upto", upto)
        .where("upto - words <= draw AND upto > draw")
        .select(F.col("source").alias("in_source"), F.col("bin").alias("last_bin"), (F.col("upto") - F.col("words")).alias("below")),
        "crossing",
    )
    inside = ranked.join(
        small(crossing), F.col("source").eqNullSafe(F.col("in_source")) & (F.col("bin") == F.col("last_bin"))
    )
    # The rows of one bin: about BIN_ROWS. Equal ranks stay together, as the frame is by value.
    front = F.col("below") + F.sum("size").over(Window.partitionBy("source").orderBy("q"))
    fits = F.when(F.col("front") <= F.col("draw"), F.col("q"))
    ends = inside.withColumn("front", front).groupBy("source").agg(
        F.first("last_bin").alias("last_bin"),
        F.coalesce(F.max(fits), F.lit(-1.0)).alias("last_q"),
        F.coalesce(F.max(F.when(F.col("front") <= F.col("draw"), F.col("front"))), F.first("below")).alias("words"),
    )
    ends = stored(ends.withColumnRenamed("source", "in_source"), "ends")
    fronts = stored(
        plans.join(small(ends), F.col("source").eqNullSafe(F.col("in_source")), "left")
        .withColumn("gap", F.col("draw") - F.col("words"))
        .drop("in_source", "words"),
        "fronts",
    )
    left = _joined(sized, fronts).withColumn("q", _rank()).where("q IS NOT NULL").withColumn("bin", _bin())
    left = left.where(~_in_front() & (F.col("size") > 0))
    off = F.abs(F.col("size") - F.col("gap"))
    closing = left.groupBy("source", "gap").agg(F.min(F.struct(off.alias("off"), "q")).alias("nearest"))
    closing = stored(
        closing.where("nearest.off < gap").select(F.col("source").alias("in_source"), F.col("nearest.q").alias("closing_q")),
        "closing",
    )
    return stored(
        fronts.join(small(closing), F.col("source").eqNullSafe(F.col("in_source")), "left").drop("in_source"), "mix"
    )


def _joined(rows: DataFrame, plans: DataFrame) -> DataFrame:
    near = small(plans).withColumnRenamed("source", "of")
    return rows.join(near, F.col("source").eqNullSafe(F.col("of"))).drop("of")


def _in_front() -> Column:
    inside = (F.col("bin") < F.col("last_bin")) | ((F.col("bin") == F.col("last_bin")) & (F.col("q") <= F.col("last_q")))
    return F.coalesce(F.when(F.col("last_bin").isNull(), F.lit(True)).otherwise(inside), F.lit(False))


def _copies() -> Column:
    drawn = F.col("q").isNotNull() & (_in_front() | F.coalesce(F.col("q") == F.col("closing_q"), F.lit(False)))
    return (F.col("whole") + F.coalesce(drawn, F.lit(False)).cast("long")).cast("long")


def sized(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text", seed: int = SEED) -> DataFrame:
    return docs.select(
        F.col(id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), uniform(F.col(id), seed).alias("u")
    )


def with_copies(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """``rows`` (source, u, ...) with the plan of their source and ``copies``, the times each is taken."""
    ranked = _joined(rows, plans).withColumn("q", _rank()).withColumn("bin", _bin())
    return ranked.withColumn("copies", _copies())


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    rows = stored(sized(docs, **options), "sized")
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return with_copies(rows, plan(rows)).select("doc_id", "size", "source_size", "target", taken, "source", "copies")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``."""
    plans = plan(stored(sized(docs), "sized"))
    keep = {f"_d{i}": name for i, name in enumerate(docs.columns)}
    rows = docs.select(*(F.col(name).alias(short) for short, name in keep.items()))
    ids, sources = docs.columns.index("doc_id"), docs.columns.index("source")
    rows = rows.withColumns({"u": uniform(F.col(f"_d{ids}")), "source": F.col(f"_d{sources}")})
    taken = with_copies(rows, plans).where("copies > 0")
    times = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return times.select(*(F.col(short).alias(name) for short, name in keep.items()))

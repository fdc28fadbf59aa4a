"""Document fingerprints by one-permutation MinHash.

Each five-word shingle of the whole text is hashed once. The top bits of the hash are its bin,
and the bin keeps its least hash. An empty bin takes the value of another by a fixed random
probe sequence of its own (densification), ending in a fixed random order of all bins, so that
equal sets fill alike. Of each bin four bits are kept, as one hex digit. Unequal values agree in
these by chance in one of sixteen, which the likeness corrects.

All bins are found by one sort: to the hashes are added the largest value of each bin, and the
first value of every bin in the sorted array is its least hash, or that mark if it is empty.

Fewer than five words: one shingle of them all. Null text is empty; without words the fingerprint
is the empty string, of likeness 1 to itself and 0 to others. Equal texts have equal
fingerprints. Ids that repeat: the next document is that with the next larger id, and of several
rows with that id the text whose first part sorts first; a null id comes last. An empty table
gives no rows.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popscope.llm.common import positions, stored

SHINGLE = 5
BINS = 128
SHIFT = 56  # 63 bits of hash, the top 7 of them the bin
EMPTY = (1 << SHIFT) - 1
BITS = 4
PROBES = 6
SPACE = r"[\x20\x09-\x0D]+"


def _longs(values) -> Column:
    """An array constant, written so that the optimizer folds it."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


_MARKS = [(bin << SHIFT) | EMPTY for bin in range(BINS)]
_RANDOM = random.Random(11)
_SEQUENCES = [_RANDOM.sample([b for b in range(BINS) if b != bin], PROBES) for bin in range(BINS)]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _hashes(words: Column) -> Column:
    """One hash of 63 bits per shingle."""
    count = F.size(words) - (SHINGLE - 1)
    aligned = F.arrays_zip(*(F.slice(words, i + 1, F.greatest(count, F.lit(0))) for i in range(SHINGLE)))
    many = F.transform(aligned, lambda s: F.shiftrightunsigned(F.xxhash64(s), 1))
    one = F.array(F.shiftrightunsigned(F.xxhash64(words), 1))
    return F.when(count >= 1, many).when(F.size(words) > 0, one).otherwise(F.array().cast("array<bigint>"))


def _is_empty(value: Column) -> Column:
    return value.bitwiseAND(F.lit(EMPTY)) == EMPTY


def _filled(values: str) -> Column:
    """The bins' digits, empty bins filled from others."""
    table = _longs(b for row in _SEQUENCES for b in row)

    def digit(value, bin):
        probes = []
        for t in range(PROBES):
            other = F.get(F.col(values), F.get(table, bin * PROBES + t).cast("int"))
            probes.append(F.when(~_is_empty(other), other))
        there = F.filter(values, lambda x: ~_is_empty(x))
        first = F.array_min(F.transform(there, lambda x: F.struct(F.xxhash64(bin, F.shiftright(x, SHIFT)).alias("h"), x.alias("x"))))
        source = F.when(~_is_empty(value), value).otherwise(F.coalesce(*probes, first["x"]))
        return F.lower(F.hex(F.xxhash64(source, bin).bitwiseAND(F.lit((1 << BITS) - 1))))

    return F.transform(values, digit)


def with_fingerprints(rows: DataFrame, texts: dict[str, str]) -> DataFrame:
    """``rows`` with a fingerprint column for each text column: ``texts`` is {text: fingerprint}."""
    names = [c for c in rows.columns if c not in texts]
    at = dict(enumerate(texts))
    # One step per select: a step that is used twice is then computed once.
    step = rows.select(*names, *texts, *(_words(F.col(t)).alias(f"_w{i}") for i, t in at.items()))
    step = step.select(*names, *(_hashes(F.col(f"_w{i}")).alias(f"_h{i}") for i in at))
    marked = (F.sort_array(F.concat(f"_h{i}", _longs(_MARKS))).alias(f"_s{i}") for i in at)
    step = step.select(*names, *((F.size(f"_h{i}") > 0).alias(f"_any{i}") for i in at), *marked)
    kept = [f"_any{i}" for i in at]

    def firsts(name):
        bin = lambda x: F.shiftright(x, SHIFT)
        return F.filter(name, lambda x, i: (i == 0) | (bin(x) != bin(F.get(F.col(name), i - 1))))

    step = step.select(*names, *kept, *(firsts(f"_s{i}").alias(f"_v{i}") for i in at))
    prints = (F.when(F.col(f"_any{i}"), F.array_join(_filled(f"_v{i}"), "")).otherwise("").alias(p) for i, p in enumerate(texts.values()))
    return step.select(*names, *prints)


def likeness(a: str, b: str) -> Column:
    """Estimated share of common shingles of two fingerprints, with the chance agreement taken out."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x == y).cast("int"))
    agree = F.aggregate(same, F.lit(0), lambda total, x: total + F.coalesce(x, F.lit(0))) / BINS
    chance = 2.0**-BITS
    corrected = F.greatest(F.lit(0.0), (agree - chance) / (1 - chance))
    neither = F.least(F.length(a), F.length(b)) == 0
    return F.when(neither, (F.col(a) == F.col(b)).cast("double")).otherwise(corrected)


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint."""
    rows = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    return with_fingerprints(rows, {"body": "fingerprint"})


def edited_fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text against its edited form and against the next document.

    Edited: the last quarter (rounded down) of the code points gives way to as many first ones of
    the next document. Only the parts needed move to the document before.
    """
    rows = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    lengths = rows.groupBy("doc_id").agg(F.max(F.length("body")).alias("most"))
    numbered = stored(positions(lengths, [F.asc_nulls_last("doc_id")], "lengths"), "numbered")
    total = max(1, numbered.count())
    before = numbered.select(((F.col("position") + 1) % total).alias("position"), F.col("doc_id").alias("of"), F.floor(F.col("most") / 4).cast("int").alias("part"))
    nexts = numbered.join(before, "position").select(F.col("doc_id").alias("next_id"), "of", "part")

    parts = rows.join(nexts, F.col("doc_id").eqNullSafe(F.col("next_id")))
    parts = parts.select("of", "next_id", F.substring("body", F.lit(1), F.col("part")).alias("part"))
    parts = parts.groupBy("of", "next_id").agg(F.min("part").alias("part"))
    joined = rows.join(parts, F.col("doc_id").eqNullSafe(F.col("of")))
    chars = F.length("body")
    changed = F.floor(chars / 4).cast("int")
    edited = F.concat(F.substring("body", F.lit(1), chars - changed), F.substring("part", F.lit(1), changed))
    both = joined.select("doc_id", "next_id", chars.cast("long").alias("n_chars"), "body", edited.alias("edited"))
    both = both.withColumn("edited_sha256", F.sha2("edited", 256))
    prints = with_fingerprints(both, {"body": "fingerprint", "edited": "edited_fingerprint"})
    prints = stored(prints.withColumn("near_edited", likeness("fingerprint", "edited_fingerprint")), "prints")

    others = prints.groupBy(F.col("doc_id").alias("other")).agg(F.min("fingerprint").alias("next_fingerprint"))
    compared = prints.join(others, F.col("next_id").eqNullSafe(F.col("other")))
    return compared.withColumn("near_next", likeness("fingerprint", "next_fingerprint")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )

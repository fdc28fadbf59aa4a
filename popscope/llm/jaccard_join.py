"""N-gram Jaccard join: components of documents whose 4-word shingle sets overlap by 85 % or more.

Words are runs of non-white-space with A-Z lower-cased; a set holds a text's distinct 4-word
shingles (64-bit hashes), or the whole word sequence as one shingle if shorter; a text without
words has the empty set and no links. Two sets link when ``100 |r & s| >= 85 |r | s|``.

The method, set-relation skipping, in Spark terms:

* Equal sets are one set (found by a 128-bit hash of the sorted set, then numbered: the
  ``digest`` column); their documents are linked.
* All tokens have one order: first the light ones by hash, then the tokens of heavy buckets
  (counts of hash buckets over the corpus), least count first. A set's prefix at threshold t
  holds its first ``n - ceil(t n) + 1`` tokens; two sets above t share a prefix token (prefix
  filter, for any one order). Only prefixes travel, once, by token; tokens that no other
  prefix holds find no partner and are dropped there.
* **Relation skipping**: every set's first shared token names a pivot (the smallest set digest
  that it comes first in). A set whose Jaccard with its pivot is at least ``HIGH`` does not probe:
  its answers are derived from the pivot's, which the pivot computes at the looser threshold
  ``t - (1 - HIGH)``. Jaccard distance is a metric, so every answer of the set is among
  them. Answers within the pivot's component are skipped; only the pivot's loose-only
  answers are verified against the derived set.
* Only components are wanted. First each set is compared with the set of its lists that shares
  the most entries (the middle of a family). Then all pairs whose ends are still in different
  components are probed; those within one cannot change it.
* **Block skipping**: index lists are keyed by (token, size band); a probe looks only into the
  bands its length filter allows, and a position filter (the overlap still possible after the
  shared token's places) drops entries before any set is read.
* Candidates are compared by masks that hold the parity of the tokens in each of 2n to 4n hash
  buckets: a bucket whose parities differ holds a token of one set only, which bounds the
  overlap, so no link is lost. The rest is verified on the full sets, taken again from the
  texts of these sets; links go to connected components (rounds of contraction, each round
  written), labelled by the smallest doc_id of their rows.

Nothing here holds a group in one task but a token's list of prefix entries, which is cut by size
band where it is probed. A 64-bit shingle hash may, with odds near 2^-64 per pair of
shingles, merge two shingles.

Edge cases: null text and texts without words are alone (n_shingles 0, component_id their own
doc_id); a null doc_id never names a component (its row's component_id is the smallest
non-null doc_id of its component, null if none); repeated rows and one doc_id on several texts
are labelled by their texts; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popscope.llm.common import released, small, stored
from popscope.llm.components import components
from popscope.llm.shingles import text_blocks, text_shingles, word_hashes

WORDS = 4  # shingle length
LINK = 85  # percent Jaccard for a link
HIGH = 95  # percent Jaccard to its pivot above which a set borrows the pivot's answers
LOOSE = LINK - (100 - HIGH)  # the pivot's threshold
BAND = 100 / LOOSE  # ratio of sizes within one band
BUCKETS = 18  # bits of a token's hash that tell its bucket when tokens are counted
HEAVY = 6  # standard deviations above the mean count (as if dealt evenly) from which a bucket's tokens come last


def _text_sets(column: pa.Array):
    """(row, sorted set) of every text of a column."""
    for row, data, offsets in text_blocks(column):
        words, ends = word_hashes(data, offsets)
        for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
            yield row + i, text_shingles(words[a:b], WORDS)


def _digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def parity_mask(found: np.ndarray) -> bytes:
    """A bit per hash bucket: whether it holds an odd number of tokens. Buckets are a power of two, 2n at least."""
    buckets = max(64, 1 << (2 * len(found) - 1).bit_length())
    at = (found & np.uint64(buckets - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=buckets) & 1).tobytes()


def least_difference(x: np.ndarray, y: np.ndarray) -> int:
    """Tokens that only one of two sets holds, at least; ``x`` and ``y`` are their masks' bits.

    Buckets are the hash's lowest bits, so the longer mask folds into the shorter one.
    """
    if len(x) < len(y):
        x, y = y, x
    return int((np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0) ^ y).sum())


ROWS = "doc_id long, n long, k1 long, k2 long, body long, mask binary"


@released
def _rows(batches):
    """Size, digest and mask of the set of every text."""
    for batch in batches:
        sizes, digests, masks = [], [], []
        for _, found in _text_sets(batch.column(1)):
            sizes.append(len(found))
            digests.append(_digest(found))
            masks.append(parity_mask(found) if len(found) else None)
        keys = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys[:, 0]), pa.array(keys[:, 1]), batch.column(2), pa.array(masks, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "k1", "k2", "body", "mask"])


@released
def _bucket_counts(batches):
    """(bucket, n): tokens of each bucket in the sets of this task's texts."""
    counts = np.zeros(1 << BUCKETS, np.int64)
    for batch in batches:
        sets = [found for _, found in _text_sets(batch.column(0))]
        if sets:
            counts += np.bincount((np.concatenate(sets) >> np.uint64(64 - BUCKETS)).astype(np.int64), minlength=len(counts))
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict({"bucket": at.astype(np.int32), "n": counts[at]})


def _entries(heavy):
    """(token, k1, n, pos) of every token in a set's loose prefix; ``heavy`` broadcasts the counts of heavy buckets."""

    @released
    def entries(batches):
        for batch in batches:
            tokens, keys, sizes = [], [], []
            for _, found in _text_sets(batch.column(0)):
                if len(found):
                    last = heavy.value[(found >> np.uint64(64 - BUCKETS)).astype(np.int64)]
                    ranked = found[np.argsort(last, kind="stable")] if last.any() else found
                    tokens.append(ranked[: len(found) - (len(found) * LOOSE + 99) // 100 + 1])
                    keys.append(np.frombuffer(_digest(found), np.int64)[0])
                    sizes.append(len(found))
            if tokens:
                lengths = np.array([len(x) for x in tokens])
                places = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                columns = {"token": np.concatenate(tokens).view(np.int64), "k1": np.repeat(np.array(keys, np.int64), lengths)}
                columns |= {"n": np.repeat(np.array(sizes, np.int64), lengths), "pos": places.astype(np.int64)}
                yield pa.RecordBatch.from_pydict(columns)

    return entries


@released
def _plausible(batches):
    """The pairs whose masks allow their threshold ``t``: (a, b, t, n_a, n_b, mask_a, mask_b) in, (a, b, t) out."""
    for batch in batches:
        t, n_a, n_b = (batch.column(i).to_numpy() for i in (2, 3, 4))
        most = (100 - t) * (n_a + n_b) // (100 + t)
        keep = []
        for i, (x, y) in enumerate(zip(batch.column(5), batch.column(6))):
            x, y = (np.unpackbits(np.frombuffer(v.as_buffer(), np.uint8)) for v in (x, y))
            if least_difference(x, y) <= most[i]:
                keep.append(i)
        yield batch.select([0, 1, 2]).take(pa.array(keep, pa.int64()))


@released
def _full_sets(batches):
    """(digest, set) of the texts (text, k1, k2, digest) whose sets have these keys."""
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy() for i in (1, 2)], axis=1).astype(np.int64)
        sets, keep = [], []
        for row, found in _text_sets(batch.column(0)):
            if _digest(found) == keys[row].tobytes():
                sets.append(found.tobytes())
                keep.append(row)
        arrays = [batch.column(3).take(pa.array(keep, pa.int64())), pa.array(sets, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["digest", "set"])


@released
def _intersections(batches):
    """(a, b, t, n_a, n_b, inter) of pairs (a, b, t, set_a, set_b)."""
    for batch in batches:
        sizes = []
        for x, y in zip(batch.column(3), batch.column(4)):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both = np.sort(np.concatenate([x, y]))
            sizes.append((len(x), len(y), int((both[1:] == both[:-1]).sum())))
        sizes = np.array(sizes, np.int64).reshape(-1, 3)
        arrays = [*(batch.column(i) for i in range(3)), *(pa.array(sizes[:, i]) for i in range(3))]
        yield pa.RecordBatch.from_arrays(arrays, names=["a", "b", "t", "n_a", "n_b", "inter"])


def _band(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / math.log(BAND)).cast("int")


def _heavy_buckets(texts: DataFrame) -> np.ndarray:
    """The counts of the buckets that are heavy, 0 for the others; one number per bucket, however large the corpus."""
    counts = stored(texts.select("text").mapInArrow(_bucket_counts, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")), "jaccard_buckets")
    mean = (counts.agg(F.sum("n")).first()[0] or 0) / (1 << BUCKETS)
    heavy = np.zeros(1 << BUCKETS, np.int64)
    for bucket, n in counts.where(F.col("n") > mean + HEAVY * math.sqrt(mean) + 16).collect():
        heavy[bucket] = n
    return heavy


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), F.xxhash64(F.col("text")).alias("body"))
    rows = stored(texts.mapInArrow(_rows, ROWS), "jaccard_rows")
    distinct = rows.where("n > 0").groupBy("k1", "k2").agg(*(F.first(c).alias(c) for c in ("n", "mask")), F.min("body").alias("body"))
    sets = stored(distinct.withColumn("digest", F.monotonically_increasing_id()), "jaccard_sets")

    heavy = docs.sparkSession.sparkContext.broadcast(_heavy_buckets(texts))
    entries = texts.select("text").mapInArrow(_entries(heavy), "token long, k1 long, n long, pos long").repartition("token").distinct()
    held = entries.withColumn("held", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("held > 1")
    index = stored(held.join(sets.select("k1", "digest"), "k1").select("token", "digest", "n", "pos", "held"), "jaccard_index")

    def verified(pairs: DataFrame) -> DataFrame:
        return _verified(pairs, sets, texts)

    derived = _derived(index, verified)
    loose = derived.select(F.col("pivot").alias("digest")).distinct().withColumn("t", F.lit(LOOSE))
    # The threshold that a set probes at; none for a derived set.
    probing = sets.select("digest").join(derived.select("digest"), "digest", "left_anti").join(loose, "digest", "left")
    probing = stored(probing.select("digest", F.coalesce("t", F.lit(LINK)).cast("long").alias("t")), "jaccard_probing")
    index = index.join(probing, "digest", "left")
    known = derived.select(F.col("digest").alias("a"), F.col("pivot").alias("b"))

    weights = index.groupBy("digest").agg(F.sum("held").alias("weight"))
    lists = stored(index.join(weights, "digest"), "jaccard_lists")
    lead = F.max_by(F.struct("digest", "n", "pos", "t"), F.struct("weight", -F.col("digest"))).alias("lead")
    leads = lists.groupBy("token").agg(lead).select("token", *(F.col(f"lead.{c}").alias(f"{c}_s") for c in ("digest", "n", "pos", "t")))
    first = verified(_pairs(_side(lists, "r").join(leads, "token").where(_fits() & (F.col("digest_r") != F.col("digest_s")))))
    labels = stored(components(known.unionByName(_links(first))), "jaccard_labels")

    labelled = lists.join(labels.withColumnRenamed("id", "digest"), "digest", "left").withColumn("component", F.coalesce("component", "digest"))
    lo, hi = F.greatest(F.lit(1), F.ceil(F.col("n_r") * LOOSE / 100)), F.floor(F.col("n_r") * 100 / LOOSE)
    probes = _side(labelled, "r").withColumn("component_r", F.col("component")).drop("component").withColumn("band", F.explode(F.sequence(_band(lo), _band(hi))))
    listed = _side(labelled, "s").withColumn("component_s", F.col("component")).drop("component").withColumn("band", _band(F.col("n_s")))
    apart = (F.col("digest_r") < F.col("digest_s")) & (F.col("component_r") != F.col("component_s"))
    rest = _pairs(probes.join(listed, ["token", "band"]).where(apart & _fits()))
    rest = verified(rest.join(first.select("a", "b"), ["a", "b"], "left_anti"))

    # A derived set: linked to its pivot, and checked against the pivot's loose-only answers.
    answers = first.unionByName(rest).where(f"inter * {100 + LINK} < {LINK} * (n_a + n_b)")
    answers = answers.select(F.col("a").alias("pivot"), F.col("b").alias("other")).unionByName(answers.select(F.col("b").alias("pivot"), F.col("a").alias("other")))
    borrowed = derived.join(answers, "pivot").where("digest <> other")
    borrowed = borrowed.select(F.least("digest", "other").alias("a"), F.greatest("digest", "other").alias("b"), F.lit(LINK).cast("long").alias("t")).distinct()
    labels = components(known.unionByName(_links(first)).unionByName(_links(rest)).unionByName(_links(verified(borrowed))))  # (id = digest, component = a digest)

    numbered = rows.select("doc_id", "n", "k1", "k2").join(sets.select("k1", "k2", "digest"), ["k1", "k2"], "left")
    keyed = numbered.select("doc_id", "n", "digest").join(labels.withColumnRenamed("id", "digest"), "digest", "left")
    keyed = keyed.withColumn("component", F.coalesce("component", "digest"))
    named = keyed.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    out = keyed.join(named, "component", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _side(lists: DataFrame, side: str) -> DataFrame:
    """``lists`` with the names of one side of a pair."""
    rest = [c for c in ("component",) if c in lists.columns]
    return lists.select("token", *rest, *(F.col(c).alias(f"{c}_{side}") for c in ("digest", "n", "pos", "t")))


def _fits() -> Column:
    """Whether two entries (r and s) of a token allow the looser of their thresholds; null if neither set probes."""
    t, n_r, n_s = F.least("t_r", "t_s"), F.col("n_r"), F.col("n_s")
    left = F.least(n_r - F.col("pos_r"), n_s - F.col("pos_s"))  # the overlap, if this is the first shared token
    in_prefix = [F.col(f"pos_{x}") < F.col(f"n_{x}") - F.floor((F.col(f"n_{x}") * t + 99) / 100) + 1 for x in "rs"]
    return (n_s * 100 >= n_r * t) & (n_r * 100 >= n_s * t) & (left * (t + 100) >= (n_r + n_s) * t) & in_prefix[0] & in_prefix[1]


def _pairs(joined: DataFrame) -> DataFrame:
    ends = F.least("digest_r", "digest_s").alias("a"), F.greatest("digest_r", "digest_s").alias("b")
    return joined.select(*ends, F.least("t_r", "t_s").alias("t")).distinct()


def _links(answers: DataFrame) -> DataFrame:
    return answers.where(f"inter * {100 + LINK} >= {LINK} * (n_a + n_b)").select("a", "b")


def _derived(index: DataFrame, verified) -> DataFrame:
    """(digest, pivot) of sets whose Jaccard with their pivot is at least HIGH."""
    first = index.groupBy("digest").agg(F.min_by("token", "pos").alias("token"))
    pivots = first.groupBy("token").agg(F.min("digest").alias("pivot"))
    pairs = first.join(pivots, "token").where("digest <> pivot").select(F.col("pivot").alias("a"), F.col("digest").alias("b"), F.lit(HIGH).cast("long").alias("t"))
    close = verified(pairs).where(f"inter * {100 + HIGH} >= {HIGH} * (n_a + n_b)")
    return stored(close.select(F.col("b").alias("digest"), F.col("a").alias("pivot")), "jaccard_derived")


def _verified(pairs: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, t, n_a, n_b, inter) of the ``pairs`` (a, b, t) whose masks allow t, by their full sets."""
    sides = [sets.select(F.col("digest").alias(x), F.col("n").alias(f"n_{x}"), F.col("mask").alias(f"mask_{x}")) for x in "ab"]
    masked = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "t", "n_a", "n_b", "mask_a", "mask_b")
    left = stored(masked.mapInArrow(_plausible, "a long, b long, t long"), "jaccard_plausible")
    ends = left.select(F.col("a").alias("digest")).unionByName(left.select(F.col("b").alias("digest"))).distinct()
    wanted = stored(sets.join(ends, "digest", "left_semi").select("body", "k1", "k2", "digest"), "jaccard_wanted")
    found = texts.select("text", "body").join(small(wanted), "body").select("text", "k1", "k2", "digest").mapInArrow(_full_sets, "digest long, set binary")
    full = stored(found.dropDuplicates(["digest"]), "jaccard_full")
    sides = [full.select(F.col("digest").alias(x), F.col("set").alias(f"set_{x}")) for x in "ab"]
    both = left.join(sides[0], "a").join(sides[1], "b").select("a", "b", "t", "set_a", "set_b")
    return stored(both.mapInArrow(_intersections, "a long, b long, t long, n_a long, n_b long, inter long"), "jaccard_answers")

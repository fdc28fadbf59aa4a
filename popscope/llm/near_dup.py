"""Near-duplicates: MinHash bands, sequential Bayesian verification, exact check.

Documents with equal sets of shingles are one class, and its smallest id stands for it. Bands
of the classes' signatures give buckets. Pairs of a bucket are judged by comparing the
signatures batch by batch: with a uniform prior the posterior of the similarity after m of n
agreements is a beta distribution, and a pair is dropped once the probability that it reaches
the threshold is below ``MISS``. What is left is verified on the full sets.

The lowest bits of all 128 values come first, together with masks of the sets, which bound the
intersection; a join compares these without making rows of the pairs it drops.

Only components are wanted, so a bucket's pairs are not all looked at. First each member is
compared with the one in the middle. Then, round after round, members outside the bucket's largest
component are compared with all members outside their own, a bounded number of pairs per bucket and
round, until every member outside that component has been. What is then left uncompared lies
within one component, so no link that could join two components is passed over.

32 bands of 4 values let a pair at the threshold slip with probability 5e-6.

Null, empty and blank texts have no shingle, are linked with nothing and are kept. Fewer than five
words are one shingle. Repeated rows are separate rows of one id. Rows without an id get the component of their
equals, if one of them has an id, and else none; they are kept in the latter case and link nothing.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popscope.llm.common import positions, released, small, stored
from popscope.llm.components import components, joined_labels, relabelled
from popscope.llm.shingles import mixed, text_blocks, text_shingles, word_hashes

THRESHOLD = (75, 100)  # intersection by union
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
BATCH = 16  # signature values compared at a time
MISS = 1e-6  # probability of dropping a pair at the threshold or above, per test
ROUND_PAIRS = 4_000_000  # pairs of one bucket looked at in one round, about

MASK_LONGS = 32  # of a mask with one bit per shingle, by the lowest bits of its hash

_RANDOM = np.random.default_rng(6)
_FACTORS = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Of each hash function the least value, its upper 32 bits."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 1024):
        np.minimum(least, np.multiply.outer(_FACTORS, shingles[start : start + 1024]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


@lru_cache
def least_matches(threshold: float = THRESHOLD[0] / THRESHOLD[1], miss: float = MISS) -> dict[int, int]:
    """By the number of values compared, the agreements without which a pair is dropped."""
    out = {}
    for n in range(BATCH, HASHES + 1, BATCH):
        # The posterior's upper tail is a binomial's lower one: P(similarity >= t | m of n) = P(Bin(n + 1, t) <= m).
        tail, m = 0.0, -1
        while m < n:
            tail += comb(n + 1, m + 1) * threshold ** (m + 1) * (1 - threshold) ** (n - m)
            if tail >= miss:
                break
            m += 1
        out[n] = m + 1
    return out


def least_bits(threshold: float = THRESHOLD[0] / THRESHOLD[1], miss: float = MISS) -> int:
    """Agreeing lowest bits of the signatures' values without which a pair is dropped.

    Values agree with the probability of the similarity, and else their bits do in half of the cases.
    """
    p, below = (1 + threshold) / 2, 0.0
    for m in range(HASHES + 1):
        below += comb(HASHES, m) * p**m * (1 - p) ** (HASHES - m)
        if below >= miss:
            return m
    return HASHES


SETS = "doc_id {id}, n_shingles long, digest binary, signature binary, bits0 long, bits1 long, text_hash long"


@released
def _sets(batches):
    """Shingle count, digest of the set, signature and the lowest bits of its values, of every text."""
    for batch in batches:
        counts, digests, signatures, bits = [], [], [], []
        for _, data, offsets in text_blocks(batch.column(1)):
            words, ends = word_hashes(data, offsets)
            for a, b in zip(ends[:-1], ends[1:]):
                found = text_shingles(words[a:b])
                counts.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                values = signature(found)
                signatures.append(values.tobytes() if len(found) else None)
                bits.append(np.packbits((values & 1).astype(bool)).view(np.int64))
        bits = np.array(bits, np.int64).reshape(-1, 2)
        arrays = [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())]
        names = ["doc_id", "n_shingles", "digest", "signature", "bits0", "bits1", "text_hash"]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(bits[:, 0]), pa.array(bits[:, 1]), batch.column(2)], names=names)


@released
def _buckets(batches):
    """(bucket, id) for every band of every signature."""
    salt = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
    for batch in batches:
        for start in range(0, batch.num_rows, 2000):
            part = batch.slice(start, 2000)
            values = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(-1, BANDS, ROWS).astype(np.uint64)
            key = np.broadcast_to(salt, values.shape[:2]).copy()
            for i in range(ROWS):
                key = mixed(key ^ (values[:, :, i] + np.uint64(i << 40)))
            ids = np.repeat(part.column(0).to_numpy(), BANDS)
            yield pa.RecordBatch.from_pydict({"bucket": key.reshape(-1).view(np.int64), "id": ids})


@released
def _plausible(batches):
    """The pairs that no batch of the signatures speaks against."""
    least = least_matches()
    for batch in batches:
        for start in range(0, batch.num_rows, 2000):
            part = batch.slice(start, 2000)
            a, b = (np.frombuffer(b"".join(part.column(i).to_pylist()), np.uint32).reshape(-1, HASHES) for i in (2, 3))
            left, agreed = np.arange(part.num_rows), np.zeros(part.num_rows, np.int64)
            for n in range(BATCH, HASHES + 1, BATCH):
                agreed = agreed + (a[left, n - BATCH : n] == b[left, n - BATCH : n]).sum(axis=1)
                good = agreed >= least[n]
                left, agreed = left[good], agreed[good]
            yield pa.RecordBatch.from_arrays([part.column(i).take(pa.array(left)) for i in (0, 1)], names=["a", "b"])


FULL = "id long, digest binary, shingles binary, filled long, mask array<long>"


@released
def _full_sets(batches):
    """Digest, sorted shingles, and the mask of bits that some shingle falls on, with their number."""
    for batch in batches:
        sets, digests, masks = [], [], []
        for _, data, offsets in text_blocks(batch.column(1)):
            words, ends = word_hashes(data, offsets)
            for a, b in zip(ends[:-1], ends[1:]):
                found = text_shingles(words[a:b])
                sets.append(found.tobytes())
                digests.append(hashlib.blake2b(sets[-1], digest_size=16).digest())
                bits = np.zeros(64 * MASK_LONGS, np.uint8)
                bits[found & np.uint64(64 * MASK_LONGS - 1)] = 1
                masks.append(np.packbits(bits).view(np.int64))
        masks = np.array(masks, np.int64).reshape(-1, MASK_LONGS)
        filled = np.unpackbits(masks.view(np.uint8), axis=1).sum(axis=1, dtype=np.int64) if len(masks) else []
        ends = pa.array(np.arange(len(masks) + 1) * MASK_LONGS, pa.int32())
        columns = [batch.column(0), pa.array(digests, pa.binary()), pa.array(sets, pa.binary()), pa.array(filled, pa.int64())]
        mask = pa.ListArray.from_arrays(ends, pa.array(masks.ravel()))
        yield pa.RecordBatch.from_arrays([*columns, mask], names=["id", "digest", "shingles", "filled", "mask"])


def _may_link() -> Column:
    """Whether sizes, masks and lowest bits of two documents allow a link.

    Shared shingles fall on shared bits; those that fall on a bit together with others are as
    many as one side's shingles beyond its bits, at most. So no link is lost to the masks.
    """
    over, under = THRESHOLD
    both = F.zip_with("mask", "p_mask", lambda x, y: F.bit_count(x.bitwiseAND(y)))
    common = F.aggregate(both, F.lit(0), lambda total, x: total + x)
    shared = F.least(common + F.least(F.col("size") - F.col("filled"), F.col("p_size") - F.col("p_filled")), "size", "p_size")
    differ = sum(F.bit_count(F.col(b).bitwiseXOR(F.col(f"p_{b}"))) for b in ("bits0", "bits1"))
    return (shared * under >= (F.col("size") + F.col("p_size") - shared) * over) & (differ <= HASHES - least_bits())


@released
def _linked(batches):
    """The pairs whose full sets reach the threshold."""
    over, under = THRESHOLD
    for batch in batches:
        keep = []
        for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            if under * min(len(x), len(y)) < over * max(len(x), len(y)):
                continue
            both = np.sort(np.concatenate([x, y]))
            shared = int((both[1:] == both[:-1]).sum())
            if under * shared >= over * (len(both) - shared):
                keep.append(i)
        yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(keep, pa.int64())) for i in (0, 1)], names=["a", "b"])


def _with_ends(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """``pairs`` (a, b) with the value ``name`` of both ends; a pair of a hot id is dealt by AQE."""
    left = values.select(F.col("id").alias("a"), F.col(name).alias("x"))
    right = values.select(F.col("id").alias("b"), F.col(name).alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", text_hash: bool = False) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (and ``text_hash`` if asked).

    Classes of equal sets are linked under an id of one of their rows. Where one doc_id holds
    several different texts, each of its texts gets an id of its own above all ids for the
    linking, so the texts are judged apart; a component is then named by the smallest doc_id
    of all its rows.
    """
    texts = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("body"), F.xxhash64(F.col(text)).alias("text_hash"))
    sets = stored(texts.mapInArrow(_sets, SETS.format(id="long")), "sets")
    sets, renamed = _own_ids(sets)
    classes = sets.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    classes = stored(classes.where("rep IS NOT NULL"), "classes")
    standing = sets.where("n_shingles > 0").join(classes, (F.col("doc_id") == F.col("rep")) & (sets["digest"] == classes["digest"]), "left_semi")
    standing = stored(standing.dropDuplicates(["doc_id", "digest"]).select(F.col("doc_id").alias("id"), "signature", F.col("n_shingles").alias("size"), "bits0", "bits1"), "standing")

    in_bucket = standing.select("id", "signature").mapInArrow(_buckets, "bucket long, id long")
    shared = in_bucket.groupBy("bucket").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n"))
    members = stored(in_bucket.join(shared.where("first < last"), "bucket").select("bucket", "id", "n"), "members")

    # A document in the middle of a family shares more and larger buckets with it than one at its edge.
    weights = stored(members.groupBy("id").agg(F.sum("n").alias("weight")), "weights")
    middle = F.max_by("id", F.struct("weight", -F.col("id"))).alias("lead")
    leads = members.join(small(weights), "id").groupBy("bucket").agg(middle)
    wanted = weights.select("id") if renamed is None else _real_ids(weights.select("id"), renamed)
    bodies = texts.join(small(wanted), F.col("doc_id") == F.col("id"), "left_semi")
    full = bodies.mapInArrow(_full_sets, FULL).dropDuplicates(["id", "digest"])
    if renamed is not None:
        inner = renamed.select(F.col("doc_id").alias("id"), "digest", "inner")
        full = full.join(inner, ["id", "digest"], "left").withColumn("id", F.coalesce("inner", "id")).drop("inner")
    full = full.drop("digest")
    full = stored(full, "full")

    def verified(pairs):
        plausible = _with_ends(pairs, standing, "signature").mapInArrow(_plausible, "a long, b long")
        return stored(_with_ends(plausible, full, "shingles").mapInArrow(_linked, "a long, b long"), "links")

    first = members.join(leads, "bucket").where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    labels = stored(components(verified(first)), "labels")
    open_ = members.join(labels, "id", "left").select("bucket", "id", "n", F.coalesce("component", "id").alias("component"))
    done = None  # members already compared with all of their bucket
    while True:
        # Only buckets of more than one component go on.
        sizes = open_.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("held"))
        largest = sizes.groupBy("bucket").agg(F.max_by("component", F.struct("held", "component")).alias("largest"), F.count(F.lit(1)).alias("parts"))
        open_ = open_.drop("largest").join(largest.where("parts > 1").drop("parts"), "bucket")
        if done is None:
            open_ = open_.join(standing.drop("signature"), "id").join(full.drop("shingles"), "id")
        open_ = stored(open_, "open")
        outside = open_.where("component <> largest")
        if done is not None:
            outside = outside.join(done, ["bucket", "id"], "left_anti")
        order = F.row_number().over(Window.partitionBy("bucket").orderBy("id"))
        pivots = outside.withColumn("k", order).where(F.col("k") <= F.ceil(F.lit(ROUND_PAIRS) / F.col("n")))
        names = {"id": "pivot", "component": "own"} | {c: f"p_{c}" for c in ("size", "filled", "bits0", "bits1", "mask")}
        pivots = stored(pivots.select("bucket", *(F.col(c).alias(name) for c, name in names.items())), "pivots")
        if pivots.isEmpty():
            break
        pairs = pivots.join(open_, (pivots["bucket"] == open_["bucket"]) & (F.col("own") != F.col("component")) & _may_link())
        pairs = pairs.select(F.least("pivot", "id").alias("a"), F.greatest("pivot", "id").alias("b")).distinct()
        links = relabelled(verified(pairs).select("b", F.col("a").alias("component")), labels)
        links = relabelled(links.select(F.col("component").alias("a"), F.col("b").alias("component")), labels)
        moves = components(links.select("a", F.col("component").alias("b")))
        labels = stored(joined_labels(labels, moves), "labels")
        open_ = relabelled(open_, moves)
        used = pivots.select("bucket", F.col("pivot").alias("id"))
        done = used if done is None else done.unionByName(used)

    named = classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    rows = sets.select(F.col("real").alias("doc_id"), "n_shingles", F.when(F.col("n_shingles") > 0, F.col("digest")).alias("digest"), "text_hash")
    found = rows.join(named, "digest", "left")
    # The smallest doc_id of a component's rows names it (partial minima before the shuffle).
    lowest = found.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("lowest"))
    found = found.join(lowest, "component", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("lowest")).otherwise(F.col("doc_id"))
    extra = ["text_hash"] if text_hash else []
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), *extra)


def _own_ids(sets: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``sets`` with ``real`` (the given doc_id) and a ``doc_id`` that names one text only.

    A doc_id that holds several different sets gives each of them a new id above all ids,
    numbered by a range shuffle (``positions``); other ids stay. Also gives the renamed
    (doc_id, digest, inner) rows, or None if no id was renamed.
    """
    sets = sets.withColumn("real", F.col("doc_id"))
    shared = sets.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.countDistinct("digest").alias("texts")).where("texts > 1")
    if shared.isEmpty():
        return sets, None
    low, top = sets.agg(F.min("doc_id"), F.max("doc_id")).first()
    pairs = sets.join(shared.select("doc_id"), "doc_id", "left_semi").where("n_shingles > 0").select("doc_id", "digest").distinct()
    numbered = positions(pairs, [F.col("doc_id"), F.col("digest")], "renamed")
    # Above all ids, or below them where ids reach 2^62 (rows without an id are numbered there).
    inner = F.lit(top + 1) + F.col("position") if top < 1 << 62 else F.lit(low - 1) - F.col("position")
    if top >= 1 << 62 and low <= -(1 << 62):
        raise ValueError("doc_id values span more than 2^63; no room for ids of repeated ids' texts")
    renamed = stored(numbered.select("doc_id", "digest", inner.alias("inner")), "renamed")
    moved = sets.join(renamed, ["doc_id", "digest"], "left").withColumn("doc_id", F.coalesce("inner", "doc_id")).drop("inner")
    return stored(moved, "sets"), renamed


def _real_ids(ids: DataFrame, renamed: DataFrame) -> DataFrame:
    """(id) with renamed ids given back as the doc_id they came from."""
    back = renamed.select(F.col("inner").alias("id"), F.col("doc_id").alias("real"))
    return ids.join(back, "id", "left").select(F.coalesce("real", "id").alias("id")).distinct()


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, and of repeated rows one; the columns stay.

    Rows without an id go by a number made of their text, above all ids: they give way to near
    copies that have one.
    """
    names = [f"_{i}" for i in range(len(docs.columns))]
    id, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    by_text = F.xxhash64(text).bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    rows = docs.toDF(*names).withColumn("doc_id", F.coalesce(F.col(id).cast("long"), by_text))
    judged = stored(near_duplicates(rows, text=text, text_hash=True), "judged")
    # A row goes by its id and its text: another text under the same id is judged on its own.
    dropped = stored(judged.where("NOT kept").select("doc_id", "text_hash").distinct(), "dropped")
    again = stored(judged.where("kept").groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    rows = rows.withColumn("text_hash", F.xxhash64(text))
    left = rows.join(small(dropped), ["doc_id", "text_hash"], "left_anti")
    single = left.join(small(again), "doc_id", "left_anti")
    repeated = left.join(small(again), "doc_id", "left_semi").dropDuplicates(["doc_id", text])
    return single.unionByName(repeated).select(names).toDF(*docs.columns)

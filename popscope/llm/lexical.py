"""Ranked lexical search, reversed: the items are the queries, every document streams past them.

Terms are the maximal runs of ASCII letters and digits and of any character beyond ASCII, with
only A-Z lower-cased. Corpus figures: ``N`` documents with a term, ``L`` their terms with
repeats, ``df`` per term of an item (documents holding it). A term's weight is
``floor(1000 * ln((2N + 2) / (2 df + 1)))``; a document of ``n`` terms has
``m = 75 + (25 n N) div L``, and its score for an item sums, over the item's terms with repeats,
``w * ((10^9 tf) div (1000 tf + 12 m))``. All but the weight is 64-bit integer arithmetic.

The plan: the terms of every text are taken once and written; one pass over them for N and L, one for ``df`` of the items' terms only (a semi-join against
their broadcast list, partial counts before the shuffle), then the scoring pass. The items'
inverted index (term -> item, weight times repeats) is broadcast after its size is counted; an
index of more than ``INDEX_ROWS`` entries is cut into blocks of items, each a pass of its own.
Each task streams its documents through the index and keeps, per item, a heap of its ``k``
best (score, doc_id); the heaps of all tasks are merged by a window over at most
``k x tasks`` rows per item. Nothing grows with a hot term, a hot item or a long text beyond
one document's term counts.

Edge cases: a null text has no terms (and does not count in N); a null doc_id ranks after all
ids on equal scores; repeated rows are scored each and may both be ranked; an empty table or an
empty benchmark gives no rows; only scores above 0 are ranked; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from popscope.llm.common import stored

# Fixed values of the contract.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
TOP = 20
INDEX_ROWS = 2_000_000  # (term, item) entries broadcast in one pass; more are split by item


def terms(text) -> F.Column:
    """The terms of a text column; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), 0)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's ``top`` best documents with a score above 0."""
    spark = docs.sparkSession
    # The terms are taken once and written: the three passes below read them, not the texts.
    docs = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), terms(F.col("text")).alias("terms")), "lexical_terms")
    totals = docs.select(F.size("terms").alias("n")).agg(
        F.count(F.when(F.col("n") > 0, 1)).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")
    ).first()
    n_docs, n_terms = int(totals["N"]), int(totals["L"])
    item_terms = items.select(F.col("item_id").alias("item_id"), F.explode(terms(F.col("text"))).alias("term"))
    wanted = item_terms.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("repeats"))
    schema = f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long"
    if n_docs == 0:
        return spark.createDataFrame([], schema)
    entries = wanted.count()
    block = max(1, math.ceil(entries / INDEX_ROWS))
    parts = []
    for b in range(block):
        part = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(block)) == b) if block > 1 else wanted
        index_terms = part.select("term").distinct()
        held = docs.select(F.explode(F.array_distinct("terms")).alias("term")).join(F.broadcast(index_terms), "term", "left_semi")
        df = held.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        index = part.join(df, "term").collect()  # at most INDEX_ROWS entries, counted above
        by_term: dict[str, list[tuple[object, int]]] = {}
        for row in index:
            by_term.setdefault(row["term"], []).append((row["item_id"], weight(n_docs, row["df"]) * row["repeats"]))
        shipped = spark.sparkContext.broadcast(by_term)
        parts.append(_heaps(docs, shipped, n_docs, n_terms, top, items.schema["item_id"].dataType.simpleString()))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    out = merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return out.select("item_id", F.col("rank").cast("int"), "doc_id", "score")


def _heaps(docs: DataFrame, shipped, n_docs: int, n_terms: int, top: int, item_type: str) -> DataFrame:
    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shipped.value
        heaps: dict[object, list] = {}
        for batch in batches:
            for doc_id, words in zip(batch["doc_id"], batch["terms"]):
                if words is None or len(words) == 0:
                    continue
                m = 75 + (25 * len(words) * n_docs) // n_terms
                scores: dict[object, int] = {}
                for term, tf in Counter(words).items():
                    hits = index.get(term)
                    if hits is None:
                        continue
                    part = (1_000_000_000 * tf) // (1000 * tf + 12 * m)
                    for item, w in hits:
                        scores[item] = scores.get(item, 0) + w * part
                key = -(doc_id if doc_id is not None and not pd.isna(doc_id) else math.inf)
                for item, score in scores.items():
                    if score <= 0:
                        continue
                    heap = heaps.setdefault(item, [])
                    entry = (score, key, None if math.isinf(key) else int(-key))
                    if len(heap) < top:
                        heapq.heappush(heap, entry)
                    elif entry[:2] > heap[0][:2]:
                        heapq.heapreplace(heap, entry)
        rows = [(item, doc, score) for item, heap in heaps.items() for score, _, doc in heap]
        yield pd.DataFrame(rows, columns=["item_id", "doc_id", "score"]).astype({"score": "int64"})

    schema = f"item_id {item_type}, doc_id long, score long"
    return docs.mapInPandas(stream, schema)

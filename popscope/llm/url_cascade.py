"""URL filter lists as Bloom filter cascades.

The first level of a cascade encodes the listed keys. The keys of the corpus that pass it
without being listed are encoded in the second, the listed keys that pass that one too in
the third, and so on until none is left. As the false positives are taken from all keys of
the corpus, the answer for each of these keys is exact, and asking takes bit tests and no join.

A rule is host and path; it fits its host and all subdomains where the url's path starts
with its path. A url's keys are the ends of its host joined with the starts of its path,
at the label counts and path lengths that occur among the rules. Among the keys that a
list holds, the longest decides; of equal ones that with the longer host.
No rule: the cascade of blocked keys answers "not listed", and the verdict is allow.

Null urls and urls without "://" have empty host and path, and so no rule. Repeated urls
get one verdict each. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popscope.llm.common import stored

MOST_BITS = 1 << 26  # of one level; a list that needs more is refused
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


@dataclass(frozen=True)
class Level:
    """One Bloom filter: 64-bit words, their number, and the number of hashes."""

    words: tuple[int, ...]
    bits: int
    hashes: int
    salt: int

    def has(self, key: Column) -> Column:
        # Written as text, which the optimizer folds into one array constant.
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        found = F.lit(True)
        for i in range(self.hashes):
            at = _place(key, self.salt, i, self.bits)
            word = F.get(words, F.shiftright(at, 6).cast("int"))
            found = found & (_shifted(word, at) == 1)
        return found


def _place(key: Column, salt: int, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), F.lit(i), key), F.lit(bits))


def _shifted(word: Column, at: Column) -> Column:
    """The bit of ``word`` that ``at`` names."""
    return F.call_function("shiftright", word, at.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1))


def _level(keys: DataFrame, count: int, rate: float, salt: int) -> Level:
    hashes = max(1, round(-math.log2(rate)))
    bits = max(64, -(-math.ceil(count * -math.log(rate) / math.log(2) ** 2) // 64) * 64)
    if bits > MOST_BITS:
        raise ValueError(f"a level of {bits} bits is above the bound of {MOST_BITS}")
    at = F.explode(F.array(*(_place(F.col("key"), salt, i, bits) for i in range(hashes))))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))
    filled = keys.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("set"))
    words = [0] * (bits // 64)
    for row in filled.collect():  # at most MOST_BITS / 64 rows
        words[row["word"]] = row["set"]
    return Level(tuple(words), bits, hashes, salt)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """Whether ``key``, a key of the corpus or the list, is listed."""
        answer = F.lit(len(self.levels) % 2 == 1)  # past the last level
        for i in reversed(range(len(self.levels))):
            answer = F.when(self.levels[i].has(key), answer).otherwise(F.lit(i % 2 == 1))
        return answer


def build_cascade(listed: DataFrame, universe: DataFrame, salt: int = 0) -> Cascade:
    """From two tables of distinct ``key``; what is not in ``universe`` may be answered wrongly.

    The first level's rate is about listed over other keys, so about as many false positives
    as listed keys go on; later levels halve. The bits needed follow the size of the list.
    """
    count = listed.count()
    if not count:
        return Cascade(())
    others = universe.join(listed, "key", "left_anti")
    rate = min(0.5, max(2.0**-40, count * math.sqrt(0.5) / max(1, others.count())))
    levels, wrong, right, right_count = [], others, listed, count
    while right_count:
        level = _level(right, right_count, rate, salt + len(levels))
        levels.append(level)
        wrong = stored(wrong.where(level.has(F.col("key"))), f"level{len(levels)}")
        wrong, right, right_count, rate = right, wrong, wrong.count(), 0.5
    return Cascade(tuple(levels))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, in lower-case ASCII, and path."""
    there = F.coalesce(F.locate("://", url), F.lit(0)) > 0
    rest = F.substring_index(url, "://", 1)
    rest = F.when(there, F.substr(url, F.length(rest) + 4)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def url_keys(host: Column, path: Column, labels: Iterable[int], lengths: Iterable[int]) -> Column:
    """Array of (length, host_length, key), at the given label counts and path lengths."""
    found = []
    for n in sorted(set(labels)):
        end = F.substring_index(host, ".", -n)
        enough = F.length(host) - F.length(F.replace(host, F.lit("."))) >= n - 1
        for length in sorted(set(lengths)):
            key = F.concat(end, F.substring(path, 1, length))
            fits = enough & (F.length(path) >= length)
            found.append(F.when(fits, F.struct(F.length(key).alias("length"), F.length(end).alias("host_length"), key.alias("key"))))
    return F.array_compact(F.array(*found))


def judge_urls(pages: DataFrame, rules=RULES, id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per url: id, host, path, rule (null where none fits), verdict."""
    spark = pages.sparkSession
    host, path = split_url(F.col(url))
    labels, lengths = [h.count(".") + 1 for _, h, _ in rules], [len(p) for _, _, p in rules]
    rows = pages.select(F.col(id).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("keys", url_keys(F.col("host"), F.col("path"), labels, lengths) if rules else F.expr("array()"))
    if not rules:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    universe = stored(rows.select(F.explode("keys.key").alias("key")).distinct(), "universe")
    blocked = {h + p for kind, h, p in rules if kind == "block"}
    cascades = {}
    for salt, (kind, keys) in enumerate({"block": blocked, "allow": {h + p for _, h, p in rules} - blocked}.items()):
        listed = spark.range(1).select(F.explode(F.array(*map(F.lit, sorted(keys))).cast("array<string>")).alias("key"))
        cascades[kind] = build_cascade(listed, universe, 1000 * salt)
    is_rule = lambda item: cascades["block"].holds(item["key"]) | cascades["allow"].holds(item["key"])
    best = rows.withColumn("best", F.array_max(F.filter("keys", is_rule)))
    verdict = F.when(F.col("best.key").isNotNull() & cascades["block"].holds(F.col("best.key")), "block").otherwise("allow")
    return best.select("page_id", "host", "path", F.col("best.key").alias("rule"), verdict.alias("verdict"))

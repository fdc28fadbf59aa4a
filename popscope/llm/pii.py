"""Personal data: base patterns, and identifiers found by their context.

Base spans are regular expressions with checks of their own. They seed a bootstrap: the words
around a seed are lexical patterns (the two words before it; the word on either side). Looser
expressions propose further identifiers of the same kinds that no base span touches. Patterns and
instances form a graph that is scored until no score grows: a pattern by the sum of its instances'
scores over their number and one, an instance by its best pattern. A pattern counts once it stands
by three different trusted instances, and an instance is added where its score reaches the threshold.
A pattern that rests on n seeds alone comes to n / (n + 1), so it takes four seeds to reach 0.8.

The expressions of the contract are written without backtracking into what cannot match: a
lookbehind keeps a failed start from being tried again inside the same run, and repeats that
nothing can follow are possessive. The matches are the same.

Null and empty texts have no spans. Rows of one id are rows of their own. Offsets count code
points. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popscope.llm.common import small, stored

KINDS = ("email", "ip", "card", "phone")
CONTEXT = 60  # characters on either side in which the neighbouring words are looked for
SUPPORT = 3  # trusted instances that a pattern must stand by
TRUST = 0.8  # score from which an instance counts as found
GROWTH = 1e-6  # a score that grows by less stands still


@dataclass(frozen=True)
class Shape:
    kind: str
    pattern: str
    may_have: str  # a cheap expression without which there is no match
    test: str = ""  # a further check in SQL, on the match s.m


_OCTET = "^0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
_DIGITS = "regexp_replace(s.m, '[^0-9]', '')"
_LUHN = (
    f"length({_DIGITS}) BETWEEN 14 AND 19 AND aggregate(sequence(1, length({_DIGITS})), 0, (total, i) -> total + "
    f"IF(i % 2 = 1, 1, 2) * int(substr({_DIGITS}, -i, 1)) - IF(i % 2 = 0 AND int(substr({_DIGITS}, -i, 1)) > 4, 9, 0)) % 10 = 0"
)
BASE = (
    Shape("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@[A-Za-z0-9-]"),
    Shape(
        "ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]++\.[0-9]",
        f"forall(split(s.m, '[.]'), p -> p RLIKE '{_OCTET}')",
    ),
    Shape("card", r"[0-9](?:[\x20-]?[0-9])++", r"(?:[0-9][\x20-]?){13}[0-9]", _LUHN),
    Shape("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", f"length({_DIGITS}) BETWEEN 10 AND 15"),
)
LOOSE = (
    Shape("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:@|\x20?\[at\]\x20?)[A-Za-z0-9._-]*+[A-Za-z0-9]", r"@|\[at\]"),
    Shape("ip", r"(?<![0-9A-Fa-f:.])(?:[0-9]++(?:\.[0-9]++){3}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7})(?![0-9A-Fa-f:])", r"[0-9A-Fa-f][.:][0-9A-Fa-f]*[.:]"),
    Shape("card", r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,18}+(?![0-9])", r"(?:[0-9][\x20-]?){12}[0-9]"),
    Shape("phone", r"(?<![0-9+])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,11}+(?![0-9])", r"(?:[0-9][\x20().-]{0,2}){6}[0-9]"),
)


SPANS = "array<struct<start:int,kind:int,end:int,m:string>>"


def _found(text: str, shape: Shape) -> Column:
    """Array of (start, kind, end, m) of the matches, in order.

    The pieces between the matches and the matches themselves, in turn, add up to the offsets.
    """
    pattern = F.lit(shape.pattern)
    pieces, matches = F.split(text, shape.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    both = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda p, m: F.struct(p.alias("p"), m.alias("m")))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out"))

    def add(state, item):
        start = state["at"] + F.length(item["p"])
        end = start + F.length(item["m"])
        span = F.struct(start.alias("start"), F.lit(KINDS.index(shape.kind)).alias("kind"), end.alias("end"), item["m"].alias("m"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    spans = F.aggregate(both, empty, add, lambda state: state["out"])
    return F.when(F.regexp_like(text, F.lit(shape.may_have)), spans).otherwise(F.array().cast(SPANS))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    shown = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(shown, ",")


def _without_text(spans: Column) -> Column:
    return F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))


def _patterns(text: str, span: Column) -> Column:
    """The lexical patterns around a span: the two words before, and the word on either side."""
    start = F.greatest(span["start"] - CONTEXT, F.lit(0))
    left = F.concat(F.lit(" "), F.substring(F.col(text), start + 1, span["start"] - start))
    right = F.substring(F.col(text), span["end"] + 1, F.lit(CONTEXT))
    before = F.lower(F.regexp_extract(left, r"(\S+\s+)?(\S+)\s*$", 0))
    words = F.filter(F.split(before, r"\s+"), lambda w: w != "")
    after = F.get(F.filter(F.split(F.lower(right), r"\s+"), lambda w: w != ""), 0)
    last, second = F.get(words, F.size(words) - 1), F.get(words, F.size(words) - 2)
    return F.array_compact(F.array(F.concat(F.lit("before "), second, F.lit(" "), last), F.concat(F.lit("around "), last, F.lit(" _ "), after)))


def _with_spans(rows: DataFrame, text: str, shapes: tuple[Shape, ...], prefix: str) -> DataFrame:
    """``rows`` with a column of checked spans per shape."""
    names = [f"{prefix}_{shape.kind}" for shape in shapes]
    raw = rows.select("*", *(_found(text, shape).alias(name) for name, shape in zip(names, shapes)))
    checked = {n: F.expr(f"filter({n}, s -> {shape.test})") for n, shape in zip(names, shapes) if shape.test}
    return raw.withColumns(checked)


def find_pii(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, added (spans beyond the base)."""
    rows = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    rows = _with_spans(rows, "body", BASE, "base")
    rows = rows.withColumn("base", F.concat(*(f"base_{kind}" for kind in KINDS)))
    rows = _with_spans(rows, "body", LOOSE, "loose")
    loose = F.concat(*(F.expr(f"filter(loose_{kind}, s -> NOT exists(base, b -> b.start < s.end AND s.start < b.end))") for kind in KINDS))
    rows = rows.withColumn("loose", loose)

    def described(spans, seed):
        return F.transform(
            spans,
            lambda s: F.struct(
                F.lit(seed).alias("seed"), s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
                F.lower(s["m"]).alias("instance"), _patterns("body", s).alias("patterns"),
            ),
        )

    counts = (F.size(f"base_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS)
    # Without the texts: what is kept is in proportion to the identifiers found.
    found = stored(
        rows.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", *counts, _without_text(F.col("base")).alias("base"),
            F.concat(described(F.col("base"), True), described(F.col("loose"), False)).alias("candidates"),
        ),
        "found",
    )
    candidates = found.select("row", F.explode("candidates").alias("c")).select("row", "c.*")
    added = _bootstrap(candidates)
    extra = added.groupBy("row").agg(F.collect_set(F.struct("start", "kind", "end")).alias("extra"))  # spans of one text
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    joined = found.join(extra, "row", "left").withColumn("extra", F.sort_array(F.coalesce("extra", none)))
    return joined.select(
        "doc_id", *(f"n_{kind}" for kind in KINDS), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.sort_array(F.concat("base", "extra"))).alias("spans"), _joined(F.col("extra")).alias("added"),
    )


def _bootstrap(candidates: DataFrame) -> DataFrame:
    """The candidates (row, start, kind, end) that trusted patterns find and that are no seeds."""
    edges = candidates.select("kind", "instance", "seed", F.explode("patterns").alias("pattern"))
    # Counted before anything else: a pattern or an instance that is everywhere is one row per pair.
    edges = stored(edges.groupBy("kind", "pattern", "instance").agg(F.max("seed").alias("seed")), "edges")
    patterns, round = None, 0
    while patterns is None or not patterns.where(F.col("score") > F.col("was") + GROWTH).isEmpty():
        patterns, round = stored(_scored(edges, patterns), f"patterns{round}"), round + 1
    good = _by_best_pattern(edges, patterns).where(F.col("score") >= TRUST).select("kind", "instance")
    return candidates.where("NOT seed").join(good, ["kind", "instance"]).select("row", "start", "kind", "end")


def _by_best_pattern(edges: DataFrame, patterns: DataFrame) -> DataFrame:
    """The instances (kind, instance, score) that patterns find."""
    by_pattern = edges.where("NOT seed").join(small(patterns.select("kind", "pattern", "score")), ["kind", "pattern"])
    return by_pattern.groupBy("kind", "instance").agg(F.max("score").alias("score"))


def _scored(edges: DataFrame, patterns: DataFrame | None) -> DataFrame:
    """The patterns that count (kind, pattern, score, was), a round after ``patterns``.

    An instance of a pattern that counts scores as much as the pattern at least. So those that no
    better pattern finds add to the sum what they add to the number, and are left out of both: the
    score is that of endless rounds, in as many rounds as patterns hang on better ones.
    """
    seed_score = F.col("seed").cast("double")
    if patterns is None:
        scored = edges.withColumns({"score": seed_score, "was": F.lit(0.0)})
    else:
        last = small(patterns.select("kind", "pattern", F.col("score").alias("was")))
        scored = edges.join(_by_best_pattern(edges, patterns), ["kind", "instance"], "left").join(last, ["kind", "pattern"], "left")
        scored = scored.withColumns({"score": F.greatest(seed_score, F.coalesce("score", F.lit(0.0))), "was": F.coalesce("was", F.lit(0.0))})
    better = F.when(F.col("score") > F.col("was"), F.col("score"))
    score = F.greatest(F.max("was"), F.coalesce(F.sum(better), F.lit(0.0)) / (F.count(better) + 1))
    trusted = F.count(F.when(F.col("score") >= TRUST, 1))
    grouped = scored.groupBy("kind", "pattern").agg(score.alias("score"), F.max("was").alias("was"), trusted.alias("support"))
    return grouped.where(F.col("support") >= SUPPORT).select("kind", "pattern", "score", "was")

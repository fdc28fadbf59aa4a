"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscope.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every end of ``links`` (a, b); the component is its smallest id.

    Rounds of contraction: every node goes over to its smallest neighbour; links between nodes
    that went to the same one disappear. A round removes every node that has a smaller
    neighbour, and in the end all moves are joined. Each round is written, so a lost executor costs
    a part of one round.
    """
    moves, edges = [], stored(links.select("a", "b").where("a <> b").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("id"), F.col("a").alias("other")))
        nearest = both.groupBy("id").agg(F.least("id", F.min("other")).alias("component"))
        moves.append(stored(nearest, "moves"))
        left = moves[-1].select(F.col("id").alias("a"), F.col("component").alias("to_a"))
        right = moves[-1].select(F.col("id").alias("b"), F.col("component").alias("to_b"))
        moved = edges.join(left, "a").join(right, "b").where("to_a <> to_b")
        edges = stored(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges")
    if not moves:
        return links.select(F.col("a").alias("id"), F.col("b").alias("component")).limit(0)
    labels = moves[0]
    for move in moves[1:]:
        labels = relabelled(labels, move)
    return labels


def relabelled(labels: DataFrame, moves: DataFrame) -> DataFrame:
    """``labels`` with components that ``moves`` (id, component) names replaced."""
    to = moves.select(F.col("id").alias("component"), F.col("component").alias("to"))
    others = [c for c in labels.columns if c != "component"]
    return labels.join(to, "component", "left").select(*others, F.coalesce("to", "component").alias("component"))


def joined_labels(labels: DataFrame, moves: DataFrame) -> DataFrame:
    """``labels`` after ``moves``, with the nodes that only the latter know."""
    return relabelled(labels, moves).unionByName(moves.join(labels.select("id"), "id", "left_anti"))

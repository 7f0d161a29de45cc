"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node, label: the smallest node that each node of the edges (a, b) is connected to.

    Alternates two star operations until nothing changes: every node links its larger
    neighbours, then its smaller ones, to the smallest node it knows. The rounds grow with the
    logarithm of the longest path. Edges stay in tables; a node with many neighbours meets only
    aggregates with partial sums and joins that Spark may split.
    """
    links = scratch.store(
        edges.where("a != b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "links"
    )
    before = None
    for turn in count():
        both = links.unionByName(links.selectExpr("b AS a", "a AS b"))
        large = _star(both, "b > a", scratch, f"large-{turn}")
        links = _star(large, "b < a", scratch, f"small-{turn}")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).collect()[0]
        if state == before:
            break
        before = state
    own = links.selectExpr("b AS node", "b AS label").distinct()
    return links.selectExpr("a AS node", "b AS label").unionByName(own)


def _star(both: DataFrame, moved: str, scratch: Scratch, name: str) -> DataFrame:
    """Links (a > b): the neighbours b of every node a that are ``moved``, to a's smallest."""
    least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) AS m")
    joined = both.join(least, "a")
    links = joined.where(moved).selectExpr("b AS a", "m AS b")
    if moved == "b < a":
        links = links.unionByName(least.selectExpr("a", "m AS b"))
    return scratch.store(links.where("a != b").distinct(), name)

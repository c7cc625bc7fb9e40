"""Connected components by alternating large-star and small-star steps.

Every step is two shuffles over the edges; each round's edges are written to
the shared folder, so lineage stays short and lost executors cost one round.
Nothing but a count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augur.llm.scratch import stored


def _star(edges: DataFrame, large: bool, rows: int) -> DataFrame:
    """One step over at most ``rows`` edges: a large star makes no more of them, a small star twice as many at most."""
    both = edges.select("u", "v")
    if large:
        both = both.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:  # every edge at its larger end
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    # written, so the join can split a node that a third of all edges meet
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least", 2 * rows)
    near = both.join(least, "u")
    if large:
        return near.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    return (
        near.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.filter("u <> m").select("u", F.col("m").alias("v")))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: long) -> (node, component): the least node reachable,
    for every node on an edge to another node. Repeated edges, both directions
    and self-loops are accepted; an empty table gives an empty table."""
    now = stored(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    seen = None
    while True:
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == seen or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = mark
        now = stored(_star(_star(now, True, mark[0]), False, mark[0]), "edges", 2 * mark[0])

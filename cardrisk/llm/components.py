"""Connected components of a link table by repeated contraction, in DataFrame operations.

Each round every node takes the smallest of itself and its neighbours, in a scrambled order, as its parent; links are
rewritten to parents, and what still joins different nodes goes on. Under a scrambled order every round at least
about halves the nodes of a path and folds a clique at once, so later rounds cost less and less. Parents are kept for
each round and folded back at the end. Nothing but row counts reaches the driver, and lineage is cut by written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardrisk.session import discard, materialise


def _scramble(name: str, seed: int):
    """A bijection of 64-bit ids: XOR with a constant of the round, so that another node is least each time."""
    return F.col(name).bitwiseXOR(F.lit(seed))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node and root, both 64-bit, for every node of a link to another; the root names the component.

    Ids have to be spread evenly, as hashes are. Links may repeat, point either way or join a node to itself; null
    ends are passed over. A table without links gives no rows.
    """
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    edges = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rounds, turn = [], 0
    while edges.limit(1).count():
        seed = (0x9E3779B97F4A7C15 * (turn + 1)) % (1 << 63)
        ends = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        parents = materialise(
            ends.groupBy("a").agg(F.min(_scramble("b", seed)).alias("m"))
            .select(F.col("a").alias("node"), F.least(_scramble("a", seed), F.col("m")).bitwiseXOR(F.lit(seed)).alias("parent"))
        )
        rounds.append(parents)
        of = lambda end: parents.select(F.col("node").alias(end), F.col("parent").alias(f"p_{end}"))
        moved = edges.join(of("a"), "a").join(of("b"), "b").filter("p_a <> p_b")
        before, edges = edges, materialise(moved.select(F.least("p_a", "p_b").alias("a"), F.greatest("p_a", "p_b").alias("b")).distinct())
        discard(before)
        turn += 1
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = rounds[0].select("node", F.col("parent").alias("root"))
    for later in rounds[1:]:
        step = later.select(F.col("node").alias("root"), F.col("parent").alias("_next"))
        found = found.join(step, "root", "left").select("node", F.coalesce("_next", "root").alias("root"))
    return found

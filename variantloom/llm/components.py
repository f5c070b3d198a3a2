"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import discarded, written

#: Links for each map task of a round, and the fewest tasks that a round uses.
PER_TASK, LEAST_TASKS = 200_000, 8


def stored(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The links, written, and their number and digest, which are taken while they are written."""
    seen = Observation()
    out = written(links.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)")).alias("digest")))
    return out, (seen.get["rows"], seen.get["digest"])


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component (the smallest node reachable) for every node of links (a, b); nodes without a link are absent.

    Each round takes minima by partial aggregation and joins them back, so a node with very many links is no hot
    group; the number of rounds grows with the logarithm of the longest path. A round's links are written before those of the round
    before are deleted. The rows of a round are narrow and get fewer with every round, so each step's output is taken together in tasks of
    PER_TASK links: otherwise few links would leave files of every task for every partition of the session behind.
    """
    links, state = stored(links.filter("a <> b").selectExpr("least(a, b) AS low", "greatest(a, b) AS high").distinct())
    for _ in range(most_rounds):
        together = lambda df: df.coalesce(max(LEAST_TASKS, -(-state[0] // PER_TASK)))  # noqa: B023, E731
        # large star: each node's larger neighbours point to the smallest of the node and its neighbours
        both = together(links.selectExpr("high AS u", "low AS v").union(links.selectExpr("low AS u", "high AS v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = together(both.filter("v > u").join(least, "u").filter("v <> m").selectExpr("m AS low", "v AS high"))
        # small star: each node and its smaller neighbours point to the smallest of them
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        small = large.join(least, "high").filter("low <> m").selectExpr("m AS low", "low AS high").union(least.selectExpr("m AS low", "high"))
        new, now = stored(together(small).distinct())
        discarded(links)
        links, last, state = new, state, now
        if now == last:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return links.selectExpr("high AS node", "low AS component").union(links.selectExpr("low AS node", "low AS component").distinct())

"""Connected components of an edge table, by alternating stars with checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Edges per task. A small graph goes through few tasks, so its rounds write few files.
TASK_EDGES = 200_000


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable, for every node on an edge ``a, b``.

    Every round turns the edges of each node towards its smallest neighbour,
    first those to larger nodes, then those to smaller ones; it ends when
    nothing changes. Only the smallest neighbour per node is aggregated, no
    list of neighbours is ever collected. Null ends and loops are ignored.
    """
    pair = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    current = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(*pair).distinct().checkpoint()
    seen = None
    while True:
        mark = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if mark == seen or not mark["n"]:
            break
        seen = mark
        # A round gives each edge back at most twice.
        tasks = 2 * mark["n"] // TASK_EDGES + 1
        current = current.coalesce(tasks)
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b"))).coalesce(tasks)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).coalesce(tasks)
        large = both.join(least, "a").filter("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.coalesce(tasks).distinct().coalesce(tasks)
        least = large.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks)
        small = large.join(least, "a").coalesce(tasks)
        # Both turned edges of a row at once, so that the join is read once.
        turned = F.explode(
            F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        )
        small = small.select(turned.alias("x")).select("x.a", "x.b").filter("a <> b")
        current = small.distinct().coalesce(tasks).checkpoint()
    nodes = current.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    roots = nodes.select(F.col("component").alias("node"), "component").distinct()
    return nodes.unionByName(roots)

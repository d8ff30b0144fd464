"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialised


def _sides(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links(a, b)``; the root is the least node.

    Large and small stars alternate until nothing changes, which takes about the
    logarithm of the longest path. Minima are partial aggregations and what is
    joined back is one row a node, so no component meets in one task. Each round
    is written to the shared folder.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialised(edges.filter("a <> b").distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = _sides(edges)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = materialised(large.distinct(), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.filter("a <> b").unionByName(least.select("a", F.col("m").alias("b")))
        edges = materialised(small.filter("a <> b").distinct(), "edges")
        after = _state(edges)
        if after == state:
            break
        state = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()

"""Connected components of a link table, by joins and grouped minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from demandloom.llm.shared import stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(
        F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("l")).select("l.*")


def _written(links: DataFrame, path: str) -> tuple[DataFrame, tuple]:
    """The link set as a table, and numbers that are equal for equal sets, observed while it is written."""
    seen, word = Observation(), F.xxhash64("a", "b")
    links = links.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(word).alias("x"), F.sum(word % 1000003).alias("s"))
    out = stored(links, path)
    return out, tuple(seen.get[k] for k in ("n", "x", "s"))


def components(links: DataFrame, folder: str) -> DataFrame:
    """(node, root) of every node of links(a, b), root the smallest node that can be reached.

    Alternates large-star (every larger neighbour of a node moves to the node's smallest
    neighbour) and small-star (every smaller one does) until the links are stars. Each round is a
    grouped minimum with map-side combine and a join that adaptive execution can split, and is
    written to `folder`, so that a lost executor costs one round and no plan grows.
    """
    at, seen = _written(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                        f"{folder}/links-0")
    turn = 0
    while seen[0]:
        turn += 1
        around = _both_ways(at)
        smallest = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (around.join(smallest.hint("merge"), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least.hint("merge"), "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                              F.struct(F.col("a"), F.col("m").alias("b")))).alias("l")).select("l.*")
        was = seen
        at, seen = _written(small.filter("a <> b").distinct(), f"{folder}/links-{turn}")
        if was == seen:
            break
    roots = at.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())

"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadsmith.session import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (columns a, b); the root is a component's smallest node.

    Each round hangs every node on the smallest neighbour it knows of and writes
    the links to the shared folder, until a round changes nothing; a chain of n
    links takes about log(n) rounds.  Minima are combined before the shuffle, so a
    node with very many links is no single task's work.  Links are undirected and
    may repeat; an empty table gives an empty result.
    """
    edges = materialize(links.where("a <> b").select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "links")
    state = _fingerprint(edges)
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        first = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(first, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = materialize(small.unionAll(first.select("hi", F.col("m").alias("lo"))).distinct(), "links")
        now = _fingerprint(edges)
        if now == state:
            break
        state = now
    roots = edges.select("lo").distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(
        roots.select(F.col("lo").alias("node"), F.col("lo").alias("root")))


def _fingerprint(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("hi", "lo")
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(hi, lo))"),
                           F.sum(F.shiftright(mixed, 20))).first())

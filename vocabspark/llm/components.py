"""Connected components by alternating star contractions, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabspark.session import checkpoint


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _downward(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger node to its smaller one."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(mixed), F.sum(mixed.bitwiseAND(F.lit(0xFFFFFFFF)))).first())


def components(edges: DataFrame) -> DataFrame:
    """The smallest node that each node is linked with.

    ``edges(a, b)`` are undirected links between comparable, non-null nodes; repeated links and
    links of a node with itself are allowed. Returns ``(id, component)`` for every node that has
    a link to another one; ``component <= id``. An empty table gives an empty table.

    Every round links the larger neighbours of each node to its smallest neighbour (large star),
    then the smaller ones (small star), until nothing changes; the rounds grow with the
    logarithm of the longest path. A round sends each link a bounded number of times; a node
    with very many links is one side of a join that Spark can split, never one group.
    """
    edges = checkpoint(_downward(edges))
    state = _state(edges)
    while state[0]:
        large = _both_ways(edges)
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        edges = large.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = _downward(edges)
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        small = edges.join(least, "a")
        edges = checkpoint(
            _downward(small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))))
        )
        now = _state(edges)
        if now == state:
            break
        state = now
    nodes = edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    roots = edges.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return nodes.unionByName(roots)

"""Connected components of links, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireworks.llm.common import settled

_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for links (u, v): component is the smallest node reachable.

    Large-star and small-star steps by turns: every node's larger neighbours are linked to
    its smallest one, then its smaller neighbours, until nothing changes; the number of
    rounds grows with the logarithm of the nodes. The smallest neighbour is a partial
    aggregate, so a node with very many links costs a row per task, and each step is
    checkpointed. Nodes without links don't appear; links to null or to itself are ignored.
    """
    edges = settled(
        links.filter("u IS NOT NULL AND v IS NOT NULL AND u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    before = _state(edges)
    for _ in range(_ROUNDS):
        if not before[0]:
            break
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
            .select(F.col("e.u").alias("u"), F.col("e.m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        edges = settled(small)
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return (
        edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
        .unionByName(roots.select("node", F.col("node").alias("component")))
    )

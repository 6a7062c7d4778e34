"""Connected components of a link table by alternating large-star and small-star steps.

Each step is a grouping and a join on node ids, so links, components and
labels stay distributed.  Every round is written to the shared folder, which
cuts the lineage, and takes the place of the one before; the number of rounds grows with the logarithm of the longest
chain.  Whether a round changed anything is observed while it is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from farelane.llm.frames import discard, materialize


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The written edges, and a checksum that tells two different sets of edges apart."""
    h = F.xxhash64("u", "v")
    seen = Observation()
    table = materialize(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.shiftright(h, 24)).alias("s"), F.sum(h.bitwiseAND(0xFFFFFF)).alias("t")), "edges")
    got = seen.get
    return table, (got["n"], got["s"], got["t"])


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for every node that has a link.

    Null ends and self links are ignored; repeated links count once.  Without
    links the result is empty.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges, seen = _written(edges.distinct())
    while seen[0]:
        # large star: every neighbour that is larger than a node goes to the smallest of the node and its neighbours
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours all go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        before, old = seen, edges
        edges, seen = _written(small.filter(F.col("u") != F.col("v")).distinct())
        discard(old)
        if seen == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)

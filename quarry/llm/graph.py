"""Connected components over edge tables of any size, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b); a
    component is named by its smallest node.

    Alternating star rounds: each node hands its larger neighbours, then its
    smaller ones, to its least neighbour, until every edge points at a root.
    A node's least neighbour is an aggregate with map-side combination, and
    the join that hands it out has a hot node on one side only, so that
    adaptive execution can split it. Edges with a null end and loops are
    ignored; an empty table has no components. Each round is written to the
    shared folder.
    """
    a, b = F.col("a"), F.col("b")
    e = edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    state = None
    while True:
        e = written(e, "components")
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == state:
            break
        state = now
        both = e.unionByName(e.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.least(a, F.min("b")).alias("m"))
        # Large star: the larger neighbours of a go to its least neighbour.
        e = e.select(b.alias("a"), a.alias("b")).join(least, "a").select(b.alias("a"), F.col("m").alias("b")).where(a != b).distinct()
        # Small star: the smaller neighbours of a, and a, go to the least of them.
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        e = e.join(least, "a").select(b.alias("a"), F.col("m").alias("b")).where(a != b).unionByName(least.select("a", F.col("m").alias("b"))).distinct()
    return e.select(a.alias("node"), b.alias("component")).unionByName(e.select(b.alias("node"), b.alias("component")).distinct())

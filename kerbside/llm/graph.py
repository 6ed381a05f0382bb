"""Connected components as rounds of joins and minima over the edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from kerbside.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read from there: lineage ends, rows stay fixed."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """``edges`` stored, and what tells them from other edges: taken while they are written."""
    seen, hashed = Observation(), F.xxhash64("a", "b")
    counted = edges.observe(seen, F.count("*").alias("n"), F.bit_xor(hashed).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), hashed)).alias("y"))
    now = stored(counted, "edges")
    return now, tuple(seen.get.get(k) for k in ("n", "x", "y"))


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is its least node.

    Alternating star contraction: nodes are hung under the least node of their neighbourhood, first
    larger neighbours, then smaller ones, until the edges are stars: hanging larger neighbours changes
    nothing, and each node hangs under one. Neighbourhoods are never
    gathered, only their minimum is, so a node with a third of all edges is one sum and a join
    that Spark may split. Edges with a null end are left out.
    """
    now, before = _settled(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(most_rounds if before[0] else 0):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Repeated edges change no minimum, and go at the end of the round.
        large, between = _settled(large.where("a <> b"))
        if between == before and large.groupBy("a").count().where("count > 1").isEmpty():
            break
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            small.select("a", F.col("m").alias("b")))
        now, before = _settled(small.where("a <> b").distinct())
    else:
        if before[0]:
            raise RuntimeError(f"no forest of stars after {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

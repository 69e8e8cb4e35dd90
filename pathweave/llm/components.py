"""Distributed union-find over an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathweave.llm.scratch import dropped, written


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """Per node the least of itself and its neighbours; the minimum combines before the shuffle."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_least_neighbour(both), "u")
    return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = down.join(_least_neighbour(down), "u")
    pairs = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
    return joined.select(pairs.alias("p")).select("p.*").filter("u <> v").distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of an edge; the component is its least node.

    ``edges`` has two columns of one ordered type; loops, repeats and nulls in them do no harm. No neighbour
    list is ever gathered: a step joins each edge with the least neighbour of its end, so that a node with
    very many edges only makes many rows, which a skewed join splits. Each round is written to the shared
    folder and the round before is deleted. An empty edge table gives an empty result.
    """
    first, second = edges.columns
    now = written(
        edges.select(F.col(first).alias("u"), F.col(second).alias("v")).filter("u <> v").distinct(), "edges"
    )
    was = _digest(now)
    while True:
        new = written(_small_star(_large_star(now)), "edges")
        digest = _digest(new)
        dropped(now)
        now = new
        if digest == was:
            break
        was = digest
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is a group-by that combines before it shuffles and a join whose heavy keys Spark splits, so a node
with very many neighbours does not meet in one task. Edges are written after every round; nothing but two
numbers per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .frames import written


def _lowest(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Edges (a, b) with the least b of their a as `low`."""
    return edges.join(edges.groupBy(a).agg(F.min(b).alias("low")), a)


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, a: Column, b: Column) -> DataFrame:
    """(node, root) of every node that has an edge to another; root is the least node of the component."""
    both = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).filter("hi != lo")
    now = written(both.distinct(), "edges")
    before, mark = None, _mark(now)
    while mark != before:
        around = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        large = _lowest(around, "u", "v").filter("v > u").select(F.col("v").alias("hi"), F.least("u", "low").alias("lo"))
        small = _lowest(large.distinct(), "hi", "lo")
        stars = small.select("hi", F.col("low").alias("lo")).union(
            small.filter("lo != low").select(F.col("lo").alias("hi"), F.col("low").alias("lo"))
        )
        now = written(stars.distinct(), "edges")
        before, mark = mark, _mark(now)
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )

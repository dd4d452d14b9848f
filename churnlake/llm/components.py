"""Connected components as a distributed star contraction.

Edges are contracted by alternating large-star and small-star steps until every node points
straight at the smallest node of its component. Each round is a grouped minimum plus a join;
the minima and the edges are frozen in the shared folder, so both join sides are plain
scans and adaptive execution can split a node that has a third of all edges. A round's
frames are written by as many tasks as the measured number of edges needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.rows import few_tasks
from churnlake.plans.bounded import freeze


def _lowest(pairs: DataFrame, rows: int) -> DataFrame:
    """Smallest right end per left end, with partial minima before the shuffle."""
    return freeze(few_tasks(pairs.groupBy("a").agg(F.min("b").alias("m")), rows), "lowest")


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    """Every node's larger neighbours move to its smallest neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _lowest(both, 2 * rows)
    # An edge is kept as (large, small), so the rows of ``edges`` are the pairs b -> a with a > b.
    moved = edges.select(F.col("b").alias("n"), "a").join(low.withColumnRenamed("a", "n"), "n")
    return moved.select("a", F.least("n", "m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of them."""
    low = _lowest(edges, rows)
    joined = edges.join(low, "a")
    moved = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def _settled(edges: DataFrame, rows: int) -> bool:
    """Whether every node points at one node, which points at none: all components are stars
    around their smallest node."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("out")).union(edges.select("b", F.lit(0)))
    per_node = ends.groupBy("n").agg(F.sum("out").alias("out"), F.min("out").alias("least"))
    wrong = few_tasks(per_node, 2 * rows).filter("out > 1 or (out = 1 and least = 0)")
    return wrong.agg(F.count(F.lit(1))).first()[0] == 0


def components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)`` that is not itself the
    smallest node of its component.

    Direction, repeats, loops and null ends of edges don't matter. Nodes may be of any
    ordered type. No edges give an empty frame. ``most`` is a bound on the number of edges,
    if the caller has one; it decides on nothing but the number of tasks.
    """
    distinct = (
        edges.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    now = freeze(distinct if most is None else few_tasks(distinct, most), "edges")
    rows = now.count()
    while rows and not _settled(now, rows):
        stars = freeze(few_tasks(_large_star(now, rows), rows), "large_star")
        now = freeze(few_tasks(_small_star(stars, rows), rows), "small_star")
        rows = now.count()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))

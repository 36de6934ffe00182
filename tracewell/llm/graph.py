"""Connected components by alternating large-star and small-star rounds, all as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import durable, release
from tracewell.session import compact, drop_kept, kept_so_far, tasks_of

#: Edges that are worth a task of their own; fewer tasks than that write fewer, larger files.
_TASK_EDGES = 20_000
_FEWEST_TASKS = 8
#: A node of more edges than this, and than one in _HUBS of all, is a hub.
_HUB_EDGES = 1000
_HUBS = 2000


def _stars(edges: DataFrame, large: bool, tasks: int, most: int | None = None) -> DataFrame:
    """One round.  most: nodes of more edges than this are hubs; None if there are none."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.filter("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    if most is None:
        met = both.join(least.select("u", "m"), "u")
    else:  # there are at most 2 n / most hubs, so they go to the edges; the others' edges meet them
        least = durable(least.coalesce(tasks))
        hubs = least.filter(F.col("n") > most).select("u", F.col("m").alias("hub"))
        told = both.join(F.broadcast(hubs), "u", "left")
        met = told.filter("hub is not null").withColumnRenamed("hub", "m").unionByName(told.filter("hub is null").drop("hub").join(least.select("u", "m"), "u"))
    if large:
        found = met.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        found = met.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return found.coalesce(tasks).distinct().coalesce(tasks)


def _size(edges: DataFrame) -> tuple[tuple[int, int], int]:
    """(number and checksum of the edges, the most edges that go down to one node)."""
    by = edges.groupBy("v").agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).coalesce(tasks_of(edges))
    n, h, most = by.agg(F.sum("n"), F.sum("h"), F.max("n")).first()
    return (n or 0, h), most or 0


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge table (u, v) of longs; a component's name is its least node.

    Each round's edges are checkpointed, so lineage stays short and a lost executor costs one round at most.  A node's
    edges meet in one task up to _HUB_EDGES, or one in _HUBS of all; beyond that they don't: what they must know, the
    node's least neighbour, is broadcast, for some 4000 nodes at most whatever the number of edges.
    """
    spark = edges.sparkSession
    last = kept_so_far(spark)
    edges = compact(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen, degree = _size(edges)
    tasks = max(_FEWEST_TASKS, -(-seen[0] // _TASK_EDGES))
    while True:
        most = max(_HUB_EDGES, seen[0] // _HUBS)
        if degree <= most:
            edges = compact(_stars(_stars(edges, True, tasks), False, tasks))
        else:
            edges = compact(_stars(compact(_stars(edges, True, tasks, most)), False, tasks, most))
        now, degree = _size(edges)
        drop_kept(spark, last, kept_so_far(spark) - 1)  # the round before and what led from it to this one
        last = kept_so_far(spark) - 1
        release(spark)  # a round is a dozen exchanges, and they leave memory behind
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct().coalesce(2 * tasks_of(edges))

"""Connected components of a graph of long ids, by star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import arrow_map, cut, tidy

#: Edges that a task contracts at a time, and edges of a partition below which partitions are put together.
BUFFER, LEAST_EDGES = 1 << 20, 1 << 16


class NotConverged(RuntimeError):
    """Components were not complete after the rounds that were allowed."""


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of stars that connect what the edges (u, v) connect: (node, least node) of every other node."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(root, further := root[root]):
            root = further
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def _contracted(edges: DataFrame) -> DataFrame:
    """Fewer edges with the same components: stars of what a task has, a buffer at a time."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0

        def out() -> pa.RecordBatch:
            node, least = forest(*(np.concatenate(x) for x in zip(*held)))
            return pa.RecordBatch.from_arrays([pa.array(node), pa.array(least)], names=["u", "v"])

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            count += batch.num_rows
            if count >= BUFFER:
                yield out()
                held, count = [], 0
        if count:
            yield out()

    return arrow_map(edges.select("u", "v"), work, "u long, v long")


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")


def _with_least(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) with ``m``, the least v of every u.

    A node's edges are dealt over as many tasks as a shuffle has, by a salt of
    v, so that a node with a third of all edges is no task's load.  The least of
    each salt is a row; the least of a node is taken over those alone, one row
    for each salt at most, and goes back to the tasks that hold the edges.
    """
    salts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = edges.select("u", "v", F.pmod(F.xxhash64("v"), F.lit(salts)).cast("int").alias("s")).repartition("u", "s")
    parts = dealt.groupBy("u", "s").agg(F.min("v").alias("m"))
    least = parts.select("u", "s", F.min("m").over(Window.partitionBy("u")).alias("m"))
    return dealt.join(least, ["u", "s"]).select("u", "v", "m")


def _held(edges: DataFrame) -> tuple[DataFrame, int]:
    """``edges`` as a checkpoint of partitions that aren't all but empty, and how many those are."""
    now = cut(edges)
    tidy(edges.sparkSession)
    parts = max(1, -(-now.count() // LEAST_EDGES))
    return now.coalesce(parts), parts


def _named(stars: DataFrame) -> DataFrame:
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v): component is the least node.

    First every task contracts the edges that it has to stars.  Then two steps
    alternate until only stars are left: every node links its larger neighbours
    to the least it sees, then its smaller ones.  What is down to the edges of
    one task is contracted there to the end.  The number of rounds grows with
    the logarithm of the nodes; a result that isn't complete after ``rounds`` of
    them is an error.  No list of neighbours is ever gathered.  Each round ends
    in a checkpoint.  Loops and repeated edges count for nothing; no edges: no rows.
    """
    now, parts = _held(_contracted(edges.where("u <> v")).distinct())
    for done in range(rounds + 1):
        if parts == 1:
            return _named(cut(_contracted(now)))
        # stars: no node has two smaller neighbours, or a smaller and a larger one
        ends = now.select(F.explode(F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
        if ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up > 0 AND down > 0)").isEmpty():
            return _named(now)
        if done == rounds:
            break
        # large star: u's larger neighbours to the least of u and its neighbours
        both = _with_least(_both_ways(now))
        large = both.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u <> v")
        # small star: u and its smaller neighbours to the least of them
        joined = _with_least(large)
        small = joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        now, parts = _held(small.where("u <> v").distinct())
    raise NotConverged(f"components are not complete after {rounds} rounds")

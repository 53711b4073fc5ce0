"""Connected components of a table of links, joined up within tasks and by large and small stars.

A task joins up the links it holds, piece by piece, and keeps a row per node and piece: its link
to the least node it reaches there. What is left is joined by alternating large and small stars,
each an aggregation over the links. A node with very many links only ever sends one minimum
back to them, and both sides of the join are plain exchanges, so its rows are spread; below it
it has one node a piece at most, so the list that a small star gathers is short. The least
neighbours of the next large star also tell when all is done: no node that has a smaller
neighbour has another one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import saved

PIECE = 1 << 18  # links that a task joins up at once


def labelled(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least member of each member's component, for links between places 0 to n - 1."""
    label = np.arange(n)
    while left.size:
        before = label.copy()
        least = np.minimum(label[left], label[right])
        for side in (left, right):
            np.minimum.at(label, before[side], least)  # what the side is labelled by comes along
            np.minimum.at(label, side, least)
        label = label[label]
        if (label == before).all():
            break
    return label


def _pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Batches put together to tables of ``size`` rows, or a batch more."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        rest.append(batch)
        if sum(b.num_rows for b in rest) >= size:
            yield pa.Table.from_batches(rest)
            rest = []
    if rest:
        yield pa.Table.from_batches(rest)


def joined_up(links: DataFrame) -> DataFrame:
    """The same components by a link (u, v) for a node and piece at most, to the least node it reaches there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _pieces(batches, PIECE):
            u, v = (table.column(c).to_numpy() for c in ("u", "v"))
            node, place = np.unique(np.concatenate([u, v]), return_inverse=True)
            label = labelled(node.size, place[: u.size], place[u.size :])
            some = np.flatnonzero(label != np.arange(node.size))
            yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(node[label[some]])], ["u", "v"])

    return links.select("u", "v").mapInArrow(run, "u bigint, v bigint")


def _least(both: DataFrame) -> DataFrame:
    """Rows (u, m, more): the least neighbour of each node, itself included, and whether it has several."""
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("most"))
    return saved(least.select("u", F.least("m", "u").alias("m"), (F.col("m") < F.col("most")).alias("more")), "least")


def _large(both: DataFrame, least: DataFrame) -> DataFrame:
    """Neighbours above a node are linked to its least one, the node included."""
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small(links: DataFrame) -> DataFrame:
    """A node and its neighbours, all below it, are linked to the least of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"), F.collect_set("v").alias("below"))
    return least.select(F.explode(F.array_append("below", F.col("u"))).alias("u"), F.col("m").alias("v")).where("u <> v")


def components(links: DataFrame) -> DataFrame:
    """Rows (u, label) for every linked node: the least node of its component, the least itself included."""
    links = saved(joined_up(links.where("u <> v")), "links")
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both)
        if least.where("m < u AND more").isEmpty():
            return saved(least.select("u", F.col("m").alias("label")), "components")
        links = saved(joined_up(saved(_small(_large(both, least)), "star")), "links")

"""Connected components by contraction in bounded chunks and alternating star rounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexloom.llm.textvec import tidy
from hexloom.llm.workspace import discard, materialize

CHUNK = 1 << 20  # links that one task contracts in memory


def contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, least node of each one's component) of the links a - b."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        while not np.array_equal(new, shorter := new[new]):
            new = shorter
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


@tidy()
def _contract(batches):
    held = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
    if held:
        nodes, least = contracted(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(least)], ["a", "b"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's larger (or smaller) neighbours are tied to its least neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = both.join(least, "a")
    moved = joined.where("b > a" if large else "b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.unionByName(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(a, b)`` links of numbers -> ``(node, component)``, the component being its least node.

    Nodes without links do not appear; null ends, loops and repeated links are ignored.
    Tasks contract up to about ``chunk`` links each to stars. If all links fit one chunk that
    is the result; else star rounds, in which a node of very many links is only reduced to a
    minimum, join the chunks' stars, until nothing changes.
    """
    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    chunks = -(-edges.count() // chunk)
    stars = materialize(edges.repartition(max(chunks, 1)).mapInArrow(_contract, "a long, b long"), "stars")
    discard(edges)
    if chunks <= 1:
        return stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    edges, last, before = stars.where("a <> b"), stars, None
    while True:
        edges = materialize(_star(_star(edges, True), False), "star")
        discard(last)
        last = edges
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = now

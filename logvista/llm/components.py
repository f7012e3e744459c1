"""Connected components of a link table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Workspace, lean

#: Links that one task contracts.
LINKS = 2_000_000


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes of the links and the smallest node of each one's component, among these links alone."""
    nodes, both = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = both[: len(a)], both[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        for end in (u, v):
            np.minimum.at(new, end, low)
            np.minimum.at(new, label[end], low)
        while (jump := new[new]).tolist() != new.tolist():
            new = jump
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(x.column(0).to_numpy(), x.column(1).to_numpy()) for x in batches if x.num_rows]
    if held:
        nodes, root = roots(*(np.concatenate(c) for c in zip(*held, strict=True)))
        far = nodes != root
        yield pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(root[far])], names=["u", "v"])


def connected_components(edges: DataFrame, work: Workspace, most: int = LINKS) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) with a link; root is the smallest node that can be reached.

    The links are dealt to tasks of about ``most`` each, and every task keeps only the stars of its own components. If one
    task sufficed, these are the components. Otherwise the large-star and small-star steps of map-reduce connectivity
    follow until the stars stop changing, a number of rounds that grows with the logarithm of the graph. Each round is
    written to the shared folder; only a count and a checksum come to the driver. Loops and repeated links are allowed;
    nulls are left out.
    """
    links = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links = work.keep(links, "links")
    tasks = -(-links.count() // most)
    now = work.keep(links.coalesce(max(1, tasks)).mapInArrow(lean(_contract), "u long, v long"), "stars")
    if tasks > 1:
        now = _stars(now, work)
    root = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return root.union(root.select(F.col("root").alias("node"), "root").distinct())


def _stars(now: DataFrame, work: Workspace) -> DataFrame:
    before = _mark(now)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = work.keep(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("v", "u")).alias("u"), F.col("m").alias("v"))
        then = work.keep(small.where("u <> v").distinct(), "small")
        work.drop(now, large)
        now, after = then, _mark(then)
        if after == before:
            return now
        before = after


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first())

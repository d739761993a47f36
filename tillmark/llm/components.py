"""Connected components of a link table: forests of bounded chunks of links, then alternating large and small stars
(Kiveris et al., 2014)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.session import materialize

CHUNK = 100_000  # links that are contracted at once, and so the most that one task settles alone


def forest(links: Iterator[tuple]) -> dict:
    """The root, the least node of its component, of every node of ``links``."""
    parent: dict = {}

    def root(node):
        while (above := parent.setdefault(node, node)) != node:
            parent[node] = parent[above]
            node = above
        return node

    for pair in links:
        low, high = sorted(map(root, pair))
        parent[high] = low
    return {node: root(node) for node in parent}


def _contracted(edges: DataFrame) -> DataFrame:
    """Each task's links, ``CHUNK`` at a time, as links of nodes to the least node of their component in the chunk."""
    most = CHUNK

    def stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        for batch in batches:
            held += zip(batch["b"].tolist(), batch["a"].tolist(), strict=True)
            while len(held) > most:
                yield _star(held[:most])
                held = held[most:]
        if held:
            yield _star(held)

    return edges.mapInPandas(stars, edges.schema)


def _star(links: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame([(node, root) for node, root in forest(links).items() if node != root], columns=["b", "a"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node's neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select("b", F.col("m").alias("a")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, is linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("b"), F.col("m").alias("a"))
    return moved.unionByName(least.select(F.col("u").alias("b"), F.col("m").alias("a"))).where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the least node of the component.

    Chunks of links are contracted first, each to one link a node; up to ``CHUNK`` links are settled by that. Of more, the
    chunks' stars go through rounds of joins. Each round is written to the shared folder; hot nodes are reduced by partial
    sums and their joins can be split. The number of rounds grows with the logarithm of the number of nodes.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a")).where("a != b"), "links")
    few = edges.count() <= CHUNK
    edges = materialize(_contracted(edges.coalesce(1) if few else edges), "forest")
    seen = None
    while not few:
        edges = materialize(_small_star(_large_star(edges)), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())

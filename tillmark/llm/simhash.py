"""SimHash near-duplicates by pigeonhole blocks.

A text's words are its runs of other characters than blank, tab and line breaks, A to Z in lower case. Each run of
four words (a shorter text has one, all its words) is hashed by XXH64 with seed 42; a bit of the fingerprint is set if
it is set in over half of the hashes. Two texts are linked when their fingerprints differ in at most ``most`` bits, and
their component is everything reachable over links.

1. One pass over the texts gives the fingerprints. Equal ones are one node, so a group of copies is one row from here.
2. Pigeonhole: the 64 bits are cut into ``blocks`` blocks. ``most`` differing bits lie in at most ``most`` blocks, so a
   close pair agrees in some choice of ``blocks - most`` whole blocks. Every choice is a table of buckets; nodes join on
   (choice, bits of its blocks) and the join itself verifies the Hamming distance, so only links come out of it. The
   number of blocks follows from the number of nodes: a bucket of unlike texts holds about 1/4 node.
3. A bucket of more than ``whole`` nodes (a passage that many texts share) is not compared pair by pair, so a node
   meets at most ``whole`` others per choice. All nodes of such buckets are spread over the points within half the
   distance, ``most // 2`` bits: a close pair has such a point in common, and nodes that share one are close, so each
   point links its nodes in a chain. That is exact too, and its rows grow in proportion to these nodes.
4. Links become components by star contraction.

Null texts are empty; a text without words has fingerprint zero, linked like any other. Texts are read whole, of any
length, in parts of bounded size. Rows with a null id have a component, but never name one; if nobody else is in it, its
name is null. Repeated rows are in one component. An empty table gives an empty result. Columns other than the id and
the text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import log2

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.components import components
from tillmark.llm.order_minhash import bounded_batches
from tillmark.session import materialize

BITS = 64
SEED = 42
PART = 1 << 16  # hashes that are counted at once
GAP = np.zeros(256, dtype=bool)
GAP[[0x20, *range(0x09, 0x0E)]] = True


def fingerprint(text: str | None, size: int = 4) -> int:
    """The SimHash of the runs of ``size`` words, as a signed number of 64 bits."""
    raw = np.frombuffer((text or "").encode().lower(), dtype=np.uint8)  # bytes: only A to Z are lower-cased
    gap = GAP[raw]
    keep = ~gap
    keep[1:] |= gap[1:] & ~gap[:-1]
    plain = np.where(gap, np.uint8(0x20), raw)[keep]
    if len(plain) and plain[-1] == 0x20:
        plain = plain[:-1]
    if not len(plain):
        return 0
    blanks = np.flatnonzero(plain == 0x20)
    starts, ends = np.concatenate([[0], blanks + 1]), np.concatenate([blanks, [len(plain)]])
    runs = max(1, len(starts) - size + 1)
    starts, ends, joined, digest = starts[:runs], ends[-runs:], plain.tobytes(), xxhash.xxh64_intdigest
    ones = np.zeros(BITS, dtype=np.int64)
    for low in range(0, runs, PART):
        places = zip(starts[low:low + PART].tolist(), ends[low:low + PART].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in places), dtype="<u8", count=min(PART, runs - low))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > runs, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4) -> DataFrame:
    """doc_id and fingerprint (a long) of every row of ``docs``."""
    @F.pandas_udf("long")
    def printed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, size) for t in texts], dtype="int64")

    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), printed(F.col(f"`{text_col}`")).alias("fingerprint"))


def blocks_for(nodes: int, most: int) -> int:
    """The least number of blocks of which ``blocks - most`` hold two bits more than it takes to number the nodes."""
    needed = min(log2(max(nodes, 1)) + 2, BITS / 2)
    return next(b for b in range(most + 1, BITS + 1) if (b - most) * BITS / b >= needed)


def masks(blocks: int, most: int) -> list[int]:
    """The bits of each choice of ``blocks - most`` blocks, as signed numbers."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    held = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    return [_signed(sum(chosen)) for chosen in combinations(held, blocks - most)]


def flips(reach: int) -> list[int]:
    """All patterns of at most ``reach`` bits, as signed numbers."""
    return [_signed(sum(1 << i for i in chosen)) for n in range(reach + 1) for chosen in combinations(range(BITS), n)]


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def _by_midpoints(nodes: DataFrame, most: int) -> DataFrame:
    """Links (a, b) that join all of ``nodes`` (node) closer than ``most``; ``most`` is even.

    The nodes of a point lie within ``most // 2`` bits of it, so a point has a bounded number of them whatever the data:
    2,081 for ``most`` = 4.
    """
    spread = nodes.select("node", F.explode(F.lit(flips(most // 2)).cast("array<bigint>")).alias("flip"))
    return spread.groupBy(F.expr("node ^ flip").alias("point")).agg(F.collect_list("node").alias("near")).where(
        "size(near) > 1").select(F.array_min("near").alias("a"), F.explode("near").alias("b")).where("a != b").distinct()


def close_links(nodes: DataFrame, most: int = 4, whole: int = 4096, blocks: int | None = None) -> DataFrame:
    """Links (a, b) between ``nodes`` (column ``node``, distinct, a written table), enough for their components:

    every link, but for pairs that only meet in buckets of more than ``whole`` nodes; these are joined over others.
    """
    if most % 2:
        raise ValueError(f"the distance must be even, not {most}")
    chosen = masks(blocks or blocks_for(nodes.count(), most), most)
    choices = F.array(*(F.struct(F.lit(i).alias("choice"), F.col("node").bitwiseAND(F.lit(m)).alias("bits"))
                        for i, m in enumerate(chosen)))
    spread = nodes.select("node", F.inline(choices))
    sizes = materialize(spread.groupBy("choice", "bits").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    shared = materialize(spread.join(sizes, ["choice", "bits"]), "shared")
    members = shared.where(F.col("size") <= whole)
    left = members.select("choice", "bits", F.col("node").alias("a"))
    right = members.select("choice", "bits", F.col("node").alias("b"))
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most)
    links = left.join(right, (left["choice"] == right["choice"]) & (left["bits"] == right["bits"]) & close).select("a", "b")
    large = shared.where(F.col("size") > whole).select("node").distinct()
    return links.unionByName(_by_midpoints(large, most))


def near_duplicate_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 4,
                              size: int = 4, whole: int = 4096, blocks: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (a long) and component_id, the least id that is reachable."""
    with bounded_batches(docs.sparkSession):
        rows = materialize(fingerprints(docs, id_col, text_col, size), "fingerprints")
    nodes = materialize(rows.groupBy(F.col("fingerprint").alias("node")).agg(F.min("doc_id").alias("least_id")), "nodes")
    links = materialize(close_links(nodes.select("node"), most, whole, blocks), "close")
    rooted = nodes.join(components(links), "node", "left").select("node", "least_id", F.coalesce("root", "node").alias("root"))
    rooted = materialize(rooted, "rooted")
    least = materialize(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "least")
    named = materialize(rooted.join(least, "root").select(F.col("node").alias("fingerprint"), "component_id"), "named")
    return rows.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")

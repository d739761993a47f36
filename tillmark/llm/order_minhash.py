"""Near-duplicate classes by Order MinHash (Marcais et al., 2019) with verification by banded alignment.

Words are runs of word characters in lower case. Two texts are linked when an alignment of their words needs edits for
at most 1 - ``threshold`` of the longer text: the edit similarity decides, nothing else does. Classes are the components
of the links.

1. One pass over the texts: the k-mers are five-word shingles labelled with their occurrence number; each sketch takes
   the ``picked`` ones of least hash and keeps them in text order. Texts that share such an ordered tuple meet in a
   bucket.
2. Identical texts count as one node, known by the MD5 of the text.
3. Buckets of at most ``whole`` nodes are compared in full, at most (``whole`` - 1) / 2 pairs a node. In larger ones
   every member is first compared with one leader: the member whose buckets hold the most nodes, so that copies made
   from one original meet the original. Pairs whose lengths, or whose shared runs of three words, rule out the
   similarity are not aligned: e edits leave all but 3 e of the runs of three words untouched, and all but e words.
   Words that both texts begin or end with are left out of the alignment.
4. Links become classes by contraction, of bounded chunks and then by stars. A bucket whose members are all in one class is done: no further link in
   it could change a class.
5. The other large buckets are compared in full, matched members included: cut into cells of like length and bounded
   size, one task takes two cells, counts the shared runs of all pairs by postings and aligns the pairs that share
   enough and are not in one class, each pair in the first of its common buckets only; cells of one and the same class
   do not meet. So there are two rounds, whatever the size of a group, and no cap; the pairs counted in step 5 grow
   with the square of those members of a bucket that are in no large class by step 3.

Texts of one to four words have one shingle, all their words. Texts without any word are linked to identical texts
only; null counts as empty. Rows with a null id are in a class like others but always stay. Rows that repeat an id
and a text get the same class, and ``drop_near_copies`` keeps one of them. An empty table gives an empty result.

The sketch is a random method. With a share c of the words replaced, independently, two texts share a share
j = s / (2 - s), s = (1 - c)^5, of their shingles and meet in a bucket with probability 1 - (1 - j^3)^32: above 0.9999
for c = 0.05, 0.91 for c = 0.1 and 0.22 for c = 0.2.
"""

from __future__ import annotations

import re
import sys
from collections import Counter, OrderedDict
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillmark.llm.components import components
from tillmark.session import materialize

SHINGLE = 5
WORD = re.compile(r"\w+")
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
CHUNK_CHARS = 2_000_000
BATCH_BYTES = 8 << 20  # of texts that a Python worker gets at once
FEW_PAIRS = 20_000  # at most 40,000 digests of 16 bytes are broadcast
CELL_NODES = 256  # nodes in a cell of a large bucket, on average
CELL_WORDS = 250_000  # and words, on average
RUN = 3  # words in the runs that are counted before an alignment
KNOWN_WORDS = 1_000_000  # words of the texts whose hashes a worker keeps, at about 40 bytes
FIRST_BAND = 8  # edits that the first, narrowest alignment allows


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """Steps written inside send texts to Python in batches of at most about ``BATCH_BYTES``."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def word_hashes(words: list[str], many: bool = True) -> np.ndarray:
    """The words' hashes; ``many`` is for lists of thousands, in which most words come again."""
    return pd.util.hash_array(np.array(words, dtype=object), categorize=many) if words else np.zeros(0, dtype=np.uint64)


def shingle_hashes(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """One hash per run of ``size`` words; of fewer words, one for all of them."""
    n = len(hashes)
    if n == 0:
        return hashes
    if n < size:
        hashes = np.concatenate([hashes, np.arange(1, size - n + 1, dtype=np.uint64)])
        n = size
    total = np.zeros(n - size + 1, dtype=np.uint64)
    for k in range(size):
        total = mix(total * GOLDEN + hashes[k:n - size + 1 + k])
    return total


def labelled(shingles: np.ndarray) -> np.ndarray:
    """Shingle hashes mixed with the number of earlier occurrences of the same shingle."""
    order = np.argsort(shingles, kind="stable")
    ranked = shingles[order]
    fresh = np.ones(len(ranked), dtype=bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    if fresh.all():
        return shingles
    at = np.arange(len(ranked))
    number = np.empty(len(ranked), dtype=np.uint64)
    number[order] = (at - np.maximum.accumulate(np.where(fresh, at, 0))).astype(np.uint64)
    return np.where(number == 0, shingles, mix(shingles + number * GOLDEN))


def order_sketch(shingles: np.ndarray, seeds: np.ndarray, picked: int) -> np.ndarray:
    """Per seed: a key of the ``picked`` least shingles, in text order. The shingles are well mixed hashes, so the order
    of their products with an odd number serves as a hash function of its own."""
    count = min(picked, len(shingles))
    places = np.empty((len(seeds), count), dtype=np.int64)
    products = np.empty(len(shingles), dtype=np.uint64)
    for row, seed in enumerate(seeds):
        np.multiply(shingles, seed, out=products)
        for k in range(count):
            places[row, k] = least = int(products.argmin())
            products[least] = np.uint64(0xFFFFFFFFFFFFFFFF)
    places.sort(axis=1)
    chosen = shingles[places]
    keys = seeds.copy()
    for k in range(count):
        keys = mix(keys * GOLDEN + chosen[:, k])
    return keys.view(np.int64)


def chunks(sizes: list[int], most: int = CHUNK_CHARS) -> Iterator[slice]:
    """Slices of a batch with about ``most`` characters each, at least one row."""
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield slice(start, i)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def edits_within(a: list, b: list, limit: int, least: int = 0) -> bool:
    """Whether at most ``limit`` edits turn a into b, known to need ``least``: bands of growing width, so that close texts
    are aligned fast."""
    band = limit if 2 * least > limit else min(max(FIRST_BAND, least), limit)
    while True:
        if abs(len(a) - len(b)) <= band and banded_distance(a, b, band) <= band:
            return True
        if band == limit:
            return False
        band = min(4 * band, limit)


def banded_distance(a: list, b: list, band: int) -> int:
    """The edit distance of a and b if it is at most ``band``, else more than ``band``; lengths differ by ``band`` at most.

    A column of the distance table is kept as the bits of its vertical steps, for the rows within ``band`` of the
    diagonal only (Hyyro's bit vectors); the band moves down a row with each column. The distance is followed along
    the lower edge of the band to the last row of a, and then along that row.
    """
    n, m = len(a), len(b)
    width = 2 * band + 1
    full, top = (1 << width) - 1, 1 << (2 * band)
    plus, minus = full ^ ((1 << band) - 1), 0
    distance, hopeless = min(band, n), 2 * band + m - n
    masks: dict[object, int] = {}
    low = high = 0  # rows of a whose bits are in the masks: low <= row < high, bit row - low
    for column in range(1, m + 1):
        first = column - 1 - band  # row of a that is the band's lowest bit
        if column + band > high and high < n:  # masks for the rows that the band passes over next
            low, high = max(0, first), min(n, max(0, first) + 2 * width)
            masks = {}
            for row in range(low, high):
                masks[a[row]] = masks.get(a[row], 0) | 1 << (row - low)
        shift = first - low
        held = masks.get(b[column - 1], 0)
        eq = (held >> shift if shift >= 0 else held << -shift) & full
        diagonal = ((((eq & plus) + plus) ^ plus) | eq | minus) & full
        up = (minus | ~(diagonal | plus)) & full
        down = diagonal & plus
        if column + band <= n:
            distance += not diagonal & top
            if distance > hopeless:
                break
        else:
            bit = 1 << (n - column + band)
            distance += bool(up & bit) - bool(down & bit)
        plus = (down | ~(diagonal >> 1 | up)) & full
        minus = (diagonal >> 1) & up
    return distance


def near_copies(a: list[str], b: list[str], threshold: float) -> bool:
    """The definition of a link, see above."""
    longest = max(len(a), len(b))
    edits = int((1 - threshold) * longest + 1e-9)
    if not a or not b or abs(len(a) - len(b)) > edits:
        return False
    a, b = trimmed(a, b)
    longest = max(len(a), len(b))
    if longest <= edits or not a or not b:
        return True
    least = max(-((shared_runs(a, b, size) - longest + size - 1) // size) for size in (1, RUN))
    return least <= edits and edits_within(a, b, edits, least)


def trimmed(a: list[str], b: list[str]) -> tuple[list[str], list[str]]:
    """What is left of two texts without the words they begin and end with alike; it needs the same edits."""
    most = min(len(a), len(b))
    start = next((k for k in range(most) if a[k] != b[k]), most)
    end = next((k for k in range(most - start) if a[-1 - k] != b[-1 - k]), most - start)
    return a[start:len(a) - end], b[start:len(b) - end]


def shared_runs(a: list[str], b: list[str], size: int = RUN) -> int:
    """Runs of ``size`` words that both texts hold, repetitions included."""
    first, second = (Counter(zip(*(words[i:] for i in range(size)), strict=False)) for words in (a, b))
    if len(second) < len(first):
        first, second = second, first
    return sum(min(n, second[run]) for run, n in first.items() if run in second)


def sketch_rows(docs: DataFrame, id_col: str, text_col: str, sketches: int, picked: int) -> DataFrame:
    """doc_id, digest, keys and number of words of every row; no keys where a text has no word."""
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    seeds = mix(np.arange(1, sketches + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)

    @F.pandas_udf("keys array<long>, n int")
    def sketched(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            keys, counts = [], []
            for part in chunks([len(t) for t in texts]):
                words = [words_of(t) for t in texts.iloc[part]]
                hashes = word_hashes([w for ws in words for w in ws])
                counts += [len(ws) for ws in words]
                ends = np.cumsum([len(ws) for ws in words])
                for start, end in zip([0, *ends[:-1]], ends, strict=True):
                    keys.append(order_sketch(labelled(shingle_hashes(hashes[start:end])), seeds, picked) if end > start else [])
            yield pd.DataFrame({"keys": keys, "n": counts})

    return base.select("doc_id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"),
                       sketched("text").alias("s")).select("doc_id", "digest", "s.*")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """``pairs`` (leader, digest), a written table, with ``linked``.

    Only the texts of the pairs travel: a short list of digests is sent to the scan of the texts.
    """
    needed = pairs.select("digest").unionByName(pairs.select(F.col("leader").alias("digest"))).distinct()
    if pairs.count() <= FEW_PAIRS:
        texts = texts.join(F.broadcast(needed), "digest", "left_semi")
    first = texts.select(F.col("digest").alias("leader"), F.col("text").alias("a"))
    second = texts.select("digest", F.col("text").alias("b"))

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([near_copies(words_of(x), words_of(y), threshold) for x, y in zip(a, b, strict=True)], dtype=bool)

    return pairs.join(first, "leader").join(second, "digest").select("leader", "digest", linked("a", "b").alias("linked"))


def _led(members: DataFrame) -> DataFrame:
    """(key, leader, leader_n) of each bucket of ``members`` (key, digest, n, size): the member whose buckets are the
    largest altogether. One row per member goes in and comes out; the leader is a first try, so a tie may go any way."""
    score = F.sum("size").over(Window.partitionBy("digest"))  # a node has a bucket per sketch at most
    rank = F.struct("score", F.xxhash64("digest").alias("tie"), "digest", "n")
    return members.withColumn("score", score).groupBy("key").agg(F.max(rank).alias("first")).select(
        "key", F.col("first.digest").alias("leader"), F.col("first.n").alias("leader_n"))


def _unsettled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, digest, n, own) of the buckets that hold nodes of several classes; ``own`` is the class."""
    own = roots.select(F.col("node").alias("digest"), F.col("root").alias("own"))
    classed = members.join(own, "digest", "left").select("key", "digest", "n", F.coalesce("own", "digest").alias("own"))
    mixed = classed.groupBy("key").agg(F.min("own").alias("low"), F.max("own").alias("high")).where("low < high")
    return classed.join(mixed.select("key"), "key", "left_semi")


def coded(lists: Sequence[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """The values of the lists as numbers from 0, and how many there are."""
    values, codes = np.unique(np.concatenate(lists), return_inverse=True)
    return np.split(codes, np.cumsum([len(one) for one in lists])[:-1]), len(values)


class Terms:
    """Words, runs of words and bag of words of texts, as hashes. The last texts are kept, up to ``KNOWN_WORDS`` words,
    since a node comes back in other cells."""

    def __init__(self) -> None:
        self.known: OrderedDict[str, tuple[list[str], np.ndarray, np.ndarray]] = OrderedDict()
        self.words = 0

    def of(self, text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
        if text in self.known:
            self.known.move_to_end(text)
            return self.known[text]
        words = [sys.intern(w) for w in words_of(text)]
        hashes = word_hashes(words, many=False)
        found = words, np.unique(labelled(shingle_hashes(hashes, RUN))), np.unique(labelled(mix(hashes)))
        if len(words) <= KNOWN_WORDS // 8:
            self.known[text] = found
            self.words += len(words) + 1
            while self.words > KNOWN_WORDS:
                self.words -= len(self.known.popitem(last=False)[1][0]) + 1
        return found


_terms = Terms()  # of a Python worker
NO_TERMS: tuple[list[str], np.ndarray, np.ndarray] = [], np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)


def links_between(rows: pd.DataFrame, threshold: float) -> list[tuple[bytes, bytes]]:
    """Links that join the classes of two cells; ``rows`` has digest, own, text, earlier, and side (0, 1; one cell by
    itself has 0).

    Pairs of one class are passed over, also of a class that a link found before has joined, and so are pairs that share
    an ``earlier`` bucket: they are compared there. Only texts with pairs left are split into words. An edit takes at most one word and ``RUN`` runs of words from those
    that two texts share, so pairs that share too few of either are not aligned.
    """
    buckets, kept = coded([np.asarray(e, dtype=np.int64) for e in rows["earlier"]])
    held = np.zeros((kept, len(rows)), dtype=bool)
    held[np.concatenate(buckets), np.repeat(np.arange(len(rows)), [len(b) for b in buckets])] = True
    side, digests = rows["side"].to_numpy(), [bytes(d) for d in rows["digest"]]
    names: dict[bytes, int] = {}
    own = np.array([names.setdefault(bytes(c), len(names)) for c in rows["own"]])
    first = np.flatnonzero(side == 0)
    todo = np.zeros((len(rows), len(rows)), dtype=bool)  # each pair once, from the row of its first node
    for i in first:
        todo[i] = (side == 1 if side.max() else np.arange(len(rows)) > i) & (own != own[i]) & ~held[buckets[i]].any(axis=0)
    second = todo.any(axis=0)
    texts, sets, bags = zip(*(_terms.of(t) if wanted else NO_TERMS for t, wanted in zip(
        rows["text"], second | todo.any(axis=1), strict=True)), strict=True)
    bags, kinds = coded(bags)
    marked = np.zeros(kinds, dtype=bool)
    sizes, lengths = np.array([len(s) for s in sets]), np.array([len(ws) for ws in texts])
    posted = np.concatenate([s if wanted else s[:0] for s, wanted in zip(sets, second, strict=True)])
    holder = np.repeat(np.arange(len(rows)), np.where(second, sizes, 0))
    order = np.argsort(posted, kind="stable")
    posted, holder = posted[order], holder[order]
    links = []
    for i in first:
        longest = np.maximum(lengths, lengths[i])
        edits = np.floor((1 - threshold) * longest + 1e-9)
        alike = todo[i] & (np.abs(lengths - lengths[i]) <= edits) & (own != own[i])
        if not alike.any():
            continue
        low, high = np.searchsorted(posted, sets[i], "left"), np.searchsorted(posted, sets[i], "right")
        counts = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        shared = np.bincount(holder[at], minlength=len(rows))
        alike &= shared >= longest - RUN + 1 - RUN * edits
        marked[bags[i]] = True
        close = [j for j in np.flatnonzero(alike) if np.count_nonzero(marked[bags[j]]) >= longest[j] - edits[j]]
        marked[bags[i]] = False
        for j in close:
            if own[i] != own[j] and near_copies(texts[i], texts[j], threshold):
                links.append((digests[i], digests[j]))
                own[own == own[j]] = own[i]
    return links


def _compared(members: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that join the classes within each bucket; ``members`` is (key, digest, n, own), a written table.

    Nodes in classes of length next to each other only can be linked: the ratio of their numbers of words is
    at least ``threshold`` else they are two classes apart. The nodes of a large class have cells of their own, which
    do not meet each other: of a group of copies with a few strays, only the strays meet the rest. Two nodes are
    compared in the least of the buckets that they share, so each row names the lesser buckets of its node.
    """
    reach = F.floor(F.log(F.col("n").cast("double")) / F.lit(-np.log(threshold * (1 - 1e-9)))).cast("int")
    everywhere = members.groupBy("digest").agg(F.collect_set("key").alias("keys"))  # a bucket per sketch at most
    sized = members.withColumn("span", reach)
    kinds = sized.groupBy("key", "span", "own").agg(F.count("*").alias("nodes"), F.sum("n").alias("words")).withColumn(
        "kin", F.when(F.col("nodes") >= CELL_NODES // 8, F.col("own")).otherwise(F.lit(b"")))
    parts = materialize(kinds.groupBy("key", "span", "kin").agg(
        F.ceil(F.greatest(F.sum("nodes") / CELL_NODES, F.sum("words") / CELL_WORDS)).cast("int").alias("parts")), "parts")
    # a row per large class, and one for all others, of a bucket's span; at most 8 / CELL_NODES as many as nodes
    named = parts.where(F.col("kin") != F.lit(b"")).select("key", "span", F.col("kin").alias("own"), "kin")
    held = sized.join(named, ["key", "span", "own"], "left").withColumn("kin", F.coalesce("kin", F.lit(b"")))
    placed = materialize(held.join(parts, ["key", "span", "kin"]).select(
        "key", "span", F.struct("kin", F.pmod(F.xxhash64("digest"), "parts").cast("int").alias("part")).alias("part"),
        "digest", "own").join(everywhere, "digest").withColumn("earlier", F.filter("keys", lambda k: k < F.col("key"))).drop("keys"),
        "cells")
    cells = placed.groupBy("key", "span", "part").agg(F.min("own").alias("low"), F.max("own").alias("high"))
    left = cells.select("key", *(F.col(c).alias(f"{c}_a") for c in ("span", "part", "low", "high")))
    right = cells.select("key", *(F.col(c).alias(f"{c}_b") for c in ("span", "part", "low", "high")))
    met = materialize(left.join(right, "key").where(
        "((span_a = span_b AND part_a <= part_b) OR span_a + 1 = span_b) AND least(low_a, low_b) < greatest(high_a, high_b)"
    ).select("key", "span_a", "part_a", "span_b", "part_b"), "met")
    pair = ["key", "span_a", "part_a", "span_b", "part_b"]
    sides = [met.withColumns({"span": F.col(f"span_{c}"), "part": F.col(f"part_{c}"), "side": F.lit(i)}) for i, c in enumerate("ab")]
    sides[1] = sides[1].where("span_a != span_b OR part_a != part_b")
    sent = sides[0].unionByName(sides[1]).join(placed, ["key", "span", "part"]).join(texts, "digest").select(
        *pair, "side", "digest", "own", "earlier", "text")

    def linked(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(links_between(rows, threshold), columns=["a", "b"])

    return sent.groupBy(*pair).applyInPandas(linked, "a binary, b binary")


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
                           sketches: int = 32, picked: int = 3, whole: int = 12) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (least id of the class), class_size, kept."""
    return _judged(_classed(docs, id_col, text_col, threshold, sketches, picked, whole)).drop("digest")


def _judged(classed: DataFrame) -> DataFrame:
    """doc_id, digest, class_id, class_size, kept: of each class the least id stays, of its texts the least digest."""
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "digest")))
    sizes = classed.groupBy("class").agg(least.alias("least"), F.count("*").alias("class_size"))
    first = (F.col("doc_id") == F.col("least.doc_id")) & (F.col("digest") == F.col("least.digest"))
    return classed.join(sizes, "class").select(
        "doc_id", "digest", F.col("least.doc_id").alias("class_id"), "class_size",
        (F.col("doc_id").isNull() | first).alias("kept"))


def _classed(docs: DataFrame, id_col: str, text_col: str, threshold: float,
             sketches: int = 32, picked: int = 3, whole: int = 12) -> DataFrame:
    """doc_id, digest and class, a node's digest, of every row."""
    with bounded_batches(docs.sparkSession):
        rows = materialize(sketch_rows(docs, id_col, text_col, sketches, picked), "sketches")
    nodes = materialize(rows.where(F.size("keys") > 0).drop("doc_id").dropDuplicates(["digest"]), "nodes")
    keyed = rows.select("doc_id", "digest")
    members = nodes.select("digest", "n", F.explode("keys").alias("key"))
    buckets = members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    pending = materialize(members.join(buckets, "key"), "pending")
    if pending.isEmpty():
        return keyed.withColumn("class", F.col("digest"))
    held = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    texts = materialize(  # of all nodes that can be compared
        held.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
        .join(pending.select("digest").distinct(), "digest", "left_semi").dropDuplicates(["digest"]), "texts")
    small = pending.where(F.col("size") <= whole).select("key", "digest", "n")
    large = materialize(pending.where(F.col("size") > whole), "large")
    first = small.select("key", F.col("digest").alias("leader"), F.col("n").alias("leader_n"))
    pairs = first.join(small, "key").where("leader < digest")
    some = not large.isEmpty()
    if some:
        pairs = pairs.unionByName(large.drop("size").join(materialize(_led(large), "led"), "key").where("leader != digest"))
    alike = F.least("n", "leader_n") >= threshold * F.greatest("n", "leader_n")
    pairs = pairs.where(alike).select(
        F.least("leader", "digest").alias("leader"), F.greatest("leader", "digest").alias("digest")).distinct()
    with bounded_batches(docs.sparkSession):
        judged = materialize(_verified(materialize(pairs, "pairs"), texts, threshold), "judged")
    roots = components(judged.where("linked").select(F.col("leader").alias("a"), F.col("digest").alias("b")))
    left = materialize(_unsettled(large.drop("size"), roots), "unsettled") if some else None
    if some and not left.isEmpty():
        with bounded_batches(docs.sparkSession):
            links = materialize(_compared(left, texts, threshold), "found")
        roots = components(links.unionByName(roots.select(F.col("root").alias("a"), F.col("node").alias("b"))))
    named = roots.select(F.col("node").alias("digest"), "root")
    return keyed.join(named, "digest", "left").select("doc_id", "digest", F.coalesce("root", "digest").alias("class"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: one of each class, with the least id, and those with a null id.

    Rows go by id and text. Of rows that share both one stays, the least by a hash of all columns.
    """
    judged = materialize(_judged(_classed(docs, id_col, text_col, threshold)), "classes").where("doc_id IS NOT NULL")
    going = judged.where("NOT kept").select("doc_id", "digest").distinct()
    shared = materialize(judged.where("kept").groupBy("doc_id", "digest").count().where("count > 1"), "shared").drop("count")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    named = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{id_col}`").alias("doc_id"),
                        F.unhex(F.md5(text.cast("binary"))).alias("digest"))
    kept = named.join(materialize(going, "going"), ["doc_id", "digest"], "left_anti")
    if not shared.isEmpty():
        one = kept.join(shared, ["doc_id", "digest"], "left_semi").groupBy("doc_id", "digest").agg(
            F.min_by("row", F.xxhash64("row")).alias("row"))
        kept = kept.join(shared, ["doc_id", "digest"], "left_anti").select("row").unionByName(one.select("row"))
    return kept.select("row.*")

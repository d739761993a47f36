"""Ranked lexical search by scanning the documents with an Aho-Corasick automaton of all query terms.

Terms are runs of digits, letters and characters beyond ASCII, A to Z in lower case. There is no index of the
documents: their texts are scanned, every other character as one blank, and the automaton holds each query term between
two guard blanks, so that a hit is a whole term; neighbouring terms share a guard, since hits may overlap.

1. The items (a stated query set) are read in blocks of bounded size, and each block's automaton is broadcast. A first
   scan counts documents with terms, all terms, and for each query term the documents that hold it.
2. Weights follow from these counts. A second scan counts the occurrences in a document, and the automaton's outputs
   lead from a term to the items that hold it. A task keeps the ``top`` documents of each item and nothing else.
3. The tasks' lists are ranked in two steps, by item and a share of the tasks and then by item, so that no task ranks
   the lists of all of them.

The score of a document for an item sums w * ((1000000000 * tf) div (1000 * tf + 20 * m)) over the item's distinct
terms; w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))), m = 100 - 50 + ((50 * n * N) div L), where N documents have
L terms, n are the document's own and tf of them are the term. All but the logarithm is in whole numbers.

Null and empty texts have no terms; an item without terms, or with null text, finds nothing. Texts are scanned whole, in
parts that end between terms. Equal scores go by ascending id, null ids last; rows that repeat an id count as documents
of their own. Repeated items each give their own rows. Empty tables give an empty result. Columns other than the ids and
the texts are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmark.llm.order_minhash import bounded_batches
from tillmark.session import materialize

TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if chr(c).isalnum() or c >= 0x80 else 0x20 for c in range(256))
PART = 1 << 20  # bytes of a text that are scanned at once
CELLS = 1 << 20  # scores that a task holds before it keeps the best


def plain_bytes(text: str | None) -> bytes:
    """The text in UTF-8 with A to Z in lower case and a blank for every character outside terms."""
    return (text or "").encode().translate(TABLE)


def terms_of(text: str | None) -> list[str]:
    return plain_bytes(text).decode().split(" ")


@dataclass
class Block:
    """Items of one block: their ids, the terms, and which items hold a term (postings[start[t]:start[t + 1]])."""

    ids: list[object]
    terms: list[str]
    starts: np.ndarray
    postings: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[object, str]]) -> Block:
        numbers: dict[str, int] = {}
        held = sorted({(numbers.setdefault(t, len(numbers)), no) for no, (_, text) in enumerate(items) for t in terms_of(text) if t})
        counts = np.bincount([t for t, _ in held], minlength=len(numbers)) if held else np.zeros(0, dtype=np.int64)
        return cls([i for i, _ in items], list(numbers), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64),
                   np.array([no for _, no in held], dtype=np.int64))

    def automaton(self) -> ahocorasick.Automaton:
        built = ahocorasick.Automaton()
        for no, term in enumerate(self.terms):
            built.add_word(f" {term} ", no)
        if self.terms:
            built.make_automaton()
        return built


def count_terms(automaton: ahocorasick.Automaton, text: str | None) -> tuple[int, Counter]:
    """The number of terms of the text, and the occurrences of the automaton's terms by number."""
    plain, found, size, low = plain_bytes(text), Counter(), 0, 0
    while low < len(plain):
        high = low + PART
        if high < len(plain):  # go on to the end of the term that is cut
            high = plain.find(b" ", high)
            high = len(plain) if high < 0 else high
        part = plain[low:high]
        size += len(part.split())
        if len(automaton):
            found.update([no for _, no in automaton.iter(f" {part.decode()} ")])
        low = high
    return size, found


def _blocks(items: DataFrame, block_chars: int) -> Iterator[Block]:
    texts = items.select("item_id", "text").where("text IS NOT NULL")
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    count = 1 + chars // block_chars
    dealt = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for no in range(count):
        rows = texts.where(dealt == no).collect()  # bounded by block_chars
        yield Block.of(sorted(((r["item_id"], r["text"]) for r in rows), key=str))


def _statistics(texts: DataFrame, block: Block) -> tuple[int, int, dict[int, int]]:
    """Documents with terms, all terms, and documents by term number."""
    held = texts.sparkSession.sparkContext.broadcast(block)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton, docs, total, df = held.value.automaton(), 0, 0, Counter()
        for batch in batches:
            for text in batch["text"]:
                size, found = count_terms(automaton, text)
                docs, total = docs + (size > 0), total + size
                df.update(found.keys())
        yield pd.DataFrame({"term": [-2, -1, *df.keys()], "n": [total, docs, *df.values()]})

    rows = texts.select("text").mapInPandas(counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = {r["term"]: r["n"] for r in rows}  # a row per term of the block
    return counts.pop(-1, 0), counts.pop(-2, 0), counts


def weights(block: Block, docs: int, df: dict[int, int]) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(block.terms))],
                    dtype=np.int64)


class Scorer:
    """Keeps the best documents of each item of a block over the texts it is given."""

    def __init__(self, block: Block, weight: np.ndarray, docs: int, total: int, top: int):
        self.block, self.weight, self.docs, self.total, self.top = block, weight, docs, total, top
        self.automaton = block.automaton()
        self.most = max(1, CELLS // max(1, len(block.ids)))
        self.ids, self.rows = [], []
        self.item = self.score = self.seat = np.zeros(0, dtype=np.int64)
        self.floor = np.ones(len(block.ids), dtype=np.int64)  # least score that is still of use

    def row(self, text: str | None) -> np.ndarray | None:
        """The text's score for every item."""
        size, found = count_terms(self.automaton, text)
        if not found:
            return None
        m = 50 + 50 * size * self.docs // self.total
        terms = np.fromiter(found.keys(), dtype=np.int64, count=len(found))
        tf = np.fromiter(found.values(), dtype=np.int64, count=len(found))
        parts = self.weight[terms] * (1_000_000_000 * tf // (1000 * tf + 20 * m))
        starts, sizes = self.block.starts[terms], self.block.starts[terms + 1] - self.block.starts[terms]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
        scores = np.zeros(len(self.block.ids), dtype=np.int64)
        np.add.at(scores, self.block.postings[places], np.repeat(parts, sizes))
        return scores

    def add(self, key: object, text: str | None) -> None:
        scores = self.row(text)
        if scores is None:
            return
        self.rows.append(scores)
        self.ids.append(key)
        if len(self.rows) >= self.most:
            self.settle()

    def settle(self) -> None:
        """Only the best ``top`` of each item stay, equal scores by ascending id."""
        if not self.rows:
            return
        table = np.stack(self.rows)
        seat, item = np.nonzero(table >= self.floor)
        old = len(self.ids) - len(self.rows)
        items = np.concatenate([self.item, item])
        scores = np.concatenate([self.score, table[seat, item]])
        seats = np.concatenate([self.seat, seat + old])
        keys = np.array([math.inf if k is None else k for k in self.ids], dtype=object)
        place = np.empty(len(keys), dtype=np.int64)
        place[np.argsort(keys, kind="stable")] = np.arange(len(keys))
        order = np.lexsort((place[seats], -scores, items))
        items, scores, seats = items[order], scores[order], seats[order]
        rank = np.arange(len(items)) - np.searchsorted(items, items, "left")
        stay = rank < self.top
        self.item, self.score, seats, rank = items[stay], scores[stay], seats[stay], rank[stay]
        last = rank == self.top - 1
        self.floor[self.item[last]] = np.maximum(self.score[last], 1)
        used, self.seat = np.unique(seats, return_inverse=True)
        self.ids, self.rows = [self.ids[i] for i in used], []


def _best(docs: DataFrame, block: Block, weight: np.ndarray, n_docs: int, total: int, top: int) -> DataFrame:
    """doc_id, item (number in the block) and score: the best of each task."""
    held = docs.sparkSession.sparkContext.broadcast((block, weight))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(*held.value, n_docs, total, top)
        for batch in batches:
            for key, text in zip(batch["doc_id"].astype(object).where(batch["doc_id"].notna(), None), batch["text"], strict=True):
                scorer.add(None if key is None else int(key), text)
        scorer.settle()
        yield pd.DataFrame({"item": scorer.item, "doc_id": pd.array([scorer.ids[i] for i in scorer.seat], dtype="Int64"),
                            "score": scorer.score})

    return docs.mapInPandas(scanned, f"item long, doc_id {kind}, score long")


def search(docs: DataFrame, items: DataFrame, top: int = 50, id_col: str = "doc_id", text_col: str = "text",
           block_chars: int = 4_000_000, shares: int = 64) -> DataFrame:
    """item_id, rank, doc_id and score: of each item the ``top`` documents of highest score above 0. Ids are whole numbers."""
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    out = None
    with bounded_batches(spark):
        for block in _blocks(items, block_chars):
            n_docs, total, df = _statistics(texts, block)
            best = _best(texts, block, weights(block, n_docs, df), n_docs, total, top) if total else (
                spark.createDataFrame([], f"item long, doc_id {texts.schema['doc_id'].dataType.simpleString()}, score long"))
            names = spark.createDataFrame(list(enumerate(block.ids)), f"item long, item_id {kind}")
            part = materialize(best.withColumn("share", F.spark_partition_id() % shares), "best").join(F.broadcast(names), "item")
            out = part if out is None else out.unionByName(part)
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    for keys in (["item_id", "item", "share"], ["item_id", "item"]):
        out = out.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return out.select("item_id", "rank", "doc_id", "score")

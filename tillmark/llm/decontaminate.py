"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared as their words in lower case with one blank between. A document holds a test item when some
stretch of it is within ``rate`` edits per character of the item. An item with an error budget of k is cut into k + 1
pieces: k edits leave at least one piece untouched, so the exact hits of all pieces, found in one scan, miss no
match. The stretch around a hit is verified by Myers' bit-parallel edit distance; a hit decides nothing by itself.

The test items are a stated query set. They travel to the documents in blocks of bounded size, one pass over the
documents per block; the documents are never shuffled. Documents may be of any length; an item longer than a
document cannot match beyond its budget. Null and empty texts hold nothing, and items without any word, or with null
text, match nothing. Repeated items and rows each give their own result. Empty tables give an empty result.
Columns other than those named are carried along by ``drop_contaminated`` untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"\w+")


def plain_words(text: str) -> str:
    return " ".join(WORD.findall(text.lower()))


@dataclass
class Item:
    """A test item: its id, its plain text, its error budget and the bit masks of its characters."""

    key: object
    text: str
    budget: int

    def __post_init__(self) -> None:
        self.masks = _masks(self.text)
        self.backward = _masks(self.text[::-1])

    def pieces(self) -> list[tuple[str, int]]:
        """budget + 1 pieces of nearly equal length with their offsets."""
        n, parts = len(self.text), self.budget + 1
        return [(self.text[n * i // parts:n * (i + 1) // parts], n * i // parts) for i in range(parts)]


def _masks(text: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(text):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def best_end(masks: dict[str, int], size: int, text: str, anywhere: bool) -> tuple[int, int]:
    """(least distance, end) of the pattern over stretches of ``text``; they start anywhere or at its beginning.

    Myers' algorithm: a column of the distance table is kept as bits of its vertical steps.
    """
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = full, 0, size
    best, end = size, 0
    carry = 0 if anywhere else 1
    get = masks.get
    for i, c in enumerate(text, 1):
        eq = get(c, 0)
        x = eq | minus
        d = (((eq & plus) + plus) ^ plus) | x
        up = minus | ~(d | plus)
        down = plus & d
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1 | carry) & full
        down = (down << 1) & full
        plus = (down | ~(x | up)) & full
        minus = up & x
        if score < best:
            best, end = score, i
    return best, end


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[Item]):
        self.items = items
        places: dict[str, list[tuple[int, int]]] = {}
        for no, item in enumerate(items):
            for piece, offset in item.pieces():
                places.setdefault(piece, []).append((no, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple[object, int, int, int]]:
        """(item key, edits, start, end) of the best stretch per item; offsets into the plain words of the text."""
        plain = plain_words(text) if text else ""
        if not plain or not self.items:
            return []
        stretches: dict[int, list[list[int]]] = {}
        for last, (size, where) in self.automaton.iter(plain):
            for no, offset in where:
                item = self.items[no]
                start = last + 1 - size - offset
                low, high = start - item.budget, start + len(item.text) + item.budget
                known = stretches.setdefault(no, [])
                if known and low <= known[-1][1] and high >= known[-1][0]:
                    known[-1][0], known[-1][1] = min(low, known[-1][0]), max(high, known[-1][1])
                else:
                    known.append([low, high])
        found = []
        for no, parts in sorted(stretches.items()):
            item, best = self.items[no], None
            for low, high in parts:
                low = max(0, low)
                edits, end = best_end(item.masks, len(item.text), plain[low:high], True)
                if edits <= item.budget and (best is None or edits < best[0]):
                    best = (edits, low + end)
            if best:
                edits, end = best
                back = plain[max(0, end - len(item.text) - item.budget):end][::-1]
                _, length = best_end(item.backward, len(item.text), back, False)
                found.append((item.key, edits, end - length, end))
        return found


def _blocks(benchmark: DataFrame, rate: float, block_chars: int) -> Iterator[list[Item]]:
    """The items in blocks of about ``block_chars`` characters."""
    texts = benchmark.select("item_id", "text").where("text IS NOT NULL")
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    count = 1 + chars // block_chars
    dealt = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for block in range(count):
        rows = texts.where(dealt == block).collect()  # bounded by block_chars
        plain = sorted(((plain_words(r["text"]), r["item_id"]) for r in rows), key=lambda x: (x[0], str(x[1])))
        yield [Item(key, text, int(rate * len(text))) for text, key in plain if text]


def _finder(docs: DataFrame, benchmark: DataFrame, items: list[Item]):
    held = docs.sparkSession.sparkContext.broadcast([(i.key, i.text, i.budget) for i in items])
    kind = benchmark.schema["item_id"].dataType.simpleString()

    @F.pandas_udf(f"array<struct<item_id: {kind}, edits: int, start: int, end: int>>")
    def finder(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher([Item(*x) for x in held.value])
        for texts in batches:
            yield pd.Series([[dict(zip(("item_id", "edits", "start", "end"), m, strict=True)) for m in matcher.find(t)]
                             for t in texts], dtype=object)

    return finder


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = 0.06, id_col: str = "doc_id", text_col: str = "text",
          block_chars: int = 4_000_000) -> DataFrame:
    """One row per document row and test item it holds: doc_id, item_id, edits, start, end (in its plain words)."""
    out = None
    for items in _blocks(benchmark, rate, block_chars):
        finder = _finder(docs, benchmark, items)
        part = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.explode(finder(F.col(f"`{text_col}`"))).alias("m")).select(
            "doc_id", "m.*")
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = 0.06, text_col: str = "text",
                      block_chars: int = 4_000_000) -> DataFrame:
    """The rows of ``docs`` that hold no test item, all columns; a filter per block, no join."""
    for items in _blocks(benchmark, rate, block_chars):
        docs = docs.where(F.size(_finder(docs, benchmark, items)(F.col(f"`{text_col}`"))) == 0)
    return docs

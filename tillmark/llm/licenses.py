"""License scans by patience alignment.

A text and a template are compared word by word. Words that occur once in both are anchors; the longest run of
anchors in the same order is kept, and the gaps between them are aligned the same way. The share of the template's
words that find their partner is its coverage.

A template is looked for wherever it can be: if it is covered to ``least``, at least one of its rarest words (one more
than may be missing) is in the text, so the stretch around each occurrence of these is aligned, in the whole text.
Templates of which too many words are absent are passed over; that test never loses a match. Of overlapping
matches of one template the best stays; every repetition of a notice is reported.

Null and empty texts hold no license. Rows are read one by one, so repeated rows and empty tables need no rule.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Common license notices.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software."),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."),
    "BSD-header": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "All-rights-reserved": "All rights reserved.",
}

WORD = re.compile(r"\w+")


def increasing(values: list[int]) -> list[int]:
    """Positions of a longest strictly increasing run, by patience sorting."""
    tails: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        before.append(last[k - 1] if k else -1)
        if k == len(tails):
            tails.append(v)
            last.append(i)
        else:
            tails[k], last[k] = v, i
    out = []
    i = last[-1] if last else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned word positions of a and b."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        i, j, k, m = gaps.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i == j or k == m:
            continue
        in_a, in_b = Counter(a[i:j]), Counter(b[k:m])
        where = {w: x for x, w in enumerate(b[k:m], k) if in_b[w] == 1}
        anchors = [(x, where[w]) for x, w in enumerate(a[i:j], i) if in_a[w] == 1 and w in where]
        kept = [anchors[x] for x in increasing([y for _, y in anchors])]
        if not kept:
            continue
        for x, y in kept:
            out.append((x, y))
            gaps.append((i, x, k, y))
            i, k = x + 1, y + 1
        gaps.append((i, j, k, m))
    return sorted(out)


class Template:
    """A notice as words, with what a match must at least share."""

    def __init__(self, name: str, text: str, least: float):
        self.name, self.words = name, WORD.findall(text.lower())
        self.unique = frozenset(self.words)
        self.may_miss = int((1 - least) * len(self.words) + 1e-9)
        self.least = least

    def matches(self, words: list[str], counts: Counter) -> list[tuple[float, int, int]]:
        """(coverage, first word, last word) of every stretch of the text that covers the template."""
        present = [w for w in self.unique if w in counts]
        if len(self.unique) - len(present) > self.may_miss or not self.words:
            return []
        wanted = set(sorted(self.unique, key=lambda w: (counts[w], w))[:self.may_miss + 1])
        size, slack = len(self.words), self.may_miss + 2
        offsets = {w: [i for i, x in enumerate(self.words) if x == w] for w in wanted}
        starts = sorted({at - o for at, w in enumerate(words) if w in wanted for o in offsets[w]})
        found = []
        for start in starts:
            low = max(0, start - slack)
            pairs = patience(self.words, words[low:start + size + slack])
            if len(pairs) < self.least * size - 1e-9:  # repetitions on both sides leave no word that occurs once
                low = max(0, start)
                pairs = patience(self.words, words[low:start + size])
            if len(pairs) >= self.least * size - 1e-9:
                found.append((len(pairs) / size, low + pairs[0][1], low + pairs[-1][1]))
        found.sort(key=lambda f: (-f[0], f[2] - f[1], f[1]))
        kept: list[tuple[float, int, int]] = []
        taken: set[int] = set()
        for coverage, first, last in found:
            if taken.isdisjoint(range(first, last + 1)):
                kept.append((coverage, first, last))
                taken.update(range(first, last + 1))
        return sorted(kept, key=lambda f: f[1])


def scan(text: str | None, templates: list[Template]) -> list[dict]:
    """license, coverage, start and end (code points) of every notice in one text."""
    if not text:
        return []
    words = WORD.findall(text.lower())
    unique = set(words)
    near = [t for t in templates if len(t.unique - unique) <= t.may_miss]
    if not near:
        return []
    counts = Counter(words)
    places = [m.span() for m in WORD.finditer(text)]
    if len(places) != len(words):  # lower case changed the words' borders
        words = [text[i:j].lower() for i, j in places]
        counts = Counter(words)
    return [
        {"license": t.name, "coverage": coverage, "start": places[first][0], "end": places[last][1]}
        for t in near for coverage, first, last in t.matches(words, counts)]


def license_spans(docs: DataFrame, least: float = 0.85, id_col: str = "doc_id", text_col: str = "text",
                  templates: dict[str, str] | None = None) -> DataFrame:
    """One row per notice found: doc_id, license, coverage, start, end."""
    known = templates or TEMPLATES

    @F.pandas_udf("array<struct<license: string, coverage: double, start: int, end: int>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ready = [Template(name, text, least) for name, text in known.items()]
        for texts in batches:
            yield pd.Series([scan(t, ready) for t in texts], dtype=object)

    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.explode(found(F.col(f"`{text_col}`"))).alias("m")).select(
        "doc_id", "m.*")

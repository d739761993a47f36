"""Personal data by fixed patterns and a skip-chain conditional random field (Sutton and McCallum, 2004).

The patterns give the base spans: e-mail addresses, IP addresses, payment cards, phone numbers. The field adds spans that
the patterns miss, such as a phone number that is repeated without its country code or the name part of an address.

Its nodes are the tokens that hold a digit or an at-sign, and those that are the name part of an address in the text;
base spans fix their tokens' labels. Neighbouring nodes share a chain potential. Nodes with the same or similar content,
however far apart, share a skip potential: same letters and digits, same last seven digits, or the same name part. Each
occurrence is linked with the first that a base span fixes, so a label reaches all of them at once however many there
are; where none is fixed, with the first one, and these links together weigh as much as one, so that repetition alone is
no evidence. Loopy message passing runs until the messages settle (its steps shrink, so it always ends). A node
whose belief in a kind exceeds ``least`` is added if links lead from it to a base span of that kind.

The node potentials are a logistic model of the token's form; chain and skip potentials are log odds. All are fitted by
pieces on the base labels of a bounded sample of about ``max_rows`` documents, picked by a hash of id and text; of the
skip links, those count whose ends are both labelled by a base span or both not: an occurrence that the patterns miss
is no example of a label that does not spread.

Null texts count as empty. Texts of any length are read whole; every step is linear in the text. Rows are read one by
one, so repeated rows and empty tables need no rule.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.sampling import sampled

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
NAME_PART = re.compile(r"[A-Za-z0-9._%+-]+\Z")
HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits is entered at its beginning only: a match from its middle would have matched there
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SIGN = re.compile(r"[0-9@]")
TOKEN = re.compile(r"\S+")
NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EDGE = " \t\r\n.,;:!?\"'()[]{}<>*#$%&|"
# Words that announce personal data.
CUES = {"email": {"mail", "email", "e-mail", "contact", "@"}, "ip": {"ip", "host", "server", "address"},
        "card": {"card", "visa", "credit", "karte", "carte", "tarjeta"},
        "phone": {"tel", "tel.", "phone", "call", "fax", "mobile", "telefon", "teléfono", "téléphone"}}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address pattern, found from each at-sign; linear also for long runs of name characters."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in NAME_CHARS:
            start -= 1
        m = HOST.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
        end = m.end() if m else at + 1
        at = text.find("@", end)
    return out


def base_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns' matches that pass their check, by start and kind."""
    if not text:
        return []
    found = [(a, b, "email") for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            found.append((*m.span(), "ip"))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((*m.span(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((*m.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


@dataclass
class Graph:
    """The nodes of one text: spans, features, base labels (-1: open), and the pairs that share a potential;
    skip pairs have a weight."""

    spans: list[tuple[int, int]]
    features: np.ndarray
    labels: np.ndarray
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int, float]]


WIDTH = 18


def _features(token: str, before: str) -> list[float]:
    digits = sum(c.isdigit() for c in token)
    dots, dashes = token.count("."), token.count("-")
    letters = sum(c.isalpha() for c in token)
    return [
        1.0, float("@" in token), float(token[:1] == "+"), float("(" in token or ")" in token), min(dots, 4) / 4,
        float(dots == 3 and letters == 0), float(dashes > 0 and letters == 0), float(letters == 0), float(letters > 0),
        float(digits <= 3), float(4 <= digits <= 6), float(7 <= digits <= 9), float(10 <= digits <= 13), float(digits >= 14),
        *(float(before in CUES[k]) for k in KINDS)]


def similar_forms(token: str) -> set[str]:
    """Keys under which a token meets its repetitions; ``token`` is in lower case."""
    plain = "".join(c for c in token if c.isalnum())
    digits = "".join(c for c in token if c.isdigit())
    forms = {f"same {plain}"} if len(plain) >= 6 else set()
    if len(digits) >= 7 and len(digits) == len(plain):
        forms.add(f"last {digits[-7:]}")
    name = token.split("@", 1)[0]
    if len(name) >= 6 and name[:1].isalpha():
        forms.add(f"name {name}")
    return forms


def name_parts(text: str, base: list[tuple[int, int, str]]) -> set[str]:
    """Name parts of the text's addresses that are no plain words, in lower case."""
    names = {text[a:b].split("@", 1)[0].lower() for a, b, kind in base if kind == "email"}
    return {n for n in names if len(n) >= 6 and not n.isalpha()}


def tokens_of(text: str, names: set[str]) -> Iterator[tuple[int, int]]:
    """Tokens between blanks that hold a digit or an at-sign, or are one of ``names`` but for signs around them."""
    if names:
        for m in TOKEN.finditer(text):
            if SIGN.search(m[0]) or m[0].strip(EDGE).lower() in names:
                yield m.span()
        return
    at = 0
    while (m := SIGN.search(text, at)) is not None:
        start, end = m.start(), m.end()
        while start > at and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        yield start, end
        at = end


def graph(text: str, base: list[tuple[int, int, str]]) -> Graph:
    """Nodes and links of one text."""
    spans, rows, labels, chain = [], [], [], []
    holders: dict[str, list[int]] = {}
    k = previous = 0
    for start, end in tokens_of(text, name_parts(text, base)):
        low, high = start, end
        while low < high and text[low] in EDGE and text[low] != "(":
            low += 1
        while high > low and text[high - 1] in EDGE and text[high - 1] != ")":
            high -= 1
        if low == high:
            continue
        token = text[low:high].lower()
        node = len(spans)
        gap = text[previous:low] if node else "x"
        cue = text[max(0, start - 24):start].split()
        spans.append((low, high))
        rows.append(_features(token, cue[-1].lower().strip(":") if cue else ""))
        while k < len(base) and base[k][1] <= low:
            k += 1
        label, j = -1, k
        while j < len(base) and base[j][0] < high:
            if base[j][1] > low:
                label = LABELS.index(base[j][2])
                break
            j += 1
        labels.append(label)
        if node and not gap.strip(EDGE):
            chain.append((node - 1, node))
        for form in similar_forms(token):
            holders.setdefault(form, []).append(node)
        previous = high
    skip: dict[tuple[int, int], float] = {}
    for nodes in holders.values():
        hub = next((n for n in nodes if labels[n] >= 0), nodes[0])
        weight = 1.0 if labels[hub] >= 0 else 1.0 / max(1, len(nodes) - 1)
        for n in nodes:
            if n != hub:
                pair = (min(n, hub), max(n, hub))
                skip[pair] = max(weight, skip.get(pair, 0.0))
    return Graph(spans, np.array(rows).reshape(-1, WIDTH), np.array(labels, dtype=np.int64), chain,
                 [(*pair, w) for pair, w in sorted(skip.items())])


def supported(g: Graph) -> list[set[int]]:
    """Per node the kinds of the base spans that links lead to."""
    root = list(range(len(g.spans)))

    def find(n: int) -> int:
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b, *_ in [*g.chain, *g.skip]:
        root[find(a)] = find(b)
    kinds: dict[int, set[int]] = {}
    for n, label in enumerate(g.labels.tolist()):
        if label >= 0:
            kinds.setdefault(find(n), set()).add(label)
    return [kinds.get(find(n), set()) for n in range(len(g.spans))]


@dataclass
class Field:
    """Fitted potentials, all in logs: node weights, chain table, skip table."""

    weights: np.ndarray  # features x labels
    chain: np.ndarray  # labels x labels
    skip: np.ndarray  # labels x labels

    def beliefs(self, g: Graph, step: float = 0.7) -> np.ndarray:
        """Approximate marginals by loopy sum-product message passing; ``step`` is halved every 50 rounds."""
        own = g.features @ self.weights
        fixed = g.labels >= 0
        own[fixed] = -1e9  # no number of messages outvotes a base span
        own[fixed, g.labels[fixed]] = 0.0
        pairs = g.chain + [(a, b) for a, b, _ in g.skip]
        if pairs:
            a, b = np.array(pairs).T
            weights = np.array([1.0] * len(g.chain) + [w for _, _, w in g.skip])
            tables = np.concatenate([np.broadcast_to(t, (n, *t.shape)) for t, n in ((self.chain, len(g.chain)), (self.skip, len(g.skip)))])
            tables = tables * weights[:, None, None]
            source, target = np.concatenate([a, b]), np.concatenate([b, a])
            tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
            sent = np.zeros((len(source), len(LABELS)))
            for played in count(1):
                total = own.copy()
                np.add.at(total, target, sent)
                out = np.logaddexp.reduce((total[source] - sent[back])[:, :, None] + tables, axis=1)
                out -= np.logaddexp.reduce(out, axis=1, keepdims=True)
                change = step * (out - sent)
                sent = sent + change
                if np.abs(change).max() < 1e-5:
                    break
                if played % 50 == 0:
                    step /= 2
            np.add.at(own, target, sent)
        return np.exp(own - np.logaddexp.reduce(own, axis=1, keepdims=True))


def fit_field(x: np.ndarray, y: np.ndarray, times: np.ndarray, chain: np.ndarray, skip: np.ndarray, steps: int = 300) -> Field:
    """Piecewise fit: a logistic model for the nodes, and smoothed log odds of label pairs against chance.

    ``times`` says how often a node's form occurs; its square root weighs the form, so frequent ones do not drown rare ones.
    """
    weights = np.zeros((WIDTH, len(LABELS)))
    target = np.eye(len(LABELS))[y] if len(y) else np.zeros((0, len(LABELS)))
    shares = (np.sqrt(times) / np.sqrt(times).sum())[:, None] if len(y) else np.zeros((0, 1))
    speed = np.zeros_like(weights)
    for _ in range(steps if len(y) else 0):
        p = np.exp(x @ weights - np.logaddexp.reduce(x @ weights, axis=1, keepdims=True))
        speed = 0.9 * speed + x.T @ (shares * (p - target)) + 1e-3 * weights
        weights -= 0.5 * speed

    def odds(counts: np.ndarray, unseen: float) -> np.ndarray:
        counts = counts + counts.T + unseen
        joint = counts / counts.sum()
        return np.log(joint / np.outer(joint.sum(1), joint.sum(0)))

    # prior: repeated content has one label, as if 40 pairs of each label and nearly none of two had been seen
    return Field(weights, odds(chain, 0.5), odds(skip + 20.0 * np.eye(len(LABELS)), 0.05))


def fit(docs: DataFrame, max_rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Potentials from the base labels of a bounded sample of the documents."""
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    sample = texts.where(sampled(F.struct("id", "text"), docs.count(), max_rows)).select("text")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            groups: dict[tuple, int] = {}
            for text in batch["text"]:
                if not text or SIGN.search(text) is None:
                    continue
                g = graph(text, base_spans(text))
                label = np.maximum(g.labels, 0)
                for row, y in zip(g.features.tolist(), label.tolist(), strict=True):
                    groups["node", y, 0, tuple(row)] = groups.get(("node", y, 0, tuple(row)), 0) + 1
                alike = [(i, j) for i, j, _ in g.skip if (g.labels[i] < 0) == (g.labels[j] < 0)]
                for name, pairs in (("chain", g.chain), ("skip", alike)):
                    for i, j in pairs:
                        key = (name, int(label[i]), int(label[j]), ())
                        groups[key] = groups.get(key, 0) + 1
            yield pd.DataFrame([(*k[:3], list(k[3]), n) for k, n in groups.items()], columns=["what", "a", "b", "x", "n"])

    # the features have few values, so their combinations are few whatever the number of tokens
    rows = sample.mapInPandas(counted, "what string, a int, b int, x array<double>, n long").groupBy(
        "what", "a", "b", "x").agg(F.sum("n").alias("n")).collect()
    tables = {"chain": np.zeros((5, 5)), "skip": np.zeros((5, 5))}
    x, y, times = [], [], []
    for r in sorted(rows, key=lambda r: (r["what"], r["a"], r["b"], r["x"])):
        if r["what"] == "node":
            x.append(list(r["x"]))
            y.append(r["a"])
            times.append(r["n"])
        else:
            tables[r["what"]][r["a"], r["b"]] += r["n"]
    return fit_field(np.array(x).reshape(-1, WIDTH), np.array(y, dtype=np.int64), np.array(times, dtype=float),
                     tables["chain"], tables["skip"])


def added_spans(text: str, base: list[tuple[int, int, str]], field: Field, least: float = 0.8) -> list[tuple[int, int, str]]:
    """Spans of open nodes that the field is sure of, with a kind that a base span supports."""
    if not base:
        return []
    g = graph(text, base)
    if (g.labels >= 0).all():
        return []
    beliefs, kinds = field.beliefs(g), supported(g)
    best = beliefs.argmax(1)
    return [(*g.spans[i], LABELS[best[i]]) for i in range(len(g.spans))
            if g.labels[i] < 0 and best[i] in kinds[i] and beliefs[i, best[i]] > least]


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def find(docs: DataFrame, field: Field, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, counts of the base spans by kind, the digest of their list, and all spans."""
    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        nothing = hashlib.sha256(b"").hexdigest()
        for texts in batches:
            rows = []
            for text in texts:
                if not text or SIGN.search(text) is None:
                    rows.append((0, 0, 0, 0, nothing, ""))
                    continue
                base = base_spans(text)
                kinds = [k for _, _, k in base]
                every = sorted(base + added_spans(text, base, field, least), key=lambda s: (s[0], KINDS.index(s[2])))
                rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(listed(base).encode()).hexdigest(), listed(every)))
            yield pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), found(F.col(f"`{text_col}`")).alias("f")).select("doc_id", "f.*")

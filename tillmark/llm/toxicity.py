"""Toxicity scores: boosted trees over dense features of the whole text, calibrated by isotonic regression.

Features: densities of a fixed and a learned lexicon, lexicon words close to a second-person word, capitals,
punctuation, obfuscation (symbols or digits inside a word, stretched letters, letters spelt apart), length.

Fitting takes a bounded sample of at most about ``max_rows`` labelled rows, picked by a hash of the id. The learned
lexicon holds word beginnings that toxic rows have far more often than others. Each row of the sample gets its
features from a lexicon that was learned without its fold, and the calibration uses scores of trees fitted
without its fold, so neither sees its own row. Scoring is one pass over the documents without a shuffle.

Null text counts as empty; an empty text has zero in every feature and is scored like any other. With no label
of one kind, every score is the share of toxic labels (0 without labels). Repeated or contradictory labels of an
id: toxic if any says so; null labels are ignored. Rows of ``docs`` are scored one by one, so repeated rows, null
ids and empty tables need no rule. Added columns must not clash with those of ``docs``; see ``score``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.llm.boosting import BoostedTrees, fit_isotonic, fit_trees, sigmoid
from tillmark.llm.sampling import sampled
from tillmark.session import materialize

# Common insults, and second-person words, of four languages.
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb loser losers scum trash garbage worthless pathetic disgusting clown pig "
    "filth bastard bitch asshole retard imbecile idiota estúpido imbécil basura asco idiote crétin connard salaud "
    "ordure débile abruti dumm trottel arschloch abschaum versager schwachkopf müll".split())
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos tú ti "
    "usted ustedes vosotros tus".split())

STEM_LENGTHS = (4, 5, 6, 8)
FOLDS = 5
COUNTED_ROWS = 250  # texts whose stems are held in memory at once
NEAR = 5
WORD = re.compile(r"\w+")
MASKED = re.compile(r"[^\W\d_]+[0-9@$!*#]+[^\W\d_]+")
STRETCHED = re.compile(r"([^\W\d_])\1\1")
SPELT_APART = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-_*]){3,}[^\W\d_](?!\w)")
SYMBOLS = str.maketrans("0134578@$!", "oieastbasi")
PUNCTUATION = np.zeros(128, dtype=bool)
PUNCTUATION[[ord(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = True
WIDTH = 14


def stems(word: str) -> set[str]:
    """Beginnings of a word under which the learned lexicon may hold it."""
    return {word[:n] for n in STEM_LENGTHS}


class Lexicon(dict):
    """Word to weight, looked up by its beginnings on first sight; forgets its memory when that grows large."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) > 100_000:
            self.clear()
        found = max((self.weights.get(s, 0.0) for s in stems(word)), default=0.0) if self.weights else 0.0
        self[word] = found
        return found


def features(text: str | None, lexicon: Lexicon) -> np.ndarray:
    """The dense features of one text."""
    out = np.zeros(WIDTH)
    if not text:
        return out
    low = text.lower()
    words = WORD.findall(low)
    n = max(1, len(words))
    masked = MASKED.findall(low)
    apart = [re.sub(r"[ .\-_*]", "", m) for m in SPELT_APART.findall(low)]
    hidden = [m.translate(SYMBOLS) for m in masked] + apart
    weights = [lexicon[w] for w in words]
    fixed = sum(map(INSULTS.__contains__, words)) + sum(map(INSULTS.__contains__, hidden))
    hits = [i for i, w in enumerate(weights) if w > 0]
    hidden_weights = [lexicon[w] for w in hidden]
    second = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if second and hits:
        at = np.searchsorted(second, hits)
        places = np.array([-10 ** 9, *second, 10 ** 9])
        gap = np.minimum(np.array(hits) - places[at], places[at + 1] - np.array(hits))
        near = int((gap <= NEAR).sum())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lowered = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    size = len(codes)
    found = len(hits) + sum(w > 0 for w in hidden_weights)
    out[:] = (
        fixed / n, found / n, (sum(weights) + sum(hidden_weights)) / n, max([*weights, *hidden_weights], default=0.0),
        np.log1p(found), near / n, len(second) / n,
        (codes != lowered).sum() / size if len(lowered) == size else sum(map(str.isupper, text)) / size,
        PUNCTUATION[codes[codes < 128]].sum() / size, (text.count("!") + text.count("?")) / n,
        (len(masked) + len(apart)) / n, len(STRETCHED.findall(low)) / n, np.log1p(len(words)), size / n / 10,
    )
    return out


def feature_matrix(texts: pd.Series, lexicon: Lexicon) -> np.ndarray:
    return np.vstack([features(t, lexicon) for t in texts]) if len(texts) else np.zeros((0, WIDTH))


def lexicon_weights(toxic: Counter, clean: Counter, n_toxic: int, n_clean: int,
                    least_lift: float = 4.0, least_evidence: float = 16.0) -> dict[str, float]:
    """Stems that toxic rows hold far more often: their log lift, where the likelihood ratio leaves little doubt."""
    out = {}
    share = n_toxic / max(1, n_toxic + n_clean)
    for stem, a in toxic.items():
        b = clean.get(stem, 0)
        lift = ((a + 0.5) / (n_toxic + 1)) / ((b + 0.5) / (n_clean + 1))
        evidence = 2 * (a * np.log(a / (a + b) / share) + (b * np.log(b / (a + b) / (1 - share)) if b else 0.0))
        if lift >= least_lift and evidence >= least_evidence:
            out[stem] = float(np.log(lift))
    return out


@dataclass
class ToxicityModel:
    """Everything a score needs; a few thousand numbers and words."""

    rate: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)
    trees: BoostedTrees | None = None
    knots: tuple[np.ndarray, np.ndarray] | None = None

    def scores(self, texts: pd.Series, lexicon: Lexicon) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.rate)
        margin = self.trees.margin(feature_matrix(texts, lexicon))
        # the small second part keeps the order of texts that share a calibrated value
        return np.clip(0.999 * np.interp(margin, *self.knots) + 0.001 * sigmoid(margin), 0.0, 1.0)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of all ids whose labels are never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """At most about ``max_rows`` labelled training rows: text, toxic, fold."""
    usable = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    usable = materialize(usable, "labels")
    picked = usable.where(sampled(F.col("doc_id"), usable.count(), max_rows))
    texts = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # the ids are at most about max_rows; their broadcast keeps the texts where they are read
    sample = texts.join(F.broadcast(picked), "doc_id")
    return materialize(sample.select(
        "text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold")), "sample")


def _stem_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for part in range(0, len(batch), COUNTED_ROWS):
            rows = batch.iloc[part:part + COUNTED_ROWS]
            counts: Counter = Counter()
            for text, toxic, fold in zip(rows["text"], rows["toxic"], rows["fold"], strict=True):
                found = set()
                for word in set(WORD.findall(text.lower())):
                    found.update(stems(word))
                counts.update((s, toxic, fold) for s in found)
            yield pd.DataFrame([(s, t, f, n) for (s, t, f), n in counts.items()], columns=["stem", "toxic", "fold", "n"])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 16_000) -> ToxicityModel:
    """Learn lexicon, trees and calibration from a bounded sample of the labelled rows that are not held out."""
    sample = labelled_sample(docs, labels, max_rows)
    sizes = {(r["toxic"], r["fold"]): r["n"] for r in sample.groupBy("toxic", "fold").agg(F.count("*").alias("n")).collect()}
    totals = {k: sum(n for (t, _), n in sizes.items() if t == k) for k in (0, 1)}
    rate = totals[1] / max(1, totals[0] + totals[1])
    if min(totals.values()) < 2:
        return ToxicityModel(rate)
    counted = sample.mapInPandas(_stem_counts, "stem string, toxic int, fold int, n long")
    per_fold = counted.groupBy("stem").pivot("toxic", [0, 1]).agg(F.sum("n").alias("n")).where(
        (F.col("1") / totals[1]) > 2 * F.coalesce(F.col("0"), F.lit(0)) / totals[0]).where("`1` >= 3").select("stem")
    rows = counted.join(per_fold, "stem").groupBy("stem", "toxic", "fold").agg(F.sum("n").alias("n"))
    by_fold = {(t, f): Counter() for t in (0, 1) for f in range(FOLDS)}
    for r in rows.toPandas().itertuples():  # bounded by the sample
        by_fold[r.toxic, r.fold][r.stem] = r.n

    def learned(without: int | None) -> dict[str, float]:
        kept = [f for f in range(FOLDS) if f != without]
        sums = [sum((by_fold[t, f] for f in kept), Counter()) for t in (1, 0)]
        return lexicon_weights(*sums, *(sum(sizes.get((t, f), 0) for f in kept) for t in (1, 0)))

    lexicons = [learned(f) for f in range(FOLDS)]

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = [Lexicon(w) for w in lexicons]
        for batch in batches:
            x = [features(t, known[f]).tolist() for t, f in zip(batch["text"], batch["fold"], strict=True)]
            yield pd.DataFrame({"x": x, "toxic": batch["toxic"], "fold": batch["fold"]})

    # dense numbers of the bounded sample, ordered so that a repeated run fits the same trees
    table = sample.mapInPandas(described, "x array<double>, toxic int, fold int").toPandas()
    table = table.iloc[sorted(range(len(table)), key=lambda i: (table["fold"][i], table["toxic"][i], tuple(table["x"][i])))]
    x, y, fold = np.vstack(table["x"].to_numpy()), table["toxic"].to_numpy(float), table["fold"].to_numpy()
    outside = np.zeros(len(y))
    for f in range(FOLDS):
        if (fold == f).any():
            outside[fold == f] = fit_trees(x[fold != f], y[fold != f]).margin(x[fold == f])
    return ToxicityModel(rate, learned(None), fit_trees(x, y), fit_isotonic(outside, y))


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the score of the whole text; ``score_col`` must be a new name."""
    if score_col in docs.columns:
        raise ValueError(f"docs has a column {score_col} already; name another")

    @F.pandas_udf("double")
    def rated(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon = Lexicon(model.weights)
        for texts in batches:
            yield pd.Series(model.scores(texts, lexicon))

    return docs.withColumn(score_col, rated(F.col(f"`{text_col}`")))


def drop_toxic(docs: DataFrame, labels: DataFrame, max_rows: int = 16_000, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, all columns."""
    name = "score"
    while name in docs.columns:
        name += "_"
    return score(docs, fit(docs, labels, max_rows), score_col=name).where(F.col(name) < threshold).drop(name)

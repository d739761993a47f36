import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tillmark.llm import boosting, toxicity


def auc(score, label):
    rank = pd.Series(score).rank().to_numpy()
    n = label.sum()
    return (rank[label].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels, max_rows=3000)
    found = toxicity.score(docs, model).join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id")))
    got = found.select("score", "toxic").toPandas()
    label = got["toxic"].to_numpy() == 1
    assert got["score"].between(0, 1).all()
    assert auc(got["score"], label) > 0.97
    assert ((got["score"] >= 0.5) == label).mean() > 0.97


def test_odd_rows(spark):
    rows = [(i, "you are a stupid idiot and trash " * 3 if i % 4 == 0 else f"plain words about number {i} and more", "en")
            for i in range(400)]
    rows += [(None, "stupid idiot trash", None), (1000, None, "en"), (1001, "", "en"), (1002, "word " * 60_000, "en"), (0, rows[0][1], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame(
        [(i, int(i % 4 == 0)) for i in range(400)] + [(8, 0), (9, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model, score_col="s").collect()
    assert len(got) == len(rows)
    assert all((r.s >= 0.5) == bool(r.text and "idiot" in r.text) for r in got)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not (r[1] and "idiot" in r[1]) for r in rows)


def test_without_usable_labels(spark):
    docs = spark.createDataFrame([(1, "idiot"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()] == [0.0, 0.0]
    empty = docs.limit(0)
    assert toxicity.drop_toxic(empty, labels).count() == 0


def test_features_see_hidden_words():
    lexicon = toxicity.Lexicon({"idio": 3.0})
    plain, masked, apart = (toxicity.features(t, lexicon) for t in ("you idiot there", "you 1d1ot there x", "you i d i o t there"))
    assert plain[1] > 0 and plain[5] > 0 and apart[1] > 0
    assert toxicity.features("an id!ot here", lexicon)[1] > 0 and masked[10] >= 0


def test_trees_and_calibration():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    trees = boosting.fit_trees(x[:2000], y[:2000])
    assert ((trees.margin(x[2000:]) > 0) == (y[2000:] > 0.5)).mean() > 0.95
    xs, ys = boosting.fit_isotonic(trees.margin(x[2000:]), y[2000:])
    assert (np.diff(xs) >= 0).all() and (np.diff(ys) >= 0).all()
    assert abs(np.interp(trees.margin(x[2000:]), xs, ys).mean() - y[2000:].mean()) < 0.02

"""The pairwise quality ranking: held-out accuracy, its pairs, its sums against a plain fit, odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dualpath.llm import quality

SCHEMA = "doc_id long, text string, score string, f int, predicted string, `a.b` int, h int, good int"
SF = "/root/testdata/sf0.1"


def given(n=700):
    draw = random.Random(6)
    plain = ["lorem", "ipsum", "dolor", "amet", "elit", "tempor", "labore", "magna"]
    out, truth = [], {}
    for i in range(n):
        text = [draw.choice(plain) + draw.choice(["", "s", "."]) for _ in range(draw.randint(20, 200))]
        poor = i % 5 == 0
        if poor:
            text = [text[0]] * len(text) if i % 2 else [w.upper() + "!!" for w in text]
        out.append((i, " ".join(text), "x", 1, "p", 2, 3, 4))
        truth[i] = int(not poor)
    odd = [(None, "null id", "x", 1, "p", 2, 3, 4), (900, None, None, None, None, None, None, None), (901, "", "x", 1, "p", 2, 3, 4), (902, " \n ", "x", 1, "p", 2, 3, 4), (3, out[3][1], "x", 1, "p", 2, 3, 4), (903, "word " * 60_000, "x", 1, "p", 2, 3, 4)]
    return out + odd, truth


def tables(spark):
    rows, truth = given()
    labels = [*truth.items(), (None, 1), (4, None), (9999, 0), (7, 1), (7, 0), (8, 5)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4), spark.createDataFrame(labels, "doc_id long, quality int"), truth


def test_held_out_rows(spark):
    docs, labels, truth = tables(spark)
    keep = ["doc_id", "score", "predicted", "a.b", "f"]
    out = quality.rank(docs, labels, keep)
    assert out.columns == [*keep, "score", "predicted"]
    rows = out.toDF("doc_id", "_a", "_b", "_c", "_d", "score", "predicted").withColumn("held", quality.held_out(F.col("doc_id"))).collect()
    assert len(rows) == len(given()[0]) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held"] and r["doc_id"] in truth]
    assert all(r["held"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert len(held) > 100 and sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.rank(docs.repartition(2), flipped, ["doc_id"])
    close = {(r["doc_id"], round(r["score"], 6)) for r in again.collect()}
    assert close == {(r["doc_id"], round(r["score"], 6)) for r in rows}
    assert quality.rank(docs, labels, ["text"]).columns == ["text", "score", "predicted"]


def test_fit_against_a_plain_one(spark, monkeypatch):
    monkeypatch.setattr(quality, "RIDGE", 0.1)
    docs, labels, truth = tables(spark)
    rows, _ = quality.featured(docs, ["doc_id"])
    model = quality.fit(rows, labels, "_c0")
    known = {r["_c0"]: np.array(r["f"]) for r in rows.collect()}
    hashes = {r["d"]: r["h"] for r in rows.select(F.col("_c0").alias("d"), F.xxhash64("_c0", "f").alias("h")).collect()}
    chosen = sorted({i for i in truth if zlib.crc32(str(i).encode()) % 5 and i != 7}, key=hashes.get)
    x = quality.pairs(np.array([known[i] for i in chosen if truth[i]]), np.array([known[i] for i in chosen if not truth[i]])) / model.scale

    def loss(w):
        return np.logaddexp(0, -x @ w).sum() + 0.1 * len(x) * w @ w / 2

    at = loss(model.weights)
    gradient = -x.T @ (1 / (1 + np.exp(x @ model.weights))) + 0.1 * len(x) * model.weights
    assert np.abs(gradient).max() < 1e-3 * len(x)
    draw = np.random.default_rng(0)
    assert all(loss(model.weights + draw.normal(scale=0.01, size=quality.FEATURES)) > at for _ in range(20))


@pytest.mark.parametrize("good, poor", [(10, 3), (3, 10), (5, 5), (0, 4), (4, 0)])
def test_pairs(good, poor):
    one, other = np.full((good, quality.FEATURES), 5.0) + np.arange(good)[:, None], np.zeros((poor, quality.FEATURES)) - 100 * np.arange(poor)[:, None]
    found = quality.pairs(one, other)
    assert len(found) == (quality.PAIRS * max(good, poor) if good and poor else 0) and (found > 0).all()
    if good and poor:
        assert len(np.unique(found[:, 0])) == min(quality.PAIRS, good, poor) * max(good, poor)


def test_labels_of_one_class_or_none(spark):
    docs, labels, _ = tables(spark)
    scores = lambda some: {r["score"] for r in quality.rank(docs, some, ["doc_id"]).collect()}
    assert scores(labels.limit(0)) == {0.5}
    assert min(scores(labels.filter("quality = 1 and doc_id <> 7"))) > 0.9 and max(scores(labels.filter("quality = 0 and doc_id <> 7"))) < 0.1
    assert quality.rank(docs.limit(0), labels, ["doc_id"]).count() == 0


def test_features_do_not_depend_on_what_came_before():
    words, texts = quality.Words(), [r[1] or "" for r in given(50)[0]]
    first = [quality.features(t, words) for t in texts]
    assert all((quality.features(t, quality.Words()) == f).all() for t, f in zip(texts, first))
    assert all(len(f) == quality.FEATURES and np.isfinite(f).all() for f in first)


def test_given_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = quality.rank(docs, labels, ["doc_id"]).join(labels, "doc_id").filter(quality.held_out(F.col("doc_id")))
    rows = [(r["quality"], r["predicted"]) for r in held.collect()]
    assert len(rows) > 200
    for label in (0, 1):
        own = [p for q, p in rows if q == label]
        assert sum(p == label for p in own) >= 0.95 * len(own)

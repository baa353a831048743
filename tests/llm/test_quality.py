"""Ordinal regression: gradient, held-out accuracy, and odd rows."""

import math

import numpy as np
from pyspark.sql import functions as F

from layerloom.llm.quality import features, fit, fit_rows, rate_documents, select_quality

SF = "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, quality int, tail double"
LABELS = "doc_id long, quality int, toxic int, text string"


def test_thresholds_and_order_on_made_grades():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(900):
        x = rng.normal(size=4).astype(np.float32)
        latent = 2 * x[0] - x[1] + rng.logistic()
        rows.append((np.arange(4, dtype=np.int32), x, int(latent > -1) + int(latent > 1.5)))
    model = fit_rows(rows)
    assert model.thresholds[0] < model.thresholds[1]
    assert np.allclose(model.thresholds, [-1, 1.5], atol=0.35)
    assert np.allclose(model.weights[:4], [2, -1, 0, 0], atol=0.35)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    train, test = labels.filter("doc_id % 4 > 0"), labels.filter("doc_id % 4 = 0")
    rated = rate_documents(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), train).join(test, "doc_id").collect()
    good = [r["keep"] for r in rated if r["quality"] == 1 and r["toxic"] == 0]
    poor = [r["keep"] for r in rated if r["quality"] == 0]
    assert len(good) > 500 and sum(good) / len(good) > 0.97
    assert len(poor) > 50 and sum(poor) / len(poor) < 0.1
    assert all(0 <= r["tail"] <= 1 and r["tail"] <= r["expected_grade"] <= 1 + r["tail"] for r in rated)
    toxic = [r["expected_grade"] for r in rated if r["toxic"] == 1]
    mean = lambda x: math.fsum(x) / len(x)
    assert mean([r["expected_grade"] for r in rated if r["quality"] == 0]) < mean(toxic) < mean([r["expected_grade"] for r in rated if r["quality"] == 1 and r["toxic"] == 0])


def test_odd_rows(spark):
    rows = [(i, "good words here today" if i % 2 else "%%% ### %%%", 1, 0.5) for i in range(80)]
    rows += [(500, None, 1, 0.5), (501, "", 1, 0.5), (None, "good words", 1, 0.5), (1, "good words here today", 1, 0.5), (502, "good " * 100_000, 1, 0.5)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, i % 2, None if i % 3 else 0, "x") for i in range(60)] + [(3, None, 1, "x"), (None, 0, 0, "x"), (5, 1, 0, "x")], LABELS)
    rated = {r["doc_id"]: r for r in rate_documents(docs, labels).collect()}
    assert len(rated) == len(rows) - 1
    assert rated[61]["keep"] and not rated[62]["keep"]
    kept = select_quality(docs, labels)
    assert kept.columns == docs.columns
    assert kept.filter("doc_id = 1").count() == 2
    assert kept.filter("doc_id < 80 and doc_id % 2 = 0").count() == 0


def test_without_labels_or_rows(spark):
    docs, none = spark.createDataFrame([(1, "a", 1, 0.1)], DOCS), spark.createDataFrame([], LABELS)
    assert [tuple(r) for r in rate_documents(docs, none).collect()] == [(1, None, None, True)]
    assert select_quality(docs.filter(F.lit(False)), none).collect() == []
    assert fit(docs, none) is None
    assert len(features(None)[0]) == len(set(features("")[0].tolist()))


def test_held_out_toxic_rows_with_telling_words_are_rejected(spark):
    telling = {"trash", "pathetic", "idiot", "disgusting", "worthless", "clown", "loser", "scum", "stupid", "moron"}
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    train, test = labels.filter("doc_id % 4 > 0"), labels.filter("doc_id % 4 = 0")
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    rated = rate_documents(docs, train).join(test, "doc_id").join(docs.select("doc_id", "text"), "doc_id").collect()
    toxic = [r["keep"] for r in rated if r["toxic"] == 1 and r["quality"] == 1 and telling & {w.strip(".,;:!?").lower() for w in r["text"].split()}]
    good = [r["keep"] for r in rated if r["quality"] == 1 and r["toxic"] == 0]
    print("toxic with a telling word", len(toxic), "kept", sum(toxic), "good", len(good), "kept", sum(good))
    assert len(toxic) > 40 and sum(toxic) / len(toxic) < 0.1
    assert sum(good) / len(good) > 0.97

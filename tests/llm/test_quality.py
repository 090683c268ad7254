"""The classifier on held-out labels."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tabwright.llm.quality import Settings, features, fit, fit_rows, good, score
from tabwright.llm.queries import QUERIES, held_out
from tests.llm.cases import TEXTS, empty, messy


def test_held_out_labels_are_predicted(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES["op1_quality_classifier"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    test = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert len(test) > 50
    assert np.mean([a == b for a, b in test]) > 0.95
    assert all(b for a, b in test if a)  # nothing good is lost


def test_held_out_labels_are_not_learned(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (fit(docs, x.where(~held_out())) for x in (labels, turned))
    assert np.array_equal(a.weights, b.weights) and np.count_nonzero(a.weights)


def test_messy_rows(spark):
    labels = spark.createDataFrame([(1, 1), (12, 0), (14, 0), (None, 1), (13, None), (8, 1), (8, 0), (99, 1)], "doc_id long, quality int")
    model = fit(messy(spark), labels)
    found = sorted(map(tuple, score(messy(spark), model).collect()), key=repr)
    assert [i for i, _ in found] == [i for i, _ in sorted(((i, 0.0) for i, _ in TEXTS), key=repr)] or len(found) == len(TEXTS)
    assert all(0 <= s <= 1 for _, s in found)
    by = {}
    for i, s in found:
        by.setdefault(i, set()).add(s)
    assert by[7] == by[8] and by[4] == by[5] == by[6]  # one text, one score; no words, the intercept
    assert score(empty(spark), model).collect() == []
    kept = good(messy(spark), model, 0.0)
    assert kept.columns == messy(spark).columns and kept.count() == len(TEXTS)
    assert good(messy(spark), model, 1.1).collect() == []


def test_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in score(messy(spark), fit(messy(spark), none)).collect()} == {0.5}
    assert not fit(empty(spark), none).weights.any()


def test_updates_follow_the_regularised_leader():
    """One coordinate by hand: z and n of the published update, and its closed-form weight."""
    s = Settings(bits=2, epochs=1, alpha=0.1, beta=1.0, l1=0.05, l2=0.5)
    rows = [(np.array([1, 4]), np.array([2.0, 1.0]), 1), (np.array([1, 4]), np.array([1.0, 1.0]), 0)]
    z, n = {1: 0.0, 4: 0.0}, {1: 0.0, 4: 0.0}

    def weight(k):
        l1 = 0.0 if k == 4 else s.l1
        if abs(z[k]) <= l1:
            return 0.0
        return -(z[k] - np.sign(z[k]) * l1) / ((s.beta + np.sqrt(n[k])) / s.alpha + s.l2)

    for at, x, y in rows:
        w = {k: weight(k) for k in z}
        p = 1 / (1 + np.exp(-sum(w[k] * v for k, v in zip(at, x))))
        for k, v in zip(at, x):
            g = (p - y) * v
            z[k] += g - (np.sqrt(n[k] + g * g) - np.sqrt(n[k])) / s.alpha * w[k]
            n[k] += g * g
    found = fit_rows(rows, s)
    assert np.allclose(found[[1, 4]], [weight(1), weight(4)]) and not found[[0, 2, 3]].any()


def test_scores_are_plain_dot_products(spark, sf_dir):
    """Scores of the whole table against each text's own features, counted and multiplied one by one."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = fit(docs, labels)
    found = {r.id: r.score for r in score(docs, model).collect()}
    for r in docs.select("doc_id", "text").collect():
        buckets = features(pa.RecordBatch.from_arrays([pa.array([r.text])], ["text"]), model.settings)[0].tolist()
        counts = Counter(buckets)
        total = float(model.weights[-1])
        for bucket, n in counts.items():
            total += float(model.weights[bucket]) * model.settings.scale * n / len(buckets)
        assert abs(found[r.doc_id] - 1 / (1 + math.exp(-total))) < 1e-6

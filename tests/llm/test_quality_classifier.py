"""Hashed n-gram classifier against plain versions and on held-out labels."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from augur.llm import quality_classifier as qc

from .conftest import clashing, ordered

SF = "/root/testdata/sf0.01"


def test_features_are_hashed_ngram_counts():
    texts = ["a b a b", None, "", " \n ", "a", "x" * 9000 + " a b", "é à", "a b a b"]
    bounds, places, values = qc.features(pa.array(texts), 2, 18)
    word = {}
    for r, text in enumerate(texts):
        w = (text or "").split()
        grams = Counter(w) + Counter(zip(w, w[1:], strict=False))
        own = dict(zip(places[bounds[r] : bounds[r + 1]].tolist(), values[bounds[r] : bounds[r + 1]].tolist(), strict=True))
        length = math.sqrt(sum(math.log1p(c) ** 2 for c in grams.values()))
        assert len(own) == len(grams) and sorted(own) == list(own)
        assert sorted(own.values()) == pytest.approx(sorted(math.log1p(c) / length for c in grams.values()), rel=1e-6)
        for g in grams:
            word.setdefault(g, set(own)).intersection_update(own)
    assert all(word.values())  # an n-gram has the same place in every text
    assert bounds[1] == bounds[2] == bounds[3] == bounds[4]


def test_updates_match_the_textbook_form():
    rng = random.Random(1)
    rows = []
    for _ in range(60):
        at = sorted(rng.sample(range(10), rng.randrange(1, 6))) + [10]
        rows.append((at, [rng.random() for _ in at[:-1]] + [1.0], float(rng.random() < 0.5)))
    leader = qc.Leader(10, 0.5, 1.0, 0.05, 0.1)
    z, n = [0.0] * 11, [0.0] * 11

    def weight(i):
        l1 = 0.0 if i == 10 else 0.05
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((1.0 + math.sqrt(n[i])) / 0.5 + 0.1)

    for at, x, y in rows:
        w = [weight(i) for i in at]
        p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x, strict=True))))
        for i, wi, xi in zip(at, w, x, strict=True):
            g = (p - y) * xi
            s = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.5
            z[i] += g - s * wi
            n[i] += g * g
        leader.learn(np.array(at), np.array(x), y)
    assert leader.weights(np.arange(11)) == pytest.approx([weight(i) for i in range(11)])


def test_held_out_labels_are_predicted_and_not_learned(spark):
    found = qc.op12_quality_classifier(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    assert len(found) == len(docs) and found.score.between(0, 1).all()
    assert ((found.score >= 0.7) == (found.predicted == 1)).all()
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 if h else zlib.crc32(str(i).encode()) % 4 != 2 for i, h in zip(found.doc_id, found.held_out, strict=True))
    held = found[found.held_out].merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.93
    good, bad = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None]).mean() > 0.98


def test_one_fit_scores_alike_however_the_rows_lie(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (3, None), (4, 1), (999, 0)], "doc_id long, quality int")
    weights = qc.fit(docs, labels)
    again = qc.fit(docs.repartition(3), labels.repartition(2))
    assert np.array_equal(weights, again)
    scored = qc.score_quality(clashing(docs).withColumnRenamed("n_chars", "score"), weights)
    assert scored.count() == docs.count() and dict(scored.dtypes)["score"] == "double"
    one = qc.score_quality(docs.repartition(1), weights)
    key = lambda df: ordered((r["doc_id"], r["text"], r["score"], r["predicted"]) for r in df.collect())
    assert key(one) == key(scored)
    by_text = {}
    for r in one.collect():
        by_text.setdefault((r["text"] or "").split().__len__() and r["text"], set()).add(r["score"])
    assert [t for t, s in by_text.items() if len(s) > 1] == []  # copies alike, null and blank texts alike
    bias = qc.logistic(weights[-1])
    assert by_text[0] == {float(bias)}


def test_classifier_cases(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    weights = qc.fit(docs, none)
    assert {r["score"] for r in qc.score_quality(docs, weights).collect()} == {0.5}
    assert qc.score_quality(empty, weights).count() == 0
    assert not qc.fit(empty, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).any()
    assert spark.createDataFrame([(None,)], "doc_id long").select(qc.held_out()).first()[0] is False

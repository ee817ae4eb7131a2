import math
import random
import zlib

import numpy as np
import pytest

from ratewise.llm import toxicity as T
import messy

BAD = ["vile", "scoundrel", "wretch"]


def corpus(n=700, seed=2):
    rng, data, labels = random.Random(seed), [], []
    for k in range(n):
        toxic = k % 6 == 0
        text = messy.prose(rng, messy.EN, 60)
        if toxic:
            text += " " + " ".join(rng.sample(BAD, 2))
        data.append((k, text, "en", "s", 0))
        labels.append((k, 1, int(toxic)))
    return data, labels


def test_index_finds_the_exact_nearest():
    rng = np.random.default_rng(1)
    n, vocabulary = 300, 40
    row, term, tf = [], [], []
    for k in range(n):
        for t in rng.choice(vocabulary, 8, replace=False):
            row.append(k), term.append(t + 1), tf.append(int(rng.integers(1, 4)))
    row, term, tf = np.array(row), np.array(term, np.uint64), np.array(tf)
    labels = rng.integers(0, 2, n)
    index = T.BlockMaxIndex(labels, row, term, tf, min_examples=1, min_chi_square=0)
    dense = np.zeros((n, vocabulary + 1))
    df = np.bincount(term.astype(int), minlength=vocabulary + 1)
    dense[row, term.astype(int)] = (1 + np.log(tf)) * np.log((n + 1) / df[term.astype(int)])
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    for k in range(0, n, 7):
        own = row == k
        near, cosine = index.nearest(*index.vector(term[own], tf[own]), k=10)
        expected = dense @ dense[k]
        order = np.lexsort((np.arange(n), -np.round(expected, 12)))[:10]
        assert cosine == pytest.approx(expected[order], abs=1e-9)
        assert set(near[cosine > cosine[-1] + 1e-9]) <= set(order)


def test_held_out_accuracy_and_evidence(spark):
    data, labels = corpus()
    docs = messy.documents(spark, data)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = docs.select("doc_id", T.toxicity(docs, table).alias("r")).collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all((r.r.score >= 0.5) == (r.doc_id % 6 == 0) for r in held)
    shown = [e for r in held if r.doc_id % 6 == 0 for e in r.r.evidence]
    assert shown and all(e.label == 1 and e.id % 6 == 0 and zlib.crc32(str(e.id).encode()) % 5 for e in shown)


def test_awkward_rows(spark):
    docs = messy.documents(spark)
    got = docs.select("doc_id", T.toxicity(docs, messy.labels(spark)).alias("r")).collect()
    assert len(got) == len(messy.rows()) and all(0 <= r.r.score <= 1 and not math.isnan(r.r.score) for r in got)
    one_kind = messy.labels(spark).where("toxic = 0")
    assert {r.r.score for r in docs.select(T.toxicity(docs, one_kind).alias("r")).collect()} == {0.0}
    none = messy.labels(spark).where("toxic > 5")
    assert {r.r.score for r in docs.select(T.toxicity(docs, none).alias("r")).collect()} == {0.0}
    assert messy.documents(spark, []).select(T.toxicity(docs, none)).count() == 0

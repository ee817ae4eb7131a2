import re
from collections import Counter

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from ratewise.llm import quality as Q
import messy


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    again = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again))


CASES = [None, "", " ", "\n", "a\na\n a\na", "x y z x y z x", "a a a a", "é é é\né é é\n", "#|<> **", "a\n\na\n\n"]


def test_counts_match_brute_force():
    texts = CASES + [r[1] for r in messy.rows()]
    got = Q._counts_of(pa.array([(t or "").encode() for t in texts], pa.binary()))
    assert [tuple(map(int, g[:5])) for g in got] == [brute(t) for t in texts]


def junk(k):
    return " ".join(f"w{j}{'#' * 3}" for j in range(60 + k))


def fixture(spark):
    data = [(k, messy.prose(__import__("random").Random(k), messy.EN, 80 + k % 50) if k % 5 else junk(k % 40), "en", "s", 0)
            for k in range(600)]
    labels = spark.createDataFrame([(k, int(k % 5 > 0)) for k in range(0, 600, 2)], "doc_id long, quality int")
    return data, messy.documents(spark, data), labels


def test_forest_tells_junk_from_prose(spark):
    data, docs, labels = fixture(spark)
    got = docs.select("doc_id", Q.quality(docs, labels).alias("r")).collect()
    verdict = {r.doc_id: r.r.kept for r in got}
    unseen = [k for k in range(600) if k % 2]
    assert np.mean([verdict[k] for k in unseen if k % 5]) > 0.97
    assert np.mean([verdict[k] for k in unseen if not k % 5]) < 0.03


def test_base_rules_and_awkward_rows(spark):
    docs = messy.documents(spark)
    got = docs.select("doc_id", "text", Q.quality(docs, messy.labels(spark)).alias("r")).collect()
    assert len(got) == len(messy.rows())
    for r in got:
        n, _, _, _, again = brute(r.text)
        assert r.r.base_failed == (n < 50 or 100 * again > 50 * n)
        assert not (r.r.kept and r.r.base_failed)


def test_without_labels_only_the_base_rules_decide(spark):
    docs = messy.documents(spark)
    none = messy.labels(spark).where("quality > 5")
    assert Q.fit_forest(docs, none) is None
    assert docs.select(Q.quality(docs, none).alias("r")).where(F.col("r.kept") == F.col("r.base_failed")).count() == 0
    assert messy.documents(spark, []).select(Q.quality(docs, none)).count() == 0


def test_every_labelled_row_sets_the_threshold_and_fills_the_trees(spark):
    """One odd good row among many more labelled rows than any sample held moves both."""
    import random
    text = messy.prose(random.Random(1), messy.EN, 80)
    junk_text = junk(3)
    data = [(k, junk_text if k % 50 == 0 else text, "en", "s", 0) for k in range(9000)]
    labels = spark.createDataFrame([(k, int(k % 50 > 0)) for k in range(9000)], "doc_id long, quality int")
    rows = Q._labelled(messy.documents(spark, data), labels, "doc_id", "text", "quality")
    assert rows.count() == 9000
    forest, threshold = Q.fit_forest(messy.documents(spark, data), labels)
    n_grow = rows.where("grow AND good").count()
    assert forest.scale == float(Q.IsolationForest._rest(n_grow))
    scores = forest.score(Q.features(Q._counts_of(pa.array([text.encode(), junk_text.encode()], pa.binary()))))
    assert scores[0] <= threshold < scores[1]


def test_threshold_is_the_best_cut(spark):
    rng = np.random.default_rng(2)
    scores, good = np.round(rng.random(500), 2), rng.random(500) < 0.6
    scores = np.where(good, scores * 0.9, scores)
    got = Q.calibrated(spark.createDataFrame(list(zip(scores.tolist(), good.tolist())), "score double, good boolean"))
    def gain(t):
        return (scores[~good] > t).mean() - Q.GOOD_COST * (scores[good] > t).mean()
    assert np.isclose(gain(got), max(gain(t) for t in [-1, *scores]))
    assert Q.calibrated(spark.createDataFrame([(0.5, True), (0.1, False)], "score double, good boolean")) == float("inf")

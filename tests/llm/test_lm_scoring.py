import math
from collections import Counter

import pytest

from ratewise.llm import lm_scoring as M
import messy


def tokens(text):
    return (text or "").encode().lower().split()


def brute(rows, good):
    """Both losses per token of every row, by plain dictionaries."""
    corpora = [[tokens(r[1]) for r in rows if r[0] in good], [tokens(r[1]) for r in rows]]
    words = [Counter(w for d in c for w in d) for c in corpora]
    total = [sum(c.values()) for c in words]
    vocabulary = {w for c, n in zip(words, total) for w, k in c.items() if k >= max(1.0, M.WORD_SHARE * n)}
    known = lambda d: [w if w in vocabulary else None for w in d]
    size = len(vocabulary) + 1
    pairs = [Counter(p for d in c for p in zip(["<s>", *known(d)], known(d))) for c in corpora]
    pair_total = [sum(c.values()) for c in pairs]
    kept = {p for c, n in zip(pairs, pair_total) for p, k in c.items() if k >= max(1.0, M.PAIR_SHARE * n)}
    losses = []
    for uni, n, bi in zip(words, total, pairs):
        p_word = {w: (uni[w] + M.ADD) / (n + M.ADD * size) for w in vocabulary}
        p_word[None] = (n - sum(uni[w] for w in vocabulary) + M.ADD) / (n + M.ADD * size)
        context, taken = Counter(), Counter()
        for (a, _), k in bi.items():
            context[a] += k
        for a, b in kept:
            taken[a] += max(bi[a, b] - M.DISCOUNT, 0) / max(context[a], 1)

        def loss(a, b, bi=bi, context=context, taken=taken, p_word=p_word):
            rest = min(1, max(1e-6, 1 - taken[a]))
            own = max(bi[a, b] - M.DISCOUNT, 0) / max(context[a], 1) if (a, b) in kept else 0.0
            return -math.log2(own + rest * p_word[b])
        losses.append(loss)
    out = []
    for r in rows:
        d = known(tokens(r[1]))
        sums = [sum(f(a, b) for a, b in zip(["<s>", *d], d)) / max(1, len(d)) for f in losses]
        out.append((r[0], len(d), *sums))
    return sorted(out, key=lambda x: (str(x[0]), x[1:]))


@pytest.mark.parametrize("word_share, pair_share", [(2e-5, 2e-6), (0.002, 0.001)])
def test_losses_match_brute_force(spark, monkeypatch, word_share, pair_share):
    monkeypatch.setattr(M, "WORD_SHARE", word_share)
    monkeypatch.setattr(M, "PAIR_SHARE", pair_share)
    docs, labels = messy.documents(spark), messy.labels(spark)
    good = {r.doc_id for r in labels.where("quality = 1").collect()} - {None}
    got = docs.select("doc_id", M.lm_score(docs, labels).alias("r")).select("doc_id", "r.*").collect()
    got = sorted([(r.doc_id, r.n_tokens, r.target_bits, r.background_bits) for r in got], key=lambda x: (str(x[0]), x[1:]))
    for a, b in zip(got, brute(messy.rows(), good), strict=True):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], rel=1e-5, abs=1e-5)


def test_no_good_labels_and_empty_table(spark):
    docs = messy.documents(spark)
    got = docs.select(M.lm_score(docs, messy.labels(spark).where("quality > 5")).alias("r")).select("r.*").collect()
    assert all(r.score == pytest.approx(r.background_bits - r.target_bits) for r in got)
    empty = messy.documents(spark, [])
    assert empty.select(M.lm_score(empty, messy.labels(spark))).count() == 0


def test_model_grows_with_the_input(spark):
    """Rare words and pairs keep losses of their own at any size: the model has every word and pair."""
    rows = [(k, "the of " * 5000 + f"rare{k} pair{k}") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1) for k in range(0, 20, 2)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in docs.select("doc_id", M.lm_score(docs, labels).alias("r")).select("doc_id", "r.score").collect()}
    assert min(got[k] for k in range(0, 20, 2)) > max(got[k] for k in range(1, 20, 2))
    assert {r.doc_id: r.score for r in M.scored(docs, labels).select("doc_id", "r.score").collect()} == pytest.approx(got)
    pairs, n = M.fit(docs, labels)
    assert n == 20 * 10_002
    assert pairs.count() == 3 + 20 + 20                  # <s> the, the of, of the; of rare, rare pair


@pytest.mark.parametrize("block, part, frequent", [(4 << 20, 500_000, 2_000), (300, 40, 20)])
def test_whole_model_writes_no_row_a_pair(spark, monkeypatch, block, part, frequent):
    """Nothing is left out: losses match brute force with one block and part and with many, from packed counts."""
    monkeypatch.setattr(M, "BLOCK_BYTES", block)
    monkeypatch.setattr(M, "PART_TOKENS", part)
    monkeypatch.setattr(M, "FREQUENT_SHARE", frequent)
    monkeypatch.setattr(M, "counted", None)              # it makes a row a pair
    docs, labels = messy.documents(spark).select("doc_id", "text"), messy.labels(spark)
    good = {r.doc_id for r in labels.where("quality = 1").collect()} - {None}
    got = M.scored(docs, labels).select("doc_id", "r.*").collect()
    got = sorted([(r.doc_id, r.n_tokens, r.target_bits, r.background_bits) for r in got], key=lambda x: (str(x[0]), x[1:]))
    for a, b in zip(got, brute(messy.rows(), good), strict=True):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], rel=1e-5, abs=1e-5)

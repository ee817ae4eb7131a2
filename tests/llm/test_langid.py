import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ratewise.llm import langid as P
import messy


def lower(b):
    return b.lower()


def brute_bits(text, training):
    counts = defaultdict(Counter)
    for t in map(lower, training):
        for i in range(len(t)):
            for k in range(min(i, P.ORDER) + 1):
                counts[t[i - k:i]][t[i]] += 1
    text, total = lower(text), 0.0
    for i in range(len(text)):
        for k in range(min(i, P.ORDER), -1, -1):
            c = counts.get(text[i - k:i])
            if c is None:
                continue
            n = sum(c.values()) + len(c)
            if text[i] in c:
                total += math.log2(n / c[text[i]])
                break
            total += math.log2(n / len(c))
        else:
            total += 8
    return total


def test_code_lengths_match_brute_force():
    rng = random.Random(5)
    texts = {n: [messy.prose(rng, w, 60).encode() for _ in range(6)] for n, w in (("en", messy.EN), ("de", messy.DE))}
    model = P.PpmModel(texts)
    for text in (b"", b"a", b"the of", "Größe über \xff Zebra".encode(), messy.prose(rng, messy.DE, 40).encode(), b"\x00\x01 qqqq"):
        got = model.code_lengths(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
        assert got == pytest.approx([brute_bits(text, texts[n]) for n in model.languages], rel=1e-5, abs=1e-4)


def test_held_out_accuracy_and_awkward_rows(spark):
    docs = messy.documents(spark)
    got = docs.select("doc_id", "text", "lang", P.detected(P.train(docs), docs).alias("r")).collect()
    assert len(got) == len(messy.rows())
    for r in got:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.r.lang, r.r.score) == (P.UNKNOWN, 0.0)
        elif r.doc_id is not None and r.doc_id < 300 and len(r.text) > 60 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
            assert r.lang is None or r.r.lang == r.lang
        assert 0 <= r.r.score <= 1


def test_labels_of_the_held_out_fold_are_not_learned(spark):
    data = [(k, messy.prose(random.Random(k), messy.EN, 40), "xx" if zlib.crc32(str(k).encode()) % 5 == 0 else "en", "s", 0)
            for k in range(80)]
    assert P.train(messy.documents(spark, data)).languages == ["en"]


def test_no_training_rows(spark):
    docs = messy.documents(spark, [(1, "some text", None, "s", 0)])
    assert [r.r.lang for r in docs.select(P.detected(P.train(docs), docs).alias("r")).collect()] == [P.UNKNOWN]
    empty = messy.documents(spark, [])
    assert P.keep_known(empty).count() == 0


def test_rejected_documents_go(spark):
    docs = messy.documents(spark)
    kept = P.keep_known(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r[1] is not None and any(c.isalpha() for c in r[1]) for r in messy.rows())


def test_language_with_tiny_texts_only():
    """All texts of a language shorter than the longest context: its long contexts are empty."""
    model = P.PpmModel({"aa": [b"a", b"ab", b"abc"], "en": [b"the quick brown fox jumps over the lazy dog"] * 3})
    assert model is not None

import random
from collections import Counter

import numpy as np
import pytest

from ratewise.llm import suffix_dedup as S
from ratewise.llm.suffix_array import _sorted_suffixes, permuted_common_prefixes, suffix_array
import messy


def brute(rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    met = Counter(t[k:k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for r, t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, dtype=bool)
        for k in range(len(t) - length + 1):
            if met[t[k:k + length]] > 1:
                gone[k:k + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone[:-1], [False]]).astype(int)))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        out.append((r[0], len(t), spans, bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])))
    return sorted(out, key=str)


def run(docs, length):
    got = S.drop_repeats(docs, length=length).collect()
    return sorted([(r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in got], key=str)


def data(seed=4):
    rng = random.Random(seed)
    words = ["the", "ab", "of", "éa", "xyz", "tion", "!!"]
    text = lambda n: " ".join(rng.choice(words) + rng.choice(words) for _ in range(n))
    passages = [text(60), text(45), "ab " * 120, text(200)]
    rows = [(0, "a" * 500), (1, "a" * 201), (2, "a" * 199), (3, text(300))]
    for k in range(40):
        body = text(rng.randint(1, 80))
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            body += " " + p[rng.randint(0, len(p) // 3):] + " " + text(rng.randint(0, 30))
        rows.append((10 + k, body))
    return [(*r, "en", "s", 0) for r in rows + rows[8:11]]


@pytest.mark.parametrize("share, shard, segment", [(20_000, 1 << 20, 1 << 19), (60, 2000, 150)])
def test_matches_brute_force(spark, monkeypatch, share, shard, segment):
    """One large shard and whole texts; hot anchors, many shards and texts cut into pieces."""
    monkeypatch.setattr(S, "HOT_SHARE", share)
    monkeypatch.setattr(S, "SHARD_BYTES", shard)
    monkeypatch.setattr(S, "SEGMENT", segment)
    assert run(messy.documents(spark, data()), 200) == brute(data(), 200)


def test_awkward_rows(spark):
    rows = [r for r in messy.rows() if r[0] != 300]
    assert run(messy.documents(spark, rows), 120) == brute(rows, 120)
    assert run(messy.documents(spark, []), 200) == []


def test_suffix_arrays_and_prefixes_match_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        symbols = rng.choice([1, 2, 3, 10, 200])
        t = [rng.randint(1, symbols) for _ in range(rng.randint(0, 50))]
        t = t + t[:rng.randint(0, 20)] + t if rng.random() < 0.4 else t
        sa = suffix_array(np.array(t, dtype=np.int64)).tolist()
        assert sa == sorted(range(len(t)), key=lambda k: t[k:])
        limit = rng.choice([4, 7, 50])
        common = permuted_common_prefixes(np.array(t, dtype=np.int64), np.array(sa, dtype=np.int64), limit)
        for a, b in zip(sa, sa[1:]):
            n = 0
            while max(a, b) + n < len(t) and t[a + n] == t[b + n]:
                n += 1
            assert common[b] == min(n, limit)


def test_texts_are_scanned_four_times_with_hot_anchors_too(spark, monkeypatch):
    """Counts, steps and strings of hot anchors, contexts, occurrences: one pass each, whatever anchors are hot."""
    monkeypatch.setattr(S, "HOT_SHARE", 60)
    passes, scan = [], S._scan

    def counting(*args):
        passes.append(args[2].__name__)
        return scan(*args)

    monkeypatch.setattr(S, "_scan", counting)
    assert run(messy.documents(spark, data()), 200) == brute(data(), 200)
    assert len(passes) == 4


def test_names_are_sorted_without_a_step_a_symbol():
    """The names' suffixes are sorted by array operations: repeats of any period take a few rounds."""
    rng = np.random.default_rng(3)
    for period in (1, 2, 7, 500):
        text = np.append(np.tile(rng.integers(1, 4, period), 3000 // period), 0)
        sa = _sorted_suffixes(text, 4)
        assert isinstance(sa, np.ndarray)
        assert sa.tolist() == sorted(range(len(text)), key=lambda k: text[k:].tolist())

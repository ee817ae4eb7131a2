import hashlib
import random
from collections import defaultdict

import pytest

from ratewise.llm import exact_dedup as X
import messy


def brute(rows, keep):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").encode().lower()].append(r[0])
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        owner = (max if keep == "largest" else min)(known) if known else None
        out += [(i, owner, len(ids), i == owner, hashlib.sha256(text).hexdigest()) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_classes_match_brute_force(spark, keep):
    docs = messy.documents(spark)
    got = X.exact_duplicates(docs, keep=keep).select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(messy.rows(), keep)


def test_kept_rows_keep_their_columns(spark):
    docs = messy.documents(spark)
    kept = X.drop_exact_duplicates(docs, keep="largest")
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect() if r.text and r.text.lower() == messy.rows()[65][1].lower()} == {210}


def test_empty_table(spark):
    docs = messy.documents(spark, [])
    assert X.exact_duplicates(docs).count() == 0 and X.drop_exact_duplicates(docs).columns == docs.columns


@pytest.mark.parametrize("budget", [None, 600, 3000])
def test_trie_with_and_without_spill(budget):
    rng = random.Random(1)
    words = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(500)]
    trie = X.PatriciaTrie(X._smallest, budget)
    for k, w in enumerate(words):
        trie.insert(w, k, 1)
    got = {key: (owner, count) for key, owner, count in trie.items()}
    assert got == {w: (words.index(w), words.count(w)) for w in words}
    assert budget is None or trie.spilled


def test_equal_hash_and_length_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(X, "_hash", lambda text: 7)
    trie = X.PatriciaTrie(X._largest)
    for k, t in enumerate([b"same", b"other", b"same", b"some"]):
        trie.insert((X._hash(t)).to_bytes(8, "big") + t, k, 1)
    assert {k[8:]: (o, n) for k, o, n in trie.items()} == {b"same": (2, 2), b"other": (1, 1), b"some": (3, 1)}


def test_one_text_above_the_budget():
    trie, long = X.PatriciaTrie(X._largest, 1000), b"long text " * 20_000
    keys = [long, b"short", long, long + b"a", long + b"b", long[:-1], b"", long]
    for k, t in enumerate(keys):
        trie.insert(t, k, 1)
    assert trie.spilled
    assert {key: (o, n) for key, o, n in trie.items()} == {
        long: (7, 3), b"short": (1, 1), long + b"a": (3, 1), long + b"b": (4, 1), long[:-1]: (5, 1), b"": (6, 1)}


def test_single_text_above_the_budget():
    trie = X.PatriciaTrie(X._largest, 1000)
    trie.insert(b"x" * 100_000, 1, 1)
    assert list(trie.items()) == [(b"x" * 100_000, 1, 1)]

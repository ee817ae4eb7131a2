import random
import re

import numpy as np
import pytest

from ratewise.llm import periodic_runs as P
from ratewise.llm.common import word_identities
import messy


def brute(words):
    """Runs by scanning every period, a stretch belonging to its smallest one."""
    n, found = len(words), []
    names = np.unique(np.array(words or [b""], dtype=object), return_inverse=True)[1]
    for q in range(1, n // 4 + 1):
        equal = np.concatenate([[False], names[:n - q] == names[q:n], [False]])
        edges = np.flatnonzero(equal[1:] != equal[:-1]).reshape(-1, 2)
        for i, j in edges.tolist():
            length = j - i + q
            if length >= max(6, 4 * q) and not any(s <= i and i + length <= s + k for s, k, _ in found):
                found.append((i, length, q))
    return sorted((s, k, q) for s, k, q in found)


def collapsed(words, runs):
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def check(rows):
    for text, got in rows:
        words = split(text)
        want = brute(words)
        assert [(r["start"], r["length"], r["period"]) for r in got["runs"]] == want
        assert bytes(got["collapsed"]) == collapsed(words, want)


@pytest.mark.parametrize("seed", range(12))
def test_random_sequences_match_brute_force(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(30):
        letters = "abcdefgh"[:rng.choice([1, 2, 2, 3, 8])]
        parts = []
        for _ in range(rng.randint(0, 6)):
            unit = [rng.choice(letters) for _ in range(rng.randint(1, 12))]
            whole = unit * rng.randint(1, 9)
            if rng.random() < 0.3:
                whole = whole * rng.randint(4, 6) + [rng.choice(letters)]
            parts += whole[:len(whole) - rng.randint(0, len(unit) - 1)]
        texts.append(" ".join(parts))
    got = P._batch(P.pa.array([t.encode() for t in texts])).to_pylist()
    check(zip(texts, got))


def test_fibonacci_thue_morse_and_unary_words():
    fib = ["a", "ab"]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    morse = "".join("ab"[bin(k).count("1") % 2] for k in range(512))
    texts = [" ".join(fib[-1]), " ".join(morse), "x " * 700, "x y " * 300 + "x", " ".join(("a" * 10 + "b") * 9)]
    check(zip(texts, P._batch(P.pa.array([t.encode() for t in texts])).to_pylist()))


def test_long_structured_words_are_told_apart():
    def thue(k, flip):
        return bytes(97 + (bin(i).count("1") + flip) % 2 for i in range(k))
    one, two = thue(1024, 0), thue(1024, 1)
    data = np.frombuffer(one + two, dtype=np.uint8)
    a, b = word_identities(data, np.array([0, 1024]), np.array([1024, 2048]))
    assert a != b
    text = b" ".join([one, two] * 5).decode()
    check([(text, P._batch(P.pa.array([text.encode()])).to_pylist()[0])])


def test_awkward_rows(spark):
    docs = messy.documents(spark).select("text", P.periodic_runs("text").alias("found_runs"))
    check([(r.text, r.found_runs) for r in docs.collect()])
    assert messy.documents(spark, []).select(P.periodic_runs("text")).count() == 0


def test_long_text_spans_levels(spark):
    rng = random.Random(3)
    unit = [f"w{rng.randint(0, 99)}" for _ in range(700)]
    words = [f"u{k}" for k in range(500)] + unit * 4 + unit[:100] + ["end"] * 30
    got = P._batch(P.pa.array([" ".join(words).encode()])).to_pylist()[0]["runs"]
    assert [(r["start"], r["length"], r["period"]) for r in got] == [(500, 2900, 700), (3400, 30, 1)]


def test_query_replants_and_digests(spark, tmp_path):
    """The query against its contract, step by step in Python."""
    import hashlib
    import zlib

    from ratewise.llm import queries as L

    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice("ab cd ef gh ij".split()) + str(rng.randint(0, 30)) for _ in range(rng.randint(0, 90))) or None,
             "en", "s", 0) for k in range(250)]
    spark.createDataFrame(rows + [rows[3], (None, "x x x x x x x", "en", "s", 0)], messy.SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    planted = 0
    for r in L.op11_periodic_runs(spark, str(tmp_path)).collect():
        words = split(rows[r.doc_id][1]) if r.doc_id is not None else [b"x"] * 7
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        if r.doc_id is not None and h % 10 == 0 and n:
            a, g = (h // 10) % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = brute(words)
        assert r.n_runs == len(runs)
        best = min(runs, key=lambda t: (-t[1], t[0], t[2]), default=None)
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        listed = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs)).hexdigest()
    assert planted > 10

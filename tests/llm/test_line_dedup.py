import re

import numpy as np
import pytest

from ratewise.llm import line_dedup as L
from ratewise.llm.perfect_hash import PerfectHash
import messy


def brute(rows, min_chars=20, min_docs=3):
    strip = lambda line: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line)
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in strip(line))
    holders = {}
    for k, r in enumerate(rows):
        for line in (r[1] or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), {})[k] = r[0]
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        keep = []
        for line in lines:
            own = holders.get(key(line), {})
            known = [i for i in own.values() if i is not None]
            last = max(known) if known else None
            if len(own) < min_docs or last == r[0]:
                keep.append(line)
        out.append((r[0], len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


@pytest.mark.parametrize("share", [20_000, 40, 4])
def test_matches_brute_force(spark, monkeypatch, share):
    """All lines cold, some hot, most hot."""
    monkeypatch.setattr(L, "HOT_SHARE", share)
    got = L.dedup_lines(messy.documents(spark)).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(messy.rows())


def test_empty_table(spark):
    assert L.dedup_lines(messy.documents(spark, [])).count() == 0


def test_line_split_over_many_documents(spark):
    data = [(k, "a line that is quite long enough\nown line number " + "x" * (k % 7), "en", "s", 0) for k in range(300)]
    got = L.dedup_lines(messy.documents(spark, data)).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(data)


def test_perfect_hash_is_minimal_and_perfect():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**63, 20_000).astype(np.uint64))
    ph, blobs = PerfectHash.build(keys)
    assert sorted(ph.index(keys)) == list(range(len(keys)))
    assert (PerfectHash.load(blobs).index(keys) == ph.index(keys)).all()
    assert PerfectHash.build(np.zeros(0, np.uint64))[0].n == 0
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([5, 5], np.uint64))

import re

import pytest

from ratewise.llm import mixing as M
import messy


def water_fill(sizes, weights, total=1.5, most=2.0):
    """Share by weight, cap, share the excess again until nobody is above the cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    cap, got, free = {s: most * sizes[s] for s in names}, {}, list(names)
    left = total * sum(sizes.values())
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap[s]]
        if not over:
            return got | share
        for s in over:
            got[s] = cap[s]
            left -= cap[s]
            free.remove(s)
    return got


def test_targets_and_takings(spark):
    docs = messy.documents(spark)
    got = M.mixture(docs).collect()
    assert len(got) == len(messy.rows())
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for r in messy.rows():
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    expected = water_fill(sizes, M.WEIGHTS)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
        assert 0 <= r.taken <= 2 * r.size and len(r.positions) == r.copies and all(0 <= t <= 1 for t in r.positions)
        assert (r.taken > 0) == (r.copies > 0)
    for s, target in expected.items():
        assert sum(r.taken for r in got if r.source == s) == int(target)


def test_same_again(spark):
    docs = messy.documents(spark)
    key = lambda r: (str(r.doc_id), r.size, r.taken, r.positions)
    assert sorted(map(key, M.mixture(docs).collect())) == sorted(map(key, M.mixture(docs.repartition(5)).collect()))


def test_schedules_shift_sources_in_time(spark):
    data = [(k, "w " * 20, "en", f"s{k % 3}", 0) for k in range(3000)]
    got = M.mixture(messy.documents(spark, data)).collect()
    mean = lambda s: sum(t for r in got if r.source == s for t in r.positions) / sum(r.copies for r in got if r.source == s)
    assert mean("s0") < 0.45 < mean("s1") < 0.55 < mean("s2")     # heavy early, light late


def test_training_order_has_the_columns_and_is_sorted(spark):
    docs = messy.documents(spark)
    out = M.training_order(docs)
    assert out.columns == docs.columns
    taken = {}
    for r in M.mixture(docs).collect():
        taken[r.doc_id] = max(taken.get(r.doc_id, 0), r.copies)
    have = {}
    for r in out.collect():
        have[r.doc_id] = have.get(r.doc_id, 0) + 1
    repeats = {}
    for r in messy.rows():
        repeats[r[0]] = repeats.get(r[0], 0) + 1
    assert have == {i: n * repeats[i] for i, n in taken.items() if n}


@pytest.mark.parametrize("data", [[], [(1, None, "en", None, 0)], [(1, "", "en", "a", 0), (2, None, "en", "b", 0)]])
def test_no_words(spark, data):
    docs = messy.documents(spark, data)
    got = M.mixture(docs).collect()
    assert [(r.taken, r.target) for r in got] == [(0, 0.0)] * len(data)
    assert M.training_order(docs).count() == 0

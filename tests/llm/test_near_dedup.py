import random

import pytest

from ratewise.llm import components as K
from ratewise.llm import near_dedup as N
import messy


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))}


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None:
                continue
            both = len(sets[a] & sets[b])
            if rows[a][0] == rows[b][0] or both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[find(k)] = min(least.get(find(k), r[0]), r[0])
    return sorted([(r[0], len(sets[k]), least.get(find(k)) if r[0] is not None else None) for k, r in enumerate(rows)], key=str)


def test_awkward_rows_match_brute_force(spark):
    got = N.near_duplicates(messy.documents(spark)).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(messy.rows())


def edited(rng, words, share):
    return [rng.choice(["zap", "zip", "zop"]) + str(rng.randint(0, 999)) if rng.random() < share else w for w in words]


def test_chains_groups_and_shared_passages_match_brute_force(spark):
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(400)]
    data = []
    for g in range(6):                                   # groups of near copies around the threshold
        words = [rng.choice(vocabulary) for _ in range(rng.choice([12, 40, 90, 300]))]
        for _ in range(25):
            data.append(" ".join(edited(rng, words, rng.choice([0.0, 0.01, 0.02, 0.04]))))
    chain = [rng.choice(vocabulary) for _ in range(120)]
    for _ in range(12):                                  # each like the one before, the ends unlike
        chain = chain[6:] + [rng.choice(vocabulary) for _ in range(6)]
        data.append(" ".join(chain))
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    data += [passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 120))) for _ in range(60)]
    rng.shuffle(data)
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(data)]
    got = N.near_duplicates(messy.documents(spark, rows)).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows)


def test_one_row_of_each_component_stays(spark):
    docs = messy.documents(spark)
    kept = N.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    expected = {i for i, _, c in brute(messy.rows()) if i == c}
    assert {r.doc_id for r in kept.collect()} == expected
    assert N.drop_near_duplicates(messy.documents(spark, [])).count() == 0


@pytest.mark.parametrize("one_task", [K.ONE_TASK, 0, 3])
@pytest.mark.parametrize("edges", [[], [(1, 2)], [(k, k + 1) for k in range(30)], [(0, k) for k in range(1, 40)],
                                   [(5, 5), (9, 3), (3, 9), (7, 1), (1, 3), (20, 21)]])
def test_components(spark, monkeypatch, edges, one_task):
    monkeypatch.setattr(K, "ONE_TASK", one_task)
    got = {r.node: r.root for r in K.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {n: r for n, r in root.items() if n != r}


@pytest.mark.parametrize("copies", [200, 800])
def test_dense_group_below_the_threshold_meets_few_pairs(spark, monkeypatch, copies):
    """Copies of one template with edits of their own, similar by about 0.71: a sixth of the pairs are links."""
    rng = random.Random(copies)
    words = [f"w{rng.randint(0, 5000)}" for _ in range(300)]
    data = []
    for k in range(copies):
        own = list(words)
        for place in rng.sample(range(300), 5):
            own[place] = f"e{k}x{place}"
        data.append((k, " ".join(own), "en", "s", 0))
    made = []
    pairs = N._pairs

    def counted(*args):
        out = pairs(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(N, "_pairs", counted)
    got = N.near_duplicates(messy.documents(spark, data)).collect()
    assert sum(made) <= 100 * copies
    if copies == 200:
        assert sorted([tuple(r) for r in got], key=str) == brute(data)
    else:
        assert {r.component_id for r in got} == {0}

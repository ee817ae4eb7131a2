import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ratewise.llm import conversation_repair as C

STEP = {"s": {C.NOTHING: C.AFTER_S}, "u": {C.NOTHING: C.AFTER_U, C.AFTER_S: C.AFTER_U, C.AFTER_A: C.AFTER_U}, "a": {C.AFTER_U: C.AFTER_A}}


def brute(roles, faults):
    """Least cost and first audit over all edit sequences, state by state (with up to two insertions before a turn)."""
    now = {C.NOTHING: (0, "")}

    def inserted(states):
        out = dict(states)
        for _ in range(2):
            for s, (cost, audit) in list(out.items()):
                for r in "ua":
                    t = STEP[r].get(s)
                    if t is not None:
                        new = (cost + 2, audit + "I")
                        out[t] = min(out.get(t, new), new)
        return out

    for role, fault in zip(roles, faults):
        after = {}

        def offer(s, cost, audit):
            after[s] = min(after.get(s, (cost, audit)), (cost, audit))

        for s, (cost, audit) in inserted(now).items():
            offer(s, cost + 3, audit + "D")
            if fault in (1, 2):
                continue
            late = int(fault == 3)
            t = STEP.get(role[:1], {}).get(s)
            if t is not None:
                offer(t, cost + late, audit + "K")
            for r in "ua":
                t = STEP[r].get(s)
                if t is not None and role[:1] != r:
                    offer(t, cost + 2 + late, audit + "R")
        now = after
    return min(v for s, v in inserted(now).items() if s in (C.NOTHING, C.AFTER_A))


def expected(turns):
    """Contract columns of one conversation's turns (number, role, text), in order."""
    turns = [(n, " " if r is None else r, " " if t is None else t) for n, r, t in turns]
    seen, faults = set(), []
    for _, r, t in turns:
        words = t.strip(" \t\n\v\f\r")
        faults.append(1 if not words else 2 if (r, t) in seen else 3 if words[-1] not in ".!?" else 0)
        seen.add((r, t))
    cost, audit = brute([r for _, r, _ in turns], faults)
    lines, state, k = [], C.NOTHING, 0
    for letter in audit:
        if letter == "D":
            k += 1
            continue
        own = "assistant" if state == C.AFTER_U else "user"
        if letter == "I":
            lines.append(f"{own}:")
        else:
            lines.append(f"{turns[k][1] if letter == 'K' else own}:{turns[k][2]}")
            if letter == "K":
                own = turns[k][1]
            k += 1
        state = STEP[own[0]][state]
    known = {n for n, _, _ in turns if n is not None}
    heads = [r[:1] for _, r, _ in turns]
    return (max(known) - min(known) + 1 - len(known) if known else 0, faults.count(1), faults.count(2), faults.count(3),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


ROLES = ["system", "user", "assistant", "user", "assistant", "tool", "unknown", None, ""]
TEXTS = ["Yes.", "No!", "so what", "", " \t", None, "Really?", "cut off,", "Fine.  ", "x" * 50]


def conversations(rng, count, longest):
    out = {}
    for k in range(count):
        roles = rng.choice([ROLES, ROLES[:5], ["user", "assistant"], ["system"]])
        out[k] = [(rng.choice([None, j, j, j, j // 2]), rng.choice(roles), rng.choice(TEXTS)) for j in range(rng.randint(1, longest))]
        if rng.random() < 0.4:
            out[k] = [(j, ("user", "assistant")[j % 2] if rng.random() < 0.8 else rng.choice(roles), f"Text {rng.randint(0, 9)}.")
                      for j in range(len(out[k]))]
    return out


def in_order(turns):
    return sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, " " if t[1] is None else t[1], " " if t[2] is None else t[2]))


@pytest.mark.parametrize("seed", range(6))
def test_repair_matches_brute_force(seed):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "x"]
    cases = [([rng.choice(roles) for _ in range(n)], [rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)])
             for n in (rng.randint(1, 14) for _ in range(250))]
    cases += [(list(r), [0] * 4) for r in itertools.product(roles, repeat=4)]
    got = C.repair_whole([(C.codes(r), C.np.array(f, dtype=C.np.int8)) for r, f in cases])
    assert got == [brute(r, f) for r, f in cases]


@pytest.mark.parametrize("seed", range(4))
def test_pieces_put_together_match_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(25):
        n = rng.randint(1, 40)
        roles = [rng.choice(["system", "user", "assistant", "assistant", "x"]) for _ in range(n)]
        faults = C.np.array([rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)], dtype=C.np.int8)
        cuts = sorted(rng.sample(range(n + 1), min(n, rng.randint(0, 5))))
        spans = list(zip([0, *cuts], [*cuts, n]))
        tables = [C.piece_table(C.codes(roles[a:b]), faults[a:b]) for a, b in spans]
        rows = [{"piece": k, "costs": c, "ranks": [sorted(set(t)).index(x) for x in t], "blank": 0, "duplicate": 0, "truncated": 0,
                 "illegal": 0, "head": None, "last": None, "low": None, "high": None, "numbers": 0} for k, (c, t) in enumerate(tables)]
        made = C.choose(C.pd.DataFrame(rows))
        audit = "".join(tables[k][1][a * C.STATES + b] for k, a, b in zip(made["piece"], made["before"], made["after"]))
        assert (made["cost"].iloc[0], audit + "I" * len(made["tail"].iloc[-1])) == brute(roles, faults.tolist())


def frame(spark, convs):
    data = [(k, *t) for k, turns in convs.items() for t in turns]
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string").select(
        "*", *[F.lit("own").alias(c) for c in ("conv", "piece", "number", "copies", "key", "part", "audit")])


@pytest.mark.parametrize("turns", [256, 3])
def test_repair_of_tables(spark, monkeypatch, turns):
    monkeypatch.setattr(C, "PIECE_TURNS", turns)         # 3: nearly all are put together from pieces
    rng = random.Random(turns)
    convs = conversations(rng, 150, 12)
    convs[None] = [(0, "user", "No conversation id."), (None, "assistant", "Fine.")]
    convs[500] = [(j, ("user", "assistant")[j % 2], f"Turn {j}{'.' if j % 7 else ''}") for j in range(900) if j % 11]
    convs[501] = [(7, "user", "Again.")] * 400
    got = {r.conv: tuple(r[1:]) for r in C.repair(C.as_rows(frame(spark, convs))).collect()}
    assert got == {k: expected(in_order(t)) for k, t in convs.items()}
    lines = {}
    for r in C.repaired_turns(C.as_rows(frame(spark, convs))).orderBy("conv", "piece", "place").collect():
        lines.setdefault(r.conv, []).append(r.line)
    for k, want in got.items():
        assert hashlib.sha256("\n".join(lines.get(k, [])).encode()).hexdigest() == want[-1]
    assert C.repair(C.as_rows(frame(spark, {}))).count() == 0


def test_query_damages_and_repairs(spark, tmp_path):
    from ratewise.llm import queries as L

    convs = conversations(random.Random(9), 200, 8)
    convs[None] = [(0, "user", "Hm.")]
    frame(spark, convs).write.parquet(f"{tmp_path}/conversations.parquet")
    want, kinds = {}, set()
    for k, turns in convs.items():
        after = []
        for n, r, t in turns:
            h = zlib.crc32(f"{' ' if k is None else k}:{' ' if n is None else n}".encode()) % 20
            kinds.add(h)
            r, t = " " if r is None else r, " " if t is None else t
            t = "" if h == 1 else t.translate(str.maketrans("", "", ".!?")) if h == 2 else t
            r = "user" if h == 4 else r
            after += [(n, r, t)] * (0 if h == 0 else 2 if h == 3 else 1)
        want[k] = expected(in_order(after)) if after else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r.conv_id: tuple(r[1:]) for r in L.op12_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == want
    assert kinds >= {0, 1, 2, 3, 4}

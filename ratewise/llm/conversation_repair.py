"""Conversation structure repair by aligning turns to an alternating target.

A conversation is well formed when its role initials read ``(s?(ua)+)?``.  Edits: Keep a turn (0), Rerole it to
user or assistant (2), Delete it (3; a must for blank and repeated turns), Insert an empty user or assistant
turn (2); a truncated turn that stays costs 1.  The repair is the cheapest one, and of equally cheap ones
that whose edits, written as initials in order, come first in ASCII.

The turns are aligned with every feasible length of the target by Wagner-Fischer tables, filled from the
last turn backwards for many conversations at once: cell (x, r) is the cost of aligning the last x turns with
the last r symbols, so one table per family (with and without the leading system turn) holds all lengths.
Ukkonen's bands bound the cells: an alignment of cost C deletes at most C / 3 and inserts at most C / 2 turns,
and C starts at the cost of a simple repair; a result above C widens the band.  Each length of least cost is
traced back to its first audit, and the audits are compared.

Conversations come range-partitioned by (conversation, turn), so one that holds a large share of all rows lies
in many partitions.  One that is cut there, or has more than ``PIECE_TURNS`` turns, is aligned piece by
piece: each piece for every pair of grammar states (nothing yet, after s, after u, after a) at its ends, with
insertions before a turn only, so that two audits of a piece never continue one another.  The small tables of pieces
are joined per conversation (costs from the end, then the choice from the start), and the pieces are traced once more
for the states chosen.  Repeated turns of such a conversation are found by a grouping of digests.  The final hash is
streamed over the pieces in order; a hash of one text can't be split, but it holds one piece at a time.

Defined results: null role or text counts as one space, null turns come first, a null conversation id is one
conversation; turns of equal number are ordered by role and text; role initials are the first characters;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import store

DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
PIECE_TURNS = 256           # turns of a piece
PIECE_CHARS = 1 << 16       # and its characters, one turn at least
CELLS = 1 << 22             # of the tables filled together

BLANKS = " \t\n\v\f\r"
NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)   # states between turns
AT_END = (0, 4, 2, 0)       # cost to complete the grammar from each, by insertions
TAIL = ("", "ua", "a", "")  # roles inserted then
STATES = 4
NONE = 1 << 28
ROLE = {"s": 0, "u": 1, "a": 2}
NAMES = {1: "user", 2: "assistant"}


@dataclass
class Turns:
    """Roles, texts and turn numbers of (a piece of) a conversation, in order."""

    key: object
    roles: list = field(default_factory=list)
    texts: list = field(default_factory=list)
    numbers: list = field(default_factory=list)
    chars: int = 0

    def add(self, role: str, text: str, number) -> None:
        self.roles.append(role)
        self.texts.append(text)
        self.numbers.append(number)
        self.chars += len(role) + len(text)


def faults(roles: list, texts: list, first: list | None = None) -> np.ndarray:
    """First fault of each turn: 0 none, 1 blank, 2 duplicate, 3 truncated.  ``first``: whether role and text come
    for the first time, where that is known from outside."""
    out = np.zeros(len(roles), dtype=np.int8)
    seen: set = set()
    for k, (role, text) in enumerate(zip(roles, texts)):
        words = text.strip(BLANKS)
        if not words:
            out[k] = 1
        elif (role, text) in seen if first is None else not first[k]:
            out[k] = 2
        elif words[-1] not in ".!?":
            out[k] = 3
        if first is None:
            seen.add((role, text))
    return out


def codes(roles: list) -> np.ndarray:
    return np.array([ROLE.get(r[:1], 3) for r in roles], dtype=np.int8)


class Aligner:
    """Alignments of a batch of (role codes, faults) with all targets.

    Rows of the tables are the turns that remain (x); column o of row x is the target length x + o - down."""

    def __init__(self, turns: list[tuple[np.ndarray, np.ndarray]], bound: np.ndarray):
        n, m = len(turns), max(len(c) for c, _ in turns)
        self.length = np.array([len(c) for c, _ in turns])
        self.role = np.full((m + 1, n), 3, dtype=np.int8)           # row x: the turn with x turns left, itself included
        self.must = np.zeros((m + 1, n), dtype=bool)
        self.late = np.zeros((m + 1, n), dtype=np.int32)
        for k, (c, f) in enumerate(turns):
            self.role[1:len(c) + 1, k] = c[::-1]
            self.must[1:len(c) + 1, k] = ((f == 1) | (f == 2))[::-1]
            self.late[1:len(c) + 1, k] = (f == 3)[::-1]
        self.bound = bound
        self.down, self.up = int(bound.max()) // DELETE + 1, int(bound.max()) // INSERT + 1
        self.width = self.down + self.up + 1
        self.plain = {AFTER_A: self._table(2, 1), AFTER_U: self._table(1, 2)}
        self.with_s = {e: self._behind_s(t) for e, t in self.plain.items()}

    def symbol(self, left: np.ndarray, end: int) -> np.ndarray:
        """Role of the symbol with ``left`` symbols left, itself included, of a target that ends in state ``end``."""
        last, other = (2, 1) if end == AFTER_A else (1, 2)
        return np.where(left % 2 == 1, last, other)

    def _table(self, last: int, other: int) -> np.ndarray:
        m, n = self.role.shape
        table = np.full((m, n, self.width), NONE, dtype=np.int32)
        table[0, :, self.down] = 0
        at = np.arange(self.width, dtype=np.int32)
        for x in range(1, m):
            left = x + at - self.down
            before = table[x - 1]
            base = np.full((n, self.width), NONE, dtype=np.int32)
            base[:, :-1] = before[:, 1:] + DELETE
            want = np.where(left % 2 == 1, last, other)
            step = np.where(self.role[x][:, None] == want, 0, REROLE) + self.late[x][:, None]
            step[self.must[x]] = NONE
            np.minimum(base, np.where(left >= 1, before + step, NONE), out=base)
            base[:, left < 0] = NONE
            table[x] = np.minimum(np.minimum.accumulate(base - INSERT * at, axis=1) + INSERT * at, NONE)
            table[x][:, left < 0] = NONE
        return table

    def _behind_s(self, plain: np.ndarray) -> np.ndarray:
        table = np.full_like(plain, NONE)
        for x in range(1, len(plain)):
            table[x][:, :-1] = table[x - 1][:, 1:] + DELETE
            kept = plain[x - 1][:, 1:] + self.late[x][:, None]
            kept[(self.role[x] != 0) | self.must[x]] = NONE
            np.minimum(table[x][:, :-1], kept, out=table[x][:, :-1])
        return np.minimum(table, NONE)

    def ends(self, k: int, entry: int) -> dict[int, tuple[int, list]]:
        """For each state after the turns: least cost from ``entry``, and what attains it, (table, target length)."""
        x = int(self.length[k])
        left = x + np.arange(self.width) - self.down
        out: dict[int, tuple[int, list]] = {}
        if entry in (NOTHING, AFTER_S):
            out[entry] = (DELETE * x, [("all", 0)])
        if entry == NOTHING:
            late = [DELETE * (x - 1) + int(self.late[y, k]) for y in range(1, x + 1)
                    if self.role[y, k] == 0 and not self.must[y, k]]
            if late:
                out[AFTER_S] = (min(late), [("lone s", 0)])
        for end in (AFTER_U, AFTER_A):
            even = (end == AFTER_A) != (entry == AFTER_U)
            fits = (left % 2 == (0 if even else 1)) & (left >= (0 if entry in (AFTER_U, AFTER_A) else 1))
            rows = [("plain", self.plain[end][x, k])]
            if entry == NOTHING:
                rows.append(("s", self.with_s[end][x, k]))
            best = min(int(np.where(fits, row, NONE).min()) for _, row in rows)
            if best < NONE:
                out[end] = (best, [(name, int(r)) for name, row in rows for r in left[fits & (row == best)]])
        return out

    def audits(self, wanted: list[tuple[int, int, str, int]]) -> list[str]:
        """First audit in ASCII of each (conversation, end state, table, target length) along least costs."""
        out: list[str] = [""] * len(wanted)
        traced = []
        for j, (k, _, name, _) in enumerate(wanted):
            x = int(self.length[k])
            if name == "all":
                out[j] = "D" * x
            elif name == "lone s":
                least = min(int(self.late[y, k]) for y in range(1, x + 1) if self.role[y, k] == 0 and not self.must[y, k])
                keep = min(y for y in range(1, x + 1)
                           if self.role[y, k] == 0 and not self.must[y, k] and self.late[y, k] == least)
                out[j] = "D" * (x - keep) + "K" + "D" * (keep - 1)
            else:
                traced.append(j)
        if not traced:
            return out
        k = np.array([wanted[j][0] for j in traced])
        end = np.array([wanted[j][1] for j in traced])
        in_s = np.array([wanted[j][2] == "s" for j in traced])
        x = self.length[k].copy()
        o = np.array([wanted[j][3] for j in traced]) - x + self.down
        tables = np.stack([self.plain[AFTER_U], self.plain[AFTER_A], self.with_s[AFTER_U], self.with_s[AFTER_A]])
        letters: list[np.ndarray] = []

        def cell(s, xs, os):
            ok = (os >= 0) & (os < self.width) & (xs >= 0)
            return np.where(ok, tables[s, np.maximum(xs, 0), k, np.clip(os, 0, self.width - 1)], NONE)

        while (x > 0).any():
            live = x > 0
            now = (end == AFTER_A) + 2 * in_s
            plain = (end == AFTER_A).astype(np.int64)
            cost = cell(now, x, o)
            left = x + o - self.down
            role, must, late = self.role[x, k], self.must[x, k], self.late[x, k]
            want = np.where(left % 2 == 1, np.where(end == AFTER_A, 2, 1), np.where(end == AFTER_A, 1, 2))
            delete = cell(now, x - 1, o + 1) + DELETE == cost
            insert = ~in_s & (left >= 1) & (cell(now, x, o - 1) + INSERT == cost)
            behind = np.where(in_s, cell(plain, x - 1, o + 1), cell(plain, x - 1, o))
            fits = np.where(in_s, role == 0, (role == want) & (left >= 1)) & ~must
            keep = fits & (behind + late == cost)
            letter = np.select([~live, delete, insert, keep], [0, ord("D"), ord("I"), ord("K")], ord("R"))
            letters.append(letter.astype(np.uint8))
            gone, put = live & (letter == ord("D")), live & (letter == ord("I"))
            kept_s = live & in_s & (letter == ord("K"))
            o = o + gone - put + kept_s
            x = x - (live & ~put)
            in_s = in_s & ~kept_s
        written = np.stack(letters, axis=1)
        for row, j in zip(written, traced):
            out[j] = row[row > 0].tobytes().decode()
        return out


def simple_cost(c: np.ndarray, f: np.ndarray) -> int:
    """Cost of a plain repair: what must go goes, the rest alternates, an odd turn is answered."""
    stay = c[(f != 1) & (f != 2)]
    cost = DELETE * (len(c) - len(stay)) + TRUNCATED * int((f == 3).sum())
    lead = int(len(stay) > 0 and stay[0] == 0)
    rest = stay[lead:]
    cost += REROLE * int((rest != 1 + np.arange(len(rest)) % 2).sum()) + INSERT * (len(rest) % 2)
    if lead and not len(rest):
        cost += 2 * INSERT
    return min(cost, DELETE * len(c))


def _batches(turns: list, bound: np.ndarray) -> Iterator[np.ndarray]:
    """Indexes of conversations that fill tables together: of like length and bound."""
    lengths = np.array([len(c) for c, _ in turns])
    todo = np.lexsort((bound, lengths))
    lo = 0
    while lo < len(todo):
        hi = lo + 1
        while hi < len(todo):
            cells = (hi + 1 - lo) * (lengths[todo[hi]] + 1) * (bound[todo[lo:hi + 1]].max() + 3)
            if cells > CELLS or lengths[todo[hi]] > 2 * lengths[todo[lo]] + 8:
                break
            hi = min(len(todo), hi + max(1, (hi - lo) // 2))
        yield todo[lo:hi]
        lo = hi


def repair_whole(turns: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, str]]:
    """Cost and audit of each conversation, given as role codes and faults; none is empty."""
    out: list = [None] * len(turns)
    bound = np.array([simple_cost(c, f) for c, f in turns], dtype=np.int64)
    for batch in _batches(turns, bound):
        aligner = Aligner([turns[k] for k in batch], bound[batch])
        wanted, owner, costs = [], [], []
        for j, k in enumerate(batch.tolist()):
            ends = aligner.ends(j, NOTHING)
            best = min(cost + AT_END[e] for e, (cost, _) in ends.items())
            assert best <= bound[k]                           # the band holds every alignment up to the simple repair's cost
            costs.append(best)
            for e, (cost, how) in ends.items():
                if cost + AT_END[e] == best:
                    wanted += [(j, e, name, r) for name, r in how]
                    owner += [(j, "I" * len(TAIL[e]))] * len(how)
        least: dict[int, str] = {}
        for (j, tail), audit in zip(owner, aligner.audits(wanted)):
            least[j] = min(least.get(j, "~"), audit + tail)
        for j, k in enumerate(batch.tolist()):
            out[k] = (costs[j], least[j])
    return out


def piece_table(c: np.ndarray, f: np.ndarray) -> tuple[list[int], list[str]]:
    """Least cost and first audit of a piece for each pair of states before and after it (row by row)."""
    if not len(c):
        return [0 if a == b else NONE for a in range(STATES) for b in range(STATES)], [""] * STATES * STATES
    most = DELETE * len(c) + 2 * INSERT
    bound = min(most, simple_cost(c, f) + 12)
    while True:
        aligner = Aligner([(c, f)], np.array([bound]))
        ends = [aligner.ends(0, e) for e in range(STATES)]
        reached = [cost for e in ends for cost, _ in e.values()]
        short = any(s not in ends[e] for e in range(STATES) for s in (AFTER_U, AFTER_A))
        if bound >= most or not short and max(reached) <= bound:
            break
        bound = min(most, 2 * bound)
    costs, audits = [NONE] * STATES * STATES, [""] * STATES * STATES
    for e in range(STATES):
        for s, (cost, how) in ends[e].items():
            costs[e * STATES + s] = cost
            audits[e * STATES + s] = min(aligner.audits([(0, s, name, r) for name, r in how]))
    return costs, audits


def edited(roles: list, texts: list, audit: str, state: int = NOTHING) -> list[str]:
    """The repaired turns, ``role:text``."""
    out, k = [], 0
    for letter in audit:
        if letter == "D":
            k += 1
            continue
        turn = 2 if state == AFTER_U else 1
        if letter == "I":
            out.append(f"{NAMES[turn]}:")
        else:
            name = roles[k] if letter == "K" else NAMES[turn]
            out.append(f"{name}:{texts[k]}")
            if letter == "K" and state == NOTHING and roles[k][:1] == "s":
                turn = 0
            k += 1
        state = (AFTER_S, AFTER_U, AFTER_A)[turn]
    return out


def illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def gaps(numbers: list) -> int:
    known = {t for t in numbers if t is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


# --- Spark: pieces of a partition ----------------------------------------------------------------

SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _summaries(done: list[Turns], keep: bool) -> list[tuple]:
    found = [(codes(t.roles), faults(t.roles, t.texts)) for t in done]
    full = [k for k, t in enumerate(done) if t.roles]
    repaired = dict(zip(full, repair_whole([found[k] for k in full]))) if full else {}
    rows = []
    for k, t in enumerate(done):
        cost, audit = repaired.get(k, (0, ""))
        lines = edited(t.roles, t.texts, audit)
        f = found[k][1]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        rows.append((t.key, None, None, None, None, lines if keep else None, gaps(t.numbers), int((f == 1).sum()), int((f == 2).sum()),
                     int((f == 3).sum()), illegal([r[:1] for r in t.roles]), cost, audit, digest))
    return rows


def _split(schema: pa.Schema, keep: bool):
    """Conversations of a sorted partition: repaired where they lie inside it, else cut into pieces."""
    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Turns | None = None
        cut, pieces, part = True, 0, 0
        done: list[Turns] = []
        out: list[tuple] = []

        def piece() -> tuple:
            return (now.key, (part << 40) + pieces, now.roles, now.texts, now.numbers, *[None] * 9)

        for batch in batches:
            for key, number, role, text, copies, part in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or key != now.key:
                    if now is not None and cut:
                        out.append(piece())
                        pieces += 1
                    elif now is not None:
                        done.append(now)
                    cut = now is None                       # the partition's first one may have begun before it
                    now = Turns(key)
                for _ in range(copies):
                    now.add(role, text, number)
                    if len(now.roles) >= PIECE_TURNS or now.chars >= PIECE_CHARS:
                        out.append(piece())
                        pieces, cut, now = pieces + 1, True, Turns(key)
            if len(done) >= 4000:
                out += _summaries(done, keep)
                done = []
            if out:
                yield table(out)
                out = []
        if now is not None:
            out.append(piece())                             # the last one may go on
        out += _summaries(done, keep)
        if out:
            yield table(out)

    return run


def _piece_meta(roles: pa.Array, texts: pa.Array, numbers: pa.Array, first: pa.Array) -> pa.Array:
    rows = []
    for r, t, u, fresh in zip(roles.to_pylist(), texts.to_pylist(), numbers.to_pylist(), first.to_pylist()):
        f = faults(r, t, [k in set(fresh) for k in range(len(r))])
        costs, audits = piece_table(codes(r), f)
        order = {a: k for k, a in enumerate(sorted(set(audits)))}
        known = [x for x in u if x is not None]
        rows.append({"costs": costs, "ranks": [order[a] for a in audits], "blank": int((f == 1).sum()),
                     "duplicate": int((f == 2).sum()), "truncated": int((f == 3).sum()), "illegal": illegal([x[:1] for x in r]),
                     "head": r[0][:1] if r else None, "last": r[-1][:1] if r else None, "low": min(known, default=None),
                     "high": max(known, default=None), "numbers": len(set(known))})
    return pa.array(rows, META)


META = pa.struct([("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int32())), ("blank", pa.int64()), ("duplicate", pa.int64()),
                  ("truncated", pa.int64()), ("illegal", pa.int64()), ("head", pa.string()), ("last", pa.string()),
                  ("low", pa.int64()), ("high", pa.int64()), ("numbers", pa.int64())])
META_SQL = ("struct<costs: array<bigint>, ranks: array<int>, blank: bigint, duplicate: bigint, truncated: bigint, illegal: bigint,"
            " head: string, last: string, low: bigint, high: bigint, numbers: bigint>")


def choose(pieces: pd.DataFrame) -> pd.DataFrame:
    """States before and after each piece of one conversation, in order, and its totals (on every row)."""
    pieces = pieces.sort_values("piece")
    costs = [np.array(c, dtype=np.int64).reshape(STATES, STATES) for c in pieces["costs"]]
    ranks = [np.array(c, dtype=np.int64).reshape(STATES, STATES) for c in pieces["ranks"]]
    rest = [np.array(AT_END, dtype=np.int64)]
    for c in reversed(costs):
        rest.append((c + rest[-1][None, :]).min(axis=1))
    rest.reverse()
    before, after, state = [], [], NOTHING
    for c, r, to_go in zip(costs, ranks, rest[1:]):
        total = c[state] + to_go
        best = np.flatnonzero(total == total.min())
        end = int(best[np.argmin(r[state][best])])
        before.append(state)
        after.append(end)
        state = end
    seen = pieces[pieces["head"].notna()]
    edges = [a + b for a, b in zip(seen["last"].iloc[:-1], seen["head"].iloc[1:])]
    dated = pieces[pieces["numbers"] > 0]
    twice = int((dated["high"].to_numpy()[:-1] == dated["low"].to_numpy()[1:]).sum())
    span = int(dated["high"].max() - dated["low"].min() + 1 - dated["numbers"].sum() + twice) if len(dated) else 0
    return pd.DataFrame({
        "piece": pieces["piece"].to_numpy(), "before": before, "after": after,
        "tail": [TAIL[state] if k == len(costs) - 1 else "" for k in range(len(costs))],
        "gaps": span, **{c: int(pieces[c].sum()) for c in ("blank", "duplicate", "truncated")},
        "illegal": int(pieces["illegal"].sum()) + sum(e not in ("su", "ua", "au") for e in edges), "cost": int(rest[0][NOTHING])})


def _traced(roles: pa.Array, texts: pa.Array, first: pa.Array, before: pa.Array, after: pa.Array, tail: pa.Array) -> pa.Array:
    rows = []
    for r, t, fresh, a, b, more in zip(*(c.to_pylist() for c in (roles, texts, first, before, after, tail))):
        fresh = set(fresh)
        audit = piece_table(codes(r), faults(r, t, [k in fresh for k in range(len(r))]))[1][a * STATES + b]
        rows.append({"audit": audit + "I" * len(more),
                     "lines": edited(r, t, audit, a) + [f"{NAMES[ROLE[x]]}:" for x in more]})
    return pa.array(rows, pa.struct([("audit", pa.string()), ("lines", pa.list_(pa.string()))]))


def _joined(schema: pa.Schema):
    """One row per conversation of sorted pieces: audits in a row, hash over the lines as they come."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, audit, totals, some, open_ = None, None, [], (), False, False

        def row() -> pa.RecordBatch:
            values = (key, *totals, "".join(audit), digest.hexdigest())
            return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(values, schema)], schema=schema)

        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for conv, letters, lines, *own in zip(*cols):
                if not open_ or conv != key:
                    if open_:
                        yield row()
                    key, digest, audit, some, open_ = conv, hashlib.sha256(), [], False, True
                totals = tuple(own)
                audit.append(letters)
                for line in lines:
                    digest.update((b"\n" if some else b"") + line.encode())
                    some = True
        if open_:
            yield row()

    return run


def _segments(rows: DataFrame, keep: bool) -> tuple[DataFrame, DataFrame]:
    """Whole conversations with their summary (and lines, if kept), and the pieces of the others with audit, lines
    and the totals of their conversation."""
    spark = rows.sparkSession
    order = [F.col("conv").asc_nulls_first(), F.col("number").asc_nulls_first(), F.col("role"), F.col("text")]
    ranged = (rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
              .sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))
    conv = rows.schema["conv"].dataType.simpleString()
    out = (f"conv {conv}, piece long, roles array<string>, texts array<string>, numbers array<long>, lines array<string>, " + SUMMARY)
    arrow = _arrow(spark, out)
    cut = store(ranged.mapInArrow(_split(arrow, keep), out), "repair-pieces")
    whole = cut.where("piece IS NULL")
    pieces = cut.where("piece IS NOT NULL").select("conv", "piece", "roles", "texts", "numbers")
    single = pieces.select("conv", "piece", F.posexplode(F.arrays_zip("roles", "texts")).alias("at", "e"))
    digest = F.sha2(F.concat(F.length("e.roles").cast("string"), F.lit(":"), F.col("e.roles"), F.col("e.texts")), 256)
    first = (single.groupBy("conv", digest.alias("d")).agg(F.min(F.struct("piece", "at")).alias("f"))
             .groupBy(F.col("f.piece").alias("piece")).agg(F.collect_list("f.at").alias("first")))
    pieces = store(pieces.join(first, "piece", "left")
                   .withColumn("first", F.coalesce("first", F.array().cast("array<int>"))), "repair-firsts")
    meta = F.arrow_udf(_piece_meta, META_SQL).asNondeterministic()
    tables = pieces.select("conv", "piece", meta("roles", "texts", "numbers", "first").alias("m")).select("conv", "piece", "m.*")
    chosen = store(tables.groupBy("conv").applyInPandas(
        choose, "piece long, before int, after int, tail string, gaps long, blank long, duplicate long, truncated long,"
                " illegal long, cost long"), "repair-choices")
    traced = F.arrow_udf(_traced, "struct<audit: string, lines: array<string>>").asNondeterministic()
    done = (pieces.join(chosen, "piece").withColumn("r", traced("roles", "texts", "first", "before", "after", "tail"))
            .select("conv", "piece", "r.audit", "r.lines", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    return whole, done


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def as_rows(turns: DataFrame, conv: str = "conv_id", number: str = "turn", role: str = "role", text: str = "text",
            copies: str | None = None) -> DataFrame:
    """conv, number, role, text, copies (how often the turn stands there; a conversation of none is kept)."""
    return turns.select(F.col(conv).alias("conv"), F.col(number).cast("long").alias("number"),
                        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
                        (F.col(copies) if copies else F.lit(1)).cast("int").alias("copies"))


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation: faults, cost and audit of its repair, and the hash of the repaired turns (``role:text``,
    joined by newlines).  ``rows`` as ``as_rows`` gives them."""
    whole, pieces = _segments(rows, keep=False)
    names = ["conv", *[f.split()[0] for f in SUMMARY.split(", ")]]
    schema = f"conv {rows.schema['conv'].dataType.simpleString()}, {SUMMARY}"
    ordered = (pieces.select("conv", "audit", "lines", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "piece")
               .repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "piece").drop("piece"))
    return whole.select(*names).unionByName(ordered.mapInArrow(_joined(_arrow(rows.sparkSession, schema)), schema))


def repaired_turns(rows: DataFrame) -> DataFrame:
    """conv, piece (null: the whole), place in it and line (``role:text``) of the repaired conversations."""
    whole, pieces = _segments(rows, keep=True)
    both = whole.select("conv", "piece", "lines").unionByName(pieces.select("conv", "piece", "lines"))
    return both.select("conv", "piece", F.posexplode("lines").alias("place", "line"))

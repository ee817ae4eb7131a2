"""Quality rules and an isolation forest on their statistics.

Each text gets rule statistics; two base rules fail it at once.  The other verdict comes from an
isolation forest: trees of random splits over the statistics, drawn from the range of all labelled
rows, whose nodes hold every good row of the half (by hash of the id) that fills the trees.  A document
that random splits separate after few steps is an anomaly; the threshold on its score is calibrated on
every labelled row of the other half.

No row is sampled: ranges, leaves and gains are aggregates over all labelled rows.  The splits don't hang
on rows, so a row is only counted in one leaf of each tree; the driver gets the ranges, the filled leaves
(at most ``TREES`` * 2 ** ``TREE_DEPTH`` numbers, whatever the input) and the threshold.
All statistics cover whole texts and every document.

Defined results: null text has no words (and fails the base rule); without labelled rows of both
kinds only the base rules decide; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import (IS_WORD, RangeHash, chunks, likely_in, map_batches, mix, store, text_bytes, window_hashes,
                                 words)
from ratewise.operators.ranking import prefix_scan

SYMBOLS = b"#*$%&|<>"       # fixed by the contract
MIN_WORDS = 50              # base rules, fixed by the contract
MAX_REPEAT_PERCENT = 50
TREES, TREE_DEPTH = 128, 10
SYMBOL_SCALE = 0.05         # symbols a word at which that statistic is half of its range
GOOD_COST = 10              # a good row lost weighs as much as so many bad rows kept

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_digits", "n_punct", "n_letters")

_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_IS_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_IS_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_IS_LETTER = _IS_UPPER | (np.arange(256) >= 97) & (np.arange(256) <= 122) | (np.arange(256) >= 192)
_IS_PUNCT = (np.arange(256) > 32) & (np.arange(256) < 127) & ~_IS_LETTER & ~_IS_DIGIT & ~_IS_SYMBOL
_IS_FIRST = (np.arange(256) < 128) | (np.arange(256) >= 192)     # first byte of a code point


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeats(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
    """True where a row holds the key twice or more."""
    own = mix(keys ^ mix(row.astype(np.uint64)))
    _, inverse, counts = np.unique(own, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def rule_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``COUNTS`` for each text of a chunk."""
    n = len(offsets) - 1
    out = np.zeros((n, len(COUNTS)), dtype=np.int64)
    if not len(data):
        out[:, 5] = 1
        return out
    hashes = RangeHash(data)
    start, end, row = words(data, offsets)
    out[:, 0] = np.bincount(row, minlength=n)
    out[:, 1] = _per_row(IS_WORD[data] & _IS_FIRST[data], offsets)
    for k, table in ((2, _IS_SYMBOL), (6, _IS_UPPER), (7, _IS_DIGIT), (8, _IS_PUNCT), (9, _IS_LETTER)):
        out[:, k] = _per_row(table[data], offsets)

    # lines: a text is cut at \n; those with a word that equal an earlier one
    feeds = np.flatnonzero(data == 10)
    first = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
    of = np.searchsorted(offsets[1:], feeds, side="right")
    line_row = np.sort(np.concatenate([np.arange(n), of]), kind="stable")
    last = np.append(first[1:], 0)
    ends_row = np.append(line_row[1:] != line_row[:-1], True)
    last = np.where(ends_row, offsets[line_row + 1], last - 1)
    out[:, 5] = np.bincount(line_row, minlength=n)
    inside = np.concatenate([[0], np.cumsum(IS_WORD[data])])
    wordy = inside[last] > inside[first]
    key = mix(hashes.of(first[wordy], last[wordy]) ^ mix(line_row[wordy].astype(np.uint64)))
    _, once = np.unique(key, return_index=True)
    out[:, 3] = (np.bincount(line_row[wordy], minlength=n)
                 - np.bincount(line_row[wordy][once], minlength=n))

    # words inside a 3-word window that the text holds twice or more
    windows, at = window_hashes(hashes.of(start, end), row, 3)
    if len(at):
        again = at[_repeats(windows, row[at])]
        covered = np.zeros(len(start), dtype=bool)
        for k in range(3):
            covered[again + k] = True
        out[:, 4] = np.bincount(row[covered], minlength=n)
    return out


def features(counts: np.ndarray) -> np.ndarray:
    """Rule statistics the forest splits on: sizes, ratios and densities of the counts."""
    c = counts.astype(float)
    n_words, chars = np.maximum(c[:, 0], 1), np.maximum(c[:, 1], 1)
    lines = np.maximum(c[:, 5], 1)
    symbols = c[:, 2] / n_words
    return np.column_stack([
        np.log1p(c[:, 0]), c[:, 1] / n_words, symbols / (symbols + SYMBOL_SCALE), c[:, 3] / lines, c[:, 4] / n_words,
        np.log1p(c[:, 0] / lines), c[:, 6] / chars, c[:, 7] / chars, c[:, 8] / chars, c[:, 9] / chars])


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])


class IsolationForest:
    """Complete binary trees as arrays: feature and split of every inner node, path length of every leaf."""

    def __init__(self, seed: int = 4):
        self.seed = seed

    @staticmethod
    def _rest(n: np.ndarray | float) -> np.ndarray:
        """Average path length below a leaf that holds n rows."""
        n = np.asarray(n, dtype=float)
        m = np.maximum(n, 2)
        return np.where(n <= 1, 0.0, 2 * (np.log(m - 1) + 0.5772156649) - 2 * (m - 1) / m)

    def draw(self, low: np.ndarray, high: np.ndarray) -> IsolationForest:
        """Splits at random places of the box between ``low`` and ``high``; no row is needed for them."""
        rng = np.random.default_rng(self.seed)
        inner = (1 << TREE_DEPTH) - 1
        self.feature = np.zeros((TREES, inner), dtype=np.int8)
        self.split = np.full((TREES, inner), np.inf)
        wide = np.flatnonzero(high > low)
        lo, hi = (np.broadcast_to(x, (TREES, 1, len(x))).copy() for x in (low, high))
        for depth in range(TREE_DEPTH if len(wide) else 0):
            width = 1 << depth
            f = wide[rng.integers(len(wide), size=(TREES, width))]
            at = f[:, :, None]
            s = rng.uniform(np.take_along_axis(lo, at, 2)[:, :, 0], np.take_along_axis(hi, at, 2)[:, :, 0])
            self.feature[:, width - 1:2 * width - 1], self.split[:, width - 1:2 * width - 1] = f, s
            lo, hi = np.repeat(lo, 2, axis=1), np.repeat(hi, 2, axis=1)
            np.put_along_axis(hi[:, 0::2], at, s[:, :, None], 2)
            np.put_along_axis(lo[:, 1::2], at, s[:, :, None], 2)
        return self

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row in every tree: one row a tree."""
        inner = self.feature.shape[1]
        out = np.zeros((len(self.feature), len(x)), dtype=np.int64)
        for t, (feature, split) in enumerate(zip(self.feature, self.split)):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(TREE_DEPTH):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] >= split[node])
            out[t] = node - inner
        return out

    def fill(self, rows: np.ndarray) -> IsolationForest:
        """Path lengths from the rows in the leaves (trees x leaves): a path ends at the first node with one row or none."""
        self.length = TREE_DEPTH + self._rest(rows)
        for depth in range(TREE_DEPTH - 1, -1, -1):
            below = 1 << (TREE_DEPTH - depth)
            own = np.repeat(rows.reshape(len(rows), -1, below).sum(axis=2), below, axis=1)
            self.length = np.where(own <= 1, depth, self.length)
        self.scale = float(self._rest(max(2, int(rows[0].sum()))))
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / expected): near 1 for anomalies."""
        total = np.zeros(len(x))
        for leaf, length in zip(self.leaves(x), self.length):
            total += length[leaf]
        return 2.0 ** (-(total / len(self.feature)) / self.scale)


def calibrated(scored: DataFrame) -> float:
    """The threshold that catches most bad rows less ``GOOD_COST`` times the good rows lost, over all rows of
    ``scored`` (score, good); a score above it is an anomaly."""
    by_score = scored.groupBy((-F.col("score")).alias("down")).agg(        # a cut lies between different scores
        F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b"))
    scanned = prefix_scan(by_score, [], "down", ["g", "b"])
    goods, bads = scanned.agg(F.sum("g"), F.sum("b")).first()
    gain = F.col("cum_b") / max(1, bads or 0) - GOOD_COST * F.col("cum_g") / max(1, goods or 0)
    best = scanned.select(gain.alias("gain"), "down", "next_down").orderBy(F.desc("gain"), "down").first()
    if best is None or best.gain <= 0:
        return float("inf")
    return -(best.down + best.next_down) / 2 if best.next_down is not None else -best.down - 1e-9


def _counts_of(texts: pa.Array) -> np.ndarray:
    parts = [rule_counts(data, offsets) for _, _, data, offsets in chunks(texts)]
    return np.vstack(parts) if parts else np.zeros((0, len(COUNTS)), np.int64)


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """grow, good and x (the statistics) of every row of ``docs`` with a label that passes the base rules, stored."""
    known = store(labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
                  .groupBy(F.col(id_col).cast("long").alias("id")).agg((F.max(label_col) > 0).alias("good")), "quality-labels")

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        counts = _counts_of(b.column("text"))
        left = ~base_failed(counts)
        ids = b.column("id").to_numpy(zero_copy_only=False)[left].astype(np.int64)
        grow = mix(ids.astype(np.uint64)) % np.uint64(2) == 0    # half fills the trees, half sets the threshold
        return pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(grow), pa.array(list(features(counts[left])), pa.list_(pa.float64()))], ["id", "grow", "x"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("text"))
    rows = rows.where(F.col("id").isNotNull() & likely_in(known.select("id"))(F.col("id")))
    return store(map_batches(rows, run, "id long, grow boolean, x array<double>").join(known, "id")
                 .select("grow", "good", "x"), "quality-labelled")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def fit_forest(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               label_col: str = "quality") -> tuple[IsolationForest, float] | None:
    """Forest and threshold from all labelled rows, or None when a kind is missing."""
    rows = _labelled(docs, labels, id_col, text_col, label_col)
    n = rows.agg(F.count_if(F.col("grow") & F.col("good")), F.count_if(~F.col("grow") & F.col("good")),
                 F.count_if(~F.col("grow") & ~F.col("good"))).first()
    if not all(n):
        return None
    width = len(features(np.zeros((1, len(COUNTS)), np.int64))[0])
    span = rows.where("grow").agg(*[bound(F.col("x")[k]) for bound in (F.min, F.max) for k in range(width)]).first()
    forest = IsolationForest().draw(np.array(span[:width]), np.array(span[width:]))
    drawn = docs.sparkSession.sparkContext.broadcast(forest)

    def count(batches):
        held, leaves = np.zeros(TREES << TREE_DEPTH, np.int64), np.arange(TREES)[:, None] << TREE_DEPTH
        for b in batches:
            if b.num_rows:
                held += np.bincount((leaves + drawn.value.leaves(_matrix(b.column("x")))).ravel(), minlength=len(held))
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], ["leaf", "n"])

    filled = (rows.where(F.col("grow") & F.col("good")).select("x").mapInArrow(count, "leaf long, n long")
              .groupBy("leaf").agg(F.sum("n").alias("n")).toArrow())         # TREES << TREE_DEPTH rows at most
    held = np.zeros(TREES << TREE_DEPTH, np.int64)
    held[filled["leaf"].to_numpy()] = filled["n"].to_numpy()
    ready = docs.sparkSession.sparkContext.broadcast(forest.fill(held.reshape(TREES, -1)))

    def score(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ready.value.score(_matrix(b.column("x")))), b.column("good")], ["score", "good"])

    rest = map_batches(rows.where(~F.col("grow")).select("x", "good"), score, "score double, good boolean")
    return forest, calibrated(rest)


VERDICT = "struct<" + ",".join(f"{n}:long" for n in COUNTS) + ",base_failed:boolean,anomaly:double,kept:boolean>"


def quality(docs: DataFrame, labels: DataFrame, text: str | Column = "text", **columns: str) -> Column:
    """Column of the counts, base_failed, anomaly score and verdict of a text."""
    shared = docs.sparkSession.sparkContext.broadcast(fit_forest(docs, labels, **columns))

    def run(texts: pa.Array) -> pa.Array:
        counts = _counts_of(texts)
        failed = base_failed(counts)
        anomaly, kept = np.zeros(len(counts)), ~failed
        if shared.value is not None:
            forest, threshold = shared.value
            anomaly = forest.score(features(counts))
            kept = kept & (anomaly <= threshold)
        return pa.StructArray.from_arrays(
            [*(pa.array(counts[:, k]) for k in range(len(COUNTS))), pa.array(failed), pa.array(anomaly), pa.array(kept)],
            [*COUNTS, "base_failed", "anomaly", "kept"])

    return F.arrow_udf(run, VERDICT).asNondeterministic()(text_bytes(text))

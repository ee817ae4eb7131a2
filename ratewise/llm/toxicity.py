"""Toxicity by the nearest labelled examples.

Labelled examples are TF-IDF vectors (terms: runs of letters, A-Z lower-cased; weight
(1 + ln tf) * idf, unit length, over the terms whose presence depends on the label by a chi-square
test) in an inverted index.  The examples lie in blocks; for
every term and block the index holds the largest weight.  A text's upper bounds of all blocks are
summed first, blocks are scored from the highest bound down, and blocks whose bound is below the
k-th best cosine so far are skipped, so the k nearest are exact.  Their labels vote with weights that
fall with distance, and a logistic curve fitted to the examples' own votes (each against the others)
turns the vote into a score calibrated to the labels' base rate.

Sample bound: the ``EXAMPLES`` labelled training rows of lowest hash, half of them at most of each
label (documented parameter of the classifier).  Scoring reads whole texts.

Defined results: null text counts as empty; a text without an indexed term gets no neighbours and the
score of a zero vote; without examples of both labels every score is the base rate (0 when there are
none); equal cosines are ordered by example; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import LOWER, RangeHash, chunks, hash_sample, in_training_fold, mix, text_bytes, words
from ratewise.llm.hashtable import HashTable

EXAMPLES = 4096
BLOCK = 64                  # examples a block
NEIGHBOURS = 48
MIN_EXAMPLES = 5            # a term is indexed if so many examples have it
MIN_CHI_SQUARE = 20.0       # and its presence depends on the label (p < 0.00001)
VOTE_POWER = 2.0            # a vote weighs cosine ** VOTE_POWER
CALIBRATION = 1024          # examples whose own votes fit the curve
EVIDENCE = 3                # examples shown with a score
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def term_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, term hash, occurrences of the distinct terms of each row, ordered by row."""
    low = LOWER[data]
    start, end, row = words(low, offsets, LETTER)
    term = RangeHash(low).of(start, end)
    own = mix(term ^ mix(row.astype(np.uint64)))
    _, first, tf = np.unique(own, return_index=True, return_counts=True)
    order = np.argsort(row[first], kind="stable")
    return row[first][order], term[first][order], tf[order]


def chi_square(positive: np.ndarray, df: np.ndarray, positives: float, n: int) -> np.ndarray:
    """Pearson's statistic of presence against label: ``positive`` of the ``df`` examples that have
    the term are among the ``positives`` of ``n``."""
    expected = df * positives / n
    spread = expected * (1 - positives / n) * (1 - df / n)
    return (positive - expected) ** 2 / np.maximum(spread, 1e-12)


class BlockMaxIndex:
    """Inverted index of unit TF-IDF vectors with the largest weight of each term in each block."""

    def __init__(self, labels: np.ndarray, row: np.ndarray, term: np.ndarray, tf: np.ndarray,
                 min_examples: int = MIN_EXAMPLES, min_chi_square: float = MIN_CHI_SQUARE):
        """Examples with their labels; their terms as (row, term hash, occurrences)."""
        n = len(labels)
        self.labels, self.blocks = labels.astype(np.float64), max(1, -(-n // BLOCK))
        vocabulary, code, df = np.unique(term, return_inverse=True, return_counts=True)
        positive = np.bincount(code, self.labels[row], minlength=len(vocabulary))
        keep = (df >= min_examples) & (chi_square(positive, df, self.labels.sum(), n) >= min_chi_square)
        new = np.cumsum(keep) - 1
        self.idf = np.log((n + 1) / df[keep])
        self.vocabulary = HashTable(vocabulary[keep], np.zeros((int(keep.sum()), 0)))
        ok = keep[code]
        row, code, tf = row[ok], new[code[ok]], tf[ok]
        weight = (1 + np.log(tf)) * self.idf[code]
        norm = np.sqrt(np.bincount(row, weight * weight, minlength=n))
        weight = weight / np.maximum(norm[row], 1e-12)
        order = np.lexsort((row, code))
        self.example, self.weight = row[order].astype(np.int32), weight[order]
        cell = code[order] * self.blocks + self.example // BLOCK
        bounds = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.zeros(0, np.int64)
        # one entry for each (term, block) that occurs: the term's entries are consecutive
        self.cell_block = (cell[bounds] % self.blocks).astype(np.int32)
        self.cell_start = np.append(bounds, len(cell)).astype(np.int64)
        self.cell_max = np.maximum.reduceat(self.weight, bounds) if len(bounds) else np.zeros(0)
        self.term_cells = np.searchsorted(cell[bounds] // self.blocks, np.arange(len(self.idf) + 1))

    def vector(self, term: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexed terms of a text and their unit weights."""
        code = self.vocabulary.find(term)
        ok = code >= 0
        code = code[ok]
        weight = (1 + np.log(tf[ok])) * self.idf[code]
        return code, weight / max(1e-12, float(np.sqrt((weight * weight).sum())))

    @staticmethod
    def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
        """start[0], start[0]+1, ... (count[0] of them), start[1], ..."""
        total = int(count.sum())
        skip = np.repeat(start - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
        return np.arange(total) + skip

    def nearest(self, code: np.ndarray, weight: np.ndarray, k: int = NEIGHBOURS,
                skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine > 0 (``skip`` left out) and the cosines."""
        count = self.term_cells[code + 1] - self.term_cells[code]
        cells = self._ranges(self.term_cells[code], count)
        share = np.repeat(weight, count)
        block = self.cell_block[cells]
        bound = np.bincount(block, share * self.cell_max[cells], minlength=self.blocks)
        order = np.argsort(-bound, kind="stable")
        scores = np.zeros(self.blocks * BLOCK)
        done, threshold, step = 0, 0.0, max(2, self.blocks // 8)
        while done < self.blocks and bound[order[done]] > threshold:
            now = order[done:done + step]
            now = now[bound[now] > threshold]
            wanted = np.zeros(self.blocks, dtype=bool)
            wanted[now] = True
            pick = np.flatnonzero(wanted[block])
            size = self.cell_start[cells[pick] + 1] - self.cell_start[cells[pick]]
            at = self._ranges(self.cell_start[cells[pick]], size)
            scores += np.bincount(self.example[at], np.repeat(share[pick], size) * self.weight[at], minlength=len(scores))
            if skip >= 0:
                scores[skip] = 0.0
            done += step
            if len(scores) > k:
                threshold = max(0.0, float(np.partition(scores, -k)[-k]) - 1e-12)
        best = np.lexsort((np.arange(len(scores)), -scores))[:k] if len(scores) <= 4 * k else \
            self._top(scores, k)
        best = best[scores[best] > 0]
        return best, scores[best]

    @staticmethod
    def _top(scores: np.ndarray, k: int) -> np.ndarray:
        least = np.partition(scores, -k)[-k]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((some, -scores[some]))][:k]


def first_of_copies(row: np.ndarray, term: np.ndarray, n: int, bands: int = 6, width: int = 8) -> np.ndarray:
    """True for examples that repeat no earlier one: copies would vote many times and make any of
    their words look telling.  Copies share a band of min-hashes of their terms."""
    fresh = np.ones(n, dtype=bool)
    bounds = np.searchsorted(row, np.arange(n))
    some = np.bincount(row, minlength=n) > 0
    for band in range(bands):
        key = np.zeros(n, dtype=np.uint64)
        for k in range(width):
            low = np.minimum.reduceat(mix(term ^ np.uint64(band * width + k + 1)), bounds[some])
            key[some] = mix(key[some] ^ low)
        _, first = np.unique(key[some], return_index=True)
        again = np.ones(int(some.sum()), dtype=bool)
        again[first] = False
        fresh[np.flatnonzero(some)[again]] = False
    return fresh


class Scorer:
    """Index, labels and calibration curve."""

    def __init__(self, ids: list, labels: np.ndarray, texts: list[bytes], base_rate: float):
        self.ids, self.base_rate, self.index = ids, base_rate, None
        self.curve = (0.0, 0.0)
        if not len(labels) or labels.min() == labels.max():
            return
        parts = [(row + lo, term, tf) for lo, _, data, offsets in chunks(pa.array(texts, pa.binary()))
                 for row, term, tf in [term_counts(data, offsets)]]
        row, term, tf = (np.concatenate(x) for x in zip(*parts))
        fresh = first_of_copies(row, term, len(labels))
        labels, self.ids = labels[fresh], [i for i, f in zip(ids, fresh) if f]
        if labels.min() == labels.max():
            return
        own = fresh[row]
        row, term, tf = (np.cumsum(fresh) - 1)[row[own]], term[own], tf[own]
        self.index = BlockMaxIndex(labels, row, term, tf)
        bounds = np.searchsorted(row, np.arange(len(labels) + 1))
        votes = np.array([self.vote(term[bounds[k]:bounds[k + 1]], tf[bounds[k]:bounds[k + 1]], skip=k)[0]
                          for k in range(min(len(labels), CALIBRATION))])
        own = labels[:len(votes)]
        share = own.mean()
        weight = np.where(own > 0, base_rate / max(share, 1e-9), (1 - base_rate) / max(1 - share, 1e-9))
        self.curve = fitted_curve(votes, own, weight)

    def vote(self, term: np.ndarray, tf: np.ndarray, skip: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        """Weighted share of toxic neighbours; the neighbours and their cosines."""
        code, weight = self.index.vector(term, tf)
        if not len(code):
            return 0.0, np.zeros(0, np.int64), np.zeros(0)
        near, cosine = self.index.nearest(code, weight, skip=skip)
        power = cosine ** VOTE_POWER
        return float((power * self.index.labels[near]).sum() / max(1e-12, power.sum())), near, cosine

    def score(self, vote: float) -> float:
        a, b = self.curve
        return float(1 / (1 + np.exp(-np.clip(a + b * vote, -30, 30))))


def fitted_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.01) -> tuple[float, float]:
    """Intercept and slope of a weighted logistic regression, by Newton's method."""
    a = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        gradient = a.T @ (weight * (y - p)) - ridge * beta
        hessian = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(max(0.0, beta[1]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Scorer:
    """Index and curve from the sampled labelled rows of the training fold."""
    known = (labels.where(F.col(label_col).isNotNull() & in_training_fold(id_col))
             .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).alias("label"))
             .withColumn("label", (F.col("label") > 0).cast("int")))
    chosen = hash_sample(known, "label", EXAMPLES // 2, 2, "id")
    rows = (docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("text"))
            .join(F.broadcast(chosen), "id"))                    # EXAMPLES rows of three numbers
    got = sorted(zip(*(c.to_pylist() for c in rows.select(F.xxhash64(F.lit(2), "id"), "id", "label", "text").toArrow().columns)))
    rate = known.agg(F.avg("label")).first()[0]
    return Scorer([g[1] for g in got], np.array([g[2] for g in got], dtype=np.int64), [g[3] for g in got],
                  float(rate or 0.0))


RESULT = "struct<score:double,vote:double,evidence:array<struct<id:long,cosine:double,label:int>>>"


def toxicity(docs: DataFrame, labels: DataFrame, text: str | Column = "text", **columns: str) -> Column:
    """Column of struct<score, vote, evidence>: evidence holds the nearest examples that voted."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **columns))
    shown = pa.list_(pa.struct([("id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))

    def run(texts: pa.Array) -> pa.Array:
        scorer = shared.value
        scores, votes, evidence = [], [], []
        for _, _, data, offsets in chunks(texts):
            n = len(offsets) - 1
            if scorer.index is None:
                scores += [scorer.base_rate] * n
                votes += [0.0] * n
                evidence += [[]] * n
                continue
            row, term, tf = term_counts(data, offsets)
            bounds = np.searchsorted(row, np.arange(n + 1))
            for k in range(n):
                own = slice(bounds[k], bounds[k + 1])
                vote, near, cosine = scorer.vote(term[own], tf[own])
                votes.append(vote)
                scores.append(scorer.score(vote))
                evidence.append([{"id": scorer.ids[e], "cosine": float(c), "label": int(scorer.index.labels[e])}
                                 for e, c in zip(near[:EVIDENCE], cosine[:EVIDENCE])])
        return pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(votes, pa.float64()),
                                           pa.array(evidence, shown)], ["score", "vote", "evidence"])

    return F.arrow_udf(run, RESULT).asNondeterministic()(text_bytes(text))

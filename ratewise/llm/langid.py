"""Language identification by prediction by partial matching.

Per language, byte contexts of up to ``ORDER`` bytes form a context tree with frozen counts; a symbol
unseen in a context costs the context's escape probability (method C: distinct / (total + distinct))
and is sought in the next shorter context, down to a uniform byte.  A text's score under a language
is its exact code length; the shortest wins, and the score is the language's posterior under equal
priors.

The trees of all languages are laid out together: for every order, a hash table of the grams seen by
any language with the code length of each language (its escapes included), and one of the contexts
with the escape cost of each language.  A byte needs one look-up at the order where its gram is found.

Sample bound: per language, the ``SAMPLE_DOCS`` training rows of lowest hash, at most
``SAMPLE_BYTES`` of text in all (documented parameters of the classifier).  Prediction reads whole
texts.

Defined results: null text, or text without a letter, is ``und`` with score 0; without any training
row everything is ``und``; equal code lengths go to the first language by name; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import LOWER, chunks, hash_sample, in_training_fold, text_bytes
from ratewise.llm.hashtable import HashTable

ORDER = 4
SAMPLE_DOCS = 300
SAMPLE_BYTES = 400_000
UNKNOWN = "und"


def grams(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Key of the ``order`` bytes before each byte and that byte, and the positions that have them all
    inside their row."""
    n = len(data)
    key = np.zeros(n, dtype=np.uint64)
    for back in range(order, -1, -1):
        shifted = data if not back else np.concatenate([np.zeros(min(back, n), np.uint8), data[:max(0, n - back)]])
        key = (key << np.uint64(8)) | shifted.astype(np.uint64)
    inside = np.ones(n, dtype=bool)
    for k in range(order):
        at = offsets[:-1] + k
        inside[at[at < offsets[1:]]] = False
    return key, inside


class PpmModel:
    """Frozen context trees of several languages."""

    def __init__(self, texts: dict[str, list[bytes]]):
        self.languages = sorted(texts)
        width = len(self.languages)
        per: list[list[dict[str, np.ndarray]]] = []
        for lang in self.languages:
            data = LOWER[np.frombuffer(b"".join(texts[lang]), np.uint8)]
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts[lang]])]).astype(np.int64)
            orders = []
            for order in range(ORDER + 1):
                key, inside = grams(data, offsets, order)
                g, c = np.unique(key[inside], return_counts=True)
                ctx, at, distinct = np.unique(g >> np.uint64(8), return_index=True, return_counts=True)
                total = np.add.reduceat(c, at) if len(c) else c
                orders.append({"g": g, "c": c, "ctx": ctx, "total": total, "distinct": distinct})
            per.append(orders)
        self.grams: list[HashTable] = []
        self.contexts: list[HashTable] = []
        shorter: list = []
        for order in range(ORDER + 1):
            keys = np.unique(np.concatenate([p[order]["g"] for p in per])) if width else np.zeros(0, np.uint64)
            ctxs = np.unique(keys >> np.uint64(8))
            escape = np.zeros((len(ctxs), width))
            bits = np.zeros((len(keys), width))
            below = self._bits(keys & np.uint64((1 << (8 * order)) - 1), order - 1, width) if order else np.full((len(keys), width), 8.0)
            for k in range(width):
                o = per[k][order]
                i_ok, total, distinct = np.zeros(len(ctxs), dtype=bool), np.zeros(len(ctxs)), np.zeros(len(ctxs))
                if len(o["ctx"]):                            # none where all of a language's texts are shorter than the order
                    i = np.minimum(np.searchsorted(o["ctx"], ctxs), len(o["ctx"]) - 1)
                    i_ok = o["ctx"][i] == ctxs
                    total = np.where(i_ok, o["total"][i], 0).astype(float)
                    distinct = np.where(i_ok, o["distinct"][i], 0).astype(float)
                escape[:, k] = np.where(i_ok, -np.log2(np.maximum(distinct, 1) / np.maximum(total + distinct, 1)), 0.0)
                own = np.searchsorted(ctxs, keys >> np.uint64(8))
                seen, met = np.zeros(len(keys), dtype=bool), np.ones(len(keys))
                if len(o["g"]):
                    j = np.minimum(np.searchsorted(o["g"], keys), len(o["g"]) - 1)
                    seen = o["g"][j] == keys
                    met = np.where(seen, o["c"][j], 1)
                denominator = (total + distinct)[own]
                bits[:, k] = np.where(seen, np.log2(np.maximum(denominator, 1) / met), escape[own, k] + below[:, k])
            self.contexts.append(HashTable(ctxs, escape))
            self.grams.append(HashTable(keys, bits))

    def _bits(self, keys: np.ndarray, order: int, width: int) -> np.ndarray:
        """Code length of each gram (keys of ``order`` + 1 bytes) under each language."""
        out = np.zeros((len(keys), width), dtype=np.float32)
        left = np.arange(len(keys))
        for k in range(order, -1, -1):
            own = keys[left] & np.uint64((1 << (8 * (k + 1))) - 1)
            at = self.grams[k].find(own)
            hit = at >= 0
            out[left[hit]] += self.grams[k].values[at[hit]]
            left, own = left[~hit], own[~hit]
            if not len(left):
                return out
            ctx = self.contexts[k].find(own >> np.uint64(8))
            known = ctx >= 0
            out[left[known]] += self.contexts[k].values[ctx[known]]
        out[left] += 8.0
        return out

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each row of a chunk under each language."""
        width = len(self.languages)
        data = LOWER[data]
        bits = np.zeros((len(data), width), dtype=np.float32)
        full, inside = grams(data, offsets, ORDER)
        at = np.flatnonzero(inside)
        bits[at] = self._bits(full[at], ORDER, width)
        for order in range(ORDER):                       # the first bytes of a row have shorter contexts
            first = offsets[:-1] + order
            first = first[first < offsets[1:]]
            bits[first] = self._bits(full[first] & np.uint64((1 << (8 * (order + 1))) - 1), order, width)
        sums = np.zeros((len(data) + 1, width))
        np.cumsum(bits, axis=0, out=sums[1:], dtype=np.float64)
        return sums[offsets[1:]] - sums[offsets[:-1]]


_ASCII_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
    out = sums[offsets[1:]] > sums[offsets[:-1]]
    for k in np.flatnonzero(~out):
        row = data[offsets[k]:offsets[k + 1]]
        if len(row) and row.max() >= 128:
            out[k] = any(c.isalpha() for c in row.tobytes().decode("utf-8", "ignore"))
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> PpmModel:
    """Context trees from the sampled rows of the training fold."""
    rows = (docs.where(in_training_fold(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang"),
                    text_bytes(text_col).alias("text")))
    long = F.octet_length("text") > SAMPLE_BYTES // 8
    got = (hash_sample(rows, "lang", SAMPLE_DOCS, 5, "id", long, F.col("text"))
           .select("lang", "place", F.substring("text", 1, SAMPLE_BYTES).alias("text")).toArrow())
    texts: dict[str, list[bytes]] = {}
    held: dict[str, int] = {}
    for lang, _, text in sorted(zip(got["lang"].to_pylist(), got["place"].to_pylist(), got["text"].to_pylist())):
        if text and held.get(lang, 0) + len(text) <= SAMPLE_BYTES:
            texts.setdefault(lang, []).append(text)
            held[lang] = held.get(lang, 0) + len(text)
    return PpmModel(texts)


def detected(model: PpmModel, docs: DataFrame, text: str | Column = "text") -> Column:
    """Column of struct<lang, score, bits_per_byte> of a text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> pa.Array:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        best, score, rate = [], [], []
        for _, _, data, offsets in chunks(texts):
            n = len(offsets) - 1
            if not model.languages:
                best += [UNKNOWN] * n
                score += [0.0] * n
                rate += [0.0] * n
                continue
            bits = model.code_lengths(data, offsets)
            win = bits.argmin(axis=1)
            low = bits[np.arange(n), win]
            p = 1.0 / np.exp2(-np.minimum(bits - low[:, None], 1000)).sum(axis=1)
            known = has_letter(data, offsets)
            best += names[np.where(known, win, len(names) - 1)].tolist()
            score += np.where(known, p, 0.0).tolist()
            rate += (low / np.maximum(1, offsets[1:] - offsets[:-1])).tolist()
        return pa.StructArray.from_arrays(
            [pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64())],
            ["lang", "score", "bits_per_byte"])

    return F.arrow_udf(run, "struct<lang:string,score:double,bits_per_byte:double>").asNondeterministic()(text_bytes(text))


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` whose text has a language; same columns."""
    found = detected(train(docs, id_col, text_col, lang_col), docs, text_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), found.alias("found"))
    return rows.where(F.col("found.lang") != UNKNOWN).select("row.*")

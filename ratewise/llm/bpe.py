"""BPE encoding and decoding with a word-level vocabulary file (vocabulary, merges, word-end mark).

Text is cut at the special tokens, normalised (NFC, lower case), split into words, and each word is
merged over one contiguous array of part boundaries with the rank of every adjacent pair: scan for
the smallest rank, delete that boundary, refresh the two neighbouring ranks.  Words longer than
``LONG_WORD`` parts keep the same order of merges with a heap of (rank, place).  The vocabulary is
read once on the driver from ``path`` and broadcast (a fixed file of a few MB).

Defined results: null text encodes as empty; an empty text has no ids and decodes to the empty
string; bytes that are no UTF-8 become U+FFFD; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ratewise.llm.common import text_bytes

LONG_WORD = 64             # parts
CACHE_WORDS = 120_000      # words remembered per generation in a worker
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"   # Unicode White_Space
OTHER_SPLITS = regex.compile("[\x1c-\x1f]")       # str.split() cuts here, the vocabulary's pattern doesn't


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself if it is printable Latin-1, else the
    next free code point from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(spare)) for b in range(256)}


class WordBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.vocab: dict[str, int] = dict(model["vocab"])
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        # a pair of adjacent part ids -> rank; rank -> id of the merged part
        self.ranks = {self.vocab[a] << 32 | self.vocab[b]: k for k, (a, b) in enumerate(pairs)}
        self.merged = [self.vocab[a + b] for a, b in pairs]
        self.mark: str = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, k in [*self.vocab.items(), *self.special.items()]:
            self.tokens[k] = token
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(pattern.replace(r"\s", SPACE))
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")")
        letters = byte_letters()
        self.inner = [self.vocab[letters[b]] for b in range(256)]               # id of each byte inside a word,
        self.last = [self.vocab[letters[b] + self.mark] for b in range(256)]    # and at its end
        self.parts: dict[str, list[int]] = {}
        self.young: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}

    def merge(self, word: str) -> list[int]:
        """Ids of one pre-token: contiguous arrays of parts and of the ranks of adjacent parts."""
        data = word.encode("utf-8")
        inner, rank, merged, none = self.inner, self.ranks.get, self.merged, len(self.merged)
        parts = [inner[b] for b in data]
        parts[-1] = self.last[data[-1]]
        if len(parts) > LONG_WORD:
            return self._merge_long(parts)
        ranks = [rank(a << 32 | b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == none:
                break
            k = ranks.index(low)
            parts[k] = part = merged[low]
            del parts[k + 1], ranks[k]
            if k < len(ranks):
                ranks[k] = rank(part << 32 | parts[k + 1], none)
            if k:
                ranks[k - 1] = rank(parts[k - 1] << 32 | part, none)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same merges for a long word: linked parts, candidates in a heap by (rank, place)."""
        n = len(parts)
        after, before, alive = [*range(1, n + 1)], [*range(-1, n - 1)], [True] * n
        heap: list[tuple[int, int, int, int]] = []

        def offer(a: int) -> None:
            b = after[a]
            if b < n:
                r = self.ranks.get(parts[a] << 32 | parts[b])
                if r is not None:
                    heapq.heappush(heap, (r, a, parts[a], parts[b]))

        for a in range(n - 1):
            offer(a)
        while heap:
            r, a, left, right = heapq.heappop(heap)
            b = after[a]
            if not alive[a] or b >= n or parts[a] != left or parts[b] != right:
                continue
            parts[a], alive[b], after[a] = self.merged[r], False, after[b]
            if after[a] < n:
                before[after[a]] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        return [p for p, live in zip(parts, alive) if live]

    def _word(self, word: str) -> list[int]:
        """Ids of a run without white space, remembered."""
        ids = self.old.get(word)
        if ids is None:
            ids = []
            for part in self.split.findall(word):
                got = self.parts.get(part)
                if got is None:
                    got = self.merge(part)
                    if len(part) <= LONG_WORD:
                        self.parts[part] = got
                ids += got
        if len(self.young) >= CACHE_WORDS:
            self.old, self.young, self.parts = self.young, {}, {}
        if len(word) <= LONG_WORD:
            self.young[word] = ids
        return ids

    def _piece(self, text: str) -> list[int]:
        # lower-casing goes letter by letter, so a final sigma is no special case
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if OTHER_SPLITS.search(text):
            return [k for part in self.split.findall(text) for k in self.merge(part)]
        out: list[int] = []
        for word in text.split():
            ids = self.young.get(word)
            out += self._word(word) if ids is None else ids
        return out

    def encode(self, text: str) -> list[int]:
        if "<|" not in text and not any(t in text for t in self.special):
            return self._piece(text)
        out: list[int] = []
        for piece in self.cut.split(text):
            if piece in self.special:
                out.append(self.special[piece])
            elif piece:
                out += self._piece(piece)
        return out

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space: the file names no decoder."""
        tokens = self.tokens
        return " ".join([tokens[k] for k in ids])


_LOADED: dict[int, WordBpe] = {}


def load_spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _tokenizer(shared) -> WordBpe:
    """One encoder, with its cache, per worker and vocabulary."""
    if shared.id not in _LOADED:
        _LOADED.clear()
        _LOADED[shared.id] = WordBpe(shared.spec.value)
    return _LOADED[shared.id]


class _Shared:
    def __init__(self, spark: SparkSession, path: str):
        self.spec = spark.sparkContext.broadcast(load_spec(path))
        self.id = hash((path, id(self.spec)))


def encoded(spark: SparkSession, text: str | Column, path: str) -> Column:
    """Column of struct<ids array<int>, decoded string>: the text's ids and what they decode to."""
    shared = _Shared(spark, path)

    def run(texts: pa.Array) -> pa.Array:
        bpe = _tokenizer(shared)
        ids, ends, decoded = [], [0], []
        for t in texts:
            got = bpe.encode(t.as_buffer().to_pybytes().decode("utf-8", "replace"))
            ids.append(np.array(got, dtype=np.int32))
            ends.append(ends[-1] + len(got))
            decoded.append(bpe.decode(got))
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
             pa.array(decoded, pa.string())], ["ids", "decoded"])

    return F.arrow_udf(run, "struct<ids:array<int>,decoded:string>").asNondeterministic()(text_bytes(text))

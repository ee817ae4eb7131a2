"""Cross-entropy difference of documents under two matched bigram models.

The target model is counted on the documents labelled good, the background model on all documents.
Both share one vocabulary, the same bigram selection and the same smoothing, so per token only the
counts differ; a document's score is its background loss minus its target loss per token (higher:
more like the target).

Every word and every pair of words that occurs is kept, so the model grows with the input and is never
a broadcast.  Most pairs occur once, so a row a pair would outweigh the texts.  The rows are dealt to
blocks of about ``BLOCK_BYTES`` instead.  A block sends its distinct words and pairs, counted and packed,
to parts by the pair's first word; a part adds up what the blocks sent and answers each with the counts
of its words and pairs in the same order, a few bits each; a block's losses come from these.  Pairs whose first word makes
up more than 1 / ``FREQUENT_SHARE`` of the tokens (fewer than 2 * ``FREQUENT_SHARE`` words, whatever the
input) are dealt by the pair, and their first words' sums are broadcast, so no part is overloaded.  Pairs are
discounted by ``DISCOUNT``; what that leaves over is given to the unigrams.

``WORD_SHARE`` and ``PAIR_SHARE`` can restrict the model to words and pairs of at least a share of
either corpus; other words are then the unknown word.  They are 0: nothing is left out.  A restricted model
is the table of ``fit``: the losses of a pair come from joins with its words' tables, and a document's
distinct pairs are joined with the losses; keys in more than 1 / ``HOT_SHARE`` of all tokens are broadcast.

Defined results: null text counts as empty; a text without words has no tokens, losses and score 0;
without good labels the target is uniform; a document labelled twice is good if any label says so;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import LOWER, chunks, likely_in, mix, signed, store, text_bytes, word_hashes
from ratewise.llm.hashtable import HashTable

WORD_SHARE = 0.0
PAIR_SHARE = 0.0
DISCOUNT = 0.75
ADD = 0.5                   # added to every word's count
UNKNOWN, START = 0, 1       # in the place of a word's hash
HELD = 1_000_000            # distinct pairs a task holds before it passes its counts on
HOT_SHARE = 20_000
BLOCK_BYTES = 4 << 20       # text of a block
PART_TOKENS = 500_000       # tokens whose pairs make up a part
FREQUENT_SHARE = 2_000


def _pairs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each pair of a chunk, of the word before (START at a row's beginning) and of the word; row."""
    second, row = word_hashes(LOWER[data], offsets)
    first = np.empty_like(second)
    if len(second):
        first[0] = START
        first[1:] = np.where(row[1:] == row[:-1], second[:-1], np.uint64(START))
    return mix(mix(first) + second), first, second, row


def _summed(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    k, a, b, n = (np.concatenate(x) for x in zip(*held))
    k, first, inverse = np.unique(k, return_index=True, return_inverse=True)
    return k, a[first], b[first], np.bincount(inverse, n, minlength=len(k)).astype(np.int64)


def counted(texts: DataFrame) -> DataFrame:
    """k, a, b, n: occurrences of each pair in the binary column ``text``, summed within the map tasks only."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(*columns: np.ndarray) -> Iterator[pa.RecordBatch]:
            for lo in range(0, len(columns[0]), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(signed(x[lo:lo + 100_000])) for x in columns],
                                                 ["k", "a", "b", "n"])

        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                k, a, b, _ = _pairs(data, offsets)
                held.append(_summed([(k, a, b, np.ones(len(k)))]))
                if sum(len(x[0]) for x in held) > 2 * HELD:
                    held = [_summed(held)]
                    if len(held[0][0]) > HELD:
                        yield from out(*held[0])
                        held = []
        if held:
            yield from out(*_summed(held))

    return texts.select("text").mapInArrow(run, "k long, a long, b long, n long")


def _totals(pairs: DataFrame) -> tuple[int, int]:
    got = pairs.agg(F.sum("t"), F.sum("c")).first()
    return got[0] or 0, got[1] or 0


def _enough(share: float, totals: tuple[int, int]) -> Column:
    """At least ``share`` of either corpus."""
    return (F.col("t") >= max(1.0, share * totals[0])) | (F.col("c") >= max(1.0, share * totals[1]))


def _joined(rows: DataFrame, side: DataFrame, on: str, hot: Column) -> DataFrame:
    """``rows`` with the columns of ``side`` (unique ``on``); its ``hot`` rows are broadcast."""
    few, many = F.broadcast(side.where(hot)), side.where(~hot)
    cold = rows.join(F.broadcast(side.where(hot).select(on)), on, "left_anti").join(many.hint("shuffle_hash"), on)
    return rows.join(few, on).unionByName(cold)


def _mapped(pairs: DataFrame, totals: tuple[int, int]) -> DataFrame:
    """k, a, b, t, c with UNKNOWN for the words below ``WORD_SHARE``."""
    words = pairs.groupBy("b").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    known = store(words.where(_enough(WORD_SHARE, totals)).select(F.col("b").alias("w")), "lm-known")
    for side in "ab":
        word = known.select(F.col("w").alias(f"{side}_known"))
        found = pairs.join(word, F.col(side) == F.col(f"{side}_known"), "left")
        start = (F.col(side) == START) if side == "a" else F.lit(False)
        pairs = found.withColumn(side, F.when(start, START).otherwise(F.coalesce(f"{side}_known", F.lit(UNKNOWN))).cast("long"))
        pairs = pairs.drop(f"{side}_known")
    return store(pairs, "lm-mapped")


def _losses(pairs: DataFrame, totals: tuple[int, int]) -> DataFrame:
    """a, b, c, bits_t, bits_c: bits of every pair under both models, from a, b, t, c."""
    hot = F.col("hot")
    kept = F.when(_enough(PAIR_SHARE, totals), 1).otherwise(0)
    own = [kept * F.greatest(F.col(x) - DISCOUNT, F.lit(0.0)) for x in "tc"]
    size = F.lit(totals[1] / HOT_SHARE)
    words = store(pairs.groupBy("b").agg(F.sum("t").alias("word_t"), F.sum("c").alias("word_c"))
                  .withColumn("hot", F.col("word_c") > size), "lm-words")
    n = words.where(F.col("b") != UNKNOWN).count() + 1                   # START is never predicted
    firsts = store(pairs.groupBy("a").agg(F.sum("t").alias("all_t"), F.sum("c").alias("all_c"),
                                          F.sum(own[0]).alias("own_t"), F.sum(own[1]).alias("own_c"))
                   .withColumn("hot", F.col("all_c") > size), "lm-firsts")
    keys = [x for x in pairs.columns if x not in ("a", "t")]
    rows = _joined(pairs, firsts, "a", hot)
    shares, rests = [], []
    for k, x in enumerate("tc"):
        seen = F.greatest(F.col(f"all_{x}"), F.lit(1))
        shares.append((own[k] / seen).cast("float").alias(f"share_{x}"))
        rest = F.least(F.lit(1.0), F.greatest(F.lit(1e-6), 1 - F.col(f"own_{x}") / seen))
        rests.append(rest.cast("float").alias(f"rest_{x}"))
    own_a = ["a"] if "k" not in keys else []
    rows = _joined(rows.select(*keys, *own_a, *shares, *rests), words, "b", hot)
    bits = [(-F.log2(F.col(f"share_{x}") + F.col(f"rest_{x}") * (F.col(f"word_{x}") + ADD) / (totals[k] + ADD * n)))
            .cast("float").alias(f"bits_{x}") for k, x in enumerate("tc")]
    return rows.select(*keys, *own_a, *bits)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> tuple[DataFrame, int]:
    """k, c, bits_t, bits_c of every pair of ``docs`` (stored): its occurrences, and bits under the target and the
    background model, counted over every document; and the number of tokens."""
    background = docs.select(text_bytes(text_col).alias("text"))
    good = labels.where(F.col(label_col) == 1).select(F.col(id_col).cast("long").alias("id")).distinct()
    good = store(good.where("id IS NOT NULL"), "lm-good")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("text"))
    target = store(rows.where(likely_in(good)(F.col("id"))).join(good.hint("merge"), "id", "left_semi").select("text"),
                   "lm-target")
    t = counted(target).select("k", "a", "b", F.col("n").alias("t"), F.lit(0).cast("long").alias("c"))
    c = counted(background).select("k", "a", "b", F.lit(0).cast("long").alias("t"), F.col("n").alias("c"))
    pairs = store(t.unionByName(c).groupBy("k").agg(F.first("a").alias("a"), F.first("b").alias("b"),
                                                    F.sum("t").alias("t"), F.sum("c").alias("c")), "lm-pairs")
    totals = _totals(pairs)
    if WORD_SHARE * max(totals) <= 1:                                    # every word is known
        return store(_losses(pairs, totals), "lm-losses").select("k", "c", "bits_t", "bits_c"), totals[1]
    mapped = _mapped(pairs, totals)
    merged = store(mapped.groupBy("a", "b").agg(F.sum("t").alias("t"), F.sum("c").alias("c")), "lm-merged")
    losses = _losses(merged, totals).drop("c")
    return store(mapped.select("k", "a", "b", "c").join(losses, ["a", "b"]).drop("a", "b"), "lm-losses"), totals[1]


def text_key(text: str | Column) -> Column:
    return F.xxhash64(text_bytes(text))


# --- blocks and parts ---------------------------------------------------------------------------

def _pack(*columns: np.ndarray) -> bytes:
    """Small counts of equal number, compressed by place of their bytes."""
    planes = np.stack([x.astype("<i8") for x in columns]).view(np.uint8).reshape(len(columns), -1, 8)
    return pa.compress(planes.transpose(0, 2, 1).tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes, columns: int, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(packed, 8 * columns * n, codec="zstd", asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)
    return np.ascontiguousarray(raw.reshape(columns, 8, n).transpose(0, 2, 1)).view("<i8")[:, :, 0]


def _among(values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each value in the sorted, not empty ``known``, and whether it is there."""
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return at, known[at] == values


class Block:
    """The distinct words and pairs of the texts of a block, by part.

    ``words`` are in order of (part, hash); ``a``, ``b`` are the pairs in order of (part, frequent ``a`` last,
    ``a``, hash).  ``token`` and ``row`` are the pair and the text of each token."""

    def __init__(self, texts: pa.Array, frequent: np.ndarray, parts: int):
        found = [(*_pairs(data, offsets), lo) for lo, _, data, offsets in chunks(texts, 1 << 17)]
        empty = np.zeros(0, np.uint64)
        k, a, b = (np.concatenate([empty, *(x[i] for x in found)]) for i in range(3))
        self.row = np.concatenate([np.zeros(0, np.int64), *(x[3] + x[4] for x in found)])
        k, first, inverse = np.unique(k, return_index=True, return_inverse=True)
        a = a[first]
        of_pair, of_a = (mix(x) % np.uint64(parts) for x in (k, a))
        often = _among(a, frequent)[1]
        part = np.where(often, of_pair, of_a).astype(np.int64)
        order = np.argsort(a, kind="stable")
        order = order[np.argsort((2 * part + often)[order], kind="stable")]
        self.a, self.b, self.often, self.part = a[order], b[first][order], often[order], part[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.token = place[inverse]
        words, of_token = np.unique(b, return_inverse=True)
        part = (mix(words) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        self.words, self.word_part, self.sorted = words[order], part[order], words
        self.word_place = np.empty(len(order), np.int64)
        self.word_place[order] = np.arange(len(order))
        self.token_word = self.word_place[of_token]

    def word_of(self, hashes: np.ndarray) -> np.ndarray:
        return self.word_place[np.searchsorted(self.sorted, hashes)]

    def slices(self) -> Iterator[tuple[int, slice, slice]]:
        """Each part with its words and pairs."""
        for p in np.union1d(self.word_part, self.part).tolist():
            yield (p, slice(*np.searchsorted(self.word_part, [p, p + 1])), slice(*np.searchsorted(self.part, [p, p + 1])))


def _frequent(texts: DataFrame) -> tuple[np.ndarray, int]:
    """START and every word above 1 / ``FREQUENT_SHARE`` of the tokens, with some above half of that, sorted; and the
    number of tokens.  Such a word is above half the share in stretches that hold half its occurrences or more."""
    share = 2 * FREQUENT_SHARE

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                w, n = np.unique(word_hashes(LOWER[data], offsets)[0], return_counts=True)
                often = n * share >= n.sum()
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.append(w[often], np.uint64(UNKNOWN)))),
                                                  pa.array(np.append(n[often], n.sum()))], ["w", "n"])

    counts = store(texts.select("text").mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")), "lm-often")
    total = (counts.where(F.col("w") == UNKNOWN).agg(F.sum("n")).first()[0]) or 0
    often = counts.where((F.col("n") * share >= total) & (F.col("w") != UNKNOWN)).toArrow()["w"].to_numpy()
    return np.unique(np.append(often.view(np.uint64), np.uint64(START))), total


def _sent(frequent: np.ndarray, parts: int):
    """What a block sends to each part.  Rows without text name the ids of the block's good rows."""
    def run(key: tuple, t: pa.Table) -> pa.Table:
        docs, good = t.filter(t["text"].is_valid()), t.filter(t["text"].is_null())
        texts = docs["text"].combine_chunks()
        is_good = pc.is_in(docs["id"], value_set=good["id"].combine_chunks(), skip_nulls=True).to_numpy().astype(float)
        x = Block(texts, frequent, parts)
        c, n_c = (np.bincount(at, minlength=n) for at, n in ((x.token, len(x.a)), (x.token_word, len(x.words))))
        t_, n_t = (np.bincount(at, is_good[x.row], minlength=n).astype(np.int64)
                   for at, n in ((x.token, len(x.a)), (x.token_word, len(x.words))))
        follow = np.bincount(x.word_of(x.a[~x.often]), minlength=len(x.words))
        out = []
        for p, w, k in x.slices():
            often = x.a[k][x.often[k]]
            a, n = np.unique(often, return_counts=True)
            out.append((p, x.words[w].tobytes(), _pack(n_c[w], n_t[w], follow[w]), a.tobytes(), _pack(n),
                        x.b[k].tobytes(), _pack(c[k], t_[k])))
        part, *rest = zip(*out) if out else [()] * 7
        return pa.table([pa.array([key[0].as_py()] * len(out), pa.int64()), pa.array(part, pa.int64()),
                         *(pa.array(r, pa.binary()) for r in rest)], ["block", "part", "w", "w_n", "a", "a_n", "b", "b_n"])
    return run


ANSWER = "block long, part long, w_n binary, b_n binary, own binary, own_n binary"


def _answers(key: tuple, t: pa.Table) -> pa.Table:
    """A part's answer to each block: of its words the counts as a word, as a first word and of followers, and of its pairs
    the counts; block -1: words and tokens of the part, and the sums of the frequent first words."""
    read = lambda name: [np.frombuffer(v, np.uint64) for v in t[name].to_pylist()]
    w, a, b = read("w"), read("a"), read("b")
    w_n, a_n, b_n = ([_unpack(v, m, len(x)) for v, x in zip(t[name].to_pylist(), xs)]
                     for name, xs, m in (("w_n", w, 3), ("a_n", a, 1), ("b_n", b, 2)))
    first = np.concatenate([np.repeat(np.concatenate([x, y]), np.concatenate([n[2], m[0]])) for x, n, y, m in zip(w, w_n, a, a_n)])
    every, again = np.concatenate(b), np.concatenate(b_n, axis=1)
    _, one, pair = np.unique(mix(mix(first) + every), return_index=True, return_inverse=True)
    c, t_ = (np.bincount(pair, n, minlength=len(one)).astype(np.int64) for n in again)
    firsts, of = np.unique(first[one], return_inverse=True)
    sums = np.stack([np.bincount(of, x, minlength=len(firsts)).astype(np.int64) for x in (c, t_, c > 0, t_ > 0)])
    words, word = np.unique(np.concatenate(w), return_inverse=True)
    as_word = np.stack([np.bincount(word, n, minlength=len(words)).astype(np.int64) for n in np.concatenate(w_n, axis=1)[:2]])
    often = np.unique(np.concatenate(a))
    as_first = np.zeros((4, len(words)), np.int64)
    if len(firsts):
        at, there = _among(words, firsts)
        as_first[:, there] = sums[:, at[there]]
    counts = np.concatenate([as_word, as_first])
    word_at, pair_at = (np.cumsum([0, *map(len, x)]) for x in (w, b))
    out = [[n, _pack(*counts[:, word[i:j]]), _pack(c[pair[k:m]], t_[pair[k:m]]), None, None]
           for n, i, j, k, m in zip(t["block"].to_pylist(), word_at, word_at[1:], pair_at, pair_at[1:])]
    total = np.array([[len(words)], [as_word[0].sum()], [as_word[1].sum()]])
    out.append([-1, _pack(*total), None, often.tobytes(), _pack(*sums[:, np.searchsorted(firsts, often)])])
    block, *rest = zip(*out)
    return pa.table([pa.array(block, pa.int64()), pa.array([key[0].as_py()] * len(out), pa.int64()),
                     *(pa.array(r, pa.binary()) for r in rest)], ["block", "part", "w_n", "b_n", "own", "own_n"])


def _part_totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a and its four sums; a = UNKNOWN: words and tokens of a part."""
    for batch in batches:
        for row in batch.to_pylist():
            a = np.frombuffer(row["own"], np.uint64)
            sums = np.concatenate([_unpack(row["own_n"], 4, len(a)), np.append(_unpack(row["w_n"], 3, 1), [[0]], axis=0)], axis=1)
            a = np.append(a, np.uint64(UNKNOWN))
            yield pa.RecordBatch.from_arrays([pa.array(signed(x)) for x in (a, *sums)], ["a", "c", "t", "n_c", "n_t"])


def _block_losses(x: Block, answers: pa.Table, frequent: np.ndarray, sums: np.ndarray, total: np.ndarray) -> list[np.ndarray]:
    """Bits of every pair of a block under the target and the background model."""
    by_part = dict(zip(answers["part"].to_pylist(), zip(answers["w_n"].to_pylist(), answers["b_n"].to_pylist())))
    words, pairs = np.zeros((6, len(x.words)), np.int64), np.zeros((2, len(x.a)), np.int64)
    for p, w, k in x.slices():
        w_n, b_n = by_part[p]
        words[:, w], pairs[:, k] = _unpack(w_n, 6, w.stop - w.start), _unpack(b_n, 2, k.stop - k.start)
    first = np.empty((4, len(x.a)), np.int64)
    first[:, x.often] = sums[:, np.searchsorted(frequent, x.a[x.often])]
    first[:, ~x.often] = words[2:, x.word_of(x.a[~x.often])]
    word = words[:2, x.word_of(x.b)]
    out = []
    for i in (1, 0):                                                      # target, background
        seen = np.maximum(first[i], 1)
        share = (np.maximum(pairs[i] - DISCOUNT, 0) / seen).astype(np.float32)
        own = first[i] - DISCOUNT * first[2 + i]
        rest = np.clip(1 - own / seen, 1e-6, 1).astype(np.float32)
        p = share + rest * ((word[i] + ADD) / (total[1 + i] + ADD * (total[0] + 1)))
        out.append(-np.log2(p).astype(np.float32))
    return out


def _block_scores(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """key, n_tokens, t, c: tokens and summed bits of every row of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("text"))
    blocks = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES + 1
    rows = rows.select(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).alias("block"), "id", "text")
    good = labels.where(F.col(label_col) == 1).select(F.col(id_col).cast("long").alias("id")).where("id IS NOT NULL").distinct()
    named = rows.select("block", "id").join(good, "id", "left_semi").select("block", "id", F.lit(None).cast("binary").alias("text"))
    frequent, tokens = _frequent(rows)
    parts = tokens // PART_TOKENS + 1
    sent = rows.unionByName(named).groupBy("block").applyInArrow(
        _sent(frequent, parts), "block long, part long, w binary, w_n binary, a binary, a_n binary, b binary, b_n binary")
    answers = store(sent.groupBy("part").applyInArrow(_answers, ANSWER), "lm-answers")
    got = (answers.where("block = -1").mapInArrow(_part_totals, "a long, c long, t long, n_c long, n_t long")
           .groupBy("a").agg(*[F.sum(x).alias(x) for x in ("c", "t", "n_c", "n_t")]).toArrow())
    sums, total = np.zeros((4, len(frequent)), np.int64), np.zeros(4, np.int64)
    for a, *n in zip(got["a"].to_numpy().view(np.uint64), *(got[x].to_pylist() for x in ("c", "t", "n_c", "n_t"))):
        if a == UNKNOWN:
            total = np.array(n)
        else:
            sums[:, np.searchsorted(frequent, a)] = n
    shared = spark.sparkContext.broadcast((frequent, sums, total))

    def score(key: tuple, texts: pa.Table, answered: pa.Table) -> pa.Table:
        frequent, sums, total = shared.value
        x = Block(texts["text"].combine_chunks(), frequent, parts)
        n = texts.num_rows
        bits = _block_losses(x, answered, frequent, sums, total)
        return pa.table([texts["key"], pa.array(np.bincount(x.row, minlength=n)),
                         *(pa.array(np.bincount(x.row, y[x.token], minlength=n).astype(float)) for y in bits)], ["key", "n_tokens", "t", "c"])

    keyed = rows.select("block", text_key("text").alias("key"), "text")
    return (keyed.groupBy("block").cogroup(answers.where("block >= 0").select("block", "part", "w_n", "b_n").groupBy("block"))
            .applyInArrow(score, "key long, n_tokens long, t double, c double"))


def _per_token(tokens: Column, r: DataFrame) -> DataFrame:
    """key and the struct of ``lm_score`` from key, t, c and n_tokens; t, c are summed over ``tokens``."""
    bits = [F.col(x) / F.greatest(tokens, F.lit(1)) for x in "tc"]
    return r.select("key", F.struct(F.col("n_tokens"), bits[0].alias("target_bits"), bits[1].alias("background_bits"),
                                    (bits[1] - bits[0]).alias("score")).alias("r"))


def text_scores(docs: DataFrame, labels: DataFrame, text_col: str = "text", **columns: str) -> DataFrame:
    """key (``text_key``) and r, the struct of ``lm_score``, of every distinct text of ``docs``."""
    if not WORD_SHARE and not PAIR_SHARE:
        id_col, label_col = columns.get("id_col", "doc_id"), columns.get("label_col", "quality")
        rows = _block_scores(docs, labels, id_col, text_col, label_col)
        return _per_token(F.col("n_tokens"), rows.groupBy("key").agg(*[F.max(x).alias(x) for x in ("n_tokens", "t", "c")]))
    losses, n_tokens = fit(docs, labels, text_col=text_col, **columns)
    hot = F.col("c") > n_tokens / HOT_SHARE
    few = losses.where(hot).orderBy("k").toArrow()                       # fewer than HOT_SHARE rows
    shared = docs.sparkSession.sparkContext.broadcast(HashTable(
        few["k"].to_numpy().view(np.uint64), np.column_stack([few["bits_t"].to_numpy(), few["bits_c"].to_numpy()])))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            all_keys = batch.column(0).to_numpy()
            for lo, hi, data, offsets in chunks(batch.column(1)):
                keys, n = all_keys[lo:hi], hi - lo
                k, _, _, row = _pairs(data, offsets)
                at = table.find(k)
                own, bits = row[at >= 0], table.values[at[at >= 0]]
                sums = [np.bincount(own, bits[:, x], minlength=n) for x in range(2)]
                # a document's tokens (as -1 - tokens) and the bits of its frequent pairs
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(signed(mix(keys.view(np.uint64)))), pa.array(-1 - np.bincount(row, minlength=n)),
                     pa.array(sums[0]), pa.array(sums[1])], ["key", "k", "n", "bits_t", "bits_c"])
                k, row = k[at < 0], row[at < 0]
                order = np.lexsort((k, row))
                k, row = k[order], row[order]
                new = np.ones(len(k), dtype=bool)
                new[1:] = (k[1:] != k[:-1]) | (row[1:] != row[:-1])
                first = np.flatnonzero(new)
                zeros = np.zeros(len(first))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[row[first]]), pa.array(signed(k[first])), pa.array(np.diff(np.append(first, len(k)))),
                     pa.array(zeros), pa.array(zeros)], ["key", "k", "n", "bits_t", "bits_c"])

    found = docs.select(text_key(text_col).alias("key"), text_bytes(text_col).alias("text"))
    probes = found.mapInArrow(run, "key long, k long, n long, bits_t double, bits_c double")
    cold = losses.where(~hot).select("k", F.col("bits_t").alias("pair_t"), F.col("bits_c").alias("pair_c"))
    rows = probes.join(cold.hint("shuffle_hash"), "k", "left")
    whole = F.col("n") < 0
    sums = rows.groupBy("key").agg(
        F.sum(F.when(whole, 1)).alias("rows"), F.max(F.when(whole, -1 - F.col("n"))).alias("n_tokens"),   # equal texts add up
        *[F.sum(F.when(whole, F.col(f"bits_{x}")).otherwise(F.col("n") * F.col(f"pair_{x}"))).alias(x) for x in "tc"])
    return _per_token(F.col("rows") * F.col("n_tokens"), sums)


def scored(docs: DataFrame, labels: DataFrame, text_col: str = "text", **columns: str) -> DataFrame:
    """Every row of ``docs``: its columns but the text, and r, the struct of ``lm_score``."""
    keyed = docs.withColumn("_key", text_key(text_col)).drop(text_col)
    scores = text_scores(docs, labels, text_col=text_col, **columns).withColumnRenamed("key", "_key")
    return keyed.join(scores, "_key", "left").drop("_key")


def lm_score(docs: DataFrame, labels: DataFrame, text: str | Column = "text", **columns: str) -> Column:
    """Column of struct<n_tokens, target_bits, background_bits, score> for texts of ``docs``; bits and score are
    per token.  ``scored`` is cheaper: it doesn't shuffle the texts for the look-up."""
    scores = store(text_scores(docs, labels, **columns), "lm-scores")
    key = text_key((F.col(text) if isinstance(text, str) else text).outer())
    return scores.where(F.col("key") == key).select(F.first("r")).scalar()

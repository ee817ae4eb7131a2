"""Removal of long repeated byte strings with sharded suffix arrays.

A string of ``length`` bytes is judged by its start.  Every start has one anchor: the smallest of the
gram hashes inside its string, leftmost among equals, so equal strings have equal anchors at the same
distance.  The starts of one anchor occurrence form a context, the text they cover.  Then

1. anchor hashes are counted over all documents; an anchor met once has no repeated string, and an
   anchor whose contexts are all equal has only repeated ones;
2. for the other anchors, a context keeps only the starts that can be repeated: a string that reaches a
   step of ``REACH`` bytes to the left or right of its anchor needs those bytes, anchor included, to be met
   elsewhere, which hashes of the steps tell; the distinct contexts that are left are dealt by anchor,
   gathered into shards of about ``SHARD_BYTES``, and each shard's suffix array (induced sorting) and permuted common prefixes tell the
   starts whose string of ``length`` bytes stands elsewhere too; equal contexts are folded before the
   shuffle and count as repeated;
3. anchors in more than 1 / ``HOT_SHARE`` of all occurrences (fewer than ``HOT_SHARE`` anchors, whatever the
   input) could overload a shard: their starts are counted one by one by a 128-bit hash of the string;
4. the verdicts go back to the occurrences, and each document drops the bytes its repeated starts cover.

Everything leaves a document as hashes, but for the distinct contexts of step 2.

Defined results: null counts as empty; a text shorter than ``length`` keeps all bytes; equal rows repeat
each other; rows of equal id are told apart by their text; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import RangeHash, mix, signed, store, text_bytes
from ratewise.llm.suffix_array import permuted_common_prefixes, suffix_array

LENGTH = 200
GRAM = 48
SEGMENT = 1 << 19           # starts of a long document looked at together
SHARD_BYTES = 1 << 20
SCAN_BYTES = 1 << 17         # text looked at together: its arrays stay in a core's cache
HOT_SHARE = 20_000
REACH = 38                  # bytes a step to the left or right of an anchor
FILTER_BITS = 24            # of the anchors' prefilter (a fixed 2 MB a map)


class Occurrences:
    """Contexts of a chunk: anchor hash, context hash, piece it lies in, first start (in the chunk) and
    number of starts."""

    def __init__(self, data: np.ndarray, pieces: np.ndarray, length: int):
        """``pieces``: offsets of the parts of ``data`` that are looked at apart."""
        self.data, self.length = data, length
        self.hashes = RangeHash(data)
        empty = np.zeros(0, np.int64)
        self.anchor = self.context = np.zeros(0, np.uint64)
        self.piece, self.start, self.starts, self.at = empty, empty, empty, empty
        self.pieces = pieces
        n = len(data)
        if n < length:
            return
        gram = self.hashes.windows(GRAM)
        bits = np.uint64(max(1, int(n).bit_length()))
        key = (gram >> bits << bits) | np.arange(len(gram), dtype=np.uint64)     # leftmost among equals
        width = length - GRAM + 1
        low = _sliding_min(key, width)                              # by start
        piece = np.repeat(np.arange(len(pieces) - 1), np.diff(pieces))[:len(low)]
        valid = np.arange(len(low)) + length <= pieces[piece + 1]
        starts = np.flatnonzero(valid)
        if not len(starts):
            return
        where = (low[starts] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        first = np.flatnonzero(np.append(True, (where[1:] != where[:-1]) | (np.diff(starts) != 1)))
        self.starts = np.diff(np.append(first, len(starts)))
        self.start = starts[first]
        self.at = where[first]
        self.anchor = gram[self.at]
        self.piece = piece[self.start]
        self.context = self.hashes.of(self.start, self.end())

    def end(self) -> np.ndarray:
        return self.start + self.starts - 1 + self.length

    def steps(self, pick: np.ndarray) -> Iterator[tuple[bool, int, np.ndarray, np.ndarray]]:
        """For each step to the left and to the right of the picked anchors: side, step, which of them have
        it inside their piece, and the hash of its bytes with the anchor's."""
        at, lo, hi = self.at[pick], self.pieces[self.piece[pick]], self.pieces[self.piece[pick] + 1]
        for left in (True, False):
            for step in range(REACH, self.length - GRAM + 1, REACH):
                a, b = (at - step, at + GRAM) if left else (at, at + GRAM + step)
                there = (a >= lo) & (b <= hi)
                key = self.hashes.of(np.where(there, a, at), np.where(there, b, at + GRAM))
                yield left, step, there, mix(key ^ np.uint64(2 * step + left))

    def trimmed(self, pick: np.ndarray, met: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, ...]:
        """Of the picked contexts those with starts that can be repeated: which, first start, number of starts
        and hash of what these cover.  ``met`` tells whether a step's hash may stand elsewhere."""
        reach = {True: np.zeros(len(pick), np.int64), False: np.zeros(len(pick), np.int64)}
        for left, step, there, key in self.steps(pick):
            grows = (reach[left] == step - REACH) & there
            reach[left] = np.where(grows & met(key), step, reach[left])
        first = np.maximum(self.start[pick], self.at[pick] - reach[True] - (REACH - 1))
        last = np.minimum(self.start[pick] + self.starts[pick] - 1,
                          self.at[pick] + GRAM + reach[False] + (REACH - 1) - self.length)
        some = first <= last
        first, last = first[some], last[some]
        return pick[some], first, last - first + 1, self.hashes.of(first, last + self.length)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    if len(x) < width:
        return np.zeros(0, x.dtype)
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[:len(x) - rest], x[rest:])


def _pieces(texts: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks of text as (data, piece offsets, row of each piece, place of each piece in its row); long
    rows are cut into pieces that share ``length`` - 1 bytes, so every start is in one piece."""
    held, rows, places, size = [], [], [], 0
    for row, text in enumerate(texts):
        data = np.frombuffer(text.as_buffer(), np.uint8)
        for lo in range(0, max(1, len(data) - length + 1), SEGMENT):
            part = data[lo:lo + SEGMENT + length - 1]
            held.append(part), rows.append(row), places.append(lo)
            size += len(part)
            if size >= SCAN_BYTES:
                yield np.concatenate(held), np.cumsum([0, *map(len, held)]), np.array(rows), np.array(places)
                held, rows, places, size = [], [], [], 0
    if held:
        yield np.concatenate(held), np.cumsum([0, *map(len, held)]), np.array(rows), np.array(places)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _filter(anchors: DataFrame) -> np.ndarray:
    """Bitmap of the buckets of a set of anchors: a fixed number of blocks of fixed size."""
    def run(key: tuple, t: pa.Table) -> pa.Table:
        bits = np.zeros(1 << 13, np.uint8)
        low = np.unique(t["low"].to_numpy())
        np.bitwise_or.at(bits, low >> 3, (128 >> (low & 7)).astype(np.uint8))
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([bits.tobytes()], pa.binary())})

    def buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = np.unique(_bucket(b.column(0).to_numpy().view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(k >> 16), pa.array(k & 0xFFFF)], ["block", "low"])

    got = (anchors.select("h").mapInArrow(buckets, "block long, low long").distinct()      # 65,536 a block at most
           .groupBy("block").applyInArrow(run, "block long, bits binary").toArrow())
    out = np.zeros((1 << (FILTER_BITS - 16), 1 << 13), np.uint8)
    for block, bits in zip(got["block"].to_pylist(), got["bits"].to_pylist()):
        out[block] = np.frombuffer(bits, np.uint8)
    return out.ravel()


def _likely(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    k = _bucket(hashes)
    return (bitmap[k >> 3] & (128 >> (k & 7)).astype(np.uint8)) > 0


def _scan(rows: DataFrame, length: int, emit: Callable, schema: str) -> DataFrame:
    """Run ``emit(occurrences, row ids, row keys, places)`` over the chunks of ``rows`` (id, key, text)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, offsets, row, place in _pieces(batch.column(2), length):
                found = Occurrences(data, offsets, length)
                if len(found.start):
                    of = row[found.piece]
                    yield from emit(found, batch, of, found.start - offsets[found.piece] + place[found.piece])
    return rows.mapInArrow(run, schema)


def _shard_verdicts(texts: list[bytes], starts: list[int], copies: list[int], length: int) -> list[np.ndarray]:
    """For each distinct context of a shard, which of its starts are repeated."""
    sizes = np.array([len(t) + 1 for t in texts])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    symbols = np.ones(offsets[-1], dtype=np.int64)                  # 1 closes a context, bytes are 2..257
    inside = np.ones(offsets[-1], dtype=bool)
    inside[offsets[1:] - 1] = False
    symbols[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + 2
    sa = suffix_array(symbols)
    long = permuted_common_prefixes(symbols, sa, length) >= length
    again = long.copy()                                             # like the suffix before it,
    again[sa[:-1]] |= long[sa[1:]]                                  # or like the one after it
    return [np.full(n, True) if c > 1 else again[o:o + n] for o, n, c in zip(offsets, starts, copies)]


def _folded(h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One of the places of each distinct pair (h, c), and how often the pair stands."""
    order = np.lexsort((c, h))
    first = np.flatnonzero(np.append(True, (h[order][1:] != h[order][:-1]) | (c[order][1:] != c[order][:-1])))
    return order[first], np.diff(np.append(first, len(h)))


def repeated_starts(rows: DataFrame, length: int) -> DataFrame:
    """id, key, at, n: runs of n repeated starts from ``at`` on."""
    spark = rows.sparkSession

    def fold(found, batch, of, at):
        one, n = _folded(found.anchor, found.context)
        yield pa.RecordBatch.from_arrays([pa.array(signed(found.anchor[one])), pa.array(signed(found.context[one])),
                                          pa.array(n)], ["h", "c", "n"])

    counts = _scan(rows, length, fold, "h long, c long, n long").groupBy("h").agg(
        F.sum("n").alias("n"), F.min("c").alias("c"), F.max("c").alias("c_max"))
    again = store(counts.where("n > 1"), "suffix-anchors")
    total = again.agg(F.sum("n")).first()[0] or 0
    hot_from = total // HOT_SHARE + 2
    mixed = again.where("c <> c_max")
    hot = np.sort(mixed.where(F.col("n") >= hot_from).select("h").toArrow()["h"].to_numpy().view(np.uint64))
    share = spark.sparkContext.broadcast((_filter(again), _filter(mixed.where(F.col("n") < hot_from)), hot))

    def is_hot(anchor: np.ndarray) -> np.ndarray:
        hot = share.value[2]
        if not len(hot):
            return np.zeros(len(anchor), dtype=bool)
        return hot[np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)] == anchor

    def is_mixed(anchor: np.ndarray) -> np.ndarray:
        return _likely(share.value[1], anchor) & ~is_hot(anchor)

    # starts of hot anchors, one by one
    def string_hashes(found):
        pick = np.flatnonzero(is_hot(found.anchor))
        n = found.starts[pick]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = np.repeat(found.start[pick], n) + within
        return (np.repeat(pick, n), within, found.hashes.of(start, start + length), found.hashes.of(start, start + length // 2))

    # steps around mixed anchors (kind 1) and strings of hot ones (kind 2) that stand more than once
    def steps(found, batch, of, at):
        pick = np.flatnonzero(is_mixed(found.anchor))
        if len(pick):
            k, n = np.unique(np.concatenate([key[there] for _, _, there, key in found.steps(pick)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(k)), pa.array(np.zeros(len(k), np.int64)), pa.array(n),
                                              pa.array(np.full(len(k), 1, np.int32))], ["h", "c", "n", "kind"])
        _, _, x, y = string_hashes(found)
        if len(x):
            one, n = _folded(x, y)
            yield pa.RecordBatch.from_arrays([pa.array(signed(x[one])), pa.array(signed(y[one])), pa.array(n),
                                              pa.array(np.full(len(n), 2, np.int32))], ["h", "c", "n", "kind"])

    met = _scan(rows, length, steps, "h long, c long, n long, kind int").groupBy("h", "c", "kind").agg(F.sum("n").alias("n"))
    twice = store(met.where("n > 1").select("h", "c", "kind"), "suffix-twice")
    strings = twice.where("kind = 2")
    reached = spark.sparkContext.broadcast((_filter(twice.where("kind = 1")), _filter(strings)))

    def may_be_met(key: np.ndarray) -> np.ndarray:
        return _likely(reached.value[0], key)

    # distinct trimmed contexts of mixed anchors -> shards
    def contexts(found, batch, of, at):
        pick, start, starts, context = found.trimmed(np.flatnonzero(is_mixed(found.anchor)), may_be_met)
        if len(pick):
            one, n = _folded(found.anchor[pick], context)
            end = start + starts - 1 + length
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(found.anchor[pick][one])), pa.array(signed(context[one])), pa.array(n), pa.array(starts[one]),
                 pa.array([found.data[start[k]:end[k]].tobytes() for k in one], pa.binary())],
                ["h", "c", "n", "starts", "text"])

    def sort_shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = []           # h, c, copies, starts, text of the distinct contexts
        size = 0

        def verdicts() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            masks = _shard_verdicts([x[4] for x in held], [x[3] for x in held], [x[2] for x in held], length)
            runs = [(x[0], x[1], a, b - a) for x, m in zip(held, masks) for a, b in _runs(m)]
            if runs:
                yield pa.RecordBatch.from_arrays([pa.array(col, pa.int64()) for col in zip(*runs)], ["h", "c", "first", "n"])

        for b in batches:
            for h, c, n, starts, text in zip(*(b.column(k).to_pylist() for k in range(5))):
                if held and held[-1][0] == h and held[-1][1] == c:
                    held[-1][2] += n
                    continue
                if size >= SHARD_BYTES and held[-1][0] != h:        # an anchor stays in one shard
                    yield from verdicts()
                    held, size = [], 0
                held.append([h, c, n, starts, text])
                size += len(text)
        yield from verdicts()

    dealt = _scan(rows, length, contexts, "h long, c long, n long, starts long, text binary")
    sorted_shards = (dealt.repartition("h").sortWithinPartitions("h", "c")
                     .mapInArrow(sort_shards, "h long, c long, first long, n long")).select("*", F.lit(1).alias("kind"))
    alike = again.where("c = c_max").select("h", "c", F.lit(0).cast("long").alias("first"),
                                            F.lit(None).cast("long").alias("n"), F.lit(0).alias("kind"))
    single = strings.select("h", "c", F.lit(0).cast("long").alias("first"), F.lit(None).cast("long").alias("n"), "kind")
    verdicts = store(sorted_shards.unionByName(alike).unionByName(single), "suffix-verdicts")

    # occurrences, as they are (kind 0) and trimmed (kind 1), and strings of hot anchors (kind 2), with their verdict
    def occurrences(found, batch, of, at):
        mixed = is_mixed(found.anchor)
        own = np.flatnonzero(_likely(share.value[0], found.anchor) & ~is_hot(found.anchor))
        pick, start, starts, context = found.trimmed(np.flatnonzero(mixed), may_be_met)
        both = np.concatenate([own, pick])
        if len(both):
            take = pa.array(of[both])
            place = np.concatenate([at[own], at[pick] + start - found.start[pick]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(signed(found.anchor[both])),
                 pa.array(signed(np.concatenate([found.context[own], context]))), pa.array(place),
                 pa.array(np.concatenate([found.starts[own], starts])),
                 pa.array(np.repeat([0, 1], [len(own), len(pick)]).astype(np.int32))],
                ["id", "key", "h", "c", "at", "all", "kind"])

        of_string, within, x, y = string_hashes(found)
        ok = np.flatnonzero(_likely(reached.value[1], x)) if len(x) else np.zeros(0, np.int64)
        if len(ok):
            own = of_string[ok]
            take = pa.array(of[own])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(signed(x[ok])), pa.array(signed(y[ok])),
                 pa.array(at[own] + within[ok]), pa.array(np.ones(len(ok), np.int64)),
                 pa.array(np.full(len(ok), 2, np.int32))], ["id", "key", "h", "c", "at", "all", "kind"])

    return (_scan(rows, length, occurrences, "id long, key long, h long, c long, at long, all long, kind int")
            .join(verdicts, ["h", "c", "kind"])
            .select("id", "key", (F.col("at") + F.col("first")).alias("at"), F.coalesce("n", "all").alias("n")))


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of True, end exclusive."""
    change = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return list(zip(change[::2].tolist(), change[1::2].tolist()))


def _removed(texts: pa.Array, hits: pa.Array, length: int) -> pa.Array:
    n_bytes, begins, finishes, counts, kept = [], [], [], [0], []
    has_hits = hits.is_valid().to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(hits), 0).to_numpy())])
    flat = hits.flatten()
    at, n = flat.field("at").to_numpy(), flat.field("n").to_numpy()
    for k, text in enumerate(texts):
        data = np.frombuffer(text.as_buffer(), np.uint8)
        n_bytes.append(len(data))
        if not has_hits[k]:
            counts.append(counts[-1])
            kept.append(data.tobytes())
            continue
        own = slice(bounds[k], bounds[k + 1])
        edge = np.bincount(at[own], minlength=len(data) + 1) - np.bincount(at[own] + n[own] - 1 + length, minlength=len(data) + 1)
        gone = np.cumsum(edge[:-1]) > 0
        runs = _runs(gone)
        begins += [a for a, _ in runs]
        finishes += [b for _, b in runs]
        counts.append(counts[-1] + len(runs))
        kept.append(data[~gone].tobytes())
    spans = pa.StructArray.from_arrays([pa.array(begins, pa.int64()), pa.array(finishes, pa.int64())], ["start", "end"])
    return pa.StructArray.from_arrays(
        [pa.array(n_bytes, pa.int64()), pa.ListArray.from_arrays(pa.array(counts, pa.int32()), spans),
         pa.array(kept, pa.binary())], ["n_bytes", "spans", "kept"])


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, spans (removed runs, end exclusive) and kept (remaining bytes) of every row."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("text"))
    rows = rows.select("id", F.xxhash64("id", "text").alias("key"), "text")
    found = repeated_starts(rows.where(F.octet_length("text") >= length), length)
    per = found.groupBy("id", "key").agg(F.collect_list(F.struct("at", "n")).alias("hits"))
    per = per.select(F.col("id").alias("hit_id"), F.col("key").alias("hit_key"), "hits")

    def run(texts: pa.Array, hits: pa.Array) -> pa.Array:
        return _removed(texts, hits, length)

    cut = F.arrow_udf(run, "struct<n_bytes:long,spans:array<struct<start:long,end:long>>,kept:binary>").asNondeterministic()
    joined = rows.join(per.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("key") == F.col("hit_key")), "left")
    done = joined.select("id", cut("text", "hits").alias("r"))
    return done.select(F.col("id").alias("doc_id"), "r.n_bytes", "r.spans", "r.kept")

"""Line deduplication: documents probe sharded perfect-hash arrays of repeated lines.

A line's key is the line stripped of ASCII white space with A-Z lower-cased.  Lines leave their
document as 128-bit hashes only.  Hashes met in enough documents form the index: shards by hash, each
a minimal perfect hash over its keys with arrays of fingerprints, counts and last documents.  A
document's hashes are dealt to the shards and probe the arrays; only hits come back.  Keys in more
than 1 / ``HOT_SHARE`` of all line occurrences (so fewer than ``HOT_SHARE`` keys, whatever the input)
form a shard of their own that is broadcast and probed where the document is, which leaves no hash
that could overload a shard.

Defined results: a null or empty text is one empty line; rows count as documents; a null id is below
every other id; rows with equal ids are treated alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import store, text_bytes
from ratewise.llm.perfect_hash import PerfectHash

STRIP = b" \t\n\x0b\x0c\r"
HOT_SHARE = 20_000
LINES_PER_SHARD = 500_000
KEYS_PER_SHARD = 100_000


def line_hash(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a line's key, or None when the key is too short."""
    key = line.strip(STRIP).lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)


def document_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """id, a, b: the distinct line hashes of each document."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, counts = [], []
            for text in batch.column(1):
                own = {line_hash(x, min_chars) for x in text.as_buffer().to_pybytes().split(b"\n")}
                own.discard(None)
                digests += sorted(own)
                counts.append(len(own))
            if digests:
                h = _halves(digests)
                ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(counts)), counts)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.ascontiguousarray(h[:, 0])), pa.array(np.ascontiguousarray(h[:, 1]))],
                    ["id", "a", "b"])

    return rows.mapInArrow(run, "id long, a long, b long")


class LineIndex:
    """One shard: perfect hash over ``a``, fingerprints ``b``, counts and last documents."""

    def __init__(self, levels: list[bytes], fingerprints: bytes, counts: bytes, last: bytes, has_last: bytes):
        self.hash = PerfectHash.load(levels)
        self.fingerprints = np.frombuffer(fingerprints, np.int64)
        self.counts, self.last = np.frombuffer(counts, np.int64), np.frombuffer(last, np.int64)
        self.has_last = np.frombuffer(has_last, bool)

    @staticmethod
    def build(a: np.ndarray, b: np.ndarray, counts: np.ndarray, last: np.ndarray, has_last: np.ndarray) -> tuple:
        # two keys with one first half: the perfect hash runs over both halves mixed, which differ
        keys = _key(a, b)
        ph, levels = PerfectHash.build(keys)
        order = np.argsort(ph.index(keys))
        return (levels, b[order].tobytes(), counts[order].tobytes(), last[order].tobytes(), has_last[order].tobytes())

    def probe(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Index of each hash in the arrays, -1 where the line isn't in the shard."""
        if not self.hash.n:
            return np.full(len(a), -1, np.int64)
        at = self.hash.index(_key(a, b))
        return np.where((at >= 0) & (self.fingerprints[at] == b), at, -1)


def _key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a).view(np.uint64) ^ (np.ascontiguousarray(b).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


INDEX_SCHEMA = "levels array<binary>, fingerprints binary, counts binary, last binary, has_last binary"


def _numpy(column: pa.ChunkedArray | pa.Array, fill: int | None = None) -> np.ndarray:
    column = column.fill_null(fill) if fill is not None else column
    return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()


def build_shards(repeated: DataFrame, shards: int) -> DataFrame:
    """shard and its arrays, from a, b, copies, last."""
    def run(key: tuple, t: pa.Table) -> pa.Table:
        parts = LineIndex.build(_numpy(t["a"]), _numpy(t["b"]), _numpy(t["copies"]), _numpy(t["last"], 0),
                                _numpy(t["last"].is_valid()))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()),
                         "levels": pa.array([parts[0]], pa.list_(pa.binary())),
                         **{n: pa.array([p], pa.binary()) for n, p in
                            zip(("fingerprints", "counts", "last", "has_last"), parts[1:])}})
    keyed = repeated.select(F.pmod("a", F.lit(shards)).alias("shard"), "a", "b", "copies", "last")
    return keyed.groupBy("shard").applyInArrow(run, f"shard long, {INDEX_SCHEMA}")


def _loses(index: LineIndex, a: np.ndarray, b: np.ndarray, ids: np.ndarray, has_id: np.ndarray) -> np.ndarray:
    at = index.probe(a, b)
    if not index.hash.n:
        return at >= 0
    return (at >= 0) & ~((index.last[at] == ids) & (index.has_last[at] == has_id))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20,
                min_docs: int = 3) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (text without the dropped lines) of every row of ``docs``.
    Keys of at least ``min_chars`` code points in at least ``min_docs`` documents lose all their
    lines except in the largest id that holds them."""
    spark = docs.sparkSession
    lines = store(document_lines(docs, id_col, text_col, min_chars), "lines")
    repeated = store(lines.groupBy("a", "b").agg(F.count(F.lit(1)).alias("copies"), F.max("id").alias("last"))
                     .where(F.col("copies") >= min_docs), "repeated-lines")
    n_lines, n_keys = lines.count(), repeated.count()
    shards = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")),
                 -(-n_lines // LINES_PER_SHARD), -(-n_keys // KEYS_PER_SHARD))
    hot_from = max(min_docs, n_lines // HOT_SHARE + 1)

    hot = repeated.where(F.col("copies") >= hot_from).toArrow()      # fewer than HOT_SHARE rows
    parts = LineIndex.build(_numpy(hot["a"]), _numpy(hot["b"]), _numpy(hot["copies"]), _numpy(hot["last"], 0),
                            _numpy(hot["last"].is_valid())) if hot.num_rows else ([], b"", b"", b"", b"")
    shared = spark.sparkContext.broadcast(parts)

    def cold(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = LineIndex(*shared.value).probe(_numpy(batch.column(1)), _numpy(batch.column(2)))
        return batch.filter(pa.array(at < 0))

    def cold_run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield cold(batch)

    def probe(key: tuple, probes: pa.Table, index: pa.Table) -> pa.Table:
        if not index.num_rows or not probes.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        own = LineIndex(*(index[c][0].as_py() for c in ("levels", "fingerprints", "counts", "last", "has_last")))
        loses = _loses(own, _numpy(probes["a"]), _numpy(probes["b"]), _numpy(probes["id"], 0),
                       _numpy(probes["id"].is_valid()))
        return probes.select(["id", "b"]).filter(pa.array(loses))

    index = build_shards(repeated.where(F.col("copies") < hot_from), shards)
    probes = (lines.mapInArrow(cold_run, "id long, a long, b long")
              .withColumn("shard", F.pmod("a", F.lit(shards))))
    hits = (probes.groupBy("shard").cogroup(index.groupBy("shard"))
            .applyInArrow(probe, "id long, b long"))
    lost = hits.groupBy("id").agg(F.collect_set("b").alias("lost")).withColumnRenamed("id", "lost_id")

    def strip(texts: pa.Array, ids: pa.Array, losts: pa.Array) -> pa.Array:
        index = LineIndex(*shared.value)
        id_values, has_id = _numpy(ids, 0), _numpy(ids.is_valid())
        n_lines, n_dropped, kept = [], [], []
        for k, (text, own) in enumerate(zip(texts, losts)):
            parts = text.as_buffer().to_pybytes().split(b"\n")
            hashes = [line_hash(x, min_chars) for x in parts]
            at = [j for j, h in enumerate(hashes) if h is not None]
            gone: set[int] = set()
            if at:
                h = _halves([hashes[j] for j in at])
                a, b = np.ascontiguousarray(h[:, 0]), np.ascontiguousarray(h[:, 1])
                drop = _loses(index, a, b, np.full(len(a), id_values[k]), np.full(len(a), has_id[k]))
                if own.is_valid:
                    drop |= np.isin(b, own.values.to_numpy())
                gone = {at[j] for j in np.flatnonzero(drop)}
            n_lines.append(len(parts)), n_dropped.append(len(gone))
            kept.append(b"\n".join([x for j, x in enumerate(parts) if j not in gone]) if gone else b"\n".join(parts))
        return pa.StructArray.from_arrays(
            [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary())],
            ["n_lines", "n_dropped", "kept"])

    strip_udf = F.arrow_udf(strip, "struct<n_lines:long,n_dropped:long,kept:binary>").asNondeterministic()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    joined = rows.join(lost.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("lost_id")), "left")
    done = joined.select("doc_id", strip_udf("text", "doc_id", "lost").alias("r"))
    return done.select("doc_id", "r.n_lines", "r.n_dropped", F.col("r.kept").cast("string").alias("kept"))

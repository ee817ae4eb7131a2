"""Helpers shared by the document operators: columns, scratch tables, batch text arrays."""

from __future__ import annotations

import atexit
import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratewise.session import apply_conf, ensure_checkpoint_dir, ship_package

ROWS_PER_BATCH = 1000          # Arrow batch: a few MB of ordinary documents
CHUNK_BYTES = 1 << 20          # text looked at together inside a batch


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of the document operators; safe to call again."""
    apply_conf(spark)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark


def text_bytes(text: str | Column) -> Column:
    """UTF-8 bytes of a text column; null counts as empty."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(col.cast("string"), F.lit("")).cast("binary")


def in_training_fold(doc_id: str | Column) -> Column:
    """True for rows whose labels may be learned: crc32 of the id's decimal text, modulo 5, is not 0.
    A null id is in no training fold."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % 5 != 0, F.lit(False))


def hash_sample(rows: DataFrame, by: str, n: int, seed: int, id_col: str, *order: Column) -> DataFrame:
    """At most ``n`` rows of each value of ``by`` (few values), those of lowest hash of the id, with their
    ``place``.  Each value's rows are counted first and thinned by the hash to about twice ``n``, so what meets
    in a task stays bounded, however many partitions there are.  ``order``: what else orders rows, the first
    before the hash."""
    sizes = rows.groupBy(by).agg(F.count(F.lit(1)).alias("_rows"))
    u = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    thinned = rows.join(F.broadcast(sizes), by).where(u * F.col("_rows") < 2 * n + 100).drop("_rows")
    window = Window.partitionBy(by).orderBy(*order[:1], u, id_col, *order[1:])
    return thinned.withColumn("place", F.row_number().over(window)).where(F.col("place") <= n)


# --- scratch tables -------------------------------------------------------------------------

_SCRATCH: dict[str, str] = {}


def _scratch_root(spark: SparkSession) -> str:
    """One folder per application below the shared checkpoint folder, removed when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        base = ensure_checkpoint_dir(spark).rstrip("/")
        _SCRATCH[app] = f"{base}/ratewise-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_remove, spark, _SCRATCH[app])
    return _SCRATCH[app]


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001 - the session has already stopped; the folder stays
        pass


def store(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage, computes
    once, survives the loss of executors."""
    spark = df.sparkSession
    path = f"{_scratch_root(spark)}/{tag}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# --- a set of ids as a filter --------------------------------------------------------------------

BITS_PER_ID = 16               # of the filter: one id in 16 gets through by chance
MOST_BITS = 27                 # 16 MB: enough for 8 million ids; beyond, more and more get through


def likely_in(ids: DataFrame) -> Callable[[Column], Column]:
    """A test that every id of the one-column ``ids`` passes, and few others: it goes before a join that
    would otherwise shuffle whole texts.  It grows with the number of ids up to 2 ** ``MOST_BITS`` bits,
    which reach the driver as packed bitmaps."""
    ids = ids.select(F.col(ids.columns[0]).cast("long").alias("id"))
    bits = 1 << min(MOST_BITS, max(16, (BITS_PER_ID * ids.count() - 1).bit_length()))
    place = F.pmod(F.xxhash64("id"), F.lit(bits))
    maps = (ids.groupBy(F.bitmap_bucket_number(place + 1).alias("bucket"))         # values from 1 on: buckets from 1 on
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place + 1)).alias("bits")).toArrow())
    packed = np.zeros(bits // 8 + 4096, dtype=np.uint8)
    for bucket, bitmap in zip(maps["bucket"].to_pylist(), maps["bits"].to_pylist()):
        packed[(bucket - 1) * 4096:bucket * 4096] = np.frombuffer(bitmap, dtype=np.uint8)
    shared = ids.sparkSession.sparkContext.broadcast(packed)

    def run(places: pa.Array) -> pa.Array:
        k = places.to_numpy(zero_copy_only=False)
        return pa.array((shared.value[k >> 3] >> (k & 7) & 1).astype(bool))

    return lambda column: F.arrow_udf(run, "boolean")(F.pmod(F.xxhash64(column.cast("long")), F.lit(bits)))


# --- text of a batch as arrays ----------------------------------------------------------------

def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if out is not None and out.num_rows:
                yield out
    return df.mapInArrow(run, schema)


def chunks(values: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a binary array into runs of rows of about ``limit`` bytes (one row at least):
    (first row, end row, uint8 data, offsets into it)."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    n = len(values)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_binary(values.type) else np.int32
    offsets = np.frombuffer(values.buffers()[1], dtype=kind)[values.offset:values.offset + n + 1].astype(np.int64)
    raw = values.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


SPACES = (9, 10, 11, 12, 13, 32)
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[list(SPACES)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x27D4EB2F165667C5)                       # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64))
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i < n."""
    if len(_POWERS["up"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        up, down = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
                    for b in (_BASE, _INVERSE))
        if size > 8 * CHUNK_BYTES:       # a huge document: not kept for the worker's lifetime
            return up, down
        _POWERS["up"], _POWERS["down"] = up, down
    return _POWERS["up"], _POWERS["down"]


class RangeHash:
    """64-bit hashes of byte ranges of one buffer, from prefix sums of code(byte) * B**i."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(BYTE_CODE[data] * up[:len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(raw ^ ((end - start).astype(np.uint64) * _M2))

    def windows(self, width: int) -> np.ndarray:
        """Hash of every range of ``width`` bytes, as ``of`` gives it."""
        raw = self.sums[width:] - self.sums[:len(self.sums) - width]
        raw *= self.down[:len(raw)]
        return mix(raw ^ np.uint64(width * int(_M2) % (1 << 64)))


def words(data: np.ndarray, offsets: np.ndarray,
          letters: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of ``letters``; as a rule ``[^\\x20\\x09-\\x0D]+``) of the rows of a chunk: start,
    end, row of each word."""
    inside = letters[data]
    before = np.empty_like(inside)
    if len(inside):
        before[0] = False
        before[1:] = inside[:-1]
        firsts = offsets[:-1][offsets[:-1] < len(data)]
        before[firsts] = False
    start = np.flatnonzero(inside & ~before)
    ends_at = np.zeros(len(inside), dtype=bool)
    if len(inside):
        ends_at[:-1] = inside[:-1] & ~inside[1:]
        ends_at[-1] = inside[-1]
        lasts = offsets[1:][offsets[1:] > 0] - 1
        ends_at[lasts] |= inside[lasts]
    end = np.flatnonzero(ends_at) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return start, end, row


LONG_WORD = 200                # bytes from which a prefix-sum hash is no safe identity


def word_identities(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit identities of byte ranges: ``RangeHash``, and a real digest of the long ones, since its sums
    can agree on long structured ranges (Thue-Morse strings do for every base)."""
    out = RangeHash(data).of(start, end)
    for k in np.flatnonzero(end - start >= LONG_WORD):
        digest = hashlib.blake2b(data[start[k]:end[k]].tobytes(), digest_size=8).digest()
        out[k] = np.frombuffer(digest, dtype=np.uint64)[0]
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of a chunk, and its row."""
    start, end, row = words(data, offsets)
    return word_identities(data, start, end), row


def window_hashes(hashes: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` words within a row, and the index of its first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = hashes[:n]
    for k in range(1, width):
        h = mix(h) * _BASE + hashes[k:n + k]
    h = mix(h)
    at = np.flatnonzero(row[:n] == row[width - 1:n + width - 1])
    return h[at], at


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)

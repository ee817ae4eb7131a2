"""Dataset manifest: file sizes and MD5 digests, checked against an expectation.

``binaryFile`` reads each file as one row (path, length, content); the
digest is computed on the executors.  MD5 needs a file's bytes in order, but
not in one task: a file above ``RANGE_BYTES`` is read in ranges, a round of
tasks (one a file) for each range, and the state goes on to the next round
through a table.  No task reads more than a range of such a file, nor holds
more than ``PIECE_BYTES`` of it.

Ranges are read through ``pyarrow.fs``.  Where the executors can't open the
files that way (a file system only Spark knows), or OpenSSL's MD5 functions
are missing, a file is still read by one task: whole as a value (up to
Spark's 2 GB) in the first case, piece by piece in the second.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.operators.sizing import materialise
from ratewise.sources.digest import BLOCK, can_carry, carry_md5

RANGE_BYTES = 256 * 1024 * 1024
PIECE_BYTES = 8 * 1024 * 1024
STATE = "path string, length long, state binary, md5 string"


def file_manifest(spark: SparkSession, path: str, glob: str = "*", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, bytes, md5) for every file under ``path`` matching ``glob``."""
    if range_bytes <= 0 or range_bytes % BLOCK:
        raise ValueError(f"range_bytes must be a multiple of {BLOCK}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    large = files.where(F.col("length") > range_bytes).select("path", "length")
    n, opened, longest = large.mapInArrow(_opened, "length long, opened boolean").agg(
        F.count("*"), F.count_if("opened"), F.max("length")).first()
    if n == 0 or opened < n:
        found = files.select("path", "length", F.md5("content").alias("md5"))
    else:
        # the source gets the bound on the length too and leaves the content of the larger files alone
        small = files.where(F.col("length") <= range_bytes)
        found = small.select("path", "length", F.md5("content").alias("md5")).unionByName(
            _digest_ranges(large, n, longest, range_bytes).select("path", "length", "md5"))
    return found.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), F.col("length").alias("bytes"), "md5")


def _digest_ranges(large: DataFrame, n: int, longest: int, range_bytes: int) -> DataFrame:
    """``STATE`` rows with the digest of each of the ``n`` files in ``large``."""
    state = large.select("path", "length", F.lit(None).cast("binary").alias("state"),
                         F.lit(None).cast("string").alias("md5"))
    for start in range(0, longest, range_bytes):
        # as many ranges as paths: one file a task
        state = materialise(state.repartitionByRange(n, "path").mapInArrow(_advance(start, range_bytes), STATE),
                            "manifest")
    return state


def _advance(start: int, range_bytes: int) -> Callable:
    """Task of the round that begins at byte ``start``: each unfinished file's state after its next range."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                if row["md5"] is not None:
                    continue
                path, length = row["path"], row["length"]
                if not can_carry():
                    whole = hashlib.md5(usedforsecurity=False)
                    for piece in _pieces(path, 0, length):
                        whole.update(piece)
                    row["md5"] = whole.hexdigest()
                    continue
                stop = min(start + range_bytes, length)
                found = carry_md5(_pieces(path, start, stop), row["state"], start, stop == length)
                if stop == length:
                    row["state"], row["md5"] = None, found.hex()
                else:
                    row["state"] = found
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                [("path", pa.string()), ("length", pa.int64()), ("state", pa.binary()), ("md5", pa.string())]))
    return run


def _opened(batches: Iterator) -> Iterator:
    """(length, opened): whether this executor can open the file and finds it as long as listed."""
    import pyarrow as pa
    for batch in batches:
        rows = batch.to_pylist()
        opened = []
        for row in rows:
            try:
                with _open(row["path"]) as f:
                    opened.append(f.size() == row["length"])
            except (OSError, ValueError, NotImplementedError, ImportError):  # pyarrow's errors are among these
                opened.append(False)
        yield pa.RecordBatch.from_arrays([pa.array([r["length"] for r in rows], pa.int64()),
                                          pa.array(opened, pa.bool_())], ["length", "opened"])


def _open(path: str):
    """Random-access file at one of Spark's paths, which are not percent-encoded."""
    from pyarrow.fs import FileSystem
    parts = re.fullmatch(r"([^:/]+):(?://([^/]*))?(/.*)", path, re.DOTALL)
    if parts is None:
        raise ValueError(f"no absolute path with a scheme: {path}")
    scheme, authority, rest = parts.groups()
    system, root = FileSystem.from_uri(f"{scheme}://{authority or ''}/")
    return system.open_input_file(root.rstrip("/") + rest)


def _pieces(path: str, start: int, stop: int) -> Iterator[bytes]:
    """Bytes ``start`` to ``stop`` of a file, ``PIECE_BYTES`` at a time."""
    with _open(path) as f:
        for at in range(start, stop, PIECE_BYTES):
            size = min(PIECE_BYTES, stop - at)
            piece = f.read_at(size, at)
            if len(piece) != size:
                raise OSError(f"{path} ends before byte {stop}")
            yield piece


def validate_manifest(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows (file, problem) for every expected file that is missing, empty or has another digest.

    ``expected`` has (file, md5); no rows means valid.  The binary-file
    source does not list zero-length files, so an empty file is reported as
    ``missing_or_empty`` like an absent one.
    """
    exp = expected.select("file", F.col("md5").alias("expected_md5"))
    joined = exp.join(actual, "file", "left")
    problem = (F.when(F.col("bytes").isNull(), F.lit("missing_or_empty"))
               .when(F.col("bytes") == 0, F.lit("empty"))
               .when(F.col("md5") != F.col("expected_md5"), F.lit("md5_mismatch")))
    return joined.select("file", problem.alias("problem")).filter(F.col("problem").isNotNull())

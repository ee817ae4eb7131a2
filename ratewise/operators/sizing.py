"""Size-checked broadcast.

A side is broadcast only when its optimizer size estimate is known and below
the threshold; otherwise the join is left to Spark (sort-merge, with AQE
switching to broadcast at run time if the side turns out small, and splitting
skewed partitions).  Estimates come from the optimized logical plan's
statistics -- no job is run to measure them.
"""

from __future__ import annotations

import atexit
import logging
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.session import ensure_checkpoint_dir

DEFAULT_BROADCAST_BYTES = 10 * 1024 * 1024  # when the session's threshold can't be read


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of ``df`` in bytes, or None when unknown."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # noqa: BLE001 - e.g. Spark Connect: no JVM handle
        return None


def broadcast_limit(df: DataFrame) -> int:
    """The session's ``spark.sql.autoBroadcastJoinThreshold``, as it is set; 0 when broadcasts are off."""
    conf = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    try:
        value = int(str(conf).lower().replace("b", ""))
    except ValueError:
        value = DEFAULT_BROADCAST_BYTES
    return max(value, 0)


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    size = estimated_bytes(df)
    cap = broadcast_limit(df) if limit is None else limit
    return size is not None and 0 < cap and size <= cap


def join_small(big: DataFrame, small: DataFrame, on: Sequence[str] | str, how: str = "inner",
               limit: int | None = None) -> DataFrame:
    """Join ``big`` to ``small``; broadcast ``small`` only behind a size check."""
    side = F.broadcast(small) if fits_broadcast(small, limit) else small
    return big.join(side, on=list(on) if not isinstance(on, str) else on, how=how)


def materialise(df: DataFrame, tag: str = "table") -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Computes the frame once for all its readers, cuts the lineage and survives
    lost executors.  The files go when the application ends.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the shared checkpoint folder, deleted when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        _ROOTS[app] = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ratewise-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(delete_path, spark, _ROOTS[app])
    return _ROOTS[app]


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through the cluster's file system; a stopped session leaves it."""
    try:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception as exc:  # noqa: BLE001 - clean-up must not hide the job's own outcome
        logging.getLogger(__name__).debug("scratch folder %s stays: %s", path, exc)

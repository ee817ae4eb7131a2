"""Continuous recommendation concentration over the event stream.

A running count per recommended id (streaming aggregate; its state holds one
row per catalog item) is emitted in ``complete`` mode through
``foreachBatch``, which writes the per-item count table of every micro-batch
under its own number; concentration (total, top share) is then an aggregate
over the newest one.  A table is complete once its writer's ``_SUCCESS`` file
is there, so a reader never meets a half-written or missing table.  A file
sink cannot take ``complete`` mode, hence ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.streaming.progress import beside, run_batches, written


def running_item_counts(events: DataFrame, item_col: str = "movie_id") -> DataFrame:
    return events.select(F.explode("movie_ids").alias(item_col)).groupBy(item_col) \
        .agg(F.count(F.lit(1)).alias("count"))


def run_item_counts(spark: SparkSession, events: DataFrame, out_path: str, checkpoint: str | None = None) -> int:
    """Drain the stream; after each batch the full (item, count) table is written below ``out_path``.
    Returns the rows of the last table written by this run."""
    rows: list[int] = []

    def publish(batch: DataFrame, epoch: int) -> int:
        rows.append(written(batch, lambda f: f.write.mode("overwrite").parquet(f"{out_path}/epoch={epoch:010d}")))
        return rows[-1]

    run_batches(running_item_counts(events), checkpoint or beside(out_path, "progress"), publish, mode="complete")
    return rows[-1] if rows else 0


def read_item_counts(spark: SparkSession, out_path: str, item_col: str = "movie_id") -> DataFrame:
    """The newest complete (item, count) table below ``out_path``; empty before the first batch."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out_path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = files.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out_path}/epoch=*/_SUCCESS"))
    names = sorted(str(f.getPath().getParent()) for f in (done or []))
    if not names:
        return spark.createDataFrame([], f"{item_col} long, count long")
    return spark.read.parquet(names[-1])

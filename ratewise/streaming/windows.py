"""Continuous request metrics: event-time tumbling windows with a watermark.

Rows later than the watermark (max event time seen minus ``delay``) are
dropped; a window is emitted once the watermark passes its end (append
mode), so its state is evicted and state stays bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.operators.requests import status_class, validate_requests
from ratewise.streaming.progress import RowCounter, beside


def _event_time(stream: DataFrame, ts_col: str) -> DataFrame:
    """Watermarks need TIMESTAMP (with zone); a zone-less column is read as UTC."""
    return stream.withColumn(ts_col, F.col(ts_col).cast("timestamp"))


def windowed_request_rate(stream: DataFrame, duration: str = "1 minute", seconds: int = 60,
                          delay: str = "10 minutes", ts_col: str = "ts", key_col: str = "handler") -> DataFrame:
    g = (_event_time(stream, ts_col).withWatermark(ts_col, delay)
         .groupBy(F.window(ts_col, duration).alias("w"), key_col)
         .agg(F.count(F.lit(1)).alias("requests")))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key_col,
                    "requests", (F.col("requests") / F.lit(float(seconds))).alias("rate_per_s"))


def windowed_latency(stream: DataFrame, duration: str = "5 minutes", delay: str = "10 minutes",
                     ts_col: str = "ts", latency_col: str = "latency_ms") -> DataFrame:
    g = (_event_time(stream, ts_col).withWatermark(ts_col, delay)
         .groupBy(F.window(ts_col, duration).alias("w"))
         .agg(F.count(F.lit(1)).alias("requests"),
              F.percentile_approx(latency_col, [0.5, 0.95], 10000).alias("q")))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "requests",
                    F.col("q")[0].alias("p50_ms"), F.col("q")[1].alias("p95_ms"))


def windowed_error_rate(stream: DataFrame, duration: str = "1 minute", seconds: int = 60,
                        delay: str = "10 minutes", ts_col: str = "ts") -> DataFrame:
    """Rejected (4xx) and failed (5xx) requests per window."""
    errors = status_class(_event_time(stream, ts_col)).where(F.col("status") != "2xx")
    g = (errors.withWatermark(ts_col, delay)
         .groupBy(F.window(ts_col, duration).alias("w"), "status").agg(F.count(F.lit(1)).alias("errors")))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "status",
                    "errors", (F.col("errors") / F.lit(float(seconds))).alias("rate_per_s"))


def windowed_request_volume(stream: DataFrame, duration: str = "5 minutes", delay: str = "10 minutes",
                            ts_col: str = "ts", k_col: str = "k") -> DataFrame:
    """Requests, served requests and recommended items per window."""
    checked = validate_requests(_event_time(stream, ts_col), k_col)
    g = (checked.withWatermark(ts_col, delay).groupBy(F.window(ts_col, duration).alias("w")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if("valid").alias("served_requests"),
        F.coalesce(F.sum(F.when(F.col("valid"), F.col(k_col))), F.lit(0)).cast("long").alias("recommended_items")))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "requests", "served_requests", "recommended_items")


def run_to_parquet(spark: SparkSession, metrics: DataFrame, out_path: str,
                   checkpoint: str | None = None) -> int:
    """Run a windowed metric stream over all available input into Parquet (append); rows in, over all
    micro-batches of this run."""
    counter = RowCounter()
    spark.streams.addListener(counter)
    try:
        q = (metrics.writeStream.format("parquet").option("path", out_path)
             .option("checkpointLocation", checkpoint or beside(out_path, "progress")).outputMode("append")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        return counter.rows.get(str(q.runId), 0)
    finally:
        spark.streams.removeListener(counter)

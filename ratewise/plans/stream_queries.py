"""Queries over the commit log, the numbered topic and panes, with their DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.operators.panes import BOUNDS, sliding_latency, sliding_request_rate
from ratewise.operators.sizing import delete_path, materialise, scratch_root
from ratewise.plans import bridge as B
from ratewise.plans.oracle import with_ctes
from ratewise.sources import topic as topics
from ratewise.sources.eventlog import read_event_log
from ratewise.streaming.drain import drain, drain_topic
from ratewise.streaming.panes import compact, late_count, read_late, read_windows, run_panes
from ratewise.streaming.progress import beside

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _scratch(spark: SparkSession, tag: str) -> str:
    return f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"


@_query
def stream_drain_commits(spark: SparkSession, sf: str) -> DataFrame:
    """Three sources drained into one log: two under checkpoints of their own, and a third after the log's progress
    folder was lost (a new query, whose batches count from 0 again).  The log read back."""
    base = _scratch(spark, "commits")
    lines = materialise(B.event_log_json(spark, sf).withColumn("part", F.crc32(F.col("value").cast("binary")) % 3), "commits")
    for k in range(3):
        lines.where(F.col("part") == k).select("value").write.text(f"{base}/in{k}")
    log = f"{base}/log"
    drain(spark, log, fmt="text", path=f"{base}/in0")
    drain(spark, log, fmt="text", path=f"{base}/in1", checkpoint=f"{base}/other")
    delete_path(spark, beside(log, "progress"))
    drain(spark, log, fmt="text", path=f"{base}/in2")
    got = read_event_log(spark, log)
    return got.select("timestamp", "user_id", "k", "num_recommendations", "movie_ids", F.round("latency_ms", 6).alias("latency_ms"))


SQL["stream_drain_commits"] = with_ctes("""
SELECT "timestamp", user_id, k, num_recommendations, movie_ids, round(latency_ms, 6) AS latency_ms
FROM events_log""", "events_log")


@_query
def stream_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Events published to a topic of four partitions in two appends, drained in limited batches with the progress folder
    lost in between; then what a replay from the offsets after the first append gives."""
    base = _scratch(spark, "topic")
    lines = materialise(B.event_log_json(spark, sf).withColumn(
        "user", F.get_json_object("value", "$.user_id").cast("long")), "topic").withColumn("at", F.col("value"))
    topic, log = f"{base}/topic", f"{base}/log"
    stored = topics.publish(lines.where("user % 2 = 0"), topic, 4, "user", "value", "at")
    first = drain_topic(spark, log, topic, limit=max(1, max(stored.values(), default=0) // 2 + 1))
    topics.publish(lines.where("user % 2 = 1"), topic, 4, "user", "value", "at")
    delete_path(spark, beside(log, "progress"))
    second = drain_topic(spark, log, topic)
    again = drain_topic(spark, log, topic)
    replay = topics.read_topic(spark, topic, stored).agg(F.count(F.lit(1)).alias("replayed"))
    log_rows = read_event_log(spark, log).agg(F.count(F.lit(1)).alias("log_rows"), F.sum(F.size("movie_ids")).alias("items"))
    return log_rows.join(replay).select(
        F.lit(first.appended).cast("long").alias("first"), F.lit(second.appended).cast("long").alias("second"),
        F.lit(again.appended).cast("long").alias("again"), "log_rows", F.col("items").cast("long").alias("items"), "replayed")


SQL["stream_offsets"] = with_ctes("""
SELECT count(*) FILTER (user_id % 2 = 0) AS first, count(*) FILTER (user_id % 2 = 1) AS second, CAST(0 AS BIGINT) AS again,
       count(*) AS log_rows, CAST(sum(len(movie_ids)) AS BIGINT) AS items, count(*) FILTER (user_id % 2 = 1) AS replayed
FROM events_log""", "events_log")


@_query
def sliding_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Requests a second of each handler over the last minute, as of the end of each ten-second pane with requests."""
    out = sliding_request_rate(B.requests(spark, sf))
    return out.select("window_start", "window_end", "handler", "requests", F.round("rate_per_s", 6).alias("rate_per_s"))


SQL["sliding_rate"] = with_ctes("""
SELECT make_timestamp((p.pane - 5) * 10000000) AS window_start, make_timestamp((p.pane + 1) * 10000000) AS window_end, p.handler,
       count(*) AS requests, round(count(*) / 60.0, 6) AS rate_per_s
FROM (SELECT DISTINCT handler, epoch_us(ts) // 10000000 AS pane FROM requests) p
JOIN requests r ON r.handler = p.handler AND epoch_us(r.ts) >= (p.pane - 5) * 10000000 AND epoch_us(r.ts) < (p.pane + 1) * 10000000
GROUP BY p.pane, p.handler""", "requests")


@_query
def sliding_latency_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Median and 95 % latency over the last five minutes from histogram buckets, per ten-second pane with requests."""
    out = sliding_latency(B.requests(spark, sf))
    return out.select("window_start", "window_end", "requests", F.round("p50_ms", 6).alias("p50_ms"),
                      F.round("p95_ms", 6).alias("p95_ms"))


def _quantile(q: float) -> str:
    at = f"list_position(list_transform(le, lambda x: x >= {q} * n), true)"
    return f"""round(CASE WHEN {at} IS NULL THEN bs[len(bs)] ELSE
         (CASE WHEN {at} > 1 THEN bs[{at} - 1] ELSE 0.0 END)
         + (bs[{at}] - (CASE WHEN {at} > 1 THEN bs[{at} - 1] ELSE 0.0 END)) * ({q} * n - (CASE WHEN {at} > 1 THEN le[{at} - 1] ELSE 0 END))
           / (le[{at}] - (CASE WHEN {at} > 1 THEN le[{at} - 1] ELSE 0 END)) END, 6)"""


SQL["sliding_latency_quantiles"] = with_ctes(f"""
SELECT make_timestamp((pane - 29) * 10000000) AS window_start, make_timestamp((pane + 1) * 10000000) AS window_end,
       n AS requests, {_quantile(0.5)} AS p50_ms, {_quantile(0.95)} AS p95_ms
FROM (SELECT pane, n, bs, list_transform(bs, lambda b: len(list_filter(ls, lambda l: l <= b))::DOUBLE) AS le
      FROM (SELECT p.pane, count(*) AS n, list(r.latency_ms) AS ls, {[float(b) for b in BOUNDS]}::DOUBLE[] AS bs
            FROM (SELECT DISTINCT epoch_us(ts) // 10000000 AS pane FROM requests WHERE latency_ms IS NOT NULL) p
            JOIN requests r ON epoch_us(r.ts) >= (p.pane - 29) * 10000000 AND epoch_us(r.ts) < (p.pane + 1) * 10000000
            WHERE r.latency_ms IS NOT NULL GROUP BY p.pane))""", "requests")


@_query
def stream_windows_final(spark: SparkSession, sf: str) -> DataFrame:
    """Requests as a file stream in two runs (the later half by time second), one-minute windows from panes: all windows, the
    open ones included, and the table compacted in between."""
    base = _scratch(spark, "panes")
    reqs = materialise(B.requests(spark, sf).withColumn("ts", F.col("ts").cast("timestamp")), "panes")
    middle = reqs.agg(F.timestamp_micros(F.avg(F.unix_micros("ts")).cast("long"))).first()[0]
    for part in (F.col("ts") < F.lit(middle), F.col("ts") >= F.lit(middle)):
        reqs.where(part).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(reqs.schema).parquet(f"{base}/in")
        run_panes(spark, stream, f"{base}/out", 60, ["handler"])
        compact(spark, f"{base}/out", ["handler"])
    out = read_windows(spark, f"{base}/out", 60, ["handler"])
    return out.select("window_start", "window_end", "handler", "requests", F.round("rate_per_s", 6).alias("rate_per_s"), "closed")


SQL["stream_windows_final"] = with_ctes("""
SELECT *, window_end <= (SELECT max(ts) FROM requests) - INTERVAL '10 minutes' AS closed FROM (
  SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start,
         time_bucket(INTERVAL '1 minute', ts) + INTERVAL '1 minute' AS window_end,
         handler, count(*) AS requests, round(count(*) / 60.0, 6) AS rate_per_s
  FROM requests GROUP BY 1, 2, 3)""", "requests")


@_query
def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Requests of even ids first, those of odd ids in a second run: what still counts and what came too late, per handler."""
    base = _scratch(spark, "late")
    reqs = materialise(B.requests(spark, sf).withColumn("ts", F.col("ts").cast("timestamp")), "late")
    for k in (0, 1):
        reqs.where(F.col("event_id") % 2 == k).write.mode("append").parquet(f"{base}/in")
        run_panes(spark, spark.readStream.schema(reqs.schema).parquet(f"{base}/in"), f"{base}/out", 60, ["handler"])
    counted = read_windows(spark, f"{base}/out", 60, ["handler"]).groupBy("handler").agg(F.sum("requests").alias("requests"))
    behind = read_late(spark, f"{base}/out")
    behind = behind if behind is not None else reqs.limit(0)
    late = behind.groupBy("handler").agg(F.count(F.lit(1)).alias("late"))
    total = late_count(spark, f"{base}/out")
    return (counted.join(late, "handler", "full")
            .select("handler", F.coalesce("requests", F.lit(0)).cast("long").alias("requests"),
                    F.coalesce("late", F.lit(0)).cast("long").alias("late"), F.lit(total).cast("long").alias("all_late")))


SQL["stream_late_rows"] = with_ctes("""
SELECT handler, count(*) FILTER (NOT late) AS requests, count(*) FILTER (late) AS late,
       CAST(sum(count(*) FILTER (late)) OVER () AS BIGINT) AS all_late
FROM (SELECT handler, event_id % 2 = 1 AND time_bucket(INTERVAL '1 minute', ts) + INTERVAL '1 minute'
               <= (SELECT max(ts) FROM requests WHERE event_id % 2 = 0) - INTERVAL '10 minutes' AS late FROM requests)
GROUP BY handler""", "requests")

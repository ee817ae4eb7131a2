"""Request validation and request metrics over event-time windows.

Windows are tumbling ``window(ts, ...)`` groups; every aggregate is
map-side combined (counts, sums, ``percentile_approx`` sketches), so a busy
window is never gathered into one buffer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the request contract.
DEFAULT_K = 10
MIN_K = 1
MAX_K = 100
BAD_K = "k must be between 1 and 100"


def validate_requests(requests: DataFrame, k_col: str = "k") -> DataFrame:
    """Add effective ``k`` (NULL -> 10), ``valid`` and ``reason``."""
    k = F.coalesce(F.col(k_col), F.lit(DEFAULT_K))
    ok = k.between(MIN_K, MAX_K)
    return requests.withColumn(k_col, k.cast("int")).withColumn("valid", ok) \
        .withColumn("reason", F.when(ok, F.lit("ok")).otherwise(F.lit(BAD_K)))


def status_class(requests: DataFrame, k_col: str = "k", error_col: str = "is_error") -> DataFrame:
    """Add ``status``: 4xx for a rejected k, 5xx for a failed request, else 2xx."""
    checked = validate_requests(requests, k_col)
    status = F.when(~F.col("valid"), F.lit("4xx")).when(F.col(error_col), F.lit("5xx")).otherwise(F.lit("2xx"))
    return checked.withColumn("status", status)


def _window(ts_col: str, duration: str):
    return F.window(F.col(ts_col), duration)


def request_rate(requests: DataFrame, duration: str = "1 minute", seconds: int = 60,
                 ts_col: str = "ts", key_col: str = "handler") -> DataFrame:
    """(window_start, window_end, handler, requests, rate_per_s)."""
    g = requests.groupBy(_window(ts_col, duration).alias("w"), key_col).agg(F.count(F.lit(1)).alias("requests"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key_col,
                    "requests", (F.col("requests") / F.lit(float(seconds))).alias("rate_per_s"))


def error_rate(requests: DataFrame, duration: str = "1 minute", seconds: int = 60,
               ts_col: str = "ts") -> DataFrame:
    """(window_start, window_end, status, errors, rate_per_s) for 4xx / 5xx only."""
    errs = status_class(requests).filter(F.col("status") != "2xx")
    g = errs.groupBy(_window(ts_col, duration).alias("w"), "status").agg(F.count(F.lit(1)).alias("errors"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "status",
                    "errors", (F.col("errors") / F.lit(float(seconds))).alias("rate_per_s"))


def latency_quantiles(requests: DataFrame, duration: str = "5 minutes", ts_col: str = "ts",
                      latency_col: str = "latency_ms", accuracy: int = 10000) -> DataFrame:
    """(window_start, window_end, requests, p50_ms, p95_ms) via a mergeable quantile sketch."""
    q = F.percentile_approx(latency_col, [0.5, 0.95], accuracy)
    g = requests.groupBy(_window(ts_col, duration).alias("w")).agg(
        F.count(F.lit(1)).alias("requests"), q.alias("q"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "requests",
                    F.col("q")[0].alias("p50_ms"), F.col("q")[1].alias("p95_ms"))


def request_volume(requests: DataFrame, duration: str = "5 minutes", ts_col: str = "ts",
                   k_col: str = "k") -> DataFrame:
    """(window_start, window_end, requests, served_requests, recommended_items)."""
    checked = validate_requests(requests, k_col)
    g = checked.groupBy(_window(ts_col, duration).alias("w")).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if("valid").alias("served_requests"),
        F.coalesce(F.sum(F.when(F.col("valid"), F.col(k_col))), F.lit(0)).cast("long").alias("recommended_items"),
    )
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "requests", "served_requests", "recommended_items")

"""Sliding request metrics from panes.

A request falls into one pane of ``pane_seconds``; a pane row holds what can be merged: a count per key, or the
cumulative counts of a latency histogram's buckets.  A window of any length is a range frame over panes, so
neither the panes nor the shuffle grow with the window's length (a sliding ``window()`` would copy every
request into each window that holds it).

Windows end with the panes that have requests, ``window_seconds`` back from there.  A key with a large share of
all requests has one row a pane; its panes are cut into blocks of ``BLOCK`` and each block gets a copy of the
panes just before it, as many as a window reaches back, so no task holds a key's whole history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PANE = 10                   # seconds
BLOCK = 8640                # panes a task takes in a row: a day of ten-second panes
# upper bounds (milliseconds) of the latency histogram; beyond the last one there is one more bucket
BOUNDS = (5.0, 10.0, 25.0, 50.0, 75.0, 100.0, 150.0, 250.0, 500.0, 1000.0)


def pane_of(ts: str | Column, seconds: int = PANE) -> Column:
    """Number of the pane that a time falls into."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(col.cast("timestamp")) / (seconds * 1_000_000)).cast("long")


def count_panes(requests: DataFrame, keys: Sequence[str], ts_col: str = "ts", seconds: int = PANE) -> DataFrame:
    """keys, pane, requests."""
    return requests.groupBy(*keys, pane_of(ts_col, seconds).alias("pane")).agg(F.count(F.lit(1)).alias("requests"))


def latency_panes(requests: DataFrame, latency_col: str = "latency_ms", ts_col: str = "ts", seconds: int = PANE,
                  bounds: Sequence[float] = BOUNDS) -> DataFrame:
    """pane, requests, and le_0, le_1, ...: how many took at most the bucket's bound.  A null latency is in no bucket
    and not counted."""
    known = requests.where(F.col(latency_col).isNotNull())
    return known.groupBy(pane_of(ts_col, seconds).alias("pane")).agg(
        F.count(F.lit(1)).alias("requests"),
        *[F.count_if(F.col(latency_col) <= F.lit(float(b))).alias(f"le_{k}") for k, b in enumerate(bounds)])


def merged_panes(panes: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Panes of several batches put together: one row per key and pane."""
    return panes.groupBy(*keys, "pane").agg(*[F.sum(c).alias(c) for c in sums])


def sliding(panes: DataFrame, keys: Sequence[str], sums: Sequence[str], window_seconds: int, seconds: int = PANE) -> DataFrame:
    """For each key and pane, ``sums`` over the window that ends with the pane: window_start, window_end (timestamps
    without zone), keys, sums."""
    if window_seconds <= 0 or window_seconds % seconds:
        raise ValueError("a window is a whole number of panes")
    reach = window_seconds // seconds - 1                   # panes before the last one
    block = F.floor(F.col("pane") / BLOCK)
    # a pane that later blocks look back to is copied there: mostly none, one if windows are shorter than a block
    last = F.floor((F.col("pane") + reach) / BLOCK)
    placed = panes.select(*keys, "pane", *sums, block.alias("_home"), F.explode(F.sequence(block, last)).alias("_block"))
    frame = Window.partitionBy(*keys, "_block").orderBy("pane").rangeBetween(-reach, 0)
    summed = placed.select(*keys, "pane", "_home", "_block", *[F.sum(c).over(frame).alias(c) for c in sums])
    end = (F.col("pane") + 1) * seconds
    return summed.where("_home = _block").select(
        F.timestamp_seconds(end - window_seconds).cast("timestamp_ntz").alias("window_start"),
        F.timestamp_seconds(end).cast("timestamp_ntz").alias("window_end"), *keys, *sums)


def sliding_request_rate(requests: DataFrame, window_seconds: int = 60, keys: Sequence[str] = ("handler",),
                         ts_col: str = "ts") -> DataFrame:
    """Requests and requests a second of each key over sliding windows."""
    wide = sliding(count_panes(requests, keys, ts_col), keys, ["requests"], window_seconds)
    return wide.withColumn("rate_per_s", F.col("requests") / F.lit(float(window_seconds)))


def bucket_quantile(q: float, total: Column, below: Sequence[Column], bounds: Sequence[float] = BOUNDS) -> Column:
    """Quantile of a histogram with cumulative counts ``below``: linear inside the bucket that holds the rank, from 0 in
    the first one; the last bound if the rank lies beyond it; null without requests."""
    rank = F.lit(float(q)) * total
    out = F.lit(float(bounds[-1]))
    for k in range(len(bounds) - 1, -1, -1):
        lower, before = (float(bounds[k - 1]), below[k - 1]) if k else (0.0, F.lit(0))
        inside = below[k] - before
        at = F.lit(lower) + F.lit(float(bounds[k]) - lower) * F.coalesce(F.try_divide(rank - before, inside), F.lit(0.0))
        out = F.when(below[k] >= rank, at).otherwise(out)
    return F.when(total > 0, out)


def sliding_latency(requests: DataFrame, window_seconds: int = 300, quantiles: Sequence[float] = (0.5, 0.95),
                    ts_col: str = "ts", latency_col: str = "latency_ms", bounds: Sequence[float] = BOUNDS) -> DataFrame:
    """Requests and latency quantiles (p50_ms, p95_ms) over sliding windows, from histogram buckets."""
    sums = ["requests", *[f"le_{k}" for k in range(len(bounds))]]
    wide = sliding(latency_panes(requests, latency_col, ts_col, bounds=bounds), [], sums, window_seconds)
    below = [F.col(c) for c in sums[1:]]
    return wide.select("window_start", "window_end", "requests",
                       *[bucket_quantile(q, F.col("requests"), below, bounds).alias(f"p{round(q * 100)}_ms") for q in quantiles])

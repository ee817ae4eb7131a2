"""Recommendation concentration: per-item frequency, total, top share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def item_frequency(events: DataFrame, item_col: str = "movie_id") -> DataFrame:
    """(item, count) over all served lists; map-side combined count."""
    ids = events.select(F.explode("movie_ids").alias(item_col))
    return ids.groupBy(item_col).agg(F.count(F.lit(1)).alias("count"))


def concentration(freq: DataFrame) -> DataFrame:
    """One row: total, distinct_items, top_count, top_movie_share (0.0 when empty)."""
    agg = freq.agg(
        F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("total"),
        F.count(F.lit(1)).alias("distinct_items"),
        F.coalesce(F.max("count"), F.lit(0)).cast("long").alias("top_count"),
    )
    share = F.when(F.col("total") > 0, F.col("top_count") / F.col("total")).otherwise(F.lit(0.0))
    return agg.withColumn("top_movie_share", share)

"""Batch serving: requests -> ranked ids with titles -> event records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.operators.requests import MAX_K, MIN_K
from ratewise.operators.sizing import join_small

UNKNOWN_TITLE = "Unknown title"  # fixed value


def with_titles(recs: DataFrame, catalog: DataFrame, item_col: str = "movie_id",
                title_col: str = "title") -> DataFrame:
    """Left join titles (catalog broadcast behind a size check); unknown id -> 'Unknown title', no id
    (an empty list) -> no title."""
    cat = catalog.select(item_col, title_col)
    out = join_small(recs, cat, item_col, "left")
    return out.withColumn(title_col, F.when(F.col(item_col).isNotNull(),
                                                F.coalesce(F.col(title_col), F.lit(UNKNOWN_TITLE))))


def ranked_positions(events: DataFrame, item_col: str = "movie_id") -> DataFrame:
    """Served lists -> (event columns..., rank, item) with 1-based rank."""
    keep = [c for c in events.columns if c != "movie_ids"]
    return events.select(*keep, F.posexplode("movie_ids").alias("_p", item_col)) \
        .withColumn("rank", (F.col("_p") + 1).cast("int")).drop("_p")


def serve_from_topk(requests: DataFrame, topk: DataFrame, user_col: str = "user_id",
                    k_col: str = "k", rank_col: str = "rank") -> DataFrame:
    """Per-request cut of per-user top lists: keep ``rank <= k`` of the request.

    ``topk`` holds each user's list up to the largest requested k.  A request
    of a user without a list stays as one row without rank and item.
    """
    lists = topk.withColumnRenamed(user_col, "_user")
    return requests.join(lists, (F.col(user_col) == F.col("_user")) & (F.col(rank_col) <= F.col(k_col)), "left").drop("_user")


def serve_from_ranking(requests: DataFrame, ranking: DataFrame, k_col: str = "k", pos_col: str = "pos",
                       rank_col: str = "rank", item_col: str = "movie_id") -> DataFrame:
    """Non-personal model: request i gets ranking positions 1..k_i.

    The ranking is joined on the position; positions 1..k are shared by all
    requests, so the ranking prefix (at most ``MAX_K`` rows) is what gets
    broadcast.  A request with an invalid k, or with nothing to recommend,
    stays as one row without rank and item; ``validate_requests`` names the reason.
    """
    k = F.col(k_col)
    slots = requests.withColumn(rank_col, F.explode_outer(F.when(k.between(MIN_K, MAX_K), F.sequence(F.lit(1), k))))
    prefix = ranking.filter(F.col(pos_col).between(MIN_K, MAX_K))
    served = slots.join(F.broadcast(prefix), slots[rank_col] == prefix[pos_col], "left").drop(pos_col)
    served = served.where(F.col(item_col).isNotNull() | F.col(rank_col).isNull() | (F.col(rank_col) == 1))
    return served.withColumn(rank_col, F.when(F.col(item_col).isNotNull(), F.col(rank_col)))

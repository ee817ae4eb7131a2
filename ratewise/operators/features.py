"""Feature table: rating statistics joined back to the fact, dimensions joined on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.functions.text import GENRES, multi_hot, release_year
from ratewise.functions.time import year_of_epoch
from ratewise.operators.sizing import join_small, materialise


def rating_stats(ratings: DataFrame, key: str, prefix: str, rating_col: str = "rating") -> DataFrame:
    """(key, <prefix>_rating_count, <prefix>_avg_rating); partial+final hash aggregate."""
    return ratings.groupBy(key).agg(
        F.count(rating_col).alias(f"{prefix}_rating_count"),
        F.avg(rating_col).alias(f"{prefix}_avg_rating"),
    )


def add_rating_features(ratings: DataFrame, item_col: str = "movie_id", user_col: str = "user_id",
                        time_col: str = "timestamp", rating_col: str = "rating") -> DataFrame:
    """Add rating_year and per-item / per-user count and mean.

    Aggregate-then-join instead of ``count() over (partition by ...)``: the
    aggregate combines map-side, and the join-back of a hot key is split by
    AQE's skew-join handling; a window would put a hot key in one task.
    The item table is catalog-sized (broadcast behind a size check); the
    user table grows with the users and is shuffle-joined.
    """
    ratings = materialise(ratings, "clean")  # read three times below: compute the clean fact once
    base = ratings.withColumn("rating_year", year_of_epoch(time_col))
    items = rating_stats(ratings, item_col, "movie", rating_col)
    users = rating_stats(ratings, user_col, "user", rating_col)
    out = join_small(base, items, item_col, "left")
    return out.join(users, user_col, "left")


def movie_dimension(movies: DataFrame, vocabulary: Sequence[str] = GENRES,
                    genres_col: str = "genres", title_col: str = "title") -> DataFrame:
    """Movies + release_year + one 0/1 column per vocabulary entry (single projection)."""
    return movies.select("*", release_year(title_col).alias("release_year"),
                         *multi_hot(genres_col, vocabulary))


# What a missing statistic or year becomes in the feature table.
FILL_DEFAULTS = {
    "movie_rating_count": 0,
    "movie_avg_rating": 0.0,
    "user_rating_count": 0,
    "user_avg_rating": 0.0,
    "release_year": 0,
}


def feature_table(ratings: DataFrame, movies: DataFrame, users: DataFrame,
                  item_col: str = "movie_id", user_col: str = "user_id") -> DataFrame:
    """Clean ratings + stats, inner-joined to the movie and user dimensions, NULLs filled.

    ``ratings`` must already be clean; ``movies`` must carry the flags of
    ``movie_dimension``.  Unknown items / users are dropped by the inner joins.
    """
    enriched = add_rating_features(ratings, item_col=item_col, user_col=user_col)
    full = enriched.join(movies, item_col, "inner").join(users, user_col, "inner")
    return full.na.fill(FILL_DEFAULTS)

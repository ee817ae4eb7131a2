"""Per-user temporal split and the user -> items relations derived from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.operators.ranking import rank_within

RELEVANCE_THRESHOLD = 4  # fixed value: rating >= 4 counts as relevant


def tag_temporal_split(ratings: DataFrame, test_frac: float = 0.2, user_col: str = "user_id",
                       time_col: str = "timestamp", item_col: str = "movie_id") -> DataFrame:
    """Add ``is_test``: each user's latest ``round(n * test_frac)`` rows (at least 1).

    Order inside a user is (time, item) -- total, since (user, item) is unique
    after cleaning.  Rounding is half-even (``rint``), like Python's ``round``.
    A user with a single row goes to test only.  The rank is computed with the
    skew-safe ``rank_within``, so one very active user does not become one task.
    """
    ranked = rank_within(ratings, [user_col], [time_col, item_col], rank_col="_rn", size_col="_n")
    n_test = F.greatest(F.lit(1), F.rint(F.col("_n") * F.lit(float(test_frac))).cast("long"))
    return ranked.withColumn("is_test", F.col("_rn") > F.col("_n") - n_test).drop("_rn", "_n")


def split_frames(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, test) from a frame tagged by ``tag_temporal_split``."""
    train = tagged.filter(~F.col("is_test")).drop("is_test")
    test = tagged.filter(F.col("is_test")).drop("is_test")
    return train, test


def seen_items(train: DataFrame, user_col: str = "user_id", item_col: str = "movie_id") -> DataFrame:
    """User -> seen items, long form (one row per pair).

    Long form instead of ``collect_set``: a heavy user's set never has to fit
    one row; exclusion is an anti-join on (user, item).
    """
    return train.select(user_col, item_col).distinct()


def relevant_items(test: DataFrame, threshold: float = RELEVANCE_THRESHOLD, user_col: str = "user_id",
                   item_col: str = "movie_id", rating_col: str = "rating") -> DataFrame:
    """User -> test items rated at or above ``threshold``, long form."""
    return test.filter(F.col(rating_col) >= threshold).select(user_col, item_col).distinct()

"""Cleaning: NULL drops, range checks, deterministic de-duplication, audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any (or the listed) column."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def in_range(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    """Closed range predicate ``low <= col <= high``."""
    return df.filter(F.col(col).between(low, high))


def first_per_key(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Keep one row per key: the first by ``order_cols`` (ascending).

    Written as ``min(struct(order..., rest...))`` per key rather than a
    ``row_number`` window: the aggregate is combined map-side, so a key that
    holds a large share of the rows is reduced before the shuffle instead of
    landing whole in one task.  Ties on ``order_cols`` are broken by the
    remaining columns, so the choice never depends on input order.
    """
    keys = list(key_cols)
    order = [c for c in order_cols if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_first")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col("_first")[c].alias(c) for c in order + rest]).select(*df.columns)


def clean_ratings(ratings: DataFrame, low: int = 1, high: int = 5,
                  key_cols: Sequence[str] = ("user_id", "movie_id"),
                  order_cols: Sequence[str] = ("timestamp",),
                  rating_col: str = "rating") -> tuple[DataFrame, Observation, Observation]:
    """NULL drop, rating range, one row per (user, item) -- earliest event first.

    Returns the clean frame and two ``Observation``s (rows in / rows out);
    they fill in when the caller's action runs, so the audit costs no extra job.
    """
    seen_in = Observation("ratings_in")
    seen_out = Observation("ratings_out")
    counted = ratings.observe(seen_in, F.count(F.lit(1)).alias("rows"))
    valid = in_range(drop_incomplete(counted), rating_col, low, high)
    deduped = first_per_key(valid, key_cols, order_cols)
    return deduped.observe(seen_out, F.count(F.lit(1)).alias("rows")), seen_in, seen_out


def clean_movies(movies: DataFrame, id_col: str = "movie_id", title_col: str = "title") -> DataFrame:
    """Drop rows without id/title, keep one row per id (smallest title, then genres)."""
    valid = drop_incomplete(movies, [id_col, title_col])
    return first_per_key(valid, [id_col], [c for c in movies.columns if c != id_col])


def clean_users(users: DataFrame, id_col: str = "user_id") -> DataFrame:
    """Drop incomplete rows, one row per user (deterministic choice)."""
    return first_per_key(drop_incomplete(users), [id_col], [c for c in users.columns if c != id_col])


def audit_counts(table: str, raw: DataFrame, stages: Sequence[tuple[str, Column]],
                 final: DataFrame | None = None) -> DataFrame:
    """Rows kept after each cleaning stage, as long rows (table, stage, step, rows).

    ``stages`` are cumulative predicates evaluated in **one** pass over the raw
    input (conditional counts); ``final`` adds the de-duplicated row count.
    """
    exprs = [F.count(F.lit(1)).alias("s0")]
    names = ["raw"]
    for i, (name, pred) in enumerate(stages, start=1):
        exprs.append(F.count_if(pred).alias(f"s{i}"))
        names.append(name)
    wide = raw.agg(*exprs)
    stack = ", ".join(f"{i}, '{n}', s{i}" for i, n in enumerate(names))
    long = wide.selectExpr(f"stack({len(names)}, {stack}) as (step, stage, rows)")
    if final is not None:
        long = long.unionByName(final.agg(F.count(F.lit(1)).alias("rows"))
                                .select(F.lit(len(names)).alias("step"), F.lit("deduplicated").alias("stage"), "rows"))
    return long.select(F.lit(table).alias("table_name"), "step", "stage", F.col("rows").cast("long").alias("rows"))


def null_audit(df: DataFrame) -> DataFrame:
    """One row: total rows and the number of NULL cells over all columns."""
    cells = [F.count_if(F.col(c).isNull()) for c in df.columns]
    total = cells[0]
    for c in cells[1:]:
        total = total + c
    return df.agg(F.count(F.lit(1)).cast("long").alias("rows"), total.cast("long").alias("null_cells"))


def distinct_catalog(df: DataFrame, id_col: str = "movie_id", title_col: str = "title") -> DataFrame:
    """One (id, title) row per id; the smallest title when several exist."""
    return df.groupBy(id_col).agg(F.min(title_col).alias(title_col))


def stats_per_item(wide: DataFrame, id_col: str = "movie_id",
                   stat_cols: Sequence[str] = ("movie_rating_count", "movie_avg_rating")) -> DataFrame:
    """One stats row per item from a table that repeats them per rating.

    The stats are functionally dependent on the id, so ``min`` picks the value.
    """
    return wide.groupBy(id_col).agg(*[F.min(c).alias(c) for c in stat_cols])

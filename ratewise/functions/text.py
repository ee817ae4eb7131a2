"""Text parsing expressions: positional fields, release year, tag lists, multi-hot."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The genre vocabulary of the movie dimension, in its published order.
GENRES = [
    "Action", "Adventure", "Animation", "Children's", "Comedy", "Crime",
    "Documentary", "Drama", "Fantasy", "Film-Noir", "Horror", "Musical",
    "Mystery", "Romance", "Sci-Fi", "Thriller", "War", "Western",
]

# Fixed value: a year in parentheses at the very end of a title, e.g. "Heat (1995)".
YEAR_AT_END = r"\((\d{4})\)\s*$"


def split_field(value: Column | str, index: int, sep: str = "::",
                dtype: T.DataType = T.StringType()) -> Column:
    """Field ``index`` (0-based) of a delimited string, cast leniently.

    A missing field or a value that does not parse gives NULL (``try_cast``),
    so cleaning can drop the row later instead of the job failing under ANSI.
    """
    col = F.col(value) if isinstance(value, str) else value
    parts = F.split(col, _regex_literal(sep))
    field = F.get(parts, F.lit(index))
    if isinstance(dtype, T.StringType):
        return field
    return F.trim(field).try_cast(dtype)


def _regex_literal(sep: str) -> str:
    special = set(".^$*+?()[]{}|\\")
    return "".join("\\" + c if c in special else c for c in sep)


def release_year(title: Column | str) -> Column:
    """Year from a trailing ``(YYYY)`` in the title; NULL when absent."""
    col = F.col(title) if isinstance(title, str) else title
    found = F.regexp_extract(col, YEAR_AT_END, 1)
    return F.when(found == "", F.lit(None).cast("int")).otherwise(found.try_cast("int"))


def tokens(value: Column | str, sep: str = "|") -> Column:
    """Delimited list held in a string -> array<string>."""
    col = F.col(value) if isinstance(value, str) else value
    return F.split(col, _regex_literal(sep))


def genre_slug(name: str, prefix: str = "genre_") -> str:
    """Column name of a vocabulary entry: lower case, '-' -> '_', quotes dropped."""
    return prefix + name.lower().replace("-", "_").replace("'", "")


def multi_hot(value: Column | str, vocabulary: Iterable[str], sep: str = "|",
              prefix: str = "genre_") -> list[Column]:
    """One 0/1 int column per vocabulary entry; exact token match.

    Returned as a list so the caller adds all flags in one ``select``
    (one projection instead of a chain of ``withColumn``).
    """
    toks = tokens(value, sep)
    return [F.coalesce(F.array_contains(toks, name), F.lit(False)).cast("int").alias(genre_slug(name, prefix))
            for name in vocabulary]

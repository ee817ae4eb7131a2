"""Delimited text scans (``::``-separated rating / user / movie files).

The CSV source splits lines in parallel; a multi-character separator, an
explicit encoding (ISO-8859-1 for the movie titles) and no quote character
(titles keep literal double quotes) are all reader options.  Every field is
read as text and converted with ``try_cast``: a short line or a non-numeric
field gives NULL, which cleaning drops -- the job never fails on one bad row.
Blank lines are skipped by the reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise.schemas import MOVIES, RATINGS, USERS


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = "::",
                   encoding: str = "UTF-8") -> DataFrame:
    """Scan ``path`` into ``schema``; unparsable values become NULL."""
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = (spark.read.schema(as_text)
           .option("sep", sep).option("encoding", encoding)
           .option("quote", "").option("escape", "").option("header", "false")
           .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
           .option("mode", "PERMISSIVE")
           .csv(path))
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        cols.append((c if isinstance(f.dataType, T.StringType) else F.trim(c).try_cast(f.dataType)).alias(f.name))
    return raw.select(*cols)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, RATINGS)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, USERS)


def read_movies(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    return read_delimited(spark, path, MOVIES, encoding=encoding)


def parse_lines(lines: DataFrame, schema: T.StructType, sep: str = "::", value_col: str = "value") -> DataFrame:
    """Same typed projection for delimited text already in a column (P1)."""
    from ratewise.functions.text import split_field
    return lines.select(*[split_field(value_col, i, sep, f.dataType).alias(f.name)
                          for i, f in enumerate(schema.fields)])

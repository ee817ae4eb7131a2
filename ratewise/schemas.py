"""Declared schemas of the raw inputs and of the served-recommendation event."""

from __future__ import annotations

from pyspark.sql import types as T

RATINGS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("movie_id", T.LongType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("timestamp", T.LongType()),
])

USERS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("occupation", T.IntegerType()),
    T.StructField("zip_code", T.StringType()),
])

MOVIES = T.StructType([
    T.StructField("movie_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])

# One served recommendation list (JSON line in the event log / topic value).
EVENT = T.StructType([
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("k", T.IntegerType()),
    T.StructField("num_recommendations", T.IntegerType()),
    T.StructField("movie_ids", T.ArrayType(T.LongType())),
    T.StructField("latency_ms", T.DoubleType()),
])

EVENT_WITH_CORRUPT = T.StructType(EVENT.fields + [T.StructField("_corrupt_record", T.StringType())])

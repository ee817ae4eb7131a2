"""Views over the driver's TPC-H-style tables in the shape the library expects.

The driver's tables carry no ratings, so the catalogue reads them through
these definitions (the DuckDB oracle inlines the same ones as CTEs):

* interactions -- lineitem joined to orders: user = customer, item = part,
  rating = ceil(quantity / 10) in 1..5, timestamp = epoch seconds of the order date;
* items        -- part: title = name plus " (1990 + size)" for even sizes,
  genres = the name's words joined by '|';
* users        -- customer: segment and nation;
* event log    -- one served list per order: the order's parts, as JSON text;
* requests     -- ``events``: k from ``props``, latency = value;
* run history  -- one run per order: family = priority, start = order date, recall = price (none for pending orders);
* factors      -- ``embeddings``: every vector is both a user and an item (itself excluded).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions.json import event_json
from ratewise.functions.time import epoch_seconds
from ratewise.operators.clean import drop_incomplete, first_per_key, in_range

# The words that make up part names, used as the tag vocabulary.
PART_TAGS = [
    "anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large",
    "new", "old", "plate", "red", "ring", "rod", "small", "widget",
]

DEDUPE_ORDER = ("timestamp", "l_orderkey", "l_linenumber", "l_quantity")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = li.join(od, li["l_orderkey"] == od["o_orderkey"], "inner")
    return joined.select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        F.ceil(F.col("l_quantity") / 10).cast("int").alias("rating"),
        epoch_seconds("o_orderdate").alias("timestamp"),
        "l_orderkey", "l_linenumber", "l_quantity",
    )


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First interaction per (user, item) by (time, order, line, quantity); 1 <= rating <= 5."""
    valid = in_range(drop_incomplete(interactions(spark, sf_dir)), "rating", 1, 5)
    deduped = first_per_key(valid, ["user_id", "movie_id"], DEDUPE_ORDER)
    return deduped.select("user_id", "movie_id", "rating", "timestamp")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    year = F.lit(1990) + F.col("p_size")
    title = F.when(F.col("p_size") % 2 == 0,
                   F.concat(F.col("p_name"), F.lit(" ("), year.cast("string"), F.lit(")"))).otherwise(F.col("p_name"))
    return part.select(
        F.col("p_partkey").alias("movie_id"),
        title.alias("title"),
        F.regexp_replace("p_name", " ", "|").alias("genres"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
    )


def event_log_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON line per order: the served list is the order's parts (repeats kept, sorted).

    An order's lines are one served list (up to some tens of lines in the
    generated tables), which the event format holds as one array.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    lists = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_partkey")).alias("movie_ids"))
    ev = od.join(lists, od["o_orderkey"] == lists["l_orderkey"], "inner")
    return ev.select(event_json(
        epoch_seconds("o_orderdate").cast("double").alias("timestamp"),
        F.col("o_custkey").alias("user_id"),
        F.size("movie_ids").alias("k"),
        F.size("movie_ids").alias("num_recommendations"),
        F.col("movie_ids"),
        (F.col("o_totalprice") / 1000).alias("latency_ms"),
    ).alias("value"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log: ts, user, requested k (may be NULL / out of range), latency, handler, error flag."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.col("ts"),
        "user_id",
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.col("value").alias("latency_ms"),
        F.col("event_type").alias("handler"),
        (F.col("event_type") == "error").alias("is_error"),
    )


def factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding as a factor row (id, features array<float>); each vector acts as a user
    and as an item, and its own id is the one "seen" item to skip."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))


RUN_HISTORY = "run_id string, family string, start_time long, recall_at_10 double"


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long runs table of several families, with runs without the metric: one run per order, with the order's year."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderpriority").alias("family"),
        epoch_seconds("o_orderdate").alias("start_time"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 1e6).alias("recall_at_10"),
        F.year("o_orderdate").alias("year"),
    )

"""Served-recommendation event log: JSON lines read, appended, published.

* ``read_event_log`` -- schema'd JSON scan of appended files and of the committed writes of drains
  (``commits``); a missing path means "no events"
  (empty typed frame, not an error); malformed lines are kept in
  ``_corrupt_record`` (PERMISSIVE) and counted, or fail the job (FAILFAST);
  an absent ``movie_ids`` becomes an empty list.
* ``append_events`` -- append sink, returns rows written (observed, no 2nd job).
* ``publish_events`` -- recommendations -> one JSON record per served list ->
  any batch sink format (``json`` files here; ``kafka`` where the connector exists).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ratewise.functions.json import well_formed
from ratewise.operators.sizing import materialise
from ratewise.schemas import EVENT, EVENT_WITH_CORRUPT
from ratewise.sources.commits import visible_paths


def _empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_event_log(spark: SparkSession, path: str, mode: str = "PERMISSIVE",
                   keep_corrupt: bool = False) -> DataFrame:
    """Event log as typed rows; ``_corrupt_record`` kept only when asked."""
    schema = EVENT_WITH_CORRUPT if mode == "PERMISSIVE" else EVENT
    paths = visible_paths(spark, path)      # a log that is not there yet has none
    df = (spark.read.schema(schema).option("mode", mode).option("columnNameOfCorruptRecord", "_corrupt_record").json(paths)
          if paths else _empty(spark, schema))
    df = df.withColumn("movie_ids", F.coalesce("movie_ids", F.array().cast("array<bigint>")))
    if mode == "PERMISSIVE" and not keep_corrupt:
        # the size() term keeps a parsed column in the scan: Spark refuses scans
        # whose only referenced column is the corrupt-record column
        df = df.filter(F.col("_corrupt_record").isNull() & (F.size("movie_ids") >= 0)).drop("_corrupt_record")
    return df


def parse_event_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Text lines (e.g. a topic's ``value`` or a text scan) -> typed events; lines that are no JSON
    object are left out, sparse events stay."""
    text = lines.select(F.col(value_col).cast("string").alias("value")).filter(well_formed("value"))
    parsed = text.select(F.from_json("value", EVENT).alias("e")).select("e.*")
    return parsed.withColumn("movie_ids", F.coalesce("movie_ids", F.array().cast("array<bigint>")))


def corrupt_count(spark: SparkSession, path: str) -> DataFrame:
    """One row: lines, parsed lines and lines that did not parse."""
    df = read_event_log(spark, path, keep_corrupt=True)
    bad = F.col("_corrupt_record").isNotNull()
    return df.agg(F.count(F.lit(1)).alias("lines"),
                  F.count_if(~bad & (F.size("movie_ids") >= 0)).alias("parsed_lines"),
                  F.count_if(bad).alias("corrupt_lines"))


def recommended_ids(events: DataFrame, item_col: str = "movie_id") -> DataFrame:
    """Flatten served lists: one row per recommended id, repeats kept."""
    return events.select(F.explode("movie_ids").alias(item_col))


def event_records(recs: DataFrame, request_col: str = "event_id", ts_col: str = "ts",
                  user_col: str = "user_id", k_col: str = "k", item_col: str = "movie_id",
                  rank_col: str = "rank", latency_col: str | None = None) -> DataFrame:
    """Long recommendations (request, rank, item) -> one event per served list.

    Grouped by the request id; a served list holds at most ``k`` (<= 100)
    ids, so the per-request ``collect_list`` is bounded by the request, not
    by the data.  Ids are ordered by rank.
    """
    keys = [request_col, ts_col, user_col, k_col] + ([latency_col] if latency_col else [])
    # a request without recommendations comes as one row without an item: an empty list, still an event
    ranked = F.when(F.col(item_col).isNotNull(), F.struct(rank_col, item_col))
    grouped = recs.groupBy(*keys).agg(F.array_sort(F.collect_list(ranked)).alias("_ranked"))
    ids = F.transform("_ranked", lambda s: s[item_col])
    return grouped.select(
        F.col(ts_col).cast("double").alias("timestamp"),
        F.col(user_col).cast("long").alias("user_id"),
        F.col(k_col).cast("int").alias("k"),
        F.size("_ranked").alias("num_recommendations"),
        ids.alias("movie_ids"),
        (F.col(latency_col).cast("double") if latency_col else F.lit(None).cast("double")).alias("latency_ms"),
    )


def to_json_lines(events: DataFrame) -> DataFrame:
    """Typed events -> single ``value`` column of JSON text."""
    return events.select(F.to_json(F.struct(*events.columns)).alias("value"))


def append_events(events: DataFrame, path: str) -> int:
    """Append events as JSON lines under ``path``; returns the number written."""
    obs = Observation("appended")
    events.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").json(path)
    return int(obs.get.get("rows", 0))


def publish_events(events: DataFrame, fmt: str = "json", path: str | None = None,
                   options: dict[str, str] | None = None) -> bool:
    """Publish events to a sink; a sink failure is reported, never raised.

    Publishing is a monitoring side channel: the served result must not fail
    because the sink is down.  The events are materialised first, so a failure
    of the recommendation plan itself is raised; a sink failure is logged.
    Returns True when the write went through.
    """
    events = materialise(events, "publish")
    # "json" writes the typed columns (one JSON object per line); "text" and
    # message sinks such as "kafka" take the JSON text in a ``value`` column
    payload = events if fmt == "json" else to_json_lines(events)
    writer = payload.write.mode("append").format(fmt)
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    try:
        if path is not None:
            writer.save(path)
        else:
            writer.save()
        return True
    except Exception:  # noqa: BLE001 - isolation is the point
        logging.getLogger(__name__).exception("events were not published to %s %s", fmt, path or "")
        return False


def write_status(status: DataFrame, path: str) -> None:
    """One-row status record (drift / frequency), overwritten each run."""
    status.coalesce(1).write.mode("overwrite").json(path)

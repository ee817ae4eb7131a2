"""End-to-end jobs: the flows of the system, each one lazy plan per output.

* ``build_features``   raw ``::`` files -> clean -> feature table (Parquet, optional CSV), audit counts;
* ``train_and_select`` feature table -> per-user split -> four models -> runs table -> run selected from it;
* ``serve``            requests -> validated -> lists with titles -> events published;
* ``monitor``          event source -> drained log -> item counts, concentration, drift status,
                       monitoring snapshot (status records overwritten each run).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions.text import GENRES
from ratewise.models.evaluation import evaluate_families, fit_families, select_run
from ratewise.operators import clean as C
from ratewise.operators.concentration import concentration, item_frequency
from ratewise.operators.drift import FEATURES, column_tests, current_population, drift_status
from ratewise.operators.features import feature_table, movie_dimension
from ratewise.operators.requests import validate_requests
from ratewise.operators.serving import serve_from_topk, with_titles
from ratewise.operators.sizing import materialise
from ratewise.operators.snapshot import monitoring_snapshot
from ratewise.operators.split import split_frames, tag_temporal_split
from ratewise.sources.delimited import read_movies, read_ratings, read_users
from ratewise.sources.eventlog import corrupt_count, event_records, publish_events, read_event_log, write_status
from ratewise.sources.files import load_columns, write_csv, write_parquet
from ratewise.sources.selection import append_runs, promote, read_runs
from ratewise.streaming.drain import drain


log = logging.getLogger(__name__)


def build_features(spark: SparkSession, ratings_path: str, movies_path: str, users_path: str,
                   out_path: str, csv_path: str | None = None) -> dict[str, int]:
    """Write the feature table; returns the audit counts (rows in / kept) gathered during the write."""
    ratings, rows_in, rows_out = C.clean_ratings(read_ratings(spark, ratings_path))
    raw_movies, raw_users = read_movies(spark, movies_path), read_users(spark, users_path)
    movies, users = C.clean_movies(raw_movies), C.clean_users(raw_users)
    audit = {}
    for name, raw, kept in (("movies", raw_movies, movies), ("users", raw_users, users)):
        audit |= {f"{name}_in": raw.count(), f"{name}_kept": kept.count()}     # numbers of rows
    movies = movie_dimension(movies, GENRES)
    table = feature_table(ratings, movies, users)
    write_parquet(table, out_path)
    if csv_path:
        write_csv(spark.read.parquet(out_path), csv_path)  # from the written table, not a recompute
    return audit | {"ratings_in": int(rows_in.get.get("rows", 0)), "ratings_kept": int(rows_out.get.get("rows", 0))}


def train_and_select(spark: SparkSession, features_path: str, runs_path: str, model_dir: str,
                     test_frac: float = 0.2, k: int = 10) -> DataFrame:
    """Evaluate the four families on one split, append the runs, select over the stored runs.

    Every run's model is saved under ``<model_dir>/runs/<run_id>`` before its run is listed; the selection reads the
    whole runs table (look-back and latest-per-family rule), so an earlier training's run can win.  It is promoted to
    the next version below ``<model_dir>/selection``; trainings may run at the same time.  Returns the selected run.
    """
    ratings = load_columns(spark, features_path, ["user_id", "movie_id", "rating", "timestamp"])
    train, test = split_frames(materialise(tag_temporal_split(ratings, test_frac), "split"))
    models = fit_families(train)
    runs = evaluate_families(train, test, k, models)
    for row in runs.select("run_id", "family").collect():       # one row per family
        models[row["family"]].save(f"{model_dir}/runs/{row['run_id']}")
    append_runs(runs, runs_path)
    made = promote(spark, lambda: read_runs(spark, runs_path), lambda stored: select_run(stored, k), f"{model_dir}/selection")
    return read_runs(spark, runs_path).where(F.col("run_id") == (made["run_id"] if made else None))


def serve(requests: DataFrame, topk: DataFrame, catalog: DataFrame, fmt: str = "json", path: str | None = None,
          options: dict[str, str] | None = None) -> tuple[DataFrame, bool]:
    """Requests -> validated -> per-request cut of the users' lists -> titles -> one event per request,
    published to the event sink.  Returns the served rows and whether publishing went through; requests with
    an invalid k come back with their reason and without items, and publish no event."""
    checked = validate_requests(requests)
    served = materialise(with_titles(serve_from_topk(checked.where("valid"), topk), catalog), "served")
    published = publish_events(event_records(served, latency_col="latency_ms"), fmt, path, options)
    rejected = checked.where(~F.col("valid"))
    return served.unionByName(rejected, allowMissingColumns=True), published


def monitor(spark: SparkSession, log_path: str, features_path: str, status_dir: str,
            source_format: str | None = None, source_path: str | None = None,
            source_options: dict[str, str] | None = None, checkpoint: str | None = None) -> DataFrame:
    """Drain new events (when a source is given), then write counts, concentration, drift and snapshot."""
    if source_format:
        drained = drain(spark, log_path, fmt=source_format, path=source_path, options=source_options,
                        checkpoint=checkpoint)
        log.info("drained %d events, %d lines to quarantine", drained.appended, drained.quarantined)
    write_status(corrupt_count(spark, log_path), f"{status_dir}/lines")
    events = read_event_log(spark, log_path)
    freq = item_frequency(events)
    freq.write.mode("overwrite").json(f"{status_dir}/item_counts")
    conc = concentration(freq)
    write_status(conc, f"{status_dir}/frequency")
    stats = C.stats_per_item(load_columns(spark, features_path, ["movie_id", *FEATURES]))
    status = drift_status(column_tests(stats.select(*FEATURES), current_population(events, stats)))
    write_status(status, f"{status_dir}/drift")
    snap = monitoring_snapshot(spark, spark.read.json(f"{status_dir}/drift"),
                               spark.read.json(f"{status_dir}/frequency"))
    return snap.select(*[F.col(c) for c in snap.columns])

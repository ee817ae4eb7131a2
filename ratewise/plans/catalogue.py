"""Query catalogue: one function per operator group, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (through ``bridge``) in full.  Doubles
are rounded to 6 digits so the DuckDB oracle can be compared by value hash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise.functions.text import multi_hot, release_year, split_field
from ratewise.functions.time import year_of_epoch
from ratewise.models.als import FactorModel, fit_implicit_als
from ratewise.models.biased_mf import fit_biased_mf, fit_biases
from ratewise.models.blocked import topk_dot
from ratewise.models.bpr import fit_bpr
from ratewise.models.evaluation import evaluate_families, popularity_sweep, select_run
from ratewise.models.norm_index import topk_by_norm
from ratewise.models.popularity import PopularityModel
from ratewise.operators import clean as C
from ratewise.operators.concentration import concentration, item_frequency
from ratewise.operators.drift import FEATURES, column_tests, current_population, drift_status
from ratewise.operators.drift_sketch import (batch_population, batch_summary, merged_tests, read_summaries,
                                             reference_summary, store_summary)
from ratewise.operators.features import movie_dimension, rating_stats
from ratewise.operators.features import feature_table as build_feature_table
from ratewise.operators.metrics import precision_recall_at_k, rating_errors
from ratewise.operators.requests import (error_rate, latency_quantiles, request_rate, request_volume,
                                         validate_requests)
from ratewise.operators.runs import best_run, latest_per_family
from ratewise.operators.serving import ranked_positions, serve_from_ranking, serve_from_topk, with_titles
from ratewise.operators.sizing import materialise, scratch_root
from ratewise.operators.snapshot import monitoring_snapshot
from ratewise.operators.split import relevant_items, seen_items, split_frames, tag_temporal_split
from ratewise.operators.weighting import bm25_weights
from ratewise.plans import bridge as B
from ratewise.plans import stream_queries
from ratewise.sources.eventlog import event_records, parse_event_lines, read_event_log, to_json_lines
from ratewise.sources.manifest import file_manifest
from ratewise.sources.selection import history, promote
from ratewise.streaming.concentration import read_item_counts, run_item_counts
from ratewise.streaming.drain import drain, event_stream
from ratewise.streaming.windows import (run_to_parquet, windowed_error_rate, windowed_latency, windowed_request_rate,
                                        windowed_request_volume)

R = 6  # digits kept for doubles
MIN_RATINGS = 20
TOP_K = 10


def _r(col: str, digits: int = R):
    return F.round(F.col(col), digits).alias(col)


# -- ETL -----------------------------------------------------------------------------------

def _features(spark, sf):
    """The reference ETL over the bridge: clean dimensions (D2), flags, stats, joins, fill."""
    movies = movie_dimension(C.clean_movies(B.items(spark, sf)), B.PART_TAGS)
    return build_feature_table(B.clean(spark, sf), movies, C.clean_users(B.users(spark, sf)))


def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    ft = _features(spark, sf)
    return ft.select(*[_r(c) if c.endswith("_avg_rating") else F.col(c) for c in ft.columns])


def clean_ratings_audit(spark: SparkSession, sf: str) -> DataFrame:
    raw = B.interactions(spark, sf)
    complete = F.lit(True)
    for c in raw.columns:
        complete = complete & F.col(c).isNotNull()
    stages = [("complete", complete), ("rating_in_range", complete & F.col("rating").between(1, 5))]
    return C.audit_counts("ratings", raw, stages, final=B.clean(spark, sf))


def parse_delimited(spark: SparkSession, sf: str) -> DataFrame:
    od = B.table(spark, sf, "orders")
    text = od.select(F.concat_ws("::", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").alias("value"))
    return text.select(
        split_field("value", 0, "::", T.LongType()).alias("o_orderkey"),
        split_field("value", 1, "::", T.LongType()).alias("o_custkey"),
        split_field("value", 2, "::").alias("o_orderstatus"),
        F.round(split_field("value", 3, "::", T.DoubleType()), 2).alias("o_totalprice"),
    )


def release_years(spark: SparkSession, sf: str) -> DataFrame:
    it = B.items(spark, sf)
    return it.select("movie_id", "title", release_year("title").alias("release_year"))


def multi_hot_tags(spark: SparkSession, sf: str) -> DataFrame:
    it = B.items(spark, sf)
    return it.select("movie_id", *multi_hot("genres", B.PART_TAGS))


def movie_stats(spark: SparkSession, sf: str) -> DataFrame:
    st = rating_stats(B.clean(spark, sf), "movie_id", "movie")
    return st.select("movie_id", "movie_rating_count", _r("movie_avg_rating"))


def user_stats(spark: SparkSession, sf: str) -> DataFrame:
    st = rating_stats(B.clean(spark, sf), "user_id", "user")
    return st.select("user_id", "user_rating_count", _r("user_avg_rating"))


def rating_year_hist(spark: SparkSession, sf: str) -> DataFrame:
    cl = B.clean(spark, sf)
    return cl.groupBy(year_of_epoch("timestamp").alias("rating_year")).agg(
        F.count(F.lit(1)).alias("ratings"), _r_expr(F.avg("rating"), "avg_rating"))


def _r_expr(col, name, digits: int = R):
    return F.round(col, digits).alias(name)


def null_audit(spark: SparkSession, sf: str) -> DataFrame:
    return C.null_audit(_features(spark, sf))


def catalog_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return C.distinct_catalog(_features(spark, sf).select("movie_id", "title"))


# -- split and popularity ------------------------------------------------------------------

def _split(spark, sf):
    """Train and test from one tagged table: train, test, seen and relevant pairs all read it."""
    return split_frames(materialise(tag_temporal_split(B.clean(spark, sf), 0.2), "split"))


def temporal_split(spark: SparkSession, sf: str) -> DataFrame:
    tagged = tag_temporal_split(B.clean(spark, sf), 0.2)
    return tagged.select("user_id", "movie_id", "rating", "timestamp", "is_test")


def seen_items_long(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = _split(spark, sf)
    return seen_items(train)


def relevant_items_long(spark: SparkSession, sf: str) -> DataFrame:
    _, test = _split(spark, sf)
    return relevant_items(test)


def popularity_rank(spark: SparkSession, sf: str) -> DataFrame:
    model = PopularityModel.fit(B.clean(spark, sf), min_ratings=MIN_RATINGS)
    rk = model.ranking()
    return rk.select("movie_id", _r("mean"), F.col("count").alias("rating_count"), F.col("pos").cast("int").alias("pos"))


def _popularity(spark, sf):
    train, test = _split(spark, sf)
    return PopularityModel.fit(train, min_ratings=MIN_RATINGS), train, test


def popularity_recommend(spark: SparkSession, sf: str) -> DataFrame:
    model, train, test = _popularity(spark, sf)
    users = relevant_items(test).select("user_id").distinct()
    recs = model.recommend(users, TOP_K, seen=seen_items(train))
    return recs.select("user_id", "movie_id", "rank", _r("score"))


def popularity_rating_error(spark: SparkSession, sf: str) -> DataFrame:
    model, _, test = _popularity(spark, sf)
    err = rating_errors(model.predict(test.select("user_id", "movie_id", "rating")))
    return err.select(_r("rmse"), _r("mae"), "n")


def popularity_ranking_metrics(spark: SparkSession, sf: str) -> DataFrame:
    model, train, test = _popularity(spark, sf)
    rel = relevant_items(test)
    recs = model.recommend(rel.select("user_id").distinct(), TOP_K, seen=seen_items(train))
    m = precision_recall_at_k(recs, rel, TOP_K)
    return m.select(_r(f"precision_at_{TOP_K}"), _r(f"recall_at_{TOP_K}"), "n_users")



# -- event log, concentration, drift -------------------------------------------------------

def _events(spark, sf):
    return parse_event_lines(B.event_log_json(spark, sf))


def _item_stats(spark, sf):
    """L1: one stats row per item.  The wide feature table is not built for it: the statistics come from
    the clean ratings, for the items of which a row survives the feature table's joins."""
    clean = materialise(B.clean(spark, sf), "clean")
    rated = clean.join(C.clean_users(B.users(spark, sf)).select("user_id"), "user_id", "left_semi").select("movie_id").distinct()
    items = C.clean_movies(B.items(spark, sf)).select("movie_id")
    stats = rating_stats(clean, "movie_id", "movie")
    return C.stats_per_item(stats.join(rated, "movie_id", "left_semi").join(items, "movie_id", "left_semi"))


def rec_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return item_frequency(_events(spark, sf))


def rec_concentration(spark: SparkSession, sf: str) -> DataFrame:
    c = concentration(item_frequency(_events(spark, sf)))
    return c.select("total", "distinct_items", "top_count", _r("top_movie_share"))


def drift_populations(spark: SparkSession, sf: str) -> DataFrame:
    stats = _item_stats(spark, sf)
    cur = current_population(_events(spark, sf), stats)
    ref = stats.select(*FEATURES)
    out = ref.withColumn("origin", F.lit("reference")).unionByName(cur.withColumn("origin", F.lit("current")))
    return out.select("origin", "movie_rating_count", _r("movie_avg_rating"))


def _drift_tests(spark, sf):
    stats = _item_stats(spark, sf)
    return column_tests(stats.select(*FEATURES), current_population(_events(spark, sf), stats))


def drift_ks(spark: SparkSession, sf: str) -> DataFrame:
    t = _drift_tests(spark, sf)
    return t.select("feature", "n_ref", "n_cur", _r("ks"), _r("ks_pvalue"))


def drift_wasserstein(spark: SparkSession, sf: str) -> DataFrame:
    t = _drift_tests(spark, sf)
    return t.select("feature", _r("wasserstein"), _r("wasserstein_norm"), "method", "drifted")


def drift_psi(spark: SparkSession, sf: str) -> DataFrame:
    t = _drift_tests(spark, sf)
    return t.select("feature", _r("psi"))


def drift_status_report(spark: SparkSession, sf: str) -> DataFrame:
    st = drift_status(_drift_tests(spark, sf))
    return st.select("dataset_drift", _r("drift_share"), "number_of_drifted_columns", "n_samples", "status")


def drift_from_summaries(spark: SparkSession, sf: str) -> DataFrame:
    """Drift from stored summaries of the log's yearly batches: merged PSI, and whether the merged KS lies within its
    stated bound of the exact one.  The last batch is stored twice, as after a restart."""
    stats = materialise(_item_stats(spark, sf), "stats")
    reference, folder = materialise(reference_summary(stats.select(*FEATURES)), "reference"), _scratch(spark, "summaries")
    dated = _events(spark, sf).withColumn("batch", F.year(F.timestamp_seconds("timestamp")))
    # read by the summaries and by the exact tests: a row a recommendation
    population = materialise(batch_population(dated, stats, ["batch"]), "population")
    summaries = materialise(batch_summary(population, reference, ["batch"]), "batches")
    years = [r.batch for r in summaries.select("batch").distinct().orderBy("batch").collect()]      # a number a batch
    for year in years + years[-1:]:
        store_summary(summaries.where(F.col("batch") == year), folder, "drain", year)
    kept = read_summaries(spark, folder)
    tests = merged_tests(reference, kept)
    exact = column_tests(stats.select(*FEATURES), population.select(*FEATURES)).select("feature", F.col("ks").alias("exact"))
    batches = kept.groupBy("feature").agg(F.count(F.lit(1)).alias("batches"))
    return tests.join(exact, "feature").join(batches, "feature").select(
        "feature", "batches", "n_ref", "n_cur", _r("psi"), (F.abs(F.col("ks") - F.col("exact")) <= F.col("ks_error")).alias("ks_within_bound"))


def monitoring_snapshot_report(spark: SparkSession, sf: str) -> DataFrame:
    drift = drift_status(_drift_tests(spark, sf))
    freq = concentration(item_frequency(_events(spark, sf)))
    snap = monitoring_snapshot(spark, drift, freq)
    return snap.select("dataset_drift", _r("drift_share"), "drift_samples", _r("top_movie_share"))


# -- requests and serving --------------------------------------------------------------------

def request_validation(spark: SparkSession, sf: str) -> DataFrame:
    v = validate_requests(B.requests(spark, sf))
    return v.select("event_id", "user_id", "k", "valid", "reason")


def request_rate_q(spark: SparkSession, sf: str) -> DataFrame:
    r = request_rate(B.requests(spark, sf))
    return r.select("window_start", "window_end", "handler", "requests", _r("rate_per_s"))


def error_rate_q(spark: SparkSession, sf: str) -> DataFrame:
    r = error_rate(B.requests(spark, sf))
    return r.select("window_start", "window_end", "status", "errors", _r("rate_per_s"))


def latency_quantiles_q(spark: SparkSession, sf: str) -> DataFrame:
    r = latency_quantiles(B.requests(spark, sf))
    return r.select("window_start", "window_end", "requests", _r("p50_ms"), _r("p95_ms"))


def request_volume_q(spark: SparkSession, sf: str) -> DataFrame:
    return request_volume(B.requests(spark, sf))


def title_lookup(spark: SparkSession, sf: str) -> DataFrame:
    served = ranked_positions(_events(spark, sf).select("timestamp", "user_id", "movie_ids"))
    out = with_titles(served, B.items(spark, sf))
    return out.select("timestamp", "user_id", "rank", "movie_id", "title")


def batch_serve(spark: SparkSession, sf: str) -> DataFrame:
    """Valid requests served by the popularity model fit on all clean ratings (no exclusion)."""
    reqs = validate_requests(B.requests(spark, sf)).filter("valid").select("event_id", "user_id", "k")
    model = PopularityModel.fit(B.clean(spark, sf), min_ratings=MIN_RATINGS)
    served = serve_from_ranking(reqs, model.ranking().select("movie_id", "pos"))
    out = with_titles(served, B.items(spark, sf))
    return out.select("event_id", "user_id", "k", "rank", "movie_id", "title")


def factor_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Top-10 vectors by dot product for every vector of the table, itself excluded."""
    vectors = B.factors(spark, sf)
    itself = vectors.select(F.col("id").alias("user_id"), F.col("id").alias("item_id"))
    top = topk_dot(vectors, vectors, TOP_K, seen=itself)
    return top.select("user_id", "item_id", "rank", _r("score"))


def factor_topk_by_norm(spark: SparkSession, sf: str) -> DataFrame:
    """The lists of ``factor_topk`` from the norm-ordered index, which skips what norms rule out."""
    vectors = B.factors(spark, sf)
    itself = vectors.select(F.col("id").alias("user_id"), F.col("id").alias("item_id"))
    return topk_by_norm(vectors, vectors, TOP_K, seen=itself).top.select("user_id", "item_id", "rank", _r("score"))


def als_norm_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of ALS factors that the norm-ordered index could have scored and those that it scored for every
    user's list, a row a round."""
    train, _ = _split(spark, sf)
    model = fit_implicit_als(train)
    pairs = seen_items(train).select("user_id", F.col("movie_id").alias("item_id"))
    return topk_by_norm(model.user_factors, model.item_factors, TOP_K, seen=pairs).cells


# -- model runs ------------------------------------------------------------------------------

SWEEP = (1, 5, 10, 20, 40)


def _runs(spark, sf):
    train, test = _split(spark, sf)
    return popularity_sweep(train, test, SWEEP, TOP_K)


def evaluation_runs(spark: SparkSession, sf: str) -> DataFrame:
    r = _runs(spark, sf)
    return r.select("run_id", "family", "start_time", "min_ratings", _r("precision_at_10"), _r("recall_at_10"),
                    _r("rmse"), _r("mae"))


def latest_run_per_family(spark: SparkSession, sf: str) -> DataFrame:
    r = latest_per_family(_runs(spark, sf))
    return r.select("run_id", "family", "start_time", _r("recall_at_10"))


def best_model(spark: SparkSession, sf: str) -> DataFrame:
    r = best_run(latest_per_family(_runs(spark, sf)))
    return r.select("run_id", "family", _r("recall_at_10"))



def latest_runs_of_history(spark: SparkSession, sf: str) -> DataFrame:
    """The latest run of each family among the newest runs of a long table of several families."""
    return latest_per_family(B.run_history(spark, sf)).select("run_id", "family", "start_time", _r("recall_at_10"))


def selection_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Versions that promoting makes of a long runs table, when it is done at the end of every year."""
    runs, folder = B.run_history(spark, sf), _scratch(spark, "selection")
    for (year,) in runs.select("year").distinct().orderBy("year").collect():        # one promotion a year
        promote(spark, lambda: runs.where(F.col("year") <= year).drop("year"), select_run, folder)
    return history(spark, folder, B.RUN_HISTORY).select("version", "previous", "run_id", "family", "start_time", _r("recall_at_10"))


# -- streaming and manifests -----------------------------------------------------------------

def _scratch(spark, tag):
    return f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"


def stream_drain(spark: SparkSession, sf: str) -> DataFrame:
    """The bridge's event log as JSON files -> availableNow drain -> log, read back."""
    base = _scratch(spark, "drain")
    B.event_log_json(spark, sf).write.text(f"{base}/in")
    drain(spark, f"{base}/log", fmt="text", path=f"{base}/in", checkpoint=f"{base}/ckpt")
    log = read_event_log(spark, f"{base}/log")
    return log.select("timestamp", "user_id", "k", "num_recommendations", "movie_ids", _r("latency_ms"))


def stream_request_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Requests as a file stream -> 1-minute windows, 10-minute watermark -> closed windows."""
    base = _scratch(spark, "reqstream")
    reqs = B.requests(spark, sf)
    reqs.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(reqs.schema).parquet(f"{base}/in")
    run_to_parquet(spark, windowed_request_rate(stream), f"{base}/out", checkpoint=f"{base}/ckpt")
    out = spark.read.parquet(f"{base}/out")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                      "handler", "requests", _r("rate_per_s"))




def stream_latency(spark: SparkSession, sf: str) -> DataFrame:
    """Requests as a file stream -> 5-minute latency quantiles, 10-minute watermark -> closed windows."""
    base = _scratch(spark, "latstream")
    reqs = B.requests(spark, sf)
    reqs.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(reqs.schema).parquet(f"{base}/in")
    run_to_parquet(spark, windowed_latency(stream), f"{base}/out", checkpoint=f"{base}/ckpt")
    out = spark.read.parquet(f"{base}/out")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                      "requests", _r("p50_ms"), _r("p95_ms"))


def stream_concentration(spark: SparkSession, sf: str) -> DataFrame:
    """Event log as a file stream -> running per-item counts (complete mode) -> read back."""
    base = _scratch(spark, "counts")
    B.event_log_json(spark, sf).write.text(f"{base}/in")
    run_item_counts(spark, event_stream(spark, "text", f"{base}/in"), f"{base}/out", checkpoint=f"{base}/ckpt")
    return read_item_counts(spark, f"{base}/out")


def dataset_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return file_manifest(spark, sf, "*.parquet")



# -- factor models (solver-dependent values: row checks only) ----------------------------------

LISTED = {"als": fit_implicit_als, "mf": fit_biased_mf, "bpr": fit_bpr}    # as recommended from and as checked


def _recommend_with(model, train, test):
    rel = relevant_items(test)
    recs = model.recommend(rel.select("user_id").distinct(), TOP_K, seen=seen_items(train))
    return recs.select("user_id", "movie_id", "rank", _r("score"))


def als_recommend(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _split(spark, sf)
    return _recommend_with(LISTED["als"](train), train, test)


def mf_recommend(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _split(spark, sf)
    return _recommend_with(LISTED["mf"](train), train, test)


def mf_rating_error(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _split(spark, sf)
    err = rating_errors(fit_biased_mf(train).predict(test.select("user_id", "movie_id", "rating")))
    return err.select(_r("rmse"), _r("mae"), "n")


def bpr_recommend(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _split(spark, sf)
    return _recommend_with(LISTED["bpr"](train), train, test)



def als_serve(spark: SparkSession, sf: str) -> DataFrame:
    """M9 with a personal model: valid requests -> ALS top-max(k) per user (seen items not excluded,
    as in serving) -> per-request cut -> titles -> one event record per request."""
    reqs = validate_requests(B.requests(spark, sf)).filter("valid") \
        .select("event_id", "user_id", "k", F.col("ts").cast("timestamp").cast("double").alias("ts"), "latency_ms")
    model = fit_implicit_als(B.clean(spark, sf))
    max_k = reqs.agg(F.max("k")).first()[0] or 0  # one number: the longest list any request asks for
    topk = model.recommend(reqs.select("user_id").distinct(), int(max_k))
    served = with_titles(serve_from_topk(reqs, topk), B.items(spark, sf))
    events = event_records(served, latency_col="latency_ms")
    return events.select("timestamp", "user_id", "k", "num_recommendations", "movie_ids", _r("latency_ms"))


def model_selection(spark: SparkSession, sf: str) -> DataFrame:
    """All four families on one split -> runs table -> latest per family -> best by recall@10."""
    train, test = _split(spark, sf)
    runs = evaluate_families(train, test, TOP_K)
    best = select_run(runs, TOP_K).select("run_id", F.lit(True).alias("selected"))
    marked = runs.join(F.broadcast(best), "run_id", "left").withColumn("selected", F.coalesce("selected", F.lit(False)))
    return marked.select("family", _r("precision_at_10"), _r("recall_at_10"), _r("rmse"), _r("mae"), "selected")



def bm25_confidence(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = _split(spark, sf)
    w = bm25_weights(train)
    return w.select("user_id", "movie_id", "rating", _r("weight"))



# -- the served log: what the popularity model would serve every user ------------------------

def _served_events(spark, sf):
    """Top-10 popularity lists (seen excluded) for every user -> JSON event records -> parsed back."""
    clean = materialise(B.clean(spark, sf), "clean")  # fit, users and seen pairs all read it
    model = PopularityModel.fit(clean, min_ratings=MIN_RATINGS)
    users = clean.select("user_id").distinct()
    recs = model.recommend(users, TOP_K, seen=seen_items(clean))
    requests = recs.withColumn("event_id", F.col("user_id")).withColumn("ts", F.lit(0.0)) \
        .withColumn("k", F.lit(TOP_K))
    return parse_event_lines(to_json_lines(event_records(requests)))


def served_concentration(spark: SparkSession, sf: str) -> DataFrame:
    c = concentration(item_frequency(_served_events(spark, sf)))
    return c.select("total", "distinct_items", "top_count", _r("top_movie_share"))


def _served_tests(spark, sf):
    stats = _item_stats(spark, sf)
    return column_tests(stats.select(*FEATURES), current_population(_served_events(spark, sf), stats))


def served_drift_tests(spark: SparkSession, sf: str) -> DataFrame:
    t = _served_tests(spark, sf)
    return t.select("feature", "n_ref", "n_cur", _r("ks"), _r("ks_pvalue"), _r("wasserstein"),
                    _r("wasserstein_norm"), _r("psi"), "method", "drifted")


def served_drift_status(spark: SparkSession, sf: str) -> DataFrame:
    st = drift_status(_served_tests(spark, sf))
    return st.select("dataset_drift", _r("drift_share"), "number_of_drifted_columns", "n_samples", "status")


def mf_biases(spark: SparkSession, sf: str) -> DataFrame:
    """Global mean, damped item and user biases of the training ratings."""
    train, _ = _split(spark, sf)
    mu, items, users = fit_biases(train.select("user_id", "movie_id", F.col("rating").cast("double").alias("rating")))
    rows = items.select(F.lit("item").alias("kind"), F.col("movie_id").alias("id"), F.col("b_item").alias("bias"))
    rows = rows.unionByName(users.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), F.col("b_user").alias("bias")))
    return rows.select("kind", "id", _r("bias"), F.round(mu, R).alias("mean"))


def factor_predict(spark: SparkSession, sf: str) -> DataFrame:
    """Factor prediction over every vector against its successor; unknown ids get the mean of the model."""
    vectors = B.factors(spark, sf).select("id", F.col("features").cast("array<double>").alias("features"))
    mean = B.clean(spark, sf).select(F.avg(F.col("rating").cast("double")).alias("mean"))
    model = FactorModel(vectors, vectors, mean=materialise(mean, "mean"))
    pairs = vectors.select(F.col("id").alias("user_id"), (F.col("id") + 1).alias("movie_id")) \
        .unionByName(vectors.select((-F.col("id") - 1).alias("user_id"), F.col("id").alias("movie_id")))
    return model.predict(pairs).select("user_id", "movie_id", _r("prediction", 4))


def _list_checks(model, train: DataFrame, test: DataFrame) -> DataFrame:
    """One row: users with a list, rows, gaps in the ranks, seen items, breaks of the score order."""
    rel, seen = relevant_items(test), seen_items(train)
    recs = materialise(model.recommend(rel.select("user_id").distinct(), TOP_K, seen=seen), "lists")
    by_user = Window.partitionBy("user_id").orderBy("rank")
    marked = recs.join(seen.withColumn("known", F.lit(1)), ["user_id", "movie_id"], "left") \
        .withColumn("place", F.row_number().over(by_user)).withColumn("before", F.lag("score").over(by_user))
    return marked.agg(F.countDistinct("user_id").alias("users"), F.count(F.lit(1)).alias("rows"),
                      F.count_if(F.col("rank") != F.col("place")).alias("rank_gaps"),
                      F.count_if(F.col("known") == 1).alias("seen_overlap"),
                      F.count_if(F.col("before") < F.col("score") - 1e-9).alias("order_breaks"))


def als_list_checks(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _split(spark, sf)
    return _list_checks(LISTED["als"](train), train, test)


def mf_list_checks(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _split(spark, sf)
    return _list_checks(LISTED["mf"](train), train, test)


def bpr_list_checks(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _split(spark, sf)
    return _list_checks(LISTED["bpr"](train), train, test)


def _request_stream(spark: SparkSession, sf: str, metrics, tag: str) -> DataFrame:
    base = _scratch(spark, tag)
    reqs = B.requests(spark, sf)
    reqs.write.parquet(f"{base}/in")
    run_to_parquet(spark, metrics(spark.readStream.schema(reqs.schema).parquet(f"{base}/in")), f"{base}/out")
    out = spark.read.parquet(f"{base}/out")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def stream_error_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Requests as a file stream -> 1-minute windows of rejected and failed requests, closed windows."""
    out = _request_stream(spark, sf, windowed_error_rate, "errstream")
    return out.select("window_start", "window_end", "status", "errors", _r("rate_per_s"))


def stream_request_volume(spark: SparkSession, sf: str) -> DataFrame:
    """Requests as a file stream -> 5-minute volumes, closed windows."""
    out = _request_stream(spark, sf, windowed_request_volume, "volstream")
    return out.select("window_start", "window_end", "requests", "served_requests", "recommended_items")


def stream_drain_resume(spark: SparkSession, sf: str) -> DataFrame:
    """Two drains with default arguments and new files in between (one sparse event, one malformed line), and a
    third that finds nothing: lines appended, set aside, in the log."""
    base = _scratch(spark, "resume")
    lines = materialise(B.event_log_json(spark, sf).withColumn("half", F.crc32(F.col("value").cast("binary")) % 2), "resume")
    lines.where("half = 0").select("value").write.mode("append").text(f"{base}/in")
    first = drain(spark, f"{base}/log", fmt="text", path=f"{base}/in")
    extra = spark.createDataFrame([('{"k": 3}',), ('{"user_id": 1, "movie_ids": [',)], "value string")
    lines.where("half = 1").select("value").unionByName(extra).write.mode("append").text(f"{base}/in")
    second = drain(spark, f"{base}/log", fmt="text", path=f"{base}/in")
    third = drain(spark, f"{base}/log", fmt="text", path=f"{base}/in")
    log = read_event_log(spark, f"{base}/log")
    return log.agg(F.count(F.lit(1)).alias("log_rows"), F.sum(F.size("movie_ids")).cast("long").alias("items")).select(
        F.lit(first.appended + second.appended).cast("long").alias("appended"),
        F.lit(first.quarantined + second.quarantined).cast("long").alias("quarantined"),
        F.lit(third.appended + third.quarantined).cast("long").alias("again"), "log_rows", "items")


CATALOGUE = {
    "mf_biases": mf_biases,
    "factor_predict": factor_predict,
    "als_list_checks": als_list_checks,
    "mf_list_checks": mf_list_checks,
    "bpr_list_checks": bpr_list_checks,
    "stream_error_rate": stream_error_rate,
    "stream_request_volume": stream_request_volume,
    "stream_drain_resume": stream_drain_resume,
    "feature_table": feature_table,
    "clean_ratings_audit": clean_ratings_audit,
    "parse_delimited": parse_delimited,
    "release_year": release_years,
    "multi_hot_tags": multi_hot_tags,
    "movie_stats": movie_stats,
    "user_stats": user_stats,
    "rating_year_hist": rating_year_hist,
    "null_audit": null_audit,
    "catalog_distinct": catalog_distinct,
    "temporal_split": temporal_split,
    "seen_items_long": seen_items_long,
    "relevant_items_long": relevant_items_long,
    "popularity_rank": popularity_rank,
    "popularity_recommend": popularity_recommend,
    "popularity_rating_error": popularity_rating_error,
    "popularity_ranking_metrics": popularity_ranking_metrics,
    "rec_frequency": rec_frequency,
    "rec_concentration": rec_concentration,
    "drift_populations": drift_populations,
    "drift_ks": drift_ks,
    "drift_wasserstein": drift_wasserstein,
    "drift_psi": drift_psi,
    "drift_status": drift_status_report,
    "drift_from_summaries": drift_from_summaries,
    "monitoring_snapshot": monitoring_snapshot_report,
    "request_validation": request_validation,
    "request_rate": request_rate_q,
    "error_rate": error_rate_q,
    "latency_quantiles": latency_quantiles_q,
    "request_volume": request_volume_q,
    "title_lookup": title_lookup,
    "batch_serve": batch_serve,
    "factor_topk": factor_topk,
    "factor_topk_by_norm": factor_topk_by_norm,
    "als_norm_cells": als_norm_cells,
    "evaluation_runs": evaluation_runs,
    "latest_run_per_family": latest_run_per_family,
    "best_model": best_model,
    "latest_runs_of_history": latest_runs_of_history,
    "selection_versions": selection_versions,
    "stream_drain": stream_drain,
    "stream_request_rate": stream_request_rate,
    "dataset_manifest": dataset_manifest,
    "stream_concentration": stream_concentration,
    "stream_latency": stream_latency,
    "als_recommend": als_recommend,
    "mf_recommend": mf_recommend,
    "mf_rating_error": mf_rating_error,
    "bpr_recommend": bpr_recommend,
    "als_serve": als_serve,
    "model_selection": model_selection,
    "bm25_confidence": bm25_confidence,
    "served_concentration": served_concentration,
    "served_drift_tests": served_drift_tests,
    "served_drift_status": served_drift_status,
    **stream_queries.QUERIES,
}

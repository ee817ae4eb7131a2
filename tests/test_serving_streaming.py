"""Request validation, titles, event records, drain and windowed metrics."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ratewise.operators.requests import validate_requests
from ratewise.operators.serving import serve_from_ranking, serve_from_topk, with_titles
from ratewise.sources.eventlog import append_events, event_records, read_event_log
from ratewise.streaming.drain import drain
from ratewise.streaming.windows import run_to_parquet, windowed_request_rate


def test_validation(spark):
    reqs = spark.createDataFrame([(1, 42, 3), (2, 42, None), (3, 1, 0), (4, 1, 101), (5, 1, -5)],
                                 "event_id long, user_id long, k int")
    got = {r["event_id"]: (r["k"], r["valid"]) for r in validate_requests(reqs).collect()}
    assert got == {1: (3, True), 2: (10, True), 3: (0, False), 4: (101, False), 5: (-5, False)}


def test_serve_with_titles_and_event(spark):
    catalog = spark.createDataFrame([(811, "North Pier"), (812, "Long Shift"), (813, "Paper Boats")],
                                    "movie_id long, title string")
    ranking = spark.createDataFrame([(811, 1), (812, 2), (813, 3), (814, 4)], "movie_id long, pos int")
    reqs = spark.createDataFrame([(1, 42, 3, 0.0), (2, 7, 2, 1.0), (3, 9, 4, 2.0)],
                                 "event_id long, user_id long, k int, ts double")
    served = with_titles(serve_from_ranking(reqs, ranking), catalog)
    first = served.filter("event_id = 1").orderBy("rank").collect()
    assert [(r["movie_id"], r["title"]) for r in first] == [(811, "North Pier"), (812, "Long Shift"), (813, "Paper Boats")]
    assert served.filter("movie_id = 814").first()["title"] == "Unknown title"
    ev = event_records(served, ts_col="ts").filter("user_id = 7").first()
    assert (ev["user_id"], ev["k"], ev["num_recommendations"], ev["movie_ids"]) == (7, 2, 2, [811, 812])


def _records(path, recs):
    os.makedirs(path, exist_ok=True)
    n = len(os.listdir(path))
    with open(f"{path}/batch-{n}.json", "w") as f:
        for r in recs:
            f.write(json.dumps(r) + "\n")


def test_drain_resumes_with_default_arguments(spark, scratch):
    """Two drains with new files in between: every line once, as it was; bad lines set aside and counted."""
    src, log = f"{scratch}/topic", f"{scratch}/log"
    _records(src, [{"user_id": 31, "k": 2, "movie_ids": [7, 9]}, {"user_id": 32, "k": 1, "movie_ids": [4], "extra": "kept"}])
    first = drain(spark, log, fmt="text", path=src)
    assert (first.appended, first.quarantined) == (2, 0)
    assert drain(spark, log, fmt="text", path=src).appended == 0  # nothing twice
    with open(f"{src}/more.json", "w") as f:
        f.write('{"k": 5}\n{"user_id": 33, broken\n[1, 2]\n{"user_id": 34, "movie_ids": []}\n')
    second = drain(spark, log, fmt="text", path=src)
    assert (second.appended, second.quarantined) == (2, 2)
    lines = {r.value for r in spark.read.option("recursiveFileLookup", True).text(log).collect()}
    assert '{"k": 5}' in lines and any('"extra": "kept"' in x for x in lines) and len(lines) == 4
    bad = {r.value for r in spark.read.option("recursiveFileLookup", True).text(f"{log}.bad").collect()}
    assert bad == {'{"user_id": 33, broken', "[1, 2]"}
    assert read_event_log(spark, log).count() == 4


def test_drain_counts_every_batch(spark, scratch):
    src = f"{scratch}/many"
    for k in range(120):
        _records(src, [{"user_id": k, "k": 1, "movie_ids": [k]}])
    got = drain(spark, f"{scratch}/many-log", fmt="text", path=src, options={"maxFilesPerTrigger": "1"})
    assert got.appended == 120  # more batches than a query's progress history keeps


def test_drain_nothing_there(spark, scratch):
    os.makedirs(f"{scratch}/empty-topic")
    assert drain(spark, f"{scratch}/log2", fmt="text", path=f"{scratch}/empty-topic").appended == 0


def test_empty_list_is_an_event_and_invalid_k_stays(spark):
    reqs = spark.createDataFrame([(1, 5, 2, 0.0), (2, 6, 2, 1.0), (3, 5, 500, 2.0)], "event_id long, user_id long, k int, ts double")
    topk = spark.createDataFrame([(5, 70, 1), (5, 71, 2), (5, 72, 3)], "user_id long, movie_id long, rank int")
    ev = {r.user_id: (r.num_recommendations, r.movie_ids)
          for r in event_records(serve_from_topk(reqs.where("event_id < 3"), topk), ts_col="ts").collect()}
    assert ev == {5: (2, [70, 71]), 6: (0, [])}
    ranking = spark.createDataFrame([(70, 1), (71, 2)], "movie_id long, pos int")
    served = serve_from_ranking(reqs, ranking)
    got = {}
    for r in served.collect():
        got.setdefault(r.event_id, []).append(r.movie_id)
    assert got[3] == [None] and sorted(got[1]) == [70, 71]


def test_shared_folder_is_required_beyond_local_masters(monkeypatch):
    from types import SimpleNamespace

    from ratewise.session import ensure_checkpoint_dir
    conf = SimpleNamespace(get=lambda key, default=None: default)
    sc = SimpleNamespace(master="spark://host:7077", getConf=lambda: conf, getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))


def test_append_events_keeps_old_rows(spark, scratch):
    log = f"{scratch}/applog"
    ev = spark.createDataFrame([(1.0, 1, 1, 1, [5], 2.0)],
                               "timestamp double, user_id long, k int, num_recommendations int,"
                               " movie_ids array<bigint>, latency_ms double")
    assert append_events(ev, log) == 1
    assert append_events(ev, log) == 1
    assert read_event_log(spark, log).count() == 2


def test_late_event_dropped_by_watermark(spark, scratch):
    src = f"{scratch}/req"
    schema = "ts string, handler string"
    batch1 = spark.createDataFrame([("2024-01-01 00:00:10", "a"), ("2024-01-01 00:30:00", "a")], schema)
    batch1 = batch1.withColumn("ts", F.to_timestamp("ts"))
    batch1.write.mode("append").parquet(src)
    out = f"{scratch}/rate"
    ck = f"{scratch}/rate-ck"
    run_to_parquet(spark, windowed_request_rate(spark.readStream.schema(batch1.schema).parquet(src)), out, ck)
    late = spark.createDataFrame([("2024-01-01 00:00:20", "a"), ("2024-01-01 01:00:00", "a")], schema) \
        .withColumn("ts", F.to_timestamp("ts"))
    late.write.mode("append").parquet(src)
    run_to_parquet(spark, windowed_request_rate(spark.readStream.schema(batch1.schema).parquet(src)), out, ck)
    got = {str(r["window_start"])[11:16]: r["requests"] for r in spark.read.parquet(out).collect()}
    assert got["00:00"] == 1  # the late 00:00:20 row arrived after the watermark passed 00:20
    assert "01:00" not in got  # still open


def test_latest_run_per_family_and_best(spark):
    from ratewise.operators.runs import best_run, latest_per_family
    rows = [("r-old-bpr", "bpr", 0, 0.9)]                      # outside the 50 newest runs
    rows += [(f"r-als-{i:02d}", "als", 10 + i, 0.1 + i / 100) for i in range(30)]
    rows += [(f"r-svd-{i:02d}", "svd", 100 + i, 0.05) for i in range(25)]
    rows += [("r-pop", "popularity_baseline", 200, None)]      # no metric: ignored by the selection
    runs = spark.createDataFrame(rows, "run_id string, family string, start_time long, recall_at_10 double")
    latest = {r["family"]: r["run_id"] for r in latest_per_family(runs).collect()}
    assert latest == {"als": "r-als-29", "svd": "r-svd-24", "popularity_baseline": "r-pop"}
    assert best_run(latest_per_family(runs)).first()["run_id"] == "r-als-29"


def test_request_metrics_windows(spark):
    from ratewise.operators.requests import error_rate, latency_quantiles, request_rate, request_volume
    rows = [("2024-01-01 00:00:05", "view", 3, 10.0, False), ("2024-01-01 00:00:40", "view", 0, 20.0, False),
            ("2024-01-01 00:00:50", "error", 5, 30.0, True), ("2024-01-01 00:01:10", "click", None, 40.0, False)]
    reqs = spark.createDataFrame(rows, "ts string, handler string, k int, latency_ms double, is_error boolean") \
        .withColumn("ts", F.to_timestamp("ts"))
    rate = {(str(r["window_start"])[11:16], r["handler"]): r["requests"] for r in request_rate(reqs).collect()}
    assert rate == {("00:00", "view"): 2, ("00:00", "error"): 1, ("00:01", "click"): 1}
    errs = {r["status"]: r["errors"] for r in error_rate(reqs).collect()}
    assert errs == {"4xx": 1, "5xx": 1}  # k = 0 rejected; the failed request
    lat = latency_quantiles(reqs).first()
    assert (lat["requests"], lat["p50_ms"], lat["p95_ms"]) == (4, 20.0, 40.0)
    vol = request_volume(reqs).first()
    assert (vol["requests"], vol["served_requests"], vol["recommended_items"]) == (4, 3, 18)  # 3 + 5 + 10

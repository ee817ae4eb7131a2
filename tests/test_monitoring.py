"""Event log, concentration, drift statistics and the monitoring snapshot."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise.operators.concentration import concentration, item_frequency
from ratewise.operators.drift import column_tests, current_population, drift_status
from ratewise.operators.snapshot import monitoring_snapshot
from ratewise.sources.eventlog import corrupt_count, read_event_log, recommended_ids


def _write_log(path, records, extra_lines=()):
    with open(path, "w") as f:
        for r in records:
            f.write(json.dumps(r) + "\n")
        for line in extra_lines:
            f.write(line + "\n")


def _summary(spark, path):
    events = read_event_log(spark, path)
    freq = {r["movie_id"]: r["count"] for r in item_frequency(events).collect()}
    c = concentration(item_frequency(events)).first()
    return freq, c["total"], c["top_movie_share"]


def test_counts_total_share(spark, scratch):
    path = f"{scratch}/log.jsonl"
    served = [[58, 7, 58], [7], [], [913, 58, 22, 58]]                 # repeats inside a list count, too
    _write_log(path, [{"movie_ids": ids} for ids in served])
    freq, total, share = _summary(spark, path)
    assert freq == {58: 4, 7: 2, 913: 1, 22: 1} and total == 8 and share == pytest.approx(1 / 2)


def test_missing_and_empty_log(spark, scratch):
    assert _summary(spark, f"{scratch}/nothing-here.jsonl") == ({}, 0, 0.0)
    open(f"{scratch}/empty.jsonl", "w").close()
    assert _summary(spark, f"{scratch}/empty.jsonl") == ({}, 0, 0.0)


def test_uniform_share(spark, scratch):
    path = f"{scratch}/u.jsonl"
    _write_log(path, [{"movie_ids": list(range(30, 37))}] * 3)
    assert _summary(spark, path)[2] == pytest.approx(1 / 7)


def test_flatten_missing_field_and_corrupt_line(spark, scratch):
    path = f"{scratch}/f.jsonl"
    _write_log(path, [{"movie_ids": [64]}, {"user_id": 70}, {"movie_ids": [12, 64, 8, 31]}], extra_lines=['{"movie_ids": [5'])
    ids = sorted(r[0] for r in recommended_ids(read_event_log(spark, path)).collect())
    assert ids == [8, 12, 31, 64, 64]
    assert corrupt_count(spark, path).first()["corrupt_lines"] == 1


def _stats(spark):
    return spark.createDataFrame([(41, 6, 2.75), (46, 130, 4.5), (52, 17, 3.25)],
                                 "movie_id long, movie_rating_count long, movie_avg_rating double")


def test_current_population_keeps_multiplicity_drops_unknown(spark):
    events = spark.createDataFrame([([52, -3, 41, 52],), ([77],), ([52],)], "movie_ids array<bigint>")
    cur = current_population(events, _stats(spark))
    assert sorted(r.movie_rating_count for r in cur.collect()) == [6, 17, 17, 17] and cur.columns == ["movie_rating_count", "movie_avg_rating"]


def test_insufficient_data(spark):
    events = spark.createDataFrame([([46, 52, 46],), ([41, 46, 8],)], "movie_ids array<bigint>")
    stats = _stats(spark)
    st = drift_status(column_tests(stats.drop("movie_id"), current_population(events, stats))).first()
    assert st["status"] == "insufficient_data" and st["n_samples"] == 5
    assert st["dataset_drift"] is False and st["drift_share"] == 0.0


def _numpy_ks_w(a, b):
    values = np.union1d(a, b)
    fa = np.searchsorted(np.sort(a), values, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), values, side="right") / len(b)
    gaps = np.abs(fa - fb)
    return gaps.max(), float(np.sum(gaps[:-1] * np.diff(values)))


@pytest.mark.parametrize("shift", [0.0, 1.5])
def test_ks_and_wasserstein_match_numpy(spark, shift):
    rng = np.random.default_rng(1)
    ref = np.round(rng.normal(0, 1, 400), 2)
    cur = np.round(rng.normal(shift, 1, 300), 2)
    r = spark.createDataFrame([(float(x), float(x)) for x in ref], "a double, b double")
    c = spark.createDataFrame([(float(x), float(x) * 0 + 1.0) for x in cur], "a double, b double")
    t = {x["feature"]: x for x in column_tests(r, c, features=("a", "b")).collect()}
    ks, w = _numpy_ks_w(ref, cur)
    assert t["a"]["ks"] == pytest.approx(ks) and t["a"]["wasserstein"] == pytest.approx(w)
    assert t["a"]["wasserstein_norm"] == pytest.approx(w / ref.std())
    assert t["a"]["method"] == "ks"
    assert t["a"]["drifted"] == (shift > 0)
    assert t["b"]["drifted"]  # constant current column vs spread reference


def test_share_half_is_drift(spark):
    rng = np.random.default_rng(2)
    ref = [(float(x), float(y)) for x, y in zip(rng.normal(0, 1, 200), rng.normal(0, 1, 200))]
    cur = [(float(x) + 3, float(y)) for x, y in zip(rng.normal(0, 1, 100), rng.normal(0, 1, 100))]
    r = spark.createDataFrame(ref, "a double, b double")
    c = spark.createDataFrame(cur, "a double, b double")
    st = drift_status(column_tests(r, c, features=("a", "b")), n_features=2).first()
    assert st["status"] == "ok" and st["drift_share"] == 0.5 and st["dataset_drift"] is True
    assert st["number_of_drifted_columns"] == 1 and st["n_samples"] == 100


@pytest.mark.parametrize("n,ok", [(29, "insufficient_data"), (30, "ok")])
def test_min_samples_boundary(spark, n, ok):
    r = spark.createDataFrame([(float(i),) for i in range(50)], "a double")
    c = spark.createDataFrame([(float(i),) for i in range(n)], "a double")
    assert drift_status(column_tests(r, c, features=("a",)), n_features=1).first()["status"] == ok


def test_snapshot_defaults_and_values(spark):
    none = monitoring_snapshot(spark, None, None).first()
    assert tuple(none) == (0, 0.0, 0, 0.0)
    drift = spark.createDataFrame([(False, 0.25, 1, 1311, "ok")],
                                  "dataset_drift boolean, drift_share double, number_of_drifted_columns int,"
                                  " n_samples long, status string")
    freq = spark.createDataFrame([(64, 9, 24, 0.375)], "total long, distinct_items long, top_count long,"
                                 " top_movie_share double")
    snap = monitoring_snapshot(spark, drift, freq).first()
    assert tuple(snap) == (0, 0.25, 1311, 0.375)


def test_empty_current_population(spark, scratch):
    stats = _stats(spark)
    events = read_event_log(spark, f"{scratch}/no-log-yet")
    st = drift_status(column_tests(stats.drop("movie_id"), current_population(events, stats))).first()
    assert st["status"] == "insufficient_data" and st["n_samples"] == 0 and st["dataset_drift"] is False

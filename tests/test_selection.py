"""Versioned selection: history, ties with other promotions, trainings at the same time."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from ratewise.models.evaluation import select_run
from ratewise.sources import selection as S

RUNS = "run_id string, family string, start_time long, recall_at_10 double"


def run(spark, run_id, family, start, recall):
    return spark.createDataFrame([(run_id, family, start, recall)], RUNS)


def step(spark, scratch):
    return S.promote(spark, lambda: S.read_runs(spark, f"{scratch}/runs"), select_run, f"{scratch}/sel")


def test_versions_follow_the_runs_table(spark, scratch):
    assert S.selection(spark, f"{scratch}/sel") is None and S.history(spark, f"{scratch}/sel", RUNS).count() == 0
    S.append_runs(run(spark, "r1", "als", 1, None), f"{scratch}/runs")
    assert step(spark, scratch) is None                                  # no run with the metric yet
    S.append_runs(run(spark, "r2", "bpr", 2, 0.4), f"{scratch}/runs")
    assert step(spark, scratch)["version"] == 1
    assert step(spark, scratch)["version"] == 1                          # the same run makes no version
    S.append_runs(run(spark, "r3", "als", 3, 0.7), f"{scratch}/runs")
    now = step(spark, scratch)
    assert (now["version"], now["run_id"], now["previous"]) == (2, "r3", "r2")
    S.append_runs(run(spark, "r4", "als", 4, 0.1), f"{scratch}/runs")    # the newest als run is worse than bpr's
    assert step(spark, scratch)["run_id"] == "r2"
    rows = sorted((r.version, r.previous, r.run_id) for r in S.history(spark, f"{scratch}/sel", RUNS).collect())
    assert rows == [(1, None, "r2"), (2, "r2", "r3"), (3, "r3", "r2")]
    assert S.selection(spark, f"{scratch}/sel", 2)["run_id"] == "r3" and S.selection(spark, f"{scratch}/sel", 9) is None


def test_a_lost_race_looks_at_the_runs_again(spark, scratch):
    S.append_runs(run(spark, "a", "als", 1, 0.3), f"{scratch}/runs")
    calls = []

    def runs():
        seen = S.read_runs(spark, f"{scratch}/runs").checkpoint()
        if not calls:                                                    # another training comes in between
            calls.append(1)
            S.append_runs(run(spark, "b", "bpr", 2, 0.9), f"{scratch}/runs")
            assert step(spark, scratch)["run_id"] == "b"
        return seen

    got = S.promote(spark, runs, select_run, f"{scratch}/sel")
    assert got["run_id"] == "b" and S.versions(spark, f"{scratch}/sel") == [1]


def test_trainings_at_the_same_time_leave_one_whole_selection(spark, scratch):
    def training(k):
        S.append_runs(run(spark, f"t{k}", f"family{k}", k, k / 10), f"{scratch}/runs")
        return step(spark, scratch)

    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(training, range(1, 7)))
    assert all(g for g in got)
    assert S.selection(spark, f"{scratch}/sel")["run_id"] == "t6"
    made = S.versions(spark, f"{scratch}/sel")
    assert made == list(range(1, len(made) + 1))
    kept = {r.version: r for r in S.history(spark, f"{scratch}/sel", RUNS).collect()}
    assert all(kept[v].previous == kept[v - 1].run_id for v in made[1:])
    assert S.read_runs(spark, f"{scratch}/runs").count() == 6


def test_gives_up_when_always_overtaken(spark, scratch, monkeypatch):
    S.append_runs(run(spark, "a", "als", 1, 0.3), f"{scratch}/runs")
    monkeypatch.setattr(S, "create_once", lambda *a: False)
    monkeypatch.setattr(S, "ATTEMPTS", 2)
    with pytest.raises(RuntimeError):
        step(spark, scratch)

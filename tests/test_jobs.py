"""The end-to-end jobs on fixture files."""

import json
import os
import random

from ratewise.plans.jobs import build_features, monitor
from ratewise.sources.eventlog import read_event_log
from ratewise.streaming.drain import drain


RATINGS = """7::301::4::5000
7::302::2::5010
8::301::9::5020
8::303::5::5030

8::303::1::5040
9::302::x::5050
9::302::3::5060
"""
MOVIES = """301::Harbour Lights (1988)::Drama|War
302::Café Noir (2011)::Film-Noir
303::Second Winter (1996)::Comedy
303::Second Winter, again (1996)::Comedy
304::Never Rated (2000)::Drama
"""
USERS = """7::F::25::3::10115
8::M::45::11::20095
8::M::45::11::20095
9::F::18::0::30159
"""


def _raw_files(scratch):
    paths = {}
    for name, text in (("ratings", RATINGS), ("movies", MOVIES), ("users", USERS)):
        paths[name] = f"{scratch}/{name}.dat"
        with open(paths[name], "wb") as f:
            f.write(text.encode("iso-8859-1"))
    return paths


def test_build_features_and_monitor(spark, scratch):
    p = _raw_files(scratch)
    audit = build_features(spark, p["ratings"], p["movies"], p["users"], f"{scratch}/features", csv_path=f"{scratch}/features_csv")
    assert audit == {"ratings_in": 7, "ratings_kept": 4, "movies_in": 5, "movies_kept": 4, "users_in": 4, "users_kept": 3}
    ft = spark.read.parquet(f"{scratch}/features")
    assert {(r.user_id, r.movie_id, r.rating) for r in ft.collect()} == {(7, 301, 4), (7, 302, 2), (8, 303, 5), (9, 302, 3)}
    assert len(ft.columns) == 34
    assert spark.read.option("header", True).csv(f"{scratch}/features_csv").count() == 4
    with open(f"{scratch}/log.jsonl", "w") as f:
        for ids in ([301, 302, 303], [302], [302, 301]):
            f.write(json.dumps({"user_id": 7, "k": len(ids), "movie_ids": ids}) + "\n")
        f.write("no json\n")
    snap = monitor(spark, f"{scratch}/log.jsonl", f"{scratch}/features", f"{scratch}/status").first()
    assert snap["drift_samples"] == 6 and snap["dataset_drift"] == 0  # too few samples to judge
    assert abs(snap["top_movie_share"] - 0.5) < 1e-9
    counts = {r["movie_id"]: r["count"] for r in spark.read.json(f"{scratch}/status/item_counts").collect()}
    assert counts == {301: 2, 302: 3, 303: 1}
    lines = spark.read.json(f"{scratch}/status/lines").first()
    assert (lines["lines"], lines["corrupt_lines"]) == (4, 1)


def test_serve_publishes_and_drains_into_the_log(spark, scratch):
    from ratewise.plans.jobs import serve
    reqs = spark.createDataFrame([(1, 7, 2, 0.0, 3.0), (2, 99, 2, 1.0, 4.0), (3, 7, 0, 2.0, 5.0)],
                                 "event_id long, user_id long, k int, ts double, latency_ms double")
    topk = spark.createDataFrame([(7, 301, 1), (7, 302, 2), (7, 303, 3)], "user_id long, movie_id long, rank int")
    catalog = spark.createDataFrame([(301, "Harbour Lights")], "movie_id long, title string")
    served, published = serve(reqs, topk, catalog, "json", f"{scratch}/topic")
    assert published
    assert {r.reason for r in served.where("NOT valid").collect()} == {"k must be between 1 and 100"}
    got = drain(spark, f"{scratch}/served-log", fmt="text", path=f"{scratch}/topic")
    assert got.appended == 2
    log = {r.user_id: r.movie_ids for r in read_event_log(spark, f"{scratch}/served-log").collect()}
    assert log == {7: [301, 302], 99: []}


def test_selection_over_two_trainings(spark, scratch):
    from ratewise.plans.jobs import train_and_select
    from ratewise.sources.selection import read_runs, selection
    rng = random.Random(8)
    rows = [(u, m, 1 + (u * m + rng.randint(0, 2)) % 5, 900 + 13 * u + 7 * m)
            for u in range(20, 30) for m in range(40, 58) if (u * 5 + m * 3) % 4]
    spark.createDataFrame(rows, "user_id int, movie_id int, rating int, timestamp long").write.parquet(f"{scratch}/features")
    for _ in range(2):
        chosen = train_and_select(spark, f"{scratch}/features", f"{scratch}/runs", f"{scratch}/model").collect()
    runs = read_runs(spark, f"{scratch}/runs").toPandas()
    assert len(runs) == 8 and runs.run_id.is_unique
    assert sorted(set(runs.family)) == ["als", "bpr", "popularity_baseline", "svd"]
    assert runs[runs.family.isin(["als", "bpr"])].rmse.isna().all()
    latest = runs.sort_values("start_time").groupby("family").tail(1)
    assert len(chosen) == 1 and chosen[0].run_id in set(latest.run_id)
    assert chosen[0].recall_at_10 == latest.recall_at_10.max()
    assert all(os.path.isdir(f"{scratch}/model/runs/{r}") for r in runs.run_id)
    assert selection(spark, f"{scratch}/model/selection")["run_id"] == chosen[0].run_id

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ratewise.operators import panes as P
from ratewise.sources import commits
from ratewise.streaming.panes import compact, late_count, read_late, read_panes, read_windows, run_panes

BASE = 1_700_000_040           # a whole minute


def requests(spark, rows):
    return spark.createDataFrame(rows, "second long, handler string, latency_ms double").select(
        F.timestamp_seconds(F.col("second") + BASE).alias("ts"), "handler", "latency_ms")


def some(seed, n=400, span=4000):
    rng = random.Random(seed)
    return [(rng.randrange(span), rng.choice("abbb"), rng.choice([None, 1.0, 5.0, 7.5, 80.0, 900.0, 5000.0])) for _ in range(n)]


@pytest.mark.parametrize("block", [8640, 5])
def test_sliding_rate_matches_recount(spark, monkeypatch, block):
    monkeypatch.setattr(P, "BLOCK", block)               # 5: windows reach over block edges, and over whole blocks
    rows = some(1)
    for window in (10, 60, 120):
        got = {(r.window_end.timestamp(), r.handler): (r.requests, r.rate_per_s)
               for r in P.sliding_request_rate(requests(spark, rows), window).select(
                   F.col("window_end").cast("timestamp").alias("window_end"), "handler", "requests", "rate_per_s").collect()}
        want = {}
        for s, h, _ in rows:
            end = ((s + BASE) // 10 + 1) * 10
            n = sum(1 for t, g, _ in rows if g == h and end - window <= t + BASE < end)
            want[end, h] = (n, n / window)
        assert got == want


def test_pane_rows_do_not_grow_with_the_window(spark):
    reqs = requests(spark, some(2))
    panes = P.count_panes(reqs, ["handler"]).count()
    assert P.sliding_request_rate(reqs, 60).count() == P.sliding_request_rate(reqs, 3600).count() == panes
    with pytest.raises(ValueError):
        P.sliding_request_rate(reqs, 25)


def test_histogram_quantiles(spark):
    rows = [(0, "a", x) for x in (4.0, 6.0, 6.0, 8.0, 30.0, 9000.0)] + [(700, "a", 9000.0), (1500, "a", None)]
    got = P.sliding_latency(requests(spark, rows), 300).orderBy("window_end").collect()
    assert [r.requests for r in got] == [6, 1]           # a window of null latencies only has no row
    assert got[0].p50_ms == pytest.approx(5 + 5 * (3 - 1) / 3)
    assert got[0].p95_ms == P.BOUNDS[-1] and got[1].p50_ms == P.BOUNDS[-1]


def stream_of(spark, rows, folder):
    frame = requests(spark, rows)
    frame.write.mode("append").parquet(folder)
    return spark.readStream.schema(frame.schema).parquet(folder)


def test_windows_of_several_runs(spark, scratch):
    src, out = f"{scratch}/in", f"{scratch}/out"
    first, second, third = [(5, "a", 1.0), (65, "a", 1.0), (3000, "b", 1.0)], [(70, "a", 1.0), (2990, "b", 1.0), (2399, "b", 1.0)], [
        (9000, "a", 1.0)]
    assert read_windows(spark, out, 60, ["handler"]) is None
    assert run_panes(spark, stream_of(spark, first, src), out, 60, ["handler"]) == 3
    early = read_windows(spark, out, 60, ["handler"]).collect()
    assert len(early) == 3 and sum(r.closed for r in early) == 2        # the open window is there already
    assert run_panes(spark, stream_of(spark, second, src), out, 60, ["handler"]) == 1
    assert late_count(spark, out) == 2
    assert sorted((r.ts.timestamp() - BASE) for r in read_late(spark, out).collect()) == [70, 2399]
    compact(spark, out, ["handler"])
    assert run_panes(spark, stream_of(spark, third, src), out, 60, ["handler"]) == 1
    for _ in range(3):
        compact(spark, out, ["handler"])                 # nothing new: nothing happens
    got = Counter()
    for r in read_windows(spark, out, 60, ["handler"]).collect():
        got[r.handler] += r.requests
        assert r.closed == (r.handler == "b" or r.requests and r.window_end.timestamp() < 9000 + BASE - 600)
    assert got == {"a": 3, "b": 2}
    assert run_panes(spark, spark.readStream.schema(requests(spark, []).schema).parquet(src), out, 60, ["handler"]) == 0


def test_compacted_tables_hold_each_batch_once(spark, scratch):
    src, out = f"{scratch}/in", f"{scratch}/out"
    for k in range(4):
        run_panes(spark, stream_of(spark, [(1000 * k + j, "a", 1.0) for j in range(3)], src), out, 60, ["handler"])
        compact(spark, out, ["handler"])
        assert read_panes(spark, out, ["handler"]).agg(F.sum("requests")).first()[0] == 3 * (k + 1)
    assert len([c for c in commits.committed(spark, out) if c.writer == "folded"]) == 4

"""Drift from merged summaries against exact values."""

import math

import numpy as np
import pytest

from ratewise.operators import drift_sketch as D

SCHEMA = "batch int, movie_rating_count double, movie_avg_rating double"


def exact_ks(a, b):
    at = np.unique(np.concatenate([a, b]))
    return np.abs(np.searchsorted(np.sort(a), at, side="right") / len(a) - np.searchsorted(np.sort(b), at, side="right") / len(b)).max()


def exact_psi(ref, cur):
    low, high = ref.min(), ref.max()
    share = lambda x: np.maximum(np.bincount(np.clip(np.floor((x - low) / (high - low) * 10), 0, 9).astype(int), minlength=10) / len(x), 1e-4)
    r, c = share(ref), share(cur)
    return ((c - r) * np.log(c / r)).sum()


def frame(spark, values, batch=0):
    batch = np.broadcast_to(batch, len(values))
    return spark.createDataFrame([(int(b), float(v), float(v) / 7) for b, v in zip(batch, values)], SCHEMA)


@pytest.mark.parametrize("n, k", [(300, 2000), (20_000, 200), (20_000, 2000)])
def test_merged_batches_stay_within_the_bound(spark, n, k):
    rng = np.random.default_rng(n + k)
    ref, cur = np.round(rng.normal(50, 10, n), 1), np.round(rng.normal(53, 14, n), 1)
    reference = D.reference_summary(frame(spark, ref), k=k)
    parts = D.batch_summary(frame(spark, cur, rng.integers(0, 6, n)), reference, ["batch"], k=k)
    assert parts.count() == 12
    got = D.merged_tests(reference, parts, k).where("feature = 'movie_rating_count'").first()
    assert (got.n_ref, got.n_cur) == (n, n)
    assert abs(got.ks - exact_ks(ref, cur)) <= got.ks_error
    assert got.ks_error == pytest.approx((2 * 2.296 / k ** 0.9021 if n > k else 0) + 0.001)
    assert got.psi == pytest.approx(exact_psi(ref, cur))


def test_small_sides_are_exact_and_ties_repeats_and_one_value(spark):
    reference = D.reference_summary(frame(spark, [1, 1, 2, 3, 3, 3]))
    got = D.merged_tests(reference, D.batch_summary(frame(spark, [3, 3, 9]), reference)).orderBy("feature").collect()
    assert [r.ks for r in got] == [pytest.approx(0.5, abs=0.001)] * 2
    flat = D.reference_summary(frame(spark, [4.0] * 5))
    same = D.merged_tests(flat, D.batch_summary(frame(spark, [4.0] * 3), flat)).first()
    assert same.ks == 0 and same.psi == 0


def test_nulls_nan_and_empty_sides(spark):
    rows = [(0, None, 1.0), (0, math.nan, 2.0), (0, 5.0, None)]
    reference = D.reference_summary(spark.createDataFrame(rows, SCHEMA))
    assert {r.feature: r.n for r in reference.collect()} == {"movie_rating_count": 1, "movie_avg_rating": 2}
    nothing = D.batch_summary(frame(spark, []), reference)
    got = D.merged_tests(reference, nothing).collect()
    assert len(got) == 2 and all(r.ks is None and r.n_cur == 0 for r in got)
    empty = D.reference_summary(frame(spark, []))
    assert D.merged_tests(empty, nothing).count() == 0


def test_stored_summaries_count_a_repeated_batch_once(spark, scratch):
    reference = D.reference_summary(frame(spark, [1, 2, 3, 4]))
    assert D.read_summaries(spark, f"{scratch}/s").count() == 0
    for writer, number, values in [("q1", 0, [1, 2]), ("q1", 0, [1, 2]), ("q2", 0, [4]), ("q1", 1, [])]:
        D.store_summary(D.batch_summary(frame(spark, values), reference), f"{scratch}/s", writer, number)
    got = D.merged_tests(reference, D.read_summaries(spark, f"{scratch}/s")).first()
    assert got.n_cur == 3 and got.ks == pytest.approx(exact_ks(np.array([1, 2, 3, 4]), np.array([1, 2, 4])), abs=got.ks_error)


def test_population_keeps_the_batch_and_repeats(spark):
    stats = spark.createDataFrame([(7, 12.0, 2.5), (8, 3.0, 4.5)], "movie_id long, movie_rating_count double, movie_avg_rating double")
    events = spark.createDataFrame([(1, [7, 7, 404]), (2, [8]), (2, [])], "batch int, movie_ids array<long>")
    got = sorted(tuple(r) for r in D.batch_population(events, stats, ["batch"]).collect())
    assert got == [(1, 12.0, 2.5), (1, 12.0, 2.5), (2, 3.0, 4.5)]

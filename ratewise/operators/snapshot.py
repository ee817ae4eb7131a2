"""Monitoring snapshot: the drift and frequency status records as one row of gauges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def monitoring_snapshot(spark: SparkSession, drift: DataFrame | None, frequency: DataFrame | None) -> DataFrame:
    """One row: dataset_drift (1/0), drift_share, drift_samples, top_movie_share; 0 when a status is absent.

    The two status frames are stacked as (metric, value) rows and pivoted with
    conditional aggregates -- no join between one-row frames.
    """
    parts = []
    if drift is not None:
        parts.append(drift.selectExpr(
            "stack(3, 'dataset_drift', CAST(CASE WHEN dataset_drift THEN 1 ELSE 0 END AS DOUBLE),"
            " 'drift_share', CAST(drift_share AS DOUBLE), 'drift_samples', CAST(n_samples AS DOUBLE))"
            " AS (metric, value)"))
    if frequency is not None:
        parts.append(frequency.selectExpr("'top_movie_share' AS metric", "CAST(top_movie_share AS DOUBLE) AS value"))
    if parts:
        long = parts[0]
        for p in parts[1:]:
            long = long.unionByName(p)
    else:
        long = spark.createDataFrame([], "metric string, value double")

    def pick(name: str):
        return F.coalesce(F.max(F.when(F.col("metric") == name, F.col("value"))), F.lit(0.0))

    return long.agg(
        pick("dataset_drift").cast("int").alias("dataset_drift"),
        pick("drift_share").alias("drift_share"),
        pick("drift_samples").cast("long").alias("drift_samples"),
        pick("top_movie_share").alias("top_movie_share"),
    )

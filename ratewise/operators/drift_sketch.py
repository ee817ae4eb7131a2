"""Incremental drift: each drained batch is summarised once, a verdict merges the summaries.

A summary holds, per feature, the row count, a KLL sketch of the values and the counts of the reference's
ten PSI bins.  Summaries of any batches merge: counts add up, sketches merge into one of the same size, so a
verdict reads a few kilobytes a batch instead of the whole log.  PSI from merged bins is exact.  KS compares the
distributions that ``GRID`` quantiles of either merged sketch describe; ``ks_error`` bounds its distance from the
exact one:

    e_ref + e_cur + 1 / GRID,  e = 2.296 / k ** 0.9021 for a sketch of more than k values, else 0

(e is the rank error that the sketch's authors give for a confidence of 99 %.  With the quantiles q_0, ..., q_GRID a
value's share is read as the largest i with q_i <= value, over GRID: at most 1 / GRID too low, on either side.)

Null values and NaN are left out, as a sketch takes neither.  An empty side gives no KS and no bins' shares but
the floor.  Summaries are stored append-only under (writer, number): a repeated batch counts once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratewise.operators.drift import FEATURES, PSI_BINS, PSI_FLOOR
from ratewise.operators.sizing import join_small
from ratewise.sources.commits import committed, write_once

SKETCH_K = 2000
GRID = 1000
RANK_ERROR = (2.296, 0.9021)   # fixed values: rank error of a sketch of size k is a / k ** b
SUMMARY = "feature string, n long, sketch binary, bins array<long>"


def batch_population(events: DataFrame, stats: DataFrame, by: Sequence[str], item_col: str = "movie_id",
                     features: Sequence[str] = FEATURES) -> DataFrame:
    """Stats of every recommended id with the columns ``by`` of its event (repeats kept, unknown ids dropped)."""
    ids = events.select(*by, F.explode("movie_ids").alias(item_col))
    return join_small(ids, stats.select(item_col, *features), item_col, "inner").select(*by, *features)


def _long(population: DataFrame, by: Sequence[str], features: Sequence[str]) -> DataFrame:
    value = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]))
    rows = population.select(*by, value.alias("_v")).select(*by, "_v.feature", "_v.value")
    return rows.where(F.col("value").isNotNull() & ~F.isnan("value"))


def reference_summary(reference: DataFrame, features: Sequence[str] = FEATURES, k: int = SKETCH_K) -> DataFrame:
    """feature, n, sketch, bins, low and high (range) of the catalogue: one row a feature with values."""
    rows = _long(reference, [], features)
    span = rows.groupBy("feature").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    return _summed(rows.join(F.broadcast(span), "feature"), ["feature", "low", "high"], k)


def batch_summary(population: DataFrame, reference: DataFrame, by: Sequence[str] = (), features: Sequence[str] = FEATURES,
                  k: int = SKETCH_K) -> DataFrame:
    """``by``, feature, n, sketch, bins: a summary of each batch, in the bins of ``reference_summary``."""
    rows = _long(population, by, features).join(F.broadcast(reference.select("feature", "low", "high")), "feature")
    return _summed(rows, [*by, "feature"], k)


def _summed(rows: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    span = F.col("high") - F.col("low")
    place = F.when(span > 0, F.least(F.lit(PSI_BINS - 1), F.greatest(
        F.lit(0), F.floor((F.col("value") - F.col("low")) / span * PSI_BINS)))).otherwise(F.lit(0))
    return rows.withColumn("_bin", place).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", k).alias("sketch"),
        F.array(*[F.count_if(F.col("_bin") == b) for b in range(PSI_BINS)]).alias("bins"))


def merged(summaries: DataFrame, by: Sequence[str] = ("feature",)) -> DataFrame:
    """One summary for each value of ``by``."""
    bins = F.array(*[F.sum(F.element_at("bins", b + 1)) for b in range(PSI_BINS)])
    return summaries.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"), bins.alias("bins"))


def store_summary(summary: DataFrame, path: str, writer: str, number: int) -> None:
    """Keep the summary (one row a feature) of batch ``number`` of a writer; once it is there, nothing happens."""
    def write(folder: str) -> int:
        summary.select("feature", "n", "sketch", "bins").coalesce(1).write.parquet(folder)
        return summary.sparkSession.read.schema(SUMMARY).parquet(folder).count()
    write_once(summary.sparkSession, path, writer, number, write)


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """All stored summaries."""
    paths = [f"{path.rstrip('/')}/{c.folder}" for c in committed(spark, path) if c.rows]
    return spark.read.schema(SUMMARY).parquet(*paths) if paths else spark.createDataFrame([], SUMMARY)


def _error(n: str, k: int) -> Column:
    return F.when(F.col(n) > k, F.lit(RANK_ERROR[0] / k ** RANK_ERROR[1])).otherwise(F.lit(0.0))


def merged_tests(reference: DataFrame, summaries: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """feature, n_ref, n_cur, ks, ks_error, psi of the merged ``summaries`` against ``reference_summary``."""
    now = merged(summaries).select("feature", F.col("n").alias("n_cur"), F.col("sketch").alias("cur"), F.col("bins").alias("c"))
    both = reference.select("feature", F.col("n").alias("n_ref"), F.col("sketch").alias("ref"), F.col("bins").alias("r")) \
        .join(now, "feature", "left").withColumn("n_cur", F.coalesce("n_cur", F.lit(0)))
    steps = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    points = [both.select("feature", F.posexplode(F.kll_sketch_get_quantile_double(side, steps)).alias(side, "value"))
              for side in ("ref", "cur")]
    upto = Window.partitionBy("feature").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)     # 2 * GRID rows at most
    share_at = lambda side: F.coalesce(F.max(side).over(upto), F.lit(0)) / F.lit(float(GRID))
    ks = (points[0].unionByName(points[1], allowMissingColumns=True)
          .groupBy("feature", "value").agg(F.max("ref").alias("ref"), F.max("cur").alias("cur"))
          .select("feature", "cur", F.abs(share_at("ref") - share_at("cur")).alias("gap"))
          .groupBy("feature").agg(F.when(F.count("cur") > 0, F.max("gap")).alias("ks")))
    share = lambda count, n: F.greatest(F.coalesce(F.try_divide(count, F.col(n)), F.lit(0.0)), F.lit(PSI_FLOOR))
    none = F.array_repeat(F.lit(0).cast("long"), PSI_BINS)
    terms = F.zip_with("r", F.coalesce("c", none), lambda r, c: (share(c, "n_cur") - share(r, "n_ref")) * F.log(share(c, "n_cur") / share(r, "n_ref")))
    return both.join(ks, "feature").select(
        "feature", "n_ref", "n_cur", "ks", (_error("n_ref", k) + _error("n_cur", k) + F.lit(1 / GRID)).alias("ks_error"),
        F.aggregate(terms, F.lit(0.0), lambda s, t: s + t).alias("psi"))

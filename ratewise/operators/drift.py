"""Distribution drift between the catalog (reference) and what was recommended (current).

Populations
    reference -- one (rating_count, avg_rating) row per catalog item;
    current   -- the same two columns for every recommended id, repeats kept,
                 unknown ids dropped (inner join, not a semi join).

Per-column two-sample statistics, all from one value-grouped table:
    ks          max |F_ref - F_cur| over the distinct values;
    ks_pvalue   asymptotic Kolmogorov tail with Stephens' small-sample factor;
    wasserstein sum |F_ref - F_cur| * (next value - value), and divided by the
                reference's population standard deviation;
    psi         population stability index on 10 equal-width bins of the
                reference range (shares floored at 1e-4).
The cumulative shares use ``prefix_scan`` (range partitions + offsets), so a
column with very many distinct values is never scanned by a single task.

Verdict: a column drifts when (KS) p < 0.05, used for reference sizes up to
1000, or (Wasserstein) normed distance >= 0.1 above that; the data set drifts
when the drifted share is >= 0.5.  Fewer than 30 current rows ->
``insufficient_data`` with zeros.  Method and thresholds are parameters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.operators.ranking import prefix_scan
from ratewise.operators.sizing import join_small

FEATURES = ("movie_rating_count", "movie_avg_rating")
# Fixed values of the verdict (documented defaults, all overridable).
MIN_SAMPLES = 30
KS_PVALUE = 0.05
WASSERSTEIN_NORMED = 0.1
KS_MAX_REFERENCE = 1000
SHARE = 0.5
PSI_BINS = 10
PSI_FLOOR = 1e-4


def current_population(events: DataFrame, stats: DataFrame, item_col: str = "movie_id",
                       features: Sequence[str] = FEATURES) -> DataFrame:
    """Stats of every recommended id, one row per recommendation (multiplicity kept)."""
    ids = events.select(F.explode("movie_ids").alias(item_col))
    return join_small(ids, stats.select(item_col, *features), item_col, "inner").select(*features)


def _long(pop: DataFrame, origin: str, features: Sequence[str]) -> DataFrame:
    pairs = ", ".join(f"'{f}', CAST({f} AS DOUBLE)" for f in features)
    return pop.selectExpr(f"stack({len(features)}, {pairs}) AS (feature, value)") \
        .filter(F.col("value").isNotNull()).withColumn("origin", F.lit(origin))


def column_tests(reference: DataFrame, current: DataFrame, features: Sequence[str] = FEATURES,
                 method: str = "auto", ks_pvalue: float = KS_PVALUE,
                 wasserstein_threshold: float = WASSERSTEIN_NORMED,
                 ks_max_reference: int = KS_MAX_REFERENCE) -> DataFrame:
    """One row per feature: sizes, ks, ks_pvalue, wasserstein, wasserstein_norm, psi, method, drifted.

    With ``method="auto"`` the verdict rule depends on the reference size: KS up to
    ``ks_max_reference`` reference rows, normed Wasserstein above (the statistics are
    computed either way).
    """
    both = _long(reference, "ref", features).unionByName(_long(current, "cur", features))
    is_ref = F.col("origin") == "ref"
    # the two populations are read once, into the value-grouped table (one row
    # per distinct value); the scan writes it and every later step reads that
    by_value = both.groupBy("feature", "value").agg(
        F.count_if(is_ref).alias("r"), F.count_if(~is_ref).alias("c"))
    scanned = prefix_scan(by_value, ["feature"], "value", ["r", "c"])
    sums = scanned.groupBy("feature").agg(
        F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"),
        F.try_divide(F.sum(F.col("r") * F.col("value")), F.sum("r")).alias("_mean"),
        F.min(F.when(F.col("r") > 0, F.col("value"))).alias("ref_min"),
        F.max(F.when(F.col("r") > 0, F.col("value"))).alias("ref_max"))
    # population std of the reference, two-pass (mean first); one row per feature
    spread = scanned.join(F.broadcast(sums.select("feature", "_mean")), "feature").groupBy("feature").agg(
        F.sqrt(F.try_divide(F.sum(F.col("r") * (F.col("value") - F.col("_mean")) ** 2), F.sum("r")))
        .alias("ref_std"))
    # totals has one row per feature: a proven small broadcast
    totals = sums.drop("_mean").join(spread, "feature")
    scanned = scanned.join(F.broadcast(totals), "feature")
    # an empty population (no reference rows, or nothing recommended yet) gives NULL
    # statistics instead of a division error; the status gate reports it
    f_ref = F.try_divide(F.col("cum_r"), F.col("n_ref"))
    f_cur = F.try_divide(F.col("cum_c"), F.col("n_cur"))
    gap = F.abs(f_ref - f_cur)
    width = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    span = F.col("ref_max") - F.col("ref_min")
    bin_ = F.when(span > 0, F.least(F.lit(PSI_BINS - 1), F.greatest(
        F.lit(0), F.floor((F.col("value") - F.col("ref_min")) / span * PSI_BINS)))).otherwise(F.lit(0))
    per_value = scanned.select("feature", "n_ref", "n_cur", "ref_std", "r", "c",
                               gap.alias("gap"), (gap * width).alias("area"), bin_.cast("int").alias("bin"))
    bins = per_value.groupBy("feature", "bin").agg(
        F.sum("r").alias("br"), F.sum("c").alias("bc"), F.first("n_ref").alias("n_ref"),
        F.first("n_cur").alias("n_cur"))
    pr = F.greatest(F.coalesce(F.try_divide(F.col("br"), F.col("n_ref")), F.lit(0.0)), F.lit(PSI_FLOOR))
    pc = F.greatest(F.coalesce(F.try_divide(F.col("bc"), F.col("n_cur")), F.lit(0.0)), F.lit(PSI_FLOOR))
    psi = bins.groupBy("feature").agg(F.sum((pc - pr) * F.log(pc / pr)).alias("psi"))
    stats = per_value.groupBy("feature").agg(
        F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur"),
        F.max("gap").alias("ks"), F.sum("area").alias("wasserstein"), F.first("ref_std").alias("ref_std"))
    out = stats.join(psi, "feature", "left")
    en = F.try_divide(F.col("n_ref") * F.col("n_cur"), F.col("n_ref") + F.col("n_cur"))
    lam = (F.sqrt(en) + F.lit(0.12) + F.try_divide(F.lit(0.11), F.sqrt(en))) * F.col("ks")
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
        lambda acc, j: acc + F.pow(F.lit(-1.0), j - 1) * F.exp(F.lit(-2.0) * j * j * F.col("_lam") * F.col("_lam")))
    chosen = (F.when(F.col("n_ref") <= ks_max_reference, F.lit("ks")).otherwise(F.lit("wasserstein"))
              if method == "auto" else F.lit(method))
    out = out.withColumn("_lam", lam).select(
        "feature", "n_ref", "n_cur", "ks",
        F.when(F.col("_lam").isNull() | (F.col("_lam") < 0.2), F.lit(1.0)).otherwise(
            F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(2.0) * series))).alias("ks_pvalue"),
        "wasserstein",
        F.when(F.col("ref_std") > 0, F.col("wasserstein") / F.col("ref_std"))
        .otherwise(F.col("wasserstein")).alias("wasserstein_norm"),
        F.coalesce("psi", F.lit(0.0)).alias("psi"),
        chosen.alias("method"),
    )
    drifted = F.when(F.col("method") == "ks", F.col("ks_pvalue") < ks_pvalue) \
        .otherwise(F.col("wasserstein_norm") >= wasserstein_threshold)
    return out.withColumn("drifted", drifted & (F.col("n_cur") > 0))


def drift_status(tests: DataFrame, n_features: int = len(FEATURES), min_samples: int = MIN_SAMPLES,
                 share_threshold: float = SHARE) -> DataFrame:
    """One row: dataset_drift, drift_share, number_of_drifted_columns, n_samples, status."""
    agg = tests.agg(F.coalesce(F.max("n_cur"), F.lit(0)).cast("long").alias("n_samples"),
                    F.coalesce(F.count_if("drifted"), F.lit(0)).cast("int").alias("n_drifted"))
    enough = F.col("n_samples") >= min_samples
    share = F.col("n_drifted") / F.lit(float(n_features))
    return agg.select(
        F.when(enough, share >= share_threshold).otherwise(F.lit(False)).alias("dataset_drift"),
        F.when(enough, share).otherwise(F.lit(0.0)).alias("drift_share"),
        F.when(enough, F.col("n_drifted")).otherwise(F.lit(0)).alias("number_of_drifted_columns"),
        "n_samples",
        F.when(enough, F.lit("ok")).otherwise(F.lit("insufficient_data")).alias("status"),
    )

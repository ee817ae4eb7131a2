"""Ranking inside groups.

``top_k_per_group`` is the usual ``row_number() <= k`` window; Spark plans a
partial *WindowGroupLimit* before the shuffle, so each map task forwards at
most ``k`` rows per group and a hot group cannot flood one reducer.

``rank_within`` numbers **all** rows of each group (a split needs the full
rank, not a top-k).  A plain window would send a whole group to one task, so
it ranks in two levels instead:

1. range-partition on (group, order) -- the sampled bounds cut a hot group
   into several partitions -- and sort inside each partition;
2. position of each row inside its partition (``monotonically_increasing_id``
   after the sort) and a per-(partition, group) summary: first position and
   row count, one row per pair, i.e. about groups + partitions rows;
   the tagged rows are written once to the shared folder, so that both uses
   read the same layout, whatever happens to executors in between;
3. rows before this partition = running sum of the summary counts over the
   partitions of the group (a window over the small summary);
4. rank = position - first position + 1 + rows before.

The ordering must be total inside a group (add a unique tie-break column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.operators.sizing import join_small, materialise


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str | Column],
                    k: int, rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows of every group by ``order_cols``; adds ``rank_col`` (1-based)."""
    w = Window.partitionBy(*group_cols).orderBy(*_cols(order_cols))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def _ranged(df: DataFrame, keys: list[Column], num_partitions: int | None, tag: str) -> DataFrame:
    """``df`` range-partitioned and sorted by ``keys``, tagged with partition and position, written once.

    An explicit partition count keeps AQE from coalescing the exchange.
    """
    parts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return materialise(ranged.withColumn("_part", F.spark_partition_id())
                       .withColumn("_pos", F.monotonically_increasing_id()), tag)


def rank_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str | Column],
                rank_col: str = "rn", size_col: str | None = "group_rows",
                num_partitions: int | None = None) -> DataFrame:
    """Exact 1-based row number per group by ascending ``order_cols``, skew-safe at any size.

    Adds ``rank_col`` and (when ``size_col`` is given) the group's row count.
    One materialisation of the sorted rows, no other job.
    """
    tagged = _ranged(df, [F.col(c) for c in group_cols] + _cols(order_cols), num_partitions, "rank")
    summary = (tagged.groupBy("_part", *group_cols)
               .agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_cnt")))
    # with no group columns this ranks the whole frame; the window then runs
    # over one summary row per partition only
    over_parts = Window.partitionBy(*group_cols).orderBy("_part")
    summary = summary.withColumn(
        "_before",
        F.coalesce(F.sum("_cnt").over(over_parts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    if size_col:
        summary = summary.withColumn(size_col, F.sum("_cnt").over(Window.partitionBy(*group_cols)))
    # The summary has about (groups + partitions) rows: broadcast when its
    # measured size allows, shuffle join on (partition, group) otherwise.
    joined = join_small(tagged, summary.drop("_cnt"), ["_part", *group_cols], "inner")
    ranked = joined.withColumn(rank_col, F.col("_pos") - F.col("_first") + 1 + F.col("_before"))
    return ranked.drop("_part", "_pos", "_first", "_before")


def prefix_scan(df: DataFrame, group_cols: Sequence[str], order_col: str, sum_cols: Sequence[str],
                num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` per group in ``order_col`` order, plus the next value.

    Adds ``cum_<c>`` for every ``c`` in ``sum_cols`` and ``next_<order_col>``
    (NULL for the last row of a group).  ``order_col`` must be unique within a
    group (scan a table already grouped by it).  Same two-level layout as
    ``rank_within``: range partitions split large groups, a window runs per
    (partition, group) and the offsets of earlier partitions come from a
    per-(partition, group) summary.
    """
    tagged = _ranged(df, [F.col(c) for c in group_cols] + [F.col(order_col)], num_partitions, "scan").drop("_pos")
    local = Window.partitionBy("_part", *group_cols).orderBy(order_col)
    upto = local.rowsBetween(Window.unboundedPreceding, 0)
    scanned = tagged.select(
        "*",
        *[F.sum(c).over(upto).alias(f"_loc_{c}") for c in sum_cols],
        F.lead(order_col).over(local).alias("_next"),
    )
    summary = tagged.groupBy("_part", *group_cols).agg(
        F.min(order_col).alias("_min"), *[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    over_parts = Window.partitionBy(*group_cols).orderBy("_part")
    before = over_parts.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(
        "_part", *group_cols,
        F.lead("_min").over(over_parts).alias("_next_part_min"),
        *[F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
    )
    joined = join_small(scanned, summary, ["_part", *group_cols], "inner")
    return joined.select(
        *df.columns,
        *[(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(f"cum_{c}") for c in sum_cols],
        F.coalesce("_next", "_next_part_min").alias(f"next_{order_col}"),
    )

"""Mixing sources to target weights along a time-varying curriculum, DataFrame functions only.

Targets: the mix holds ``total`` times the words of all documents, shared between the sources by
weight; a source stops at ``most`` times its own words and the excess is shared by weight among the
rest, which ends in a common level: target = least(cap, level * weight).  The level is found from
the sources ordered by cap / weight.

Curriculum: each source has a weight schedule, linear in training time t from ``1 - slope`` to
``1 + slope`` (``slope`` by the source's place in the weight cycle).  Its integral
D(t) = target * ((1 - slope) * t + slope * t * t) is the number of its words demanded by time t.  A
source's documents stand in a fixed pseudo-random order, pass after pass; the occurrence whose words
start at cumulative word c is trained on at the time t with D(t) = c, and the documents are
range-sorted by that position.

Hot sources: the cumulative words of a source come from two levels, sums over (source, slice of the
order) and a window inside each slice, so no task holds a source.

Defined results: null text has size 0; a null source is a source of its own and comes last; a
document without words takes nothing; equal rows share the order's ties in any order, with the same
sums; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import store

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SLOPES = (-0.5, 0.0, 0.5)       # heavy sources early, light sources late
SLICE_DIGITS = 3                # 16**3 slices of a source's order


def _cycle(values: tuple[float, ...], place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), ((place % len(values)) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, total: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """source, source_size, place, weight, target of each source of ``sizes`` (source, size).
    One row per source; the windows below run over that aggregate."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    placed = per.withColumn("place", F.row_number().over(order) - 1)
    placed = placed.withColumn("weight", _cycle(weights, F.col("place")))
    placed = placed.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy("one").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (placed.withColumn("one", F.lit(1))
              .withColumn("all", F.sum("source_size").over(everything))
              .withColumn("level", (F.lit(float(total)) * F.col("all") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                          / F.sum("weight").over(after)))
    # the level of the first source that stays below its cap when all smaller ratios are capped
    free = F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.col("level"))
    chosen = levels.withColumn("chosen", F.min(F.struct(F.when(free.isNotNull(), 0).otherwise(1),
                                                        F.col("cap") / F.col("weight"), F.col("place"), free.alias("l")))
                               .over(everything)["l"])
    target = F.when(F.col("chosen").isNull(), F.col("cap")).otherwise(
        F.least("cap", F.col("chosen") * F.col("weight")))
    return chosen.select("source", "source_size", "place", "weight", target.alias("target"))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            weights: tuple[float, ...] = WEIGHTS, total: float = 1.5, most: float = 2.0,
            slopes: tuple[float, ...] = SLOPES) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words the mix takes),
    before (words of its source that stand before it in a pass), copies (passes that reach it) and
    positions (training time of each, from 0 to 1)."""
    sizes = store(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "mix-sizes")
    turn = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")) ).cast("binary"))
    sizes = sizes.withColumn("turn", turn).withColumn("slice", F.substring("turn", 1, SLICE_DIGITS))
    sources = store(source_targets(sizes, weights, total, most), "mix-targets")

    # words of the source before each slice, by sums over slices
    per_slice = sizes.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    per_slice = per_slice.select(F.col("source").alias("s"), F.col("slice").alias("k"),
                                 F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("ahead"))
    wanted = per_slice.join(sources, F.col("s").eqNullSafe(F.col("source"))).drop("source")

    inside = (Window.partitionBy("source", "slice").orderBy("turn", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = sizes.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = placed.join(wanted, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("k")))

    start = F.col("ahead") + F.col("within")
    stop = F.floor("target")
    passes = F.sequence(F.lit(0), F.lit(max(0, int(-(-most // 1)) - 1)))
    begins = F.transform(passes, lambda k: k * F.col("source_size") + F.col("before"))
    took = F.transform(begins, lambda b: F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), F.col("stop") - b)))
    slope = _cycle(slopes, F.col("place"))
    out = (joined.withColumn("before", start).withColumn("stop", stop).withColumn("slope", slope)
           .withColumn("took", took)
           .withColumn("taken", F.aggregate("took", F.lit(0).cast("long"), lambda a, x: a + x))
           .withColumn("starts", F.filter(begins, lambda b: (b < F.col("stop")) & (F.col("size") > 0))))

    def time(b: Column) -> Column:
        # D(t) = c  <=>  slope * t^2 + (1 - slope) * t - c / target = 0
        q = b / F.col("target")
        a, p = F.col("slope"), 1 - F.col("slope")
        return F.when(a == 0, q).otherwise((F.sqrt(F.greatest(F.lit(0.0), p * p + 4 * a * q)) - p) / (2 * a) + 0.0)

    return out.select("doc_id", "source", "size", "source_size", "target", "taken", "before",
                      F.size("starts").cast("long").alias("copies"), F.transform("starts", time).alias("positions"))


def training_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                   **options) -> DataFrame:
    """``docs``, each row as often as the mix takes it (a document cut by its source's target counts
    whole), range-sorted by training position.  Same columns."""
    chosen = (mixture(docs, id_col, text_col, source_col, **options).where("copies > 0")
              .groupBy("doc_id").agg(F.max_by("positions", F.struct("copies", "positions")).alias("positions")))
    chosen = chosen.withColumnRenamed("doc_id", "_mix_id").withColumnRenamed("positions", "_mix_at")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(id_col).cast("long").alias("_id"))
    joined = rows.join(chosen, F.col("_id").eqNullSafe(F.col("_mix_id")))
    placed = joined.select("row", "_id", F.explode("_mix_at").alias("_at"))
    return placed.repartitionByRange("_at", "_id").sortWithinPartitions("_at", "_id").select("row.*")

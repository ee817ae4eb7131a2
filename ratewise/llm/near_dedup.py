"""Near-duplicate components from bottom-k sketches of one hash function.

A document's set holds 64-bit hashes of its five-word shingles; its sketch keeps the ``SKETCH``
smallest.  Documents with one and the same set form a class with one representative.  Inverted lists
of the retained values generate candidate pairs, the union sketch of a pair estimates its similarity
and filters, and the full sets confirm.

Which values are listed: two sets of similarity 0.75 share at least s retained values (exactly
ceil(0.75 n) for sets that fit into three quarters of a sketch; for larger ones ``LEAST_SHARED``, which a
pair at the threshold misses with a probability below 3e-7, as the retained values of the union are a
uniform sample of it).  So each document lists only the rarest values, all but its s - 1 most frequent
ones, and a document with fewer than s values that occur elsewhere has no partner at all.  This keeps
passages that many documents share out of the lists.

Which pairs are tested: no list is expanded into all its pairs.  In a star round documents of a list meet
its leads.  The first round has one, the most central document (whose retained values occur most often
elsewhere: the text that the copies of a group were made from, if it is there), which joins groups of
copies at linear cost.  Each further round takes the lists that still hold several components, and
``LEADS`` times as many of their most central documents as leads (the square of that after a round that linked nothing, as the components stay as they were); only the
documents outside a list's main component meet them.  A list is done when it holds one component, or when all its documents have been leads.  So a
group whose members are linked at random is one component after a few leads each, and only documents that
stay unlinked meet the rest of their lists.  Pairs that their sizes rule out, the number of shingles that
other candidates have too, or the measured intersections with the list's central document, are left out at
once; pairs inside a component are never made, no list and no partner is left out.

Defined results: null or word-less text has an empty set and stays alone; fewer than five words form
one shingle; rows of equal id count as one node; a null id is linked with nothing; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import LOWER, chunks, likely_in, mix, signed, store, text_bytes, window_hashes, word_hashes
from ratewise.llm.components import components

WIDTH = 5                   # words a shingle
PERCENT = 75                # 100 * intersection >= PERCENT * union
SKETCH = 64                 # retained values
LEADS = 16                  # times as many leads in each further star round
LEAST_SHARED = 28           # of them shared at least by a pair at the threshold


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the rows of a chunk, ordered by row and hash; their bounds."""
    n = len(offsets) - 1
    hashes, row = word_hashes(LOWER[data], offsets)
    shingles, at = window_hashes(hashes, row, WIDTH)
    own = row[at]
    count = np.bincount(row, minlength=n)
    first = np.searchsorted(row, np.arange(n))
    short = np.flatnonzero((count > 0) & (count < WIDTH))
    if len(short):
        whole = np.full(len(short), 1, np.uint64)
        for k in range(WIDTH - 1):
            live = count[short] > k
            whole[live] = mix(whole[live] * np.uint64(0x9E3779B97F4A7C15) ^ hashes[first[short[live]] + k])
        shingles, own = np.concatenate([shingles, whole]), np.concatenate([own, short])
    order = np.lexsort((shingles, own))
    shingles, own = shingles[order], own[order]
    fresh = np.append(True, (shingles[1:] != shingles[:-1]) | (own[1:] != own[:-1])) if len(own) else np.zeros(0, bool)
    shingles, own = shingles[fresh], own[fresh]
    return shingles, np.searchsorted(own, np.arange(n + 1))


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n (set size), x and y (128-bit digest of the set), sketch (smallest hashes, ascending)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(1)):
                sets, bounds = shingle_sets(data, offsets)
                size = np.diff(bounds)
                digest = np.frombuffer(b"".join(
                    hashlib.blake2b(sets[a:b].tobytes(), digest_size=16).digest() for a, b in zip(bounds, bounds[1:])),
                    dtype="<i8").reshape(-1, 2)
                held = np.minimum(size, SKETCH)
                ends = np.concatenate([[0], np.cumsum(held)])
                at = np.arange(ends[-1]) - np.repeat(ends[:-1] - bounds[:-1], held)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(size.astype(np.int64)),
                     pa.array(np.ascontiguousarray(digest[:, 0])), pa.array(np.ascontiguousarray(digest[:, 1])),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(signed(sets[at])))],
                    ["id", "n", "x", "y", "sketch"])

    return rows.mapInArrow(run, "id long, n long, x long, y long, sketch array<long>")


def full_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n, full (the whole set, ascending) of the documents in ``ids``."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(1)):
                sets, bounds = shingle_sets(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(bounds).astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(signed(sets)))], ["id", "n", "full"])

    return rows.where(likely_in(ids)(F.col("id"))).join(ids, "id", "left_semi").mapInArrow(run, "id long, n long, full array<long>")


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat unsigned values and bounds of a list column."""
    flat = column.flatten().to_numpy().view(np.uint64)
    return flat, column.offsets.to_numpy() - column.offsets[0].as_py()


def _estimate_passes(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether the union sketch of two sketches lets the similarity reach the threshold."""
    x, x_at = _values(a)
    y, y_at = _values(b)
    out = np.zeros(len(a), dtype=bool)
    for k in range(len(a)):
        p, q = x[x_at[k]:x_at[k + 1]], y[y_at[k]:y_at[k + 1]]
        union, counts = np.unique(np.concatenate([p, q]), return_counts=True)
        if len(p) < SKETCH and len(q) < SKETCH:        # both are whole sets: no estimate
            out[k] = 100 * (counts == 2).sum() >= PERCENT * len(union)
        else:
            out[k] = (counts[:SKETCH] == 2).sum() >= LEAST_SHARED
    return pa.array(out)


def _intersections(a: pa.Array, b: pa.Array) -> pa.Array:
    x, x_at = _values(a)
    y, y_at = _values(b)
    return pa.array([len(np.intersect1d(x[x_at[k]:x_at[k + 1]], y[y_at[k]:y_at[k + 1]], assume_unique=True))
                     for k in range(len(a))], pa.int64())


def _with_both(pairs: DataFrame, of: DataFrame, column: str) -> DataFrame:
    """a, b and the column of ``of`` (id, column) for both."""
    left = pairs.join(of.select(F.col("id").alias("b"), F.col(column).alias("of_b")), "b")
    return left.join(of.select(F.col("id").alias("a"), F.col(column).alias("of_a")), "a")


def _measured(pairs: DataFrame, sketches: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, both (size of the intersection), linked of the pairs that the estimate lets through."""
    passes = F.arrow_udf(_estimate_passes, "boolean").asNondeterministic()
    both = F.arrow_udf(_intersections, "long").asNondeterministic()
    likely = store(_with_both(pairs, sketches, "sketch").where(passes("of_a", "of_b")).select("a", "b"), "near-likely")
    full = _with_both(likely, sets, "full")
    union = F.size("of_a") + F.size("of_b") - F.col("both")
    return store(full.withColumn("both", both("of_a", "of_b"))
                 .select("a", "b", "both", (100 * F.col("both") >= PERCENT * union).alias("linked")), "near-measured")


def near_links(docs: DataFrame, marks: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """node, root: components of the class representatives that have a near duplicate of another set.
    ``marks`` holds one row (id, n, sketch) per class."""
    values = marks.where("n > 0").select("id", "n", F.explode("sketch").alias("v"))
    shared = values.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    need = F.when(F.col("n") * 4 <= 3 * SKETCH, F.floor((3 * F.col("n") + 3) / 4)).otherwise(F.lit(LEAST_SHARED))
    per = (values.join(shared, "v").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("vs"))
           .withColumn("spare", F.size("vs") - need + 1).where("spare > 0")
           .withColumn("central", F.aggregate("vs", F.lit(0.0), lambda w, e: w + F.log2(e["df"]))))
    per = per.withColumn("own", F.transform(F.slice("vs", F.lit(1), F.greatest(F.lit(0), F.col("spare").cast("int"))), lambda e: e["v"]))
    listed = store(per.where(F.size("own") > 0).select("id", "n", "central", "own"), "near-listed")
    ids = listed.select("id").distinct()
    sets = store(full_sets(docs, ids, id_col, text_col).dropDuplicates(["id", "n"]), "near-sets")
    listed = store(listed.join(_elsewhere(sets), "id"), "near-listed")
    ids = listed.select("id").distinct()
    sketches = store(marks.select("id", "sketch").join(ids, "id", "left_semi"), "near-sketches")

    tested: DataFrame | None = None
    links: DataFrame | None = None
    none = F.lit(None).cast("long")
    now = listed.select("id", "n", "central", "m", F.explode("own").alias("v"), none.alias("p"), F.col("id").alias("c"),
                        none.alias("main"))                                                 # open lists
    order = Window.partitionBy("v").orderBy(F.col("central").desc(), "id")
    before, leads, found = 0, 1, None
    while True:
        outside = now.where(F.col("main").isNull() | (F.col("c") != F.col("main")))
        lead = (now.withColumn("place", F.row_number().over(order)).where(F.col("place") <= leads).where(F.col("place") > before)
                .select("v", *[F.col(x).alias(f"{x}_a") for x in CARRIED]))
        if leads > 1:
            outside, lead = _with_lists(outside, "id"), _with_lists(lead, "id_a")
        pairs = store(_pairs(outside, lead, tested), "near-stars")
        measured = _measured(pairs, sketches, sets)
        own = measured.where("linked").select("a", "b")
        links = own if links is None else links.unionByName(own)
        tested = pairs if tested is None else tested.unionByName(pairs)
        if leads == 1:
            listed = _with_pivot(now, lead, measured)
        more = now.groupBy("v").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > leads + int(leads == 1)).select("v")
        fresh = found is None or not own.isEmpty()
        if fresh:
            found = components(links)
            now = _open(listed, found, more)
        else:                                               # same components: only exhausted lists go
            now = store(now.join(more, "v", "left_semi"), "near-open")
        if now.isEmpty():
            return found
        before, leads = leads, leads * (LEADS if fresh else LEADS ** 2)


CARRIED = ("id", "n", "m", "c", "p")


def _with_pivot(lists: DataFrame, lead: DataFrame, measured: DataFrame) -> DataFrame:
    """One row a document with its lists (v, p); p, the size of its intersection with the list's lead, where it was
    measured."""
    led = lists.drop("p").join(lead.select("v", "id_a"), "v")
    led = led.withColumn("a", F.least("id", "id_a")).withColumn("b", F.greatest("id", "id_a"))
    return store(led.join(measured.select("a", "b", "both"), ["a", "b"], "left").groupBy("id", "n", "central", "m")
                 .agg(F.collect_list(F.struct("v", F.col("both").alias("p"))).alias("held")), "near-lists")


def _with_lists(rows: DataFrame, id_col: str) -> DataFrame:
    """``rows`` with the lists ``in_<id>`` that hold a document among them, at most as many as its retained values."""
    lists = rows.groupBy(id_col).agg(F.array_sort(F.collect_set("v")).alias(f"in_{id_col}"))
    return rows.join(lists, id_col)


def _pairs(lists: DataFrame, leads: DataFrame, tested: DataFrame | None) -> DataFrame:
    """a, b: the leads of each list with its documents of other components, but those that can't be linked.
    With their lists (``_with_lists``) a document and a lead meet in the first list that they share only.

    An intersection i of sets of sizes n and n_a needs (100 + P) * i >= P * (n + n_a).  It is at most the
    smaller of the sets, and of m, their shingles that other candidates have too.  What both have in common
    with a third document, the list's lead, is at most the smaller p; what they share beside it is at most the
    smaller rest m - p."""
    most = F.least("n", "n_a", "m", "m_a")
    beside = F.least("p", "p_a") + F.least(F.col("m") - F.col("p"), F.col("m_a") - F.col("p_a"))
    most = F.when(F.col("p").isNull() | F.col("p_a").isNull(), most).otherwise(F.least(most, beside))
    fits = (100 + PERCENT) * most >= PERCENT * (F.col("n") + F.col("n_a"))
    fits = (F.col("c") != F.col("c_a")) & fits
    if "in_id" in lists.columns:
        fits = fits & (F.col("v") == F.array_min(F.array_intersect("in_id", "in_id_a")))
    made = lists.join(leads, "v").where(fits)
    pairs = (made.select(F.least("id_a", "id").alias("a"), F.greatest("id_a", "id").alias("b")).distinct())
    return pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")


def _elsewhere(sets: DataFrame) -> DataFrame:
    """id, m: how many shingles of a candidate's whole set other candidates have too (an upper bound of every
    intersection), of the candidates for which that can be enough."""
    values = sets.select("id", "n", F.explode("full").alias("v"))
    shared = values.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("v")
    return (values.join(shared, "v").groupBy("id", "n").agg(F.count(F.lit(1)).alias("m"))
            .where(100 * F.col("m") >= PERCENT * F.col("n")).select("id", "m"))


def _open(listed: DataFrame, found: DataFrame, more: DataFrame) -> DataFrame:
    """The lists of ``more`` that hold several components, a row for each document with its component ``c`` and the
    list's largest, ``main``.  Components are joined to documents, before these are spread over their lists."""
    placed = listed.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("c", F.coalesce("root", "id"))
    whole = placed.select("id", "n", "central", "m", "c", F.inline("held")).join(more, "v", "left_semi")
    parts = whole.groupBy("v", "c").agg(F.count(F.lit(1)).alias("rows"))
    main = (parts.groupBy("v").agg(F.max(F.struct("rows", "c")).alias("top"), F.count(F.lit(1)).alias("parts"))
            .where("parts > 1").select("v", F.col("top.c").alias("main")))
    return store(whole.join(main, "v"), "near-open")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable over confirmed links) of every row."""
    marks = store(signatures(docs, id_col, text_col), "near-marks")
    classes = store(marks.where("n > 0 AND id IS NOT NULL").groupBy("x", "y").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "near-classes")
    reps = marks.join(classes.select("x", "y", F.col("rep").alias("id")), ["id", "x", "y"], "left_semi")
    found = near_links(docs, store(reps.select("id", "n", "sketch").dropDuplicates(["id", "n"]), "near-reps"), id_col, text_col)
    member = (marks.select("id", "n", "x", "y").join(classes.where("copies > 1").select("x", "y", "rep"), ["x", "y"], "left")
              .withColumn("rep", F.coalesce(F.when(F.col("id").isNotNull(), F.col("rep")), F.col("id"))))
    placed = member.join(found, F.col("rep") == F.col("node"), "left")
    return placed.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                         F.coalesce("root", "rep").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row per component, that of the smallest id; same columns."""
    gone = (near_duplicates(docs, id_col, text_col).where(F.col("doc_id") != F.col("component_id"))
            .select(F.col("doc_id").alias("_gone")).distinct())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(id_col).cast("long").alias("_id"))
    return rows.join(gone, F.col("_id") == F.col("_gone"), "left_anti").select("row.*")

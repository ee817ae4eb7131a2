"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is two aggregates with partial minima and two equi-joins, so a hub with a large share of
all links is pre-aggregated and its join side is split; the links of a step are written to the shared
folder.  Only two numbers a step reach the driver.  As soon as a step leaves ``ONE_TASK`` links or fewer
(counted, 16 bytes each), one task settles them: the roots are the same, without further steps.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import store

MAX_STEPS = 60
ONE_TASK = 200_000          # links that one task settles: 3 MB


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hang = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hang.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b")


def _settled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, root of all links that the task reads."""
    held = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches if b.num_rows]
    if not held:
        return
    a, b = (np.concatenate(part) for part in zip(*held))
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while (root[a] != root[b]).any():
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a].copy(), least)
        np.minimum.at(root, root[b].copy(), least)
        while (root[root] != root).any():
            root = root[root]
    below = np.flatnonzero(root != np.arange(len(nodes)))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[below]), pa.array(nodes[root[below]])], ["node", "root"])


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) of every node but the roots themselves;
    ``links`` has long columns a, b."""
    now = store(links.where("a <> b").distinct(), "links")
    before = None
    for _ in range(MAX_STEPS):
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        if state[0] <= ONE_TASK:
            return store(now.select("a", "b").coalesce(1).mapInArrow(_settled, "node long, root long"), "settled")
        before = state
        now = store(_small_star(_large_star(now).distinct()).distinct(), "links")
    raise RuntimeError(f"components not settled after {MAX_STEPS} steps")

"""Windows of a request stream as mergeable panes in an append-only table: early results, late rows, final flush.

Each micro-batch adds the panes of its own requests as one committed write (``sources.commits``), besides a
side output of its late rows; the commit notes the latest event time seen.  The watermark of a batch is the
latest event time of the batches before it less ``delay_seconds``; a row is late if the window it falls
into had ended by then, as in Spark's own watermarks.  Late rows change no window; they are kept and counted.

A reader merges what is committed.  A window has a row from its first request on (an early result, which later
batches raise) and is ``closed`` once the watermark has passed its end; nothing is withheld, so at the end of
an ``availableNow`` run all windows are there, the open ones included.  A batch that is run again after a failure
finds its commit.  ``compact`` folds the commits of a table into one, so the number of folders stays bounded.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.operators.panes import count_panes, merged_panes
from ratewise.sources import commits
from ratewise.streaming.drain import query_id
from ratewise.streaming.progress import beside, run_batches, written

FOLDED = "folded"           # writer of compacted tables
KEEP = 2                    # compacted tables whose folders stay, for readers under way


def live_commits(spark: SparkSession, table: str) -> list[commits.Commit]:
    """The commits a reader merges: the newest compacted table and what came after it."""
    made = commits.committed(spark, table)
    folded = [c for c in made if c.writer == FOLDED]
    if not folded:
        return made
    last = max(folded, key=lambda c: c.number)
    inside = {(w, n) for w, n in last.note["holds"]}
    return [last] + [c for c in made if c.writer != FOLDED and (c.writer, c.number) not in inside]


def seen_until(made: list[commits.Commit]) -> int | None:
    """Latest event time (microseconds) noted."""
    return max((c.note["latest"] for c in made if c.note["latest"] is not None), default=None)


def run_panes(spark: SparkSession, stream: DataFrame, table: str, seconds: int, keys: Sequence[str], delay_seconds: int = 600,
              ts_col: str = "ts", checkpoint: str | None = None,
              panes_of: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Add all available input to the table; rows of the input that were not late.

    ``panes_of``: the panes of a batch; by default counts per key and window of ``seconds``."""
    progress = checkpoint or beside(table, "progress")
    make = panes_of or (lambda rows: count_panes(rows, keys, ts_col, seconds))

    def one(frame: DataFrame, epoch: int) -> int:
        writer = f"panes-{query_id(spark, progress)}"
        if commits.find_commit(spark, table, writer, epoch) is not None:
            return 0
        until = seen_until(live_commits(spark, table))
        micros = F.unix_micros(F.col(ts_col).cast("timestamp"))
        ends = (F.floor(micros / (seconds * 1_000_000)) + 1) * (seconds * 1_000_000)
        late = F.lit(False) if until is None else F.coalesce(ends <= until - delay_seconds * 1_000_000, F.lit(False))
        tagged = frame.where(F.col(ts_col).isNotNull()).withColumn("_late", late)
        latest, rows, behind = tagged.agg(F.max(micros), F.count(F.lit(1)), F.count_if("_late")).first()

        def write(folder: str) -> int:
            if behind:
                tagged.where("_late").drop("_late").write.parquet(f"{folder}/late")
            return written(make(tagged.where("NOT _late").drop("_late")), lambda f: f.write.parquet(f"{folder}/panes"))

        commits.write_once(spark, table, writer, epoch, write, {"latest": latest, "late": behind})
        return rows - behind

    return run_batches(stream, progress, one)


def read_panes(spark: SparkSession, table: str, keys: Sequence[str], sums: Sequence[str] = ("requests",)) -> DataFrame | None:
    """One row per key and pane over all commits; None before the first one."""
    paths = [f"{table.rstrip('/')}/{c.folder}/panes" for c in live_commits(spark, table) if c.rows]
    return merged_panes(spark.read.parquet(*paths), keys, sums) if paths else None


def read_windows(spark: SparkSession, table: str, seconds: int, keys: Sequence[str], delay_seconds: int = 600) -> DataFrame | None:
    """window_start, window_end, keys, requests, rate_per_s, closed (the watermark has passed the end)."""
    panes = read_panes(spark, table, keys)
    if panes is None:
        return None
    until = seen_until(live_commits(spark, table))
    end = (F.col("pane") + 1) * seconds
    return panes.select(
        F.timestamp_seconds(F.col("pane") * seconds).cast("timestamp_ntz").alias("window_start"),
        F.timestamp_seconds(end).cast("timestamp_ntz").alias("window_end"), *keys, "requests",
        (F.col("requests") / F.lit(float(seconds))).alias("rate_per_s"),
        (end * 1_000_000 <= F.lit(until - delay_seconds * 1_000_000)).alias("closed"))


def read_late(spark: SparkSession, table: str) -> DataFrame | None:
    """The late rows, as they came; None if there were none."""
    paths = [f"{table.rstrip('/')}/{c.folder}/late" for c in commits.committed(spark, table)
             if c.writer != FOLDED and c.note["late"]]
    return spark.read.parquet(*paths) if paths else None


def late_count(spark: SparkSession, table: str) -> int:
    return sum(c.note["late"] for c in commits.committed(spark, table) if c.writer != FOLDED)


def compact(spark: SparkSession, table: str, keys: Sequence[str], sums: Sequence[str] = ("requests",)) -> None:
    """Fold all commits into one table, and delete the panes of those that older folded tables held already.

    The commit files stay: they say which batches are done.  Readers under way keep the folders of the newest ``KEEP``."""
    live = live_commits(spark, table)
    folded = sorted((c for c in commits.committed(spark, table) if c.writer == FOLDED), key=lambda c: c.number)
    if not live or live == folded[-1:]:
        return
    holds = sorted({(c.writer, c.number) for c in live if c.writer != FOLDED} | {tuple(h) for c in folded[-1:] for h in c.note["holds"]})
    panes = read_panes(spark, table, keys, sums)

    def write(folder: str) -> int:
        return 0 if panes is None else written(panes, lambda f: f.write.parquet(f"{folder}/panes"))

    number = folded[-1].number + 1 if folded else 0
    commits.write_once(spark, table, FOLDED, number, write,
                       {"latest": seen_until(live), "late": 0, "holds": json.loads(json.dumps(holds))})
    gone = [c.folder for c in folded[:-KEEP + 1]]
    if folded:
        inside = {tuple(h) for h in folded[-1].note["holds"]}
        gone += [c.folder for c in commits.committed(spark, table) if c.writer != FOLDED and (c.writer, c.number) in inside]
    for folder in gone:
        files, target = commits.file_system(spark, f"{table.rstrip('/')}/{folder}/panes")
        files.delete(target, True)

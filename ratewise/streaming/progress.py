"""Counts and checkpoints of bounded streaming runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


class RowCounter(StreamingQueryListener):
    """Adds up the input rows of every micro-batch of one query (``recentProgress`` forgets old ones)."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        key = str(event.progress.runId)
        self.rows[key] = self.rows.get(key, 0) + int(event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def beside(path: str, what: str) -> str:
    """A folder next to an output path, on the same storage: found again by the next run."""
    return f"{path.rstrip('/')}.{what}"


def run_batches(stream: DataFrame, checkpoint: str, batch, mode: str = "append") -> int:
    """Run ``batch(frame, epoch)`` over all available input and stop; returns what the batches returned,
    added up over every micro-batch of this run."""
    counts: list[int] = []

    def one(frame: DataFrame, epoch: int) -> None:
        counts.append(int(batch(frame, epoch) or 0))

    query = (stream.writeStream.outputMode(mode).foreachBatch(one)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return sum(counts)


def written(frame: DataFrame, write) -> int:
    """Rows that ``write(frame)`` writes, observed by the writing job itself."""
    from pyspark.sql import Observation

    seen = Observation("written")
    write(frame.observe(seen, F.count(F.lit(1)).alias("rows")))
    return int(seen.get.get("rows", 0))

"""A topic of numbered partitions on shared storage, as a stream source with offsets per partition.

``publish`` appends records: each goes to the partition of its key's hash and gets the next offset there.  An
append is one committed write (see ``commits``): a folder with a sub-folder per partition, and a commit that notes
the first offset and the number of records of each.  Appends are numbered; two publishers that pick one number
meet at the commit file, the loser takes the next number and the offsets that follow.

``TopicSource`` (format ``numbered_topic``) reads a topic as a Python data source: columns ``partition``, ``offset``,
``key``, ``value``.  Its offsets are a number per partition, so a query's progress, a stored position and a replay from it
mean the same on any cluster.  Options:

* ``path``: the topic;
* ``starting``: JSON of partition -> first offset wanted; earliest by default;
* ``limit``: most records a partition admits to one micro-batch, beyond ``admitted`` (JSON of partition -> offset
  reached so far).

Tasks read their slice of an append's lines by the offsets in them; one slice is one file's lines in memory at a time.
Data are read with pyarrow's file systems, which know local, HDFS and object-store paths.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ratewise.operators.ranking import rank_within
from ratewise.sources import commits

SCHEMA = "partition int, offset long, key string, value string"
PUBLISHER = "append"


def _ends(made: list[commits.Commit]) -> dict[int, int]:
    ends: dict[int, int] = {}
    for c in made:
        for p, (first, count) in c.note["ranges"].items():
            ends[int(p)] = max(ends.get(int(p), 0), first + count)
    return ends


def end_offsets(spark: SparkSession, topic: str) -> dict[int, int]:
    """One past the last offset of each partition that has records."""
    return _ends(commits.committed(spark, topic))


def publish(records: DataFrame, topic: str, partitions: int, key_col: str, value_col: str, order_col: str) -> dict[int, int]:
    """Append records to a topic, in the order of ``order_col`` (unique) within each partition; returns the topic's end offsets.

    Numbers within a partition come from ``rank_within``, so a partition of any size is split over tasks."""
    spark = records.sparkSession
    dealt = records.select(F.pmod(F.xxhash64(F.col(key_col).cast("string")), F.lit(partitions)).cast("int").alias("partition"),
                           F.col(key_col).cast("string").alias("key"), F.col(value_col).cast("string").alias("value"),
                           F.col(order_col).alias("_order"))
    ranked = rank_within(dealt, ["partition"], ["_order"], rank_col="_rank", size_col=None)
    counts = {r["partition"]: r["n"] for r in ranked.groupBy("partition").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return end_offsets(spark, topic)
    while True:
        made = commits.committed(spark, topic)
        ends, number = _ends(made), max((c.number for c in made), default=-1) + 1
        ranges = {str(p): [ends.get(p, 0), n] for p, n in counts.items()}
        base = F.create_map(*[F.lit(x) for p in counts for x in (p, ends.get(p, 0))])
        lines = ranked.select("partition", F.to_json(F.struct(
            (base[F.col("partition")] + F.col("_rank") - 1).cast("long").alias("offset"), "key", "value")).alias("line"))
        attempt = uuid.uuid4().hex

        def write(folder: str) -> int:
            lines.write.partitionBy("partition").text(folder)
            return sum(counts.values())

        done = commits.write_once(spark, topic, PUBLISHER, number, write, {"ranges": ranges, "attempt": attempt})
        if done.note["attempt"] == attempt:
            return end_offsets(spark, topic)


@dataclass
class Slice(InputPartition):
    """Offsets [first, last) of a partition, inside one append's folder."""

    folder: str
    number: int
    first: int
    last: int


def _load(options: dict) -> list[commits.Commit]:
    spark = SparkSession.getActiveSession()
    if spark is None:               # the planner of a Python data source runs in a process without a session
        return [commits.Commit(**c) for c in _list_commits(options["path"])]
    return commits.committed(spark, options["path"])


def _list_commits(topic: str) -> list[dict]:
    from pyarrow import fs

    files, root = fs.FileSystem.from_uri(_uri(topic))
    folder = f"{root.rstrip('/')}/{commits.COMMITS}"
    if files.get_file_info(folder).type == fs.FileType.NotFound:
        return []
    out = []
    for info in files.get_file_info(fs.FileSelector(folder)):
        if info.base_name.endswith(".json") and not info.base_name.startswith("."):
            with files.open_input_stream(info.path) as stream:
                out.append(json.loads(stream.read()))
    return sorted(out, key=lambda c: c["number"])


def _uri(path: str) -> str:
    return path if "://" in path else f"file://{path.removeprefix('file:')}"


def _slices(topic: str, made: list[commits.Commit], start: dict[int, int], end: dict[int, int]) -> list[Slice]:
    out = []
    for c in made:
        for p, (first, count) in c.note["ranges"].items():
            p = int(p)
            lo, hi = max(first, start.get(p, 0)), min(first + count, end.get(p, 0))
            if lo < hi:
                out.append(Slice(f"{topic.rstrip('/')}/{c.folder}/partition={p}", p, lo, hi))
    return out


def _records(part: Slice) -> Iterator[tuple]:
    from pyarrow import fs

    files, folder = fs.FileSystem.from_uri(_uri(part.folder))
    for info in sorted(files.get_file_info(fs.FileSelector(folder)), key=lambda f: f.path):
        if info.is_file and not info.base_name.startswith(("_", ".")):
            with files.open_input_stream(info.path) as stream:
                for line in stream.read().decode().splitlines():
                    r = json.loads(line)
                    if part.first <= r["offset"] < part.last:
                        yield part.number, r["offset"], r.get("key"), r.get("value")


def _numbers(text: str | None) -> dict[int, int]:
    return {int(p): int(k) for p, k in json.loads(text or "{}").items()}


def _admitted(options: dict, ends: dict[int, int]) -> dict[int, int]:
    limit = int(options.get("limit", 0))
    if not limit:
        return ends
    reached = _numbers(options.get("admitted"))
    return {p: min(e, reached.get(p, 0) + limit) for p, e in ends.items()}


class TopicStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = options

    def initialOffset(self) -> dict:
        return {str(p): k for p, k in _numbers(self.options.get("starting")).items()}

    def latestOffset(self) -> dict:
        return {str(p): k for p, k in sorted(_admitted(self.options, _ends(_load(self.options))).items())}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        return _slices(self.options["path"], _load(self.options), {int(p): k for p, k in start.items()},
                       {int(p): k for p, k in end.items()})

    def read(self, partition: Slice) -> Iterator[tuple]:
        return _records(partition)

    def commit(self, end: dict) -> None:
        """Nothing to let go: the topic keeps its records."""


class TopicBatch(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Slice]:
        made = _load(self.options)
        return _slices(self.options["path"], made, _numbers(self.options.get("starting")), _ends(made))

    def read(self, partition: Slice | None) -> Iterator[tuple]:
        return _records(partition) if partition is not None else iter(())


class TopicSource(DataSource):
    """Streaming and batch reads of a topic."""

    @classmethod
    def name(cls) -> str:
        return "numbered_topic"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TopicBatch:
        return TopicBatch(self.options)

    def streamReader(self, schema) -> TopicStream:
        return TopicStream(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to the session; the package must be shipped to the workers."""
    spark.dataSource.register(TopicSource)


def read_topic(spark: SparkSession, topic: str, starting: dict[int, int] | None = None) -> DataFrame:
    """All records of a topic from the given offsets on (earliest by default)."""
    register(spark)
    return spark.read.format("numbered_topic").option("path", topic).option("starting", json.dumps(starting or {})).load()

"""Bounded drain of the recommendation-event stream into the JSON-lines log.

``trigger(availableNow=True)`` reads everything that is on the source when
the query starts, in as many micro-batches as needed, and stops.  Lines go to
the log as they are; they are parsed when the log is read.  A line that is no
JSON object goes to the quarantine log beside it instead, and both numbers
are returned.  Progress lives in a checkpoint folder that is derived from the
log's path (same storage), so a second run, also of another session, adds
only what is new.

The log is append-only (``sources.commits``): a micro-batch is one write of the
writer ``drain-<query id>``, numbered as the batch.  A batch that is run again
after a failure finds its commit, or writes a new folder; drains with several
checkpoints, and one whose progress folder was lost (its query gets a new id
and reads the source from the start), add to the log and never replace what is there.

``drain_topic`` reads a topic of numbered partitions (``sources.topic``).  Its
commits note the offsets they end at, so the log itself knows how far it has
come: records are taken once, whatever becomes of the progress folder, and
also if two drains run at the same time.

The source of ``drain`` is a format name plus options: ``kafka`` (topic, bootstrap
servers; needs the Kafka connector on the classpath) or a file source such
as ``text`` over a folder of JSON lines (used in tests).
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions.json import well_formed
from ratewise.schemas import EVENT
from ratewise.sources import commits, topic as topics
from ratewise.streaming.progress import beside, run_batches, written


def raw_lines(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
              options: dict[str, str] | None = None) -> DataFrame:
    """Streaming frame of the source's lines, one text column ``value``."""
    reader = spark.readStream.format(fmt)
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "earliest")
    for k, v in opts.items():
        reader = reader.option(k, v)
    raw = reader.load(path) if path else reader.load()
    return raw.select(F.col("value").cast("string").alias("value"))


def event_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                 options: dict[str, str] | None = None) -> DataFrame:
    """Streaming frame of typed events from a topic (``value``) or a text-file folder."""
    lines = raw_lines(spark, fmt, path, options).where(well_formed("value"))
    parsed = lines.select(F.from_json("value", EVENT).alias("e")).select("e.*")
    return parsed.withColumn("movie_ids", F.coalesce("movie_ids", F.array().cast("array<bigint>")))


@dataclass(frozen=True)
class Drained:
    """Lines appended to the log and lines put into quarantine by one run."""

    appended: int
    quarantined: int


def _write_lines(frame: DataFrame):
    """What ``commits.write_once`` runs for the lines of a frame."""
    return lambda folder: written(frame.select("value"), lambda f: f.write.text(folder))


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity of the query that owns a checkpoint folder; it lasts as long as the folder."""
    return json.loads(commits.read_small(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def drain(spark: SparkSession, log_path: str, fmt: str = "kafka", path: str | None = None,
          options: dict[str, str] | None = None, checkpoint: str | None = None) -> Drained:
    """Append every available line to ``log_path``; lines that are no JSON object to ``<log_path>.bad``."""
    progress, bad = checkpoint or beside(log_path, "progress"), []

    def one(frame: DataFrame, epoch: int) -> int:
        tagged = frame.withColumn("ok", well_formed("value"))
        writer = f"drain-{query_id(spark, progress)}"
        bad.append(commits.write_once(spark, beside(log_path, "bad"), writer, epoch, _write_lines(tagged.where(~F.col("ok")))).rows)
        return commits.write_once(spark, log_path, writer, epoch, _write_lines(tagged.where("ok"))).rows

    appended = run_batches(raw_lines(spark, fmt, path, options), progress, one)
    return Drained(appended, sum(bad))


def _topic_writer(topic: str) -> str:
    return "topic-" + hashlib.sha256(topic.rstrip("/").encode()).hexdigest()[:16]


def reached_offsets(spark: SparkSession, log_path: str, topic: str) -> dict[int, int]:
    """One past the last offset of each partition of a topic that the log holds."""
    reached: dict[int, int] = {}
    for c in commits.committed(spark, log_path):
        if c.writer == _topic_writer(topic):
            for p, end in c.note["ends"].items():
                reached[int(p)] = max(reached.get(int(p), 0), end)
    return reached


def _append_new(spark: SparkSession, log_path: str, topic: str, frame: DataFrame) -> tuple[int, int]:
    """Commit the records of a micro-batch that the log has not got yet: rows appended, rows put into quarantine."""
    attempt = uuid.uuid4().hex
    while True:
        made = [c for c in commits.committed(spark, log_path) if c.writer == _topic_writer(topic)]
        reached = reached_offsets(spark, log_path, topic)
        known = F.create_map(*[F.lit(x) for item in reached.items() for x in item]) if reached else None
        new = frame if known is None else frame.where(F.col("offset") >= F.coalesce(known[F.col("partition")], F.lit(0)))
        ends = {str(r["partition"]): r["end"] for r in
                new.groupBy("partition").agg((F.max("offset") + 1).alias("end")).collect()}     # a row per partition
        if not ends:
            return 0, 0
        tagged = new.withColumn("ok", well_formed("value"))
        number = len(made)
        bad = commits.write_once(spark, beside(log_path, "bad"), f"{_topic_writer(topic)}-{attempt}", number,
                                 _write_lines(tagged.where(~F.col("ok"))))
        own = commits.write_once(spark, log_path, _topic_writer(topic), number, _write_lines(tagged.where("ok")),
                                 {"ends": ends, "attempt": attempt, "bad": bad.folder})
        if own.note["attempt"] == attempt:
            return own.rows, bad.rows
        # another drain was first: see what is left to do after its commit


def drain_topic(spark: SparkSession, log_path: str, topic: str, limit: int | None = None,
                checkpoint: str | None = None, starting: dict[int, int] | None = None) -> Drained:
    """Append every record of a topic that the log has not got, in micro-batches of at most ``limit`` records a partition.

    Lines that are no JSON object go to ``<log_path>.bad``; of several drains that run at the same time each record is
    committed by one (the quarantine may hold a line of a lost race twice)."""
    topics.register(spark)
    total, bad = 0, 0
    while True:
        reached = {**(starting or {}), **reached_offsets(spark, log_path, topic)}
        end = topics.end_offsets(spark, topic)
        if all(reached.get(p, 0) >= e for p, e in end.items()):
            return Drained(total, bad)
        options = {"path": topic, "starting": json.dumps(reached), "admitted": json.dumps(reached), "limit": str(limit or 0)}
        stream = spark.readStream.format("numbered_topic").options(**options).load()
        quarantined: list[int] = []

        def one(frame: DataFrame, epoch: int) -> int:
            appended, lost = _append_new(spark, log_path, topic, frame)
            quarantined.append(lost)
            return appended

        total += run_batches(stream, checkpoint or beside(log_path, "progress"), one)
        bad += sum(quarantined)

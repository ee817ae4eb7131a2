"""Append-only tables of text lines: data folders that no name is ever given twice, made visible by commit files.

Layout of a log::

    <log>/data/<writer>-<number>-<random>/part-*      lines, one folder per write attempt
    <log>/_commits/<writer>.<number>.json              one file per finished write: its folder and what it holds

A writer (a streaming query, a publisher) numbers its writes.  A write goes to a folder of its own; then the
commit file is created, which the file system does once only.  A write that is repeated finds its commit and
does nothing; an attempt that died leaves a folder that no commit names, so no reader looks at it.  Nothing is
overwritten and nothing is renamed, so writers need not know of each other: the log of two streaming queries,
or of one that lost its checkpoint and got a new identity, holds what both of them wrote.

Readers list the commits and read the folders they name, besides the plain files that ``append_events`` puts
into the log's top folder.  All file access goes through the cluster's own file system.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

DATA, COMMITS = "data", "_commits"
NUMBER_DIGITS = 12


def file_system(spark: SparkSession, path: str):
    """(file system, path) of the cluster for a path."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file, whole or not at all; False if it is there already."""
    jvm = spark.sparkContext._jvm
    files, target = file_system(spark, path)
    files.mkdirs(target.getParent())
    part = jvm.org.apache.hadoop.fs.Path(f"{target.getParent()}/.{target.getName()}.{uuid.uuid4().hex}")
    out = files.create(part, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(part, target, no_options)            # fails if the target exists
        return True
    except Py4JJavaError:
        if not files.exists(target):
            raise
        files.delete(part, False)
        return False


def read_small(spark: SparkSession, path: str) -> str:
    """Content of a small file."""
    files, target = file_system(spark, path)
    stream = files.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


@dataclass(frozen=True)
class Commit:
    """A finished write: the folder it made (relative to the log), its rows, and what else the writer noted."""

    writer: str
    number: int
    folder: str
    rows: int
    note: dict = field(default_factory=dict)


def commit_path(log: str, writer: str, number: int) -> str:
    return f"{log.rstrip('/')}/{COMMITS}/{writer}.{number:0{NUMBER_DIGITS}d}.json"


def committed(spark: SparkSession, log: str) -> list[Commit]:
    """All finished writes of a log, by writer and number."""
    files, folder = file_system(spark, f"{log.rstrip('/')}/{COMMITS}")
    if not files.exists(folder):
        return []
    names = [str(f.getPath().getName()) for f in files.listStatus(folder)]
    if not any(re.fullmatch(r".+\.\d+\.json", n) for n in names):
        return []
    lines = spark.read.text(f"{log.rstrip('/')}/{COMMITS}/*.json").collect()   # one line a write
    return sorted((Commit(**json.loads(r.value)) for r in lines), key=lambda c: (c.writer, c.number))


def find_commit(spark: SparkSession, log: str, writer: str, number: int) -> Commit | None:
    path = commit_path(log, writer, number)
    files, target = file_system(spark, path)
    return Commit(**json.loads(read_small(spark, path))) if files.exists(target) else None


def write_once(spark: SparkSession, log: str, writer: str, number: int, write, note: dict | None = None) -> Commit:
    """Run ``write(folder) -> rows`` into a new folder and commit it, unless this write was committed before.

    ``note`` is kept with the commit; it must not depend on the attempt."""
    if not re.fullmatch(r"[A-Za-z0-9_-]+", writer):
        raise ValueError(f"not a writer's name: {writer!r}")
    before = find_commit(spark, log, writer, number)
    if before is not None:
        return before
    folder = f"{DATA}/{writer}-{number:0{NUMBER_DIGITS}d}-{uuid.uuid4().hex[:12]}"
    made = Commit(writer, number, folder, int(write(f"{log.rstrip('/')}/{folder}")), dict(note or {}))
    create_once(spark, commit_path(log, writer, number), json.dumps(made.__dict__))
    # another attempt of this very write may have been first: its commit is the one that counts
    return find_commit(spark, log, writer, number) or made


def visible_paths(spark: SparkSession, log: str) -> list[str]:
    """What a reader of the log reads: committed folders with rows, and plain files in the top folder."""
    root = log.rstrip("/")
    files, target = file_system(spark, root)
    if any(c in root for c in "*?[{"):
        return [root]
    if not files.exists(target):
        return []
    if not files.getFileStatus(target).isDirectory():
        return [root]
    paths = [f"{root}/{c.folder}" for c in committed(spark, root) if c.rows]
    plain = any(s.isFile() and not str(s.getPath().getName()).startswith(("_", ".")) for s in files.listStatus(target))
    return paths + [root] * plain                           # without partition folders Spark reads the files right below


def read_lines(spark: SparkSession, log: str) -> DataFrame:
    """``value``: the committed lines of a log (none where there is no log)."""
    paths = visible_paths(spark, log)
    return spark.read.text(paths) if paths else spark.createDataFrame([], "value string")

"""Runs table and versioned selection, both append-only, so that trainings may run at the same time.

A training adds its runs as a folder of its own (one file: all its runs appear at once).  A selection is a
small file ``<folder>/<version>.json`` that is created once; the highest version is the current one and the
earlier ones stay as its history.  Promoting reads the current version, then the runs, and creates the next
version; if another training created it first, it looks at the runs again.  So every version rests on runs
read after the version before it, no version is overwritten, and a reader finds a whole selection or the one
before, never none or parts of two.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.sources.commits import create_once, file_system, read_small

VERSION_DIGITS = 12
ATTEMPTS = 100


def append_runs(runs: DataFrame, path: str) -> None:
    """Add the runs of one training (a few rows) to the runs table."""
    runs.coalesce(1).write.parquet(f"{path.rstrip('/')}/training-{uuid.uuid4().hex}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The runs of all trainings, also those stored right below ``path``."""
    return spark.read.option("recursiveFileLookup", True).parquet(path)


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the selections made so far, ascending."""
    files, target = file_system(spark, folder)
    if not files.exists(target):
        return []
    names = [str(f.getPath().getName()) for f in files.listStatus(target)]
    return sorted(int(n[:-5]) for n in names if re.fullmatch(r"\d+\.json", n))


def selection(spark: SparkSession, folder: str, version: int | None = None) -> dict | None:
    """A selection, the current one by default; None before the first."""
    made = versions(spark, folder)
    if not made or version is not None and version not in made:
        return None
    return json.loads(read_small(spark, _file(folder, made[-1] if version is None else version)))


def _file(folder: str, version: int) -> str:
    return f"{folder.rstrip('/')}/{version:0{VERSION_DIGITS}d}.json"


def promote(spark: SparkSession, runs: Callable[[], DataFrame], select: Callable[[DataFrame], DataFrame], folder: str) -> dict | None:
    """Make the run that ``select`` chooses from ``runs()`` the current selection; returns that selection.

    ``runs`` is called anew for every attempt.  The selection holds the run's columns, ``version`` and
    ``previous`` (run_id before).  The run that is current already makes no new version; without any run to
    choose, the selection stays as it is."""
    for _ in range(ATTEMPTS):
        now = selection(spark, folder)
        found = select(runs()).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).first()    # one row or none
        if found is None:
            return now
        run = json.loads(found[0])
        if now and now["run_id"] == run["run_id"]:
            return now
        made = {**run, "version": now["version"] + 1 if now else 1, "previous": now["run_id"] if now else None}
        if create_once(spark, _file(folder, made["version"]), json.dumps(made)):
            return made
    raise RuntimeError(f"no selection after {ATTEMPTS} attempts: {folder} is promoted to all the time")


def history(spark: SparkSession, folder: str, run_schema: str) -> DataFrame:
    """All selections: version, previous and the run's columns; ``run_schema`` names them with their types."""
    schema = f"version int, previous string, {run_schema}"
    if not versions(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{folder.rstrip('/')}/*.json")

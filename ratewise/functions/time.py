"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts: Column | str) -> Column:
    """Timestamp (with or without zone) -> epoch seconds (long); UTC session assumed."""
    return F.unix_seconds(_col(ts).cast("timestamp"))


def year_of_epoch(seconds: Column | str) -> Column:
    """Epoch seconds -> calendar year (UTC when the session zone is UTC)."""
    return F.year(F.timestamp_seconds(_col(seconds)))

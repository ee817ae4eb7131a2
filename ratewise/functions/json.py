"""JSON expressions for the served-recommendation event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_json(*cols: Column | str) -> Column:
    """Struct of the given columns -> compact JSON text."""
    return F.to_json(F.struct(*cols))


def well_formed(value: Column | str) -> Column:
    """The text is one JSON object (any fields: a sparse event is an event)."""
    col = F.col(value) if isinstance(value, str) else value
    read = F.from_json(col, "_corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"})
    return F.coalesce(F.ltrim(col).startswith("{") & read["_corrupt_record"].isNull(), F.lit(False))

"""The size check that stands before every explicit broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A broadcast copy lives in the driver and in every executor.
BROADCAST_BYTES = 256 * 1024 * 1024

_ROW_OVERHEAD = 24
_COLUMN_BYTES = 8


def row_bytes(df: DataFrame) -> Column:
    """Column with the in-memory width of a row: a word per column plus string bytes."""
    fixed = F.lit(_ROW_OVERHEAD + _COLUMN_BYTES * len(df.columns)).cast("bigint")
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    lengths = [F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0)) for name in strings]
    return sum((length + _COLUMN_BYTES for length in lengths), fixed)


def broadcast_limit(df: DataFrame) -> int:
    """Bytes that may be broadcast: the session's ``capplan.broadcastBytes``, 256 MiB where it is unset."""
    return int(df.sparkSession.conf.get("capplan.broadcastBytes", str(BROADCAST_BYTES)))


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """Whether all rows of ``df`` together measure at most ``limit`` bytes (the session's, if not given)."""
    total = df.agg(F.sum(row_bytes(df)).alias("bytes")).first()["bytes"]
    return (total or 0) <= (broadcast_limit(df) if limit is None else limit)

"""Key tables for semi and anti joins with texts, broadcast only while their counted size is small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of fixed-width keys (at most 32 bytes each) that may be broadcast: 32 MB.
BROADCAST_ROWS = 1_000_000


def stored_keys(keys: DataFrame, path: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Write a table of numeric keys and read it back; above ``max_rows`` its join shuffles instead."""
    if any(t not in ("bigint", "int") for _, t in keys.dtypes) or len(keys.columns) > 4:
        raise ValueError("only a few fixed-width numeric columns are bounded by their row count")
    keys.write.parquet(path)
    stored = keys.sparkSession.read.schema(keys.schema).parquet(path)
    return F.broadcast(stored) if stored.count() <= max_rows else stored

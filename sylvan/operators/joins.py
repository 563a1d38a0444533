"""Join helpers: broadcast only behind a measured size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.session import cut_lineage

# Upper bounds on what we are willing to ship to every executor.  Model and
# per-group summary tables are tiny in practice; beyond the bounds we fall back
# to a shuffle join, so correctness never depends on the size.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 128 << 20
#: Below this many rows, strings are not measured.
UNMEASURED_ROWS = 50_000


def materialize_small(df: DataFrame) -> tuple[DataFrame, int]:
    """Checkpoint a (presumably small) derived table and return it with its row count."""
    df = cut_lineage(df)
    return df, df.count()


def _bytes(df: DataFrame) -> int:
    """Fixed-width columns by their width, others measured as text."""
    varying = [c for c, t in df.dtypes if t in ("string", "binary") or t.startswith(("array", "map", "struct"))]
    width = F.lit(8 * (len(df.columns) + 1))
    for c, t in df.dtypes:
        if c in varying:
            width = width + F.coalesce(F.octet_length(F.col(c) if t in ("string", "binary") else F.to_json(F.struct(c))), F.lit(0))
    return df.agg(F.sum(width.cast("long"))).first()[0] or 0


def broadcast_if_small(df: DataFrame, n_rows: int | None, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` when its measured (or proven upper-bound) row count is within the bound, and so are its bytes.

    ``None`` means unknown: no hint, Spark/AQE decide from runtime statistics.
    """
    if n_rows is None or n_rows > max_rows:
        return df
    fixed = all(t in ("int", "bigint", "double", "float", "boolean", "smallint", "tinyint", "date", "timestamp") for _, t in df.dtypes)
    if not fixed and n_rows > UNMEASURED_ROWS and _bytes(df) > max_bytes:
        return df
    return F.broadcast(df)

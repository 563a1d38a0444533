"""Preparation operators (P1-P11, J1-J3, L1): thin, declarative DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def select_existing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep the listed columns that exist, in list order."""
    have = set(df.columns)
    return df.select(*[c for c in cols if c in have])


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a null (or, for floating columns, NaN) in ``subset``."""
    subset = subset or df.columns
    cond = None
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    for c in subset:
        ok = F.col(c).isNotNull()
        if isinstance(types[c], (DoubleType, FloatType)):
            ok = ok & ~F.isnan(c)
        cond = ok if cond is None else cond & ok
    return df.where(cond)


def add_missing_columns(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """P5: add each absent column as a typed null."""
    for c, t in cols.items():
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(t))
    return df


def key_slice(df: DataFrame, key: str, start: int, max_rows: int | None) -> DataFrame:
    """Rows with ``start <= key < start + max_rows`` on an explicit key.

    ``None`` means "to the end"; 0 means no rows.  No global row number is
    invented (that would pull every row into one partition).
    """
    cond = F.col(key) >= F.lit(start)
    if max_rows is not None:
        cond = cond & (F.col(key) < F.lit(start + max_rows))
    return df.where(cond)


def worklist(df: DataFrame, url: str, pending: str, idx: str, name: str | None) -> DataFrame:
    """Rows with a non-empty URL whose ``pending`` column is still null.

    The display name falls back to ``Player {idx+1}``.
    """
    label = F.concat(F.lit("Player "), (F.col(idx) + 1).cast("string"))
    nm = F.coalesce(F.col(name), label) if name and name in df.columns else label
    todo = F.col(url).isNotNull() & (F.col(url) != "") & F.col(pending).isNull()
    return df.where(todo).select(idx, url, nm.alias("name"))


def second_pass_counters(rows: DataFrame, results: DataFrame, key: str, url: str, pending: str, found: list[str]) -> DataFrame:
    """Counters of an enrichment pass, one row.

    A row without a URL or with its ``pending`` column set is skipped; the rest are tasks.  A task with a
    non-empty value in one of ``found`` is a success, one without (or without a result) an error.
    ``results`` holds one row per key."""
    todo = F.col(url).isNotNull() & (F.col(url) != "") & F.col(pending).isNull()
    got = F.lit(False)
    for c in found:
        got = got | (F.coalesce(F.col(f"_r_{c}"), F.lit("")) != "")
    renamed = results.select(F.col(key).alias("_r_key"), *[F.col(c).alias(f"_r_{c}") for c in found])
    flags = rows.join(renamed, F.col(key) == F.col("_r_key"), "left").select(todo.alias("todo"), got.alias("got"))
    return flags.agg(F.count_if("todo").alias("n_tasks"), F.count_if(F.col("todo") & F.col("got")).alias("n_success"),
                     F.count_if(F.col("todo") & ~F.col("got")).alias("n_error"), F.count_if(~F.col("todo")).alias("n_skipped"))


def distinct_first_seen(df: DataFrame, col: str, order_col: str) -> DataFrame:
    """Distinct values with their first-appearance position."""
    return df.groupBy(F.col(col).alias("value")).agg(F.min(order_col).alias("first_seen"))


def skip_seen(new: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Anti join on the key; nulls are removed from the seen set first.

    The seen side is de-duplicated (partial aggregation), so a key repeated a
    billion times in the history becomes one build row.
    """
    seen = seen.select(*keys).dropna().distinct()
    return new.join(seen, keys, "left_anti")


def enrich(base: DataFrame, details: DataFrame, keys: list[str]) -> DataFrame:
    """1:1 left join; a detail value overrides a same-named base column."""
    shared = [c for c in details.columns if c in base.columns and c not in keys]
    b = base.alias("b")
    d = details.alias("d")
    out = b.join(d, keys, "left")
    cols = [F.col(k) for k in keys]
    for c in base.columns:
        if c in keys:
            continue
        cols.append(F.coalesce(F.col(f"d.{c}"), F.col(f"b.{c}")).alias(c) if c in shared else F.col(f"b.{c}"))
    cols += [F.col(f"d.{c}") for c in details.columns if c not in keys and c not in shared]
    return out.select(*cols)


def keyed_update(base: DataFrame, updates: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Set ``cols`` from ``updates`` only where the new value is truthy (non-null, non-empty)."""
    u = updates.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in cols])
    out = base.join(u, keys, "left")
    for c in cols:
        new = F.col(f"_new_{c}")
        truthy = F.nullif(new.cast("string"), F.lit("")) if dict(updates.dtypes)[c] == "string" else new
        out = out.withColumn(c, F.coalesce(truthy, F.col(c))).drop(f"_new_{c}")
    return out


def head(df: DataFrame, key: list[str], n: int = 10) -> DataFrame:
    """L1: first n rows by an explicit key (top-k: partial sort per partition, then merge)."""
    return df.orderBy(*key).limit(n)


def tail(df: DataFrame, key: list[str], n: int = 10) -> DataFrame:
    """L1: last n rows by an explicit key, returned in ascending order."""
    return df.orderBy(*[F.col(k).desc() for k in key]).limit(n).orderBy(*key)

"""Profiling tables behind the reference's plots (A8-A10): correlation matrix,
equal-width histograms, box-plot statistics.  Drawing is not built."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.operators.blocks import gram
from sylvan.operators.joins import broadcast_if_small, materialize_small
from sylvan.operators.quantile import RankIndex


#: Up to this many columns one aggregate holds all pairs; wider tables take the blocked Gram matrix.
WIDE = 30


def correlation_matrix(df: DataFrame, cols: list[str], wide: int = WIDE) -> DataFrame:
    """Pearson r for every ordered pair (i, j), diagonal included, in one pass.

    Nulls are left out pair by pair; r is null where it is undefined (fewer than two rows, a constant column) and
    NaN where a row of the pair is NaN.
    """
    if len(cols) > wide:
        return _wide_correlation(df, cols)
    # corr divides by the deviations, which ANSI mode rejects for a constant column
    corr = lambda a, b: F.when(
        (F.regr_sxx(a, b) > 0) & (F.regr_syy(a, b) > 0), F.regr_sxy(a, b) / F.sqrt(F.regr_sxx(a, b) * F.regr_syy(a, b)))
    aggs = [corr(a, b).alias(f"_{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j]
    one = df.agg(*aggs) if aggs else df.limit(0)
    entries = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i == j:
                r = F.lit(1.0)
            else:
                r = F.col(f"_{min(i, j)}_{max(i, j)}")
            entries.append(F.struct(F.lit(a).alias("col_i"), F.lit(b).alias("col_j"), r.alias("r")))
    return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def _wide_correlation(df: DataFrame, cols: list[str]) -> DataFrame:
    g = gram(df, cols)
    d = len(cols)
    r = np.full((d, d), np.nan) if g is None else g.correlation()
    undefined = np.isnan(r) & (True if g is None else g.nan == 0)
    np.fill_diagonal(r, 1.0)
    np.fill_diagonal(undefined, False)
    # d x d numbers, a bound fixed by the table's width
    rows = pa.table({"col_i": np.repeat(cols, d), "col_j": np.tile(cols, d), "r": pa.array(r.ravel(), mask=undefined.ravel())})
    return df.sparkSession.createDataFrame(rows)


def histogram(df: DataFrame, cols: list[str], bins: int = 20) -> DataFrame:
    """``bins`` equal-width bins over [min, max] per column; last bin closed; empty bins kept.

    Bin = floor((v - min) / (max - min) * bins) + 1, with v = max folded into the
    last bin; a constant column puts everything in bin 1.  Nulls and values that
    are not finite are left out; a column without any value gives no row.

    One pass for the extremes of all columns, one for the counts: a task counts
    all its rows into one array per column, so rows shuffled are tasks x columns.
    """
    infinite = float("inf")
    fine = lambda c: F.when(F.abs(F.col(c).cast("double")) < infinite, F.col(c).cast("double"))
    ends = df.agg(*[f(fine(c)).alias(f"{n}{i}") for i, c in enumerate(cols) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    lo, hi = ([ends[f"{n}{i}"] for i in range(len(cols))] for n in ("lo", "hi"))
    some = [i for i in range(len(cols)) if lo[i] is not None]

    def count(batches):
        total = np.zeros((len(cols), bins), np.int64)
        for batch in batches:
            for i in some:
                v = batch.column(i).drop_null().to_numpy()
                span = hi[i] - lo[i]
                at = np.floor((v - lo[i]) / span * bins).astype(np.int64) if span else np.zeros(len(v), np.int64)
                total[i] += np.bincount(np.minimum(at, bins - 1), minlength=bins)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([total[i].tolist() for i in some], pa.list_(pa.int64()))],
                                         names=["f", "n"])

    counted = df.select(*[fine(c).alias(f"v{i}") for i, c in enumerate(cols)]).mapInArrow(count, "f int, n array<long>")
    merged = counted.groupBy("f").agg(F.array(*[F.sum(F.col("n")[k]) for k in range(bins)]).alias("n"))
    item = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("f") + 1)
    each = merged.select("f", item(cols).alias("feature"), item(lo).cast("double").alias("lo"), item(hi).cast("double").alias("hi"),
                         F.posexplode("n").alias("at", "n"))
    width = (F.col("hi") - F.col("lo")) / bins
    return each.select("feature", (F.col("at") + 1).alias("bin"), (F.col("lo") + F.col("at") * width).alias("bin_lo"),
                       (F.col("lo") + (F.col("at") + 1) * width).alias("bin_hi"), "n")


def boxplot_stats(df: DataFrame, value: str, by: str | None = None) -> DataFrame:
    """A10: Q1/median/Q3 (linear interpolation), whiskers at the extreme points within
    1.5 IQR of the box, and the outlier count, per group (null is a group of its own).

    The raw rows are read once, into the rank index that gives the quartiles
    (exact, whatever the size of a group); whiskers and outliers are read off
    its distinct values.
    """
    g = F.col(by) if by else F.lit("all")
    index = RankIndex(df.select(g.cast("string").alias("group"), F.col(value).alias("v")), ["group"], "v")
    q = index.quantiles([0.25, 0.5, 0.75], count="n", surrogate=True).select(
        "_g", "group", F.col("n").cast("long").alias("n"), F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    q, n_groups = materialize_small(q)
    iqr = F.col("q3") - F.col("q1")
    inside = (F.col("_y") >= F.col("q1") - 1.5 * iqr) & (F.col("_y") <= F.col("q3") + 1.5 * iqr)
    w = (index.rows.select("_g", "_y", "_c").join(broadcast_if_small(q.drop("group", "n"), n_groups), "_g")
         .groupBy("_g").agg(F.min(F.when(inside, F.col("_y"))).alias("whisker_lo"), F.max(F.when(inside, F.col("_y"))).alias("whisker_hi"),
                            F.coalesce(F.sum(F.when(~inside, F.col("_c"))), F.lit(0)).cast("long").alias("n_outliers")))
    return q.join(w, "_g").drop("_g")

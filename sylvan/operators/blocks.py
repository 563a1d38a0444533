"""Numpy blocks: rows cross to Python once, partial results are merged by levels.

``numpy_blocks`` turns a table of equal-length arrays into blocks of at most
``BLOCK_ROWS`` rows, kept on the executors (memory, then disk; a lost block is
built again from its input).  ``tree_sum`` merges one result per block pairwise
in tasks, level by level, so the driver receives a single item whatever the
number of partitions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.session import ship_package

BLOCK_ROWS = 65_536


def numpy_blocks(df: DataFrame, vector: Column, extra: Column | None = None, block_rows: int = BLOCK_ROWS) -> RDD:
    """An RDD of (matrix, extra column or None); null components are NaN, null vectors are left out.

    Vectors of different lengths raise.  The caller persists and releases it.
    """
    ship_package(df.sparkSession)
    rows = df.select(vector.cast("array<double>").alias("x"), (F.lit(None) if extra is None else extra).cast("double").alias("y"))

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if len(batch):
                held.append(_matrix(batch))
                n += len(batch)
            if n >= block_rows:
                yield _packed(held)
                held, n = [], 0
        if held:
            yield _packed(held)

    packed = rows.where("x IS NOT NULL").mapInArrow(run, "d int, x binary, y binary")
    has_extra = extra is not None

    def unpack(r):
        x = np.frombuffer(r["x"]).reshape(-1, r["d"])
        return x, (np.frombuffer(r["y"]) if has_extra else None)

    return packed.rdd.map(unpack)


def _matrix(batch: pa.RecordBatch):
    lists = batch.column(0)
    sizes = np.diff(lists.offsets.to_numpy())
    if (sizes != sizes[0]).any():
        raise ValueError("vectors of different lengths")
    return (lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1) if sizes[0] else np.zeros((len(lists), 0)),
            batch.column(1).to_numpy(zero_copy_only=False).astype(float))


def _packed(held) -> pa.RecordBatch:
    if len({x.shape[1] for x, _ in held}) > 1:
        raise ValueError("vectors of different lengths")
    x, y = (np.concatenate(c) for c in zip(*held))
    return pa.RecordBatch.from_arrays([pa.array([x.shape[1]], pa.int32()), pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()),
                                       pa.array([y.tobytes()], pa.binary())], names=["d", "x", "y"])


def width(blocks: RDD) -> int | None:
    """The vectors' length; None without rows."""
    found = blocks.map(lambda xy: xy[0].shape[1]).distinct().take(2)
    if len(found) > 1:
        raise ValueError("vectors of different lengths")
    return found[0] if found else None


def tree_sum(blocks: RDD, of_block, merge):
    """``of_block`` of every block, merged in tasks level by level; None without blocks."""
    def both(a, b):
        return b if a is None else a if b is None else merge(a, b)

    return blocks.map(of_block).treeAggregate(None, both, both)


# --------------------------------------------------------------------------- moments

class Moments:
    """Counts, means and centred second moments of vector components (Chan's pairwise merge)."""

    def __init__(self, n, mean, m2):
        self.n, self.mean, self.m2 = n, mean, m2

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        ok = ~np.isnan(x)
        n = ok.sum(axis=0).astype(float)
        mean = np.where(ok, x, 0).sum(axis=0) / np.maximum(n, 1)
        return cls(n, mean, (np.where(ok, x - mean, 0) ** 2).sum(axis=0))

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        step = other.mean - self.mean
        share = other.n / np.maximum(n, 1)
        return Moments(n, self.mean + step * share, self.m2 + other.m2 + step ** 2 * self.n * share)


def component_moments(df: DataFrame, vector: Column) -> Moments | None:
    """Per component its number of values, mean and sum of squared deviations, in one pass."""
    return tree_sum(numpy_blocks(df, vector), lambda xy: Moments.of(xy[0]), Moments.merged)


class Gram:
    """Centred cross products of all pairs of columns over the rows where both are present.

    For the pair (i, j): ``n`` rows, ``mean`` of i, ``var`` the squared deviations of i and ``co`` the products of
    deviations; ``nan`` counts the rows that make the pair's result not a number.
    """

    FIELDS = ("n", "mean", "var", "co", "nan")

    def __init__(self, n, mean, var, co, nan):
        self.n, self.mean, self.var, self.co, self.nan = n, mean, var, co, nan

    @classmethod
    def of(cls, x: np.ndarray, null: np.ndarray) -> Gram:
        here, nan = (~null).astype(float), (np.isnan(x) & ~null).astype(float)
        fine = (here - nan) > 0
        count = np.maximum(fine.sum(axis=0), 1)
        shift = np.where(fine, x, 0).sum(axis=0) / count  # sums of shifted values do not cancel
        z = np.where(fine, x - shift, 0)
        n = here.T @ here
        total, some = z.T @ here, np.maximum(n, 1)
        mean = total / some
        return cls(n, mean + shift[:, None], (z * z).T @ here - total * mean, z.T @ z - total * mean.T, nan.T @ here + here.T @ nan)

    def merged(self, other: Gram) -> Gram:
        n = self.n + other.n
        share = other.n / np.maximum(n, 1)
        # a side without rows of a pair has no mean of it
        step = np.where((self.n > 0) & (other.n > 0), other.mean - self.mean, 0)
        mean = np.where(self.n > 0, self.mean + step * share, other.mean)
        weight = self.n * share
        return Gram(n, mean, self.var + other.var + step ** 2 * weight, self.co + other.co + step * step.T * weight, self.nan + other.nan)

    def correlation(self) -> np.ndarray:
        """Pearson's r of each pair; NaN where it is undefined."""
        with np.errstate(divide="ignore", invalid="ignore"):
            r = self.co / np.sqrt(self.var * self.var.T)
        r[(self.n < 2) | (self.nan > 0) | (self.var <= 0) | (self.var.T <= 0)] = np.nan
        return r


def gram(df: DataFrame, cols: list[str]) -> Gram | None:
    """All pairs' moments of numeric columns in one pass (nulls are left out pair by pair)."""
    # a null is told from a NaN by a second half of the vector
    vector = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols],
                     *[F.col(c).isNull().cast("double") for c in cols])
    d = len(cols)
    return tree_sum(numpy_blocks(df, vector, block_rows=max(256, BLOCK_ROWS * 64 // max(64, d))),
                    lambda xy: Gram.of(xy[0][:, :d], xy[0][:, d:] > 0), Gram.merged)


def kept(blocks: RDD) -> RDD:
    return blocks.persist(StorageLevel.MEMORY_AND_DISK)

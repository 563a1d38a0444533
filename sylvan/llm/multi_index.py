"""Approximate nearest neighbours by an inverted multi-index.

Vectors are scaled to unit length and cut into halves; each half has its own
codebook of ``centroids`` centroids, so a vector belongs to one of
``centroids ** 2`` cells.  A query walks the cells in the order of the summed
distances of its halves to the two centroids: the pairs are popped from a heap
that starts at the two nearest centroids and pushes the next one of either
side (the multi-sequence walk).  It stops when the cells popped hold
the index's ``share`` of all vectors, and the entries found are reranked by the exact cosine of
the original vectors.

The codebooks are fitted on a hash sample of about ``sample`` vectors, and on
the same sample ``share`` is calibrated: the smallest share of entries with
which the sample's own nearest neighbours are found at ``target`` recall.  In
clustered data it is small; in data without structure it must be large, and
the walk pays for it instead of losing recall.  All vectors are indexed.

Work is grouped by the first half's centroid: the index rows of a centroid are
dealt to blocks of about ``BLOCK`` rows, the queries that visit it to chunks of
the same size, and each block meets each chunk once, so a centroid that holds
a third of all vectors is spread over many tasks.  A task returns the ``k`` best
of each query, and these are merged.

Defined results: vectors that are null, zero, or hold a null or non-finite
component take no part; vectors of different lengths are searched apart, each
among its own; ties go to the smaller id; components of any size are scored
exactly, as both vectors are scaled by powers of two first; a query's own row is no candidate, but a repeated row of the same
id counts as its own too; null ids take no part; an empty table gives no row.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sylvan.session import scratch_path

CENTROIDS = 32
SAMPLE = 16_000
SAMPLE_QUERIES = 600
TARGET = 0.96
BLOCK = 4096
LLOYD_STEPS = 12

OUT = "query_id long, rank int, vec_id long, score double"


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _tame(x: np.ndarray) -> np.ndarray:
    """Rows scaled by the power of two that brings their largest component to about 1: exact, and squares stay finite."""
    _, power = np.frexp(np.abs(x).max(axis=1, keepdims=True))
    return np.ldexp(x, -power)


def kmeans(x: np.ndarray, k: int, steps: int = LLOYD_STEPS) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced distinct starts; at most ``k`` centroids."""
    distinct = np.unique(x, axis=0)
    c = distinct[np.linspace(0, len(distinct) - 1, min(k, len(distinct))).astype(int)].copy()
    for _ in range(steps):
        at = _distances(x, c).argmin(1)
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        n = np.bincount(at, minlength=len(c))
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


class MultiIndex:
    """Two codebooks, the cells' counts, and the share of entries to visit."""

    def __init__(self, x: np.ndarray, centroids: int):
        half = (x.shape[1] + 1) // 2
        self.half = half
        self.books = [kmeans(x[:, :half], centroids), kmeans(x[:, half:], centroids)] if x.shape[1] > 1 else \
            [kmeans(x, centroids), np.zeros((1, 0))]
        self.counts = np.zeros((len(self.books[0]), len(self.books[1])), np.int64)
        self.share = 1.0

    def halves(self, x: np.ndarray):
        return _distances(x[:, :self.half], self.books[0]), _distances(x[:, self.half:], self.books[1])

    def assign(self, x: np.ndarray):
        a, b = self.halves(x)
        return a.argmin(1), b.argmin(1)

    def walk(self, a: np.ndarray, b: np.ndarray):
        """Centroid pairs by summed distance: heap over the two sorted lists."""
        first, second = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        heap, seen = [(a[first[0]] + b[second[0]], 0, 0)], {(0, 0)}
        while heap:
            _, i, j = heapq.heappop(heap)
            yield int(first[i]), int(second[j])
            for ni, nj in ((i + 1, j), (i, j + 1)):
                if ni < len(first) and nj < len(second) and (ni, nj) not in seen:
                    seen.add((ni, nj))
                    heapq.heappush(heap, (a[first[ni]] + b[second[nj]], ni, nj))

    def visited(self, a: np.ndarray, b: np.ndarray, least: int):
        """The cells of a walk until they hold ``share`` of all entries, and at least ``least``."""
        need, total, out = max(least, int(np.ceil(self.share * self.counts.sum()))), 0, []
        for i, j in self.walk(a, b):
            if self.counts[i, j]:
                out.append((i, j))
                total += int(self.counts[i, j])
                if total >= need:
                    break
        return out

    def calibrate(self, x: np.ndarray, k: int, target: float, queries: int) -> None:
        i, j = self.assign(x)
        np.add.at(self.counts, (i, j), 1)
        rows = np.linspace(0, len(x) - 1, min(len(x), queries)).astype(int)
        a, b = self.halves(x[rows])
        seen = []
        for q, da, db in zip(rows, a, b):
            near = x @ x[q]
            near[q] = -2
            best = np.argpartition(-near, min(k, len(x) - 1) - 1)[:k] if len(x) > 1 else []
            wanted = {}
            for t in best:
                if t != q:
                    wanted.setdefault((int(i[t]), int(j[t])), []).append(t)
            total = 0
            for cell in self.walk(da, db):
                total += int(self.counts[cell])
                if cell in wanted:
                    seen += [total] * len(wanted.pop(cell))
                if not wanted:
                    break
        self.share = float(np.quantile(seen, target, method="higher")) / len(x) if seen else 1.0
        self.counts[:] = 0


def usable(vector: Column) -> Column:
    """Not null, not zero, and every component a finite number."""
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(vector, lambda v: v != 0), F.lit(False))


def _matrix(arrays: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(v.as_py(), np.float64) for v in arrays]).reshape(len(arrays), -1)


def best_of(ids: np.ndarray, x: np.ndarray, q: np.ndarray, own: int, k: int):
    """The ``k`` nearest rows of ``x`` to ``q``: (score, id), largest cosine first, then the smaller id."""
    x, q = _tame(x), _tame(q[None, :])[0]
    scores = (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))
    ok = np.flatnonzero(ids != own)
    order = ok[np.lexsort((ids[ok], -scores[ok]))][:k]
    return [(float(scores[t]), int(ids[t])) for t in order]


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
            centroids: int = CENTROIDS, sample: int = SAMPLE, target: float = TARGET, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row that ``is_query`` (a condition on ``vec_id``)."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")) \
        .where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy("d").collect()  # a row per length
    out = spark.createDataFrame([], OUT)
    for r in lengths:
        out = out.unionAll(_nearest_of_length(rows.where(F.size("vector") == r["d"]), r["d"], r["n"], is_query, k, centroids, sample, target, block))
    return out


def _nearest_of_length(rows: DataFrame, dim: int, n_rows: int, is_query: Column, k: int, centroids: int, sample: int, target: float,
                       block: int) -> DataFrame:
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "multi-index")
    # codebooks and share from the bounded sample
    rate = min(1.0, sample / n_rows)
    drawn = rows.where(F.pmod(F.xxhash64(F.lit("codebook"), "vec_id"), F.lit(1_000_000)) < F.lit(rate * 1_000_000)) \
        .select("vec_id", "vector").toArrow()
    if not len(drawn):
        drawn = rows.select("vec_id", "vector").limit(1).toArrow()  # a tiny table whose hashes all miss
    order = np.argsort(drawn["vec_id"].to_numpy(), kind="stable")
    base = _unit(np.array(drawn["vector"].to_pylist(), np.float64))[order]
    index = MultiIndex(base, centroids)
    index.calibrate(base, k, target, SAMPLE_QUERIES)

    def assign(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, dim)
            i, j = index.assign(_unit(x)) if len(x) else (np.zeros(0, int), np.zeros(0, int))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([v.tobytes() for v in x], pa.binary())],
                names=["vec_id", "i", "j", "v"])

    schema = "vec_id long, i int, j int, v binary"
    rows.mapInArrow(assign, schema).write.parquet(f"{path}/index")
    stored = spark.read.schema(schema).parquet(f"{path}/index")
    for r in stored.groupBy("i", "j").agg(F.count(F.lit(1)).alias("n")).collect():  # centroids ** 2 rows at most
        index.counts[r["i"], r["j"]] = r["n"]

    def visit(batches):
        for batch in batches:
            x = _matrix(batch.column(1))
            if not len(x):
                continue
            a, b = index.halves(_unit(x))
            ids, firsts, seconds, vs = [], [], [], []
            for q, v, da, db in zip(batch.column(0).to_pylist(), batch.column(1), a, b):
                by_first: dict[int, list[int]] = {}
                for i, j in index.visited(da, db, 10 * k + 1):
                    by_first.setdefault(i, []).append(j)
                for i, js in by_first.items():
                    ids.append(q), firsts.append(i), seconds.append(js), vs.append(v.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(firsts, pa.int32()),
                                              pa.array(seconds, pa.list_(pa.int32())), pa.array(vs, pa.binary())],
                                             names=["query_id", "i", "js", "q"])

    schema = "query_id long, i int, js array<int>, q binary"
    stored.where(is_query).select("vec_id", "v").mapInArrow(visit, schema).write.parquet(f"{path}/visits")
    visits = spark.read.schema(schema).parquet(f"{path}/visits")

    # blocks of index rows and chunks of queries, by first centroid
    held = index.counts.sum(axis=1)
    asked = {r["i"]: r["n"] for r in visits.groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per centroid
    plan = [(i, -(-int(held[i]) // block), -(-asked[i] // block)) for i in sorted(asked)]
    if not plan:
        return spark.createDataFrame([], OUT)
    dealt = {name: F.create_map(*(F.lit(v) for row in plan for v in (row[0], row[at]))) for name, at in (("blocks", 1), ("chunks", 2))}
    def side(df: DataFrame, key: str, own: str, other: str, own_name: str, other_name: str) -> DataFrame:
        return (df.where(F.col("i").isin([r[0] for r in plan]))
                .withColumn(own_name, F.pmod(F.xxhash64(key), dealt[own][F.col("i")]).cast("int"))
                .withColumn(other_name, F.explode(F.sequence(F.lit(0), dealt[other][F.col("i")] - 1))))

    left = side(stored, "vec_id", "blocks", "chunks", "block", "chunk")
    right = side(visits, "query_id", "chunks", "blocks", "chunk", "block")

    def rerank(entries: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if len(entries) and len(queries):
            ids, cells = entries["vec_id"].to_numpy(), entries["j"].to_numpy()
            x = _matrix(entries["v"].combine_chunks())
            unit = _unit(x)
            by_cell = {int(j): np.flatnonzero(cells == j) for j in np.unique(cells)}
            for own, js, q in zip(queries["query_id"].to_pylist(), queries["js"].to_pylist(), queries["q"]):
                at = [by_cell[j] for j in js if j in by_cell]
                if not at:
                    continue
                at, q = np.concatenate(at), np.frombuffer(q.as_py(), np.float64)
                rough = unit[at] @ _unit(q[None, :])[0]
                if len(at) > k + 1:  # all that can be among the k + 1 best, ties included
                    at = at[rough >= np.partition(rough, -(k + 1))[-(k + 1)] - 1e-9]
                found += [(own, t, s) for s, t in best_of(ids[at], x[at], q, own, k)]
        cols = list(zip(*found)) or [()] * 3
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()),
                         "score": pa.array(cols[2], pa.float64())})

    keys = ["i", "block", "chunk"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(rerank, "query_id long, vec_id long, score double")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.distinct().withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

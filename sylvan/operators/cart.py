"""Threshold (CART-style) trees on numeric features.

M14 exposes the split search as SQL: the exact best threshold of each numeric
column (Gini or squared error), from per-value label statistics and cumulative
sums over the sorted distinct values (a blocked, two-level prefix sum, so
high-cardinality features need no pre-binning).

M12/M13 grow exact trees level by level on that search, without bins, samples
or a depth limit (unless one is given), until a node has one label value or
equal features.  A node of at most MAX_ROWS_PER_TASK rows is finished within
one task by the same rules; larger ones are split by the distributed search.  Ties (gains equal to
12 decimals) go to the first feature, then to the smallest threshold; a class
tie in a leaf goes to the smallest label.  Null or NaN features and null labels
raise, an empty table too.
"""

from __future__ import annotations

import base64
import math
import os
import pickle
import time
import uuid
import zlib
from dataclasses import dataclass, field
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.operators.cart_search import split_large
from sylvan.operators.joins import BROADCAST_MAX_ROWS, broadcast_if_small, materialize_small
from sylvan.session import cut_lineage, scratch_path, ship_package

MAX_VALUES_PER_TASK = 1_000_000
#: Nodes of more rows are split by the distributed search.
MAX_ROWS_PER_TASK = 250_000
#: Bins of a feature in that search.
MAX_BINS = 4096
#: Tasks that finish the smaller nodes.
MAX_TASKS = 1000
#: A task splits its nodes of more rows one at a time, by bins as the large ones, and all others of a level at once.
LARGE_IN_TASK = 16_384
#: Feature values that a task of the search of large class nodes holds at most (8,000,000 rows of four), and its classes.
MAX_VALUES_HELD = 32_000_000
MAX_CLASSES_HELD = 16


def grow(x: np.ndarray, y: np.ndarray, k: int, max_depth: int | None = None, node: np.ndarray | None = None,
         depths: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """The exact trees of one task's rows: feature (-1 in leaves), threshold, left (the right child follows it) and value by node.
    ``k`` classes, or 0 for squared error.  ``node``: the tree of each row, its root's number from 0 (the default: one tree),
    and ``depths``: how deep the roots are."""
    node = np.zeros(len(y), np.int64) if node is None else node
    depths = np.zeros(1, np.int64) if depths is None else depths
    sizes, roots = np.bincount(node, minlength=len(depths)), len(depths)
    large = np.flatnonzero(sizes > LARGE_IN_TASK) if k else []
    names = ("feature", "threshold", "left", "value")
    if not len(large):
        return dict(zip(names, _grow_levels(x, y, k, max_depth, node, depths)))
    # the top of large trees, whose ends are the roots of what is grown level by level
    top = {name: [np.full(roots, -1)] for name in names}
    n_top, parts, part_depths, own = roots, node.copy(), depths.tolist(), list(range(roots))
    for r in large:
        rows = np.flatnonzero(node == r)
        left_depth = None if max_depth is None else max_depth - depths[r]
        tree, _, ends, _, _ = split_large([x[rows, j] for j in range(x.shape[1])], y[rows].astype(np.int64), k, LARGE_IN_TASK, 256, left_depth)
        at = np.r_[r, np.arange(n_top, n_top + len(tree["left"]) - 1)]  # the number of each of its nodes
        left = np.array(tree["left"])
        for name, v in (("feature", np.array(tree["feature"])), ("threshold", np.array(tree["threshold"])),
                        ("left", np.where(left < 0, -1, at[left])), ("value", np.zeros(len(left)))):
            top[name][0] = top[name][0].astype(v.dtype)
            top[name][0][r] = v[0]
            top[name].append(v[1:])
        parts[rows] = at[ends]
        n_top += len(left) - 1
        part_depths += [depths[r] + d for d in tree["depth"][1:]]
    ends, parts = np.unique(parts, return_inverse=True)
    rest = _grow_levels(x, y, k, max_depth, parts, np.array(part_depths)[ends])
    out = {}
    for name, v in zip(names, rest):
        if name == "left":
            v = np.where(v < 0, -1, v + n_top - len(ends))
        out[name] = np.concatenate([*top[name], v[len(ends):]])
        out[name][ends] = v[:len(ends)]
    return out


def _grow_levels(x: np.ndarray, y: np.ndarray, k: int, max_depth: int | None, node: np.ndarray, depths: np.ndarray) -> list[np.ndarray]:
    """``grow``, all nodes of a level at once."""
    feature, threshold, left, value = [], [], [], []
    first, orders, columns = 0, [], [np.ascontiguousarray(x[:, j]) for j in range(x.shape[1])]
    for c in columns:
        o = np.argsort(c, kind="stable")
        orders.append(o if len(depths) == 1 else o[np.argsort(node[o], kind="stable")])
    sizes, y = np.bincount(node, minlength=len(depths)), y.astype(np.int16 if k < 1 << 15 else np.int64) if k else y
    is_left, stats = np.zeros(len(y), bool), np.zeros(0 if k else len(y))
    while len(sizes):
        m, stops = len(sizes), np.cumsum(sizes)
        starts, seg, n = stops - sizes, np.repeat(np.arange(m), sizes), sizes.astype(float)
        ys = y[orders[0]]
        if k:
            total = np.bincount(seg * k + ys, minlength=m * k).reshape(m, k).astype(float)
            out, scale, parent = total.argmax(axis=1).astype(float), np.ones(m), (total * total).sum(axis=1)
            several = (total > 0).sum(axis=1) > 1
        else:
            lo, hi = np.minimum.reduceat(ys, starts), np.maximum.reduceat(ys, starts)
            mean = lo + np.add.reduceat(ys - lo[seg], starts) / n
            out, several = np.where(lo == hi, lo, mean), lo != hi
            stats[orders[0]] = own = ys - mean[seg]
            scale, total, parent = np.add.reduceat(own ** 2, starts) / n, np.add.reduceat(own, starts)[:, None], np.zeros(m)
        if max_depth is not None:
            several &= depths < max_depth
        best, chosen, cut = np.full(m, -np.inf), np.full(m, -1), np.zeros(m)
        inner = several[seg]
        inner = inner[1:] & (seg[1:] == seg[:-1])
        for j, o in enumerate(orders if inner.any() else []):
            xs = columns[j][o]
            i = np.flatnonzero((xs[1:] != xs[:-1]) & inner)
            if not len(i):
                continue
            g = seg[i]
            nl = i - starts[g] + 1.0
            nr, of = n[g] - nl, y[o] if k else stats[o]
            sl2 = sr2 = 0.0
            for c in range(max(k, 1)):
                sums = np.cumsum(of == c, dtype=np.int64) if k else np.cumsum(of)
                sl = (sums[i] - np.where(starts > 0, sums[starts - 1], 0)[g]).astype(float)
                sr = total[g, c] - sl
                sl2, sr2 = sl2 + sl * sl, sr2 + sr * sr
            gain = (sl2 / nl + sr2 / nr - parent[g] / n[g]) / n[g]
            r = np.round(gain / scale[g], 12)
            heads = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            top = np.full(m, -np.inf)
            top[g[heads]] = np.maximum.reduceat(r, heads)
            hits = np.flatnonzero(r == top[g])
            hits = hits[np.r_[True, g[hits][1:] != g[hits][:-1]]]
            hits = hits[r[hits] > best[g[hits]]]
            a, b = xs[i[hits]], xs[i[hits] + 1]
            with np.errstate(all="ignore"):
                mid = (a + b) / 2
            won = g[hits]
            best[won], chosen[won], cut[won] = r[hits], j, np.where(mid < b, mid, a)
        split = chosen >= 0
        child = first + m + 2 * (np.cumsum(split) - 1)
        feature.append(chosen), threshold.append(cut), value.append(out)
        left.append(np.where(split, child, -1))
        stays = split[seg]
        own, o = (np.cumsum(split) - 1)[seg[stays]], orders[0][stays]
        at, by = chosen[split], cut[split]
        is_left[o] = x[o, at[own]] <= by[own]
        n_left, size = np.bincount(own, weights=is_left[o], minlength=len(at)).astype(np.int64), sizes[split]
        # each node's rows keep their order, those of its left child first
        start, before = np.cumsum(size) - size, np.cumsum(n_left) - n_left
        to_left, to_right = (start - before - 1)[own], (n_left + before)[own] + np.arange(len(own))
        for j, o in enumerate(orders):
            o = o[stays]
            goes = is_left[o]
            lefts = np.cumsum(goes)
            orders[j] = np.empty_like(o)
            orders[j][np.where(goes, to_left + lefts, to_right - lefts)] = o
        sizes = np.column_stack([n_left, size - n_left]).ravel()
        first, depths = first + m, np.repeat(depths[split] + 1, 2)
    return [np.concatenate(v) for v in (feature, threshold, left, value)]


def descend(tree: dict[str, np.ndarray], x: np.ndarray, node: np.ndarray | None = None) -> np.ndarray:
    """The value of each row's leaf.  ``node``: where the rows begin (the default: the first node)."""
    node, live = np.zeros(len(x), np.int64) if node is None else node, np.arange(len(x))
    while len(live):
        live = live[tree["feature"][node[live]] >= 0]
        at = node[live]
        node[live] = tree["left"][at] + ~(x[live, tree["feature"][at]] <= tree["threshold"][at])
    return tree["value"][node]


@dataclass
class CartModel:
    """The tree of the large nodes (``upper``: its ends hold node numbers), the values of its leaves, and the trees of its
    other ends, those of a bucket grown by one task.  ``levels``: how many levels were split by the distributed search."""

    features: list[str]
    classes: list | None
    class_type: T.DataType | None
    levels: int
    upper: dict[str, np.ndarray]
    leaves: dict[int, float]
    buckets: np.ndarray
    trees: DataFrame

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``."""
        _reject_missing(df, self.features)
        ship_package(df.sparkSession)
        upper, buckets = self.upper, self.buckets

        @F.arrow_udf("struct<_node: int, _bucket: int>")
        def place(*x: pa.Array) -> pa.Array:  # the rows themselves need not go to Python here
            node = descend(upper, np.column_stack([v.to_numpy(zero_copy_only=False) for v in x])).astype(np.int32)
            return pa.StructArray.from_arrays([pa.array(node), pa.array(buckets[node])], names=["_node", "_bucket"])

        at = place(*[F.col(f).cast("double") for f in self.features])
        rows = df.select(F.struct("*").alias("row"), _vector(self.features).alias("_x"), at.alias("_at"))
        rows = cut_lineage(rows.select("row", "_x", "_at.*"))
        limit = MAX_ROWS_PER_TASK
        counts, n_counts = materialize_small(rows.groupBy("_bucket").agg(F.ceil(F.count("*") / limit).alias("_parts")))
        parts = broadcast_if_small(counts, n_counts)
        of_tree = rows.join(parts, "_bucket").withColumn("_part", F.monotonically_increasing_id() % F.col("_parts")).drop("_parts")
        trees = self.trees.join(parts, "_bucket").withColumn(
            "_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1))).drop("_parts")
        schema = T.StructType([T.StructField("row", df.schema), T.StructField("_value", T.DoubleType())])
        width, leaves = len(self.features), self.leaves

        def apply(rows, trees):
            if not len(rows):
                values = np.zeros(0)
            elif (bucket := rows["_bucket"][0].as_py()) < 0:
                values = np.full(len(rows), leaves[~bucket])
            else:
                ends, tree = pickle.loads(trees["tree"][0].as_py())
                values = descend(tree, _matrix(rows["_x"], width), np.searchsorted(ends, rows["_node"].to_numpy()))
            return pa.table({"row": rows["row"], "_value": pa.array(values, pa.float64())})

        by = ("_bucket", "_part")
        out = of_tree.groupBy(*by).cogroup(trees.groupBy(*by)).applyInArrow(apply, schema)
        value = F.col("_value")
        if self.classes is not None:
            value = F.element_at(F.array(*[F.lit(c).cast(self.class_type) for c in self.classes]), value.cast("int") + 1)
        return out.select("row.*", value.alias("prediction"))


def _vector(features: list[str]):
    return F.array(*[F.col(f).cast("double") for f in features])


def _matrix(x, width: int) -> np.ndarray:
    """An Arrow column of vectors as rows."""
    x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    return x.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _at_ends(rows: DataFrame, upper: dict[str, np.ndarray], width: int, buckets: np.ndarray) -> DataFrame:
    """``rows`` with ``_node``, the end of ``upper`` that each row falls to, and its ``_bucket``."""
    ship_package(rows.sparkSession)

    def walk(batches):
        for b in batches:
            node = descend(upper, _matrix(b.column("_x"), width)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(node), pa.array(buckets[node])], names=[*b.schema.names, "_node", "_bucket"])

    added = [T.StructField("_node", T.IntegerType()), T.StructField("_bucket", T.IntegerType())]
    return rows.mapInArrow(walk, T.StructType([*rows.schema.fields, *added]))


def _buckets(tree: dict, leaves: dict[int, float], limit: int) -> np.ndarray:
    """The bucket of each end: as many as ``limit`` rows allow share one; a leaf, which needs no task, has ``~number``."""
    out, bucket, held = np.full(len(tree["left"]), -1, np.int32), 0, 0
    for end, (feature, n) in enumerate(zip(tree["feature"], tree["n"])):
        if end in leaves:
            out[end] = ~end
        elif feature < 0:
            if held and held + n > limit:
                bucket, held = bucket + 1, 0
            out[end], held = bucket, held + n
    return out


def _reject_missing(df: DataFrame, features: list[str], label: str | None = None) -> int:
    """The number of rows; raises when a feature is null or NaN or a label null."""
    bad = F.lit(False) if label is None else F.col(label).isNull()
    for f in features:
        bad = bad | F.col(f).isNull() | F.isnan(F.col(f).cast("double"))
    n, n_bad = df.agg(F.count("*"), F.count_if(bad)).first()
    if n_bad:
        raise ValueError(f"{n_bad} rows have a null or NaN feature or a null label")
    return n


def fit_cart(df: DataFrame, features: list[str], label: str, criterion: str = "gini",
             max_depth: int | None = None) -> CartModel:
    """The exact tree: ``gini`` for classes, ``squared_error`` for numbers."""
    n = _reject_missing(df, features, label)
    if not n:
        raise ValueError("cannot fit a tree on an empty table")
    classes, class_type, k = None, None, 0
    if criterion == "gini":
        classes, class_type = [r[0] for r in df.select(label).distinct().orderBy(label).collect()], df.schema[label].dataType
        k = len(classes)
        y = (F.array_position(F.array(*[F.lit(c).cast(class_type) for c in classes]), F.col(label)) - 1).cast("double")
    elif criterion == "squared_error":
        y = F.col(label).cast("double")
    else:
        raise ValueError(f"unknown criterion {criterion!r}")
    width, limit = len(features), MAX_ROWS_PER_TASK
    rows = df.select(_vector(features).alias("_x"), y.alias("_y"))
    slots = _slots(rows.sparkSession) if 0 < k <= MAX_CLASSES_HELD and n > limit else 0
    held = n * width <= slots * MAX_VALUES_HELD
    if held:
        of_tasks, tree, leaves, depth = _search_held(rows, width, k, min(slots, math.ceil(n / limit)), max_depth)
    else:
        rows = cut_lineage(rows)
        tree, leaves, depth = _search_levels(rows, n, width, k, max_depth)
    arrays = {name: np.array(tree[name]) for name in ("feature", "threshold", "left")} | {"value": np.arange(len(tree["left"]))}
    arrays["threshold"] = arrays["threshold"].astype(float)
    depths = np.zeros(len(arrays["left"]), int)
    for i in np.flatnonzero(arrays["feature"] >= 0):  # children follow their parents
        depths[arrays["left"][i]:arrays["left"][i] + 2] = depths[i] + 1
    buckets = _buckets(tree, leaves, limit)

    def finish(group: pa.Table) -> pa.Table:
        y = group["_y"].to_numpy()
        ends, node = np.unique(group["_node"].to_numpy(), return_inverse=True)
        tree = grow(_matrix(group["_x"], width), y, k, max_depth, node, depths[ends])
        return pa.table({"_bucket": group["_bucket"][:1], "tree": pa.array([pickle.dumps((ends, tree))], pa.binary())})

    if not held:
        of_tasks = _at_ends(rows, arrays, width, buckets)
        if leaves:
            of_tasks = of_tasks.where("_bucket >= 0")
    of_tasks = of_tasks.repartition(int(min(max(buckets.max() + 1, 1), MAX_TASKS)), "_bucket")
    trees = cut_lineage(of_tasks.groupBy("_bucket").applyInArrow(finish, "_bucket int, tree binary"))
    return CartModel(features, classes, class_type, depth, arrays, leaves, buckets, trees)


def _slots(spark) -> int:
    """How many tasks can run at the same time, 0 where that may change."""
    sc = spark.sparkContext
    if sc.getConf().get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 0
    jsc = sc._jsc.sc()
    return jsc.maxNumConcurrentTasks(jsc.resourceProfileManager().defaultResourceProfile())


class _Gather:
    """Gives each task of a barrier stage the parts of all, by partition.  Files in ``folder`` carry them where all tasks see them there
    (some milliseconds); Spark's own gathering, which waits a second each time, where not."""

    def __init__(self, folder: str | None):
        self.task, own = BarrierTaskContext.get(), uuid.uuid4().hex
        self.me, self.paths = self.task.partitionId(), None
        if folder is None:
            return
        try:
            os.makedirs(folder, exist_ok=True)
            open(os.path.join(folder, own), "xb").close()
        except OSError:
            own = ""
        names = self.task.allGather(own)
        seen = all(name and os.path.exists(os.path.join(folder, name)) for name in names)
        if all(said == "y" for said in self.task.allGather("y" if seen else "n")):
            self.paths, self.read = [os.path.join(folder, name) for name in names], [0] * len(names)

    def __call__(self, part) -> list:
        own = zlib.compress(pickle.dumps(part, 5), 1)
        if self.paths is None:
            return [pickle.loads(zlib.decompress(base64.b64decode(m))) for m in self.task.allGather(base64.b64encode(own).decode())]
        with open(self.paths[self.me], "ab") as f:
            f.write(len(own).to_bytes(8, "big") + own)
        return [part if i == self.me else pickle.loads(zlib.decompress(self._next(i))) for i in range(len(self.paths))]

    def _next(self, i: int) -> bytes:
        """What another task wrote next.  A task that waits for one that failed is ended by Spark with its stage."""
        wait = 0.0005
        while True:
            with open(self.paths[i], "rb") as f:  # opened anew, so that a network file system looks again
                f.seek(self.read[i])
                size = int.from_bytes(head, "big") if len(head := f.read(8)) == 8 else None
                if size is not None and len(body := f.read(size)) == size:
                    self.read[i] += 8 + size
                    return body
            time.sleep(wait)
            wait = min(2 * wait, 0.02)


def _search_held(rows: DataFrame, width: int, k: int, slots: int, max_depth: int | None) -> tuple[DataFrame, dict, dict, int]:
    """The tree of large class nodes by tasks that hold the rows and run together: the rows of ends that are no leaves with their
    ``_node`` and ``_bucket``, the tree, its leaves and its levels."""
    ship_package(rows.sparkSession)
    limit, max_bins = MAX_ROWS_PER_TASK, MAX_BINS
    shared = urlparse(scratch_path(rows.sparkSession, "cart-parts"))
    folder = unquote(shared.path) if shared.scheme in ("", "file") else None
    schema = T.StructType([T.StructField("_x", T.ArrayType(T.DoubleType())), T.StructField("_y", T.DoubleType()),
                           T.StructField("_node", T.IntegerType()), T.StructField("_bucket", T.IntegerType()),
                           T.StructField("_tree", T.BinaryType())])

    def batch(x, y, node, bucket, tree=None):
        vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * (x.size // len(y))), pa.array(x.ravel()))
        return pa.RecordBatch.from_arrays([vectors, *map(pa.array, (y.astype(float), node, bucket)), pa.array([tree] * len(y), pa.binary())],
                                          names=schema.names)

    def search(batches):
        xs, ys = [[np.zeros(0)] for _ in range(width)], [np.zeros(0, np.int8)]
        for b in batches:
            m = _matrix(b.column("_x"), width)
            for j in range(width):
                xs[j].append(m[:, j].copy())
            ys.append(b.column("_y").to_numpy(zero_copy_only=False).astype(np.int8))
        x, y = [np.concatenate(xs.pop(0)) for _ in range(width)], np.concatenate(ys)
        tree, leaves, node, depth, features = split_large(x, y, k, limit, max_bins, max_depth, _Gather(folder))
        bucket = _buckets(tree, leaves, limit)[node]
        if BarrierTaskContext.get().partitionId() == 0:
            none = np.full(1, -1, np.int32)
            yield batch(np.zeros(0), np.zeros(1), none, none, pickle.dumps((tree, leaves, depth)))
        stays = np.flatnonzero(bucket >= 0)
        for i in range(0, len(stays), 1 << 16):
            at = stays[i:i + (1 << 16)]
            yield batch(np.column_stack([f.values(at) for f in features]), y[at], node[at], bucket[at])

    # not a checkpoint: what reads one counts as a barrier stage, too
    path = scratch_path(rows.sparkSession, "cart-ends")
    rows.repartition(slots).mapInArrow(search, schema, barrier=True).write.parquet(path)
    out = rows.sparkSession.read.schema(schema).parquet(path)
    tree, leaves, depth = pickle.loads(out.where("_tree IS NOT NULL").select("_tree").first()[0])
    return out.where("_bucket >= 0").drop("_tree"), tree, leaves, depth


def _search_levels(rows: DataFrame, n: int, width: int, k: int, max_depth: int | None) -> tuple[dict, dict, int]:
    """The tree of large nodes by queries over the stored rows, its leaves and its levels."""
    limit = MAX_ROWS_PER_TASK
    names = ("feature", "threshold", "left")
    upper, leaves, depth = {name: [-1] for name in names} | {"n": [n]}, {}, 0
    live = [_Node(0, n, 0.0 if k else rows.agg(F.avg("_y")).first()[0])] if n > limit else []
    table, table_rows = (_binned(rows, width), n) if live else (None, 0)
    while live:
        ends, splits = _level(table, live, width, k, depth == max_depth)
        leaves.update(ends)
        kept = []
        for node in live:
            if node.id not in splits:
                continue
            f, t, left = splits[node.id]
            at = len(upper["left"])
            upper["feature"][node.id], upper["threshold"][node.id], upper["left"][node.id] = f, t, at
            for name in names:
                upper[name] += [-1, -1]
            children = [node.child(at, left, f, t, True), node.child(at + 1, left, f, t, False)]
            upper["n"] += [c.n for c in children]
            kept += [c for c in children if c.n > limit]
        live, depth = kept, depth + 1
        held = sum(node.n for node in live)
        # once half of the rows have left the large nodes the rest is written anew, so a level costs what its rows cost
        if live and (held <= table_rows / 2 or len(live) > 8 + 2 * len({node.root for node in live})):
            table, table_rows = cut_lineage(table.withColumn("_node", _at_boxes(live)).where("_node IS NOT NULL")), held
            live = [_Node(node.id, node.n, node.mean, node.id) for node in live]
    return upper, leaves, depth


@dataclass
class _Node:
    """A large node: its rows, the mean that squared errors are taken from, and its bounds since the table was last written,
    ``lo < x <= hi`` by feature, below the node ``root`` named there."""

    id: int
    n: int
    mean: float = 0.0
    root: int = 0
    box: dict[int, tuple[float | None, float | None]] = field(default_factory=dict)

    def child(self, at: int, left: list, f: int, t: float, is_left: bool) -> _Node:
        """``left``: the rows left of the split, and for squared error the sums on both sides."""
        lo, hi = self.box.get(f, (None, None))
        n = left[0] if is_left else self.n - left[0]
        mean = self.mean + (left[1] if is_left else left[2]) / n
        return _Node(at, n, mean, self.root, {**self.box, f: (lo, t) if is_left else (t, hi)})

    def holds(self) -> Column:
        own = F.col("_node") == self.root
        for f, (lo, hi) in self.box.items():
            x = F.element_at("_x", f + 1)
            own = own if lo is None else own & (x > lo)
            own = own if hi is None else own & (x <= hi)
        return own


def _by_node(live: list[_Node], column: Column, values: dict[int, Column]) -> Column:
    """The value of the node that ``column`` names."""
    out = F
    for node in live:
        if node.id in values:
            out = out.when(column == node.id, values[node.id])
    return F.lit(None).cast("double") if out is F else out


def _at_boxes(live: list[_Node]) -> Column:
    """The large node that a row of the table belongs to, null for rows that have left them."""
    out = F
    for node in live:
        out = out.when(node.holds(), F.lit(node.id))
    return out


def _binned(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` with ``_node`` 0 and the bin of each feature: the number of its cut points below the value."""
    probs = [i / MAX_BINS for i in range(1, MAX_BINS)]
    cuts = rows.agg(*[F.percentile_approx(F.element_at("_x", j + 1), probs, 4 * MAX_BINS) for j in range(width)]).first()
    cuts = [np.unique(c) for c in cuts]

    def find(batches):
        for b in batches:
            x = _matrix(b.column("_x"), width)
            bins = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)]).astype(np.int32)
            bins = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * width), pa.array(bins.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, bins], names=[*b.schema.names, "_b"])

    ship_package(rows.sparkSession)
    schema = T.StructType([*rows.schema.fields, T.StructField("_b", T.ArrayType(T.IntegerType()))])
    return cut_lineage(rows.mapInArrow(find, schema).withColumn("_node", F.lit(0)))


def _level(table: DataFrame, live: list[_Node], width: int, k: int, last: bool) -> tuple[dict, dict]:
    """The exact best split of every large node: leaves (node: value) and splits (node: feature, threshold, left sums).

    Class counts (or sums) of a feature's bins give the gain at every bin's end and a bound of the gains within it.  Only
    bins of several values whose bound reaches the best gain are then searched value by value, so the rows are not sorted.

    With D the sums left of a threshold less their share of the node's, n times the gain is D^2 n / (nl nr), over all
    classes; within a bin each D stays between what the bin's rows can add and take away.
    """
    pairs = F.arrays_zip(F.col("_b").alias("b"), F.col("_x").alias("x"))
    long = table.withColumn("_node", _at_boxes(live)).where("_node IS NOT NULL")
    mean = F.lit(0.0) if k else _by_node(live, F.col("_node"), {node.id: F.lit(node.mean) for node in live})
    long = long.select("_node", "_y", (F.col("_y") - mean).alias("_d"), F.posexplode(pairs).alias("_f", "_p")).select(
        "_node", "_f", "_p.b", "_p.x", "_y", "_d")
    own = [F.count_if(F.col("_y") == i).cast("double") for i in range(k)] or [F.sum("_d")]
    sums = [F.count("*").cast("double").alias("_c"), *[c.alias(f"_c{i}") for i, c in enumerate(own)]]
    m, span = len(own), Window.partitionBy("_node", "_f")
    cols = ["_c", *[f"_c{i}" for i in range(m)]]
    more = [] if k else [F.sum(F.greatest("_d", F.lit(0.0))).alias("_up"), F.sum(F.col("_d") * F.col("_d")).alias("_q")]
    bins = long.groupBy("_node", "_f", "b").agg(*sums, *more, F.min("x").alias("_lo"), F.max("x").alias("_hi"),
                                               F.min("_y").alias("_ylo"), F.max("_y").alias("_yhi"))
    at = span.orderBy("b")
    run = at.rowsBetween(Window.unboundedPreceding, 0)
    bins = bins.select("*", F.lead("_lo").over(at).alias("_next"), *[F.sum(c).over(run).alias("_l" + c[2:]) for c in cols],
                       *[F.sum(c).over(span).alias("_t" + c[2:]) for c in cols],
                       *([] if k else [F.sum("_q").over(span).alias("_tq")]))
    n, nl = F.col("_t"), F.col("_l")
    pick = [(F.col(f"_l{i}"), F.col(f"_t{i}")) for i in range(m)]
    scale = F.lit(1.0) if k else F.col("_tq") / n - (F.col("_t0") / n) * (F.col("_t0") / n)

    def rank(nl: Column) -> Column:
        nr = n - nl
        parts = (sum((c * c for c, _ in pick), F.lit(0.0)) / nl + sum(((t - c) * (t - c) for c, t in pick), F.lit(0.0)) / nr
                 - sum((t * t for _, t in pick), F.lit(0.0)) / n) / n
        return F.when(scale > 0, F.round(parts / scale, 12) + 0.0).otherwise(F.lit(0.0))

    most = F.lit(0.0)
    first, final = nl - F.col("_c") + 1, nl - 1
    for i, (c, t) in enumerate(pick):
        share = t / n
        start = c - F.col(f"_c{i}") - (nl - F.col("_c")) * share
        if k:
            low = start - share * (F.col("_c") - F.col(f"_c{i}"))
            high = start + (1 - share) * F.col(f"_c{i}")
        else:
            low = start + F.col("_c0") - F.col("_up") - F.greatest(share * F.col("_c"), F.lit(0.0))
            high = start + F.col("_up") - F.least(share * F.col("_c"), F.lit(0.0))
        most = most + F.greatest(low * low, high * high)
    bound = F.when(scale > 0, most / F.least(first * (n - first), final * (n - final)) / scale).otherwise(F.lit(0.0))
    middle = (F.col("_hi") + F.col("_next")) / 2
    keep = ["_node", "_f", "b", "_c", "_next", *[f"_l{c[2:]}" for c in cols], *[f"_t{c[2:]}" for c in cols], *cols[1:]]
    bins = cut_lineage(bins.select(
        *keep, *([] if k else ["_tq"]), "_ylo", "_yhi", F.when(F.col("_lo") < F.col("_hi"), bound).alias("_bound"),
        F.when(F.col("_next").isNotNull(), rank(nl)).alias("_rank"),
        F.when(middle < F.col("_next"), middle).otherwise(F.col("_hi")).alias("_cut")))
    left = F.array(nl, *([] if k else [F.col("_l0"), F.col("_t0") - F.col("_l0")]))

    def best(of: DataFrame, *others: Column) -> dict:
        found = F.max(F.when(F.col("_rank").isNotNull(), F.struct("_rank", -F.col("_f"), -F.col("_cut"), left)))
        return {r[0]: r[1:] for r in of.groupBy("_node").agg(found, *others).collect()}

    totals = F.max(F.array(*[F.col("_t" + c[2:]) for c in cols]))
    whole = best(bins, totals, F.min("_ylo"), F.max("_yhi"))
    ends, tops = {}, {}
    for node in live:
        top, total, lo, hi = whole[node.id]
        value = float(np.argmax(total[1:])) if k else node.mean + total[1] / total[0]
        ends[node.id] = lo if lo == hi else value
        if lo != hi and not last:
            tops[node.id] = top
    least = _by_node(live, F.col("_node"), {i: F.lit(float("-inf") if t is None else t[0] - 1e-11) for i, t in tops.items()})
    keys, known = ["_node", "_f", "b"], [*["_t" + c[2:] for c in cols], *([] if k else ["_tq"])]
    marked = bins.where(F.col("_bound") >= least).select(
        *keys, *known, *[(F.col("_l" + c[2:]) - F.col(c)).alias("_s" + c[2:]) for c in cols])
    n_marked = len(live) * width * MAX_BINS  # at most; they are counted only where that is too many
    if n_marked > BROADCAST_MAX_ROWS:
        n_marked = marked.count()
    if tops and n_marked:
        starts = ["_s" + c[2:] for c in cols]
        values = long.join(broadcast_if_small(marked, n_marked), keys).groupBy(*keys, *known, *starts, "x").agg(*sums)
        at = Window.partitionBy(*keys).orderBy("x")
        run = at.rowsBetween(Window.unboundedPreceding, 0)
        values = values.select(*keys, *known, "x", F.lead("x").over(at).alias("_next"),
                               *[(F.col("_s" + c[2:]) + F.sum(c).over(run)).alias("_l" + c[2:]) for c in cols]).where("_next IS NOT NULL")
        middle = (F.col("x") + F.col("_next")) / 2
        values = values.select("*", rank(nl).alias("_rank"), F.when(middle < F.col("_next"), middle).otherwise(F.col("x")).alias("_cut"))
        for i, (found,) in best(values).items():
            tops[i] = max(filter(None, (tops[i], found)), key=lambda r: r[:3])
    splits = {i: (-t[1], -t[2], [int(t[3][0]), *(t[3][1:] or [0.0, 0.0])]) for i, t in tops.items() if t is not None}
    return {i: v for i, v in ends.items() if i not in splits}, splits


def cart_classify(df: DataFrame, features: list[str], label: str, max_depth: int | None = None) -> DataFrame:
    """Gini tree; adds ``prediction``."""
    return fit_cart(df, features, label, "gini", max_depth).predict(df)


def cart_regress(df: DataFrame, features: list[str], label: str, max_depth: int | None = None) -> DataFrame:
    """Squared-error tree; adds ``prediction``."""
    return fit_cart(df, features, label, "squared_error", max_depth).predict(df)


def _candidates(long: DataFrame, keys: list[str], label: str, labels) -> DataFrame:
    """Every threshold of each key group of (keys, x, label): threshold, gain, n_left, n_right, and ``_rank``, the gain to
    12 decimals.  ``labels``: the classes (Gini), or None for squared error (ranked by its share of the group's variance)."""
    y = F.col(label)
    if labels is None:
        mean = long.agg(F.avg(label)).first()[0] or 0.0
        stats = [F.count("*"), F.sum(y - mean), F.sum((y - mean) * (y - mean))]
    else:
        stats = [F.count_if(y == F.lit(v)) for v in labels]
    k = len(stats)
    per_value = cut_lineage(long.groupBy(*keys, "x").agg(*[c.alias(f"_c{i}") for i, c in enumerate(stats)]))
    most = per_value.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    blocks = max(1, math.ceil(most / MAX_VALUES_PER_TASK))
    if blocks > 1:
        probs = [i / blocks for i in range(1, blocks)]
        cuts, n_cuts = materialize_small(per_value.groupBy(*keys).agg(
            F.percentile_approx("x", probs, 10000).alias("_cuts")))
        pv = per_value.join(broadcast_if_small(cuts, n_cuts), keys).withColumn(
            "_blk", F.size(F.filter("_cuts", lambda c: c < F.col("x")))).drop("_cuts")
    else:
        pv = per_value.withColumn("_blk", F.lit(0))
    bt = pv.groupBy(*keys, "_blk").agg(*[F.sum(f"_c{i}").alias(f"_b{i}") for i in range(k)],
                                       F.min("x").alias("_bmin"))
    wb = Window.partitionBy(*keys).orderBy("_blk")
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    bt = bt.select(*keys, "_blk", F.lead("_bmin").over(wb).alias("_nextmin"),
                   *[F.coalesce(F.sum(f"_b{i}").over(before), F.lit(0)).alias(f"_o{i}") for i in range(k)],
                   *[F.sum(f"_b{i}").over(whole).alias(f"_t{i}") for i in range(k)])
    bt, n_bt = materialize_small(bt)
    cum = pv.join(broadcast_if_small(bt, n_bt), [*keys, "_blk"])
    w = Window.partitionBy(*keys, "_blk").orderBy("x")
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    for i in range(k):
        cum = cum.withColumn(f"_l{i}", F.sum(f"_c{i}").over(running) + F.col(f"_o{i}"))
    cum = cum.withColumn("_next", F.coalesce(F.lead("x").over(w), F.col("_nextmin")))
    left = [F.col(f"_l{i}") for i in range(k)]
    total = [F.col(f"_t{i}") for i in range(k)]
    right = [t - c for t, c in zip(total, left)]
    if labels is None:
        nl, n, nr = left[0], total[0], right[0]
        gain = (left[1] * left[1] / nl + right[1] * right[1] / nr - total[1] * total[1] / n) / n
        variance = total[2] / n - (total[1] / n) * (total[1] / n)
        rank = F.when(variance > 0, gain / variance).otherwise(F.lit(0.0))
    else:
        nl = sum(left, F.lit(0))
        n = sum(total, F.lit(0))
        nr = n - nl

        def gini(counts, of):
            return F.lit(1.0) - sum(((c / of) * (c / of) for c in counts), F.lit(0.0))

        gain = rank = gini(total, n) - (nl * gini(left, nl) + nr * gini(right, nr)) / n
    mid = (F.col("x") + F.col("_next")) / 2
    return cum.where(F.col("_next").isNotNull()).select(
        *keys, F.when(mid < F.col("_next"), mid).otherwise(F.col("x")).alias("threshold"), gain.alias("gain"),
        nl.alias("n_left"), nr.alias("n_right"), F.round(rank, 12).alias("_rank"))


def best_threshold_split(df: DataFrame, features: list[str], label: str, criterion: str = "gini") -> DataFrame:
    """Per numeric feature, the best threshold ``x <= t`` (midpoint of two
    consecutive distinct values) by Gini or squared error: feature, threshold, gain, n_left, n_right.

    Ties go to the smallest threshold.  Cumulative label statistics over the
    sorted distinct values are a two-level prefix sum: distinct values are cut
    into blocks of at most MAX_VALUES_PER_TASK (approximate quantile cut
    points), block offsets come from a window over the few block totals, and
    the within-block windows run in parallel -- no task sorts a whole feature.
    With Gini the label set (the classes) is read first; it bounds the count vectors.
    """
    if criterion not in ("gini", "squared_error"):
        raise ValueError(f"unknown criterion {criterion!r}")
    y, labels = F.col(label).cast("double"), None
    if criterion == "gini":
        y = F.col(label)
        labels = [r[0] for r in df.select(label).distinct().where(F.col(label).isNotNull()).orderBy(label).collect()]
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features])
    long = df.select(y.alias("y"), F.explode(pairs).alias("_p")).select("_p.feature", "_p.x", "y")
    long = long.where(F.col("x").isNotNull() & ~F.isnan("x") & F.col("y").isNotNull())
    best = _candidates(long, ["feature"], "y", labels).groupBy("feature").agg(
        F.max_by(F.struct("threshold", "gain", "n_left", "n_right"), F.struct("_rank", -F.col("threshold"))).alias("b"))
    return best.select("feature", "b.*")

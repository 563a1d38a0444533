"""Threshold trees (M12-M14) against a brute-force tree, in one task and split level by level."""

import random
import threading
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from sylvan.operators import cart
from sylvan.operators.cart_search import split_large
from sylvan.plans import QUERIES
from sylvan.session import cut_lineage
from sylvan.sources.tables import table

from .conftest import SF001


def _loss(ys, gini):
    n = len(ys)
    if gini:
        return n - sum(Fraction(ys.count(v) ** 2, n) for v in set(ys))
    return sum(Fraction(v) ** 2 for v in ys) - Fraction(sum(ys)) ** 2 / n


def _best(rows, f, gini):
    """(loss after, feature, threshold) of the feature's best split, the smallest threshold first."""
    values = sorted({x[f] for x, _ in rows})
    cuts = [(a + b) / 2 for a, b in zip(values, values[1:])]
    return min(((sum(_loss([y for x, y in rows if (x[f] <= t) == side], gini) for side in (True, False)), f, t) for t in cuts),
               default=None)


def _brute(rows, gini, depth=None):
    ys = [y for _, y in rows]
    best = min(filter(None, (_best(rows, f, gini) for f in range(len(rows[0][0])))), default=None)
    if len(set(ys)) == 1 or best is None or depth == 0:
        value = max(sorted(set(ys)), key=ys.count) if gini else sum(ys) / len(ys)
        return lambda x: value
    _, f, t = best
    left, right = (_brute([r for r in rows if (r[0][f] <= t) == side], gini, None if depth is None else depth - 1)
                   for side in (True, False))
    return lambda x: left(x) if x[f] <= t else right(x)


def _data(n, gini):
    rnd = random.Random(5)
    rows = [((rnd.randrange(12), rnd.randrange(30) / 4, 1), rnd.choice("RAN") if gini else rnd.randrange(40) / 8) for _ in range(n)]
    return rows, [(rnd.randrange(-1, 13), rnd.randrange(-1, 31) / 4, 1) for _ in range(40)]


@pytest.mark.parametrize("per_task", [1_000_000, 60])
@pytest.mark.parametrize("gini, depth", [(True, None), (False, None), (True, 3)])
def test_exact_trees(spark, monkeypatch, per_task, gini, depth):
    monkeypatch.setattr(cart, "MAX_VALUES_PER_TASK", per_task)
    monkeypatch.setattr(cart, "MAX_ROWS_PER_TASK", per_task // 3)
    rows, new = _data(90, gini)
    df = spark.createDataFrame([(*map(float, x), y) for x, y in rows], f"a double, b double, c double, y {'string' if gini else 'double'}")
    model = cart.fit_cart(df, ["a", "b", "c"], "y", "gini" if gini else "squared_error", depth)
    assert bool(model.levels) == (per_task == 60)
    points = [x for x, _ in rows] + new
    got = model.predict(spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(points)], "i int, a double, b double, c double"))
    got = {r["i"]: r["prediction"] for r in got.collect()}
    want = _brute(rows, gini, depth)
    assert len(got) == len(points)
    assert all(got[i] == (want(x) if gini else pytest.approx(want(x), abs=1e-12)) for i, x in enumerate(points))


@pytest.mark.parametrize("gini", [True, False])
def test_bins_of_several_values_are_searched_exactly(spark, monkeypatch, gini):
    monkeypatch.setattr(cart, "MAX_ROWS_PER_TASK", 12)
    monkeypatch.setattr(cart, "MAX_BINS", 4)
    rows, _ = _data(70, gini)
    df = spark.createDataFrame([(*map(float, x), y) for x, y in rows], f"a double, b double, c double, y {'string' if gini else 'double'}")
    model = cart.fit_cart(df, ["a", "b", "c"], "y", "gini" if gini else "squared_error")
    want = _brute(rows, gini)
    assert model.levels > 1
    assert all(r["prediction"] == (want((r["a"], r["b"], r["c"])) if gini else pytest.approx(want((r["a"], r["b"], r["c"])), abs=1e-12))
               for r in model.predict(df).collect())


def test_levels_of_large_nodes_write_no_rows_and_add_no_joins(spark, monkeypatch):
    monkeypatch.setattr(cart, "MAX_ROWS_PER_TASK", 30)
    written = []
    monkeypatch.setattr(cart, "cut_lineage", lambda df: written.append(df.columns) or cut_lineage(df))
    # every label is a run of its own at the low end, so each level cuts a thin end off
    df = spark.createDataFrame([(float(i), 2.0 ** max(0, 8 - i)) for i in range(40)], "x double, y double")
    model = cart.fit_cart(df, ["x"], "y", "squared_error")
    assert model.levels > 4
    assert sum("_x" in columns for columns in written) == 2  # the rows, and the rows with their bins
    assert model.predict(df)._jdf.queryExecution().analyzed().toString().count("Join") <= 2
    assert [r["prediction"] == r["y"] for r in model.predict(df).collect()] == [True] * 40


def test_levels_of_large_class_nodes_take_no_jobs(spark, monkeypatch):
    monkeypatch.setattr(cart, "MAX_ROWS_PER_TASK", 10)
    # each level cuts a thin end off
    df = cut_lineage(spark.createDataFrame([(float(i), "ABC"[i % 3]) for i in range(40)], "x double, y string"))
    tracker, jobs, levels = spark.sparkContext.statusTracker(), [], []
    for depth in (1, None):
        spark.sparkContext.setJobGroup(group := f"cart-{depth}", "")
        model = cart.fit_cart(df, ["x"], "y", "gini", depth)
        spark.sparkContext.setJobGroup("none", "")
        jobs.append(len(tracker.getJobIdsForGroup(group)))
        levels.append(model.levels)
    assert levels[1] > levels[0] + 3
    assert abs(jobs[1] - jobs[0]) <= 4  # with adaptive execution each shuffle is a job of its own
    assert model.predict(df).where("prediction <> y").count() == 0


@pytest.mark.parametrize("slots, folder", [(0, "file:/"), (2, "viewfs:/")])
def test_without_tasks_that_run_together_or_a_folder_they_share(spark, monkeypatch, slots, folder):
    monkeypatch.setattr(cart, "MAX_ROWS_PER_TASK", 20)
    monkeypatch.setattr(cart, "_slots", lambda _: slots)
    path = cart.scratch_path
    monkeypatch.setattr(cart, "scratch_path", lambda spark, name: path(spark, name).replace("file:/", folder if name == "cart-parts" else "file:/"))
    rows, new = _data(60, True)
    df = spark.createDataFrame([(*map(float, x), y) for x, y in rows], "a double, b double, c double, y string")
    model = cart.fit_cart(df, ["a", "b"], "y", "gini", 2)
    want = _brute([(x[:2], y) for x, y in rows], True, 2)
    assert model.levels
    assert all(r["prediction"] == want((r["a"], r["b"])) for r in model.predict(df).collect())


@pytest.mark.parametrize("max_bins", [3, 64])
@pytest.mark.parametrize("limit", [7, 40])
def test_tasks_with_shares_of_the_rows_take_the_splits_of_one(max_bins, limit):
    rnd = np.random.default_rng(3)
    n, k, tasks = 400, 3, 3
    x = np.column_stack([np.round(rnd.normal(size=n), 2), rnd.integers(0, 9, n), np.where(rnd.random(n) < 0.5, 7.0, rnd.random(n))])
    y = ((x[:, 0] > 0.3) + (rnd.random(n) < 0.2) * rnd.integers(0, 3, n)) % k
    share, parts, meet = rnd.integers(0, tasks - 1, n), [None] * tasks, threading.Barrier(tasks, timeout=60)  # the last task has no rows
    found = [None] * tasks

    def gather(i):
        def exchange(part):
            parts[i] = part
            meet.wait()
            out = list(parts)
            meet.wait()
            return out
        return exchange

    def run(i):
        own = share == i
        found[i] = split_large([v.copy() for v in x[own].T], y[own].astype(np.int64), k, limit, max_bins, None, gather(i))

    threads = [threading.Thread(target=run, args=(i,)) for i in range(tasks)]
    [t.start() for t in threads], [t.join() for t in threads]
    tree = found[0][0]
    assert all(f[0] == tree and f[1] == found[0][1] for f in found)
    whole = cart.grow(x, y.astype(float), k)
    at = [(0, 0)]
    while at:
        i, j = at.pop()
        if tree["feature"][i] >= 0:
            assert (tree["feature"][i], tree["threshold"][i]) == (whole["feature"][j], whole["threshold"][j])
            at += [(tree["left"][i] + side, whole["left"][j] + side) for side in (0, 1)]
        else:
            assert tree["n"][i] == sum((f[2] == i).sum() for f in found)
            assert tree["n"][i] <= limit or found[0][1][i] == whole["value"][j] and whole["feature"][j] < 0


def test_a_task_splits_its_large_nodes_by_bins_to_the_same_tree(monkeypatch):
    rows, new = _data(90, True)
    x, y = np.array([x for x, _ in rows], float), np.array(["ANR".index(y) for _, y in rows], float)
    want = _brute([(p, float("ANR".index(v))) for p, v in rows], True)
    monkeypatch.setattr(cart, "LARGE_IN_TASK", 20)
    tree = cart.grow(x, y, 3)
    points = np.array([p for p, _ in rows] + new, float)
    assert cart.descend(tree, points).tolist() == [want(p) for p in points.tolist()]


@pytest.mark.parametrize("gini", [True, False])
@pytest.mark.parametrize("per_task", [1_000_000, 7])
def test_best_threshold_split(spark, monkeypatch, gini, per_task):
    monkeypatch.setattr(cart, "MAX_VALUES_PER_TASK", per_task)
    rows, _ = _data(90, gini)
    df = spark.createDataFrame([(*map(float, x), y) for x, y in rows], f"a double, b double, c double, y {'string' if gini else 'double'}")
    got = {r["feature"]: r for r in cart.best_threshold_split(df, ["a", "b", "c"], "y", "gini" if gini else "squared_error").collect()}
    assert set(got) == {"a", "b"}
    for f, name in enumerate("ab"):
        loss, _, t = _best(rows, f, gini)
        assert got[name]["threshold"] == t and got[name]["n_left"] == sum(x[f] <= t for x, _ in rows)
        assert got[name]["gain"] == pytest.approx(float(_loss([y for _, y in rows], gini) - loss) / len(rows), abs=1e-12)


def test_missing_values_and_empty_tables_raise(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (float("nan"), "b")], "x double, y string")
    with pytest.raises(ValueError):
        cart.cart_classify(df, ["x"], "y")
    with pytest.raises(ValueError):
        cart.cart_classify(df.where("false"), ["x"], "y")


def test_unlimited_tree_learns_every_distinct_row(spark):
    features = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    li = table(spark, SF001, "lineitem")
    sure = li.groupBy(*features).agg(F.min("l_returnflag").alias("lo"), F.max("l_returnflag").alias("hi")).where("lo = hi")
    keys = [c for c in QUERIES["cart_classify"](spark, SF001).columns if c != "prediction"]
    own = li.join(sure, features).select(*keys, "l_returnflag").join(QUERIES["cart_classify"](spark, SF001), keys)
    assert own.count() > 0 and own.where("prediction <> l_returnflag").count() == 0

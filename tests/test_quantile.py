"""Exact quantiles by rank lookup equal Spark's exact percentile, whatever the partitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sylvan.operators import eda
from sylvan.operators.quantile import RankIndex, exact_quantiles
from sylvan.sources.tables import table

from .conftest import SF001


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_lookup_matches_percentile(spark, monkeypatch, partitions):
    # 40 partitions: every group spans many, and some are empty
    real = type(spark.range(0)).repartitionByRange
    monkeypatch.setattr(type(spark.range(0)), "repartitionByRange", lambda self, *cols: real(self, partitions, *cols))
    li = table(spark, SF001, "lineitem")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    ref = {r[0]: r[1] for r in li.groupBy("l_returnflag").agg(
        F.percentile("l_extendedprice", F.array(*[F.lit(p) for p in probs]))).collect()}
    got = exact_quantiles(li, ["l_returnflag"], "l_extendedprice", probs).collect()
    assert len(got) == len(ref)
    for r in got:
        assert [r[f"q{i}"] for i in range(5)] == pytest.approx(ref[r["l_returnflag"]], abs=1e-9)
    whole = RankIndex(li, [], "l_extendedprice").median_deviation().first()
    y = np.array([r[0] for r in li.select("l_extendedprice").collect()])
    assert (whole["N"], whole["median"]) == (len(y), np.median(y))
    assert whole["AD"] == pytest.approx(np.abs(y - np.median(y)).sum(), rel=1e-12)


def test_weighted_ties_and_null_keys(spark):
    li = table(spark, SF001, "lineitem").withColumn(
        "g", F.when(F.col("l_returnflag") == "A", None).otherwise(F.col("l_returnflag")))
    cells = li.groupBy("g", "l_quantity").count()
    got = {r["g"]: r["q0"] for r in exact_quantiles(cells, ["g"], "l_quantity", [0.5], weight="count").collect()}
    ref = {r[0]: r[1] for r in li.groupBy("g").agg(F.median("l_quantity")).collect()}
    assert got == pytest.approx(ref)


def test_heavy_ties_and_extreme_values(spark):
    ties = spark.range(3000).selectExpr("'g' AS g", "CASE WHEN id < 2500 THEN 7.0D ELSE CAST(id % 50 AS DOUBLE) END AS v")
    got = exact_quantiles(ties, ["g"], "v", [0.0, 0.5, 1.0]).first()
    assert (got["q0"], got["q1"], got["q2"]) == (0.0, 7.0, 49.0)
    values = [float("-inf"), -1.7e308, -1e-320, 0.0, 5e-324, 1e-300, 1.0, 1.7e308, float("inf")] * 3
    df = spark.createDataFrame([("g", v) for v in [*values, None, float("nan")]], "g string, v double")
    got = exact_quantiles(df, ["g"], "v", [0.0, 0.5, 1.0]).first()
    want = sorted(values)
    assert (got["q0"], got["q1"], got["q2"]) == (want[0], want[13], want[-1])
    assert exact_quantiles(df.where("v > 5 AND v < 6"), ["g"], "v", [0.5]).count() == 0


def test_box_plot_of_null_groups_and_one_value(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (None, 3.0), (None, 100.0), ("a", 5.0), ("b", None)], "g string, v double")
    got = {r["group"]: r for r in eda.boxplot_stats(df, "v", "g").collect()}
    assert set(got) == {None, "a"}
    assert (got[None]["n"], got[None]["median"], got[None]["whisker_hi"], got[None]["n_outliers"]) == (4, 2.5, 3.0, 1)
    assert (got["a"]["q1"], got["a"]["q3"], got["a"]["n_outliers"]) == (5.0, 5.0, 0)


def test_histogram_shuffles_a_row_per_task_and_column(spark):
    df = spark.createDataFrame([(1.0, None, 2.0), (float("nan"), None, 2.0), (3.0, None, 2.0), (float("inf"), None, None)],
                               "a double, b double, c double")
    got = {(r["feature"], r["bin"]): r["n"] for r in eda.histogram(df, ["a", "b", "c"], 2).collect()}
    assert got == {("a", 1): 1, ("a", 2): 1, ("c", 1): 3, ("c", 2): 0}
    assert eda.histogram(df.where("false"), ["a"], 2).count() == 0


def test_wide_correlation_equals_the_narrow_one(spark):
    rng = np.random.default_rng(1)
    rows = [[None if rng.random() < 0.2 else float(rng.normal(1e6, 1)) for _ in range(6)] + [3.0, float(i)] for i in range(300)]
    rows[7][0] = float("nan")
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(8))).repartition(5)
    narrow, wide = ({(r["col_i"], r["col_j"]): r["r"] for r in eda.correlation_matrix(df, df.columns, wide=w).collect()} for w in (30, 1))
    assert narrow[("c1", "c6")] is None and wide[("c1", "c6")] is None  # a constant column
    assert narrow.keys() == wide.keys()
    assert all(wide[k] == pytest.approx(v, abs=1e-9, nan_ok=True) for k, v in narrow.items() if v is not None and "c6" not in k)
    assert wide[("c1", "c2")] == pytest.approx(df.where("c1 IS NOT NULL AND c2 IS NOT NULL").toPandas()[["c1", "c2"]].corr().iloc[0, 1], abs=1e-9)

"""Hot keys: one class holding about a third of all rows stays exact and distributed."""

import math

import pytest
from pyspark.sql import functions as F

from sylvan.operators import sampling
from sylvan.operators.impurity import column_impurity
from sylvan.operators.quantile import exact_quantiles
from sylvan.sources.tables import table

from .conftest import SF001

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@pytest.fixture(scope="module")
def skewed(spark):
    li = table(spark, SF001, "lineitem")
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit("HOT")).otherwise(F.col("l_returnflag"))
    return li.withColumn("cls", hot)


def test_hot_class_is_a_third(skewed):
    share = skewed.where("cls = 'HOT'").count() / skewed.count()
    assert 0.25 < share < 0.42


def test_exact_split_on_hot_class(skewed):
    s = sampling.stratified_split(skewed.select(*KEYS, "cls"), "cls", KEYS, 0.2)
    for r in s.groupBy("cls").agg(F.count(F.lit(1)).alias("n"),
                                   F.count_if(F.col("split") == "test").alias("t")).collect():
        assert r["t"] == math.ceil(0.2 * r["n"])


def test_selection_on_hot_group_matches_percentile(skewed):
    ref = {r[0]: r[1] for r in skewed.groupBy("cls").agg(F.median("l_extendedprice")).collect()}
    got = exact_quantiles(skewed, ["cls"], "l_extendedprice", [0.5])
    for r in got.collect():
        assert r["q0"] == pytest.approx(ref[r["cls"]], abs=1e-9)


def test_mae_impurity_on_hot_group(skewed):
    got = {r["cls"]: r["impurity"] for r in column_impurity(skewed, "l_extendedprice", "mae", by=["cls"]).collect()}
    rows = skewed.select("cls", "l_extendedprice").collect()
    import numpy as np
    for c in got:
        y = np.array([r[1] for r in rows if r[0] == c])
        assert got[c] == pytest.approx(np.mean(np.abs(y - np.median(y))), rel=1e-9)


def test_quartiles_of_hot_and_other_groups(skewed):
    ref = {r[0]: r[1] for r in skewed.groupBy("cls").agg(
        F.percentile("l_extendedprice", F.array(F.lit(0.25), F.lit(0.75)))).collect()}
    got = exact_quantiles(skewed, ["cls"], "l_extendedprice", [0.25, 0.75])
    for r in got.collect():
        assert [r["q0"], r["q1"]] == pytest.approx(ref[r["cls"]], abs=1e-9)

"""Properties of seeded sampling and splits on driver tables."""

import math

from pyspark.sql import functions as F

from sylvan.operators import sampling
from sylvan.sources.tables import table

from .conftest import SF001

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def test_stratified_split_is_exact_and_disjoint(spark):
    li = table(spark, SF001, "lineitem").select(*KEYS, "l_returnflag")
    s = sampling.stratified_split(li, "l_returnflag", KEYS, 0.2)
    per = {r["l_returnflag"]: (r["n"], r["t"]) for r in s.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("split") == "test").alias("t")).collect()}
    for n, t in per.values():
        assert t == math.ceil(0.2 * n)
    assert s.count() == li.count()


def test_split_stable_under_repartition(spark):
    li = table(spark, SF001, "lineitem").select(*KEYS, "l_returnflag")
    a = sampling.stratified_split(li, "l_returnflag", KEYS, 0.2).where("split = 'test'").select(*KEYS)
    b = sampling.stratified_split(li.repartition(7), "l_returnflag", KEYS, 0.2).where("split = 'test'").select(*KEYS)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_balanced_sample_caps_each_class(spark):
    li = table(spark, SF001, "lineitem").select(*KEYS, "l_returnflag")
    s = sampling.balanced_sample(li, "l_returnflag", KEYS, n=100)
    counts = {r[0]: r[1] for r in s.groupBy("l_returnflag").count().collect()}
    full = {r[0]: r[1] for r in li.groupBy("l_returnflag").count().collect()}
    assert counts == {k: min(100, v) for k, v in full.items()}


def test_hash_split_share(spark):
    o = table(spark, SF001, "orders").select("o_orderkey")
    s = sampling.hash_split(o, ["o_orderkey"], 0.2)
    share = s.where("split = 'test'").count() / s.count()
    assert 0.15 < share < 0.25

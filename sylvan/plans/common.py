"""Shared derived inputs for the registered queries (Spark form + SQL form)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sylvan.functions.binning import bin_right_closed, bin_sql
from sylvan.sources.tables import table

R6 = 6  # decimals used on both sides of every oracle comparison

LI_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

# (source expression in SQL, Spark column, edges, labels)
LI_BINS = {
    "qty_bin": ("l_quantity", [0, 10, 20, 30, 40, 50], ["q1", "q2", "q3", "q4", "q5"]),
    "disc_bin": ("l_discount", [0, 0.02, 0.05, 0.08, 0.1], ["d1", "d2", "d3", "d4"]),
    "tax_bin": ("l_tax", [0, 0.02, 0.05, 0.08], ["t1", "t2", "t3"]),
}
LI_CLS_FEATURES = ["qty_bin", "disc_bin", "tax_bin", "l_linestatus"]
LI_REG_FEATURES = ["qty_bin", "disc_bin", "tax_bin", "l_returnflag"]

PART_BINS = {
    "size_bin": ("p_size", [0, 10, 20, 30, 40, 50], ["s1", "s2", "s3", "s4", "s5"]),
    "pk_bin": ("(p_partkey % 1000)", [0, 250, 500, 750, 1000], ["k1", "k2", "k3", "k4"]),
}
PART_FEATURES = ["size_bin", "pk_bin", "p_brand", "p_type"]


def _spark_bins(bins):
    out = []
    for name, (src, edges, labels) in bins.items():
        col = F.expr(src)
        out.append(bin_right_closed(col, edges, labels).alias(name))
    return out


def _sql_bins(bins):
    return ", ".join(f"{bin_sql(src, edges, labels)} AS {name}" for name, (src, edges, labels) in bins.items())


def lineitem_binned(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(*LI_KEYS, *_spark_bins(LI_BINS), "l_linestatus", "l_returnflag", "l_extendedprice")


LINEITEM_BINNED_SQL = (
    f"(SELECT {', '.join(LI_KEYS)}, {_sql_bins(LI_BINS)}, l_linestatus, l_returnflag, l_extendedprice "
    f"FROM lineitem)"
)


def part_binned(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", *_spark_bins(PART_BINS), "p_brand", "p_type", "p_retailprice")


PART_BINNED_SQL = (
    f"(SELECT p_partkey, {_sql_bins(PART_BINS)}, p_brand, p_type, p_retailprice FROM part)"
)


def r6(c):
    """Round a numeric column for oracle comparison and fold -0.0 into 0.0."""
    return F.round(F.col(c) if isinstance(c, str) else c, R6) + F.lit(0.0)

"""The reference's end-to-end tree demo as one chain of Spark operators.

player rows extracted from HTML list pages (H2-H4) -> value filter (P3) ->
right-closed bins (F6) -> balanced sample of at most 100 per class (G2) ->
multiway tree on an ordered categorical target (T1, A5 ties by category) ->
training accuracy (M1).  The list pages are rendered from ``customer`` rows,
so the oracle runs the same chain in SQL on the relational values.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sylvan.functions.binning import PLAYER_BINS, bin_right_closed, bin_sql
from sylvan.operators import html_extract as H
from sylvan.operators import metrics, sampling
from sylvan.operators.tree import fit_tree
from sylvan.plans import html_queries as HQ
from sylvan.plans.common import r6
from sylvan.plans.registry import register
from sylvan.plans.tree_sql import tree_sql
from sylvan.session import cut_lineage

# Category and column names of the player tables.
CATEGORIES = ["Low", "Medium", "High", "Elite"]
FEATURES = ["Age_Cat", "Potential_Cat", "Wage_Cat"]
TARGET = "Overall_Category"
_SOURCE = {"Age_Cat": ("age", "Age"), "Potential_Cat": ("potential", "Potential"),
           "Wage_Cat": ("wage_numeric", "Wage_Numeric"), TARGET: ("overall", "Overall")}


def player_training_rows(spark, sf):
    """The sampled training table: parsed and sampled once for all fits and scoring passes of a query."""
    rows = H.player_rows(HQ._list_els(spark, sf), ["page_no"])
    rows = rows.where(F.col("age").isNotNull() & F.col("overall").isNotNull() & F.col("potential").isNotNull()
                      & F.col("wage_numeric").isNotNull() & F.col("value_numeric").isNotNull())
    rows = rows.where(F.col("value_numeric") > 0)
    binned = rows.select("player_url", *[bin_right_closed(F.col(src), *PLAYER_BINS[b]).alias(name)
                                         for name, (src, b) in _SOURCE.items()])
    binned = binned.where(F.col(TARGET).isNotNull())
    return cut_lineage(sampling.balanced_sample(binned, TARGET, ["player_url"], n=100, seed=42))


def _fit(rows, criterion):
    return fit_tree(rows, FEATURES, TARGET, criterion, max_depth=4, order_by=["player_url"], label_order=CATEGORIES)


_PLAYERS_SQL = (
    "SELECT '/p/' || c_custkey AS player_url, c_nationkey + 17 AS age, 50 + c_custkey % 40 AS overall, "
    "55 + c_custkey % 40 AS potential, CAST(c_nationkey * 3 * 1000 AS DOUBLE) AS wage_numeric, "
    "CAST(((c_custkey % 100) + 0.5) * 1000000 AS DOUBLE) AS value_numeric FROM customer "
    f"WHERE c_custkey // {HQ.ROWS_PER_PAGE} NOT IN ({HQ._BAD_PAGES_SQL})"
)
_BINNED_SQL = (
    "SELECT player_url, " + ", ".join(f"{bin_sql(src, *PLAYER_BINS[b])} AS {name}"
                                      for name, (src, b) in _SOURCE.items())
    + f" FROM ({_PLAYERS_SQL}) WHERE value_numeric > 0"
)
_SAMPLE_SQL = (
    f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {TARGET} ORDER BY md5('42:' || player_url), "
    f"player_url) AS rn FROM ({_BINNED_SQL}) WHERE {TARGET} IS NOT NULL) WHERE rn <= 100)"
)


def _tree_sql(kind, output):
    return tree_sql(_SAMPLE_SQL, FEATURES, TARGET, kind, 4, keys=["player_url"], output=output,
                    label_order=CATEGORIES)


@register("player_balanced_sample",
          f"SELECT player_url, {', '.join(FEATURES)}, {TARGET} FROM {_SAMPLE_SQL}")
def player_balanced_sample(spark, sf):
    return player_training_rows(spark, sf).select("player_url", *FEATURES, TARGET)


def _nodes(criterion):
    def q(spark, sf):
        m = _fit(player_training_rows(spark, sf), criterion)
        return m.nodes.select("node_id", "depth", "split_feature", "is_leaf", "prediction", "n",
                              r6("impurity").alias("impurity"), r6("gain").alias("gain"))
    return q


register("player_tree_fit_ig", _tree_sql("entropy", "nodes"))(_nodes("information_gain"))
register("player_tree_fit_gini", _tree_sql("gini", "nodes"))(_nodes("gini"))


@register("player_tree_accuracy",
          " UNION ALL ".join(
              f"SELECT '{crit}' AS criterion, round(avg(CASE WHEN actual = prediction THEN 1.0 ELSE 0.0 END), 6) + 0.0 "
              f"AS accuracy, count(*) AS n FROM ({_tree_sql(kind, 'predict')})"
              for crit, kind in [("information_gain", "entropy"), ("gini", "gini")]))
def player_tree_accuracy(spark, sf):
    rows, out = player_training_rows(spark, sf), None
    for crit in ["information_gain", "gini"]:
        scored = _fit(rows, crit).predict(rows)
        acc = metrics.accuracy(scored, TARGET, "prediction").select(
            F.lit(crit).alias("criterion"), r6("accuracy").alias("accuracy"), "n")
        out = acc if out is None else out.unionByName(acc)
    return out


# --------------------------------------------------------------------------- regression twin

REG_FEATURES = ["Age", "Overall", "Potential", "Wage_Numeric"]
REG_TARGET = "Value_Million"
_REG_SOURCE = {"Age": "age", "Overall": "overall", "Potential": "potential", "Wage_Numeric": "wage_numeric"}


def player_regression_rows(spark, sf):
    """Value in millions; the four features binned in place; at most 100 rows per Overall bin."""
    rows = H.player_rows(HQ._list_els(spark, sf), ["page_no"])
    rows = rows.dropna(subset=["age", "overall", "potential", "wage_numeric", "value_numeric"])
    rows = rows.where(F.col("value_numeric") > 0)
    binned = rows.select("player_url", *[bin_right_closed(F.col(src), *PLAYER_BINS[name]).alias(name)
                                         for name, src in _REG_SOURCE.items()],
                         (F.col("value_numeric") / 1_000_000).alias(REG_TARGET))
    binned = binned.where(F.col("Overall").isNotNull())
    return cut_lineage(sampling.balanced_sample(binned, "Overall", ["player_url"], n=100, seed=42))


def _reg_fit(rows, criterion):
    return fit_tree(rows, REG_FEATURES, REG_TARGET, criterion, max_depth=3, order_by=["player_url"])


_REG_BINNED_SQL = (
    "SELECT player_url, " + ", ".join(f"{bin_sql('raw_' + src, *PLAYER_BINS[name])} AS {name}"
                                      for name, src in _REG_SOURCE.items())
    + f", raw_value_numeric / 1000000 AS {REG_TARGET} FROM ("
    + "SELECT player_url, age AS raw_age, overall AS raw_overall, potential AS raw_potential, "
    + f"wage_numeric AS raw_wage_numeric, value_numeric AS raw_value_numeric FROM ({_PLAYERS_SQL})) "
    + "WHERE raw_value_numeric > 0"
)
_REG_SAMPLE_SQL = (
    "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY Overall ORDER BY md5('42:' || player_url), "
    f"player_url) AS rn FROM ({_REG_BINNED_SQL}) WHERE Overall IS NOT NULL) WHERE rn <= 100)"
)


def _reg_tree_sql(kind, output):
    return tree_sql(_REG_SAMPLE_SQL, REG_FEATURES, REG_TARGET, kind, 3, keys=["player_url"], output=output)


def _reg_nodes(criterion):
    def q(spark, sf):
        m = _reg_fit(player_regression_rows(spark, sf), criterion)
        return m.nodes.select("node_id", "depth", "split_feature", "is_leaf", r6("prediction").alias("prediction"),
                              "n", r6("impurity").alias("impurity"), r6("gain").alias("gain"))
    return q


register("player_reg_tree_fit_mse", _reg_tree_sql("mse", "nodes"))(_reg_nodes("mse"))
register("player_reg_tree_fit_mae", _reg_tree_sql("mae", "nodes"))(_reg_nodes("mae"))

_SCORE_COLS = ["r2", "mse", "rmse", "mae", "mape"]


def _reg_scores_sql(crit, kind):
    p = f"({_reg_tree_sql(kind, 'predict')})"
    return (f"SELECT '{crit}' AS criterion, count(*) AS n, round(CASE WHEN var_pop(actual) = 0 THEN 0.0 ELSE "
            f"1 - sum((actual - prediction) ^ 2) / (var_pop(actual) * count(*)) END, 6) + 0.0 AS r2, "
            f"round(avg((actual - prediction) ^ 2), 6) + 0.0 AS mse, round(sqrt(avg((actual - prediction) ^ 2)), 6) + 0.0 AS rmse, "
            f"round(avg(abs(actual - prediction)), 6) + 0.0 AS mae, "
            f"round(avg(abs((actual - prediction) / actual)) * 100, 6) + 0.0 AS mape FROM {p}")


@register("player_reg_scores", " UNION ALL ".join(_reg_scores_sql(c, k) for c, k in [("mse", "mse"), ("mae", "mae")]))
def player_reg_scores(spark, sf):
    rows, out = player_regression_rows(spark, sf), None
    for crit in ["mse", "mae"]:
        scored = _reg_fit(rows, crit).predict(rows)
        s = metrics.regression_scores(scored, REG_TARGET, "prediction").select(
            F.lit(crit).alias("criterion"), "n", *[r6(c).alias(c) for c in _SCORE_COLS])
        out = s if out is None else out.unionByName(s)
    return out

"""Registered queries: impurity, split gain, trees, scoring (I, A5-A7, G1, T, M1-M7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sylvan.operators import metrics
from sylvan.operators.impurity import column_impurity, split_gains
from sylvan.operators.tree import fit_tree
from sylvan.plans.common import (
    LI_CLS_FEATURES,
    LI_KEYS,
    LI_REG_FEATURES,
    LINEITEM_BINNED_SQL,
    PART_BINNED_SQL,
    PART_FEATURES,
    lineitem_binned,
    part_binned,
    r6,
)
from sylvan.plans.registry import register
from sylvan.plans.tree_sql import tree_sql

# ---------------------------------------------------------------------------
# model specs
# ---------------------------------------------------------------------------

SPECS = {
    "cls_ig": dict(src="lineitem", features=LI_CLS_FEATURES, target="l_returnflag",
                   criterion="information_gain", max_depth=3, keys=LI_KEYS),
    "cls_gini": dict(src="lineitem", features=LI_CLS_FEATURES, target="l_returnflag",
                     criterion="gini", max_depth=3, keys=LI_KEYS),
    "reg_mse": dict(src="part", features=PART_FEATURES, target="p_retailprice",
                    criterion="mse", max_depth=3, keys=["p_partkey"]),
    "reg_mae": dict(src="part", features=PART_FEATURES, target="p_retailprice",
                    criterion="mae", max_depth=3, keys=["p_partkey"]),
    "li_mse": dict(src="lineitem", features=LI_REG_FEATURES, target="l_extendedprice",
                   criterion="mse", max_depth=3, keys=LI_KEYS),
}
KIND = {"information_gain": "entropy", "gini": "gini", "mse": "mse", "mae": "mae"}


def _src(spark, sf_dir, name):
    return lineitem_binned(spark, sf_dir) if name == "lineitem" else part_binned(spark, sf_dir)


def _src_sql(name):
    return LINEITEM_BINNED_SQL if name == "lineitem" else PART_BINNED_SQL


def model(spark, sf_dir, spec_name):
    """The spec's tree, fitted on the table as it is now."""
    s = SPECS[spec_name]
    return fit_tree(_src(spark, sf_dir, s["src"]), s["features"], s["target"], s["criterion"],
                    max_depth=s["max_depth"], order_by=s["keys"])


def _spec_sql(spec_name, output):
    s = SPECS[spec_name]
    return tree_sql(_src_sql(s["src"]), s["features"], s["target"], KIND[s["criterion"]], s["max_depth"],
                    keys=s["keys"], output=output)


def _nodes_query(spec_name, digits):
    def q(spark, sf_dir):
        m = model(spark, sf_dir, spec_name)
        pred = F.col("prediction") if m.kind in ("entropy", "gini") else r6("prediction")
        return m.nodes.select("node_id", "depth", "split_feature", "is_leaf", pred.alias("prediction"), "n",
                              (F.round("impurity", digits) + 0.0).alias("impurity"),
                              (F.round("gain", digits) + 0.0).alias("gain"))
    return q


def _nodes_sql(spec_name, digits):
    sql = _spec_sql(spec_name, "nodes")
    return sql.replace("round(d.imp, 6)", f"round(d.imp, {digits})").replace(
        "round(d.gain, 6)", f"round(d.gain, {digits})")


# Squared-price impurities reach ~1e9, so that tree is compared at 2 decimals
# (still ~1e-11 relative); everything else at 6.
for _name, _spec, _digits in [("tree_fit_cls_ig", "cls_ig", 6), ("tree_fit_cls_gini", "cls_gini", 6),
                              ("tree_fit_reg_mse", "reg_mse", 6), ("tree_fit_reg_mae", "reg_mae", 6),
                              ("tree_fit_lineitem_mse", "li_mse", 2)]:
    register(_name, _nodes_sql(_spec, _digits))(_nodes_query(_spec, _digits))


@register("tree_rules", _spec_sql("cls_ig", "rules"))
def tree_rules(spark, sf_dir):
    return model(spark, sf_dir, "cls_ig").rules()


def _predicted(spark, sf_dir, spec_name):
    s = SPECS[spec_name]
    m = model(spark, sf_dir, spec_name)
    return m.predict(_src(spark, sf_dir, s["src"])).withColumnRenamed(s["target"], "actual")


def _pred_sql(spec_name):
    return f"({_spec_sql(spec_name, 'predict')})"


@register("tree_predict_cls", f"SELECT {', '.join(LI_KEYS)}, actual, prediction FROM {_pred_sql('cls_ig')}")
def tree_predict_cls(spark, sf_dir):
    return _predicted(spark, sf_dir, "cls_ig").select(*LI_KEYS, "actual", "prediction")


@register("tree_predict_reg",
          f"SELECT p_partkey, round(actual, 6) + 0.0 AS actual, round(prediction, 6) + 0.0 AS prediction "
          f"FROM {_pred_sql('reg_mae')}")
def tree_predict_reg(spark, sf_dir):
    return _predicted(spark, sf_dir, "reg_mae").select(
        "p_partkey", r6("actual").alias("actual"), r6("prediction").alias("prediction"))


# T4: fit without the largest quantity bin; rows in that bin carry an unseen value
# and must follow each node's first-seen child.
_UNSEEN_SQL_BASE = f"(SELECT * FROM {LINEITEM_BINNED_SQL} WHERE qty_bin <> 'q5')"


@register("tree_predict_unseen",
          tree_sql(_UNSEEN_SQL_BASE, LI_CLS_FEATURES, "l_returnflag", "entropy", 2, keys=LI_KEYS, output="route",
                   route_base=f"(SELECT * FROM {LINEITEM_BINNED_SQL} WHERE qty_bin = 'q5')"))
def tree_predict_unseen(spark, sf_dir):
    li = lineitem_binned(spark, sf_dir)
    m = fit_tree(li.where(F.col("qty_bin") != "q5"), LI_CLS_FEATURES, "l_returnflag", "information_gain",
                 max_depth=2, order_by=LI_KEYS)
    return m.predict(li.where(F.col("qty_bin") == "q5")).select(*LI_KEYS, "prediction")


# ---------------------------------------------------------------------------
# scoring
# ---------------------------------------------------------------------------

@register("score_accuracy",
          f"SELECT round(avg(CASE WHEN actual = prediction THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS accuracy, "
          f"count(*) AS n FROM {_pred_sql('cls_ig')}")
def score_accuracy(spark, sf_dir):
    return metrics.accuracy(_predicted(spark, sf_dir, "cls_ig"), "actual", "prediction").select(
        r6("accuracy").alias("accuracy"), "n")


_REG_SQL = (
    "SELECT count(*) AS n, "
    "CASE WHEN var_pop(actual) = 0 THEN 0.0 ELSE 1 - sum((actual - prediction) ^ 2) / (var_pop(actual) * count(*)) END AS r2, "
    "avg((actual - prediction) ^ 2) AS mse, sqrt(avg((actual - prediction) ^ 2)) AS rmse, "
    "avg(abs(actual - prediction)) AS mae, "
    "avg(abs((actual - prediction) / CASE WHEN actual = 0 THEN NULL ELSE actual END)) * 100 AS mape "
    f"FROM {_pred_sql('reg_mse')}"
)


def _reg_scores(spark, sf_dir):
    return metrics.regression_scores(_predicted(spark, sf_dir, "reg_mse"), "actual", "prediction")


for _name, _cols in [("score_r2", ["r2"]), ("score_mse_rmse", ["mse", "rmse"]), ("score_mae", ["mae"]),
                     ("score_mape", ["mape"])]:
    def _q(spark, sf_dir, _cols=_cols):
        return _reg_scores(spark, sf_dir).select("n", *[r6(c).alias(c) for c in _cols])
    register(_name, "SELECT n, " + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in _cols)
             + f" FROM ({_REG_SQL})")(_q)


@register("confusion_matrix",
          f"SELECT actual, prediction AS predicted, count(*) AS n FROM {_pred_sql('cls_ig')} GROUP BY 1, 2")
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(_predicted(spark, sf_dir, "cls_ig"), "actual", "prediction")


_REPORT_SQL = f"""
WITH p AS {_pred_sql('cls_gini')},
labels AS (SELECT actual AS label FROM p UNION SELECT prediction FROM p),
per AS (
  SELECT l.label,
    (SELECT count(*) FROM p WHERE p.actual = l.label AND p.prediction = l.label) AS tp,
    (SELECT count(*) FROM p WHERE p.actual = l.label) AS support,
    (SELECT count(*) FROM p WHERE p.prediction = l.label) AS npred
  FROM labels l),
m AS (SELECT label, support, tp,
    CASE WHEN npred > 0 THEN tp / npred ELSE 0.0 END AS precision,
    CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM per),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM m),
c AS (SELECT * FROM f)
SELECT label, round(precision, 6) + 0.0 AS precision, round(recall, 6) + 0.0 AS recall, round(f1, 6) + 0.0 AS f1,
       CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6) + 0.0, CAST(sum(support) AS BIGINT) FROM c
UNION ALL SELECT 'macro avg', round(avg(precision), 6) + 0.0, round(avg(recall), 6) + 0.0, round(avg(f1), 6) + 0.0,
       CAST(sum(support) AS BIGINT) FROM c
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6) + 0.0,
       round(sum(recall * support) / sum(support), 6) + 0.0, round(sum(f1 * support) / sum(support), 6) + 0.0,
       CAST(sum(support) AS BIGINT) FROM c
"""


@register("classification_report", _REPORT_SQL)
def classification_report(spark, sf_dir):
    rep = metrics.classification_report(_predicted(spark, sf_dir, "cls_gini"), "actual", "prediction")
    return rep.select("label", r6("precision").alias("precision"), r6("recall").alias("recall"),
                      r6("f1").alias("f1"), F.col("support").cast("bigint").alias("support"))


# ---------------------------------------------------------------------------
# impurity and gains (I1-I8), best split (G1), group statistics
# ---------------------------------------------------------------------------

def _imp_sql(kind, by, target, base):
    if kind in ("entropy", "gini"):
        share = "(CAST(c AS DOUBLE) / nt)"
        imp = f"-sum({share} * log2({share}))" if kind == "entropy" else f"1 - sum({share} * {share})"
        return (f"SELECT {by}, CAST(max(nt) AS BIGINT) AS n, round({imp}, 6) + 0.0 AS impurity FROM ("
                f"SELECT {by}, c, sum(c) OVER (PARTITION BY {by}) AS nt FROM ("
                f"SELECT {by}, {target}, count(*) AS c FROM {base} GROUP BY {by}, {target})) GROUP BY {by}")
    if kind == "mse":
        return (f"SELECT {by}, count(*) AS n, round(var_pop({target}), 6) + 0.0 AS impurity "
                f"FROM {base} GROUP BY {by}")
    return (f"SELECT x.{by}, count(*) AS n, round(avg(abs(x.{target} - m.med)), 6) + 0.0 AS impurity "
            f"FROM {base} x JOIN (SELECT {by}, median({target}) AS med FROM {base} GROUP BY {by}) m "
            f"ON x.{by} = m.{by} GROUP BY x.{by}")


for _name, _kind, _by, _target, _src_name in [
    ("entropy", "entropy", "qty_bin", "l_returnflag", "lineitem"),
    ("gini", "gini", "qty_bin", "l_returnflag", "lineitem"),
    ("mse_impurity", "mse", "l_returnflag", "l_extendedprice", "lineitem"),
    ("mae_impurity", "mae", "l_returnflag", "l_extendedprice", "lineitem"),
]:
    def _q(spark, sf_dir, _kind=_kind, _by=_by, _target=_target, _src_name=_src_name):
        df = _src(spark, sf_dir, _src_name).where(F.col(_by).isNotNull())
        out = column_impurity(df, _target, _kind, by=[_by])
        return out.select(_by, "n", r6("impurity").alias("impurity"))
    register(_name, _imp_sql(_kind, _by, _target, f"(SELECT * FROM {_src_sql(_src_name)} WHERE {_by} IS NOT NULL)"))(_q)


def _gain_sql(spec_name, best=False):
    s = SPECS[spec_name]
    sql = tree_sql(_src_sql(s["src"]), s["features"], s["target"], KIND[s["criterion"]], 1,
                   keys=[], output="nodes")
    head = sql[: sql.rindex("\n")]
    names = " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(s["features"]))
    if best:
        return head + f"\nSELECT CASE best_f {names} END AS feature, round(best_gain, 6) + 0.0 AS gain FROM b0"
    return head + f"\nSELECT CASE f {names} END AS feature, round(gain, 6) + 0.0 AS gain FROM g0"


def _gains_query(spec_name):
    def q(spark, sf_dir):
        s = SPECS[spec_name]
        g = split_gains(_src(spark, sf_dir, s["src"]), s["features"], s["target"], s["criterion"])
        return g.select("feature", r6("gain").alias("gain"))
    return q


for _name, _spec in [("information_gain", "cls_ig"), ("gini_gain", "cls_gini"),
                     ("mse_reduction", "reg_mse"), ("mae_reduction", "reg_mae")]:
    register(_name, _gain_sql(_spec))(_gains_query(_spec))


def _best_query(spec_name):
    def q(spark, sf_dir):
        s = SPECS[spec_name]
        g = split_gains(_src(spark, sf_dir, s["src"]), s["features"], s["target"], s["criterion"])
        r = F.round("gain", 12)
        best = g.agg(F.max_by(F.struct("feature", "gain"), F.struct(r, -F.col("feature_idx"))).alias("b"))
        return best.select("b.feature", r6("b.gain").alias("gain"))
    return q


register("best_split_cls", _gain_sql("cls_ig", best=True))(_best_query("cls_ig"))
register("best_split_reg", _gain_sql("reg_mse", best=True))(_best_query("reg_mse"))


@register("majority_label",
          f"SELECT qty_bin, first(l_returnflag ORDER BY c DESC, l_returnflag) AS majority FROM ("
          f"SELECT qty_bin, l_returnflag, count(*) AS c FROM {LINEITEM_BINNED_SQL} GROUP BY 1, 2) GROUP BY qty_bin")
def majority_label(spark, sf_dir):
    from sylvan.operators.impurity import class_summary
    li = lineitem_binned(spark, sf_dir)
    frame = li.groupBy("qty_bin", F.col("l_returnflag").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    return class_summary(frame, ["qty_bin"]).select("qty_bin", "majority")


@register("leaf_mean",
          f"SELECT size_bin, round(avg(p_retailprice), 6) + 0.0 AS mean_value FROM {PART_BINNED_SQL} GROUP BY 1")
def leaf_mean(spark, sf_dir):
    return part_binned(spark, sf_dir).groupBy("size_bin").agg(r6(F.avg("p_retailprice")).alias("mean_value"))


@register("leaf_median",
          f"SELECT qty_bin, round(median(l_extendedprice), 6) + 0.0 AS median_value FROM {LINEITEM_BINNED_SQL} GROUP BY 1")
def leaf_median(spark, sf_dir):
    from sylvan.operators.quantile import exact_quantiles
    m = exact_quantiles(lineitem_binned(spark, sf_dir), ["qty_bin"], "l_extendedprice", [0.5])
    return m.select("qty_bin", r6("q0").alias("median_value"))

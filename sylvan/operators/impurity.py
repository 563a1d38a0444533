"""Impurity, split gain and best split.

All features of all nodes are scored in one grouped pass: the rows (or the
compacted cells of a tree level) are unpivoted to ``(node, f, v, target-stats)``
and rolled up (node, f, v) -> (node, f).  Every formula is a sum over groups,
so Spark runs partial (map-side) aggregation before each shuffle.

Summary statistics per group:
  classification  N, S = sum c*log2(c), Q = sum c^2, majority label, #labels
                  entropy = log2 N - S/N ;  gini = 1 - Q/N^2
  mse             N, mean, M2 = sum m2 + sum s^2/n - S^2/N over mean-centred
                  cell sums (one pass, no window);  mse = M2/N
  mae             N, exact median and AD = sum |y - median| from one rank
                  lookup (``quantile.RankIndex``);  mae = AD/N
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.operators.quantile import RankIndex
from sylvan.session import cut_lineage

CLASSIFICATION = {"information_gain": "entropy", "entropy": "entropy", "gini": "gini"}
REGRESSION = {"mse": "mse", "mae": "mae"}

# Gains are rounded before the arg-max: distributed sums differ in the last bits.
GAIN_DECIMALS = 12


def impurity_kind(criterion: str) -> str:
    """Map a criterion name to entropy / gini / mse / mae; unknown names raise."""
    c = criterion.lower()
    if c in CLASSIFICATION:
        return CLASSIFICATION[c]
    if c in REGRESSION:
        return REGRESSION[c]
    raise ValueError(f"unknown criterion {criterion!r}; use one of "
                     f"{sorted(CLASSIFICATION) + sorted(REGRESSION)}")


# --------------------------------------------------------------------------
# group summaries over weighted frames
# --------------------------------------------------------------------------

def class_summary(frame: DataFrame, keys: list[str], label: str = "y", count: str = "n",
                  label_order: list | None = None) -> DataFrame:
    """``frame(keys.., label, count)`` -> per key: N, S, Q, majority, n_labels.

    Majority ties go to the smallest label (pandas ``mode()[0]``); for an
    ordered categorical label pass ``label_order`` (lowest category first) and
    ties go to the lowest category instead.
    """
    per_label = frame.groupBy(*keys, label).agg(F.sum(count).alias("_c"))
    if label_order:
        rank = F.array_position(F.array(*[F.lit(v) for v in label_order]), F.col(label))
    else:
        rank = F.col(label)
    return per_label.groupBy(*keys).agg(
        F.sum("_c").alias("N"),
        F.sum(F.col("_c") * F.log2("_c")).alias("S"),
        F.sum(F.col("_c") * F.col("_c")).alias("Q"),
        F.min_by(label, F.struct((-F.col("_c")).alias("k"), rank.alias("l"))).alias("majority"),
        F.count(F.lit(1)).alias("n_labels"),
    )


def center_mse_cells(cells: DataFrame) -> DataFrame:
    """Shift the cells' sums by the overall mean ``c`` (kept in column ``_c``).

    Variance is shift-invariant; centring keeps the one-pass merge in
    ``mse_summary`` free of cancellation even when |mean| >> std.  ``cells``
    should be materialised (``c`` is one small aggregate over them).
    """
    c = cells.agg((F.sum("s") / F.sum("n")).alias("c")).first()["c"] or 0.0
    return cells.withColumn("s", F.col("s") - F.col("n") * F.lit(c)).withColumn("_c", F.lit(float(c)))


def mse_summary(frame: DataFrame, keys: list[str]) -> DataFrame:
    """``frame(keys.., n, s, m2, ymin, ymax, _c)`` -> per key: N, mean, M2, ymin, ymax.

    ``s`` are sums centred by ``_c`` (``center_mse_cells``).  M2 merges in one
    pass, M2 = sum(m2_i) + sum(s_i^2 / n_i) - S^2 / N, so every term is a plain
    sum (partial aggregation, no per-group window or buffer).
    """
    agg = frame.groupBy(*keys).agg(
        F.sum("n").alias("N"), F.sum("s").alias("_S"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("_Q"),
        F.sum("m2").alias("_W"), F.max("_c").alias("_c"), F.min("ymin").alias("ymin"), F.max("ymax").alias("ymax"))
    m2 = F.greatest(F.col("_W") + F.col("_Q") - F.col("_S") * F.col("_S") / F.col("N"), F.lit(0.0))
    return agg.select(*keys, "N", (F.col("_S") / F.col("N") + F.col("_c")).alias("mean"), m2.alias("M2"),
                      "ymin", "ymax")


def mae_summary(frame: DataFrame, keys: list[str], y: str = "y", count: str = "n") -> DataFrame:
    """``frame(keys.., y, n)`` -> per key: N, median (exact), AD, ymin, ymax, all from one rank index."""
    return RankIndex(frame, keys, y, weight=count).median_deviation()


def impurity_of(kind: str) -> Column:
    """Impurity column over a summary row of the given kind."""
    if kind == "entropy":
        return F.log2("N") - F.col("S") / F.col("N")
    if kind == "gini":
        return F.lit(1.0) - F.col("Q") / (F.col("N") * F.col("N"))
    if kind == "mse":
        return F.col("M2") / F.col("N")
    if kind == "mae":
        return F.col("AD") / F.col("N")
    raise ValueError(kind)


def prediction_of(kind: str) -> Column:
    """What a leaf with this summary predicts."""
    return F.col({"entropy": "majority", "gini": "majority", "mse": "mean", "mae": "median"}[kind])


def is_constant(kind: str) -> Column:
    """Whether the summarised rows have one target value only."""
    return F.col("n_labels") == 1 if kind in ("entropy", "gini") else F.col("ymin") == F.col("ymax")


def summarize(frame: DataFrame, keys: list[str], kind: str, label_order: list | None = None) -> DataFrame:
    """Group summary of the kind."""
    if kind in ("entropy", "gini"):
        return class_summary(frame, keys, label_order=label_order)
    if kind == "mse":
        return mse_summary(frame, keys)
    return mae_summary(frame, keys)


# --------------------------------------------------------------------------
# weighted frames from raw rows
# --------------------------------------------------------------------------

def weighted_rows(df: DataFrame, target: str, kind: str, keys: list[str]) -> DataFrame:
    """Compact raw rows to the weighted frame ``summarize`` expects."""
    y = F.col(target)
    if kind in ("entropy", "gini"):
        return df.groupBy(*keys, y.alias("y")).agg(F.count(F.lit(1)).alias("n"))
    if kind == "mse":
        yd = y.cast("double")
        return df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.sum(yd).alias("s"),
            (F.var_pop(yd) * F.count(F.lit(1))).alias("m2"),
            F.min(yd).alias("ymin"), F.max(yd).alias("ymax"))
    return df.groupBy(*keys, y.cast("double").alias("y")).agg(F.count(F.lit(1)).alias("n"))


def column_impurity(df: DataFrame, target: str, criterion: str, by: list[str] | None = None) -> DataFrame:
    """Impurity of ``target`` (per ``by`` group): columns by.., n, impurity."""
    kind = impurity_kind(criterion)
    keys = list(by or [])
    frame = weighted_rows(df.where(F.col(target).isNotNull()), target, kind, keys)
    if kind == "mse":
        frame = center_mse_cells(cut_lineage(frame))
    summ = summarize(frame, keys, kind)
    return summ.select(*keys, F.col("N").alias("n"), impurity_of(kind).alias("impurity"))


# --------------------------------------------------------------------------
# split gains for all (node, feature) pairs
# --------------------------------------------------------------------------

#: The feature number of a node's own group, beside those of its children.
WHOLE = -1


def grouping_sets(cells: DataFrame, feature_cols: list[str], keep: list[str], used: Column | None = None) -> DataFrame:
    """Each cell once for its node (feature ``WHOLE``) and once for each feature not yet used on its path."""
    sets = [F.struct(F.lit(WHOLE).alias("f"), F.lit("").alias("v"))]
    sets += [F.struct(F.lit(i).alias("f"), F.col(c).cast("string").alias("v")) for i, c in enumerate(feature_cols)]
    items = F.array(*sets)
    if used is not None:
        items = F.filter(items, lambda x: ~F.array_contains(used, x["f"]))
    return cells.select(*keep, F.explode_outer(items).alias("_p")).select(*keep, "_p.f", "_p.v")


def node_gains(groups: DataFrame, node_key: list[str], n_features: int, kind: str, carried: dict[str, Column] | None = None) -> DataFrame:
    """One row per node from the summaries of ``grouping_sets``: ``n, impurity`` and ``gains``, an array of
    (f, child_impurity, gain) in feature order; ``carried`` columns are taken from the node's own group."""
    own = F.col("f") == WHOLE
    weighted = groups.withColumn("_imp", impurity_of(kind))
    of_node = {"n": F.col("N"), "impurity": F.col("_imp"), **(carried or {})}
    sums = [(F.sum(F.when(F.col("f") == i, F.col("N") * F.col("_imp"))) / F.sum(F.when(F.col("f") == i, F.col("N")))).alias(f"_c{i}")
            for i in range(n_features)]
    nodes = weighted.groupBy(*node_key).agg(*(F.max(F.when(own, c)).alias(k) for k, c in of_node.items()), *sums)
    gains = F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"_c{i}").alias("child_impurity"), (F.col("impurity") - F.col(f"_c{i}")).alias("gain"))
                      for i in range(n_features)]).cast("array<struct<f: int, child_impurity: double, gain: double>>")
    return nodes.select(*node_key, *of_node, F.filter(gains, lambda g: g["gain"].isNotNull()).alias("gains"))


def best_of(gains: Column) -> Column:
    """G1: the (gain, f) with the largest gain; ties -> first feature in column order.  Null without any."""
    ranked = F.array_max(F.transform(gains, lambda g: F.struct(F.round(g["gain"], GAIN_DECIMALS).alias("gain"), (-g["f"]).alias("f"))))
    return F.struct(ranked["gain"].alias("gain"), (-ranked["f"]).alias("f"))


def split_gains(df: DataFrame, features: list[str], target: str, criterion: str) -> DataFrame:
    """Gain of each feature at the root: feature, feature_idx, gain, ..."""
    kind = impurity_kind(criterion)
    clean = df.where(F.col(target).isNotNull())
    for c in features:
        clean = clean.where(F.col(c).isNotNull())
    frame_cols = [F.col(c).cast("string").alias(f"_f{i}") for i, c in enumerate(features)]
    fcols = [f"_f{i}" for i in range(len(features))]
    # one pass over the raw rows: compact to cells; the roll-ups run on the cells
    cells = weighted_rows(clean.select(*frame_cols, F.col(target)), target, kind, fcols)
    if kind == "mse":
        cells = center_mse_cells(cut_lineage(cells))
    groups = summarize(grouping_sets(cells, fcols, [c for c in cells.columns if c not in fcols]), ["f", "v"], kind)
    root = node_gains(groups, [], len(features), kind)
    names = F.array(*[F.lit(c) for c in features])
    g = root.select("impurity", F.explode("gains").alias("_g"))
    return g.select(F.element_at(names, F.col("_g.f") + 1).alias("feature"), F.col("_g.f").alias("feature_idx"),
                    F.col("_g.gain").alias("gain"), F.col("impurity").alias("parent_impurity"), F.col("_g.child_impurity").alias("child_impurity"))


def best_split(gains: DataFrame) -> DataFrame:
    """G1 over ``split_gains``: best_f, best_gain."""
    best = best_of(F.collect_list(F.struct(F.col("feature_idx").alias("f"), "gain")))  # a row per feature
    return gains.agg(best.alias("_b")).select(F.col("_b.f").alias("best_f"), F.col("_b.gain").alias("best_gain"))

"""Multiway categorical decision trees (T1-T6, J5), grown level by level.

Design (a few Spark jobs per *level*, never per node x feature x value):

1. Compact once: rows -> cells grouped by all features (+ label for
   classification / the value itself for MAE) with counts and the first-seen
   order key.  Map-side partial aggregation makes this the only pass over the
   raw data; it is checkpointed to the shared checkpoint dir.
2. Per level, one query over the cells scores every frontier node and every
   unused feature: each cell is expanded to its grouping sets (the node itself,
   and the node's children under each feature), these are summarised together,
   and one row per node takes the arg-max (``impurity.node_gains``).
3. Stop rules keep the reference's order (classification: pure, no features /
   depth, too few rows, zero gain; regression: no features / depth, too few
   rows, constant target, no reduction).  Leaves drop out of the frontier.
4. Cells of split nodes are routed to their children by one join against the
   (small, counted) decision table, broadcast only within the row bound.  The
   level's counts are observed while it is written, not in a job of their own.

The model is two tables: ``nodes`` and ``edges`` (node_id, value, child_id,
first_seen).  Node ids are path strings ``R/<feature_idx>=<value>/...`` with
``%``, ``/`` and ``=`` escaped, so they are deterministic, and a node's parent,
value and rule follow from its id.

Scoring walks the tree as one flat array (``flat_model``): no join, no shuffle;
only levels beyond ``FLAT_NODES`` nodes are joined.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sylvan.operators.impurity import (
    best_of,
    center_mse_cells,
    grouping_sets,
    impurity_kind,
    is_constant,
    node_gains,
    prediction_of,
    summarize,
)
from sylvan.operators.joins import broadcast_if_small
from sylvan.session import cut_lineage


def escape_value(c: Column) -> Column:
    c = F.regexp_replace(c, "%", "%25")
    c = F.regexp_replace(c, "/", "%2F")
    return F.regexp_replace(c, "=", "%3D")


def unescape_value(c: Column) -> Column:
    c = F.regexp_replace(c, "%3D", "=")
    c = F.regexp_replace(c, "%2F", "/")
    return F.regexp_replace(c, "%25", "%")


#: The value that stands for null under ``null_policy="branch"`` (a private-use character).
NULL_VALUE = "\ue000null"


@dataclass
class TreeModel:
    features: list[str]
    target: str
    criterion: str
    kind: str
    nodes: DataFrame
    edges: DataFrame
    levels: int
    n_nodes: int
    n_edges: int
    level_sizes: list[int] = field(default_factory=list)
    null_policy: str = "drop"
    dropped: DataFrame | None = None

    def predict(self, df: DataFrame, out_col: str = "prediction") -> DataFrame:
        return predict(self, df, out_col)

    def rules(self) -> DataFrame:
        """T5: one row per leaf: rule text, depth, prediction, n."""
        return self.nodes.where("is_leaf").select("node_id", "rule", "depth", "prediction", "n")


def fit_tree(df: DataFrame, features: list[str], target: str, criterion: str = "information_gain",
             max_depth: int | None = None, min_samples_split: int = 2,
             order_by: list[str] | None = None, label_order: list | None = None, null_policy: str = "drop") -> TreeModel:
    """Fit a multiway tree on categorical ``features``.

    ``order_by`` names columns giving the rows' original order; it defines the
    first-seen child used for unseen values at predict time (T4).  Without it,
    the smallest value is used.  ``null_policy`` says what a null feature
    means: ``drop`` leaves the row out (``model.dropped`` counts such rows),
    ``reject`` raises, and ``branch`` makes null a value of its own, at predict
    too.  Rows with a null target are left out (and counted), or rejected.
    ``label_order`` lists
    an ordered categorical target's categories, lowest first: majority ties
    then go to the lowest category rather than the smallest label text.
    """
    kind = impurity_kind(criterion)
    if not features:
        raise ValueError("need at least one feature")
    if null_policy not in ("drop", "reject", "branch"):
        raise ValueError(f"unknown null policy: {null_policy}")
    fcols = [f"_f{i}" for i in range(len(features))]
    order = F.struct(*[F.col(c) for c in order_by]) if order_by else F.lit(None).cast("string")
    base = df.select(*[F.col(c).cast("string").alias(fc) for c, fc in zip(features, fcols)],
                     F.col(target).alias("_y"), order.alias("_o"))
    if null_policy == "branch":
        base = base.withColumns({c: F.coalesce(c, F.lit(NULL_VALUE)) for c in fcols})
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in [*fcols, "_y"]])
    dropped = base.agg(F.count_if(any_null).alias("n_dropped"))
    if null_policy == "reject" and (n_null := dropped.first()["n_dropped"]):
        raise ValueError(f"{n_null} rows have a null feature or target")
    base = base.dropna(subset=fcols + ["_y"])

    if kind in ("entropy", "gini"):
        cells = base.groupBy(*fcols, F.col("_y").alias("y")).agg(
            F.count(F.lit(1)).alias("n"), F.min("_o").alias("_o"))
    elif kind == "mse":
        yd = F.col("_y").cast("double")
        cells = base.groupBy(*fcols).agg(
            F.count(F.lit(1)).alias("n"), F.sum(yd).alias("s"),
            (F.var_pop(yd) * F.count(F.lit(1))).alias("m2"),
            F.min(yd).alias("ymin"), F.max(yd).alias("ymax"), F.min("_o").alias("_o"))
    else:
        cells = base.groupBy(*fcols, F.col("_y").cast("double").alias("y")).agg(
            F.count(F.lit(1)).alias("n"), F.min("_o").alias("_o"))

    if kind == "mse":
        cells = center_mse_cells(cut_lineage(cells))
    frontier = cut_lineage(cells.select(F.lit("R").alias("node_id"), F.array().cast("array<int>").alias("used"), *cells.columns))
    if frontier.isEmpty():
        raise ValueError("empty training frame")
    stat_cols = [c for c in frontier.columns if c not in [*fcols, "node_id", "used", "_o"]]

    levels, firsts, sizes, depth = [], [], [], 0
    while True:
        level_open = (max_depth is None or depth < max_depth) and depth < len(features)
        sets = grouping_sets(frontier, fcols if level_open else [], ["node_id", *stat_cols], F.col("used"))
        groups = summarize(sets, ["node_id", "f", "v"], kind, label_order)
        decision = node_gains(groups, ["node_id"], len(features) if level_open else 0, kind,
                              {"prediction": prediction_of(kind), "_constant": is_constant(kind)})
        evaluated = ~F.col("_constant") & (F.col("n") >= F.lit(min_samples_split)) & F.lit(level_open)
        decision = decision.withColumn("_best", best_of("gains")).select(
            "node_id", F.lit(depth).alias("depth"), "n", "impurity", "prediction",
            F.when(evaluated, F.col("_best.gain")).alias("gain"),
            (~evaluated | (F.col("_best.gain") <= 0)).alias("is_leaf"), F.col("_best.f").alias("_f"))
        decision = decision.withColumn("split_idx", F.when(~F.col("is_leaf"), F.col("_f"))).drop("_f")
        seen = Observation()
        decision = cut_lineage(decision.observe(seen, F.count(F.lit(1)).alias("all"), F.count_if(~F.col("is_leaf")).alias("split")))
        levels.append(decision)
        sizes.append(seen.get["all"])
        n_split = seen.get["split"]
        if n_split == 0:
            break
        split = decision.where(~F.col("is_leaf")).select("node_id", "split_idx")
        value = F.element_at(F.array(*fcols), F.col("split_idx") + 1)
        child = F.concat("node_id", F.lit("/"), F.col("split_idx").cast("string"), F.lit("="), escape_value(value))
        frontier = cut_lineage(frontier.join(broadcast_if_small(split, n_split), "node_id").select(
            child.alias("node_id"), F.array_append("used", F.col("split_idx")).alias("used"), *fcols, *stat_cols, "_o"))
        firsts.append(frontier.groupBy(F.col("node_id").alias("child_id")).agg(F.min("_o").alias("first_seen")))
        depth += 1

    nodes, edges = _tables(levels, firsts, features)
    n_nodes = sum(sizes)
    return TreeModel(features=list(features), target=target, criterion=criterion, kind=kind, nodes=nodes, edges=edges,
                     levels=len(levels) - 1, n_nodes=n_nodes, n_edges=n_nodes - 1, level_sizes=sizes, null_policy=null_policy,
                     dropped=dropped)


def _tables(levels: list[DataFrame], firsts: list[DataFrame], features: list[str]) -> tuple[DataFrame, DataFrame]:
    """``nodes`` and ``edges``; what a path id tells is read from it."""
    names = F.array(*[F.lit(c) for c in features])
    nodes = reduce(DataFrame.unionByName, levels)
    if firsts:
        children = reduce(DataFrame.unionByName, firsts)
        edges = cut_lineage(children.select(
            F.regexp_replace("child_id", "/[^/]*$", "").alias("node_id"),
            unescape_value(F.regexp_extract("child_id", "=([^/]*)$", 1)).alias("value"), "child_id", "first_seen"))
        first = edges.groupBy("node_id").agg(F.min_by("child_id", F.struct("first_seen", "value")).alias("first_child"))
        nodes = nodes.join(first, "node_id", "left")
    else:
        edges = nodes.sparkSession.createDataFrame([], "node_id string, value string, child_id string, first_seen string")
        nodes = nodes.withColumn("first_child", F.lit(None).cast("string"))

    def condition(step):
        parts = F.split(step, "=", 2)
        return F.concat(F.element_at(names, parts[0].cast("int") + 1), F.lit(" = "), unescape_value(parts[1]))

    steps = F.split("node_id", "/", -1)
    rule = F.array_join(F.transform(F.slice(steps, 2, F.size(steps)), condition), " AND ")
    parent = F.when(F.col("depth") > 0, F.regexp_replace("node_id", "/[^/]*$", ""))
    feature = F.when(F.col("split_idx").isNotNull(), F.element_at(names, F.col("split_idx") + 1))
    return cut_lineage(nodes.select("node_id", parent.alias("parent_id"), rule.alias("rule"), "depth", "n", "impurity", "prediction",
                                    "gain", "is_leaf", "split_idx", "first_child", feature.alias("split_feature"))), edges


#: Nodes of a model that are walked as one constant array, about a hundred bytes each; deeper levels are joined.
FLAT_NODES = 200_000


def flat_depth(model: TreeModel, max_nodes: int) -> int:
    """The deepest level such that all nodes down to it are at most ``max_nodes`` (the root always counts)."""
    total, depth = 0, 0
    for d, n in enumerate(model.level_sizes):
        total += n
        if total > max_nodes:
            break
        depth = d
    return depth


def flat_model(model: TreeModel, depth: int) -> Column:
    """The tree down to ``depth`` as one constant array; item 0 is the root.

    Each item holds its node, the split feature's number (null for a leaf and at the last level), the values of its
    children with their items' numbers, the item for any other value, and the prediction.
    """
    own = model.nodes.where(F.col("depth") <= depth)
    nodes = own.select("node_id", "depth", "split_idx", "first_child", F.col("prediction").cast("string").alias("p")).collect()
    nodes.sort(key=lambda r: r["node_id"] != "R")
    number = {r["node_id"]: i for i, r in enumerate(nodes)}
    kids: list[list] = [[] for _ in nodes]
    inner = own.where(~F.col("is_leaf") & (F.col("depth") < depth)).select("node_id")
    for e in model.edges.join(inner, "node_id", "left_semi").select("node_id", "value", "child_id").collect():
        kids[number[e["node_id"]]].append((e["value"], number[e["child_id"]]))
    items = [{"n": r["node_id"], "f": r["split_idx"] if r["depth"] < depth else None, "v": [v for v, _ in k], "k": [c for _, c in k],
              "o": number.get(r["first_child"]), "p": r["p"]} for r, k in zip(nodes, kids)]
    return F.from_json(F.lit(json.dumps(items)), "array<struct<n: string, f: int, v: array<string>, k: array<int>, o: int, p: string>>")


def predict(model: TreeModel, df: DataFrame, out_col: str = "prediction") -> DataFrame:
    """Walk the flat tree; unseen values (and nulls, unless they are a branch) follow the first child.

    One expression per row: the item of the current node is looked up by number, and the row's value of its feature
    names the next one.  No row is shuffled.  Only levels below the first ``FLAT_NODES`` nodes are joined, and by then
    the rows are spread over that many nodes.
    """
    depth = flat_depth(model, FLAT_NODES)
    tree = flat_model(model, depth)
    values = F.array(*[F.col(c).cast("string") for c in model.features])
    if model.null_policy == "branch":
        values = F.transform(values, lambda v: F.coalesce(v, F.lit(NULL_VALUE)))
    rows = df.withColumn("_fv", values)

    def step(at, _):
        item = F.get(tree, at)
        child = F.get(item["k"], F.array_position(item["v"], F.get(F.col("_fv"), item["f"])).cast("int") - 1)
        return F.when(item["f"].isNull(), at).otherwise(F.coalesce(child, item["o"]))

    end = F.get(tree, F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step) if depth else F.lit(0))
    kind = model.nodes.schema["prediction"].dataType
    if depth == model.levels:
        return rows.withColumn(out_col, end["p"].cast(kind)).drop("_fv")
    rows = rows.withColumn("_node", end["n"])
    inner = model.nodes.where(~F.col("is_leaf") & (F.col("depth") >= depth)).select(
        F.col("node_id").alias("_node"), F.col("split_idx").alias("_split"), F.col("first_child").alias("_first"))
    edges = model.edges.select(F.col("node_id").alias("_node"), F.col("value").alias("_val"), F.col("child_id").alias("_child"))
    for _ in range(model.levels - depth):
        rows = rows.join(inner, "_node", "left").withColumn("_val", F.get("_fv", F.col("_split"))).join(edges, ["_node", "_val"], "left")
        rows = rows.withColumn("_node", F.coalesce("_child", "_first", "_node")).drop("_split", "_first", "_val", "_child")
    leaves = model.nodes.select(F.col("node_id").alias("_node"), F.col("prediction").alias(out_col))
    return rows.join(leaves, "_node", "left").drop("_node", "_fv")

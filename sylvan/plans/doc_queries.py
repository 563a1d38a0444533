"""Trees over the text tables: document quality from whole-text attributes.

documents ⋈ labels -> language, source, binned text length (whole text) and a
digit flag -> information-gain tree for ``quality`` -> training accuracy.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sylvan.functions.binning import bin_right_closed, bin_sql
from sylvan.operators import metrics
from sylvan.operators.tree import fit_tree
from sylvan.plans.common import r6
from sylvan.plans.registry import register
from sylvan.plans.tree_sql import tree_sql
from sylvan.sources.tables import table

LEN_EDGES = [0, 500, 1500, 3000, 1_000_000_000]
LEN_LABELS = ["short", "medium", "long", "huge"]
FEATURES = ["lang", "source", "len_bin", "has_digit"]


def labelled_documents(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    j = d.join(lab, "doc_id")
    return j.select("doc_id", "lang", "source",
                    bin_right_closed(F.length("text"), LEN_EDGES, LEN_LABELS).alias("len_bin"),
                    F.when(F.col("text").rlike("[0-9]"), "yes").otherwise("no").alias("has_digit"), "quality")


_BASE_SQL = (
    "(SELECT d.doc_id, d.lang, d.source, " + bin_sql("length(d.text)", LEN_EDGES, LEN_LABELS) + " AS len_bin, "
    "CASE WHEN regexp_matches(d.text, '[0-9]') THEN 'yes' ELSE 'no' END AS has_digit, l.quality "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"
)


def _model(spark, sf):
    return fit_tree(labelled_documents(spark, sf), FEATURES, "quality", "information_gain", max_depth=3, order_by=["doc_id"])


@register("doc_quality_tree", tree_sql(_BASE_SQL, FEATURES, "quality", "entropy", 3, keys=["doc_id"]))
def doc_quality_tree(spark, sf):
    m = _model(spark, sf)
    return m.nodes.select("node_id", "depth", "split_feature", "is_leaf", "prediction", "n",
                          r6("impurity").alias("impurity"), r6("gain").alias("gain"))


@register("doc_quality_accuracy",
          "SELECT round(avg(CASE WHEN actual = prediction THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS accuracy, count(*) AS n "
          f"FROM ({tree_sql(_BASE_SQL, FEATURES, 'quality', 'entropy', 3, keys=['doc_id'], output='predict')})")
def doc_quality_accuracy(spark, sf):
    scored = _model(spark, sf).predict(labelled_documents(spark, sf))
    return metrics.accuracy(scored, "quality", "prediction").select(r6("accuracy").alias("accuracy"), "n")

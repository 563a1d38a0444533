"""Rules that hold whatever the data: malformed markup, averages over all labels, deterministic folds, CSV marks."""

import os
import subprocess
import sys

from sylvan.operators.metrics import classification_report
from sylvan.session import scratch_path
from sylvan.sources import csv
from sylvan.sources.html import parse_tree
from sylvan.streaming.ingest import latest_updates

from .conftest import SF001


def test_rejected_markup_does_not_cut_the_page():
    text, _ = parse_tree("<p>a</p><![foo[x]]><p>b</p>")
    assert b"a" in text and b"b" in text


def test_macro_average_counts_a_class_that_is_only_predicted(spark):
    df = spark.createDataFrame([("A", "A"), ("A", "C"), ("B", "B")], "actual string, predicted string")
    rows = {r["label"]: r for r in classification_report(df, "actual", "predicted").collect()}
    macro = rows["macro avg"]
    assert [round(macro[c], 3) for c in ("precision", "recall", "f1")] == [0.667, 0.5, 0.556]


def test_fold_of_two_values_in_one_batch_ignores_row_order(spark):
    for rows in ([(1, "X"), (1, "Y")], [(1, "Y"), (1, "X")]):
        path = scratch_path(spark, "fold")
        spark.createDataFrame([(k, v, 0) for k, v in rows], "k long, v string, batch_id long").coalesce(1).write.parquet(path)
        assert latest_updates(spark, path, ["k"], ["v"]).collect()[0]["v"] == "Y"


def test_csv_mark_and_unreadable_table(spark):
    schema = "a int, b string"
    path = csv.write_csv(spark.createDataFrame([(1, "x"), (2, None)], schema).coalesce(1), scratch_path(spark, "csv"))
    local = path.removeprefix("file:")
    part, = [f for f in os.listdir(local) if f.startswith("part")]
    with open(os.path.join(local, part), "rb") as f:
        assert f.read(3) == b"\xef\xbb\xbf"
    assert [tuple(r) for r in csv.load_or_empty(spark, path, schema).orderBy("a").collect()] == [(1, "x"), (2, None)]
    other = scratch_path(spark, "csv-other")
    spark.createDataFrame([("zz",)], "c string").write.option("header", True).csv(other)
    assert csv.load_or_empty(spark, other, schema).count() == 0
    assert csv.load_or_empty(spark, other + "-none", schema).count() == 0


def test_workers_find_the_package_from_another_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {root!r})\n"
            "from sylvan.session import get_spark\nfrom sylvan.plans import QUERIES\n"
            "s = get_spark('local[2]', shuffle_partitions=2)\n"
            "from sylvan.sources.html import html_trees\n"
            "print('trees', html_trees(s.createDataFrame([(1, '<p>x</p>')], 'k long, html string'), 'html', ['k']).count())\n"
            f"print('rows', QUERIES['html_text'](s, {SF001!r}).count())")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows" in out.stdout and "trees 1" in out.stdout, out.stderr[-2000:]

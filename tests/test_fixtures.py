"""Golden values from FIXTURES.md §1-2 (toy weather and price tables)."""

import math

import pytest
from pyspark.sql import functions as F

from sylvan.operators import metrics
from sylvan.operators.impurity import column_impurity, split_gains
from sylvan.operators.tree import fit_tree, predict

WEATHER = [("Sunny", "Hot", "No"), ("Sunny", "Hot", "No"), ("Overcast", "Hot", "Yes"), ("Rainy", "Mild", "Yes"),
           ("Rainy", "Cool", "Yes"), ("Rainy", "Cool", "No"), ("Overcast", "Cool", "Yes"), ("Sunny", "Mild", "No"),
           ("Sunny", "Cool", "Yes"), ("Rainy", "Mild", "Yes")]
PRICES = [("Small", "City", 150), ("Small", "Suburb", 180), ("Medium", "City", 250), ("Large", "City", 400),
          ("Large", "Suburb", 350), ("Large", "Suburb", 380), ("Medium", "Suburb", 220), ("Small", "City", 170),
          ("Medium", "City", 240), ("Large", "Suburb", 390)]


@pytest.fixture(scope="module")
def weather(spark):
    return spark.createDataFrame([(i,) + r for i, r in enumerate(WEATHER)],
                                 "row_id int, Weather string, Temp string, Play string")


@pytest.fixture(scope="module")
def prices(spark):
    return spark.createDataFrame([(i,) + r for i, r in enumerate(PRICES)],
                                 "row_id int, Size string, Location string, Price int")


def _gains(df, feats, target, crit):
    return {r["feature"]: r for r in split_gains(df, feats, target, crit).collect()}


@pytest.mark.parametrize("crit,parent,gw,gt", [("information_gain", 0.970951, 0.321928, 0.095462),
                                              ("gini", 0.48, 0.18, 0.063333)])
def test_classification_gains(weather, crit, parent, gw, gt):
    g = _gains(weather, ["Weather", "Temp"], "Play", crit)
    assert g["Weather"]["parent_impurity"] == pytest.approx(parent, abs=1e-6)
    assert g["Weather"]["gain"] == pytest.approx(gw, abs=1e-6)
    assert g["Temp"]["gain"] == pytest.approx(gt, abs=1e-6)


@pytest.mark.parametrize("crit,parent,size,loc", [("mse", 8601, 8367.666667, 961), ("mae", 81, 69, 11)])
def test_regression_reductions(prices, crit, parent, size, loc):
    g = _gains(prices, ["Size", "Location"], "Price", crit)
    assert g["Size"]["parent_impurity"] == pytest.approx(parent, abs=1e-6)
    assert g["Size"]["gain"] == pytest.approx(size, abs=1e-6)
    assert g["Location"]["gain"] == pytest.approx(loc, abs=1e-6)


def test_column_impurity_by_group(weather):
    rows = {r["Weather"]: r["impurity"] for r in column_impurity(weather, "Play", "entropy", by=["Weather"]).collect()}
    assert rows["Sunny"] == pytest.approx(0.811278, abs=1e-6)
    assert rows["Overcast"] == pytest.approx(0.0, abs=1e-12)


@pytest.mark.parametrize("crit", ["information_gain", "gini"])
def test_classification_tree(weather, crit):
    m = fit_tree(weather, ["Weather", "Temp"], "Play", crit, order_by=["row_id"])
    leaves = {r["rule"]: r["prediction"] for r in m.rules().collect()}
    assert leaves == {
        "Weather = Sunny AND Temp = Hot": "No", "Weather = Sunny AND Temp = Mild": "No",
        "Weather = Sunny AND Temp = Cool": "Yes", "Weather = Overcast": "Yes",
        "Weather = Rainy AND Temp = Mild": "Yes", "Weather = Rainy AND Temp = Cool": "No"}
    acc = metrics.accuracy(m.predict(weather), "Play", "prediction").first()["accuracy"]
    assert acc == pytest.approx(0.9)
    wrong = m.predict(weather).where(F.col("Play") != F.col("prediction")).select("row_id").collect()
    assert [r[0] for r in wrong] == [4]


def test_unseen_values_follow_first_seen_child(spark, weather):
    m = fit_tree(weather, ["Weather", "Temp"], "Play", "information_gain", order_by=["row_id"])
    probe = spark.createDataFrame([("Foggy", "Cool"), ("Rainy", "Hot"), (None, "Hot")], "Weather string, Temp string")
    got = [r["prediction"] for r in m.predict(probe).collect()]
    assert got == ["Yes", "Yes", "No"]  # Foggy->Sunny->Cool; Rainy/Hot->Mild; null->Sunny->Hot


def test_max_depth_one(weather):
    m = fit_tree(weather, ["Weather", "Temp"], "Play", "information_gain", max_depth=1, order_by=["row_id"])
    leaves = {r["rule"]: r["prediction"] for r in m.rules().collect()}
    assert leaves == {"Weather = Sunny": "No", "Weather = Overcast": "Yes", "Weather = Rainy": "Yes"}


def test_unknown_criterion_raises(weather):
    with pytest.raises(ValueError):
        fit_tree(weather, ["Weather"], "Play", "entropyy")


@pytest.mark.parametrize("crit,suburb,scores", [
    ("mse", 373.333333, dict(mse=111.666667, rmse=10.567245, mae=7.666667, r2=0.987017, mape=2.932691)),
    ("mae", 380.0, dict(mse=125.0, rmse=11.18034, mae=7.0, r2=0.985467, mape=2.776788)),
])
def test_regression_tree_and_scores(prices, crit, suburb, scores):
    m = fit_tree(prices, ["Size", "Location"], "Price", crit, order_by=["row_id"])
    leaves = {r["rule"]: r["prediction"] for r in m.rules().collect()}
    assert leaves["Size = Large AND Location = Suburb"] == pytest.approx(suburb, abs=1e-6)
    assert leaves["Size = Small AND Location = City"] == pytest.approx(160)
    s = metrics.regression_scores(predict(m, prices), "Price", "prediction").first()
    for k, v in scores.items():
        assert s[k] == pytest.approx(v, abs=1e-5), k


def test_counts_sum_to_parent(weather):
    m = fit_tree(weather, ["Weather", "Temp"], "Play", "gini", order_by=["row_id"])
    nodes = {r["node_id"]: r for r in m.nodes.collect()}
    for e in m.edges.collect():
        assert nodes[e["child_id"]]["n"] <= nodes[e["node_id"]]["n"]
    for nid, r in nodes.items():
        if not r["is_leaf"]:
            kids = [x for x in m.edges.collect() if x["node_id"] == nid]
            assert sum(nodes[k["child_id"]]["n"] for k in kids) == r["n"]
    assert all(r["gain"] is None or r["gain"] >= -1e-12 for r in nodes.values())
    assert not math.isnan(nodes["R"]["impurity"])


def test_ordered_label_majority_tie(spark):
    # one node, tie between High and Low: text order picks High, category order picks Low
    df = spark.createDataFrame([(0, "a", "High"), (1, "a", "Low")], "row_id int, f string, y string")
    m_text = fit_tree(df, ["f"], "y", "gini", order_by=["row_id"])
    m_cat = fit_tree(df, ["f"], "y", "gini", order_by=["row_id"], label_order=["Low", "Medium", "High", "Elite"])
    assert m_text.nodes.first()["prediction"] == "High"
    assert m_cat.nodes.first()["prediction"] == "Low"


def test_null_policy(spark):
    df = spark.createDataFrame([(0, "a", "x"), (1, None, "y"), (2, "b", "x"), (3, None, "y"), (4, "a", None)],
                               "row_id int, f string, y string")
    dropped = fit_tree(df, ["f"], "y", "gini", order_by=["row_id"])
    assert dropped.dropped.first()[0] == 3 and dropped.nodes.where("node_id = 'R'").first()["n"] == 2
    with pytest.raises(ValueError):
        fit_tree(df, ["f"], "y", "gini", null_policy="reject")
    with pytest.raises(ValueError):
        fit_tree(df, ["f"], "y", "gini", null_policy="keep")
    own = fit_tree(df, ["f"], "y", "gini", order_by=["row_id"], null_policy="branch")
    assert own.dropped.first()[0] == 1
    got = {r["f"]: r["prediction"] for r in own.predict(df.select("f").distinct()).collect()}
    assert got == {"a": "x", "b": "x", None: "y"}


def test_join_scoring_routes_unseen_and_null_values(spark, weather, prices):
    probe = spark.createDataFrame([("Foggy", "Cool"), ("Rainy", "Hot"), (None, "Hot"), ("Sunny", "Mild")],
                                  "Weather string, Temp string")
    m = fit_tree(weather, ["Weather", "Temp"], "Play", "information_gain", order_by=["row_id"])
    assert [r["prediction"] for r in m.predict(probe).collect()] == ["Yes", "Yes", "No", "No"]



def test_levels_below_the_flat_part_are_joined(weather, monkeypatch):
    from sylvan.operators import tree

    m = fit_tree(weather, ["Weather", "Temp"], "Play", "information_gain", order_by=["row_id"])
    whole = [r["prediction"] for r in m.predict(weather).orderBy("row_id").collect()]
    for flat in (0, 4, 8, 9):
        monkeypatch.setattr(tree, "FLAT_NODES", flat)
        scored = m.predict(weather)
        joined = "Join" in scored._jdf.queryExecution().executedPlan().toString()
        assert [r["prediction"] for r in scored.orderBy("row_id").collect()] == whole
        assert joined == (flat < m.n_nodes)
    assert m.n_nodes == 9 and m.level_sizes == [1, 3, 5]


def test_a_level_takes_few_jobs(spark, weather):
    tracker = spark.sparkContext.statusTracker()

    def jobs(run):
        group = f"jobs-{id(run)}"
        spark.sparkContext.setJobGroup(group, "")
        run()
        spark.sparkContext.setJobGroup("none", "")
        return len(tracker.getJobIdsForGroup(group))

    one, two = (jobs(lambda d=d: fit_tree(weather, ["Weather", "Temp"], "Play", "gini", max_depth=d, order_by=["row_id"])) for d in (1, 2))
    assert two - one <= 8  # with adaptive execution each shuffle is a job of its own

"""Scalar function edge cases (FIXTURES.md §3-4)."""

from pyspark.sql import functions as F

from sylvan.functions import scalar as S
from sylvan.functions.binning import PLAYER_BINS, bin_right_closed


def _eval(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_parse_money(spark):
    got = _eval(spark, ["€110.5M", "€500K", "€0", "€500", "€xM"], S.parse_money)
    assert got == [110500000.0, 500000.0, 0.0, 0.0, None]


def test_parse_rating_and_safe_int(spark):
    assert _eval(spark, ["75+2", "75-2", "75"], S.parse_rating) == ["75", "75", "75"]
    assert _eval(spark, ["17", "n/a", ""], S.safe_int) == [17, 0, 0]


def test_json_first_int(spark):
    assert _eval(spark, ['{"height":"170cm"}', "{broken"], lambda c: S.json_first_int(c, "$.height")) == [170, None]


def test_safe_name_and_codes(spark):
    assert _eval(spark, ["FK Accuracy", "Att. Rate"], S.safe_name) == ["FK_Accuracy", "Att_Rate"]
    assert _eval(spark, ["a ST b GK ST"], S.position_codes) == [["GK", "ST"]]
    assert _eval(spark, ["ST", "st", "GOAL", "G", "12"], S.is_position_code) == [True, False, False, False, False]


def test_work_rate_pair_and_text(spark):
    assert _eval(spark, ["medium / HIGH"], S.work_rate_pair) == ["Medium/High"]
    assert _eval(spark, ["Work Rate: Hoch / Niedrig"], S.work_rate_text) == ["Hoch/Niedrig"]


def test_first_line_strips_unicode_whitespace(spark):
    assert _eval(spark, ["  first line  \nsecond"], S.first_line) == ["first line"]


def test_default_fill(spark):
    assert _eval(spark, ["", None, "X"], lambda c: S.default_fill(c, "Free Agent")) == ["Free Agent", "Free Agent", "X"]


def test_bins_right_closed(spark):
    edges, labels = PLAYER_BINS["Age"]
    got = _eval(spark, [0.0, 22.0, 22.5, 28.0, 50.0, 51.0, -1.0], lambda c: bin_right_closed(c, edges, labels),
                "double")
    assert got == ["Young", "Young", "Prime", "Prime", "Veteran", None, None]


def test_sigmoid_no_overflow(spark):
    got = _eval(spark, [0.0, -1000.0, 1000.0], S.sigmoid, "double")
    assert got[0] == 0.5 and got[1] == 0.0 and got[2] == 1.0

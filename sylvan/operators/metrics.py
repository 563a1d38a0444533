"""Scoring (M1-M7): every metric is one aggregate over (actual, prediction) pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accuracy(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """M1: share of rows whose prediction equals the label (null-safe)."""
    hit = F.when(F.col(actual).eqNullSafe(F.col(pred)), 1.0).otherwise(0.0)
    return df.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def regression_scores(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """M2-M5: R^2 (0 when SStot = 0), MSE, RMSE, MAE, MAPE (%; rows with y = 0 skipped).

    SStot uses the one-pass identity sum(y^2) - n*mean^2 replaced by
    n*var_pop(y) (Spark's var_pop is Welford-merged, so it is stable).
    """
    y, p = F.col(actual).cast("double"), F.col(pred).cast("double")
    err = y - p
    agg = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(err * err).alias("_ssres"),
        (F.var_pop(y) * F.count(y)).alias("_sstot"),
        F.avg(err * err).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.avg(F.abs(F.try_divide(err, y))) * 100.0).alias("mape"),
    )
    r2 = F.when(F.col("_sstot") == 0, F.lit(0.0)).otherwise(1.0 - F.col("_ssres") / F.col("_sstot"))
    return agg.select("n", r2.alias("r2"), "mse", F.sqrt("mse").alias("rmse"), "mae", "mape")


def confusion_matrix(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """M7: counts per (actual, predicted)."""
    return df.groupBy(F.col(actual).alias("actual"), F.col(pred).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """M6: per-class precision / recall / F1 / support plus accuracy, macro and weighted avg.

    Classes with no predicted rows get precision 0 (the library's
    zero_division default); output rows are keyed by ``label``.
    """
    cm = confusion_matrix(df, actual, pred)
    tp = cm.where(F.col("actual").eqNullSafe(F.col("predicted"))).groupBy(
        F.col("actual").cast("string").alias("label")).agg(F.sum("n").alias("tp"))
    support = cm.groupBy(F.col("actual").cast("string").alias("label")).agg(F.sum("n").alias("support"))
    predicted = cm.groupBy(F.col("predicted").cast("string").alias("label")).agg(F.sum("n").alias("npred"))
    per = (support.join(predicted, "label", "full").join(tp, "label", "left")
           .fillna(0, ["tp", "support", "npred"]))
    prec = F.when(F.col("npred") > 0, F.col("tp") / F.col("npred")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    per = per.select("label", prec.alias("precision"), rec.alias("recall"), "support", "tp")
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall") /
                                      (F.col("precision") + F.col("recall"))).otherwise(0.0))
    # the averages run over every label, also one that is only predicted (its recall is 0)
    summary = per.agg(
        F.avg("precision").alias("m_p"), F.avg("recall").alias("m_r"), F.avg("f1").alias("m_f"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("w_p"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("w_r"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("w_f"),
        F.sum("support").alias("total"), (F.sum("tp") / F.sum("support")).alias("acc"))
    rows = summary.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), F.col("acc").alias("f1"),
                 F.col("total").alias("support")),
        F.struct(F.lit("macro avg").alias("label"), F.col("m_p").alias("precision"),
                 F.col("m_r").alias("recall"), F.col("m_f").alias("f1"), F.col("total").alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), F.col("w_p").alias("precision"),
                 F.col("w_r").alias("recall"), F.col("w_f").alias("f1"), F.col("total").alias("support")),
    )).alias("r")).select("r.*")
    return per.select("label", "precision", "recall", "f1", "support").unionByName(rows)

"""Seeded, deterministic sampling and splits.

Randomness is an md5 of ``"<seed>:<id>"``: identical in every engine, stable
under repartitioning and executor loss (a recomputed task draws the same rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sylvan.operators.joins import broadcast_if_small, materialize_small
from sylvan.session import scratch_path

# Hex digits of the md5 used to histogram a stratum before locating the exact
# boundary: 16^5 = 1M buckets, so the boundary bucket of even a 1e11-row
# stratum holds ~1e5 rows.
BUCKET_HEX = 5


def seeded_hash(id_cols: list[str], seed: int = 42) -> Column:
    ident = F.concat_ws("|", *[F.col(c).cast("string") for c in id_cols])
    return F.md5(F.concat(F.lit(f"{seed}:"), ident))


def balanced_sample(df: DataFrame, class_col: str, id_cols: list[str], n: int = 100, seed: int = 42) -> DataFrame:
    """At most ``n`` rows per class, chosen by seeded hash order.

    ``row_number() <= n`` over a per-class window is planned with a partial
    WindowGroupLimit: every map task keeps only its top ``n`` per class before
    the shuffle, so a huge class never travels whole.
    """
    h = seeded_hash(id_cols, seed)
    w = Window.partitionBy(class_col).orderBy(h, *id_cols)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def hash_split(df: DataFrame, id_cols: list[str], test_fraction: float = 0.2, seed: int = 42,
               col: str = "split") -> DataFrame:
    """G4 (default mode): per-row test flag from a 4-hex-digit hash prefix; no shuffle."""
    cut = format(int(round(test_fraction * 0x10000)), "04x")
    h = seeded_hash(id_cols, seed)
    return df.withColumn(col, F.when(F.substring(h, 1, 4) < F.lit(cut), "test").otherwise("train"))


def stratified_split(df: DataFrame, class_col: str | None, id_cols: list[str], test_fraction: float = 0.2,
                     seed: int = 42, col: str = "split") -> DataFrame:
    """G3 / exact G4: exactly ceil(f * n_class) test rows per class, the smallest hashes.

    1. the rows are written once with their class and hash (no shuffle); all that follows reads that table, of which
       the counting passes read two columns;
    2. histogram (class, hash prefix) -> counts (partial aggregation);
    3. per class, the prefix bucket holding the k-th hash (cumulative window
       over <= 16^BUCKET_HEX histogram rows per class);
    4. rank only the rows of that boundary bucket to get the k-th hash itself;
    5. tag ``hash <= threshold`` with a broadcast of the per-class thresholds (one row per class, counted first).
    The input is read and hashed once.  Ids must be unique for the split to be exact.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "split")
    cls = F.col(class_col).cast("string") if class_col else F.lit("all")
    df.select(F.struct("*").alias("row"), cls.alias("_cls"), seeded_hash(id_cols, seed).alias("_h")).write.parquet(path)
    keyed = spark.read.parquet(path)
    bucket = F.substring("_h", 1, BUCKET_HEX)
    hist = keyed.groupBy("_cls", bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("_cls").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    total = Window.partitionBy("_cls")
    hist = (hist.withColumn("_cum", F.sum("_n").over(w))
            .withColumn("_tot", F.sum("_n").over(total))
            .withColumn("_k", F.ceil(F.col("_tot") * F.lit(test_fraction)).cast("long")))
    boundary = hist.where((F.col("_cum") - F.col("_n") < F.col("_k")) & (F.col("_cum") >= F.col("_k"))).select(
        F.col("_cls").alias("_c"), F.col("_b").alias("_p"), (F.col("_k") - (F.col("_cum") - F.col("_n"))).alias("_need"))
    boundary, n_cls = materialize_small(boundary)
    in_bucket = keyed.select("_cls", "_h").join(broadcast_if_small(boundary, n_cls), F.col("_cls").eqNullSafe(F.col("_c")) & (bucket == F.col("_p")))
    rank = Window.partitionBy("_cls").orderBy("_h")
    thresholds = (in_bucket.withColumn("_r", F.row_number().over(rank))
                  .where(F.col("_r") == F.col("_need")).select(F.col("_cls").alias("_c"), F.col("_h").alias("_t")))
    thresholds, n_t = materialize_small(thresholds)
    out = keyed.join(broadcast_if_small(thresholds, n_t), F.col("_cls").eqNullSafe(F.col("_c")), "left")
    is_test = F.col("_t").isNotNull() & (F.col("_h") <= F.col("_t"))
    return out.select("row.*", F.when(is_test, "test").otherwise("train").alias(col))


def first_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Keep the first row per key by ``order`` (aggregate with map-side combine)."""
    cols = [c for c in df.columns]
    best = F.min_by(F.struct(*cols), F.struct(*order))
    return df.groupBy(*key).agg(best.alias("_r")).select("_r.*")

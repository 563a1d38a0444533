"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, path: str) -> DataFrame:
    """``node, root`` (the smallest node of its component) for every node of ``edges`` (long ``u``, ``v``).

    Each step is written below ``path``, so lineage stays short and survives
    lost executors; the number of steps grows with the logarithm of the
    largest component.  Only a count and a checksum of the edges reach the
    driver.
    """
    spark, step, last = edges.sparkSession, 0, None

    def stored(df: DataFrame) -> DataFrame:
        nonlocal step
        out = f"{path}/step-{step:03d}"
        step += 1
        df.write.parquet(out)
        return spark.read.schema("u long, v long").parquet(out)

    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = stored(small.select("e.u", "e.v").where("u <> v").distinct())
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if tuple(mark) == last:
            break
        last = tuple(mark)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

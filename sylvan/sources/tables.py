"""Driver tables (one parquet file each)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sylvan.session import ship_package

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

"""CSV sources and sinks.

Reads always use a declared schema (no inference).  Writes never overwrite the
path they read from: every save goes to a fresh version directory and the
caller swaps to it, because overwriting a path that is also the input deletes
the input before the job has read it.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


BOM = "\ufeff"


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Header row, declared schema; a UTF-8 BOM in the header is ignored."""
    return (spark.read.schema(schema).option("header", True).option("encoding", "UTF-8")
            .option("mode", "PERMISSIVE").csv(path))


def write_csv(df: DataFrame, base: str) -> str:
    """Full snapshot with header, no index column, to a new version path; returns it.

    Each file starts with a UTF-8 byte order mark, carried by the first header name.
    """
    path = f"{base.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"
    df = df.toDF(*(BOM * (i == 0) + c for i, c in enumerate(df.columns)))
    df.write.mode("errorifexists").option("header", True).csv(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def load_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """S3: the table at ``path``, else an empty frame of ``schema``.

    Empty stands for a missing path and for a file that is no such table (its
    header does not name the schema's columns).  Storage errors are raised.
    """
    empty = spark.createDataFrame([], schema)
    if not path or not path_exists(spark, path):
        return empty
    try:
        header = spark.read.option("header", True).csv(path).columns
    except AnalysisException:  # no CSV file below the path
        return empty
    if [c.removeprefix(BOM) for c in header] != empty.columns:
        return empty
    return read_csv(spark, path, schema)

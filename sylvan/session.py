"""Session and shared-storage helpers.

Everything that must survive executor loss (lineage cuts, streaming
checkpoints, intermediate tables) is written below the directory the
cluster names in ``spark.checkpoint.dir``.  Only when that setting is
absent -- local tests -- do we create a private folder ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


_SHIPPED: set[str] = set()


def get_spark(master: str | None = None, app: str = "sylvan",
              shuffle_partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, so Python workers can import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="sylvan-code-"), "sylvan.zip")  # read by this driver only
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    at = os.path.join(folder, name)
                    z.write(at, os.path.join("sylvan", os.path.relpath(at, root)))
    sc.addPyFile(archive)


#: Rows of whole texts that travel to a worker at a time (Spark's default is 10,000).
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Keep batches of whole texts small in the JVM and the worker, unless the session says otherwise."""
    ship_package(spark)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(setting) == "10000":
        spark.conf.set(setting, str(BATCH_ROWS))


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, configuring it from the session.

    Order: an already-set SparkContext checkpoint dir, then the
    ``spark.checkpoint.dir`` setting; only if both are missing (unit tests
    on one machine) a fresh private folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured and not re.match(r"local(\[|$)", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="sylvan-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint directory (for a job, whose workers get the package)."""
    ship_package(spark)
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df):
    """Reliable checkpoint (never a local one): survives executor loss."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)

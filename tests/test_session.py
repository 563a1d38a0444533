"""Shared storage comes from the session's spark.checkpoint.dir when it is set."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from sylvan.session import checkpoint_root, cut_lineage, scratch_path
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {target!r}).getOrCreate())
root = checkpoint_root(spark)
df = cut_lineage(spark.range(10))
assert df.count() == 10
print("ROOT", root)
print("SCRATCH", scratch_path(spark, "x"))
"""


def test_checkpoint_dir_is_read_from_the_session():
    target = tempfile.mkdtemp(prefix="shared-ckpt-", dir="/tmp")
    code = SCRIPT.format(root=ROOT, target=target)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = dict(line.split(" ", 1) for line in out.stdout.splitlines() if line.startswith(("ROOT", "SCRATCH")))
    assert target in lines["ROOT"]
    assert target in lines["SCRATCH"]
    assert any(os.scandir(target))  # the checkpoint was written there

"""A seen-key index whose cost per batch follows the batch, not the sink (S7, ST1).

Keys lie in *runs*.  A run is hash-partitioned into buckets of about
``BUCKET_KEYS`` keys (a folder each), so a run with more keys has more buckets;
its files are sorted by the keys' hash and carry a Bloom filter of it.  A batch
of ``m`` keys reads, of each run, only the buckets its keys fall into (at most
``m``, of bounded size), and for a small batch the filters decide which row
groups of those are read at all.

Every batch adds a run of its own keys.  ``FAN_OUT`` runs of a level are merged
into one of the next level, so there are at most ``FAN_OUT`` runs for each power
of ``FAN_OUT`` in the number of batches, and a key is rewritten once per level.

The index is a list of runs in a manifest.  A manifest is written under the
next number and counts once complete, so a batch is either in the index with
all its keys or not at all; ``done`` remembers the last batch of each stream,
and a batch that was already committed is not taken again.  Runs that a merge
replaced are removed with the next commit.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.operators.joins import broadcast_if_small, materialize_small

BUCKET_KEYS = 50_000
FAN_OUT = 4
#: Up to this many keys, a batch asks the files' filters for each of them.
ASKED_KEYS = 64


class SeenKeys:
    def __init__(self, spark: SparkSession, path: str, key: list[str], bucket_keys: int = BUCKET_KEYS, fan_out: int = FAN_OUT):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.bucket_keys, self.fan_out = bucket_keys, fan_out
        self.version, self.runs, self.done, self.replaced = self._latest()

    # -- the manifest

    def _manifest(self, n: int) -> str:
        return f"{self.path}/manifest-{n:09d}"

    def _files(self):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return path(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _latest(self):
        fs, path = self._files()
        found = fs.globStatus(path(f"{self.path}/manifest-*/_SUCCESS")) or []
        numbers = [int(s.getPath().getParent().getName().rpartition("-")[2]) for s in found]
        if not numbers:
            return 0, [], {}, []
        text = "".join(r["value"] for r in self.spark.read.text(self._manifest(max(numbers)), wholetext=True).collect())
        state = json.loads(text)
        return max(numbers), state["runs"], state["done"], state["replaced"]

    def _commit(self) -> None:
        fs, path = self._files()
        for name in self.replaced:  # no manifest that counts names them any more
            fs.delete(path(f"{self.path}/{name}"), True)
        self.version += 1
        self.replaced = self.merged
        text = json.dumps({"runs": self.runs, "done": self.done, "replaced": self.replaced})
        frame = self.spark.createDataFrame([(text,)], "value string").coalesce(1)
        frame.write.mode("overwrite").text(self._manifest(self.version))

    # -- runs

    def _keyed(self, df: DataFrame) -> DataFrame:
        """Null-safe key columns and their hash."""
        return df.withColumn("_h", F.xxhash64(*self.key))

    @staticmethod
    def _bucket(n: int):
        return F.pmod(F.shiftright("_h", 3), F.lit(n)).cast("int")

    def _write(self, keys: DataFrame, n_keys: int, level: int) -> None:
        buckets = max(1, -(-n_keys // self.bucket_keys))
        name = f"run-{self.version + 1:09d}-{level}"
        (keys.withColumn("_bucket", self._bucket(buckets)).repartition(buckets, "_bucket").sortWithinPartitions("_bucket", "_h")
         .write.mode("overwrite").option("parquet.bloom.filter.enabled#_h", "true")
         .option("parquet.bloom.filter.expected.ndv#_h", str(self.bucket_keys)).partitionBy("_bucket").parquet(f"{self.path}/{name}"))
        self.runs.append({"name": name, "level": level, "buckets": buckets, "keys": n_keys})

    def _run(self, run: dict) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{run['name']}")

    def touched(self, keyed: DataFrame) -> dict[str, list[int]]:
        """Of each run, the buckets that a batch's keys fall into: all that is read for it."""
        counts = sorted({r["buckets"] for r in self.runs})
        if not counts:
            return {}
        sets = keyed.agg(*[F.sort_array(F.collect_set(self._bucket(n))).alias(str(n)) for n in counts]).first()  # at most a number per bucket
        return {r["name"]: list(sets[str(r["buckets"])]) for r in self.runs if sets[str(r["buckets"])]}

    def unseen(self, batch: DataFrame) -> tuple[DataFrame, int]:
        """The rows of a batch (one per key) whose key is not in the index, and their number."""
        keyed, n = materialize_small(self._keyed(batch))
        touched = self.touched(keyed) if n else {}
        asked = [r["_h"] for r in keyed.select("_h").collect()] if n <= ASKED_KEYS else None
        seen = None
        for run in self.runs:
            if run["name"] in touched:
                part = self._run(run)
                where = F.col("_bucket").isin(touched[run["name"]])
                if asked is not None:
                    hit = F.col("_h") == asked[0]
                    for h in asked[1:]:
                        hit = hit | (F.col("_h") == h)
                    where = where & hit
                part = part.where(where).select(*self.key, "_h")
                seen = part if seen is None else seen.unionAll(part)
        if seen is None:
            return keyed, n
        # the batch's own keys decide what is carried on of the runs, before anything is compared
        seen = seen.join(broadcast_if_small(keyed.select("_h"), n), "_h", "left_semi")
        same = [F.col(f"_s.{k}").eqNullSafe(F.col(f"_b.{k}")) for k in self.key]
        fresh = keyed.alias("_b").join(seen.alias("_s"), [F.col("_b._h") == F.col("_s._h"), *same], "left_anti")
        return materialize_small(fresh)

    def add(self, keyed: DataFrame, n_keys: int, stream: str, batch_id: int) -> None:
        """Add a batch's new keys as a run, merge full levels, and commit."""
        if n_keys:
            self._write(keyed.select(*self.key, "_h"), n_keys, 0)
        self.merged: list[str] = []
        level = 0
        while len(same := [r for r in self.runs if r["level"] == level]) >= self.fan_out:
            merged = None
            for r in same:
                part = self._run(r).select(*self.key, "_h")
                merged = part if merged is None else merged.unionAll(part)
            self.runs = [r for r in self.runs if r["level"] != level]
            self.merged += [r["name"] for r in same]
            level += 1
            self._write(merged, sum(r["keys"] for r in same), level)
        self.done[stream] = batch_id
        self._commit()

    def has_done(self, stream: str, batch_id: int) -> bool:
        return batch_id <= self.done.get(stream, -1)


def index_path(sink: str) -> str:
    """Where the index of a sink lies: beside it."""
    return f"{sink.rstrip('/')}-keys"

"""Ingest by a seen-key index, update snapshots, and state bounded by a watermark."""

import random

import pytest

from sylvan.session import scratch_path
from sylvan.streaming import ingest as ST
from sylvan.streaming.seen import SeenKeys, index_path


def frame(spark, keys):
    return spark.createDataFrame([(k, f"v{k}") for k in keys], "k long, v string")


def test_index_equals_a_set_and_reads_what_a_batch_may_hit(spark):
    path, rng, known = scratch_path(spark, "seen"), random.Random(1), set()
    rows_of_buckets, sizes = [], []
    for b in range(12):
        index = SeenKeys(spark, path, ["k"], bucket_keys=40, fan_out=3)  # opened anew: a restart
        keys = rng.sample(range(100_000), 150) + (rng.sample(sorted(known - {None}), 20) if known else [])
        keys = list(dict.fromkeys(keys)) + [None] * (b == 3)
        fresh, n = index.unseen(frame(spark, keys))
        assert sorted(map(str, (r["k"] for r in fresh.collect()))) == sorted(map(str, set(keys) - known)) and n == len(set(keys) - known)
        index.add(fresh, n, "s", b)
        known |= set(keys)
        assert index.has_done("s", b) and not index.has_done("s", b + 1)
        # a batch of one key, as large however large the sink is
        probe = SeenKeys(spark, path, ["k"], bucket_keys=40, fan_out=3)
        touched = probe.touched(probe._keyed(frame(spark, [rng.randrange(100_000)])))
        assert all(len(buckets) == 1 for buckets in touched.values())
        rows_of_buckets.append(max(probe._run(r).where(f"_bucket = {touched[r['name']][0]}").count() for r in probe.runs))
        sizes.append(len(probe.runs))
    assert max(rows_of_buckets) <= 3 * 40 and max(sizes) <= 2 * 3  # bounded buckets, at most fan-out runs a level
    assert sum(r["keys"] for r in probe.runs) == len(known)


def test_filters_are_written_with_the_hash(spark):
    import glob

    import pyarrow.parquet as pq

    path = scratch_path(spark, "seen")
    index = SeenKeys(spark, path, ["k"])
    fresh, n = index.unseen(frame(spark, range(500)))
    index.add(fresh, n, "s", 0)
    file, = glob.glob(f"{path.removeprefix('file:')}/run-*/_bucket=0/*.parquet")
    group = pq.ParquetFile(file).metadata.row_group(0)
    h, = (group.column(i) for i in range(group.num_columns) if group.column(i).path_in_schema == "_h")
    assert h.statistics.min < h.statistics.max and len(open(file, "rb").read()) > 500 * 8


def test_replayed_and_half_done_batches_change_nothing(spark):
    sink = scratch_path(spark, "sink")
    batches = [frame(spark, range(0, 30)), frame(spark, range(20, 50))]
    for b, df in enumerate(batches):
        ST.ingest_batch(df, b, "s", sink, ["k"], ["v"])
    ST.ingest_batch(batches[1], 1, "s", sink, ["k"], ["v"])  # replayed after its commit
    third = frame(spark, range(45, 60))
    index = SeenKeys(spark, index_path(sink), ["k"])
    fresh, _ = index.unseen(third)
    fresh.drop("_h").write.parquet(f"{sink}/{ST.BATCH}=s-2")  # written, but the run was lost before the index's commit
    ST.ingest_batch(third, 2, "s", sink, ["k"], ["v"])
    ST.ingest_batch(frame(spark, []), 3, "s", sink, ["k"], ["v"])
    got = [r["k"] for r in spark.read.parquet(sink).collect()]
    assert sorted(got) == list(range(60))


def test_sink_without_an_index_gets_one(spark):
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("landing", "sink", "ckpt"))
    frame(spark, range(10)).write.parquet(f"{sink}/{ST.BATCH}=old-0")
    frame(spark, range(5, 15)).write.parquet(landing)
    ST.run_ingest(spark, landing, "k long, v string", sink, ckpt, ["k"], ["v"])
    assert sorted(r["k"] for r in spark.read.parquet(sink).collect()) == list(range(15))


def test_fold_starts_from_the_snapshot(spark):
    sink, rng, fields = scratch_path(spark, "log"), random.Random(2), ["a", "b"]

    def arrive(batch):
        rows = [(rng.randrange(20), rng.choice([None, "", "x", "y", str(batch)]), rng.choice([None, str(batch)])) for _ in range(15)]
        spark.createDataFrame(rows, "k long, a string, b string").write.parquet(f"{sink}/batch_id={batch}")

    def folded():
        return sorted((r["k"], r["a"] or "", r["b"] or "") for r in ST.latest_updates(spark, sink, ["k"], fields).collect())

    for batch in range(3):
        arrive(batch)
    before = folded()
    assert ST.compact_updates(spark, sink, ["k"], fields) == 2 and folded() == before
    assert ST.compact_updates(spark, sink, ["k"], fields) == 2  # nothing new
    arrive(3)
    pending = ST.pending_updates(spark, sink, ["k"], fields)
    assert pending.count() == 15 + len(before) and pending.agg({"batch_id": "min"}).first()[0] == 2
    after = folded()
    assert ST.compact_updates(spark, sink, ["k"], fields) == 3 and folded() == after
    arrive(4)
    rows = spark.read.parquet(sink).collect()  # the same fold over the whole log
    want = {}
    for r in sorted(rows, key=lambda r: r["batch_id"]):
        for f in fields:
            if r[f]:
                old = want.setdefault(r["k"], {}).get(f, (-1, ""))
                want[r["k"]][f] = max(old, (r["batch_id"], r[f]))
    keys = {r["k"] for r in rows}
    assert folded() == sorted((k, want.get(k, {}).get("a", (0, ""))[1], want.get(k, {}).get("b", (0, ""))[1]) for k in keys)


def test_state_falls_after_the_watermark(spark):
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("landing", "sink", "ckpt"))
    schema = "id long, ts timestamp"

    def arrive(rows):
        spark.createDataFrame([(i, t) for i, t in rows], "id long, t string").selectExpr("id", "CAST(t AS timestamp) AS ts").write.mode(
            "append").parquet(landing)
        progress = ST.run_dedupe(spark, landing, schema, ["id"], sink, ckpt, event_time="ts", delay="10 minutes")
        return progress["stateOperators"][0]["numRowsTotal"]

    first = arrive([(i, "2026-01-01 00:00:00") for i in range(50)] + [(7, "2026-01-01 00:05:00")])
    assert first == 50
    arrive([(3, "2026-01-01 00:06:00"), (100, "2026-01-01 02:00:00")])  # a repeat within the delay; then time goes on
    last = arrive([(101, "2026-01-01 02:01:00"), (4, "2026-01-01 00:00:30")])  # the last row is late
    assert last < 10  # the first fifty keys have been dropped
    got = sorted(r["id"] for r in spark.read.parquet(sink).collect())
    assert got == [*range(50), 100, 101]


def test_unknown_runs_are_removed_after_a_merge(spark):
    path = scratch_path(spark, "seen")
    for b in range(5):
        index = SeenKeys(spark, path, ["k"], fan_out=2)
        fresh, n = index.unseen(frame(spark, range(b * 10, b * 10 + 10)))
        index.add(fresh, n, "s", b)
    assert sorted(r["k"] for run in SeenKeys(spark, path, ["k"], fan_out=2).runs for r in index._run(run).collect()) == list(range(50))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{path}/run-000000001-0")

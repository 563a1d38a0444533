"""Registered queries: CSV round trip and resume load (S1-S3), run counters (A11),
streaming ingest / de-dup / enrichment / scoring (ST1-ST4)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from sylvan.operators import html_extract as H
from sylvan.operators import prep
from sylvan.plans import html_queries as HQ
from sylvan.plans import prep_queries as PQ
from sylvan.plans import trees as TQ
from sylvan.plans.common import LI_KEYS, lineitem_binned
from sylvan.plans.registry import register
from sylvan.session import scratch_path
from sylvan.sources.csv import load_or_empty, read_csv, write_csv
from sylvan.sources.tables import table
from sylvan.streaming import ingest as ST

CUSTOMER_SCHEMA = StructType([
    StructField("c_custkey", LongType()), StructField("c_name", StringType()),
    StructField("c_nationkey", IntegerType()), StructField("c_acctbal", DoubleType()),
    StructField("c_mktsegment", StringType()),
])


@register("src_csv_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_csv_roundtrip(spark, sf):
    path = write_csv(table(spark, sf, "customer"), scratch_path(spark, "csv-customer"))
    return read_csv(spark, path, CUSTOMER_SCHEMA)


@register("load_or_empty", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def load_or_empty_q(spark, sf):
    path = write_csv(table(spark, sf, "customer"), scratch_path(spark, "csv-customer"))
    missing = scratch_path(spark, "csv-missing")
    return load_or_empty(spark, path, CUSTOMER_SCHEMA).unionByName(load_or_empty(spark, missing, CUSTOMER_SCHEMA))


_SEEN_SQL = "SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'"


@register("run_counters",
          f"SELECT count(*) AS n_rows, count(*) FILTER (WHERE c_custkey IN ({_SEEN_SQL})) AS n_skipped, "
          f"count(*) FILTER (WHERE c_custkey NOT IN ({_SEEN_SQL})) AS n_new FROM customer "
          f"WHERE c_custkey // {HQ.ROWS_PER_PAGE} NOT IN ({HQ._BAD_PAGES_SQL})")
def run_counters(spark, sf):
    """Counters of one ingest run, all in a single aggregate."""
    rows = H.player_rows(HQ._list_els(spark, sf), ["page_no"])
    seen = (table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
            .select(F.concat(F.lit("/p/"), F.col("o_custkey").cast("string")).alias("player_url")).distinct())
    flagged = rows.join(seen.withColumn("_seen", F.lit(True)), "player_url", "left")
    return flagged.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("_seen").isNotNull()).alias("n_skipped"),
                       F.count_if(F.col("_seen").isNull()).alias("n_new"))


_TODO_SQL = "player_url IS NOT NULL AND player_url <> '' AND p.position_list IS NULL"
_FOUND_SQL = "(coalesce(e.position_list, '') <> '' OR coalesce(e.work_rate, '') <> '')"


@register("enrich_counters",
          f"SELECT count(*) FILTER (WHERE {_TODO_SQL}) AS n_tasks, count(*) FILTER (WHERE ({_TODO_SQL}) AND {_FOUND_SQL}) AS n_success, "
          f"count(*) FILTER (WHERE ({_TODO_SQL}) AND NOT {_FOUND_SQL}) AS n_error, "
          f"count(*) FILTER (WHERE NOT coalesce({_TODO_SQL}, false)) AS n_skipped FROM ({PQ._PLAYERS_SQL}) p "
          f"LEFT JOIN (SELECT r.* FROM ({HQ.ENRICH_RECORD_SQL}) r JOIN customer k ON k.c_custkey = r.c_custkey "
          "WHERE k.c_nationkey <> 6) e ON p.idx = e.c_custkey")
def enrich_counters(spark, sf):
    """Tasks, successes, errors and skips of the second pass; customers of nation 6 have no page,
    so their tasks are errors.  Only pages of the work list are parsed."""
    rows = PQ.players(spark, sf)
    todo = prep.worklist(rows, "player_url", "position_list", "idx", "name").select(F.col("idx").alias("c_custkey"))
    pages = HQ.enrich_pages(spark, sf).join(
        table(spark, sf, "customer").where("c_nationkey <> 6").select("c_custkey"), "c_custkey", "left_semi")
    pages = pages.join(todo, "c_custkey", "left_semi")
    got = H.enrich_record(H.parse_pages(pages, ["c_custkey"], tags="span,li,div,p,a"), ["c_custkey"])
    return prep.second_pass_counters(rows, got.withColumnRenamed("c_custkey", "idx").withColumnRenamed("position_list", "positions"),
                                     "idx", "player_url", "position_list", ["positions", "work_rate"])


# --------------------------------------------------------------------------- streaming

EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _land_events_in_two_arrivals(spark, sf):
    """Stage the events table as two arrivals in a landing folder; the second also
    re-delivers the first arrival's clicks (duplicates a restart must absorb)."""
    e = table(spark, sf, "events")
    mid = e.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    first = e.where(F.col("event_id") <= mid)
    second = e.where(F.col("event_id") > mid).unionByName(first.where(F.col("event_type") == "click"))
    return first, second


@register("stream_ingest", "SELECT event_id, user_id, event_type, value FROM events")
def stream_ingest(spark, sf):
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("landing-events", "sink-events", "ckpt-events"))
    first, second = _land_events_in_two_arrivals(spark, sf)
    first.write.mode("append").parquet(landing)
    ST.run_ingest(spark, landing, EVENTS_SCHEMA, sink, ckpt, ["event_id"], ["ts", "event_id"])
    second.write.mode("append").parquet(landing)
    ST.run_ingest(spark, landing, EVENTS_SCHEMA, sink, ckpt, ["event_id"], ["ts", "event_id"])  # restart
    ST.run_ingest(spark, landing, EVENTS_SCHEMA, sink, ckpt, ["event_id"], ["ts", "event_id"])  # nothing new
    return spark.read.parquet(sink).select("event_id", "user_id", "event_type", "value")


@register("stream_dedupe", "SELECT DISTINCT event_type, user_id FROM events")
def stream_dedupe(spark, sf):
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("landing-dedupe", "sink-dedupe", "ckpt-dedupe"))
    first, second = _land_events_in_two_arrivals(spark, sf)
    first.write.mode("append").parquet(landing)
    ST.run_dedupe(spark, landing, EVENTS_SCHEMA, ["event_type", "user_id"], sink, ckpt)
    second.write.mode("append").parquet(landing)
    ST.run_dedupe(spark, landing, EVENTS_SCHEMA, ["event_type", "user_id"], sink, ckpt)
    return spark.read.parquet(sink).select("event_type", "user_id")


@register("stream_dedupe_bounded", "SELECT event_id, user_id, event_type FROM events")
def stream_dedupe_bounded(spark, sf):
    """ST3 with bounded state: repeats within the watermark's delay go.  Arrivals follow the event time here, and the
    delay covers one of them, so nothing is late."""
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("landing-bounded", "sink-bounded", "ckpt-bounded"))
    e = table(spark, sf, "events")
    times = e.agg(*[F.percentile_approx(F.col("ts").cast("timestamp"), q).alias(f"q{i}") for i, q in enumerate((0.25, 0.5, 0.75))]).first()
    at = F.col("ts").cast("timestamp")
    span = e.agg((F.max(at).cast("long") - F.min(at).cast("long") + 1).alias("s")).first()["s"]
    bounds = [None, *times, None]
    for lo, hi in zip(bounds, bounds[1:]):
        part = e if lo is None else e.where(at > F.lit(lo))
        part = part if hi is None else part.where(at <= F.lit(hi))
        part.unionByName(part.where("event_type = 'click'")).write.mode("append").parquet(landing)  # clicks come twice
        ST.run_dedupe(spark, landing, EVENTS_SCHEMA, ["event_id"], sink, ckpt, event_time="ts", delay=f"{span} seconds")
    return spark.read.parquet(sink).select("event_id", "user_id", "event_type")


PAGES_SCHEMA = "c_custkey long, html string"


@register("stream_enrich",
          f"SELECT p.idx AS c_custkey, CASE WHEN p.position_list IS NULL THEN nullif(e.position_list, '') ELSE p.position_list "
          f"END AS position_list, CASE WHEN p.position_list IS NULL THEN nullif(e.work_rate, '') END AS work_rate FROM (SELECT c_custkey AS idx, CASE WHEN c_acctbal > 5000 THEN c_mktsegment END AS position_list "
          f"FROM customer) p LEFT JOIN ({HQ.ENRICH_RECORD_SQL}) e ON p.idx = e.c_custkey")
def stream_enrich(spark, sf):
    """ST2: rows still without a position list are enriched from pages arriving in two batches;
    pages of rows that have one are not parsed and change nothing."""
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("landing-enrich", "sink-enrich", "ckpt-enrich"))
    pages = HQ.enrich_pages(spark, sf)
    pages.where(F.col("c_custkey") % 2 == 0).write.mode("append").parquet(landing)

    base = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment")).alias("position_list"),
        F.lit(None).cast("string").alias("work_rate"))
    missing = base.where("position_list IS NULL").select("c_custkey")

    def extract(df):
        todo = df.join(missing, "c_custkey", "left_semi")
        return H.enrich_record(H.parse_pages(todo, ["c_custkey"], tags="span,li,div,p,a"), ["c_custkey"])

    ST.run_keyed_updates(spark, landing, PAGES_SCHEMA, extract, sink, ckpt)
    pages.where(F.col("c_custkey") % 2 == 1).write.mode("append").parquet(landing)
    ST.compact_updates(spark, sink, ["c_custkey"], ["position_list", "work_rate"])
    ST.run_keyed_updates(spark, landing, PAGES_SCHEMA, extract, sink, ckpt)
    upd = ST.latest_updates(spark, sink, ["c_custkey"], ["position_list", "work_rate"])
    return prep.keyed_update(base, upd, ["c_custkey"], ["position_list", "work_rate"])


@register("stream_score",
          f"SELECT {', '.join(LI_KEYS)}, prediction FROM ({TQ._spec_sql('cls_ig', 'predict')})")
def stream_score(spark, sf):
    """ST4: score lineitem rows arriving as a stream with the fitted information-gain tree."""
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("landing-score", "sink-score", "ckpt-score"))
    rows = lineitem_binned(spark, sf)
    rows.write.mode("append").parquet(landing)
    m = TQ.model(spark, sf, "cls_ig")
    ST.run_scoring(spark, landing, rows.schema, lambda s: m.predict(s).select(*LI_KEYS, "prediction"), sink, ckpt)
    return spark.read.parquet(sink)

"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from sylvan.llm import (alignment, bpe, decontam, langid, licences, line_dedup, multi_index, near_dups, quality, spelling, token_counts,
                        token_files, warc)
from sylvan.session import scratch_path
from sylvan.sources.tables import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark, sf_dir):
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


@query
def op5_token_files(spark, sf_dir):
    path = scratch_path(spark, "op5")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, WORD_BPE, end_id=2)
    return token_files.read_checksums(spark, path)


@query
def op7_decontamination(spark, sf_dir):
    return decontam.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _runs_sql(k):
    """Runs of k words in documents, where an item's shingles have that length."""
    return (f"SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i+{k - 1}], ' '))) AS s "
            f"FROM d WHERE {k} IN (SELECT least(len(w), 5) FROM b)")


ORACLES["op7_decontamination"] = rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS w FROM benchmark),
ds AS ({" UNION ALL ".join(map(_runs_sql, range(1, 6)))}),
bs AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i+4], ' '))) AS s
  FROM b WHERE len(w) > 0),
n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM m JOIN n USING (item_id) WHERE n_shared / n_shingles >= 0.8
"""


@query
def op8_warc(spark, sf_dir):
    path = warc.write_archive(table(spark, sf_dir, "pages"), scratch_path(spark, "op8"))
    return warc.read_records(spark, path)


ORACLES["op8_warc"] = """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS d, strlen(coalesce(html, ''))::BIGINT AS n FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS keeper FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN n < 100 OR page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN n < 100 OR page_id = keeper THEN NULL ELSE keeper END AS refers_to
FROM q
"""


@query
def op9_bpe(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op10_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = line_dedup.drop_repeated_lines(docs)
    return cleaned.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                          F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op10_line_dedup"] = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, f.key IS NOT NULL AS dropped FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query
def op2_nearest_vectors(spark, sf_dir):
    return multi_index.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op3_language(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op4_licences(spark, sf_dir):
    return licences.scan(table(spark, sf_dir, "documents"))


@query
def op6_near_duplicates(spark, sf_dir):
    found = near_dups.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "copy_id", "n_links")


@query
def op11_quality(spark, sf_dir):
    return quality.rate_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Occurrences of which one in so many loses a code point before words are counted.
SLIP = 31


@query
def op12_spelling(spark, sf_dir):
    found = spelling.runs(table(spark, sf_dir, "documents"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    found = found.withColumn("h", h).withColumn("k", (F.col("h") % F.char_length("run")).cast("int"))
    word = F.when(F.col("h") % SLIP == 0, F.expr("concat(substring(run, 1, k), substring(run, k + 2))")).otherwise(F.col("run"))
    grouped = spelling.group_variants(spelling.count_words(found, word))
    return grouped.select("word", "form", "root", "n", "n_near", "form_n")


@query
def op13_alignment(spark, sf_dir):
    path = scratch_path(spark, "op13")
    groups = alignment.token_groups(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    (groups.withColumn("groups_sha256", digest).drop("groups").withColumn("row", F.monotonically_increasing_id())
     .write.parquet(f"{path}/aligned"))
    aligned = spark.read.parquet(f"{path}/aligned")
    scores = alignment.link_scores(aligned).withColumnRenamed("row", "of")
    return aligned.join(scores, F.col("row") == F.col("of"), "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")

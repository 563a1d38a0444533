"""Benchmark passages inside documents: size-partitioned MinHash containment search.

Test items are short and documents can be very long, so the similarity of the
two sets says little; what counts is containment, the share of an item's
five-word shingles that the document holds.  Under one hash function the
smallest value of an item's shingles falls inside a document with probability
equal to that containment, whatever the document's size.  The search therefore
keeps, for each item, its ``m`` smallest shingle hashes (its MinHash values).
Items are partitioned by size, and a partition's ``m`` is the number that
misses an item at the threshold with probability below ``MISS``; items with no
more shingles than that keep all.  A document that holds any of an item's
values is a candidate.

Candidates are verified exactly: the item's whole shingle set is looked up in
the candidate's, and the share must reach the threshold.

All of it is DataFrame work.  Documents are hashed in place; the one table
joined with all shingles is the items' values, ``m`` at most per item.  It is
broadcast only while its counted size proves it small (``BROADCAST_ROWS`` rows
of 24 bytes), otherwise the join shuffles.  A passage found in a third of all
documents gives one row per document.

Words are the lower-cased runs of letters and digits.  An item of fewer than
five words is one shingle of all its words; documents are hashed at such a
length only if an item has it.  Defined results: null texts and items without
a word hold nothing and are never found; a text shorter than an item does not
hold it; rows repeated with the same id and text give their pair once, of
different texts under one id the one that holds most counts; empty tables give
no row; very long texts are hashed whole; other columns, whatever their names,
are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.session import scratch_path

WORDS = 5
CONTAINMENT = 0.8
MISS = 1e-9
BROADCAST_ROWS = 1_000_000


def words_of(text):
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(words, n: int = WORDS):
    """Array of the 64-bit hashes of all runs of ``n`` words (with repeats)."""
    return F.when(F.size(words) >= n, F.transform(
        F.sequence(F.lit(0), F.size(words) - n), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(n))))
    ).otherwise(F.array().cast("array<bigint>"))


def values_needed(threshold: float = CONTAINMENT, miss: float = MISS) -> int:
    """MinHash values of which at least one is found, but for a probability of ``miss``."""
    return max(1, math.ceil(math.log(miss) / math.log(max(1e-9, 1 - threshold))))


def item_sketches(items: DataFrame, id_col: str, text_col: str, threshold: float, n: int):
    """``item_id, length, size_class, n_shingles, shingles, sketch`` of each item; ``length`` is its shingles' words."""
    m = values_needed(threshold)
    words = (items.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("w"))
             .withColumn("length", F.least(F.size("w"), F.lit(n))))
    hashes = F.array().cast("array<bigint>")
    for k in range(n, 0, -1):
        hashes = F.when(F.col("length") == k, shingle_hashes(F.col("w"), k)).otherwise(hashes)
    base = (words.select("item_id", "length", F.array_sort(F.array_distinct(hashes)).alias("shingles"))
            .withColumn("n_shingles", F.size("shingles")))
    # partitions: up to m shingles all are kept; in each doubling above, a part of the m may repeat a word run
    # across items, so one more value per doubling is kept
    size_class = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest("n_shingles", F.lit(1)) / m))).cast("int")
    return (base.withColumn("size_class", size_class)
            .withColumn("sketch", F.slice("shingles", 1, F.lit(m) + F.col("size_class"))))


def document_hashes(words, lengths: list[int]):
    """The hashes of all runs of the given numbers of words."""
    found = [shingle_hashes(words, k) for k in lengths]
    return F.concat(*found) if len(found) > 1 else found[0]


def find_versions(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", threshold: float = CONTAINMENT, n: int = WORDS) -> DataFrame:
    """``doc_id, version, item_id, n_shingles, n_shared, containment``; ``version`` is the 64-bit hash of the text."""
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "decontam")
    item_sketches(items, item_id_col, item_text_col, threshold, n).write.parquet(f"{path}/items")
    sketches = spark.read.parquet(f"{path}/items").where(F.col("n_shingles") > 0)
    values = sketches.select("item_id", F.explode("sketch").alias("h"))
    n_values, short = sketches.agg(F.coalesce(F.sum(F.size("sketch")), F.lit(0)), F.sort_array(F.collect_set("length"))).first()
    lengths = short or [n]  # at most n numbers
    if n_values <= BROADCAST_ROWS:
        values = F.broadcast(values)

    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    # the words are a column of their own: inside the lambda they would be split again for each shingle
    hashed = (base.withColumn("w", words_of(F.col("text")))
              .select("doc_id", "version", document_hashes(F.col("w"), lengths).alias("hs")))
    # explode_outer: a plain explode adds a filter that is pushed below the words and splits them for each shingle
    (hashed.select("doc_id", "version", F.explode_outer("hs").alias("h")).join(values, "h")
     .select("doc_id", "version", "item_id").distinct().write.parquet(f"{path}/candidates"))
    found = spark.read.parquet(f"{path}/candidates")

    # exact: the candidates' texts, their shingles met with the whole sets of their candidate items
    holders = found.select("doc_id", "version").distinct()
    texts = (base.join(holders.withColumnsRenamed({"doc_id": "d", "version": "v"}),
                       F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v")), "left_semi")
             .dropDuplicates(["doc_id", "version"])
             .withColumn("w", words_of(F.col("text")))
             .select("doc_id", "version", F.array_distinct(document_hashes(F.col("w"), lengths)).alias("hs")))
    sets = sketches.select(F.col("item_id").alias("i"), "shingles", "n_shingles")
    pairs = found.join(sets, F.col("item_id").eqNullSafe(F.col("i"))).drop("i")
    shared = F.size(F.array_intersect("hs", "shingles"))
    return (pairs.join(texts.withColumnsRenamed({"doc_id": "d", "version": "v"}),
                       F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v")))
            .select("doc_id", "version", "item_id", F.col("n_shingles").cast("long").alias("n_shingles"), shared.cast("long").alias("n_shared"))
            .groupBy("doc_id", "version", "item_id").agg(F.max("n_shingles").alias("n_shingles"), F.max("n_shared").alias("n_shared"))
            .withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
            .where(F.col("containment") >= threshold))


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
               item_text_col: str = "text", threshold: float = CONTAINMENT, n: int = WORDS) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_shared, containment`` of every document that holds an item."""
    found = find_versions(docs, items, id_col, text_col, item_id_col, item_text_col, threshold, n)
    return (found.groupBy("doc_id", "item_id").agg(F.max("n_shingles").alias("n_shingles"), F.max("n_shared").alias("n_shared"))
            .withColumn("containment", F.col("n_shared") / F.col("n_shingles")))

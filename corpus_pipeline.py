"""A corpus pipeline over ``documents``: five stages, each one operator of ``sylvan.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet to the shared folder and hands the next stage what it
reads back.  All stages but the last return the columns of ``documents``.

* ``language``       drops documents in which no language can be told (null
                     text or no letter); the rest stay as they are
* ``line_dedup``     takes lines found in ten or more documents out of texts
* ``near_dups``      keeps one document of each near-duplicate group: the one
                     with the smallest id
* ``decontaminate``  drops documents that hold a benchmark item (rows are told apart by id and text, so others of
                     the same or of no id stay)
* ``bpe``            encodes and decodes the texts and returns their digests

Defined results: repeated rows are exact copies, of which one stays; documents
without a word have no near duplicates and stay; a text that line dedup
empties stays as an empty text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sylvan.llm import bpe, decontam, langid, line_dedup, near_dups
from sylvan.llm.joins import stored_keys
from sylvan.llm.queries import BYTE_BPE
from sylvan.session import scratch_path
from sylvan.sources.tables import table


def language(spark, docs, sf_dir):
    model = langid.train(docs.where(~langid.held_out()))
    return docs.where(langid.predict(F.col("text"), model)["lang_pred"] != langid.UNDETERMINED)


def dedup_lines(spark, docs, sf_dir):
    return line_dedup.drop_repeated_lines(docs).drop("__n_lines", "__n_dropped")


def _whole(docs, version):
    """Rows as one column, with their id and the hash of their text: no name of a row's own can clash."""
    return docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), version.alias("hash"))


def dedup_documents(spark, docs, sf_dir):
    path = scratch_path(spark, "pipeline-near-dups")
    near_dups.near_duplicates(docs).select("doc_id", "version", "is_kept", "has_words").write.parquet(f"{path}/found")
    found = spark.read.parquet(f"{path}/found")
    key = [F.col("doc_id").alias("d"), F.col("version").alias("v")]
    gone = found.where(~F.col("is_kept")).select(*key).distinct()
    # repeats of a kept row (same id and text): taken out of the main path, and one of each is put back
    again = (found.where(F.col("is_kept") & F.col("has_words")).groupBy("doc_id", "version").agg(F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(*key))
    here = _whole(docs, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    same = F.col("id").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("v"))
    once = here.join(stored_keys(gone.unionAll(again), f"{path}/out"), same, "left_anti")
    repeated = here.join(stored_keys(again, f"{path}/again"), same, "left_semi").dropDuplicates(["id", "hash"])
    return once.unionAll(repeated).select("row.*")


def decontaminate(spark, docs, sf_dir):
    found = decontam.find_versions(docs, table(spark, sf_dir, "benchmark"))
    holders = found.select(F.col("doc_id").alias("d"), F.col("version").alias("v")).distinct()
    holders = stored_keys(holders, scratch_path(spark, "pipeline-holders"))
    same = F.col("id").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("v"))
    return _whole(docs, F.xxhash64("text")).join(holders, same, "left_anti").select("row.*")


def encode(spark, docs, sf_dir):
    return bpe.round_trip(docs, BYTE_BPE)


STAGES = [("language", language), ("line_dedup", dedup_lines), ("near_dups", dedup_documents),
          ("decontaminate", decontaminate), ("bpe", encode)]

#: The mixture model, the pruned join and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs, path = table(spark, sf_dir, "documents"), scratch_path(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{k}-{name}")
        docs = spark.read.parquet(f"{path}/{k}-{name}")
    return docs

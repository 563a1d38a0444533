"""Removal of repeated lines through levelled sorted runs of line hashes.

``LineRuns`` is a store of runs ``(h1, h2, n)``: 128-bit hashes of line keys
with the number of documents that hold the line.  Each run is sorted and
hash-partitioned by the key.  A new batch of documents

1. counts its documents per line key,
2. merge-anti-joins the stored runs' saturated keys (those that already stand
   in ``min_docs`` documents: more would change nothing),
3. adds the rest as a run of its own at level 0.

When a level holds ``fan_out`` runs they are compacted into one run of the
next level, so a key is rewritten once per level.  ``frequent`` merges what is
left.  Everything is DataFrame work; state lives in the shared folder.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z
lower-cased.  ``drop_repeated_lines`` removes every line whose key has at
least ``min_chars`` code points and stands in at least ``min_docs`` documents.
Texts cross the network once, in the join that hands each document the
positions of its lines to drop; hashes and positions are all that is shuffled
otherwise.  A line that stands in a third of all documents is one key with
partial counts before each shuffle; in the join it is a skewed key of an
equi-join, which adaptive execution splits.

Defined results: null or empty text is one empty line, which is never dropped
(its key has no code point); a document is an id, so repeated rows count once
and are each cleaned; null ids count as one document; columns keep their
names, extra ones are passed through whatever they are called (but
``__n_lines`` and ``__n_dropped``, which are the results' names: an error); an
empty table gives no row; the work on a text is linear in its lines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.session import scratch_path

MIN_DOCS = 10
MIN_CHARS = 1
BATCHES = 4
FAN_OUT = 2

# fixed values: the characters stripped from a line, and the letters folded
STRIPPED = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RUN = "h1 long, h2 long, n long"


def line_key(line):
    """Strip and fold a line (ASCII lines take the faster whole-string lower-casing, with the same result)."""
    s = F.btrim(line, F.lit(STRIPPED))
    return F.when(F.octet_length(s) == F.char_length(s), F.lower(s)).otherwise(F.translate(s, UPPER, LOWER))


def _hash_pair(key):
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2"))


class LineRuns:
    def __init__(self, spark: SparkSession, path: str, min_docs: int = MIN_DOCS, fan_out: int = FAN_OUT):
        self.spark, self.path, self.min_docs, self.fan_out = spark, path, min_docs, fan_out
        self.levels: list[list[str]] = []
        self.written = 0

    def _write(self, counts: DataFrame) -> str:
        out = f"{self.path}/run-{self.written:06d}"
        self.written += 1
        counts.select("h1", "h2", "n").sortWithinPartitions("h1", "h2").write.parquet(out)
        return out

    def _merged(self, runs: list[str]) -> DataFrame:
        tables = [self.spark.read.schema(RUN).parquet(r) for r in runs]
        return reduce(DataFrame.unionAll, tables).groupBy("h1", "h2").agg(F.sum("n").alias("n"))

    def _all(self) -> list[str]:
        return [r for level in self.levels for r in level]

    def add(self, lines: DataFrame) -> None:
        """A batch of ``(doc, h1, h2)`` lines; a document's lines come in one batch."""
        counts = (lines.groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one"))
                  .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")))
        if self._all():
            done = self._merged(self._all()).where(F.col("n") >= self.min_docs)
            counts = counts.join(done.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        self._push(0, self._write(counts))

    def _push(self, level: int, run: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan_out:
            runs, self.levels[level] = self.levels[level], []
            self._push(level + 1, self._write(self._merged(runs)))

    def frequent(self) -> DataFrame:
        """``(h1, h2)`` of the lines found in at least ``min_docs`` documents."""
        if not self._all():
            return self.spark.createDataFrame([], "h1 long, h2 long")
        return self._merged(self._all()).where(F.col("n") >= self.min_docs).select("h1", "h2")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                        min_chars: int = MIN_CHARS, batches: int = BATCHES, fan_out: int = FAN_OUT) -> DataFrame:
    """``docs`` with the text cleaned, plus ``__n_lines`` and ``__n_dropped``."""
    if {"__n_lines", "__n_dropped"} & set(docs.columns):
        raise ValueError("the results are called __n_lines and __n_dropped; rename those columns")
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "line-dedup")
    text = F.coalesce(F.col(text_col), F.lit(""))
    doc = F.col(id_col)
    version = F.xxhash64(text)  # tells apart rows that share an id
    lines = (docs.select(doc.alias("doc"), version.alias("version"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
             .withColumn("key", line_key(F.col("line")))
             .where(F.char_length("key") >= min_chars)
             .select("doc", "version", "pos", _hash_pair(F.col("key")).alias("h"))
             .select("doc", "version", "pos", "h.h1", "h.h2", F.pmod(F.xxhash64("doc"), F.lit(batches)).cast("int").alias("batch")))
    lines.write.partitionBy("batch").parquet(f"{path}/lines")
    schema = lines.schema
    stored = spark.read.schema(schema).parquet(f"{path}/lines")

    runs = LineRuns(spark, f"{path}/runs", min_docs, fan_out)
    for b in range(batches):
        runs.add(stored.where(F.col("batch") == b).select("doc", "h1", "h2"))

    drops = (stored.join(runs.frequent(), ["h1", "h2"], "left_semi")
             .groupBy("doc", "version").agg(F.collect_set("pos").alias("drop")))
    # the row travels as one column, so no name of its own can clash
    joined = docs.select(F.struct("*").alias("row"), doc.alias("id"), version.alias("hash")).join(
        drops, F.col("id").eqNullSafe(F.col("doc")) & (F.col("hash") == F.col("version")), "left")
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    # linear: the positions that stay, then their lines; the one-item array names the split lines, which
    # would be split again for each position otherwise
    both = F.array(F.struct(F.split(text, "\n", -1).alias("lines"), F.col("drop").alias("drop")))
    kept = F.get(F.transform(both, lambda x: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), x["drop"]), lambda p: F.get(x["lines"], p)), "\n")), F.lit(0))
    return joined.select(
        *((F.when(F.col("drop").isNull(), text).otherwise(kept) if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns),
        (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("__n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("__n_dropped"))

"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of hashed five-word shingles (words: lower-cased runs of
letters and digits; a text of fewer words is one shingle).  Rows with equal
sets form a *class*; everything below works on one representative a class, so
copies are never paired.

1. Signatures.  ``BANDS * ROWS`` MinHash values per class; two classes meet if
   they agree on a whole band (at similarity 0.8 all bands miss with a
   probability of 7e-6).  Classes that meet are linked to the smallest class of
   their bucket, and connected components give candidate *groups*.
2. Units of work.  A group's classes are dealt to blocks of about ``BLOCK``
   members by hash, and each pair of blocks is one unit, so a group of any size
   is spread over many tasks, each of bounded size.  That suits groups whose
   members are mostly alike.  A group that is a long chain of small buckets is
   dealt by bucket instead (a hot bucket again in pairs of blocks), and a pair
   counts in its first common band only; of the two ways each group takes the
   one with fewer copies of its members, so a chain costs what its buckets do.
3. Bayesian pruning.  In a unit, the pairs' MinHash values are compared a few at
   a time.  With a uniform prior, m agreements among h values leave a Beta
   posterior of the similarity; a pair is dropped as soon as the probability of
   reaching the threshold falls below ``TOLERANCE``.
4. What is left is verified exactly on the shingle sets.

A unit returns a row per member with its number of links and one edge to a
local root (a spanning forest), not the pairs; components of those edges are
the near-duplicate groups.

Node numbers are the 64-bit hash of the shingle set.  Defined results: a null
text or one without a word has no shingle, no link and is a group of its own
(per row); rows with the same id are told apart by their text; exact repeats
belong to the same class; a null id sorts before all others as a group's name;
an empty table gives no row; texts of any length are shingled whole; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.llm.components import components
from sylvan.llm.joins import stored_keys
from sylvan.llm.workers import held, small_batches
from sylvan.session import scratch_path

WORDS = 5
SIMILARITY = 0.8
BANDS = 30
ROWS = 5
STEP = 15
TOLERANCE = 1e-6
BLOCK = 256
CACHE_WORDS = 150_000

WORD = re.compile(r"[^\W_]+").findall
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _odd(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


class Shingler:
    """Shingle sets and MinHash signatures of texts (numpy; one per worker)."""

    def __init__(self, n: int = WORDS, values: int = BANDS * ROWS):
        self.n, self.words = n, {}
        self.weights = _odd(n, 7)
        self.a = (_odd(values, 11) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        self.b = (_odd(values, 13) >> np.uint64(32)).astype(np.uint32)

    def shingles(self, text: str | None) -> np.ndarray:
        """The sorted distinct 64-bit shingle hashes of a text."""
        words = WORD(text.lower()) if text else ()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        known = self.words
        try:
            h = np.array([known[w] for w in words], np.uint64)
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            h = np.array([known[w] for w in words], np.uint64)
        k = min(self.n, len(h))
        total = np.zeros(len(h) - k + 1, np.uint64)
        for i in range(k):
            total += h[i:len(h) - k + 1 + i] * self.weights[i]
        return np.unique(_mix(total + np.uint64(k)))

    def signature(self, s: np.ndarray) -> np.ndarray:
        x = (s >> np.uint64(32)).astype(np.uint32)
        out = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), 4096):
            np.minimum(out, (self.a[:, None] * x[None, i:i + 4096] + self.b[:, None]).min(axis=1), out=out)
        return out


def set_hash(s: np.ndarray) -> int:
    """64-bit hash of a shingle set, as a signed number."""
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def band_hashes(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    bands = sig.reshape(-1, rows).astype(np.uint64)
    out = np.arange(1, len(bands) + 1, dtype=np.uint64)
    for r in range(rows):
        out = _mix(out * _M2 + bands[:, r])
    return out.view(np.int64)


def least_matches(threshold: float, values: int, step: int, tolerance: float) -> dict[int, int]:
    """For each number of compared values, the fewest agreements that keep a pair.

    P(similarity >= t | m of h agree) under a uniform prior is the upper tail
    of Beta(m + 1, h - m + 1), a binomial sum.
    """
    out = {}
    for h in [*range(step, values, step), values]:
        tail, m = 0.0, -1
        while tail < tolerance and m < h:
            m += 1
            tail = sum(math.comb(h + 1, j) * threshold ** j * (1 - threshold) ** (h + 1 - j) for j in range(m + 1))
        out[h] = m
    return out


def linked_pairs(sigs_a, sets_a, sigs_b, sets_b, same: bool, threshold: float, least: dict[int, int]):
    """Index pairs (i, j) whose exact Jaccard similarity reaches the threshold, by pruned comparison."""
    every = [*sets_a, *([] if same else sets_b)]
    vocab, ids = np.unique(np.concatenate(every), return_inverse=True)
    cuts = np.cumsum([0, *map(len, every)])
    member = [ids[cuts[i]:cuts[i + 1]] for i in range(len(every))]
    member_b = member if same else member[len(sets_a):]
    size_b = np.array([len(s) for s in (sets_a if same else sets_b)])
    mark = np.zeros(len(vocab), bool)
    for i, sig in enumerate(sigs_a):
        alive = np.arange(i + 1 if same else 0, len(sigs_b))
        agreed, done = np.zeros(len(alive), np.int64), 0
        for h, m in least.items():
            agreed += (sigs_b[alive, done:h] == sig[done:h]).sum(axis=1)
            keep = agreed >= m
            alive, agreed, done = alive[keep], agreed[keep], h
            if not len(alive):
                break
        if not len(alive):
            continue
        mark[member[i]] = True
        for j in alive:
            both = int(mark[member_b[j]].sum())
            if both >= threshold * (len(member[i]) + int(size_b[j]) - both):
                yield i, int(j)
        mark[member[i]] = False


def _shingler() -> Shingler:
    return held("near_dups", "shingler", Shingler)


def _signed(batches):
    """(id, version, text) to (id, version, node, bands); node is null for texts without words."""
    sh = _shingler()
    for batch in batches:
        nodes, bands = [], []
        for t in batch.column(2):
            s = sh.shingles(t.as_py())
            nodes.append(set_hash(s) if len(s) else None)
            bands.append(band_hashes(sh.signature(s)) if len(s) else np.zeros(0, np.int64))
        cuts = np.cumsum([0, *map(len, bands)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(nodes, pa.int64()),
             pa.ListArray.from_arrays(cuts, np.concatenate([np.zeros(0, np.int64), *bands]))],
            names=["doc_id", "version", "node", "bands"])


def _sets(batches):
    """(node, text) to (node, signature, shingles) as bytes."""
    sh = _shingler()
    for batch in batches:
        sets = [sh.shingles(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([sh.signature(s).tobytes() for s in sets], pa.binary()),
             pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "sig", "shingles"])


def first_band(a: np.ndarray, b: np.ndarray, rows: int = ROWS) -> int:
    """The first band in which two signatures agree."""
    return int((a == b).reshape(-1, rows).all(axis=1).argmax())


def _verifier(threshold: float, tolerance: float):
    least = least_matches(threshold, BANDS * ROWS, STEP, tolerance)

    def verify(table: pa.Table) -> pa.Table:
        nodes, blocks = table["node"].to_pylist(), table["block"].to_pylist()
        lo, hi, unit, by_bucket = (table[c][0].as_py() for c in ("lo", "hi", "unit", "by_bucket"))
        order = sorted(range(len(nodes)), key=nodes.__getitem__)
        sigs = [np.frombuffer(x.as_py(), np.uint32) for x in table["sig"]]
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table["shingles"]]
        a = [i for i in order if blocks[i] == lo]
        b = a if lo == hi else [i for i in order if blocks[i] == hi]
        links, root = dict.fromkeys(order, 0), {i: i for i in order}

        def find(i):
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        if a and b:
            for i, j in linked_pairs([sigs[i] for i in a], [sets[i] for i in a], np.stack([sigs[i] for i in b]),
                                     [sets[i] for i in b], lo == hi, threshold, least):
                i, j = a[i], b[j]
                if by_bucket and band_hashes(sigs[i])[first_band(sigs[i], sigs[j])] != unit:
                    continue
                links[i] += 1
                links[j] += 1
                i, j = find(i), find(j)
                root[max(i, j, key=nodes.__getitem__)] = min(i, j, key=nodes.__getitem__)
        out = [(nodes[i], links[i], nodes[find(i)]) for i in order if links[i]]
        cols = list(zip(*out)) or [()] * 3
        return pa.table({k: pa.array(c, pa.int64()) for k, c in zip(("node", "links", "root"), cols)})

    return verify


def deal(groups: DataFrame, bands: DataFrame, block: int, path: str) -> DataFrame:
    """``node, unit, by_bucket, block, blocks``: the units of each candidate group ``node, root``.

    ``bands`` has each node's buckets as an array (a node may stand in several rows).
    """
    spark = groups.sparkSession
    groups.groupBy("root").agg(F.count(F.lit(1)).alias("size")).withColumn("blocks", F.ceil(F.col("size") / block).cast("int")).write.parquet(f"{path}/sizes")
    sizes = spark.read.schema("root long, size long, blocks int").parquet(f"{path}/sizes")
    in_blocks = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    whole = groups.join(sizes, "root").select("node", F.col("root").alias("unit"), F.lit(False).alias("by_bucket"),
                                              in_blocks(F.col("blocks")).alias("block"), "blocks", "root")
    large = sizes.where("blocks > 1")
    if large.isEmpty():
        return whole.drop("root")
    # buckets of the large groups' members only; all members of a bucket are of one group
    groups.join(large, "root").write.parquet(f"{path}/large")
    members = spark.read.parquet(f"{path}/large")
    (bands.join(stored_keys(members.select("node"), f"{path}/large-keys"), "node").select("node", F.explode("bands").alias("bucket"))
     .distinct().write.parquet(f"{path}/met"))
    met = spark.read.schema("node long, bucket long").parquet(f"{path}/met")
    shared = met.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n_blocks"), F.count(F.lit(1)).alias("n")).where("n > 1")
    inside = met.join(shared, "bucket").join(members, "node").select("node", "root", "size", "bucket", "n_blocks", "blocks")
    inside.write.parquet(f"{path}/inside")
    inside = spark.read.parquet(f"{path}/inside")
    # copies of members: one per bucket and its blocks, against one per block of the whole group
    chains = (inside.groupBy("root").agg(F.sum("n_blocks").alias("copies"), F.max("size").alias("size"), F.max("blocks").alias("blocks"))
              .where(F.col("copies") < F.col("size") * F.col("blocks")).select("root"))
    dealt = inside.join(chains, "root", "left_semi").select(
        "node", F.col("bucket").alias("unit"), F.lit(True).alias("by_bucket"), in_blocks(F.col("n_blocks")).alias("block"), F.col("n_blocks").alias("blocks"))
    return whole.join(chains, "root", "left_anti").drop("root").unionByName(dealt)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY,
                    tolerance: float = TOLERANCE, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, version, class_id, copy_id, n_links, has_words, is_kept``.

    ``class_id`` names the near-duplicate group by its smallest id, ``copy_id``
    the rows with an equal shingle set; ``n_links`` counts the other shingle
    sets at or above the threshold; ``is_kept`` marks the row (and its exact
    repeats) that stands for the group.  ``version`` is the text's hash.
    """
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "near-dups")
    small_batches(spark)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("version"), F.col(text_col).alias("text"))
    schema = "doc_id long, version long, node long, bands array<long>"
    base.mapInArrow(_signed, schema).write.parquet(f"{path}/signed")
    signed = spark.read.schema(schema).parquet(f"{path}/signed")

    # classes and their representatives
    (signed.where("node IS NOT NULL").groupBy("node").agg(F.min(F.struct("doc_id", "version")).alias("rep"))
     .select("node", "rep.doc_id", "rep.version").write.parquet(f"{path}/classes"))
    classes = spark.read.schema("node long, doc_id long, version long").parquet(f"{path}/classes")

    # candidate groups: classes that share a bucket are joined to its smallest class
    banded = (signed.where("node IS NOT NULL").select("node", F.explode("bands").alias("bucket"))
              .groupBy("node", "bucket").agg(F.lit(1).alias("one")).select("node", "bucket"))
    hubs = (banded.groupBy("bucket").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    met = banded.join(hubs.select("bucket", "hub"), "bucket").where("node <> hub").select(F.col("node").alias("u"), F.col("hub").alias("v"))
    groups = components(met, f"{path}/groups")
    deal(groups, signed.where("node IS NOT NULL").select("node", "bands"), block, path).write.parquet(f"{path}/dealt")
    dealt = spark.read.schema("node long, unit long, by_bucket boolean, block int, blocks int").parquet(f"{path}/dealt")

    # the representatives' texts, once each, then a row per unit of work
    # (the keys are broadcast while few; beyond that the texts are shuffled once)
    keys = stored_keys(groups.join(classes, "node").select(F.col("doc_id").alias("d"), F.col("version").alias("v"), "node"), f"{path}/rep-keys")
    texts = (base.join(keys, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v")))
             .select("node", "text"))
    sets = texts.mapInArrow(_sets, "node long, sig binary, shingles binary").dropDuplicates(["node"])
    units = (sets.join(dealt, "node")
             .select("node", "sig", "shingles", "unit", "by_bucket", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select("node", "sig", "shingles", "unit", "by_bucket", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")))
    (units.groupBy("unit", "by_bucket", "lo", "hi").applyInArrow(_verifier(threshold, tolerance), "node long, links long, root long")
     .write.parquet(f"{path}/links"))
    links = spark.read.schema("node long, links long, root long").parquet(f"{path}/links")
    counted = links.groupBy("node").agg(F.sum("links").alias("n_links"))
    linked = components(links.select(F.col("node").alias("u"), F.col("root").alias("v")), f"{path}/linked")

    # names: the smallest row of each group
    named = (classes.join(linked, "node", "left").join(counted, "node", "left")
             .select("node", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                     F.struct("doc_id", "version").alias("rep")))
    named.write.parquet(f"{path}/named")
    named = spark.read.schema(named.schema).parquet(f"{path}/named")
    keepers = named.groupBy("root").agg(F.min("rep").alias("keeper"))
    nodes = named.join(keepers, "root").select("node", "n_links", F.col("rep.doc_id").alias("copy_id"), "keeper")
    lone = F.col("keeper").isNull()
    return signed.select("doc_id", "version", "node").join(nodes, "node", "left").select(
        "doc_id", "version",
        F.when(lone, F.col("doc_id")).otherwise(F.col("keeper.doc_id")).alias("class_id"),
        F.when(lone, F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.col("node").isNotNull().alias("has_words"),
        (lone | (F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("version") == F.col("keeper.version")))).alias("is_kept"))

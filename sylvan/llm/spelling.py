"""Spelling variants: words one edit apart, by sorted-list dynamic programming.

Two words are *near* if they differ by one inserted, deleted or replaced code
point.  Of a near pair either the first or the last half is the same in both
words, so words meet in ranges of the vocabulary that share a half (and the
length of the shorter word); the rest of each word is compared.  A task holds
its ranges as one sorted list and scans it depth by depth: words with the same
prefix are adjacent, so the rows of the edit matrix (banded: three cells, as
two edits are never of use) that belong to a prefix are worked out once for
all words that share it, which the longest common prefixes (LCPs) of adjacent
words tell.  A range of the list whose shared prefix already exceeds one edit
is skipped as a whole.  All words of a task are searched for at the same time,
with numpy.

Ranges are partitioned by their key and sorted by Spark; tasks stream over
them.  A key shared by more than ``BLOCK`` words is split into blocks, and
each pair of blocks is a range of its own, so no task holds more than two
blocks of one key.  What leaves a task is one row per word: the number of near
words and the best of them.

Defined results: words are distinct (``count_words`` makes them so); null
words take no part; a word without near words has count 0 and is its own root;
ties between near words go to the smallest word in code-point order; chains of
forms end, as each form is ``ratio`` times as frequent as the word before it;
an empty table gives no row; words of any length are compared whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.session import scratch_path

MIN_CHARS = 7
MIN_COUNT = 2
RATIO = 10
#: Words of one range that a task holds at a time, and searches that advance together.
BLOCK = 20_000
SEARCHES = 8192

# fixed values: the letters of a word, and the letters that are folded
LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, run``: the maximal letter runs of at least ``min_chars``, lower-cased (A-Z only), one row each."""
    found = F.regexp_extract_all(F.col(text_col), F.lit(f"{LETTERS}{{{min_chars},}}"), F.lit(0))
    return (docs.select(F.col(id_col).alias("doc_id"), F.explode(found).alias("run"))
            .select("doc_id", F.translate("run", UPPER, LOWER).alias("run")))


def count_words(words: DataFrame, word: Column, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words with enough code points and occurrences."""
    return (words.select(word.alias("word")).where(F.char_length("word") >= min_chars)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def ranges(words: DataFrame, block: int, path: str) -> DataFrame:
    """``key, a, b, own, longer, other, rest, word, n``: each word in the ranges where it can meet a near one.

    ``rest`` is what is compared (the suffix side is reversed), ``other`` the half that is not the key's: pairs equal
    in both halves meet on either side and count on the first.  ``a`` and ``b`` name the blocks of a split key.
    """
    size = F.char_length("word")
    meets = F.explode(F.array(*(F.struct(F.lit(side).alias("side"), (size - less).alias("m"), F.lit(bool(less)).alias("longer"))
                                for side in (0, 1) for less in (0, 1))))
    # half of the shorter word: its first part on the prefix side, the rest of it on the suffix side
    shared = "IF(side = 0, m div 2, m - m div 2)"
    rows = (words.where("word IS NOT NULL").select("word", "n", meets.alias("r")).select("word", "n", "r.side", "r.m", "r.longer")
            .withColumn("s", F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word")))
            .select("word", "n", "longer", F.expr(f"concat(side, '/', m, '/', substring(s, 1, {shared}))").alias("key"),
                    F.expr("IF(side = 1, substring(word, 1, m div 2), NULL)").alias("other"),
                    F.expr(f"substring(s, {shared} + 1)").alias("rest")))
    hot = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > block)
    hot.select("key", F.ceil(F.col("size") / block).cast("int").alias("blocks")).write.parquet(f"{path}/hot")
    hot = words.sparkSession.read.schema("key string, blocks int").parquet(f"{path}/hot")
    if hot.isEmpty():
        return rows.select("key", F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(0).alias("own"), "longer", "other", "rest", "word", "n")
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = rows.join(hot, "key", "left").withColumn("own", F.pmod(F.xxhash64("word"), blocks).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.select("key", F.least("own", "with").alias("a"), F.greatest("own", "with").alias("b"), "own", "longer", "other", "rest", "word", "n")


class SortedList:
    """Ranges of words, sorted by (range, rest), as code points with the LCPs of adjacent words."""

    def __init__(self, range_of: np.ndarray, rest: list[str]):
        self.size = np.fromiter(map(len, rest), np.int64, len(rest))
        self.first = np.cumsum(self.size) - self.size
        # two more code points: a search may look past the last word's end
        self.flat = np.frombuffer(("".join(rest) + "\0" * 3).encode("utf-32-le", "surrogatepass"), "<u4")
        #: LCP with the word before; -1 where a range begins
        self.lcp = np.full(len(rest), -1, np.int64)
        pairs, depth = np.flatnonzero(np.diff(range_of) == 0) + 1, 0
        self.lcp[pairs] = 0
        shorter = np.minimum(self.size[1:], self.size[:-1])
        while len(pairs):
            pairs = pairs[shorter[pairs - 1] > depth]
            pairs = pairs[self.code(pairs, depth) == self.code(pairs - 1, depth)]
            depth += 1
            self.lcp[pairs] = depth

    def code(self, word: np.ndarray, at: int) -> np.ndarray:
        """The code points at a position (of no meaning beyond a word's end)."""
        return self.flat[np.minimum(self.first[word] + at, len(self.flat) - 1)]

    def near(self, queries: np.ndarray):
        """(query, word) of all rests at distance one in the query's own range."""
        starts = np.flatnonzero(self.lcp < 0)
        upto = np.append(starts, len(self.lcp))
        at = np.searchsorted(starts, queries, "right") - 1
        # a search: the query, the adjacent words [lo, hi) that share a prefix of ``depth``, and the three cells of its row
        q, lo, hi = queries, starts[at], upto[at + 1]
        row = np.tile(np.array([9, 0, 1], np.int8), (len(q), 1))
        found, depth = [], 0
        while len(q):
            ended = self.size[lo] == depth  # the prefix is itself a word: the first of its range
            col = self.size[q] - depth + 1
            hit = ended & (col >= 0) & (col <= 2)
            hit[hit] = row[hit, col[hit]] == 1
            found.append((q[hit], lo[hit]))
            lo = lo + ended
            # the words below, by their next letter: ranges start where the LCP falls short of the new depth
            starts = np.flatnonzero(self.lcp < depth + 1)
            upto = np.append(starts, len(self.lcp))
            i, j = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
            n = j - i
            child = np.repeat(i - np.cumsum(n) + n, n) + np.arange(n.sum())
            of = np.repeat(np.arange(len(q)), n)
            q, lo, hi, old = q[of], starts[child], upto[child + 1], row[of]
            letter, size = self.code(lo, depth), self.size[q]
            new = np.empty_like(old)
            step = lambda j: np.where(j < size, self.code(q, j) != letter, 9)
            new[:, 0] = np.minimum(old[:, 0] + (step(depth - 1) if depth else 9), old[:, 1] + 1)
            new[:, 1] = np.minimum(np.minimum(old[:, 1] + step(depth), old[:, 2] + 1), new[:, 0] + 1)
            new[:, 2] = np.minimum(old[:, 2] + step(np.full(len(q), depth + 1)), new[:, 1] + 1)
            alive = new.min(axis=1) <= 1  # the others' ranges are skipped
            q, lo, hi, row = q[alive], lo[alive], hi[alive], np.minimum(new[alive], 9)
            depth += 1
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))


def _search(rows: pa.Table) -> pa.RecordBatch:
    """Per word its near words of these ranges: how many, and the best by count, then code points."""
    unit = pc.binary_join_element_wise(rows["key"], pc.cast(rows["a"], pa.string()), pc.cast(rows["b"], pa.string()), "/")
    range_of = unit.combine_chunks().dictionary_encode().indices.to_numpy()
    listed = SortedList(range_of, rows["rest"].to_pylist())
    alone = np.bincount(range_of)[range_of] < 2
    split = (rows["a"].to_numpy() != rows["b"].to_numpy())
    own, longer = rows["own"].to_numpy(), rows["longer"].to_numpy(zero_copy_only=False)
    other = pc.fill_null(pc.cast(rows["other"].combine_chunks().dictionary_encode().indices, pa.int64()), -1).to_numpy()
    words, n = rows["word"].to_pylist(), rows["n"].to_numpy()
    queries = np.flatnonzero(~alone)
    pairs = [listed.near(queries[i:i + SEARCHES]) for i in range(0, len(queries), SEARCHES)]
    q, w = (np.concatenate([p[k] for p in pairs]) if pairs else np.zeros(0, int) for k in (0, 1))
    ok = ~(longer[q] & longer[w]) & (~split[q] | (own[q] != own[w])) & ((other[q] < 0) | (other[q] != other[w]))
    q, w = q[ok], w[ok]
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[w], -n[w], q))
    q, w = q[order], w[order]
    first = np.flatnonzero(np.diff(q, prepend=-1))
    count = np.diff(np.append(first, len(q)))
    return pa.RecordBatch.from_arrays(
        [pa.array([words[i] for i in q[first]], pa.string()), pa.array(count, pa.int64()), pa.array(n[w[first]], pa.int64()),
         pa.array([words[i] for i in w[first]], pa.string())], names=["word", "n_near", "near_n", "near"])


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word, n_near, near, near_n`` of the words that have near ones: how many, and the most frequent."""
    dealt = ranges(words, block, scratch_path(words.sparkSession, "spelling"))
    parts = dealt.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", "rest")

    def scan(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= block:
                table = pa.Table.from_batches(held)
                last = [table[c][-1] for c in ("key", "a", "b")]
                open_ = pc.and_(pc.and_(pc.equal(table["key"], last[0]), pc.equal(table["a"], last[1])), pc.equal(table["b"], last[2]))
                closed = n - pc.sum(open_).as_py()  # the last range may go on in the next batch
                if closed:
                    yield _search(table.slice(0, closed))
                held, n = table.slice(closed).to_batches(), n - closed
        if n:
            yield _search(pa.Table.from_batches(held))

    found = parts.mapInArrow(scan, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the end of each word's chain in ``word, form``, one step for all words at a time."""
    spark, path = forms.sparkSession, scratch_path(forms.sparkSession, "roots")
    forms.select("word", "form").write.parquet(f"{path}/forms")
    forms = spark.read.schema("word string, form string").parquet(f"{path}/forms")
    step = forms.select(F.col("word").alias("at"), F.col("form").alias("next"))
    # only chains that go on are followed; each step's ends are a table of their own
    ends, going, k = [], forms.select("word", F.col("form").alias("root")), 0
    while True:
        going.join(step, F.col("root") == F.col("at"), "left").select("word", "root", "next").write.parquet(f"{path}/step-{k}")
        done = spark.read.schema("word string, root string, next string").parquet(f"{path}/step-{k}")
        ends.append(done.where("next IS NULL").select("word", "root"))
        going, k = done.where("next IS NOT NULL").select("word", F.col("next").alias("root")), k + 1
        if going.isEmpty():
            break
    out = ends[0]
    for e in ends[1:]:
        out = out.unionAll(e)
    return out


def group_variants(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of a vocabulary ``word, n`` of distinct words."""
    spark, path = words.sparkSession, scratch_path(words.sparkSession, "variants")
    words.select("word", "n").write.parquet(f"{path}/words")
    words = spark.read.schema("word string, n long").parquet(f"{path}/words")
    has_form = F.col("near_n") >= ratio * F.col("n")
    (words.join(near_words(words, block), "word", "left")
     .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has_form, F.col("near")).alias("form"),
             F.when(has_form, F.col("near_n")).alias("form_n")).write.parquet(f"{path}/found"))
    found = spark.read.schema("word string, n long, n_near long, form string, form_n long").parquet(f"{path}/found")
    ends = roots(found.where("form IS NOT NULL"))
    return found.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))

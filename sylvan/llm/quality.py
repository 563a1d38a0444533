"""A quality classifier on supervised subword embeddings.

Words are the runs between white space, case and signs kept.  Each distinct
feature of a word (the word itself and its character n-grams, with marks for
its begin and end) is hashed to one of ``BUCKETS`` rows of a learned embedding
matrix.  A document is the average of the rows of all its features, with
repeats; a softmax over the labels is put on it.  Embeddings and softmax are
trained together by stochastic gradient descent in numpy, one document a step,
the step size falling to zero.

Training runs on a bounded sample: about ``sample_per_label`` labelled rows of
each label, drawn by a hash of the id; that is the documented parameter.  A
label of which only a share is drawn weighs as much more, so scores keep the
labels' shares.  Features of the sample are worked out by tasks; the driver
holds the sample's bucket counts and ``buckets x dim`` numbers.

For scoring, embeddings and softmax are multiplied once (``buckets x labels``
numbers go to the workers), as the average and the softmax's product can be
swapped.  Every whole text is scored by one map, without a shuffle.

Defined results: null and empty texts have no features and get the labels'
shares among the sampled rows (0.5 where nothing is labelled, 0 or 1 where all
labels are the same); rows with a null label or null id are not trained on;
repeated rows are scored row by row, and repeated labels of an id all count;
very long texts are scored whole, in slices; an empty table gives no row;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.llm.joins import stored_keys
from sylvan.session import scratch_path, ship_package

BUCKETS = 1 << 16
DIM = 12
NGRAMS = (3, 4, 5)
EPOCHS = 5
RATE = 0.5
SAMPLE_PER_LABEL = 3000
#: Rows of a batch, and characters of a text, whose features are worked out at a time.
SLICE_ROWS = 250
SLICE_CHARS = 1_000_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def word_buckets(words: list[str], buckets: int = BUCKETS, ngrams=NGRAMS) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of each word's features as (offsets, buckets): the marked word, then its n-grams by size."""
    marked = [f"<{w}>" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    first = np.cumsum(size) - size
    of, hashed = [np.arange(len(words))], []
    with np.errstate(over="ignore"):
        # a word's hash adds up its code points, each scrambled with its position
        position = np.arange(len(codes)) - np.repeat(first, size)
        mixed = (codes + (position.astype(np.uint64) << np.uint64(24))) * _MULTIPLIER
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MULTIPLIER
        hashed.append(np.add.reduceat(mixed, first) if len(words) else np.zeros(0, np.uint64))
        for n in ngrams:
            count = np.maximum(0, size - n + 1)
            start = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
            h = np.full(len(start), n, np.uint64)
            for k in range(n):
                h = (h ^ codes[start + k]) * _MULTIPLIER
                h ^= h >> np.uint64(31)
            of.append(np.repeat(np.arange(len(words)), count))
            hashed.append(h)
        h = np.concatenate(hashed) * _MULTIPLIER
        bucket = (h >> np.uint64(64 - int(math.log2(buckets)))).astype(np.int64)
    of = np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(words)))]), bucket[order]


def split_words(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of some texts, and per occurrence (text, word)."""
    parts = [t.split() if t else [] for t in texts]
    text = np.repeat(np.arange(len(texts)), np.fromiter(map(len, parts), np.int64, len(parts)))
    flat = pa.array([w for p in parts for w in p], pa.string()).dictionary_encode()
    return flat.dictionary.to_pylist(), text, flat.indices.to_numpy()


def slices(texts: pa.Array):
    """(row, text) in lists of bounded size; a very long text is cut between words."""
    held, n = [], 0
    for i, t in enumerate(texts):
        t, at = t.as_py() or "", 0
        while True:
            end = len(t)
            if end - at > SLICE_CHARS:
                end = at + SLICE_CHARS
                while end < len(t) and not t[end].isspace():
                    end += 1
            held.append((i, t[at:end] if at or end < len(t) else t))
            n += end - at
            if n >= SLICE_CHARS or len(held) >= SLICE_ROWS:
                yield held
                held, n = [], 0
            at = end
            if at >= len(t):
                break
    if held:
        yield held


class EmbeddingModel:
    def __init__(self, labels: list[int], shares: np.ndarray, buckets: int = BUCKETS, dim: int = DIM, ngrams=NGRAMS, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.labels, self.ngrams, self.buckets = labels, ngrams, buckets
        self.embedding = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
        self.softmax = np.zeros((len(labels), dim), np.float32)
        self.bias = np.log(np.maximum(shares, 1e-9)) if len(labels) else np.zeros(0)

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, weights: np.ndarray, epochs: int = EPOCHS,
            rate: float = RATE, seed: int = 2) -> None:
        """Stochastic gradient descent; a row is (distinct buckets, their shares of the row's features)."""
        rng, steps, done = np.random.default_rng(seed), epochs * len(rows), 0
        e, w, bias = self.embedding, self.softmax, self.bias.astype(np.float32)
        for _ in range(epochs):
            for r in rng.permutation(len(rows)):
                bucket, share = rows[r]
                done += 1
                if not len(bucket):
                    continue
                mean = share @ e[bucket]
                logit = w @ mean + bias
                p = np.exp(logit - logit.max())
                p /= p.sum()
                p[labels[r]] -= 1
                step = rate * (1 - done / (steps + 1)) * weights[r] * p
                # the average is over many rows: each gets the whole gradient, as all of them carry the document
                back = step @ w
                w -= np.outer(step, mean)
                e[bucket] -= (share / share.max())[:, None] * back
        self.folded = (e @ w.T).astype(np.float64)


def bucket_counts(texts: pa.Array, buckets: int, ngrams):
    """Per text its distinct buckets and how many features fall into each."""
    out = [[] for _ in range(len(texts))]
    for part in slices(texts):
        words, text, word = split_words([t for _, t in part])
        if not words:
            continue
        at, bucket = word_buckets(words, buckets, ngrams)
        n = np.diff(at)[word]
        flat = bucket[np.repeat(at[word] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        cut = np.searchsorted(np.repeat(text, n), np.arange(len(part) + 1))
        for (i, _), lo, hi in zip(part, cut, cut[1:]):
            out[i].append(np.unique(flat[lo:hi], return_counts=True))
    merged = []
    for found in out:
        if len(found) > 1:
            codes, where = np.unique(np.concatenate([b for b, _ in found]), return_inverse=True)
            found = [(codes, np.bincount(where, np.concatenate([c for _, c in found])))]
        merged.append(found[0] if found else (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    return merged


def train(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text",
          sample_per_label: int = SAMPLE_PER_LABEL, buckets: int = BUCKETS, ngrams=NGRAMS, **options) -> EmbeddingModel:
    """Fit on a bounded sample of ``labels`` (``id_col`` and an integer ``label_col``)."""
    spark = docs.sparkSession
    ship_package(spark)
    given = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    sizes = {r["label"]: r["n"] for r in given.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per label
    names = sorted(sizes)
    total = sum(sizes.values())
    model = EmbeddingModel(names, np.array([sizes[k] / total for k in names]), buckets, ngrams=ngrams)
    model.folded = np.zeros((buckets, len(names)))
    if len(names) < 2:
        return model
    share = F.create_map(*(F.lit(x) for k in names for x in (k, min(1.0, sample_per_label / sizes[k]))))
    drawn = given.where(F.pmod(F.xxhash64(F.lit("quality"), F.col("id").cast("string")), F.lit(1_000_000)) < share[F.col("label")] * 1_000_000)
    sample = drawn.groupBy("id", "label").agg(F.count(F.lit(1)).cast("int").alias("times"))
    if dict(sample.dtypes)["id"] in ("int", "bigint"):
        sample = stored_keys(sample, scratch_path(spark, "quality-sample"))

    def features(batches):
        for batch in batches:
            for i in range(0, len(batch), SLICE_ROWS):
                part = batch.slice(i, SLICE_ROWS)
                rows = bucket_counts(part.column(2), buckets, ngrams)
                at = np.concatenate([[0], np.cumsum([len(b) for b, _ in rows])]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(at, np.concatenate([r[k] for r in rows]).astype(np.int32)) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *lists], names=["label", "times", "bucket", "n"])

    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    got = (texts.join(sample, F.col("doc") == F.col("id")).select("label", "times", "text")
           .mapInArrow(features, "label int, times int, bucket array<int>, n array<int>").toArrow().combine_chunks())
    if not len(got):
        return model
    rows, order = [], []
    for b, n in zip(got["bucket"], got["n"]):
        b, n = b.values.to_numpy(), n.values.to_numpy().astype(np.float32)
        rows.append((b, n / max(1, n.sum())))
        order.append((len(b), b.tobytes(), n.tobytes()))
    label = np.searchsorted(names, got["label"].to_numpy())
    rank = sorted(range(len(rows)), key=lambda i: (order[i], label[i]))  # the same fit however the rows came
    weight = got["times"].to_numpy() * np.array([max(1.0, sizes[k] / sample_per_label) for k in names])[label]
    weight = weight / weight.mean()
    model.fit([rows[i] for i in rank], label[rank], weight[rank].astype(np.float32), **options)
    return model


def score(text: Column, model: EmbeddingModel, label: int = 1) -> Column:
    """The probability of ``label`` for a text column."""
    buckets, ngrams, bias, folded, names = model.buckets, model.ngrams, model.bias, model.folded, model.labels

    @F.arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        if label not in names:
            return pa.array(np.full(len(texts), 0.0 if names else 0.5))
        total, count = np.zeros((len(texts), len(names))), np.zeros(len(texts))
        for part in slices(texts):
            words, text, word = split_words([t for _, t in part])
            if not words:
                continue
            at, bucket = word_buckets(words, buckets, ngrams)
            of_word = np.add.reduceat(folded[bucket], at[:-1], axis=0)
            row = np.array([i for i, _ in part])[text]
            count += np.bincount(row, np.diff(at)[word], len(texts))
            for k in range(len(names)):
                total[:, k] += np.bincount(row, of_word[word, k], len(texts))
        logit = bias + total / np.maximum(1, count)[:, None]
        p = np.exp(logit - logit.max(axis=1, keepdims=True))
        return pa.array(p[:, names.index(label)] / p.sum(axis=1))

    return probability(text)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learned from: CRC-32 of the id's text modulo 5 is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def rate_documents(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = 0.3, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row, trained on the labels not held out."""
    model = train(docs, labels.where(~held_out(id_col)), label_col, id_col, text_col, **options)
    got = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), score(F.col(text_col), model).alias("score"))
    return got.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

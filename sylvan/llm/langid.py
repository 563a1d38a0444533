"""Language identification as multilingual mixture inference.

Each language's model is the smoothed distribution of its letter trigrams
(hashed to ``BUCKETS``), counted over a bounded sample of labelled rows.  A
document is seen as a mixture: every trigram is drawn from one of the
languages, in unknown proportions.  Expectation-maximisation estimates the
proportions from the trigram likelihoods.  The set of languages is chosen by
penalised likelihood: languages are added in the order of their proportions
while the gain in log-likelihood (divided by 3, as each letter stands in three
trigrams) exceeds half the logarithm of the trigram count.  The prediction is
the language with the largest proportion in the chosen set, its score that
proportion.

Training counts are summed in tasks and then by bucket; the driver holds
languages x buckets numbers.  Per language at most about ``sample_per_lang``
labelled rows are used (a hash of the id decides); that is the documented
bound.  Prediction reads the text alone.

Defined results: null texts and texts without a letter get ``und`` with score
0; repeated rows are predicted row by row; if nothing is labelled, all are
``und``; a null id is not trained on.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.llm.workers import held, small_batches

BUCKETS = 1 << 15
SAMPLE_PER_LANG = 4000
UNDETERMINED = "und"
SMOOTHING = 0.5
EM_STEPS = 40
EM_TOLERANCE = 1e-4

def letters() -> np.ndarray:
    """For each code point, whether it is a letter (built once per worker)."""
    return held("langid", "letters", lambda: np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))


def trigrams(text: str) -> np.ndarray:
    """The bucket of the trigram around each letter; what is no letter counts as a blank."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = letters()[a]
    a = np.concatenate([[32], np.where(is_letter, a, 32), [32]]).astype(np.uint64)
    mid = np.flatnonzero(is_letter)
    with np.errstate(over="ignore"):
        h = (a[mid] * np.uint64(0x1F0D5) + a[mid + 1]) * np.uint64(0x1F0D5) + a[mid + 2]
        h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - int(math.log2(BUCKETS)))
    return h.astype(np.int64)


class MixtureModel:
    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        smooth = counts + SMOOTHING
        self.prob = smooth / smooth.sum(axis=1, keepdims=True) if langs else smooth

    @staticmethod
    def em(p: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, float]:
        """Proportions of the rows of ``p`` given bucket counts, and the log-likelihood."""
        n, w = c.sum(), np.full(len(p), 1 / len(p))
        if len(p) > 1:
            for _ in range(EM_STEPS):
                new = w * (p @ (c / (w @ p))) / n
                moved = np.abs(new - w).max()
                w = new
                if moved < EM_TOLERANCE:
                    break
        return w, float(c @ np.log(w @ p))

    def infer(self, text: str | None) -> tuple[dict[str, float], str, float]:
        """(proportions of the chosen languages, prediction, score)."""
        grams = trigrams(text) if text and self.langs else ()
        if not len(grams):
            return {}, UNDETERMINED, 0.0
        buckets, c = np.unique(grams, return_counts=True)
        c = c.astype(float)
        p = self.prob[:, buckets]
        order = np.argsort(-self.em(p, c)[0], kind="stable")
        chosen, (w, ll) = order[:1], self.em(p[order[:1]], c)
        for size in range(2, len(order) + 1):
            more, ll_more = self.em(p[order[:size]], c)
            if (ll_more - ll) / 3 <= 0.5 * math.log(len(grams)):
                break
            chosen, w, ll = order[:size], more, ll_more
        best = int(np.argmax(w))
        return {self.langs[i]: float(x) for i, x in zip(chosen, w)}, self.langs[chosen[best]], float(min(1.0, w[best]))


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_per_lang: int = SAMPLE_PER_LANG) -> MixtureModel:
    """Count trigrams per language over the bounded sample."""
    small_batches(labelled.sparkSession)
    src = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")) \
        .where("lang IS NOT NULL AND text IS NOT NULL AND id IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in src.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return MixtureModel([], np.zeros((0, BUCKETS)))
    langs = sorted(sizes)
    share = F.create_map(*(F.lit(x) for k in langs for x in (k, min(1.0, sample_per_lang / sizes[k]))))
    drawn = F.pmod(F.xxhash64(F.lit("train"), F.col("id").cast("string")), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                lang = lang.as_py()
                if lang not in total:
                    total[lang] = np.zeros(BUCKETS, np.int64)
                total[lang] += np.bincount(trigrams(text.as_py()), minlength=BUCKETS)
        for lang, c in total.items():
            seen = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), pa.array(seen, pa.int32()),
                                              pa.array(c[seen], pa.int64())], names=["lang", "bucket", "n"])

    rows = (src.where(drawn).select("text", "lang").mapInArrow(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())  # languages x buckets rows at most
    counts = np.zeros((len(langs), BUCKETS))
    at = {k: i for i, k in enumerate(langs)}
    counts[[at[k] for k in rows["lang"].to_pylist()], rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return MixtureModel(langs, counts)


def predict(text: Column, model: MixtureModel) -> Column:
    """``struct<lang_pred, score, languages>`` of a text column."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("languages", pa.string())])

    @F.arrow_udf("struct<lang_pred: string, score: double, languages: string>")
    def infer(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts:
            parts, lang, score = model.infer(t.as_py())
            names = ",".join(f"{k}:{v:.3f}" for k, v in sorted(parts.items(), key=lambda kv: (-kv[1], kv[0])))
            out.append({"lang_pred": lang, "score": score, "languages": names})
        return pa.array(out, kind)

    return infer(text)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never trained on: CRC-32 of the id's text modulo 4 is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, languages`` per row, trained on the rows not held out."""
    model = train(docs.where(~held_out(id_col)), id_col, text_col, lang_col)
    got = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), predict(F.col(text_col), model).alias("p"))
    return got.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.languages")

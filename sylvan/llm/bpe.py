"""Byte-level BPE encoding and decoding with a contiguous rank array per word.

A word's bytes are held as two parallel arrays: the parts (token ids between
the boundaries) and the rank of each adjacent pair.  The smallest rank is
looked for by a scan, its boundary is deleted, and the ranks of the two
neighbouring pairs are refreshed; this is repeated until no pair has a rank.
Words are short, so the scans stay inside a few machine words.  For the rare
word above ``SCAN_BYTES`` bytes the same rule is applied with a heap, which
gives the same parts (smallest rank first, then leftmost) without rescanning.

Encodings of words are kept in a bounded two-generation cache per worker.

Defined results: null text is encoded as empty; repeated rows are encoded row
by row; special strings inside a text become their own ids, as in the library.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sylvan.llm.bytelevel import Vocabulary
from sylvan.llm.workers import held, small_batches

SCAN_BYTES = 256
CACHE_WORDS = 150_000

NO_RANK = 1 << 60


#: Below this code point the classes of letters, numbers and spaces are the same in every Unicode
#: version a library may have; texts with later characters are split by the library's pre-tokeniser.
PLAIN_END = 0x530
BEYOND_PLAIN = re.compile(f"[^\0-{chr(PLAIN_END - 1)}]").search


def plain_pattern():
    """The pre-tokeniser's pattern with its classes written out for code points below ``PLAIN_END``."""
    chars = [chr(i) for i in range(PLAIN_END)]
    letter = re.escape("".join(c for c in chars if unicodedata.category(c)[0] == "L"))
    number = re.escape("".join(c for c in chars if unicodedata.category(c)[0] == "N"))
    space = r"\t-\r \x85\xa0"
    # fixed value: the alternatives of the public pattern, in its order
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
                      f"|[{space}]+(?![^{space}])|[{space}]+")


class _Known(dict):
    """Words and their ids as u32 bytes; a missing word is taken from the older generation or encoded."""

    def __init__(self, encoder, old):
        super().__init__()
        self.encoder, self.old = encoder, old

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = array("I", self.encoder.merge(word.encode())).tobytes()
        if len(word) <= 64:
            self[word] = ids
        return ids


def _pre_tokenizer(path: str):
    """The library's pre-tokeniser of a vocabulary file, without a second copy of the vocabulary in memory."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    light = {k: spec.get(k) for k in ("version", "normalizer", "pre_tokenizer")}
    return Tokenizer.from_str(json.dumps(light | {"added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}})).pre_tokenizer


class RankArrayEncoder:
    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        self.vocab = Vocabulary(path)
        self.pre_tokenizer = _pre_tokenizer(path)
        self.cache_words = cache_words
        self.known = _Known(self, {})
        specials = sorted(self.vocab.special, key=len, reverse=True)
        self.split_special = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None
        self.plain_words = plain_pattern().findall

    def merge(self, word: bytes) -> list[int]:
        """The parts of one word."""
        parts = [self.vocab.byte_id[b] for b in word]
        if len(parts) > SCAN_BYTES:
            return self.merge_long(parts)
        lookup = self.vocab.rank.get
        none = (NO_RANK, -1)
        ranks = [lookup(p, none) for p in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best is none:
                break
            at = ranks.index(best)
            parts[at] = best[1]
            del parts[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = lookup((parts[at], parts[at + 1]), none)
            if at:
                ranks[at - 1] = lookup((parts[at - 1], parts[at]), none)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        n, lookup = len(parts), self.vocab.rank.get
        right = [*range(1, n), -1]
        left = list(range(-1, n - 1))
        heap = [(r[0], i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := lookup((a, b)))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if j < 0 or parts[i] != a or parts[j] != b:
                continue
            parts[i], parts[j] = lookup((a, b))[1], -1
            right[i] = k = right[j]
            right[j] = -1
            if k >= 0:
                left[k] = i
                if r := lookup((parts[i], parts[k])):
                    heapq.heappush(heap, (r[0], i, parts[i], parts[k]))
            if (h := left[i]) >= 0 and (r := lookup((parts[h], parts[i]))):
                heapq.heappush(heap, (r[0], h, parts[h], parts[i]))
        return [p for p in parts if p >= 0]

    def words(self, text: str) -> list[str]:
        if not BEYOND_PLAIN(text):
            return self.plain_words(text)
        return [text[a:b] for _, (a, b) in self.pre_tokenizer.pre_tokenize_str(text)]

    def encode(self, text: str) -> bytes:
        """The ids of a text as u32 bytes."""
        if self.split_special and any(s in text for s in self.vocab.special):
            out = []
            for part in self.split_special.split(text):
                special = self.vocab.special.get(part)
                out.append(self.encode(part) if special is None else array("I", [special]).tobytes())
            return b"".join(out)
        if len(self.known) > self.cache_words:
            self.known = _Known(self, {**self.known})
        return b"".join(map(self.known.__getitem__, self.words(text)))


class Decoder:
    """Bytes of ids by one gather; invalid UTF-8 becomes replacement characters, as in the library."""

    def __init__(self, path: str, vocab: Vocabulary | None = None):
        v = vocab or Vocabulary(path)
        table = v.bytes_of | {i: s.encode() for s, i in v.special.items()}
        size = max(table) + 1
        self.table = [table.get(i, b"") for i in range(size)]

    def decode(self, ids) -> str:
        return b"".join(map(self.table.__getitem__, ids)).decode("utf-8", "replace")


def _worker(kind, path: str):
    return held("bpe", (kind, path), lambda: kind(path))


def _round_tripper(path: str):
    """Encoder and decoder of one worker; they share the vocabulary."""
    enc = RankArrayEncoder(path)
    return enc, Decoder(path, enc.vocab)


def _encode_batch(enc: RankArrayEncoder, texts: pa.Array) -> pa.ListArray:
    ids = [enc.encode(t.as_py() or "") for t in texts]
    offsets = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in ids], out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(ids), np.int32))


def _decode_batch(dec: Decoder, arrays: pa.Array) -> pa.Array:
    values, at = arrays.values.to_numpy(zero_copy_only=False), arrays.offsets.to_numpy()
    return pa.array([None if null else dec.decode(values[a:b].tolist())
                     for null, a, b in zip(arrays.is_null().to_pylist(), at, at[1:])], pa.string())


def _id_and_text(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), docs.schema[id_col].dataType.simpleString()


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the token ids (``array<int>``) of each row's whole text."""
    rows, id_type = _id_and_text(docs, id_col, text_col)

    def run(batches):
        enc = _worker(RankArrayEncoder, tokenizer_path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _encode_batch(enc, batch.column(1))], names=["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {id_type}, ids array<int>")


def decode(ids: Column, tokenizer_path: str) -> Column:
    """The text of an id array column (null ids: null)."""

    @F.arrow_udf("string")
    def bpe_decode(arrays: pa.Array) -> pa.Array:
        return _decode_batch(_worker(Decoder, tokenizer_path), arrays)

    return bpe_decode(ids)


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, decoded``: the ids of each row's whole text and the text decoded from these ids.

    As ``encode`` and ``decode`` one after the other, but one worker of a task does both: two
    Python functions in one stage run in two processes, each with a vocabulary of its own.
    """
    rows, id_type = _id_and_text(docs, id_col, text_col)

    def run(batches):
        enc, dec = _worker(_round_tripper, tokenizer_path)
        for batch in batches:
            ids = _encode_batch(enc, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, _decode_batch(dec, ids)], names=["doc_id", "ids", "decoded"])

    return rows.mapInArrow(run, f"doc_id {id_type}, ids array<int>, decoded string")


def round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, token count, and SHA-256 of the ids and of the text decoded from them."""
    return encode_decode(docs, tokenizer_path, id_col, text_col).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))

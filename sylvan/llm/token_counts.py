"""Token counts by a compiled finite-state transducer.

The byte-level BPE tokenizer of a vocabulary file is compiled, lazily, into a
deterministic transducer over characters.  Every transition is annotated with
the number of tokens it emits; the number is signed, as a character can undo
what would have been emitted had the text ended before it, so the sum along a
path is the token count of the text read so far.

A state holds the pre-tokeniser's state and, inside a word, what later
characters can still depend on: the longest suffix that begins some token,
with the last token and relative count at each of its byte boundaries.  (A
sequence of tokens is the BPE encoding of its bytes exactly if each adjacent
pair is, so the last token of every prefix is found from those boundaries.)
The suffix is no longer than a token, so states are finite in number.

Long texts are cut into chunks.  A word always ends between a non-space and
a white-space character; at such a point the transducer is in its start
state, whatever came before.  A chunk's state map is therefore a constant map
between its first and last such points (the ``body`` count) with the
characters before (``head``) and after (``tail``) them left open: a state
travels as the string that reaches it.  Maps compose by a prefix scan in
Spark: a running count of synchronised chunks gives each seam its number, and
each seam's strings (tail of one chunk, unsynchronised chunks in between, head
of the next) are counted independently of all other seams.

Defined results: null text counts as empty (0 bytes, 0 tokens); repeated rows
are counted row by row; other columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sylvan.llm.bytelevel import Vocabulary
from sylvan.llm.workers import held, small_batches

CHUNK_CHARS = 32_768
#: Compiled transitions kept per Python worker (a cache; dropped states are compiled again).
MAX_EDGES = 800_000

# fixed values: the white-space characters of the pre-tokeniser's \s
SPACES = frozenset("\t\n\x0b\x0c\r \x85\xa0            "
                   "    　")
# fixed values: the contractions that the pre-tokeniser splits off, by length
SHORT_CONTRACTIONS = "stmd"
LONG_CONTRACTIONS = {"r": "e", "v": "e", "l": "l"}


class _State(dict):
    """A state: maps a character to (next state, tokens emitted); edges compile on first use."""

    __slots__ = ("tx", "kind", "core", "info")

    def __init__(self, tx, kind, core, info):
        self.tx, self.kind, self.core, self.info = tx, kind, core, info

    def __missing__(self, ch):
        edge = self[ch] = self.tx.compile_edge(self, ch)
        return edge


class CountTransducer:
    def __init__(self, path: str, max_edges: int = MAX_EDGES):
        self.vocab = v = Vocabulary(path)
        self.prefixes = {t[:n] for t in v.id_of for n in range(1, len(t) + 1)}
        self.longest = max(map(len, v.id_of))
        self.max_edges = max_edges
        self.pre_tokenizer = Tokenizer.from_file(path).pre_tokenizer
        self.kinds: dict[str, str] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._solo: dict[int, bool] = {}
        self.specials = sorted(v.special, key=len, reverse=True)
        self.reset()

    def reset(self):
        self.states: dict = {}
        self.edges = 0
        self.root = self._state("E", self.empty, None)

    # -- words: the BPE part of a state is (suffix, ((last token, relative count), ...))
    empty = (b"", ((-1, 0),))

    def encode(self, word: bytes) -> list[int]:
        """Plain BPE of a short byte string, for deciding which token pairs stand."""
        ids, rank = [self.vocab.byte_id[b] for b in word], self.vocab.rank
        while len(ids) > 1:
            best, at = min(((rank.get(p, (1 << 60,))[0], i) for i, p in enumerate(zip(ids, ids[1:]))))
            if best == 1 << 60:
                break
            ids[at:at + 2] = [rank[ids[at], ids[at + 1]][1]]
        return ids

    def _stands(self, before: int, token: int) -> bool:
        if before < 0:
            ok = self._solo.get(token)
            if ok is None:
                ok = self._solo[token] = self.encode(self.vocab.bytes_of[token]) == [token]
            return ok
        ok = self._pairs.get((before, token))
        if ok is None:
            if len(self._pairs) > 500_000:
                self._pairs.clear()
            both = self.vocab.bytes_of[before] + self.vocab.bytes_of[token]
            ok = self._pairs[before, token] = self.encode(both) == [before, token]
        return ok

    def step(self, core, ch: str):
        """The BPE part after one more character, and the tokens it adds."""
        added = 0
        for b in ch.encode("utf-8", "surrogatepass"):
            suffix, marks = core
            u = suffix + bytes([b])
            for start in range(len(u)):
                token = self.vocab.id_of.get(u[start:])
                if token is not None and marks[start] and self._stands(marks[start][0], token):
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
            count = marks[start][1] + 1
            marks = (*marks, (token, count))
            keep = 0
            while keep < len(u) and u[keep:] not in self.prefixes:
                keep += 1
            # of the boundaries, only those matter at which a longer token can still begin
            core = (u[keep:], tuple((t, n - count) if i == len(u) or u[i:] in self.prefixes else None
                                    for i, (t, n) in self._from(marks, keep)))
            added += count
        return core, added

    @staticmethod
    def _from(marks, keep):
        return ((i, m or (-1, 0)) for i, m in enumerate(marks) if i >= keep)

    def _state(self, kind, core, info):
        key = (kind, core, info)
        s = self.states.get(key)
        if s is None:
            s = self.states[key] = _State(self, kind, core, info)
        return s

    # -- the pre-tokeniser: E start, W white space, L letters, N numbers, O others,
    #    A an apostrophe that opens a word, R apostrophe and r/v/l, E again after a contraction
    def kind_of(self, ch: str) -> str:
        """The character's class, asked of the library's pre-tokeniser once (its Unicode version counts)."""
        kind = self.kinds.get(ch)
        if kind is None:
            pieces = self.pre_tokenizer.pre_tokenize_str
            kind = ("W" if ch in SPACES else "L" if len(pieces("a" + ch)) == 1
                    else "N" if len(pieces("1" + ch)) == 1 else "O")
            self.kinds[ch] = kind
        return kind

    def _fresh(self, ch, lead=""):
        """The state that a character opens, after an optional leading space, and its tokens."""
        kind, core, n = self.kind_of(ch), self.empty, 0
        for c in lead + ch:
            core, k = self.step(core, c)
            n += k
        if kind == "W":
            return self._state("W", core, (-n, ch, n)), n
        return self._state("A" if ch == "'" and not lead else kind, core, None), n

    def compile_edge(self, s, ch):
        self.edges += 1
        to, kind = s.kind, self.kind_of(ch)
        if to == "W":
            if kind == "W":
                core, k = self.step(s.core, ch)
                return self._state("W", core, (-k, ch, len(self.encode(ch.encode())))), k
            undo, last, alone = s.info  # the run gives its last character away
            if last == " ":
                nxt, n = self._fresh(ch, " ")
                return nxt, undo + n
            nxt, n = self._fresh(ch)
            return nxt, undo + alone + n
        if to == "A":
            if ch in SHORT_CONTRACTIONS:
                return self.root, len(self.encode(b"'" + ch.encode())) - 1
            if ch in LONG_CONTRACTIONS:
                core, n = self.step(self.empty, ch)
                return self._state("R", core, ch), n
            to = "O"
        if to == "R":
            if ch == LONG_CONTRACTIONS[s.info]:
                whole = len(self.encode(("'" + s.info + ch).encode()))
                return self.root, whole - 1 - self._tokens(s.info)
            to = "L"
        if to == kind:
            core, n = self.step(s.core, ch)
            return self._state(kind, core, None), n
        return self._fresh(ch)

    def _tokens(self, text: str) -> int:
        return len(self.encode(text.encode()))

    def count(self, text: str) -> int:
        """Tokens of a whole text; special strings count as one token each."""
        if self.edges > self.max_edges:
            self.reset()
        for special in self.specials:
            if special in text:
                parts = text.split(special)
                return len(parts) - 1 + sum(map(self.count, parts))
        s, n = self.root, 0
        for ch in text:
            s, k = s[ch]
            n += k
        return n


def first_sync(text: str, start: int = 0) -> int:
    """The first position from ``start`` on where a word certainly ended, or -1."""
    for i in range(max(1, start), len(text)):
        if text[i] in SPACES and text[i - 1] not in SPACES:
            return i
    return -1


def last_sync(text: str) -> int:
    for i in range(len(text) - 1, 0, -1):
        if text[i] in SPACES and text[i - 1] not in SPACES:
            return i
    return -1


def chunk_maps(tx: CountTransducer, text: str, size: int):
    """(chunk number, synchronised, head, body count, tail) of each chunk of a text."""
    n_chunks = max(1, -(-len(text) // size))
    for k in range(n_chunks):
        part = text[k * size:(k + 1) * size]
        first = 0 if k == 0 else first_sync(part)
        last = len(part) if k == n_chunks - 1 else last_sync(part)
        if k == 0 and last < 0:
            last = 0
        if first < 0:  # no point in it: it belongs to the seam around it as a whole
            yield k, False, part, 0, ""
        else:
            yield k, True, part[:first], tx.count(part[first:last]), part[last:]


def _transducer(path: str, max_edges: int = MAX_EDGES) -> CountTransducer:
    return held("token_counts", path, lambda: CountTransducer(path, max_edges))


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_tokens`` of the whole text."""
    id_type = docs.schema[id_col].dataType.simpleString()
    small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def maps(batches):
        tx, task, row = _transducer(tokenizer_path), TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            out = [[] for _ in range(7)]
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for i, doc in enumerate(ids):
                text = texts[i].as_py()
                for k, sync, head, body, tail in chunk_maps(tx, text, chunk_chars):
                    size = len(text.encode("utf-8", "surrogatepass")) if k == 0 else 0
                    for col, v in zip(out, (doc, task + row, k, sync, size, body, [head, tail])):
                        col.append(v)
                row += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], batch.schema.field(0).type), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()),
                 pa.array(out[3], pa.bool_()), pa.array(out[4], pa.int64()), pa.array(out[5], pa.int64()),
                 pa.array([x[0] for x in out[6]], pa.string()), pa.array([x[1] for x in out[6]], pa.string())],
                names=["doc_id", "row", "k", "sync", "n_bytes", "body", "head", "tail"])

    chunks = src.mapInArrow(maps, f"doc_id {id_type}, row long, k int, sync boolean, n_bytes long, body long, "
                                  "head string, tail string")
    # inclusive scan over a document's maps: the seam after each synchronised chunk
    scan = Window.partitionBy("doc_id", "row").orderBy("k")
    seam = F.sum(F.col("sync").cast("int")).over(scan)
    # a synchronised chunk closes the seam before it with its head and opens its own with its tail
    sides = F.when(F.col("sync"), F.array(F.struct((F.col("seam") - 1).alias("seam"), F.col("head").alias("s")),
                                          F.struct(F.col("seam").alias("seam"), F.col("tail").alias("s")))) \
        .otherwise(F.array(F.struct(F.col("seam").alias("seam"), F.col("head").alias("s"))))
    parts = (chunks.withColumn("seam", seam)
             .select("doc_id", "row", "k", "n_bytes", "body", F.posexplode(sides).alias("side", "p"))
             .groupBy("doc_id", "row", F.col("p.seam").alias("seam"))
             .agg(F.sum(F.when(F.col("side") == 0, F.col("n_bytes"))).alias("n_bytes"),
                  F.sum(F.when(F.col("side") == 0, F.col("body"))).alias("body"),
                  F.array_join(F.transform(F.array_sort(F.collect_list(
                      F.when(F.col("p.s") != "", F.struct("k", "side", F.col("p.s").alias("s"))))),
                      lambda x: x["s"]), "").alias("text")))

    @F.arrow_udf("long")
    def seam_tokens(texts: pa.Array) -> pa.Array:
        tx = _transducer(tokenizer_path)
        return pa.array([tx.count(t.as_py()) if t.as_py() else 0 for t in texts], pa.int64())

    return (parts.withColumn("seam_tokens", seam_tokens("text"))
            .groupBy("doc_id", "row")
            .agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).cast("long").alias("n_bytes"),
                 (F.coalesce(F.sum("body"), F.lit(0)) + F.sum("seam_tokens")).cast("long").alias("n_tokens"))
            .drop("row"))

"""Token ids in binary files, compressed by a static range asymmetric numeral system (rANS).

``write_token_files`` encodes whole texts in ascending id order and writes a
folder of three tables:

* ``ids``     the plain ids of each document with its start, and a last row with each partition's
              counts (an intermediate)
* ``model``   the shared frequency table, counted over all ids
* ``blocks``  one binary block a row

A block stands alone.  All numbers are little-endian::

    "RNS1" | lanes u16, scale bits u16 | ids, entries, steps per checkpoint, checkpoints, words u32
    entries:      doc id i64, start i64, segment u32, ids u32, null-id flag u8   (arrays, one after another)
    checkpoints:  word offset u32; state u64 per lane
    words u32 | CRC-32 of all that precedes u32

Symbol ``i`` of a block belongs to lane ``i % lanes``; the lanes' states are
interleaved in one word stream.  A checkpoint holds all states and the word
offset, so each stretch between checkpoints decodes on its own; numpy decodes
all stretches of several blocks side by side.  Parquet carries the blocks, so
Spark's commit protocol covers retried and speculative tasks.

A document longer than a block is cut into numbered segments.  Each document's
``start`` (ids of all documents before it) is fixed when the ids are written:
its range partition's base plus the running sum inside the partition.

Defined results: null text is empty (the end id alone); a null id sorts first;
rows that share an id are kept apart by their start.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sylvan.llm.bytelevel import byte_alphabet
from sylvan.llm.workers import held, small_batches

BLOCK_IDS = 1 << 16
LANES = 32
CHECKPOINT_STEPS = 256
SCALE_BITS = 20
BATCH_BLOCKS = 24
CACHE_WORDS = 450_000
SLICE_BYTES = 4 << 20

LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
HEAD = struct.Struct("<4sHHIIIII")


# ---- the frequency table

def scaled_counts(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Counts scaled to sum to ``2**bits``, each seen symbol at least 1."""
    total, seen = int(counts.sum()), counts > 0
    if not total:
        return np.zeros(len(counts), np.uint64)
    space = 1 << bits
    if int(seen.sum()) > space:
        raise ValueError("more symbols than the scale has room for")
    out = np.where(seen, np.maximum(1, np.floor(counts * (space / total))), 0).astype(np.int64)
    rest = space - int(out.sum())
    order = np.argsort(-out, kind="stable")
    while rest:  # the largest symbols take what rounding left, or give what the minimum took
        for s in order:
            if not rest or not out[s]:
                break
            step = rest if rest > 0 else -min(-rest, max(int(out[s]) // 2, 0))
            out[s] += step
            rest -= step
    return out.astype(np.uint64)


class Coder:
    def __init__(self, counts: np.ndarray, bits: int = SCALE_BITS):
        self.bits = np.uint64(bits)
        self.freq = scaled_counts(counts, bits)
        self.cum = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.freq, dtype=np.uint64)[:-1]])
        self.symbol = np.repeat(np.arange(len(counts), dtype=np.uint32), self.freq.astype(np.int64))
        self.room = np.uint64(31 + 32 - bits)

    def encode(self, blocks: list[np.ndarray], lanes: int = LANES, every: int = CHECKPOINT_STEPS):
        """(checkpoint states, word offsets, words) of each block; blocks run side by side."""
        m, steps = len(blocks), max(1, max(-(-len(b) // lanes) for b in blocks))
        ids = np.zeros((m, steps * lanes), np.int64)
        live = np.zeros((m, steps * lanes), bool)
        for i, b in enumerate(blocks):
            ids[i, :len(b)] = b
            live[i, :len(b)] = True
        ids, live = ids.reshape(m, steps, lanes), live.reshape(m, steps, lanes)
        x = np.full((m, lanes), LOW, np.uint64)
        out = np.zeros((m, steps, lanes), np.uint32)
        sent = np.zeros((m, steps, lanes), bool)
        states = {}
        for s in range(steps - 1, -1, -1):
            on = live[:, s]
            f = np.where(on, self.freq[ids[:, s]], np.uint64(1))
            full = on & ((x >> self.room) >= f)
            out[:, s], sent[:, s] = x, full
            y = np.where(full, x >> WORD, x)
            q = y // f
            x = np.where(on, (q << self.bits) + (y - q * f) + self.cum[ids[:, s]], y)
            if s % every == 0:
                states[s] = x
        before = np.concatenate([np.zeros((m, 1), np.int64), sent.sum(2).cumsum(1)], axis=1)
        res = []
        for i, b in enumerate(blocks):
            at = range(0, max(1, -(-len(b) // lanes)), every)
            res.append((np.stack([states[s][i] for s in at]), before[i, at].astype(np.uint32), out[i][sent[i]]))
        return res

    def decode(self, blocks) -> list[np.ndarray]:
        """Ids of blocks given as (n ids, lanes, every, states, offsets, words)."""
        lanes, every = blocks[0][1], blocks[0][2]
        base = np.cumsum([0] + [len(b[5]) for b in blocks])
        words = np.concatenate([*(b[5] for b in blocks), np.zeros(1, np.uint32)]).astype(np.uint64)
        x = np.concatenate([b[3] for b in blocks])
        at = np.concatenate([b[4].astype(np.int64) + base[i] for i, b in enumerate(blocks)])
        left = np.concatenate([np.minimum(every * lanes, b[0] - np.arange(len(b[4])) * every * lanes) for b in blocks])
        out = np.zeros((len(x), every, lanes), np.uint32)
        lane, mask = np.arange(lanes), np.uint64((1 << int(self.bits)) - 1)
        for s in range(min(every, max(0, -(-int(left.max()) // lanes)))):
            on = (s * lanes + lane)[None, :] < left[:, None]
            slot = x & mask
            sym = self.symbol[slot] if len(self.symbol) else slot.astype(np.uint32)
            out[:, s] = sym
            y = np.where(on, self.freq[sym] * (x >> self.bits) + slot - self.cum[sym], x)
            need = on & (y < LOW)
            got = need.cumsum(1)
            x = np.where(need, (y << WORD) | words[np.where(need, at[:, None] + got - 1, -1)], y)
            at = at + got[:, -1]
        flat, res, row = out.reshape(len(out), -1), [], 0
        for b in blocks:
            k = len(b[4])
            res.append(flat[row:row + k].reshape(-1)[:b[0]])
            row += k
        return res


# ---- blocks

def pack(coded, n_ids: int, entries, lanes: int = LANES, every: int = CHECKPOINT_STEPS, bits: int = SCALE_BITS) -> bytes:
    states, offsets, words = coded
    docs, starts, segs, counts = zip(*entries)
    body = b"".join([
        HEAD.pack(b"RNS1", lanes, bits, n_ids, len(entries), every, len(offsets), len(words)),
        np.array([d or 0 for d in docs], "<i8").tobytes(), np.array(starts, "<i8").tobytes(),
        np.array(segs, "<u4").tobytes(), np.array(counts, "<u4").tobytes(),
        np.array([d is None for d in docs], "u1").tobytes(),
        offsets.astype("<u4").tobytes(), states.astype("<u8").tobytes(), words.astype("<u4").tobytes()])
    return body + struct.pack("<I", zlib.crc32(body))


def unpack(data: bytes):
    """(entries, coder input) of a block, after its checksum."""
    body, (crc,) = data[:-4], struct.unpack("<I", data[-4:])
    if zlib.crc32(body) != crc:
        raise ValueError("a block's checksum does not match")
    magic, lanes, bits, n_ids, n, every, k, w = HEAD.unpack_from(body)
    if magic != b"RNS1":
        raise ValueError("not a token block")
    at = HEAD.size

    def take(kind, count):
        nonlocal at
        a = np.frombuffer(body, kind, count, at)
        at += a.nbytes
        return a

    docs, starts, segs, counts, null = (take(t, n) for t in ("<i8", "<i8", "<u4", "<u4", "u1"))
    offsets, states = take("<u4", k), take("<u8", k * lanes).reshape(k, lanes)
    entries = [(None if z else int(d), int(s), int(g), int(c)) for d, s, g, c, z in zip(docs, starts, segs, counts, null)]
    return entries, (n_ids, lanes, every, states, offsets, take("<u4", w))


# ---- texts to ids

#: A plain word has only characters below this one (with the classes, composition and lower case that
#: every Unicode version gives them), and nothing that can belong to a special string.
PLAIN_END = 0x250
BEYOND = f"[^\\x{{00}}-\\x{{12f}}\\x{{131}}-\\x{{{PLAIN_END - 1:x}}}]"
NOT_PLAIN = re.compile(f"[^\0-\u012f\u0131-{chr(PLAIN_END - 1)}]|[<|>]").search
ALPHABET = {b: c for c, b in byte_alphabet().items()}


#: Marks that are a piece of their own after a word of letters alone.
STOPS = ",.;:!?)"


def _plain_pieces():
    chars = [chr(i) for i in range(PLAIN_END)]
    letter = re.escape("".join(c for c in chars if unicodedata.category(c)[0] == "L"))
    number = re.escape("".join(c for c in chars if unicodedata.category(c)[0] == "N"))
    space = r"\t-\r \x85\xa0"
    # fixed value: the alternatives of the public pattern, in its order
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{space}{letter}{number}]+").findall


PLAIN_PIECES = _plain_pieces()


class _Known(dict):
    """Words and their ids as u32 bytes; a missing word is taken from the older generation or encoded."""

    def __init__(self, cache, old):
        super().__init__()
        self.cache, self.old = cache, old

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.cache.word(word)
        self[word] = ids
        return ids


class WordCache:
    """The library's ids (u32 bytes), word by word: no token, pattern or normaliser step crosses a
    blank or newline.  Words are kept in two generations; the older is dropped when the younger is full."""

    def __init__(self, path: str):
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.tokenize = self.tok.model.tokenize
        self.words = _Known(self, {})

    def word(self, word: str) -> bytes:
        if NOT_PLAIN(word):
            return np.array(self.tok.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        pieces = PLAIN_PIECES(word.lower())
        if len(pieces) == 1:
            return self.piece(pieces[0])
        return b"".join(map(self.words.__getitem__, pieces))

    def piece(self, piece: str) -> bytes:
        """A piece's ids by the library's own model, past a normaliser and splitter that it need not pass."""
        known = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(ALPHABET)
        return array("I", [t.id for t in self.tokenize(known)]).tobytes()

    def distinct(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words.  Words of plain letters, with or without a mark after them, are
        lower-cased and brought together before they are looked up."""
        last = pc.utf8_slice_codeunits(words, -1)
        marked = pc.is_in(last, value_set=pa.array(list(STOPS)))
        base = pc.if_else(marked, pc.utf8_slice_codeunits(words, 0, -1), words)
        plain = pc.and_not(pc.utf8_is_alpha(base), pc.match_substring_regex(base, BEYOND))
        marked = pc.and_(plain, marked)
        keys = pc.if_else(plain, pc.utf8_lower(base), words).dictionary_encode()
        ids = pa.array(list(map(self.words.__getitem__, keys.dictionary.to_numpy(zero_copy_only=False))), pa.large_binary()).take(keys.indices)
        marks = pa.array([b"", *map(self.words.__getitem__, STOPS)], pa.large_binary())
        at = pc.if_else(marked, pc.add(pc.index_in(last, value_set=pa.array(list(STOPS))), 1), 0)
        if len(self.words) > CACHE_WORDS:
            self.words = _Known(self, {**self.words})
        return pc.binary_join_element_wise(ids, marks.take(at), pa.scalar(b"", pa.large_binary()))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as u32 bytes; Arrow splits the words and numbers the distinct ones."""
        lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        ids = self.distinct(words.dictionary).take(words.indices)
        end = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, 8 * ids.offset) if len(ids) else np.zeros(1, np.int64)
        data = memoryview(ids.buffers()[2] or b"")
        cut = end[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])]
        return [bytes(data[a:b]) for a, b in zip(cut.tolist(), cut[1:].tolist())]

    def encode_all(self, texts: pa.Array):
        """The same, a few megabytes of text at a time."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
        start = 0
        while start < len(texts):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
            yield from self.encode(texts[start:stop])
            start = stop


def _words(path: str) -> WordCache:
    return held("token_files", path, lambda: WordCache(path))


# ---- Spark jobs

def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", block_ids: int = BLOCK_IDS) -> str:
    """Write the folder described above and return its path."""
    spark = docs.sparkSession
    small_batches(spark)
    # the number splits an id that holds many rows (or all null ids) over several ranges
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("at"))
               .repartitionByRange("doc_id", "at").sortWithinPartitions("doc_id", "at").select("doc_id", "text"))

    names = ["part", "doc_id", "start", "n", "ids", "counts"]

    def to_ids(batches):
        enc, part, start = _words(tokenizer_path), TaskContext.get().partitionId(), 0
        end, total = struct.pack("<I", end_id), np.zeros(end_id + 1, np.int64)
        for batch in batches:
            rows, starts, sizes = [], [], []
            for ids in enc.encode_all(batch.column(1)):
                ids += end
                rows.append(ids)
                starts.append(start)
                sizes.append(len(ids) // 4)
                start += len(ids) // 4
            raw = pa.array(rows, pa.large_binary())
            if rows:
                seen = np.bincount(np.frombuffer(raw.buffers()[2], "<u4"), minlength=len(total))
                seen[:len(total)] += total
                total = seen
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(rows), pa.int32()), batch.column(0), pa.array(starts, pa.int64()),
                 pa.array(sizes, pa.int64()), raw.cast(pa.binary()), pa.nulls(len(rows), pa.binary())], names=names)
        # the partition's last row: its ids and their counts
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([start], pa.int64()),
             pa.nulls(1, pa.binary()), pa.array([total.astype("<i8").tobytes()], pa.binary())], names=names)

    ids_schema = "part int, doc_id long, start long, n long, ids binary, counts binary"
    ordered.mapInArrow(to_ids, ids_schema).write.option("compression", "zstd").parquet(f"{path}/ids")
    ids = spark.read.schema(ids_schema).parquet(f"{path}/ids")

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for x in batch.column(0).drop_null():
                c = np.frombuffer(x.as_py(), "<i8")
                short, long = sorted((total, c), key=len)
                total = long.copy()
                total[:len(short)] += short
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    # a task for each core adds up its partitions' counts: rows by cores, not by partitions
    (ids.select("counts").where("counts IS NOT NULL").coalesce(spark.sparkContext.defaultParallelism).mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
     .write.parquet(f"{path}/model"))
    counts = _model(spark, path)
    # one row per range partition, in order: the partitions' bases
    totals = ids.where("counts IS NOT NULL").select("part", "n").collect()
    base, at = {}, 0
    for part, n in sorted((r["part"], r["n"]) for r in totals):
        base[part], at = at, at + n

    def to_blocks(batches):
        coder, ready = Coder(counts), []
        block, room, entries, current = [], block_ids, [], None

        def flush():
            coded = coder.encode([b for b, _ in ready])
            data = [pack(c, len(b), e) for c, (b, e) in zip(coded, ready)]
            out = pa.RecordBatch.from_arrays(
                [pa.array([e[0][1] for _, e in ready], pa.int64()), pa.array([len(b) for b, _ in ready], pa.int64()),
                 pa.array(data, pa.binary())], names=["start", "n", "data"])
            ready.clear()
            return out

        for batch in batches:
            for part, doc, start, raw in zip(*batch.columns):
                part = part.as_py()
                if part != current and block:  # a block holds one run of ascending ids
                    ready.append((np.concatenate(block), entries))
                    block, room, entries = [], block_ids, []
                    if len(ready) == BATCH_BLOCKS:
                        yield flush()
                current = part
                doc, start = doc.as_py(), start.as_py() + base[part]
                rest, seg = np.frombuffer(raw.as_py(), "<u4"), 0
                while len(rest):
                    piece, rest = rest[:room], rest[room:]
                    block.append(piece)
                    entries.append((doc, start, seg, len(piece)))
                    seg, room = seg + 1, room - len(piece)
                    if not room:
                        ready.append((np.concatenate(block), entries))
                        block, room, entries = [], block_ids, []
                        if len(ready) == BATCH_BLOCKS:
                            yield flush()
        if block:
            ready.append((np.concatenate(block), entries))
        if ready:
            yield flush()

    (ids.where("ids IS NOT NULL").select("part", "doc_id", "start", "ids").mapInArrow(to_blocks, "start long, n long, data binary")
     .write.option("compression", "uncompressed").parquet(f"{path}/blocks"))
    return path


def _model(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.schema("id long, n long").parquet(f"{path}/model").collect()  # at most one row per vocabulary entry
    counts = np.zeros(1 + max((r["id"] for r in rows), default=0), np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


def _decoded(batches, counts):
    """(entry, ids) of every segment in batches of blocks."""
    coder = Coder(counts)
    for batch in batches:
        data = batch.column(0)
        for i in range(0, len(data), BATCH_BLOCKS):
            blocks = [unpack(d.as_py()) for d in data[i:i + BATCH_BLOCKS]]
            for (entries, _), ids in zip(blocks, coder.decode([b for _, b in blocks])):
                at = 0
                for e in entries:
                    yield e, ids[at:at + e[3]]
                    at += e[3]


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("start long, n long, data binary").parquet(f"{path}/blocks").select("data")


def _segments(spark, path, column, kind, schema, make):
    counts = _model(spark, path)

    def read(batches):
        rows = []

        def out():
            cols = list(zip(*rows)) or [()] * 5
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), kind]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                              names=["doc_id", "start", "seg", "n", column])

        for (doc, start, seg, n), ids in _decoded(batches, counts):
            rows.append((doc, start, seg, n, make(ids)))
            if len(rows) == 2000:
                yield out()
        if rows:
            yield out()

    return _blocks(spark, path).mapInArrow(read, f"doc_id long, start long, seg int, n long, {column} {schema}")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, seg, n, ids``: every segment's ids, decoded from the blocks."""
    return _segments(spark, path, "ids", pa.list_(pa.int32()), "array<int>", lambda x: x.astype(np.int32))


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, decoded from the blocks."""
    parts = _segments(spark, path, "crc", pa.int64(), "long", lambda x: zlib.crc32(x.astype("<u4").tobytes()))

    @F.arrow_udf("long")
    def combined(segments: pa.Array) -> pa.Array:
        out = []
        for doc in segments:
            crc = 0
            for s in sorted(doc.as_py(), key=lambda s: s["seg"]):
                crc = crc32_combine(crc, s["crc"], 4 * s["n"])
            out.append(crc)
        return pa.array(out, pa.int64())

    return (parts.groupBy("start").agg(F.first("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"),
                                       F.collect_list(F.struct("seg", "n", "crc")).alias("segments"))
            .select("doc_id", "start", "n_tokens", combined("segments").alias("ids_crc32")))


def crc32_combine(a: int, b: int, size: int) -> int:
    """CRC-32 of two joined byte strings from their CRCs and the second's size."""
    if not a:
        return b
    return _shift(a, 8 * size) ^ b


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2), bits reflected, modulo the CRC-32 polynomial."""
    out, bit = 0, 1 << 31
    while bit:
        if a & bit:
            out ^= b
        b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
        bit >>= 1
    return out


def _shift(crc: int, bits: int) -> int:
    """``crc`` times x to the power of ``bits``."""
    power, square = 1 << 31, 1 << 30
    while bits:
        if bits & 1:
            power = _times(power, square)
        square = _times(square, square)
        bits >>= 1
    return _times(power, crc)

"""Cross-tokenizer alignment through token-byte incidence matrices.

Two tokenizers cut the same bytes (a space and the text) into tokens A and B.
An incidence matrix has a row per token and a column per byte; it is held in
compressed rows (``Csr``), built and multiplied here with numpy.  Gustavson's
row products ``A . B'`` (a row of the result is the sum of the rows of ``B'``
that the row of ``A`` names) give the links:

* ``overlap``  A and B token share a byte (the value: how many),
* ``group``    both lie in one group: byte offsets where A and B tokens both end cut the tokens into groups, and the
  token-group incidences are multiplied,
* ``end``      their byte ranges end together: the incidences of last bytes are multiplied.

The work is done once per distinct *unit* of a batch, a run of white space
with the run of other characters after it, and kept in a bounded cache per
worker.  Both tokenizers always end a token between a unit and the next one:
the byte-level pre-tokeniser cuts before white space, and no piece of the
other vocabulary continues into white space.  The white-space characters for
which that does not hold are read from the vocabulary; a text that has one of
them is a single unit.  Units go through the libraries, so ids are theirs.

``token_groups`` is one map over the documents.  ``link_scores`` adds up the
links of each (A id, B id) corpus-wide and joins these counts with the
documents' links; the counts are broadcast only while their counted rows prove
them small, else the join shuffles (a pair found in very many documents is a
skewed key of a plain equi-join, which adaptive execution splits).

Defined results: null and empty texts, and texts whose A or B tokens do not
give back the bytes of space and text, have no tokens; repeated rows are
aligned row by row, and their links all count; an empty table gives no row;
very long texts are taken in segments that end with a unit; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sylvan.llm.bpe import BEYOND_PLAIN, plain_pattern
from sylvan.llm.bytelevel import Vocabulary
from sylvan.llm.joins import stored_keys
from sylvan.llm.workers import held
from sylvan.session import scratch_path, ship_package

#: Units kept by a worker, and their characters together; beyond either the cache starts anew.
CACHE_UNITS = 400_000
CACHE_CHARS = 16_000_000
#: Characters of a text that are cut into units at a time, and rows of a batch that are aligned at a time.
SEGMENT_CHARS = 1_000_000
SLICE_ROWS = 500
#: Units encoded end to end by one call.
RUN_UNITS = 1000
#: Partial products expanded at a time by ``Csr.dot``.
EXPANDED = 4_000_000

LINKS = ("overlap", "group", "end")

_NO_PAIRS = np.zeros(0, np.int64), np.zeros(0, np.int64)


@dataclass
class Csr:
    """A sparse matrix in compressed rows."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    n_cols: int

    @classmethod
    def of(cls, rows: np.ndarray, cols: np.ndarray, n_rows: int, n_cols: int) -> Csr:
        """Ones at (rows, cols); ``rows`` ascend."""
        indptr = np.zeros(n_rows + 1, np.int64)
        np.cumsum(np.bincount(rows, minlength=n_rows), out=indptr[1:])
        return cls(indptr, np.asarray(cols, np.int64), np.ones(len(cols), np.int64), n_cols)

    @property
    def n_rows(self) -> int:
        return len(self.indptr) - 1

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(self.n_rows), np.diff(self.indptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        out = Csr.of(self.indices[order], self.rows()[order], self.n_cols, self.n_rows)
        out.data = self.data[order]
        return out

    def dot(self, other: Csr) -> Csr:
        """Row products: row i of the result is the sum of ``other``'s rows named by row i, weighted."""
        fan = np.diff(other.indptr)[self.indices]
        made = np.concatenate([[0], np.cumsum(fan)])
        out, first, n = [], 0, self.n_rows
        while first < n:
            last = int(np.searchsorted(made[self.indptr], made[self.indptr[first]] + EXPANDED, "right")) - 1
            last = min(n, max(first + 1, last))
            out.append(self._products(other, first, last, fan))
            first = last
        counts = [c for c, _, _ in out]
        indptr = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, np.int64)
        flat = lambda k: np.concatenate([x[k] for x in out]) if out else np.zeros(0, np.int64)
        return Csr(indptr, flat(1), flat(2), other.n_cols)

    def _products(self, other: Csr, first: int, last: int, fan: np.ndarray):
        lo, hi = self.indptr[first], self.indptr[last]
        n = fan[lo:hi]
        at = np.repeat(other.indptr[self.indices[lo:hi]] - np.cumsum(n) + n, n) + np.arange(n.sum())
        row = np.repeat(np.repeat(np.arange(last - first), np.diff(self.indptr[first:last + 1])), n)
        key, where = np.unique(row * other.n_cols + other.indices[at], return_inverse=True)
        value = np.bincount(where, np.repeat(self.data[lo:hi], n) * other.data[at], len(key)).astype(np.int64)
        return np.bincount(key // other.n_cols, minlength=last - first), key % other.n_cols, value


def byte_incidence(lengths: np.ndarray) -> Csr:
    """Tokens that lie end to end, by the bytes they cover."""
    total = int(lengths.sum())
    return Csr.of(np.repeat(np.arange(len(lengths)), lengths), np.arange(total), len(lengths), total)


def end_incidence(lengths: np.ndarray) -> Csr:
    """Tokens by their last bytes (a token without bytes has none)."""
    some = np.flatnonzero(lengths)
    return Csr.of(some, np.cumsum(lengths)[some] - 1, len(lengths), int(lengths.sum()))


def group_incidence(lengths: np.ndarray, cuts: np.ndarray) -> Csr:
    """Tokens by their group; ``cuts`` are the last bytes of the groups."""
    some = np.flatnonzero(lengths)
    return Csr.of(some, np.searchsorted(cuts, np.cumsum(lengths)[some] - 1), len(lengths), len(cuts))


def link_matrix(a: np.ndarray, b: np.ndarray, kind: str) -> tuple[Csr, np.ndarray]:
    """The links of A and B tokens (byte lengths of either, the same bytes), and the last byte of each group."""
    if kind not in LINKS:
        raise ValueError(f"links are one of {LINKS}")
    ends = end_incidence(a).dot(end_incidence(b).transposed())
    cuts = (np.cumsum(a) - 1)[np.unique(ends.rows())]
    if kind == "end":
        return ends, cuts
    make = byte_incidence if kind == "overlap" else lambda x: group_incidence(x, cuts)
    return make(a).dot(make(b).transposed()), cuts


class Aligner:
    """Both tokenizers, and what is known of the units seen."""

    def __init__(self, a_path: str, b_path: str, links: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.links = links
        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True  # special strings inside texts are plain text
        self.a.no_truncation(), self.a.no_padding()
        v = Vocabulary(a_path)
        self.a_bytes = [v.bytes_of.get(i, b"") for i in range(max([*v.bytes_of, *v.special.values()]) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        is_byte = [self.b.is_byte(i) for i in range(len(pieces))]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode()
                        for p, byte in zip(pieces, is_byte)]
        self.a_len, self.b_len = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.items = pa.array([f"{i}{sign}" for i in range(max(len(self.a_bytes), len(pieces))) for sign in (",", "|", ";", "")])
        self.lead = self.b.piece_to_id("▁")
        # white space into which a piece continues: a unit must not begin there
        joined = {c for p, byte in zip(pieces, is_byte) if not byte
                  for c in re.findall(r"(?<=.)\s", re.sub("▁", " ", p), re.S)} - {" "}
        if any(re.search(r"\S ", p.replace("▁", " ")) for p, byte in zip(pieces, is_byte) if not byte):
            joined.add(" ")
        self.whole = re.compile("[" + re.escape("".join(sorted(joined))) + "]").search if joined else lambda text: None
        self.ranks = self._rank_encoder(v)
        self.units_of = re.compile(r"\s*\S+|\s+").findall
        self.reset()

    @staticmethod
    def _rank_encoder(v: Vocabulary):
        """A faster encoder of the same vocabulary for plain text, or None if it might differ.

        It merges the neighbours whose bytes together have the smallest rank, the vocabulary's own merges the pair with
        the smallest rank.  The two are the same if ids rise with ranks and every token is the encoding of its own
        bytes: within the bytes of a token, between two boundaries that stay, all smaller merges leave its own pair.
        """
        merged = sorted((rank, i) for rank, i in v.rank.values())
        ids = [i for _, i in merged]
        if ids != sorted(set(ids)) or max(v.byte_id) > min(ids, default=1 << 60) or len(v.bytes_of) != 256 + len(ids):
            return None
        for token, own in v.bytes_of.items():
            parts = [v.byte_id[b] for b in own]
            while len(parts) > 1:
                rank, at = min((v.rank.get(p, (1 << 60,))[0], k) for k, p in enumerate(zip(parts, parts[1:])))
                if rank == 1 << 60:
                    return None
                parts[at:at + 2] = [v.rank[parts[at], parts[at + 1]][1]]
            if parts != [token]:
                return None
        return tiktoken.Encoding("ranks", pat_str=plain_pattern().pattern, mergeable_ranks={b: i for i, b in v.bytes_of.items()}, special_tokens={})

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.texts = pa.array([], pa.string())
        self.counts = np.zeros((0, 4), np.int64)  # tokens A, tokens B, groups, links; -1 where the bytes differ
        self.pair_at = np.zeros(1, np.int64)
        self.pairs = np.zeros(0, np.int64)

    def segments(self, text: str):
        """The units of a space and the text, in lists of bounded size."""
        text = " " + text
        if self.whole(text):
            yield [text]
            return
        at, boundary = 0, re.compile(r"(?<=\S)(?=\s)")
        while len(text) - at > SEGMENT_CHARS:
            cut = boundary.search(text, at + SEGMENT_CHARS)
            if not cut:
                break
            yield self.units_of(text[at:cut.start()])
            at = cut.start()
        yield self.units_of(text[at:] if at else text)

    def learn(self, new: list[str]) -> None:
        """Align units that are not known yet, all by one product."""
        # plain units can be encoded end to end: they begin with white space and end without
        plain = [not BEYOND_PLAIN(u) and not u[-1].isspace() for u in new]
        if not all(plain):
            new = [u for u, p in zip(new, plain) if p] + [u for u, p in zip(new, plain) if not p]
        n_plain = sum(plain)
        runs = [new[i:min(i + RUN_UNITS, n_plain)] for i in range(0, n_plain, RUN_UNITS)]
        runs += [new[i:i + 1] for i in range(n_plain, len(new))]
        found = [self._ids(units, k * RUN_UNITS < n_plain) for k, units in enumerate(runs)]
        xs, ys = (np.concatenate([f[k] for f in found]) for k in (0, 2))
        na, nb, good = (np.concatenate([f[k] for f in found]) for k in (1, 3, 4))
        if not good.all():
            xs, ys = xs[np.repeat(good, na)], ys[np.repeat(good, nb)]
            na, nb = na[good], nb[good]
        a_len, b_len = self.a_len[xs], self.b_len[ys]
        links, cuts = link_matrix(a_len, b_len, self.links)
        # every unit ends with a cut, so no group and no link reaches into the next one
        a_of, b_of = np.searchsorted(cuts, np.cumsum(a_len) - 1), np.searchsorted(cuts, np.cumsum(b_len) - 1)
        last = a_of[np.cumsum(na) - 1]
        n_groups = np.diff(last, prepend=-1)
        n_links = np.bincount(np.repeat(np.arange(len(na)), na), np.diff(links.indptr), len(na)).astype(np.int64)
        counts = np.full((len(new), 4), -1, np.int64)
        counts[good] = np.stack([na, nb, n_groups, n_links], 1)
        sizes = np.zeros((2, len(new)), np.int64)
        sizes[:, good] = na + nb, n_links
        texts = pc.binary_join(pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes[0])]),
                                                             self._group_items(xs, ys, a_of, b_of, last)), "")
        base = len(self.texts)
        self.known.update((u, base + i) for i, u in enumerate(new))
        self.chars += sum(map(len, new))
        self.texts = pa.concat_arrays([self.texts, texts])
        self.counts = np.concatenate([self.counts, counts])
        self.pair_at = np.concatenate([self.pair_at, self.pair_at[-1] + np.cumsum(sizes[1])])
        self.pairs = np.concatenate([self.pairs, (xs[links.rows()] << 32) | ys[links.indices]])

    def _ids(self, units: list[str], plain: bool):
        """(ids A, their number per unit, ids B, their number per unit, whether both give back the unit's bytes)."""
        own = [u.encode() for u in units]
        if plain:
            text = "".join(units)
            lead = text[0] != " "  # the library puts a space in front, which stands for the text's own
            x = self.ranks.encode_ordinary(text) if self.ranks else self.a.encode(text, add_special_tokens=False).ids
            y = self.b.encode(text if lead else text[1:])
            x, y = np.array(x, np.int64), np.array(y, np.int64)
            if not lead or len(y) and y[0] == self.lead:
                y, size = y[int(lead):], np.cumsum([len(u) for u in own])
                counts = [self._cut(ids, table, lengths, size, b"".join(own))
                          for ids, table, lengths in ((x, self.a_bytes, self.a_len), (y, self.b_bytes, self.b_len))]
                if counts[0] is not None and counts[1] is not None:
                    return x, counts[0], y, counts[1], np.ones(len(units), bool)
        found = [self._unit_ids(u, b) for u, b in zip(units, own)]
        flat = lambda k: np.array([i for f in found for i in f[k]], np.int64)
        count = lambda k: np.array([len(f[k]) for f in found], np.int64)
        return flat(0), count(0), flat(1), count(1), np.array([f[2] for f in found], bool)

    @staticmethod
    def _cut(ids, table, lengths, size, own: bytes):
        """Tokens per unit, if the tokens give back the bytes and end with each unit; else None."""
        if b"".join(map(table.__getitem__, ids.tolist())) != own:
            return None
        ends = np.cumsum(lengths[ids])
        upto = np.searchsorted(ends, size, "right")
        return np.diff(upto, prepend=0) if (ends[upto - 1] == size).all() else None

    def _unit_ids(self, unit: str, own: bytes):
        x = self.a.encode(unit, add_special_tokens=False).ids
        if unit == " ":
            y = [self.lead]  # an empty text has no tokens, but a space has
        elif unit[0] == " ":
            y = self.b.encode(unit[1:])
        else:
            y = self.b.encode(unit)
            y = y[1:] if y[:1] == [self.lead] else []
        return x, y, all(b"".join(map(t.__getitem__, ids)) == own for t, ids in ((self.a_bytes, x), (self.b_bytes, y)))

    def _group_items(self, xs, ys, a_of, b_of, last) -> pa.Array:
        """Ids with the sign after them, in the order of the groups' text: a comma, a bar after the last A of a group,
        a semicolon after its last B (nothing after the last of a unit)."""
        ids, of = np.concatenate([xs, ys]), np.concatenate([a_of, b_of])
        is_b = np.repeat([0, 1], [len(xs), len(ys)])
        order = np.lexsort((is_b, of))  # stable: tokens keep their order
        ids, of, is_b = ids[order], of[order], is_b[order]
        ends = np.concatenate([(of[1:] != of[:-1]) | (is_b[1:] != is_b[:-1]), [True]])[:len(ids)]
        sign = np.where(ends, 1 + is_b, 0)
        sign[ends & (is_b == 1) & np.isin(of, last)] = 3
        return self.items.take(pa.array(ids * 4 + sign))

    def align(self, parts: list[list[str]]):
        """For lists of units: counts (tokens A and B, groups, links; -1 where bytes differ), the groups' texts, and the
        distinct id pairs with their numbers of links as (offsets, pairs, times)."""
        if len(self.texts) > CACHE_UNITS or self.chars > CACHE_CHARS:
            self.reset()
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        units = list(chain.from_iterable(parts))
        new = [u for u in dict.fromkeys(units) if u not in self.known]
        if new:
            self.learn(new)
        at = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))
        part, counts = np.repeat(np.arange(len(parts)), sizes), self.counts[at]
        whole = np.bincount(part, counts[:, 0] < 0, len(parts)) == 0
        total = np.stack([np.bincount(part, counts[:, k], len(parts)) for k in range(4)], 1).astype(np.int64)
        total[~whole] = -1
        texts = pc.binary_join(pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]), self.texts.take(pa.array(at))), ";")
        n = self.pair_at[at + 1] - self.pair_at[at]
        codes = self.pairs[np.repeat(self.pair_at[at] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        cut = np.concatenate([[0], np.cumsum(np.bincount(part, n, len(parts)).astype(np.int64))])
        found = [np.unique(codes[i:j], return_counts=True) if ok else _NO_PAIRS for i, j, ok in zip(cut, cut[1:], whole)]
        return total, texts, found

    def rows(self, texts: list[str | None]):
        """``align`` for whole texts (null and empty: no units)."""
        short = [list(self.segments(t)) if t and len(t) <= SEGMENT_CHARS else [] for t in texts]
        counts, joined, found = self.align([s[0] if s else [] for s in short])
        joined = joined.to_pylist()
        for i, t in enumerate(texts):
            if t and len(t) > SEGMENT_CHARS:
                counts[i], joined[i], found[i] = self._long(t)
            if counts[i, 0] < 0:
                counts[i], joined[i], found[i] = 0, "", _NO_PAIRS
        return counts, joined, found

    def _long(self, text: str):
        """A very long text: its segments one after the other."""
        total, strings, pairs = np.zeros(4, np.int64), [], []
        for units in self.segments(text):
            counts, joined, found = self.align([units])
            if counts[0, 0] < 0:
                return counts[0], "", _NO_PAIRS
            total += counts[0]
            strings.append(joined[0].as_py())
            pairs.append(found[0])
        codes, where = np.unique(np.concatenate([c for c, _ in pairs]), return_inverse=True)
        return total, ";".join(strings), (codes, np.bincount(where, np.concatenate([n for _, n in pairs])).astype(np.int64))


def token_groups(docs: DataFrame, a_path: str, b_path: str, links: str = "end", id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times``.

    ``groups`` is text: ``a1,a2|b1;a3|b2,b3``; ``pairs`` are the distinct linked ids ``a << 32 | b`` of the row, and
    ``times`` how many links hold each.
    """
    if links not in LINKS:
        raise ValueError(f"links are one of {LINKS}")
    ship_package(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        aligner = held("alignment", (a_path, b_path, links), lambda: Aligner(a_path, b_path, links))
        for batch in batches:
            for part in (batch.slice(i, SLICE_ROWS) for i in range(0, len(batch), SLICE_ROWS)):
                counts, groups, found = aligner.rows(part.column(1).to_pylist())
                at = np.concatenate([[0], np.cumsum([len(codes) for codes, _ in found])]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(at, np.concatenate([x[k] for x in found]).astype(kind))
                         for k, kind in ((0, np.int64), (1, np.int32))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(counts[:, k]) for k in range(4)), pa.array(groups, pa.string()), *lists],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>")


def link_scores(aligned: DataFrame) -> DataFrame:
    """``aligned`` (a table of ``token_groups`` with a unique ``row``) as ``row, n_best, count_sum``, rows with links only.

    A link's count is the number of links corpus-wide with its two ids; ``n_best`` links have the highest count of
    their B id (ties included), and ``count_sum`` adds the counts up.
    """
    path = scratch_path(aligned.sparkSession, "links")
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.pairs", "p.times")
    counts = links.groupBy("pairs").agg(F.sum("times").alias("n")).withColumn("b", F.col("pairs").bitwiseAND(0xFFFFFFFF))
    counts.write.parquet(f"{path}/counts")
    counts = aligned.sparkSession.read.schema(counts.schema).parquet(f"{path}/counts")
    top = counts.groupBy("b").agg(F.max("n").alias("top"))
    scored = counts.join(top, "b").select(F.col("pairs").alias("pair"), "n", (F.col("n") == F.col("top")).cast("int").alias("best"))
    scored = stored_keys(scored, f"{path}/scored")
    return (links.join(scored, F.col("pairs") == F.col("pair"))
            .groupBy("row").agg(F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")))

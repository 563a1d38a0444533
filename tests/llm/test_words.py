"""Alignment, spelling variants and the quality classifier: brute force, held-out accuracy, and the odd inputs."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sylvan.llm import alignment, quality, spelling
from sylvan.llm.queries import BYTE_BPE, PIECE_BPE, QUERIES, SLIP
from sylvan.sources.tables import table
from tests.conftest import SF001, SF01

ODD = [None, "", " ", " a", "a ", "  ", "\n\n", "x\r\ny z", "\nBar\tq  r ", "日本語 text ½²", "▁x y", "<s> </s><unk><0x41>", "a\x1cb \x85 c",
       "<|endoftext|> it's", "x\xa0y　z   w", "😀 👍🏽 x", "a" * 3000 + " b", "\t\t a\n \n b", "é ﻿ ñandú"]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, one row twice, one id with two texts, a null id, and columns with the operators' own names."""
    rows = [(i, t) for i, t in enumerate(ODD)] + [(9, ODD[9]), (9, "another text"), (None, "no id here")]
    return spark.createDataFrame([(*r, 7, 8, "k", "w", 1) for r in rows],
                                 "doc_id long, text string, row long, n int, pairs string, word string, label int")


@pytest.fixture(scope="module")
def texts(spark):
    return [(r["doc_id"], r["text"]) for r in table(spark, SF001, "documents").select("doc_id", "text").collect()]


# ----------------------------------------------------------------------------- alignment


def dense_links(a, b, kind):
    """The links of tokens of these byte lengths, pair by pair."""
    spans = [[(int(e - n), int(e)) for n, e in zip(x, np.cumsum(x))] for x in (a, b)]
    cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    group = lambda e: next(i for i, c in enumerate(cuts) if e <= c)
    out = {}
    for i, (s, e) in enumerate(spans[0]):
        for j, (t, f) in enumerate(spans[1]):
            if kind == "overlap" and min(e, f) > max(s, t):
                out[i, j] = min(e, f) - max(s, t)
            if kind == "end" and e == f or kind == "group" and group(e) == group(f):
                out[i, j] = 1
    return out


def test_products_equal_pairwise_links(monkeypatch):
    rng = random.Random(4)
    for trial in range(60):
        total = rng.randint(1, 40)
        lengths = [np.diff([0, *sorted(rng.sample(range(1, total), rng.randint(0, total - 1))), total]) for _ in range(2)]
        for kind in alignment.LINKS:
            monkeypatch.setattr(alignment, "EXPANDED", rng.choice([1, 7, 4_000_000]))
            got, _ = alignment.link_matrix(*lengths, kind)
            cells = dict(zip(zip(got.rows().tolist(), got.indices.tolist()), got.data.tolist()))
            expected = dense_links(*lengths, kind)
            if kind == "group":  # the shared group counts once
                assert set(cells) == set(expected)
            else:
                assert cells == expected
    a, b = (np.array([[1, 0, 2], [0, 3, 0]]), np.array([[1, 1], [0, 2], [5, 0]]))
    sparse = [alignment.Csr.of(*np.nonzero(m), *m.shape) for m in (a, b)]
    for s, m in zip(sparse, (a, b)):
        s.data = m[np.nonzero(m)]
    product = sparse[0].dot(sparse[1])
    dense = np.zeros((2, 2), int)
    dense[product.rows(), product.indices] = product.data
    assert (dense == a @ b).all()


def brute_alignment(rows):
    tok, sp = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    tok.encode_special_tokens = True
    v = alignment.Vocabulary(BYTE_BPE)
    b_bytes = lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
    docs, pairs = [], Counter()
    for doc, text in rows:
        a, b = [], []
        if text:
            a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            own = (" " + text).encode()
            if b"".join(map(v.bytes_of.get, a)) != own or b"".join(map(b_bytes, b)) != own:
                a, b = [], []
        at, bt = np.cumsum([len(v.bytes_of[i]) for i in a]), np.cumsum([len(b_bytes(i)) for i in b])
        cuts = sorted(set(at.tolist()) & set(bt.tolist()))

        def side(ids, ends):
            upto = np.searchsorted(ends, cuts, "right").tolist()
            return [",".join(map(str, ids[i:j])) for i, j in zip([0, *upto], upto)]

        groups = ";".join(f"{x}|{y}" for x, y in zip(side(a, at), side(b, bt)))
        where = {int(e): i for i, e in zip(b, bt)}
        links = [(i, where[int(e)]) for i, e in zip(a, at) if int(e) in where]
        pairs.update(links)
        docs.append((doc, len(a), len(b), len(cuts), links, groups))
    top = defaultdict(int)
    for (_, j), n in pairs.items():
        top[j] = max(top[j], n)
    return [(doc, na, nb, ng, len(links), sum(pairs[x] == top[x[1]] for x in links), sum(pairs[x] for x in links),
             hashlib.sha256(groups.encode()).hexdigest() if na else "")
            for doc, na, nb, ng, links, groups in docs]


def by_id(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, str(x)) for x in r))


def digests(aligned):
    """The query's columns of an operator's result."""
    aligned = aligned.withColumn("row", F.monotonically_increasing_id()).checkpoint()
    scores = alignment.link_scores(aligned).withColumnRenamed("row", "of")
    got = aligned.join(scores, F.col("row") == F.col("of"), "left").collect()
    return [(r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"] or 0, r["count_sum"] or 0,
             hashlib.sha256(r["groups"].encode()).hexdigest() if r["n_a"] else "") for r in got]


def test_alignment_equals_the_libraries(spark, odd, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    expected = by_id(brute_alignment(rows))
    assert by_id(digests(alignment.token_groups(odd, BYTE_BPE, PIECE_BPE))) == expected
    assert alignment.token_groups(odd.where("false"), BYTE_BPE, PIECE_BPE).count() == 0
    with pytest.raises(ValueError):
        alignment.token_groups(odd, BYTE_BPE, PIECE_BPE, links="none")
    # segments and the cache's end
    whole = alignment.Aligner(BYTE_BPE, PIECE_BPE, "end").rows([t for _, t in rows])
    monkeypatch.setattr(alignment, "SEGMENT_CHARS", 4)
    monkeypatch.setattr(alignment, "CACHE_UNITS", 3)
    cut = alignment.Aligner(BYTE_BPE, PIECE_BPE, "end").rows([t for _, t in rows])
    assert (whole[0] == cut[0]).all() and whole[1] == cut[1]
    assert all(x.tolist() == y.tolist() for p, q in zip(whole[2], cut[2]) for x, y in zip(p, q))


def test_alignment_of_very_long_texts():
    long = "naïve café, 日本 " * 90_000 + "x" * 20_000
    counts, groups, found = alignment.Aligner(BYTE_BPE, PIECE_BPE, "end").rows([long])
    tok, sp = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    assert counts[0][:2].tolist() == [len(tok.encode(" " + long).ids), len(sp.encode(long))]
    assert groups[0].count(";") + 1 == counts[0][2] == found[0][1].sum()


def test_alignment_query_equals_the_libraries(spark, texts):
    assert by_id(QUERIES["op13_alignment"](spark, SF001).collect()) == by_id(brute_alignment(texts))


# ----------------------------------------------------------------------------- spelling


def one_edit(word):
    letters = range(len(word))
    return {word[:i] + word[i + 1:] for i in letters}, {(word[:i], word[i + 1:]) for i in letters}


def brute_variants(counts):
    """Near words by deletions and by equal surroundings of one letter."""
    deleted, around = defaultdict(set), defaultdict(set)
    for w in counts:
        shorter, sides = one_edit(w)
        for x in shorter:
            deleted[x].add(w)
        for x in sides:
            around[x].add(w)
    near = defaultdict(set)
    for w in counts:
        near[w] |= {x for s in one_edit(w)[1] for x in around[s]} - {w}
        near[w] |= deleted.get(w, set())
        near[w] |= {x for x in one_edit(w)[0] if x in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 10 * n:
            form[w] = best
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return out


def variants(spark, counts, **options):
    words = spark.createDataFrame(list(counts.items()) or [], "word string, n long")
    return [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.group_variants(words, **options).collect()]


def test_variants_equal_brute_force(spark):
    rng, counts = random.Random(3), {"": 3, "a": 40, "b": 400, "ab": 5000}
    for _ in range(900):  # a crowd of short and long words with shared halves, repeats of letters and letters beyond 16 bits
        stem = rng.choice(["", "aaaa", "banana", "ñandú", "\U0001f600x"])
        counts[stem + "".join(rng.choices("aabñ\U0001f600", k=rng.randint(0, 6))) + rng.choice(["", "aaaa", "nana"])] = rng.choice([1, 2, 7, 30, 400, 5000, 70000])
    assert by_id(variants(spark, counts)) == by_id(brute_variants(counts))
    assert by_id(variants(spark, counts, block=16)) == by_id(brute_variants(counts))
    assert variants(spark, {}) == []
    one = "x" * 20_000
    assert by_id(variants(spark, {one: 1, one + "y": 30})) == by_id([(one, one + "y", one + "y", 1, 1, 30), (one + "y", None, one + "y", 30, 1, None)])


def test_null_words_take_no_part(spark):
    words = spark.createDataFrame([(None, 5), ("abcdefg", 2), ("abcdefh", 40)], "word string, n long")
    assert by_id(spelling.near_words(words).collect()) == by_id([("abcdefg", 1, "abcdefh", 40), ("abcdefh", 1, "abcdefg", 2)])


def counted(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % SLIP == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_spelling_query_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF01, "documents").select("doc_id", "text").collect()]
    got = [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in QUERIES["op12_spelling"](spark, SF01).collect()]
    expected = brute_variants(counted(rows))
    assert any(x[1] for x in expected) and by_id(got) == by_id(expected)


def test_runs_of_odd_texts(spark, odd):
    odd = odd.unionByName(spark.createDataFrame([(50, "ÀBCDEFG×÷ÿ abcdef abcdefG1abcdefg " + "Z" * 1_100_000)], "doc_id long, text string"), True)
    got = [r["run"] for r in spelling.runs(odd).collect()]
    expected = [m.translate(str.maketrans(spelling.UPPER, spelling.LOWER)) for (t,) in odd.select("text").collect()
                for m in re.findall("[A-Za-zÀ-ÿ]{7,}", t or "")]
    assert sorted(got) == sorted(expected) and "z" * 1_100_000 in got


# ----------------------------------------------------------------------------- quality


def test_quality_on_held_out_rows(spark):
    got = {r["doc_id"]: r for r in QUERIES["op11_quality"](spark, SF01).collect()}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF01, "labels").collect()}
    test = [d for d in labels if zlib.crc32(str(d).encode()) % 5 == 0]
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    right = sum(got[d]["predicted"] == labels[d] for d in test)
    assert right >= 0.95 * len(test)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    good, bad = ([got[d]["score"] for d in test if labels[d] == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_quality_never_learns_from_held_out_labels(spark):
    docs, labels = table(spark, SF001, "documents"), table(spark, SF001, "labels")
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    # other columns, and the order of rows, change nothing
    moved = docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y")).orderBy(F.desc("doc_id")).repartition(3)
    assert by_id(quality.rate_documents(docs, labels).collect()) == by_id(quality.rate_documents(moved, flipped).collect())


def test_quality_of_odd_inputs(spark, odd):
    labels = table(spark, SF001, "labels").select("doc_id", "quality")
    extra = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 0)], "doc_id long, quality int")
    got = quality.rate_documents(odd, labels.unionAll(extra)).collect()
    assert len(got) == len(ODD) + 3 and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (0, 1, 2, 5, 6)}) == 1  # nothing to go by: the labels' shares
    none = quality.rate_documents(odd, labels.where("false")).collect()
    assert {r["score"] for r in none} == {0.5}
    assert {r["score"] for r in quality.rate_documents(odd, labels.withColumn("quality", F.lit(0))).collect()} == {0.0}
    assert {r["score"] for r in quality.rate_documents(odd, labels.withColumn("quality", F.lit(1))).collect()} == {1.0}
    assert quality.rate_documents(odd.where("false"), labels).count() == 0


def test_slices_of_long_texts_give_the_same_features(monkeypatch):
    texts = pa.array(["one two  three " * 200 + "end", None, "", "four", "x" * 500])
    whole = quality.bucket_counts(texts, 1 << 10, (3, 4))
    monkeypatch.setattr(quality, "SLICE_CHARS", 37)
    cut = quality.bucket_counts(texts, 1 << 10, (3, 4))
    assert all((x == y).all() for p, q in zip(whole, cut) for x, y in zip(p, q))
    at, bucket = quality.word_buckets(["abc", "abc", "ab"], 1 << 16, (3,))
    assert at.tolist() == [0, 4, 8, 11] and (bucket[:4] == bucket[4:8]).all()

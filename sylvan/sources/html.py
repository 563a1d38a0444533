"""H1: HTML -> interval-numbered page trees, one row per page.

A page's row holds its visible text once (``text``, UTF-8 bytes) and its
elements in document order (``els``).  An element is numbered as an interval:
its descendants are those with ``ord < other.ord < end_ord``, and they stand
next to each other in the array (``pos + 1`` up to ``end_pos``), so "inside"
is a slice.  Its visible text is the slice ``t0 .. t1`` of the page's bytes.
Nothing of an element is copied into its ancestors: a page's tree is linear in
its bytes at any nesting depth.

The document itself is ord 0, tag ``#document``.  Script and style contents
are no visible text; ``own_text`` (direct text children) keeps them.  Pages
without markup (null) have no tree.

Tree building: a stack; void elements never open; an end tag closes the
nearest open element of that name and is ignored when none is open.

``tags`` limits the emitted elements (comma list, ``*`` for all; the document is
always there) so a job only materialises those it will use; numbers stay those of the whole page.

Plain markup is read by one pattern (``_plain_tree``); a page with anything the
pattern does not cover goes to the library's parser, which gives the same tree.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from html.parser import HTMLParser
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.session import small_batches

# HTML void elements (never have an end tag).
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is raw data, not visible text.
DATA_TAGS = frozenset(["script", "style"])

ELEMENT = ("ord int, end_ord int, parent_ord int, depth int, pos int, end_pos int, tag string, classes array<string>, "
           "attrs map<string,string>, own_text string, t0 int, t1 int")
NAMES = [f.split()[0] for f in ELEMENT.split(", ")]
TREE = f"text binary, els array<struct<{', '.join(f.replace(' ', ': ', 1) for f in ELEMENT.split(', '))}>>"

#: Bytes of markup whose trees are built and handed back at a time (a longer page goes alone).
SLICE_BYTES = 1 << 18

_ATTR = r'''[ \n\t]++{}(?:="{}")?+'''
_ATTR_NAME, _ATTR_VALUE = r"[a-zA-Z][a-zA-Z0-9_:-]*+", r'''[^"&<>]*+(?:&(?:#[0-9]{1,6}|amp|lt|gt|quot);[^"&<>]*+)*+'''
_ATTRS = f"(?:{_ATTR.format(_ATTR_NAME, _ATTR_VALUE)})*+"
_ATTRIBUTE = re.compile(_ATTR.format(f"({_ATTR_NAME})", f"({_ATTR_VALUE})"))
# Elements whose content some parsers read as text; only the plainest forms are covered here.
_RAW_TAGS = "script|style|title|textarea|iframe|noembed|noframes|noscript|xmp|plaintext|svg:|math:"
#: Groups: 1 text; 2 end tag; 3-5 start tag, attributes, slash; 6-8 raw element, attributes, content.
_PLAIN = re.compile(
    rf"""([^<]++)|</([a-zA-Z][a-zA-Z0-9]*+)[ \n\t]*+>|<(?!(?i:{_RAW_TAGS})[ \n\t/>])([a-zA-Z][a-zA-Z0-9]*+)({_ATTRS})[ \n\t]*+(/?)>"""
    rf"""|<(script|style)({_ATTRS})>((?:[^<]|<(?!(?i:/script|/style|!--)))*+)</\6>"""
    rf"""|<(title)({_ATTRS})>([^<&]*+)</title>|<!--(?![->])(?:[^-]|-(?!-))*+-->|<!(?:DOCTYPE|doctype) html>""")


class _TreeBuilder(HTMLParser):
    """Elements as lists in the order of ``NAMES``; ``own_text`` is a list of parts until the page ends."""

    END_ORD, END_POS, OWN, T0, T1 = (NAMES.index(n) for n in ("end_ord", "end_pos", "own_text", "t0", "t1"))

    def __init__(self, wanted):
        super().__init__(convert_charrefs=True)
        self.wanted = wanted
        self.text: list[bytes] = []
        self.at, self.n, self.open = 0, 0, Counter()
        self.els: list[list] = []
        self.stack: list[list] = []
        self._open("#document", [], False)

    def _open(self, tag, attrs, void):
        a = {k: "" if v is None else v for k, v in attrs}
        parent = self.stack[-1][0] if self.stack else None
        kept = self.wanted is None or tag in self.wanted or parent is None
        el = [self.n, self.n + 1, parent, len(self.stack), len(self.els), len(self.els) + 1, tag,
              a.get("class", "").split(), a, [], self.at, self.at]
        self.n += 1
        if kept:
            self.els.append(el)
        if not void:
            self.stack.append(el)
            self.open[tag] += 1

    def _shut(self):
        el = self.stack.pop()
        self.open[el[6]] -= 1
        el[self.END_ORD], el[self.END_POS], el[self.T1] = self.n, len(self.els), self.at

    def handle_starttag(self, tag, attrs):
        self._open(tag, attrs, tag in VOID_TAGS)

    def handle_startendtag(self, tag, attrs):
        self._open(tag, attrs, True)

    def handle_endtag(self, tag):
        if self.open[tag]:
            while self.stack[-1][6] != tag:
                self._shut()
            self._shut()

    def parse_html_declaration(self, i):
        """A declaration the library rejects (such as ``<![foo[x]]>``) is skipped like a comment; parsing goes on."""
        try:
            return super().parse_html_declaration(i)
        except AssertionError:
            return self.parse_bogus_comment(i)

    def handle_data(self, data):
        el = self.stack[-1]
        el[self.OWN].append(data)
        if el[6] not in DATA_TAGS:
            part = data.encode("utf-8", "replace")
            self.text.append(part)
            self.at += len(part)

    def done(self) -> tuple[bytes, list[list]]:
        self.close()
        while self.stack:
            self._shut()
        for el in self.els:
            el[self.OWN] = "".join(el[self.OWN])
        return b"".join(self.text), self.els


def _plain_tree(html: str, wanted: frozenset | None) -> tuple[bytes, list[list]] | None:
    """The tree of a page of plain markup; None when the pattern does not cover the whole page."""
    end_ord, end_pos, own_text, t1 = (NAMES.index(n) for n in ("end_ord", "end_pos", "own_text", "t1"))
    root = [0, 1, None, 0, 0, 1, "#document", [], {}, [], 0, 0]
    # the open elements: number, tag, and the element if it is emitted
    text, els, stack, opened = [], [root], [(0, "#document", root)], {"#document": 1}
    at, n, covered = 0, 1, 0
    for m in _PLAIN.finditer(html):
        begin, end = m.span()
        if begin != covered:
            return None
        covered, kind = end, m.lastindex
        part = close = None
        if kind == 1:
            part = m[1]
            if "&" in part:
                part = unescape(part)
        elif kind == 2:
            close = m[2].lower()
        elif kind is not None:  # 5, or 8 and 11 for raw elements
            tag, attrs = (m[3].lower(), m[4]) if kind == 5 else (m[kind - 2], m[kind - 1])
            el = None
            if wanted is None or tag in wanted:
                a = {k.lower(): unescape(v) if "&" in v else v for k, v in _ATTRIBUTE.findall(attrs)} if attrs else {}
                here = len(els)
                el = [n, n + 1, stack[-1][0], len(stack), here, here + 1, tag,
                      a["class"].split() if "class" in a else [], a, [], at, at]
                els.append(el)
            if kind != 5 or not (m[5] or tag in VOID_TAGS):
                stack.append((n, tag, el))
                opened[tag] = opened.get(tag, 0) + 1
            n += 1
            if kind != 5:
                part, close = m[kind], tag
        if part:
            el = stack[-1][2]
            if el is not None:
                el[own_text].append(part)
            if kind != 8:
                part = part.encode("utf-8", "replace")
                text.append(part)
                at += len(part)
        if close is not None and opened.get(close):
            tag = None
            while tag != close:
                _, tag, el = stack.pop()
                opened[tag] -= 1
                if el is not None:
                    el[end_ord], el[end_pos], el[t1] = n, len(els), at
    if covered != len(html):
        return None
    for _, _, el in stack:
        if el is not None:
            el[end_ord], el[end_pos], el[t1] = n, len(els), at
    for el in els:
        el[own_text] = "".join(el[own_text])
    return b"".join(text), els


def parse_tree(html: str, tags: str | None = "*") -> tuple[bytes, list[list]]:
    """A page's visible text and its elements (lists in the order of ``NAMES``)."""
    wanted = None if tags in (None, "", "*") else frozenset(t.strip() for t in tags.split(","))
    plain = _plain_tree(html, wanted)
    if plain is not None:
        return plain
    builder = _TreeBuilder(wanted)
    builder.feed(html)
    return builder.done()


def _offsets(lists) -> pa.Array:
    n, out = 0, [0]
    for x in lists:
        n += len(x)
        out.append(n)
    return pa.array(out, pa.int32())


def _element_arrays(trees: list[list[list]]) -> pa.Array:
    """All pages' elements as one list array of structs."""
    columns = [[el[i] for els in trees for el in els] for i in range(len(NAMES))]
    strings = lambda x: pa.array(list(chain.from_iterable(x)), pa.string())
    made = []
    for name, values in zip(NAMES, columns):
        if name == "classes":
            made.append(pa.ListArray.from_arrays(_offsets(values), strings(values)))
        elif name == "attrs":
            made.append(pa.MapArray.from_arrays(_offsets(values), strings(values), strings(v.values() for v in values)))
        else:
            made.append(pa.array(values, pa.string() if name in ("tag", "own_text") else pa.int32()))
    return pa.ListArray.from_arrays(_offsets(trees), pa.StructArray.from_arrays(made, names=NAMES))


def _slices(html: pa.Array) -> list[tuple[int, int]]:
    """Runs of pages (start, length) of about SLICE_BYTES of markup, so that a task's memory does not follow its batches."""
    ends = np.cumsum(pc.binary_length(html).to_numpy(zero_copy_only=False).astype(np.int64))
    edges = [0, *(np.flatnonzero(np.diff(ends // SLICE_BYTES)) + 1).tolist(), len(ends)]
    return [(a, b - a) for a, b in zip(edges, edges[1:]) if b > a]


def html_trees(pages: DataFrame, html_col: str, key_cols: list[str], tags: str = "*") -> DataFrame:
    """Key columns, ``text`` and ``els`` of every page with markup, parsed where the pages lie (no shuffle)."""
    small_batches(pages.sparkSession)
    keys = pages.select(*key_cols)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema), TREE])

    def run(batches):
        for batch in batches:
            for i, n in _slices(batch.column(len(key_cols))):
                part = batch.slice(i, n)
                trees = [parse_tree(h, tags) for h in part.column(len(key_cols)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in range(len(key_cols))), pa.array([t for t, _ in trees], pa.binary()),
                     _element_arrays([els for _, els in trees])], names=[*key_cols, "text", "els"])

    return pages.where(F.col(html_col).isNotNull()).select(*key_cols, F.col(html_col).alias("_html")).mapInArrow(run, schema)


# --------------------------------------------------------------------------- columns over a tree

def els() -> Column:
    return F.col("els")


def text_of(e: Column) -> Column:
    """The visible text of an element (null of null)."""
    return F.substring(F.col("text"), e["t0"] + 1, e["t1"] - e["t0"]).cast("string")


def below(e: Column) -> Column:
    """The emitted descendants of an element, in document order (null of null)."""
    return F.slice(F.col("els"), e["pos"] + 2, e["end_pos"] - e["pos"] - 1)


def tagged(elements: Column, tag: str, cls: str | None = None) -> Column:
    """Those with the tag (and the class token)."""
    def want(e):
        return (e["tag"] == tag) & F.array_contains(e["classes"], cls) if cls else e["tag"] == tag
    return F.filter(elements, want)


def first(elements: Column) -> Column:
    """The first of an array (null of an empty or null one)."""
    return F.get(elements, F.lit(0))


def last(elements: Column) -> Column:
    return F.try_element_at(elements, F.lit(-1))


def element_table(trees: DataFrame, key: list[str], text: bool = False) -> DataFrame:
    """One row per element; with ``text``, each element's visible text too."""
    # outer: a tree always has the document, and a plain explode would evaluate its input once more in a filter
    if not text:
        return trees.select(*key, F.explode_outer("els").alias("_e")).select(*key, "_e.*")
    rows = F.transform(els(), lambda e: F.struct(e.alias("e"), text_of(e).alias("text")))
    return trees.select(*key, F.explode_outer(rows).alias("_r")).select(*key, "_r.e.*", "_r.text")

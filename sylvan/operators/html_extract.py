"""HTML extraction over interval-numbered page trees.

A page is one row (``sources/html.py``): "find X inside Y" is a slice of the
page's element array and a filter, "first" / "last match wins" its first or
last item, and text is a slice of the page's bytes.  Every extraction is an
expression over the row, so nothing is joined or shuffled: the pages'
placement before parsing is the only exchange, and all fields of a record come
from one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.functions import scalar as S
from sylvan.sources.html import below, els, first, html_trees, last, tagged, text_of

# Stat names recognised on detail pages.
STAT_NAMES = [
    "Crossing", "Finishing", "Heading accuracy", "Short passing", "Volleys", "Dribbling", "Curve",
    "FK Accuracy", "Long passing", "Ball control", "Acceleration", "Sprint speed", "Agility", "Reactions",
    "Balance", "Shot power", "Jumping", "Stamina", "Strength", "Long shots", "Aggression", "Interceptions",
    "Positioning", "Vision", "Penalties", "Composure", "Marking", "Standing tackle", "Sliding tackle",
]


def parse_pages(pages: DataFrame, key: list[str], html_col: str = "html", tags: str = "*",
                spread: bool = True) -> DataFrame:
    """The trees of all pages: key, ``text``, ``els``.

    Parsing is Python work, so it must run on every task slot: pages are first
    spread over the cluster's default parallelism by their key.  With
    ``spread=False`` they are parsed where they lie, for inputs of many splits.
    """
    if spread:
        pages = pages.repartition(pages.sparkSession.sparkContext.defaultParallelism, *key)
    return html_trees(pages, html_col, key, tags)


def _each(rows: DataFrame, key: list[str], items: Column) -> DataFrame:
    """One row per item of an array of structs.  (Outer, then filtered: a plain explode of an expression would
    have it evaluated once more, in a filter below it.)"""
    return rows.select(*key, F.explode_outer(items).alias("_i")).where("_i IS NOT NULL").select(*key, "_i.*")


def class_probes(trees: DataFrame, key: list[str], tag: str = "div", token: str = "pos", k: int = 5, width: int = 30) -> DataFrame:
    """Per page, the elements of ``tag`` with the class ``token`` (number, first ``k`` texts) and those
    with a class that contains it (number, first ``k`` as ``class:text``, texts cut to ``width``, the
    reference's display).  Pages without any give zeros and empty strings."""
    exact = tagged(els(), tag, token)
    like = F.filter(els(), lambda e: (e["tag"] == tag) & F.exists(e["classes"], lambda c: c.contains(token)))
    text = lambda e: F.trim(text_of(e))
    shown = lambda e: F.concat(F.array_join(e["classes"], " "), F.lit(":"), F.substring(text(e), 1, width))
    joined = lambda found, show: F.array_join(F.transform(F.slice(found, 1, k), show), " | ")
    return trees.select(*key, F.size(exact).cast("long").alias("n_exact"), joined(exact, text).alias("first_exact"),
                        F.size(like).cast("long").alias("n_like"), joined(like, shown).alias("first_like"))


def parent_of_first(trees: DataFrame, key: list[str], tag: str, codes: list[str], k: int = 20) -> DataFrame:
    """Of the first ``k`` elements of ``tag``, the first whose text is one of ``codes``: that code, and its
    parent's tag and classes.  Pages without one give no row; parents must be among the parsed tags."""
    hits = F.filter(F.transform(F.slice(tagged(els(), tag), 1, k), lambda e: F.struct(
        F.trim(text_of(e)).alias("code"), e["parent_ord"].alias("parent_ord"))), lambda h: h["code"].isin(*codes))
    out = trees.select(*key, "els", first(hits).alias("_h")).where("_h IS NOT NULL")
    parent = first(F.filter(els(), lambda e: e["ord"] == F.col("_h.parent_ord")))
    return out.select(*key, "_h.code", parent.alias("_p")).select(
        *key, "code", F.col("_p.tag").alias("parent_tag"), F.array_join("_p.classes", " ").alias("parent_class"))


# --------------------------------------------------------------------------- list pages (H2-H4)

def _list_rows() -> Column:
    """H2: the first ``table``'s first ``tbody``'s ``tr`` elements (null or empty on a bad page)."""
    return tagged(below(first(tagged(below(first(tagged(els(), "table"))), "tbody"))), "tr")


def _cells(rows: Column, min_cells: int) -> Column:
    """Rows as (tr_ord, cells): those with at least ``min_cells`` ``td`` elements."""
    with_cells = F.transform(rows, lambda r: F.struct(r["ord"].alias("tr_ord"), tagged(below(r), "td").alias("cells")))
    return F.filter(with_cells, lambda r: F.size(r["cells"]) >= min_cells)


def _link(cell: Column) -> Column:
    """The first ``a`` inside a cell: title, href, text (nulls when there is none)."""
    found = first(tagged(below(cell), "a"))
    return F.struct(found["ord"].alias("ord"), found["attrs"]["title"].alias("title"), found["attrs"]["href"].alias("href"),
                    text_of(found).alias("text"))


def table_rows(trees: DataFrame, key: list[str], min_cells: int = 8, link_cell: int = 1) -> DataFrame:
    """H2: key, tr_ord, n_cells, cells (their texts) and the link of cell ``link_cell`` of every row with at least
    ``min_cells`` cells; pages without table, tbody or rows give none."""
    return _each(trees, key, F.transform(_cells(_list_rows(), min_cells), lambda r: F.struct(
        r["tr_ord"].alias("tr_ord"), F.size(r["cells"]).alias("n_cells"), F.transform(r["cells"], text_of).alias("cells"),
        _link(F.get(r["cells"], F.lit(link_cell))).alias("link"))))


def is_bad_page() -> Column:
    """No table, no tbody in it, or no row in that tbody."""
    return F.coalesce(F.size(_list_rows()), F.lit(0)) <= 0


def player_rows(trees: DataFrame, key: list[str]) -> DataFrame:
    """H3/H4: one player record per list row that has a name link (F1-F5 applied).

    Rows whose money text does not parse are dropped (the reference skips them).
    """
    def fields(r):
        return F.struct(r["tr_ord"].alias("tr_ord"), _link(r["cells"][1]).alias("name"), _link(r["cells"][5]).alias("team"),
                        *(text_of(r["cells"][i]).alias(f"c{i}") for i in (2, 3, 4, 6, 7)))

    r = _each(trees, key, F.transform(_cells(_list_rows(), 8), fields)).where("name.ord IS NOT NULL")
    name = F.coalesce(F.nullif(F.col("name.title"), F.lit("")), S.first_line(F.col("name.text")))
    ovr = S.parse_rating(S.py_strip("c3"))
    pot = S.parse_rating(S.py_strip("c4"))
    value, wage = S.py_strip("c6"), S.py_strip("c7")
    out = r.select(
        *key, "tr_ord",
        name.alias("name"),
        S.safe_int(S.py_strip("c2")).alias("age"),
        S.safe_int(ovr).alias("overall"),
        S.safe_int(pot).alias("potential"),
        F.when(F.col("team.ord").isNotNull(), S.py_strip(F.col("team.text"))).otherwise(F.lit("Free Agent")).alias("team"),
        value.alias("value_raw"), wage.alias("wage_raw"),
        S.parse_money(value).alias("value_numeric"), S.parse_money(wage).alias("wage_numeric"),
        F.coalesce(F.col("name.href"), F.lit("")).alias("player_url"))
    return out.where(F.col("value_numeric").isNotNull() & F.col("wage_numeric").isNotNull())


# --------------------------------------------------------------------------- detail pages
# Each field (or struct of fields) of a page is a column expression; records put them side by side.

def star_fields() -> Column:
    """H5: in the first div.attribute, each p mentioning "Skill moves" (else "Weak foot")
    sets that count to its number of svg.star descendants; the last such p wins."""
    ps = F.transform(tagged(below(first(tagged(els(), "div", "attribute"))), "p"), lambda p: F.struct(
        text_of(p).alias("text"), F.size(tagged(below(p), "svg", "star")).cast("long").alias("n")))
    skill = lambda p: p["text"].contains("Skill moves")
    weak = lambda p: ~skill(p) & p["text"].contains("Weak foot")
    return F.struct(last(F.filter(ps, skill))["n"].alias("skill_moves"), last(F.filter(ps, weak))["n"].alias("weak_foot"))


def star_counts(trees: DataFrame, key: list[str]) -> DataFrame:
    """H5 per page that has either."""
    return trees.select(*key, star_fields().alias("_s")).select(*key, "_s.*").where("skill_moves IS NOT NULL OR weak_foot IS NOT NULL")


def stat_entries() -> Column:
    """H6: array of (p_ord, span_ord, stat, value): in every div.col > p, a span whose stripped text is a known
    stat name takes the first em's ``title`` (or its text when the title is empty); digits only.  In document order,
    each once."""
    names = F.array(*[F.lit(s) for s in STAT_NAMES])

    def of_p(p):
        em = first(tagged(below(p), "em"))
        raw = F.coalesce(F.nullif(em["attrs"]["title"], F.lit("")), text_of(em))
        spans = F.transform(tagged(below(p), "span"), lambda s: F.struct(
            p["ord"].alias("p_ord"), s["ord"].alias("span_ord"), S.py_strip(text_of(s)).alias("stat"), raw.alias("value")))
        return F.filter(spans, lambda h: F.array_contains(names, h["stat"]) & h["value"].rlike("^[0-9]+$"))

    cols = tagged(els(), "div", "col")
    return F.array_sort(F.array_distinct(F.flatten(F.transform(cols, lambda c: F.flatten(F.transform(
        tagged(below(c), "p"), of_p))))))


def stats(trees: DataFrame, key: list[str]) -> DataFrame:
    """H6: (key, stat, value); the last occurrence in document order wins."""
    return stats_of(trees.select(*key, stat_entries().alias("_h")), key)


def stats_of(hits: DataFrame, key: list[str]) -> DataFrame:
    winners = F.filter("_h", lambda h, i: ~F.exists(F.slice("_h", i + 2, F.size("_h")), lambda later: later["stat"] == h["stat"]))
    return _each(hits, key, F.transform(winners, lambda h: F.struct(
        S.safe_name(h["stat"]).alias("stat"), h["value"].cast("int").alias("value"))))


def stat_map(hits: Column) -> Column:
    """Stat name -> value of ``stat_entries``, the last of a name; null without any."""
    names = F.array_distinct(F.transform(hits, lambda h: h["stat"]))
    value = lambda n: last(F.filter(hits, lambda h: h["stat"] == n))["value"].cast("int")
    return F.when(F.size(hits) > 0, F.map_from_arrays(F.transform(names, S.safe_name), F.transform(names, value)))


def _distinct_joined(values: Column, k: int = 5, sep: str = ", ") -> Column:
    """The first ``k`` distinct values in first-seen order, joined (F13); null without any."""
    return F.nullif(F.array_join(F.slice(F.array_distinct(values), 1, k), sep), F.lit(""))


def positions_div_field() -> Column:
    """First 10 div.pos; stripped text of 1-4 characters; de-dup; first 5; ', '-joined."""
    texts = F.transform(F.slice(tagged(els(), "div", "pos"), 1, 10), lambda e: S.py_strip(text_of(e)))
    return _distinct_joined(F.filter(texts, lambda t: (F.length(t) >= 1) & (F.length(t) <= 4)))


def positions_div(trees: DataFrame, key: list[str]) -> DataFrame:
    return trees.select(*key, positions_div_field().alias("positions")).where("positions IS NOT NULL")


def positions_span_field() -> Column:
    """Spans having class token ``pos``; stripped text passing F16; de-dup; stop at 5."""
    texts = F.transform(tagged(els(), "span", "pos"), lambda e: S.py_strip(text_of(e)))
    return _distinct_joined(F.filter(texts, S.is_position_code))


def positions_span(trees: DataFrame, key: list[str]) -> DataFrame:
    return trees.select(*key, positions_span_field().alias("position_list")).where("position_list IS NOT NULL")


# fixed value: the three rates as they are looked for in a text
_RATE = r"(?i)(Low|Medium|High)"


def work_rate_field() -> Column:
    """H8/G7 (+F11 fallback): over li/div/p in document order, an element whose text
    mentions the attacking (defensive) work rate sets that side to the first
    Low/Medium/High in its whole text; the last such element wins.  With a side
    missing, the first 'X / Y' pair in the page text is used."""
    candidates = F.filter(els(), lambda e: e["tag"].isin("li", "div", "p"))

    def side(short, long):
        # what is looked for is first tested on the whole page: most elements need no text then
        page = F.col("text").cast("string")
        hits = F.filter(F.transform(candidates, text_of), lambda t: (t.contains(short) | t.contains(long)) & t.rlike(_RATE))
        found = F.initcap(F.lower(F.regexp_extract(last(hits), _RATE, 1)))
        return F.when(page.contains(short) | page.contains(long), found)

    att, dfn = side("Att. Work Rate", "Attacking Work Rate"), side("Def. Work Rate", "Defensive Work Rate")
    return F.coalesce(F.concat(att, F.lit("/"), dfn), S.work_rate_pair(F.col("text").cast("string")))


def work_rate(trees: DataFrame, key: list[str]) -> DataFrame:
    return trees.select(*key, work_rate_field().alias("work_rate"))


def json_ld_fields() -> Column:
    """F8 on the first script[type=application/ld+json]: height/weight digits, nationality."""
    own = first(F.filter(els(), lambda e: (e["tag"] == "script") & (e["attrs"]["type"] == "application/ld+json")))["own_text"]
    return F.struct(S.json_first_int(own, "$.height").cast("int").alias("height_cm"),
                    S.json_first_int(own, "$.weight").cast("int").alias("weight_kg"),
                    F.get_json_object(own, "$.nationality").alias("nationality"))


def page_text_fields(trees: DataFrame, key: list[str]) -> DataFrame:
    """F9/F10 on the page text: preferred foot and the generic work-rate pattern."""
    return trees.select(*key, *_page_text())


def _page_text() -> list[Column]:
    text = F.col("text").cast("string")
    # fixed value: the text pattern of the preferred foot
    return [S.regex_group(text, r"Preferred foot\s+(Left|Right)").alias("preferred_foot"),
            S.work_rate_text(text).alias("work_rate_page")]


def player_details(trees: DataFrame, key: list[str]) -> DataFrame:
    """One detail record per page, all fields in one pass."""
    return trees.select(*key, json_ld_fields().alias("_j"), *_page_text(), star_fields().alias("_s"),
                        positions_div_field().alias("positions"), stat_entries().alias("_h")).select(
        *key, "_j.*", "preferred_foot", "work_rate_page", "_s.*", "positions", stat_map(F.col("_h")).alias("stats"))


def enrich_record(trees: DataFrame, key: list[str]) -> DataFrame:
    """Positioning (H7b) and work rate (H8) per page, nulls when absent."""
    return trees.select(*key, positions_span_field().alias("position_list"), work_rate_field().alias("work_rate"))


def tag_inventory(trees: DataFrame, key: list[str]) -> DataFrame:
    """Element count per page and tag."""
    tags = trees.select(*key, F.explode_outer(F.transform(els(), lambda e: e["tag"])).alias("tag"))
    return tags.where("tag <> '#document'").groupBy(*key, "tag").agg(F.count(F.lit(1)).alias("n"))


def table_inventory(trees: DataFrame, key: list[str]) -> DataFrame:
    """Per table: class, row count, cells in its first row, first five cell texts (50 chars)."""
    with_rows = F.transform(tagged(els(), "table"), lambda t: F.struct(t.alias("t"), tagged(below(t), "tr").alias("trs")))

    first_cells = F.transform(with_rows, lambda r: F.struct(r["t"].alias("t"), F.size(r["trs"]).alias("n"), F.filter(
        below(first(r["trs"])), lambda e: e["tag"].isin("td", "th")).alias("cells")))
    some = lambda n: F.when(n > 0, n).cast("long")
    texts = lambda cells: F.transform(F.slice(cells, 1, 5), lambda e: S.prefix(S.py_strip(text_of(e)), 50))
    return _each(trees, key, F.transform(first_cells, lambda r: F.struct(
        r["t"]["ord"].alias("t_ord"), F.array_join(r["t"]["classes"], " ").alias("table_class"), some(r["n"]).alias("n_rows"),
        some(F.size(r["cells"])).alias("n_cols"), F.when(F.size(r["cells"]) > 0, texts(r["cells"])).alias("first_cells"))))

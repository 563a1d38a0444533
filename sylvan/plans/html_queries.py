"""Registered queries: page trees and extractions.

The driver's ``pages`` carry no tables, stars or JSON-LD, so list, detail and
enrichment pages are *rendered inside the query* from ``customer`` / ``part``
rows with ``concat``; the oracle is the relational value they were rendered
from (a round trip through HTML).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sylvan.functions.scalar import POSITION_CODES
from sylvan.operators import html_extract as H
from sylvan.plans.registry import register
from sylvan.session import cut_lineage
from sylvan.sources.html import element_table
from sylvan.sources.tables import table

ROWS_PER_PAGE = 60
_CODES = POSITION_CODES  # 13 codes
_RATES = ["Low", "Medium", "High"]

# --------------------------------------------------------------------------- list pages


def list_pages(spark, sf):
    """One list page per 60 customers; a page holding a customer with balance < -990
    is rendered without ``tbody`` (a bad page)."""
    c = table(spark, sf, "customer")
    k = F.col("c_custkey").cast("string")
    team = F.when(F.col("c_acctbal") < 0, F.lit("Free")).otherwise(
        F.concat(F.lit('<a href="/t/x">'), F.col("c_mktsegment"), F.lit("</a>")))
    ovr = F.lit(50) + F.col("c_custkey") % 40
    row = F.concat(
        F.lit('<tr><td><img src="/f/'), k, F.lit('.png"></td><td><a href="/p/'), k, F.lit('" title="'),
        F.regexp_replace("c_name", "#", "&#35;"), F.lit('">'), F.col("c_name"), F.lit("<br>ST</a></td><td> "),
        (F.col("c_nationkey") + 17).cast("string"), F.lit(" </td><td>"), ovr.cast("string"), F.lit("+2</td><td>"),
        (ovr + 5).cast("string"), F.lit("-1</td><td>"), team, F.lit("</td><td>€"),
        (F.col("c_custkey") % 100).cast("string"), F.lit(".5M</td><td>€"), (F.col("c_nationkey") * 3).cast("string"),
        F.lit("K</td></tr>"))
    extra = ("<tr><td>a</td><td>b</td><td>c</td><td>d</td><td>e</td><td>f</td><td>g</td></tr>"
             "<tr><td></td><td>No link</td><td>1</td><td>2</td><td>3</td><td>4</td><td>€1M</td><td>€1K</td></tr>")
    pages = c.groupBy((F.col("c_custkey") / ROWS_PER_PAGE).cast("long").alias("page_no")).agg(
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", row.alias("r")))),
                                    lambda x: x["r"])).alias("rows"),
        F.max(F.col("c_acctbal") < -990).alias("bad"))
    tb_open = F.when(F.col("bad"), "").otherwise("<tbody>")
    tb_close = F.when(F.col("bad"), "").otherwise("</tbody>")
    html = F.concat(F.lit("<!DOCTYPE html><html><head><title>Players "), F.col("page_no").cast("string"),
                    F.lit('</title></head><body><div class="x"><table class="table"><thead><tr><th>Name</th></tr>'
                          "</thead>"), tb_open, F.col("rows"), F.lit(extra), tb_close,
                    F.lit("</table></div></body></html>"))
    return pages.select("page_no", html.alias("html"))


_BAD_PAGES_SQL = f"SELECT DISTINCT CAST(c_custkey // {ROWS_PER_PAGE} AS BIGINT) FROM customer WHERE c_acctbal < -990"


def _list_els(spark, sf, tags="table,tbody,tr,td,th,a"):
    return H.parse_pages(list_pages(spark, sf), ["page_no"], tags=tags)


@register("html_table_rows",
          f"SELECT CAST(c_custkey // {ROWS_PER_PAGE} AS BIGINT) AS page_no, '/p/' || c_custkey AS player_url, "
          f"8 AS n_cells FROM customer WHERE c_custkey // {ROWS_PER_PAGE} NOT IN ({_BAD_PAGES_SQL})")
def html_table_rows(spark, sf):
    rows = H.table_rows(_list_els(spark, sf), ["page_no"])
    return rows.where("link.ord IS NOT NULL").select("page_no", F.col("link.href").alias("player_url"), "n_cells")


@register("html_links",
          f"SELECT '/p/' || c_custkey AS player_url, c_name AS name FROM customer "
          f"WHERE c_custkey // {ROWS_PER_PAGE} NOT IN ({_BAD_PAGES_SQL})")
def html_links(spark, sf):
    return H.player_rows(_list_els(spark, sf), ["page_no"]).select("player_url", "name")


_PLAYER_SQL = (
    "SELECT c_name AS name, c_nationkey + 17 AS age, CAST(50 + c_custkey % 40 AS INTEGER) AS overall, "
    "CAST(55 + c_custkey % 40 AS INTEGER) AS potential, "
    "CASE WHEN c_acctbal < 0 THEN 'Free Agent' ELSE c_mktsegment END AS team, "
    "'€' || (c_custkey % 100) || '.5M' AS value_raw, '€' || (c_nationkey * 3) || 'K' AS wage_raw, "
    "CAST(((c_custkey % 100) + 0.5) * 1000000 AS DOUBLE) AS value_numeric, CAST(c_nationkey * 3 * 1000 AS DOUBLE) AS wage_numeric, "
    "'/p/' || c_custkey AS player_url FROM customer "
    f"WHERE c_custkey // {ROWS_PER_PAGE} NOT IN ({_BAD_PAGES_SQL})"
)


@register("player_rows", _PLAYER_SQL)
def player_rows(spark, sf):
    r = H.player_rows(_list_els(spark, sf), ["page_no"])
    return r.select("name", r.age.cast("int").alias("age"), r.overall.cast("int").alias("overall"),
                    r.potential.cast("int").alias("potential"), "team", "value_raw", "wage_raw",
                    "value_numeric", "wage_numeric", "player_url")


@register("prefix_until_bad",
          f"SELECT CAST(c_custkey // {ROWS_PER_PAGE} AS BIGINT) AS page_no, '/p/' || c_custkey AS player_url "
          f"FROM customer WHERE c_custkey // {ROWS_PER_PAGE} < coalesce(({_BAD_PAGES_SQL.replace('DISTINCT', 'min(').replace(' FROM', ') FROM')}), 9223372036854775807)")
def prefix_until_bad(spark, sf):
    """Rows of the pages before the first bad one; pages are rendered and parsed once."""
    trees = cut_lineage(_list_els(spark, sf))
    first_bad = trees.where(H.is_bad_page()).agg(F.min("page_no")).scalar()
    before = trees.where(F.coalesce(F.col("page_no") < first_bad, first_bad.isNull()))
    return H.player_rows(before, ["page_no"]).select("page_no", "player_url")


# Every list page has one table (element 6 in document order) whose rows are the
# page's customers, the two malformed rows and the header row; the first row is
# the header with the single cell "Name".
@register("html_table_inventory",
          f"SELECT CAST(c_custkey // {ROWS_PER_PAGE} AS BIGINT) AS page_no, 6 AS t_ord, 'table' AS table_class, "
          f"count(*) + 3 AS n_rows, CAST(1 AS BIGINT) AS n_cols, 'Name' AS first_cells FROM customer GROUP BY 1")
def html_table_inventory(spark, sf):
    inv = H.table_inventory(_list_els(spark, sf, "table,tr,td,th"), ["page_no"])
    return inv.withColumn("first_cells", F.array_join("first_cells", "|"))


# --------------------------------------------------------------------------- detail pages


def _code(idx_col):
    return F.element_at(F.array(*[F.lit(c) for c in _CODES]), ((idx_col % len(_CODES)) + 1).cast("int"))


def detail_pages(spark, sf):
    """One detail page per part row (JSON-LD, stars, stats, position divs, work rates)."""
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    s = F.col("p_size")
    json_ok = F.concat(F.lit('{"height": "'), (F.lit(170) + s % 30).cast("string"), F.lit('cm", "weight": "'),
                       (F.lit(60) + s).cast("string"), F.lit('kg", "nationality": "'), F.col("p_brand"), F.lit('"}'))
    json = F.when(k % 7 == 0, F.lit("{height: 1")).otherwise(json_ok)
    skill, weak = s % 5 + 1, k % 5 + 1
    stars = lambda n: F.repeat(F.lit('<svg class="star"></svg>'), n)
    foot = F.when(k % 2 == 0, "Left").otherwise("Right")
    divs = F.concat_ws("", F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: F.concat(
        F.lit('<div class="pos"> '),
        F.when(i == 2, F.lit("WIDE5")).when(i == 4, F.lit("")).otherwise(_code(k + i * i)),
        F.lit(" </div>"))))
    att = F.element_at(F.array(*[F.lit(r) for r in _RATES]), (k % 3 + 1).cast("int"))
    dfn = F.element_at(F.array(*[F.lit(r) for r in _RATES]), ((k / 3).cast("long") % 3 + 1).cast("int"))
    lis = F.concat(F.lit("<li>Att. Work Rate "), att, F.lit("</li>"),
                   F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("<li>Def. Work Rate "), dfn, F.lit("</li>"))))
    lis = F.when(k % 4 == 0, F.concat(F.lit('<div class="wr">'), lis, F.lit("</div>"))).otherwise(lis)
    pair = F.concat(F.lit("<p>Rates: "), F.element_at(F.array(F.lit("low"), F.lit("MEDIUM"), F.lit("High")),
                                                      (k % 3 + 1).cast("int")),
                    F.lit(" / "), F.element_at(F.array(F.lit("High"), F.lit("low"), F.lit("medium")),
                                              (k % 3 + 1).cast("int")), F.lit("</p>"))
    html = F.concat(
        F.lit('<html><head><script type="application/ld+json">'), json, F.lit("</script>"),
        F.lit('<script>var s = "<p>Skill moves</p>";</script></head><body><div class="page">'),
        F.lit("<p>Preferred foot "), foot, F.lit("</p>"),
        F.lit('<div class="attribute"><p>Skill moves '), stars(skill), F.lit("</p><p>Weak foot "), stars(weak),
        F.lit('</p></div><div class="attribute"><p>Skill moves <svg class="star"/></p></div>'),
        F.lit('<div class="col"><p><em title="'), (s + 40).cast("string"), F.lit('">'), (s + 40).cast("string"),
        F.lit('</em> <span>Agility</span></p><p><em>'), (k % 50 + 30).cast("string"),
        F.lit('</em><span> FK Accuracy </span></p><p><em title="n/a">7</em><span>Vision</span></p>'
              '<p><em title="9">9</em><span>Unknown stat</span></p></div>'),
        F.lit('<div class="col"><p><em title="'), (s + 41).cast("string"), F.lit('">x</em><span>Agility</span></p></div>'),
        divs, F.lit("<ul>"), lis, F.lit("</ul>"), pair, F.lit("<!-- Work Rate: High / High --></div></body></html>"))
    return p.select("p_partkey", html.alias("html"))


DETAIL_TAGS = "script,div,p,span,em,svg,li"


def _detail_els(spark, sf, tags=DETAIL_TAGS):
    """The detail pages' trees, with the elements that the extraction looks at."""
    return H.parse_pages(detail_pages(spark, sf), ["p_partkey"], tags=tags)


_CODES_SQL = "[" + ", ".join(f"'{c}'" for c in _CODES) + "]"


@register("html_star_count",
          "SELECT p_partkey, CAST(p_size % 5 + 1 AS BIGINT) AS skill_moves, CAST(p_partkey % 5 + 1 AS BIGINT) AS weak_foot "
          "FROM part")
def html_star_count(spark, sf):
    return H.star_counts(_detail_els(spark, sf, "div,p,svg"), ["p_partkey"])


@register("html_stats",
          "SELECT p_partkey, 'Agility' AS stat, p_size + 41 AS value FROM part UNION ALL "
          "SELECT p_partkey, 'FK_Accuracy', CAST(p_partkey % 50 + 30 AS INTEGER) FROM part")
def html_stats(spark, sf):
    return H.stats(_detail_els(spark, sf, "div,p,span,em"), ["p_partkey"])


_DIV_POS_SQL = (
    "SELECT p_partkey, string_agg(t, ', ' ORDER BY first_i) AS positions FROM ("
    "SELECT p_partkey, t, first_i, row_number() OVER (PARTITION BY p_partkey ORDER BY first_i) AS r FROM ("
    "SELECT p_partkey, t, min(i) AS first_i FROM ("
    f"SELECT p_partkey, i, CASE WHEN i = 2 THEN 'WIDE5' WHEN i = 4 THEN '' ELSE {_CODES_SQL}[((p_partkey + i * i) % 13) + 1] END AS t "
    "FROM part, range(0, 10) r(i)) WHERE length(t) BETWEEN 1 AND 4 GROUP BY p_partkey, t)) WHERE r <= 5 GROUP BY p_partkey"
)


@register("html_positions_div", _DIV_POS_SQL)
def html_positions_div(spark, sf):
    return H.positions_div(_detail_els(spark, sf, "div"), ["p_partkey"])


_RATE_SQL = "['Low', 'Medium', 'High']"
_WORK_RATE_SQL = (
    f"CASE WHEN p_partkey % 5 = 0 THEN "
    f"['Low', 'Medium', 'High'][p_partkey % 3 + 1] || '/' || ['High', 'Low', 'Medium'][p_partkey % 3 + 1] "
    f"ELSE {_RATE_SQL}[p_partkey % 3 + 1] || '/' || {_RATE_SQL}[(p_partkey // 3) % 3 + 1] END"
)


@register("html_work_rate", f"SELECT p_partkey, {_WORK_RATE_SQL} AS work_rate FROM part")
def html_work_rate(spark, sf):
    return H.work_rate(_detail_els(spark, sf, "li,div,p"), ["p_partkey"])


@register("player_details",
          "SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE 170 + p_size % 30 END AS height_cm, "
          "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE 60 + p_size END AS weight_kg, "
          "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END AS nationality, "
          "CASE WHEN p_partkey % 2 = 0 THEN 'Left' ELSE 'Right' END AS preferred_foot, "
          "CAST(p_size % 5 + 1 AS BIGINT) AS skill_moves, CAST(p_partkey % 5 + 1 AS BIGINT) AS weak_foot, "
          "d.positions, p_size + 41 AS agility, CAST(p_partkey % 50 + 30 AS INTEGER) AS fk_accuracy "
          f"FROM part JOIN ({_DIV_POS_SQL}) d USING (p_partkey)")
def player_details(spark, sf):
    d = H.player_details(_detail_els(spark, sf), ["p_partkey"])
    return d.select("p_partkey", "height_cm", "weight_kg", "nationality", "preferred_foot", "skill_moves",
                    "weak_foot", "positions", F.col("stats")["Agility"].alias("agility"),
                    F.col("stats")["FK_Accuracy"].alias("fk_accuracy"))


# F10 on detail pages: after the first "Work Rate" the lazy match reaches the
# "Rates: x / y" paragraph (the list items carry no slash), so the raw words x/y.
@register("regex_work_rate_page",
          "SELECT p_partkey, ['low', 'MEDIUM', 'High'][p_partkey % 3 + 1] || '/' || "
          "['High', 'low', 'medium'][p_partkey % 3 + 1] AS work_rate_page FROM part")
def regex_work_rate_page(spark, sf):
    return H.page_text_fields(_detail_els(spark, sf, "#document"), ["p_partkey"]).select("p_partkey", "work_rate_page")


# --------------------------------------------------------------------------- enrichment pages


def enrich_pages(spark, sf):
    """One enrichment page per customer: position spans and work-rate list items."""
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    spans = F.concat_ws("", F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.concat(
        F.lit('<a href="#"><span class="pos pos'), i.cast("string"), F.lit('"> '),
        F.when(i == 1, F.lower(_code(k * 7 + i * i))).when(i == 3, F.lit("GOAL")).otherwise(_code(k * 7 + i * i)),
        F.lit(" </span></a>"))))
    noise = F.lit('<span class="posx">ZZ</span><span class="pos">12</span>')
    att = F.element_at(F.array(*[F.lit(r) for r in _RATES]), (k % 3 + 1).cast("int"))
    dfn = F.element_at(F.array(*[F.lit(r) for r in _RATES]), (k % 2 + 1).cast("int"))
    lis = F.concat(F.lit("<ul><li>Attacking Work Rate "), F.lower(att), F.lit("</li><li>Defensive Work Rate "),
                   dfn, F.lit("</li></ul>"))
    html = F.concat(F.lit("<html><body><div>"), noise, spans, lis, F.lit("</div></body></html>"))
    return c.select("c_custkey", html.alias("html"))


def _enrich_els(spark, sf):
    return H.parse_pages(enrich_pages(spark, sf), ["c_custkey"], tags="span,li,div,p,a")


_SPAN_POS_SQL = (
    "SELECT c_custkey, string_agg(t, ', ' ORDER BY first_i) AS position_list FROM ("
    "SELECT c_custkey, t, first_i, row_number() OVER (PARTITION BY c_custkey ORDER BY first_i) AS r FROM ("
    "SELECT c_custkey, t, min(i) AS first_i FROM ("
    f"SELECT c_custkey, i, CASE WHEN i = 1 THEN lower({_CODES_SQL}[((c_custkey * 7 + i * i) % 13) + 1]) "
    f"WHEN i = 3 THEN 'GOAL' ELSE {_CODES_SQL}[((c_custkey * 7 + i * i) % 13) + 1] END AS t "
    "FROM customer, range(0, 10) r(i)) WHERE length(t) BETWEEN 2 AND 3 AND upper(t) = t AND lower(t) <> t "
    "GROUP BY c_custkey, t)) WHERE r <= 5 GROUP BY c_custkey"
)


@register("html_positions_span", _SPAN_POS_SQL)
def html_positions_span(spark, sf):
    return H.positions_span(_enrich_els(spark, sf), ["c_custkey"])


ENRICH_RECORD_SQL = (
    f"SELECT c.c_custkey, s.position_list, {_RATE_SQL}[c.c_custkey % 3 + 1] || '/' || "
    f"{_RATE_SQL}[c.c_custkey % 2 + 1] AS work_rate FROM customer c LEFT JOIN ({_SPAN_POS_SQL}) s "
    f"ON c.c_custkey = s.c_custkey")


@register("enrich_record", ENRICH_RECORD_SQL)
def enrich_record(spark, sf):
    return H.enrich_record(_enrich_els(spark, sf), ["c_custkey"])


# Enrichment pages: the code spans sit inside plain <a href="#"> links, so the
# parent of the first span carrying one of the six codes is an 'a' without class.
# The six codes.
_SIX_CODES = ["ST", "CF", "LW", "RW", "CAM", "CM"]
_SIX = "('" + "', '".join(_SIX_CODES) + "')"


@register("html_parent_lookup",
          "SELECT c_custkey, first(t ORDER BY i) AS code, 'a' AS parent_tag, '' AS parent_class FROM ("
          f"SELECT c_custkey, i, CASE WHEN i = 1 THEN lower({_CODES_SQL}[((c_custkey * 7 + i * i) % 13) + 1]) "
          f"WHEN i = 3 THEN 'GOAL' ELSE {_CODES_SQL}[((c_custkey * 7 + i * i) % 13) + 1] END AS t "
          f"FROM customer, range(0, 10) r(i)) WHERE t IN {_SIX} GROUP BY c_custkey")
def html_parent_lookup(spark, sf):
    """First span (of the first 20) whose text is one of six codes -> its parent's tag and class."""
    return H.parent_of_first(H.parse_pages(enrich_pages(spark, sf), ["c_custkey"]), ["c_custkey"], "span", _SIX_CODES)


_DIV_CODE_SQL = f"{_CODES_SQL}[((p_partkey + {{i}} * {{i}}) % 13) + 1]"
_SPAN_CODE_SQL = f"{_CODES_SQL}[((c_custkey * 7 + {{i}} * {{i}}) % 13) + 1]"
_c0, _c1, _c3 = (_DIV_CODE_SQL.format(i=i) for i in (0, 1, 3))
_s0, _s1, _s2 = (_SPAN_CODE_SQL.format(i=i) for i in (0, 1, 2))


@register("html_class_probe_div",
          f"SELECT p_partkey, 12::BIGINT AS n_exact, {_c0} || ' | ' || {_c1} || ' | WIDE5 | ' || {_c3} || ' | ' AS first_exact, "
          f"12::BIGINT AS n_like, 'pos:' || {_c0} || ' | pos:' || {_c1} || ' | pos:WIDE5 | pos:' || {_c3} || ' | pos:' AS first_like "
          "FROM part")
def html_class_probe_div(spark, sf):
    """Div.pos and divs with 'pos' in a class, per detail page."""
    return H.class_probes(H.parse_pages(detail_pages(spark, sf), ["p_partkey"], tags="div"), ["p_partkey"])


@register("html_class_probe_span",
          f"SELECT c_custkey, 11::BIGINT AS n_exact, '12 | ' || {_s0} || ' | ' || lower({_s1}) || ' | ' || {_s2} || ' | GOAL' "
          f"AS first_exact, 12::BIGINT AS n_like, 'posx:ZZ | pos:12 | pos pos0:' || {_s0} || ' | pos pos1:' || lower({_s1}) "
          f"|| ' | pos pos2:' || {_s2} AS first_like FROM customer")
def html_class_probe_span(spark, sf):
    """H10 on the enrichment pages' spans, whose classes hold the token, a longer one, or both."""
    return H.class_probes(H.parse_pages(enrich_pages(spark, sf), ["c_custkey"], tags="span"), ["c_custkey"], tag="span")


# --------------------------------------------------------------------------- driver pages


def _driver_els(spark, sf):
    return H.parse_pages(table(spark, sf, "pages").select("page_id", "html"), ["page_id"])


@register("html_elements")
def html_elements_q(spark, sf):
    return element_table(_driver_els(spark, sf), ["page_id"]).select("page_id", "ord", "parent_ord", "depth", "tag")


# The character references that occur in the driver's pages, decoded
# by the oracle (the parser decodes every reference itself).
_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"),
             ("&middot;", "·"), ("&amp;", "&")]


def _visible_text_sql():
    t = ("regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), "
         "'(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g'), '<[^>]*>', '', 'g')")
    for ent, ch in _ENTITIES:
        t = f"replace({t}, '{ent}', '{ch}')"
    return t


@register("html_text",
          f"SELECT page_id, CAST(length(t) AS BIGINT) AS n_chars, t AS text FROM "
          f"(SELECT page_id, {_visible_text_sql()} AS t FROM pages)")
def html_text(spark, sf):
    """H9: the whole visible text of each page (script, style and comments excluded)."""
    d = _driver_els(spark, sf).select("page_id", F.col("text").cast("string").alias("text"))
    return d.select("page_id", F.length("text").cast("bigint").alias("n_chars"), "text")


_STRIP = ("regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), "
          "'(?is)<script[^>]*>.*?</script>', '<script>', 'g'), '(?is)<style[^>]*>.*?</style>', '<style>', 'g')")


@register("html_inventory",
          f"SELECT page_id, tag, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all({_STRIP}, "
          f"'<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS t FROM pages) x, LATERAL (SELECT lower(t) AS tag) GROUP BY 1, 2")
def html_inventory(spark, sf):
    return H.tag_inventory(_driver_els(spark, sf), ["page_id"])


@register("html_tag_sequence",
          f"SELECT page_id, CAST(ord AS INTEGER) AS ord, lower(tag) AS tag FROM (SELECT page_id, generate_subscripts(t, 1) AS ord, "
          f"unnest(t) AS tag FROM (SELECT page_id, regexp_extract_all({_STRIP}, '<([a-zA-Z][a-zA-Z0-9]*)', 1) AS t "
          f"FROM pages))")
def html_tag_sequence(spark, sf):
    """H1 check on real pages: every element's tag in document order (ord 1, 2, ...)."""
    return element_table(_driver_els(spark, sf), ["page_id"]).where(F.col("ord") > 0).select("page_id", "ord", "tag")


@register("page_range",
          "SELECT o_orderkey, o_orderkey // 60 AS page_no FROM orders WHERE o_orderkey // 60 BETWEEN 3 AND 7")
def page_range(spark, sf):
    """Pages start..start+n-1 of 60 rows each, as a key-range filter (pushed to the scan)."""
    start, n = 3, 5
    o = table(spark, sf, "orders").select("o_orderkey")
    o = o.where((F.col("o_orderkey") >= start * ROWS_PER_PAGE) & (F.col("o_orderkey") < (start + n) * ROWS_PER_PAGE))
    return o.select("o_orderkey", (F.col("o_orderkey") / ROWS_PER_PAGE).cast("long").alias("page_no"))

"""Page trees: the parser (pure Python part), intervals against ancestor lists, and extraction in Spark."""

import random

import pyarrow as pa

from sylvan.operators import html_extract as H
from sylvan.sources import html as source
from sylvan.sources.html import NAMES, element_table, parse_tree


def parsed(html, tags="*"):
    """Elements as dicts, with their visible text."""
    text, els = parse_tree(html, tags)
    return [{**dict(zip(NAMES, e)), "text": text[e[-2]:e[-1]].decode()} for e in els]


def by_tag(rows, tag):
    return [r for r in rows if r["tag"] == tag]


def test_tree_building_rules():
    html = '<div class="a b"><p>x<br>y</p></span><img src=i><p>z &amp; é</p></div><script>var t="</p>";</script>'
    rows = parsed(html)
    assert rows[0]["tag"] == "#document" and rows[0]["text"] == "xyz & é"  # script text excluded, entities decoded
    div, = by_tag(rows, "div")
    assert div["classes"] == ["a", "b"] and div["text"] == "xyz & é"
    ps = by_tag(rows, "p")
    assert [p["text"] for p in ps] == ["xy", "z & é"] and [p["own_text"] for p in ps] == ["xy", "z & é"]
    assert by_tag(rows, "br")[0]["parent_ord"] == ps[0]["ord"]  # void element child of p
    assert by_tag(rows, "img")[0]["parent_ord"] == div["ord"]  # stray </span> ignored, img back in div
    assert by_tag(rows, "script")[0]["own_text"] == 'var t="</p>";' and by_tag(rows, "script")[0]["text"] == ""


def test_intervals_equal_the_parents_chain():
    rng = random.Random(5)
    for _ in range(200):
        html = "".join(rng.choice(["<a>", "</a>", "<b>", "</b>", "<i>", "</i>", "<br>", "x", "é", "<p/>"]) for _ in range(60))
        rows = parsed(html)
        parent = {r["ord"]: r["parent_ord"] for r in rows}

        def ancestors(o):
            while parent[o] is not None:
                o = parent[o]
                yield o

        for r in rows:
            inside = [x["ord"] for x in rows if r["ord"] in ancestors(x["ord"])]
            assert inside == list(range(r["ord"] + 1, r["end_ord"])) == [x["ord"] for x in rows[r["pos"] + 1:r["end_pos"]]]
        wanted = parsed(html, "b,i")
        assert [r["ord"] for r in wanted] == [r["ord"] for r in rows if r["tag"] in ("#document", "b", "i")]
        assert [(r["ord"], r["end_ord"], r["text"], r["depth"]) for r in wanted] == [
            (r["ord"], r["end_ord"], r["text"], r["depth"]) for r in rows if r["tag"] in ("#document", "b", "i")]
        for r in wanted:
            assert [x["ord"] for x in wanted[r["pos"] + 1:r["end_pos"]]] == [
                x["ord"] for x in wanted if r["ord"] < x["ord"] < r["end_ord"]]


def test_tree_is_linear_in_the_page_at_any_depth():
    n = 60_000
    html = "<div>x" * n + "</p>" * n  # stray end tags are ignored at once
    text, els = parse_tree(html)
    assert len(text) == n and len(els) == n + 1 and els[-1][3] == n
    assert sum(len(e[NAMES.index("own_text")]) for e in els) == n  # no text is copied into ancestors
    assert els[1][NAMES.index("end_ord")] == n + 1


PARTS = ["<p>", "</p>", '<P class="a b">', "<br/>", "</div >", "<div id='x'>", "text", "a & b", "&amp;", "&notit;", "<title>T</title>", "<title>",
         '<script>var a="<p>x</p>";</script>', "<script>", "</script>", "<SCRIPT>a</SCRIPT>", "<style>b<c</style>", "<!-- c -->", "<!--", "-->",
         "<!DOCTYPE html>", "<!x>", '<a href="x&amp;y" title="&#35;1">', "<a href=x>", "</a>", "<", ">", '"', "\n", "é€", "<li hidden class=\"z\" class=\"w\">",
         "<textarea><b></textarea>", "\0", '<p\tq="1"\n>', '<p a="1"b="2">', "<![CDATA[x]]>", "<?pi?>", "<plaintext>"]


def test_plain_pages_give_the_library_parsers_tree():
    rng, plain = random.Random(1), 0
    for _ in range(20_000):
        html = "".join(rng.choice(PARTS) for _ in range(rng.randrange(9)))
        wanted = rng.choice([None, frozenset(["p", "a"]), frozenset(["#document"])])
        found, library = source._plain_tree(html, wanted), source._TreeBuilder(wanted)
        library.feed(html)
        assert found is None or found == library.done(), html
        plain += found is not None
    assert plain > 2_000 and source._plain_tree(PAGE, None) is not None


def test_trees_are_built_for_a_bounded_share_of_a_batch():
    page = "<p>" + "x" * 9_997
    runs = source._slices(pa.array([page] * 500 + ["y" * 10**6, ""] + [page] * 20))
    assert [a for a, _ in runs] == [0, *(a + n for a, n in runs[:-1])] and sum(n for _, n in runs) == 522
    assert all(n <= source.SLICE_BYTES // 10_000 + 1 for _, n in runs)
    assert source._slices(pa.array([], pa.string())) == []


PAGE = ('<html><head><script type="application/ld+json">{"height": "181cm", "nationality": "X"}</script></head>'
        '<body><div class="attribute"><p>Skill moves <svg class="star"></svg><svg class="star"/></p>'
        '<p>Weak foot <svg class="star"></svg></p></div>'
        '<div class="col"><p><em title="77">77</em><span>Agility</span></p>'
        '<div class="col"><p><em>60</em><span>Vision</span></p></div><p><em>61</em><span> Vision </span></p></div>'
        '<div class="pos">ST</div><div class="pos">ST</div><div class="pos">CAM</div>'
        '<ul><li>Att. Work Rate High</li><li>Def. Work Rate low</li></ul>'
        '<span class="pos pos1">RW</span><span class="pos">rw</span><p>Preferred foot Left</p></body></html>')


def test_extractors_on_a_page(spark):
    # the page among others: without markup, empty, broken
    pages = spark.createDataFrame([(1, PAGE, "k"), (2, None, "k"), (3, "", "k"), (4, "<p>a</p><![foo[x]]><table><tr>", "k")],
                                  "k long, html string, text string")
    trees = H.parse_pages(pages, ["k"])
    details = {r["k"]: r for r in H.player_details(trees, ["k"]).collect()}
    assert set(details) == {1, 3, 4}
    d = details[1]
    assert (d["height_cm"], d["nationality"], d["preferred_foot"]) == (181, "X", "Left")
    assert (d["skill_moves"], d["weak_foot"], d["positions"]) == (2, 1, "ST, CAM")
    assert d["stats"] == {"Agility": 77, "Vision": 61}  # the last in document order, also around a nested column
    assert all(details[3][c] is None for c in ("height_cm", "skill_moves", "positions", "stats", "preferred_foot"))
    assert sorted((r["stat"], r["value"]) for r in H.stats(trees, ["k"]).collect()) == [("Agility", 77), ("Vision", 61)]
    e = {r["k"]: r for r in H.enrich_record(trees, ["k"]).collect()}
    assert (e[1]["position_list"], e[1]["work_rate"]) == ("RW", "High/Low")
    assert e[3]["position_list"] is None and e[3]["work_rate"] is None
    assert {r["k"]: r[1] for r in trees.select("k", H.is_bad_page()).collect()} == {1: True, 3: True, 4: True}
    assert H.player_rows(trees, ["k"]).count() == 0
    texts = element_table(trees, ["k"], text=True).where("k = 1 AND tag = 'li'").orderBy("ord").select("text").collect()
    assert [t[0] for t in texts] == ["Att. Work Rate High", "Def. Work Rate low"]


def test_record_extraction_needs_no_exchange_beyond_the_spread(spark):
    trees = H.parse_pages(spark.createDataFrame([(1, PAGE)], "k long, html string"), ["k"])
    for out in (H.player_details(trees, ["k"]), H.player_rows(trees, ["k"]), H.enrich_record(trees, ["k"])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") <= 1 and "Join" not in plan


def test_first_rows_of_nested_and_repeated_tables(spark):
    cells = "".join(f"<td>{i}</td>" for i in range(8))
    html = f"<table><tbody><tr>{cells}</tr><tr><td>short</td></tr></tbody><tbody><tr>{cells}</tr></tbody></table><table><tbody><tr>{cells}</tr></table>"
    trees = H.parse_pages(spark.createDataFrame([(1, html)], "k long, html string"), ["k"])
    rows = H.table_rows(trees, ["k"]).collect()
    assert [(r["n_cells"], r["cells"]) for r in rows] == [(8, [str(i) for i in range(8)])]
    inventory = H.table_inventory(trees, ["k"]).orderBy("t_ord").collect()
    assert [(r["n_rows"], r["n_cols"], r["first_cells"]) for r in inventory] == [(3, 8, ["0", "1", "2", "3", "4"]), (1, 8, ["0", "1", "2", "3", "4"])]
    bare = H.parse_pages(spark.createDataFrame([(1, "<table class='x y'></table>")], "k long, html string"), ["k"])
    r = H.table_inventory(bare, ["k"]).first()
    assert (r["table_class"], r["n_rows"], r["n_cols"], r["first_cells"]) == ("x y", None, None, None)


def test_a_pages_batches_are_small_and_queries_build_what_they_read(spark, monkeypatch):
    from sylvan.plans import QUERIES, html_queries
    from .conftest import SF001

    asked, parse = [], H.parse_pages
    monkeypatch.setattr(html_queries.H, "parse_pages", lambda *a, **k: asked.append(k["tags"]) or parse(*a, **k))
    for name in ("html_star_count", "html_positions_div", "html_work_rate", "regex_work_rate_page"):
        assert QUERIES[name](spark, SF001).count() == 200
    assert asked == ["div,p,svg", "div", "li,div,p", "#document"]
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000

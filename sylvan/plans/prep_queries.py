"""Registered queries: projections, filters, joins, general aggregates, set ops,
sorts and scalar functions (P, J, A1-A4, U, L, F)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.functions import scalar as S
from sylvan.operators import prep
from sylvan.operators.joins import broadcast_if_small
from sylvan.plans.common import LI_BINS, LI_KEYS, LINEITEM_BINNED_SQL, lineitem_binned, r6
from sylvan.plans.registry import register
from sylvan.sources.tables import table

# --------------------------------------------------------------------------- P


@register("prep_select", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def prep_select(spark, sf):
    return prep.select_existing(table(spark, sf, "customer"), ["c_custkey", "c_name", "c_acctbal", "Positions"])


_NULLED = ("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS acct, "
           "CASE WHEN c_nationkey = 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer")


@register("prep_dropna", f"SELECT c_custkey, acct, segment FROM ({_NULLED}) WHERE acct IS NOT NULL "
                         f"AND NOT isnan(acct) AND segment IS NOT NULL")
def prep_dropna(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") < 0, None).otherwise(F.col("c_acctbal")).alias("acct"),
        F.when(F.col("c_nationkey") == 0, None).otherwise(F.col("c_mktsegment")).alias("segment"))
    return prep.drop_incomplete(c, ["acct", "segment"])


@register("prep_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 0 "
                         "AND o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT'")
def prep_filter(spark, sf):
    o = table(spark, sf, "orders")
    return o.where((F.col("o_totalprice") > 0) & (F.col("o_orderstatus") != "P")
                   & (F.col("o_orderpriority") == "1-URGENT")).select("o_orderkey", "o_totalprice")


@register("prep_derive", "SELECT p_partkey, round(p_retailprice / 1000000, 9) + 0.0 AS price_million FROM part")
def prep_derive(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", (F.round(F.col("p_retailprice") / 1_000_000, 9) + 0.0).alias("price_million"))


@register("schema_complete", "SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS position_list, "
                             "CAST(NULL AS VARCHAR) AS work_rate_enriched FROM customer")
def schema_complete(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return prep.add_missing_columns(c, {"position_list": "string", "work_rate_enriched": "string"})


@register("index_slice", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey >= 100 AND o_orderkey < 600")
def index_slice(spark, sf):
    return prep.key_slice(table(spark, sf, "orders"), "o_orderkey", 100, 500).select("o_orderkey", "o_custkey")


_PLAYERS_SQL = (
    "SELECT c_custkey AS idx, CASE WHEN c_nationkey = 3 THEN NULL WHEN c_nationkey = 4 THEN '' "
    "ELSE '/player/' || c_custkey END AS player_url, "
    "CASE WHEN c_nationkey = 5 THEN NULL ELSE c_name END AS name, "
    "CASE WHEN c_acctbal > 5000 THEN c_mktsegment END AS position_list FROM customer"
)


def players(spark, sf):
    """A player-like table derived from ``customer`` (url, name, position list)."""
    c = table(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").alias("idx"),
        F.when(F.col("c_nationkey") == 3, None).when(F.col("c_nationkey") == 4, "")
        .otherwise(F.concat(F.lit("/player/"), F.col("c_custkey").cast("string"))).alias("player_url"),
        F.when(F.col("c_nationkey") == 5, None).otherwise(F.col("c_name")).alias("name"),
        F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment")).alias("position_list"))


@register("worklist", "SELECT idx, player_url, coalesce(name, 'Player ' || (idx + 1)) AS name "
                      f"FROM ({_PLAYERS_SQL}) WHERE player_url IS NOT NULL AND player_url <> '' "
                      "AND position_list IS NULL")
def worklist(spark, sf):
    return prep.worklist(players(spark, sf), "player_url", "position_list", "idx", "name")


@register("eda_scatter_points",
          "SELECT c_mktsegment AS species, c_acctbal AS x, c_nationkey AS y FROM customer "
          "WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def eda_scatter_points(spark, sf):
    c = table(spark, sf, "customer")
    return c.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        F.col("c_mktsegment").alias("species"), F.col("c_acctbal").alias("x"), F.col("c_nationkey").alias("y"))


@register("distinct_first_seen",
          "SELECT o_orderpriority AS value, min(o_orderkey) AS first_seen FROM orders GROUP BY 1")
def distinct_first_seen(spark, sf):
    return prep.distinct_first_seen(table(spark, sf, "orders"), "o_orderpriority", "o_orderkey")


# --------------------------------------------------------------------------- J


@register("anti_join_new",
          "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN "
          "(SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderpriority = '1-URGENT')")
def anti_join_new(spark, sf):
    seen = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return prep.skip_seen(table(spark, sf, "customer").select("c_custkey", "c_name"), seen, ["c_custkey"])


_DETAILS_SQL = ("SELECT o_custkey, max(o_orderpriority) AS c_mktsegment, count(*) AS n_orders "
                "FROM orders GROUP BY o_custkey")


@register("enrich_details",
          f"SELECT c.c_custkey, coalesce(d.c_mktsegment, c.c_mktsegment) AS c_mktsegment, d.n_orders "
          f"FROM customer c LEFT JOIN ({_DETAILS_SQL}) d ON c.c_custkey = d.o_custkey")
def enrich_details(spark, sf):
    o = table(spark, sf, "orders")
    details = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderpriority").alias("c_mktsegment"), F.count(F.lit(1)).alias("n_orders"))
    base = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return prep.enrich(base, details, ["c_custkey"])


_UPDATES_SQL = ("SELECT o_custkey, CASE WHEN max(o_orderstatus) = 'F' THEN '' "
                "WHEN max(o_orderstatus) = 'P' THEN NULL ELSE max(o_orderpriority) END AS new_value "
                "FROM orders GROUP BY o_custkey")


@register("keyed_update",
          f"SELECT c.c_custkey, coalesce(nullif(u.new_value, ''), c.c_mktsegment) AS c_mktsegment "
          f"FROM customer c LEFT JOIN ({_UPDATES_SQL}) u ON c.c_custkey = u.o_custkey")
def keyed_update(spark, sf):
    o = table(spark, sf, "orders")
    st = F.max("o_orderstatus")
    upd = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.when(st == "F", "").when(st == "P", None).otherwise(F.max("o_orderpriority")).alias("c_mktsegment"))
    base = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return prep.keyed_update(base, upd, ["c_custkey"], ["c_mktsegment"])


@register("label_lookup",
          "SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey")
def label_lookup(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region").select("r_regionkey", "r_name")
    # the dimension side is broadcast only after its size is measured
    r = broadcast_if_small(r, r.count())
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")


# --------------------------------------------------------------------------- A1-A4


@register("agg_shape", "SELECT count(*) AS n_rows, 11 AS n_columns, count(DISTINCT l_returnflag) AS n_classes "
                       "FROM lineitem")
def agg_shape(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(li.columns)).alias("n_columns"),
                  F.count_distinct("l_returnflag").alias("n_classes"))


@register("value_counts", f"SELECT qty_bin, CAST(list_position({LI_BINS['qty_bin'][2]}, qty_bin) AS INTEGER) AS ordinal, count(*) AS n "
          f"FROM {LINEITEM_BINNED_SQL} GROUP BY 1, 2")
def value_counts(spark, sf):
    """L2: class counts in category order (the ordinal is the position of the bin's label)."""
    labels = F.array(*map(F.lit, LI_BINS["qty_bin"][2]))
    return (lineitem_binned(spark, sf).groupBy("qty_bin").agg(F.count(F.lit(1)).alias("n"))
            .select("qty_bin", F.array_position(labels, F.col("qty_bin")).cast("int").alias("ordinal"), "n").orderBy("ordinal"))


@register("baseline_accuracy",
          "SELECT round(max(n) * 100.0 / sum(n), 6) + 0.0 AS baseline_accuracy FROM "
          "(SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1)")
def baseline_accuracy(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(r6(F.max("n") * 100.0 / F.sum("n")).alias("baseline_accuracy"))


@register("describe_target",
          "SELECT min(p_retailprice) AS min_value, max(p_retailprice) AS max_value, "
          "round(avg(p_retailprice), 6) + 0.0 AS mean_value FROM part")
def describe_target(spark, sf):
    return table(spark, sf, "part").agg(F.min("p_retailprice").alias("min_value"),
                                        F.max("p_retailprice").alias("max_value"),
                                        r6(F.avg("p_retailprice")).alias("mean_value"))


# --------------------------------------------------------------------------- U, L


@register("union_classes",
          "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')")
def union_classes(spark, sf):
    """The per-class frames of all classes put together again."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return reduce(DataFrame.unionByName, [o.where(F.col("o_orderstatus") == c) for c in ("F", "O", "P")])


@register("append_new",
          "SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS acctbal "
          "FROM customer UNION ALL SELECT s_suppkey + 1000000000, s_name, NULL, s_acctbal FROM supplier")
def append_new(spark, sf):
    old = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                              F.col("c_mktsegment").alias("segment"))
    new = table(spark, sf, "supplier").select((F.col("s_suppkey") + 1_000_000_000).alias("key"),
                                              F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"))
    return old.unionByName(new, allowMissingColumns=True)


@register("preview_head_tail",
          "SELECT o_orderkey, 'head' AS part FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 10) "
          "UNION ALL SELECT o_orderkey, 'tail' FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 10)")
def preview_head_tail(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    return prep.head(o, ["o_orderkey"], 10).withColumn("part", F.lit("head")).unionByName(
        prep.tail(o, ["o_orderkey"], 10).withColumn("part", F.lit("tail")))


# --------------------------------------------------------------------------- F


_MONEY_RAW_SQL = (
    "CASE c_nationkey % 5 WHEN 0 THEN '€' || c_custkey || '.5M' WHEN 1 THEN '€' || c_custkey || 'K' "
    "WHEN 2 THEN '€' || c_custkey WHEN 3 THEN '€x' || c_custkey || 'M' ELSE '€0' END"
)


def _money_raw():
    k = F.col("c_custkey").cast("string")
    m = F.col("c_nationkey") % 5
    return (F.when(m == 0, F.concat(F.lit("€"), k, F.lit(".5M"))).when(m == 1, F.concat(F.lit("€"), k, F.lit("K")))
            .when(m == 2, F.concat(F.lit("€"), k)).when(m == 3, F.concat(F.lit("€x"), k, F.lit("M")))
            .otherwise(F.lit("€0")))


@register("parse_money",
          "SELECT c_custkey, raw, value FROM (SELECT c_custkey, raw, CASE WHEN contains(raw, 'M') "
          "THEN TRY_CAST(regexp_replace(raw, '[€M]', '', 'g') AS DOUBLE) * 1000000 WHEN contains(raw, 'K') "
          "THEN TRY_CAST(regexp_replace(raw, '[€K]', '', 'g') AS DOUBLE) * 1000 ELSE 0.0 END AS value "
          f"FROM (SELECT c_custkey, {_MONEY_RAW_SQL} AS raw FROM customer)) WHERE value IS NOT NULL")
def parse_money(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", _money_raw().alias("raw"))
    return c.select("c_custkey", "raw", S.parse_money("raw").alias("value")).where(F.col("value").isNotNull())


@register("parse_rating",
          "SELECT c_custkey, CAST(split_part(regexp_replace(raw, '-', '+', 'g'), '+', 1) AS INTEGER) AS rating FROM "
          "(SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_nationkey + 60 || '+2' ELSE c_nationkey + 60 || '-1' END "
          "AS raw FROM customer)")
def parse_rating(spark, sf):
    c = table(spark, sf, "customer")
    base = (F.col("c_nationkey") + 60).cast("string")
    raw = F.when(F.col("c_acctbal") > 0, F.concat(base, F.lit("+2"))).otherwise(F.concat(base, F.lit("-1")))
    return c.select("c_custkey", S.parse_rating(raw).cast("int").alias("rating"))


@register("safe_int",
          "SELECT c_custkey, CASE WHEN regexp_full_match(raw, '[0-9]+') THEN CAST(raw AS BIGINT) ELSE 0 END AS value "
          "FROM (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN substr(c_name, 10) ELSE c_mktsegment END AS raw "
          "FROM customer)")
def safe_int(spark, sf):
    c = table(spark, sf, "customer")
    raw = F.when(F.col("c_acctbal") > 0, F.substring("c_name", 10, 1000)).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", S.safe_int(raw).alias("value"))


@register("default_fill",
          "SELECT c_custkey, coalesce(nullif(team, ''), 'Free Agent') AS team FROM (SELECT c_custkey, "
          "CASE WHEN c_acctbal < 0 THEN '' WHEN c_acctbal < 100 THEN NULL ELSE c_mktsegment END AS team FROM customer)")
def default_fill(spark, sf):
    c = table(spark, sf, "customer")
    team = F.when(F.col("c_acctbal") < 0, "").when(F.col("c_acctbal") < 100, None).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", S.default_fill(team, "Free Agent").alias("team"))


_WS = S.PY_WHITESPACE_CLASS


@register("clean_text",
          f"SELECT doc_id, regexp_replace(split_part(regexp_replace(text, '^{_WS}+|{_WS}+$', '', 'g'), chr(10), 1), "
          f"'^{_WS}+|{_WS}+$', '', 'g') AS first_line FROM documents")
def clean_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", S.first_line("text").alias("first_line"))


@register("bin_right_closed",
          "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, qty_bin, disc_bin, tax_bin "
          f"FROM {LINEITEM_BINNED_SQL}")
def bin_right_closed_q(spark, sf):
    return lineitem_binned(spark, sf).select(*LI_KEYS, "qty_bin", "disc_bin", "tax_bin")


@register("label_binarize",
          "SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, count(*) AS n FROM lineitem GROUP BY 1")
def label_binarize(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy(S.binarize("l_returnflag", "R").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@register("json_extract_int",
          "SELECT event_id, CAST(nullif(regexp_extract(json_extract_string(props, '$.k'), '(\\d+)', 1), '') "
          "AS BIGINT) AS k FROM events")
def json_extract_int(spark, sf):
    return table(spark, sf, "events").select("event_id", S.json_first_int("props", "$.k").alias("k"))


_FOOT_TEXT_SQL = ("'Name ' || c_name || ' Preferred foot ' || CASE WHEN c_acctbal > 4000 THEN 'Left' "
                  "WHEN c_acctbal > 0 THEN 'Right' ELSE 'unknown' END || ' Age 30'")


@register("regex_extract",
          "SELECT c_custkey, CASE WHEN regexp_matches(t, 'Preferred foot\\s+(Left|Right)') THEN "
          "regexp_extract(t, 'Preferred foot\\s+(Left|Right)', 1) END AS foot "
          f"FROM (SELECT c_custkey, {_FOOT_TEXT_SQL} AS t FROM customer)")
def regex_extract(spark, sf):
    c = table(spark, sf, "customer")
    t = F.concat(F.lit("Name "), F.col("c_name"), F.lit(" Preferred foot "),
                 F.when(F.col("c_acctbal") > 4000, "Left").when(F.col("c_acctbal") > 0, "Right")
                 .otherwise("unknown"), F.lit(" Age 30"))
    return c.select("c_custkey", S.regex_group(t, r"Preferred foot\s+(Left|Right)").alias("foot"))


def _rate_word(col):
    return (F.when(col == "1-URGENT", "HIGH").when(col == "2-HIGH", "high").when(col == "3-MEDIUM", "Medium")
            .when(col == "4-NOT SPECIFIED", "none").otherwise("low"))


_WR_TEXT_SQL = ("'Team x. Work rate: ' || CASE o_orderpriority WHEN '1-URGENT' THEN 'HIGH' WHEN '2-HIGH' THEN 'high' "
                "WHEN '3-MEDIUM' THEN 'Medium' WHEN '4-NOT SPECIFIED' THEN 'none' ELSE 'low' END || ' / ' || "
                "CASE o_orderstatus WHEN '1-URGENT' THEN 'HIGH' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'Medium' "
                "WHEN '4-NOT SPECIFIED' THEN 'none' ELSE 'low' END")
_WR_RE = "(?i)Work Rate.*?(\\w+)\\s*/\\s*(\\w+)"


# The rendered text is ASCII, where Java's Unicode \w and RE2's \w agree, so RE2 can serve as oracle.
@register("regex_work_rate",
          f"SELECT o_orderkey, CASE WHEN regexp_matches(t, '{_WR_RE}') THEN regexp_extract(t, '{_WR_RE}', 1) "
          f"|| '/' || regexp_extract(t, '{_WR_RE}', 2) END AS work_rate FROM (SELECT o_orderkey, {_WR_TEXT_SQL} AS t "
          f"FROM orders)")
def regex_work_rate(spark, sf):
    o = table(spark, sf, "orders")
    t = F.concat(F.lit("Team x. Work rate: "), _rate_word(F.col("o_orderpriority")), F.lit(" / "),
                 _rate_word(F.col("o_orderstatus")))
    return o.select("o_orderkey", S.work_rate_text(t).alias("work_rate"))


_PAIR_SQL = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'HIGH' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN "
             "'Medium' WHEN '4-NOT SPECIFIED' THEN 'none' ELSE 'low' END || ' /  ' || "
             "CASE o_orderstatus WHEN 'F' THEN 'medium' WHEN 'O' THEN 'LOW' ELSE 'High' END")
_PAIR_RE = "(?i)(Low|Medium|High)\\s*/\\s*(Low|Medium|High)"


@register("regex_work_rate_pair",
          f"SELECT o_orderkey, CASE WHEN regexp_matches(t, '{_PAIR_RE}') THEN "
          f"upper(substr(lower(regexp_extract(t, '{_PAIR_RE}', 1)), 1, 1)) || substr(lower(regexp_extract(t, '{_PAIR_RE}', 1)), 2) "
          f"|| '/' || upper(substr(lower(regexp_extract(t, '{_PAIR_RE}', 2)), 1, 1)) || substr(lower(regexp_extract(t, '{_PAIR_RE}', 2)), 2) "
          f"END AS work_rate FROM (SELECT o_orderkey, {_PAIR_SQL} AS t FROM orders)")
def regex_work_rate_pair(spark, sf):
    o = table(spark, sf, "orders")
    st = F.col("o_orderstatus")
    t = F.concat(_rate_word(F.col("o_orderpriority")), F.lit(" /  "),
                 F.when(st == "F", "medium").when(st == "O", "LOW").otherwise("High"))
    return o.select("o_orderkey", S.work_rate_pair(t).alias("work_rate"))


@register("safe_name", "SELECT p_partkey, replace(replace(p_name || '. ' || p_type, ' ', '_'), '.', '') AS safe_name "
                       "FROM part")
def safe_name(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", S.safe_name(F.concat(F.col("p_name"), F.lit(". "), F.col("p_type"))).alias("safe_name"))


@register("array_join_distinct",
          "SELECT l_orderkey, string_agg(l_returnflag || l_linestatus, ', ' ORDER BY first_pos, l_returnflag || l_linestatus) "
          "FILTER (WHERE rnk <= 5) AS flags FROM (SELECT l_orderkey, l_returnflag, l_linestatus, first_pos, "
          "row_number() OVER (PARTITION BY l_orderkey ORDER BY first_pos, l_returnflag || l_linestatus) AS rnk FROM "
          "(SELECT l_orderkey, l_returnflag, l_linestatus, min((l_linenumber, l_partkey, l_suppkey)) AS first_pos "
          "FROM lineitem GROUP BY 1, 2, 3)) GROUP BY l_orderkey")
def array_join_distinct(spark, sf):
    """F13 per order: distinct flag pairs in first-seen order, first five, joined.

    First-seen position per (order, value) is an aggregate (map-side combined),
    so only the distinct values of an order -- not its rows -- are gathered.
    """
    li = table(spark, sf, "lineitem")
    v = F.concat("l_returnflag", "l_linestatus")
    first = li.groupBy("l_orderkey", v.alias("v")).agg(
        F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("pos"))
    ordered = first.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("a"))
    return ordered.select("l_orderkey", S.join_distinct(F.transform("a", lambda x: x["v"])).alias("flags"))


_CODES_SQL = ("SELECT l_orderkey, string_agg(['ST','CF','LW','RW','CAM','CM','CDM','CB','LB','RB','GK','LM','RM','XX']"
              "[l_linenumber] || CASE WHEN l_partkey % 2 = 0 THEN 'x' ELSE '' END, ' ') AS t "
              "FROM lineitem GROUP BY l_orderkey")


@register("position_codes",
          "SELECT l_orderkey, array_to_string(list_sort(list_distinct(regexp_extract_all(t, "
          f"'{S.POSITION_CODE_PATTERN}', 1))), ',') AS codes FROM ({_CODES_SQL})")
def position_codes(spark, sf):
    li = table(spark, sf, "lineitem")
    codes = F.array(*[F.lit(c) for c in S.POSITION_CODES + ["XX"]])
    tok = F.concat(F.element_at(codes, F.col("l_linenumber")),
                   F.when(F.col("l_partkey") % 2 == 0, "x").otherwise(""))
    # codes are found per line and unioned per order: only the (at most 13) distinct
    # codes of an order are gathered, never its lines
    found = li.select("l_orderkey", F.explode_outer(S.position_codes(tok)).alias("code"))
    per = found.groupBy("l_orderkey").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    return per.select("l_orderkey", F.array_join("codes", ",").alias("codes"))


@register("keyword_flag", "SELECT lang, count(*) FILTER (WHERE contains(text, 'the')) AS n_with, "
                          "count(*) AS n FROM documents GROUP BY lang")
def keyword_flag(spark, sf):
    d = table(spark, sf, "documents")
    return d.groupBy("lang").agg(F.count_if(S.keyword_flag("text", "the")).alias("n_with"),
                                 F.count(F.lit(1)).alias("n"))


@register("code_filter",
          "SELECT n_nationkey, cand, length(cand) BETWEEN 2 AND 3 AND upper(cand) = cand AND lower(cand) <> cand AS keep "
          "FROM (SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN lower(substr(n_name, 1, 2)) "
          "WHEN n_nationkey % 3 = 1 THEN substr(n_name, 1, 3) ELSE substr(n_name, 1, 1 + n_nationkey % 5) || '1' END "
          "AS cand FROM nation)")
def code_filter(spark, sf):
    n = table(spark, sf, "nation")
    k = F.col("n_nationkey")
    cand = (F.when(k % 3 == 0, F.lower(F.substring("n_name", 1, 2))).when(k % 3 == 1, F.substring("n_name", 1, 3))
            .otherwise(F.concat(F.expr("substr(n_name, 1, 1 + n_nationkey % 5)"), F.lit("1"))))
    return n.select("n_nationkey", cand.alias("cand")).withColumn("keep", S.is_position_code("cand"))


@register("sigmoid", "SELECT event_id, round(1 / (1 + exp(-(value / 100 - 1))), 6) + 0.0 AS p FROM events")
def sigmoid(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", r6(S.sigmoid(F.col("value") / 100 - 1)).alias("p"))

"""Registered queries: sampling and splits (G2-G5), profiling (A8-A10),
scaling and logistic regression (M8-M11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sylvan.operators import eda, logreg, sampling
from sylvan.plans.common import LI_KEYS, r6
from sylvan.plans.registry import register
from sylvan.sources.tables import table

_LI_ID_SQL = "md5('42:' || concat_ws('|', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in LI_KEYS) + "))"

# --------------------------------------------------------------------------- sampling


@register("balanced_sample",
          f"SELECT {', '.join(LI_KEYS)}, l_returnflag FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag "
          f"ORDER BY {_LI_ID_SQL}, {', '.join(LI_KEYS)}) AS rn FROM lineitem) WHERE rn <= 100")
def balanced_sample(spark, sf):
    li = table(spark, sf, "lineitem").select(*LI_KEYS, "l_returnflag")
    return sampling.balanced_sample(li, "l_returnflag", LI_KEYS, n=100, seed=42)


@register("split_stratified",
          f"SELECT {', '.join(LI_KEYS)}, l_returnflag, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split "
          f"FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY {_LI_ID_SQL}) AS rn, "
          f"count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)")
def split_stratified(spark, sf):
    li = table(spark, sf, "lineitem").select(*LI_KEYS, "l_returnflag")
    return sampling.stratified_split(li, "l_returnflag", LI_KEYS, 0.2, seed=42)


@register("split_hash",
          "SELECT o_orderkey, CASE WHEN substr(md5('42:' || CAST(o_orderkey AS VARCHAR)), 1, 4) < '3333' "
          "THEN 'test' ELSE 'train' END AS split FROM orders")
def split_hash(spark, sf):
    return sampling.hash_split(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 0.2, seed=42)


@register("split_exact",
          "SELECT o_orderkey, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM ("
          "SELECT o_orderkey, row_number() OVER (ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR))) AS rn, "
          "count(*) OVER () AS n FROM orders)")
def split_exact(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    return sampling.stratified_split(o, None, ["o_orderkey"], 0.2, seed=42)


@register("dedupe_first",
          "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER "
          "(PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def dedupe_first(spark, sf):
    e = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return sampling.first_per_key(e, ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", "event_type", "value")


# --------------------------------------------------------------------------- EDA

_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_sql():
    parts = []
    for i, a in enumerate(_NUM):
        for j, b in enumerate(_NUM):
            if i == j:
                parts.append(f"SELECT '{a}' AS col_i, '{b}' AS col_j, 1.0 AS r")
            else:
                parts.append(f"SELECT '{a}' AS col_i, '{b}' AS col_j, round(corr({a}, {b}), 6) + 0.0 AS r FROM lineitem")
    return " UNION ALL ".join(parts)


@register("eda_corr", _corr_sql())
def eda_corr(spark, sf):
    m = eda.correlation_matrix(table(spark, sf, "lineitem"), _NUM)
    return m.select("col_i", "col_j", r6("r").alias("r"))


def _hist_sql(bins=20):
    long = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM lineitem" for c in _NUM)
    return (
        f"WITH l AS ({long}), s AS (SELECT feature, min(v) AS lo, max(v) AS hi FROM l GROUP BY feature), "
        f"c AS (SELECT l.feature, CASE WHEN s.hi = s.lo THEN 1 ELSE least(CAST(floor((l.v - s.lo) / (s.hi - s.lo) * {bins}) AS INTEGER) + 1, {bins}) END AS bin, "
        f"count(*) AS n FROM l JOIN s ON l.feature = s.feature GROUP BY 1, 2), "
        f"g AS (SELECT feature, lo, hi, unnest(generate_series(1, {bins})) AS bin FROM s) "
        f"SELECT g.feature, CAST(g.bin AS INTEGER) AS bin, round(g.lo + (g.bin - 1) * (g.hi - g.lo) / {bins}, 6) + 0.0 AS bin_lo, "
        f"round(g.lo + g.bin * (g.hi - g.lo) / {bins}, 6) + 0.0 AS bin_hi, coalesce(c.n, 0) AS n "
        f"FROM g LEFT JOIN c ON g.feature = c.feature AND g.bin = c.bin")


@register("eda_histogram", _hist_sql())
def eda_histogram(spark, sf):
    h = eda.histogram(table(spark, sf, "lineitem"), _NUM, 20)
    return h.select("feature", "bin", r6("bin_lo").alias("bin_lo"), r6("bin_hi").alias("bin_hi"), "n")


@register("eda_boxplot",
          "WITH q AS (SELECT event_type AS grp, count(*) AS n, quantile_cont(value, 0.25) AS q1, "
          "quantile_cont(value, 0.5) AS med, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1), "
          "w AS (SELECT q.grp, min(CASE WHEN e.value BETWEEN q.q1 - 1.5 * (q.q3 - q.q1) AND q.q3 + 1.5 * (q.q3 - q.q1) "
          "THEN e.value END) AS wlo, max(CASE WHEN e.value BETWEEN q.q1 - 1.5 * (q.q3 - q.q1) AND q.q3 + 1.5 * (q.q3 - q.q1) "
          "THEN e.value END) AS whi, count(*) FILTER (WHERE NOT (e.value BETWEEN q.q1 - 1.5 * (q.q3 - q.q1) AND "
          "q.q3 + 1.5 * (q.q3 - q.q1))) AS n_out FROM events e JOIN q ON e.event_type = q.grp GROUP BY q.grp) "
          "SELECT q.grp AS \"group\", q.n, round(q.q1, 6) + 0.0 AS q1, round(q.med, 6) + 0.0 AS median, "
          "round(q.q3, 6) + 0.0 AS q3, w.wlo AS whisker_lo, w.whi AS whisker_hi, w.n_out AS n_outliers "
          "FROM q JOIN w ON q.grp = w.grp")
def eda_boxplot(spark, sf):
    b = eda.boxplot_stats(table(spark, sf, "events"), "value", "event_type")
    return b.select("group", "n", r6("q1").alias("q1"), r6("median").alias("median"), r6("q3").alias("q3"),
                    "whisker_lo", "whisker_hi", "n_outliers")


# --------------------------------------------------------------------------- logistic regression

LR_EPOCHS, LR_RATE = 5, 0.1


def _embeddings(spark, sf):
    """All rows; label 1 against the rest; exactly ceil(0.2 n) test rows."""
    e = table(spark, sf, "embeddings").withColumn("label", (F.col("label") == 1).cast("int"))
    return sampling.stratified_split(e, None, ["vec_id"], 0.2, seed=42)


def _scaled(spark, sf):
    e = _embeddings(spark, sf)
    mu, sd = logreg.scaler_fit(e.where(F.col("split") == "train"), "embedding")
    return logreg.scaler_transform(e, "embedding", mu, sd, out="z")


def _lr_model(spark, sf, epochs=LR_EPOCHS, every=1):
    tr = _scaled(spark, sf).where(F.col("split") == "train")
    return logreg.fit_logistic(tr, "z", "label", learning_rate=LR_RATE, epochs=epochs, record_every=every)


def _lr_sql(output, epochs=LR_EPOCHS, lr=LR_RATE):
    ctes = [
        "base AS (SELECT vec_id, embedding, CASE WHEN label = 1 THEN 1 ELSE 0 END AS label, "
        "CASE WHEN row_number() OVER (ORDER BY md5('42:' || CAST(vec_id AS VARCHAR))) <= ceil(0.2 * count(*) OVER ()) "
        "THEN 'test' ELSE 'train' END AS split FROM embeddings)",
        "xl AS (SELECT vec_id, label, split, unnest(generate_series(0, len(embedding) - 1)) AS idx, "
        "CAST(unnest(embedding) AS DOUBLE) AS x FROM base)",
        "st AS (SELECT idx, avg(x) AS mu, CASE WHEN stddev_pop(x) = 0 OR stddev_pop(x) IS NULL THEN 1.0 "
        "ELSE stddev_pop(x) END AS sd FROM xl WHERE split = 'train' GROUP BY idx)",
        "z AS (SELECT xl.vec_id, xl.label, xl.split, xl.idx, (xl.x - st.mu) / st.sd AS z FROM xl JOIN st ON xl.idx = st.idx)",
        "tr AS (SELECT * FROM z WHERE split = 'train')",
        "w0 AS (SELECT idx, CAST(0.0 AS DOUBLE) AS w FROM st)",
        "b0 AS (SELECT CAST(0.0 AS DOUBLE) AS b)",
    ]
    for e in range(epochs):
        ctes.append(f"s{e} AS (SELECT tr.vec_id, any_value(tr.label) AS y, sum(tr.z * w{e}.w) + any_value(b{e}.b) AS s "
                    f"FROM tr JOIN w{e} ON tr.idx = w{e}.idx CROSS JOIN b{e} GROUP BY tr.vec_id)")
        ctes.append(f"p{e} AS (SELECT vec_id, y, s, 1 / (1 + exp(-s)) AS p FROM s{e})")
        ctes.append(f"loss{e} AS (SELECT {e} AS epoch, avg(greatest(s, 0) - s * y + ln(1 + exp(-abs(s)))) AS loss FROM p{e})")
        ctes.append(f"w{e + 1} AS (SELECT tr.idx, any_value(w{e}.w) - {lr} * avg((p{e}.p - p{e}.y) * tr.z) AS w "
                    f"FROM tr JOIN p{e} ON tr.vec_id = p{e}.vec_id JOIN w{e} ON tr.idx = w{e}.idx GROUP BY tr.idx)")
        ctes.append(f"b{e + 1} AS (SELECT any_value(b{e}.b) - {lr} * avg(p{e}.p - p{e}.y) AS b FROM p{e} CROSS JOIN b{e})")
    head = "WITH " + ",\n".join(ctes) + "\n"
    if output == "standard_scale":
        return head + "SELECT vec_id, CAST(idx AS INTEGER) AS idx, round(z, 6) + 0.0 AS z FROM z"
    if output == "weights":
        return head + (f"SELECT CAST(idx AS INTEGER) AS idx, round(w, 6) + 0.0 AS weight FROM w{epochs} UNION ALL "
                       f"SELECT -1, round(b, 6) + 0.0 FROM b{epochs}")
    if output == "loss":
        return head + " UNION ALL ".join(f"SELECT epoch, round(loss, 6) + 0.0 AS loss FROM loss{e}"
                                         for e in range(epochs))
    if output == "predict":
        return head + (f"SELECT z.vec_id, any_value(z.label) AS label, CASE WHEN 1 / (1 + exp(-(sum(z.z * w.w) + "
                       f"any_value(b.b)))) > 0.5 THEN 1 ELSE 0 END AS prediction FROM z JOIN w{epochs} w "
                       f"ON z.idx = w.idx CROSS JOIN b{epochs} b WHERE z.split = 'test' GROUP BY z.vec_id")
    raise ValueError(output)


@register("standard_scale", _lr_sql("standard_scale"))
def standard_scale(spark, sf):
    s = _scaled(spark, sf)
    return s.select("vec_id", F.posexplode("z").alias("idx", "z")).select("vec_id", "idx", r6("z").alias("z"))


@register("logreg_fit", _lr_sql("weights"))
def logreg_fit(spark, sf):
    m = _lr_model(spark, sf)
    rows = [(i, float(w)) for i, w in enumerate(m.weights)] + [(-1, m.bias)]
    df = spark.createDataFrame(rows, "idx int, weight double")
    return df.select("idx", r6("weight").alias("weight"))


@register("bce_loss", _lr_sql("loss"))
def bce_loss(spark, sf):
    m = _lr_model(spark, sf)
    df = spark.createDataFrame([(int(e), float(v)) for e, v in m.losses], "epoch int, loss double")
    return df.select("epoch", r6("loss").alias("loss"))


@register("logreg_predict", _lr_sql("predict"))
def logreg_predict(spark, sf):
    m = _lr_model(spark, sf)
    te = _scaled(spark, sf).where(F.col("split") == "test")
    return m.predict(te, "z").select("vec_id", "label", "prediction")


# --------------------------------------------------------------------------- threshold trees

from sylvan.operators import cart  # noqa: E402

_CART_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("cart_classify")
def cart_classify(spark, sf):
    li = table(spark, sf, "lineitem").select(*LI_KEYS, *_CART_FEATURES, "l_returnflag")
    return cart.cart_classify(li, _CART_FEATURES, "l_returnflag").select(*LI_KEYS, "prediction")


@register("cart_regress")
def cart_regress(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size", (F.col("p_partkey") % 1000).alias("pk_mod"),
                                        "p_retailprice")
    out = cart.cart_regress(p, ["p_size", "pk_mod"], "p_retailprice")
    return out.select("p_partkey", r6("prediction").alias("prediction"))


_THR_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def _threshold_sql():
    long = " UNION ALL ".join(f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS x, l_returnflag AS y FROM lineitem"
                              for f in _THR_FEATURES)
    return (
        f"WITH l AS ({long}), cnt AS (SELECT feature, x, y, count(*) AS c FROM l GROUP BY ALL), "
        "vals AS (SELECT DISTINCT feature, x FROM l), labs AS (SELECT DISTINCT y FROM l), "
        "grid AS (SELECT v.feature, v.x, lb.y, coalesce(c.c, 0) AS c FROM vals v CROSS JOIN labs lb "
        "LEFT JOIN cnt c ON v.feature = c.feature AND v.x = c.x AND lb.y = c.y), "
        "cum AS (SELECT feature, x, y, sum(c) OVER (PARTITION BY feature, y ORDER BY x) AS cl, "
        "sum(c) OVER (PARTITION BY feature, y) AS ct FROM grid), "
        "agg AS (SELECT feature, x, sum(cl) AS nl, sum(ct) AS n, sum(cl * cl) AS sl2, sum((ct - cl) * (ct - cl)) AS sr2, "
        "sum(ct * ct) AS st2 FROM cum GROUP BY feature, x), "
        "cand AS (SELECT feature, x, lead(x) OVER (PARTITION BY feature ORDER BY x) AS nx, nl, n - nl AS nr, n, "
        "(1 - st2 / (n * n)) - (nl * (1 - sl2 / (nl * nl)) + (n - nl) * (1 - sr2 / ((n - nl) * (n - nl)))) / n AS gain "
        "FROM agg), "
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY round(gain, 12) DESC, (x + nx) / 2) AS rn "
        "FROM cand WHERE nx IS NOT NULL) "
        "SELECT feature, round((x + nx) / 2, 6) + 0.0 AS threshold, round(gain, 6) + 0.0 AS gain, "
        "CAST(nl AS BIGINT) AS n_left, CAST(nr AS BIGINT) AS n_right FROM ranked WHERE rn = 1")


@register("best_threshold_split", _threshold_sql())
def best_threshold_split(spark, sf):
    b = cart.best_threshold_split(table(spark, sf, "lineitem"), _THR_FEATURES, "l_returnflag")
    return b.select("feature", r6("threshold").alias("threshold"), r6("gain").alias("gain"),
                    F.col("n_left").cast("bigint").alias("n_left"), F.col("n_right").cast("bigint").alias("n_right"))


_THR_REG_FEATURES = ["p_size", "pk_mod"]


def _threshold_reg_sql():
    part = "(SELECT p_size, p_partkey % 1000 AS pk_mod, p_retailprice AS y FROM part)"
    long = " UNION ALL ".join(f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS x, y FROM {part}" for f in _THR_REG_FEATURES)
    return (
        f"WITH l AS ({long}), m AS (SELECT avg(y) AS mu FROM l), "
        "v AS (SELECT feature, x, count(*) AS c, sum(y - mu) AS s, sum((y - mu) * (y - mu)) AS q FROM l CROSS JOIN m GROUP BY feature, x), "
        "cum AS (SELECT feature, x, sum(c) OVER w AS nl, sum(s) OVER w AS sl, sum(c) OVER g AS n, sum(s) OVER g AS st, sum(q) OVER g AS qt, "
        "lead(x) OVER w AS nx FROM v WINDOW w AS (PARTITION BY feature ORDER BY x), g AS (PARTITION BY feature)), "
        "cand AS (SELECT feature, (x + nx) / 2 AS threshold, nl, n - nl AS nr, "
        "(sl * sl / nl + (st - sl) * (st - sl) / (n - nl) - st * st / n) / n AS gain, qt / n - (st / n) * (st / n) AS var "
        "FROM cum WHERE nx IS NOT NULL), "
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY round(gain / var, 12) DESC, threshold) AS rn FROM cand) "
        "SELECT feature, round(threshold, 6) + 0.0 AS threshold, round(gain, 6) + 0.0 AS gain, CAST(nl AS BIGINT) AS n_left, "
        "CAST(nr AS BIGINT) AS n_right FROM ranked WHERE rn = 1")


@register("best_threshold_split_reg", _threshold_reg_sql())
def best_threshold_split_reg(spark, sf):
    """M14 by squared error."""
    p = table(spark, sf, "part").select("p_size", (F.col("p_partkey") % 1000).alias("pk_mod"), "p_retailprice")
    b = cart.best_threshold_split(p, _THR_REG_FEATURES, "p_retailprice", "squared_error")
    return b.select("feature", r6("threshold").alias("threshold"), r6("gain").alias("gain"),
                    F.col("n_left").cast("bigint").alias("n_left"), F.col("n_right").cast("bigint").alias("n_right"))

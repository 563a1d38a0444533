"""DuckDB oracle SQL for the level-wise trees, unrolled one CTE block per level.

This is an independent, textbook formulation (impurity from class shares,
``var_pop``, ``median``) used only to check the Spark operators.
"""

from __future__ import annotations


def _esc(v: str) -> str:
    return f"replace(replace(replace({v}, '%', '%25'), '/', '%2F'), '=', '%3D')"


def _case(idx: str, values: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN {idx} = {i} THEN {v}" for i, v in enumerate(values)) + " END"


def tree_sql(base: str, features: list[str], target: str, kind: str, max_depth: int | None,
             min_samples: int = 2, keys: list[str] | None = None, output: str = "nodes",
             reg_round: bool = True, route_base: str | None = None, label_order: list | None = None) -> str:
    k = len(features)
    levels = k if max_depth is None else min(max_depth, k)
    keys = keys or []
    cls = kind in ("entropy", "gini")
    fcols = [f"f{i}" for i in range(k)]
    fsel = ", ".join(f"CAST({f} AS VARCHAR) AS f{i}" for i, f in enumerate(features))
    notnull = " AND ".join([f"{f} IS NOT NULL" for f in features] + [f"{target} IS NOT NULL"])
    y = target if cls else f"CAST({target} AS DOUBLE)"
    kc = "".join(f"{c}, " for c in keys)
    ctes = [f"a0 AS (SELECT 'R' AS node_id, CAST(NULL AS VARCHAR) AS parent, CAST([] AS INTEGER[]) AS used, "
            f"'' AS rule, {kc}{fsel}, {y} AS y FROM {base} WHERE {notnull})"]
    names_sql = [f"'{f}'" for f in features]
    tie = ("list_position([" + ", ".join(f"'{v}'" for v in label_order) + "], y)") if label_order else "y"
    for d in range(levels + 1):
        a = f"a{d}"
        if cls:
            share = "(CAST(c AS DOUBLE) / nt)"
            imp = f"-sum({share} * log2({share}))" if kind == "entropy" else f"1 - sum({share} * {share})"
            ctes.append(f"lc{d} AS (SELECT node_id, y, count(*) AS c FROM {a} GROUP BY node_id, y)")
            ctes.append(f"lt{d} AS (SELECT node_id, y, c, sum(c) OVER (PARTITION BY node_id) AS nt FROM lc{d})")
            ctes.append(f"s{d} AS (SELECT node_id, CAST(max(nt) AS BIGINT) AS n, {imp} AS imp, "
                        f"first(y ORDER BY c DESC, {tie}) AS pred, count(*) = 1 AS const FROM lt{d} GROUP BY node_id)")
        elif kind == "mse":
            ctes.append(f"s{d} AS (SELECT node_id, count(*) AS n, var_pop(y) AS imp, avg(y) AS pred, "
                        f"min(y) = max(y) AS const FROM {a} GROUP BY node_id)")
        else:
            ctes.append(f"m{d} AS (SELECT node_id, median(y) AS med FROM {a} GROUP BY node_id)")
            ctes.append(f"s{d} AS (SELECT x.node_id, count(*) AS n, avg(abs(x.y - m.med)) AS imp, "
                        f"any_value(m.med) AS pred, min(x.y) = max(x.y) AS const "
                        f"FROM {a} x JOIN m{d} m ON x.node_id = m.node_id GROUP BY x.node_id)")
        ctes.append(f"r{d} AS (SELECT DISTINCT node_id, rule FROM {a})")
        if d < levels:
            long = " UNION ALL ".join(
                f"SELECT node_id, {i} AS f, f{i} AS v, y FROM {a} WHERE NOT list_contains(used, {i})"
                for i in range(k))
            ctes.append(f"l{d} AS ({long})")
            if cls:
                ctes.append(f"vc{d} AS (SELECT node_id, f, v, y, count(*) AS c FROM l{d} GROUP BY node_id, f, v, y)")
                ctes.append(f"vt{d} AS (SELECT node_id, f, v, c, sum(c) OVER (PARTITION BY node_id, f, v) AS nt "
                            f"FROM vc{d})")
                ctes.append(f"vi{d} AS (SELECT node_id, f, v, max(nt) AS nv, {imp} AS imp FROM vt{d} "
                            f"GROUP BY node_id, f, v)")
            elif kind == "mse":
                ctes.append(f"vi{d} AS (SELECT node_id, f, v, count(*) AS nv, var_pop(y) AS imp FROM l{d} "
                            f"GROUP BY node_id, f, v)")
            else:
                ctes.append(f"vm{d} AS (SELECT node_id, f, v, median(y) AS med FROM l{d} GROUP BY node_id, f, v)")
                ctes.append(f"vi{d} AS (SELECT x.node_id, x.f, x.v, count(*) AS nv, avg(abs(x.y - m.med)) AS imp "
                            f"FROM l{d} x JOIN vm{d} m ON x.node_id = m.node_id AND x.f = m.f AND x.v = m.v "
                            f"GROUP BY x.node_id, x.f, x.v)")
            ctes.append(f"fi{d} AS (SELECT node_id, f, sum(nv * imp) / sum(nv) AS child FROM vi{d} "
                        f"GROUP BY node_id, f)")
            ctes.append(f"g{d} AS (SELECT fi.node_id, fi.f, s.imp - fi.child AS gain FROM fi{d} fi "
                        f"JOIN s{d} s ON fi.node_id = s.node_id)")
            ctes.append(f"b{d} AS (SELECT node_id, f AS best_f, round(gain, 12) AS best_gain FROM ("
                        f"SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY round(gain, 12) DESC, f) AS rn "
                        f"FROM g{d}) WHERE rn = 1)")
            ev = f"(NOT s.const AND s.n >= {min_samples})"
            ctes.append(f"dec{d} AS (SELECT s.node_id, s.n, s.imp, s.pred, {d} AS depth, "
                        f"CASE WHEN {ev} THEN b.best_gain END AS gain, "
                        f"(NOT {ev}) OR b.best_gain <= 0 AS is_leaf, b.best_f "
                        f"FROM s{d} s LEFT JOIN b{d} b ON s.node_id = b.node_id)")
            value = _case("d.best_f", [f"x.{c}" for c in fcols])
            fname = _case("d.best_f", names_sql)
            cond = f"{fname} || ' = ' || {value}"
            ctes.append(
                f"a{d + 1} AS (SELECT x.node_id || '/' || CAST(d.best_f AS VARCHAR) || '=' || {_esc(value)} AS node_id, "
                f"x.node_id AS parent, list_append(x.used, d.best_f) AS used, "
                f"CASE WHEN x.rule = '' THEN {cond} ELSE x.rule || ' AND ' || {cond} END AS rule, "
                f"{''.join(f'x.{c}, ' for c in keys)}{', '.join(f'x.{c}' for c in fcols)}, x.y "
                f"FROM a{d} x JOIN dec{d} d ON x.node_id = d.node_id WHERE NOT d.is_leaf)")
        else:
            ctes.append(f"dec{d} AS (SELECT s.node_id, s.n, s.imp, s.pred, {d} AS depth, "
                        f"CAST(NULL AS DOUBLE) AS gain, TRUE AS is_leaf, CAST(NULL AS INTEGER) AS best_f FROM s{d} s)")
    pred = "pred" if cls or not reg_round else "round(pred, 6) + 0.0"
    if output == "nodes":
        body = " UNION ALL ".join(
            f"SELECT d.node_id, d.depth, CASE WHEN NOT d.is_leaf THEN {_case('d.best_f', names_sql)} END AS split_feature, "
            f"d.is_leaf, {pred.replace('pred', 'd.pred')} AS prediction, d.n, round(d.imp, 6) + 0.0 AS impurity, "
            f"round(d.gain, 6) + 0.0 AS gain FROM dec{d} d" for d in range(levels + 1))
    elif output == "rules":
        body = " UNION ALL ".join(
            f"SELECT d.node_id, r.rule, d.depth, {pred.replace('pred', 'd.pred')} AS prediction, d.n "
            f"FROM dec{d} d JOIN r{d} r ON d.node_id = r.node_id WHERE d.is_leaf" for d in range(levels + 1))
    elif output == "predict":
        body = " UNION ALL ".join(
            f"SELECT {''.join(f'x.{c}, ' for c in keys)}x.y AS actual, d.pred AS prediction "
            f"FROM a{d} x JOIN dec{d} d ON x.node_id = d.node_id WHERE d.is_leaf" for d in range(levels + 1))
    elif output == "route":
        # rows of ``route_base`` routed through the fitted tree; a value with no
        # child at a node follows the node's first-seen child (smallest key tuple).
        order = ", ".join(f"{c}" for c in keys)
        rsel = ", ".join(f"CAST({f} AS VARCHAR) AS f{i}" for i, f in enumerate(features))
        ctes.append(f"t0 AS (SELECT 'R' AS node_id, {kc}{rsel} FROM {route_base})")
        for d in range(levels):
            ctes.append(f"fc{d} AS (SELECT parent, first(node_id ORDER BY {order}) AS first_child "
                        f"FROM a{d + 1} GROUP BY parent)")
            value = _case("d.best_f", [f"t.{c}" for c in fcols])
            child = f"t.node_id || '/' || CAST(d.best_f AS VARCHAR) || '=' || {_esc(value)}"
            ctes.append(
                f"t{d + 1} AS (SELECT CASE WHEN d.node_id IS NULL OR d.is_leaf THEN t.node_id "
                f"ELSE coalesce(e.node_id, fc.first_child) END AS node_id, "
                f"{''.join(f't.{c}, ' for c in keys)}{', '.join(f't.{c}' for c in fcols)} "
                f"FROM t{d} t LEFT JOIN dec{d} d ON t.node_id = d.node_id "
                f"LEFT JOIN (SELECT DISTINCT node_id FROM a{d + 1}) e ON e.node_id = {child} "
                f"LEFT JOIN fc{d} fc ON fc.parent = t.node_id)")
        alln = " UNION ALL ".join(f"SELECT node_id, pred FROM dec{d}" for d in range(levels + 1))
        body = (f"SELECT {''.join(f't.{c}, ' for c in keys)}n.pred AS prediction FROM t{levels} t "
                f"JOIN ({alln}) n ON t.node_id = n.node_id")
    else:
        raise ValueError(output)
    return "WITH " + ",\n".join(ctes) + "\n" + body

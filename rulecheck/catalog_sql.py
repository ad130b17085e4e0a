"""DuckDB oracle SQL for every query of ``catalog.queries()``.

Written independently of the Spark plans: plain SQL aggregates, joins and
windows over the same tables (and the same derivation expressions).
"""

from __future__ import annotations

from . import catalog as C

DQ, DV = C.DQ, C.DV


def _wrap(sql: str) -> str:
    return f"SELECT * FROM ({sql})"


def _kpi(sheet, field, tt, tn, with_names, count_sql):
    return C._sql_with(with_names) + C._kpi_row(sheet, field, tt, tn, count_sql)


def _lit(sheet, field, tt, tn, n, style="kpi"):
    status = ("P" if n == 0 else "F") if style == "kpi" else ("PASS" if n == 0 else "FAIL")
    extra = ", CAST(NULL AS BIGINT) AS total_checked, CAST(NULL AS BIGINT) AS passed_count" if style != "kpi" else ""
    return (f"SELECT '{sheet}' AS sheet_name, '{field}' AS field, '{tt}' AS test_type, '{tn}' AS test_name, "
            f"'{status}' AS status, CAST({n} AS BIGINT) AS failed_count{extra}")


N = C._norm


def _div(n, d):
    return (f"(CASE WHEN {d} = 0 THEN (CASE WHEN {n} > 0 THEN 'inf'::DOUBLE WHEN {n} < 0 THEN '-inf'::DOUBLE END) "
            f"ELSE CAST({n} AS DOUBLE) / {d} END)")


def _prec_fail(v):
    return f"({v} IS NOT NULL AND isfinite({v}) AND abs({v} - round_even({v}, 2)) > 1e-6)"


# ---------------------------------------------------------------------------- single checks
def table_existence():
    vals = ", ".join(f"('{t}', {i})" for i, t in enumerate(C.EXPECTED_TABLES))
    return (
        "SELECT e.name AS sheet_name, 'Sheet' AS field, 'Sheet Validation' AS test_type, "
        "'Sheet Existence Testing' AS test_name, CASE WHEN t.table_name IS NULL THEN 'F' ELSE 'P' END AS status, "
        "CAST(CASE WHEN t.table_name IS NULL THEN 1 ELSE 0 END AS BIGINT) AS failed_count "
        f"FROM (VALUES {vals}) e(name, ord) "
        "LEFT JOIN (SELECT DISTINCT table_name FROM information_schema.tables) t ON t.table_name = e.name"
    )


def column_existence():
    rows = []
    for sheet, info in C.EXPECTED_COLUMNS.items():
        for f in info["fields"]:
            rows.append(f"('{sheet}', '{f['name']}')")
    loose = "lower(replace(replace(trim({x}), ' ', ''), '_', ''))"
    return (
        f"WITH e(sheet, fname) AS (VALUES {', '.join(rows)}), "
        "tabs AS (SELECT DISTINCT table_name FROM information_schema.tables), "
        f"cols AS (SELECT DISTINCT table_name, {loose.format(x='column_name')} AS n FROM information_schema.columns) "
        "SELECT e.sheet AS sheet_name, e.fname AS field, 'Field Validation' AS test_type, "
        "'Field Existence Testing' AS test_name, CASE WHEN c.n IS NULL THEN 'F' ELSE 'P' END AS status, "
        "CAST(CASE WHEN c.n IS NULL THEN 1 ELSE 0 END AS BIGINT) AS failed_count "
        "FROM e JOIN tabs t ON t.table_name = e.sheet "
        f"LEFT JOIN cols c ON c.table_name = e.sheet AND c.n = {loose.format(x='e.fname')} "
        "UNION ALL SELECT DISTINCT e.sheet, 'Field', 'Field Validation', 'Field Existence Testing', 'F', CAST(1 AS BIGINT) "
        "FROM e WHERE e.sheet NOT IN (SELECT table_name FROM tabs)"
    )


def required_tables(present=("customer_text", "orders_dates", "events_cells")):
    parts = []
    for sheet, rules in C.SHEET_CHECKS.items():
        if sheet in present:
            parts.append(f"SELECT '{sheet}' s, 'PASS' st, 0 n")
        elif (rules or {}).get("required", True):
            parts.append(f"SELECT '{sheet}' s, 'FAIL' st, 1 n")
        else:
            parts.append(f"SELECT '{sheet}' s, 'SKIPPED' st, 0 n")
    return (
        "SELECT s AS sheet_name, 'Sheet' AS field, 'Sheet Validation' AS test_type, "
        "'Sheet Existence Testing' AS test_name, st AS status, CAST(n AS BIGINT) AS failed_count, "
        "CAST(NULL AS BIGINT) AS total_checked, CAST(NULL AS BIGINT) AS passed_count "
        f"FROM ({' UNION ALL '.join(parts)})"
    )


def _dup(rule, names):
    cols = rule["columns"]
    some = " OR ".join(f"{c} IS NOT NULL" for c in cols)
    return _kpi(rule["sheetname"], ", ".join(cols), DQ, "Duplicate Check", names,
                f"SELECT SUM(n) FROM (SELECT COUNT(*) n FROM {rule['sheetname']} WHERE {some} "
                f"GROUP BY {', '.join(cols)} HAVING COUNT(*) > 1)")


def null_check():
    blank = " + ".join(f"SUM(CASE WHEN {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '' THEN 1 ELSE 0 END)"
                       for c in ["priority", "o_orderstatus"])
    return _kpi("orders_blank", "priority, o_orderstatus, o_comment", DQ, "Null Check", ["orders_blank"],
                f"SELECT {blank} + 1 FROM orders_blank")


def formula_rows():
    v = f"({_div('l_tax', 'l_discount')} * 100)"
    return _kpi("lineitem", "tax to discount", DQ, "Formula Validation", [],
                f"SELECT SUM(CASE WHEN {v} IS NOT NULL AND NOT ({v} <= 100) THEN 1 ELSE 0 END) FROM lineitem")


def formula_grouped():
    v = f"({_div('t', 'd')} * 100)"
    return _kpi("lineitem", "order tax to discount", DQ, "Formula Validation", [],
                f"SELECT SUM(CASE WHEN {v} IS NOT NULL AND NOT ({v} <= 100) THEN 1 ELSE 0 END) FROM "
                "(SELECT COALESCE(SUM(l_tax), 0) t, COALESCE(SUM(l_discount), 0) d FROM lineitem "
                "WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey)")


def formula_cmp_grouped():
    return _kpi("orders_parts", "parts add up per customer", DQ, "Formula Validation", ["orders_parts"],
                "SELECT SUM(CASE WHEN COALESCE(round_even(a + b, 2) <> round_even(t, 2), TRUE) THEN 1 ELSE 0 END) FROM "
                "(SELECT COALESCE(SUM(part_a), 0) a, COALESCE(SUM(part_b), 0) b, COALESCE(SUM(total), 0) t "
                "FROM orders_parts WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey)")


def formula_cmp_rows():
    return _kpi("orders_parts", "parts add up", DQ, "Formula Validation", ["orders_parts"],
                "SELECT SUM(CASE WHEN COALESCE(round_even(part_a + part_b, 2) <> round_even(total, 2), TRUE) "
                "THEN 1 ELSE 0 END) FROM orders_parts")


def formula_typed():
    """Whole numbers and decimals in exact arithmetic; a missing value passes a threshold and fails a comparison."""
    counts = {
        "exact differences": "SELECT COUNT(*) FILTER (part IS NULL OR big - base <> part) FROM orders_wide",
        "exact differences per customer": "SELECT COUNT(*) FILTER (a - b <> p) FROM (SELECT cust, SUM(big) AS a, SUM(base) AS b, "
                                          "COALESCE(SUM(part), 0) AS p FROM orders_wide WHERE cust IS NOT NULL GROUP BY cust)",
        "whole division": "SELECT COUNT(*) FILTER (fives = 0 AND cust > 0 OR fives > 0 AND cust // nullif(fives, 0) > 1000) FROM orders_wide",
        "comparison as a number": "SELECT COUNT(*) FILTER (price_due > price) FROM orders_wide",
        "remainder of a distance": "SELECT COUNT(*) FILTER (abs(part - o_orderkey) % 3 > 1) FROM orders_wide",
        "decimals agree": "SELECT COUNT(*) FILTER (price_due <> price) FROM orders_wide",
        "either": "SELECT COUNT(*) FILTER (COALESCE(part > 500, FALSE) OR fives IN (2, 3) AND price <> price_due) FROM orders_wide",
    }
    return C._sql_with(["orders_wide"]) + "\nUNION ALL ".join(
        C._kpi_row("orders_wide", name, DQ, "Formula Validation", sql) for name, sql in counts.items())


def precision(columns):
    parts = []
    for c in columns:
        if c == "no_such":
            parts.append(_lit("orders_precision", "no_such", DQ, "Numeric Precision", 1))
            continue
        v = f"TRY_CAST({c} AS DOUBLE)"
        parts.append(_wrap(_kpi("orders_precision", c, DQ, "Numeric Precision", ["orders_precision"],
                                f"SELECT SUM(CASE WHEN {_prec_fail(v)} THEN 1 ELSE 0 END) FROM orders_precision")))
    return " UNION ALL ".join(parts)


def rule_dates():
    lv = "try_strptime(trim(order_date), '%Y-%m-%d')"
    lb = f"{N('order_date')} IN ('', 'not applicable', 'none')"
    fail = f"({lb} OR {lv} IS NULL OR l_shipdate IS NULL OR NOT ({lv} < l_shipdate))"
    return _kpi("order_lines", "ordered before shipped", DV, "Business Rule Validation", ["order_lines"],
                f"SELECT {C._distinct_count('o_custkey', fail)} FROM order_lines")


def rule_numbers():
    lv = "TRY_CAST(balance_text AS DOUBLE)"
    fail = f"({N('balance_text')} = '' OR {lv} IS NULL OR nation_limit IS NULL OR NOT ({lv} > nation_limit))"
    return _kpi("customer_text", "balance above nation limit", DV, "Business Rule Validation", ["customer_text"],
                f"SELECT SUM(CASE WHEN {fail} THEN 1 ELSE 0 END) FROM customer_text")


def rule_stale():
    p = "try_strptime(trim(order_date_text), '%Y-%m-%d')"
    fail = (f"({p} IS NOT NULL AND {p} < TIMESTAMP '1998-05-01' AND {N('order_date_text')} NOT IN ('', 'null'))")
    return _kpi("orders_dates", "stale order dates", DV, "Business Rule Validation", ["orders_dates"],
                f"SELECT {C._distinct_count('o_custkey', fail)} FROM orders_dates")


def rule_local_dates():
    """A column has the form of its first text (day-Mon-year); a comparison reads every text in its own."""
    any_form = "try_strptime(any_date, ['%Y-%m-%d', '%Y.%m.%d', '%b %d, %Y', '%Y%m%d', '%m/%d/%Y', '%d %b %Y %H:%M'])"
    counts = {
        "stale local dates": "SELECT COUNT(*) FILTER (try_strptime(local_date, '%d-%b-%Y') < "
                             f"TIMESTAMP '{C.STALE_AS_OF}' - INTERVAL 24 MONTH) FROM orders_local_dates",
        "dates in any form": f"SELECT COUNT(*) FILTER (NOT COALESCE({any_form} >= o_orderdate, FALSE)) FROM orders_local_dates",
    }
    return C._sql_with(["orders_local_dates"]) + "\nUNION ALL ".join(
        C._kpi_row("orders_local_dates", name, DV, "Business Rule Validation", sql) for name, sql in counts.items())


def rule_lookup(keep_nulls=False):
    where = "" if keep_nulls else "WHERE l.nation_key IS NOT NULL"
    name = C.BR_LOOKUP_NULLS["name"] if keep_nulls else C.BR_LOOKUP["name"]
    return _kpi("customer_nation", name, DV, "Business Rule Validation", ["customer_nation"],
                f"SELECT {C._distinct_count('k', 'lv <> rv')} FROM (SELECT l.nation_key k, {N('l.nation_label')} lv, "
                f"{N('n.n_name')} rv FROM customer_nation l LEFT JOIN nation n ON l.nation_key = n.n_nationkey {where})")


def _recon_sides(keys_src, keys_tgt):
    return (
        f"s AS (SELECT {keys_src}, SUM(COALESCE(TRY_CAST(\"Line Amount\" AS DOUBLE), 0)) v FROM line_amounts "
        "WHERE {nn_s} GROUP BY ALL), "
        f"t AS (SELECT {keys_tgt}, SUM(COALESCE(TRY_CAST(\"Order Total\" AS DOUBLE), 0)) v FROM order_amounts "
        "WHERE {nn_t} GROUP BY ALL)"
    )


def reconcile_multi():
    keys = '"Fiscal Year" y, "Fiscal Month" m, "Customer" c'
    nn = '"Fiscal Year" IS NOT NULL AND "Fiscal Month" IS NOT NULL AND "Customer" IS NOT NULL'
    sides = _recon_sides(keys, keys).format(nn_s=nn, nn_t=nn)
    return (C._sql_with(["line_amounts", "order_amounts"])[:-1] + ", " + sides + " " +
            C._kpi_row("line_amounts", C.RECON_MULTI["name"], DV, "Reconciliation Validation",
                       "SELECT COUNT(DISTINCT COALESCE(s.c, t.c)) FILTER (WHERE abs(COALESCE(s.v, 0) - COALESCE(t.v, 0)) > 0.01) "
                       "FROM s FULL OUTER JOIN t ON s.y = t.y AND s.m = t.m AND s.c = t.c"))


def reconcile_tol():
    sides = _recon_sides("orderkey k", "orderkey k").format(nn_s="orderkey IS NOT NULL", nn_t="orderkey IS NOT NULL")
    return (C._sql_with(["line_amounts", "order_amounts"])[:-1] + ", " + sides + " " +
            C._kpi_row("line_amounts", C.RECON_TOL["name"], DV, "Reconciliation Validation",
                       "SELECT COUNT(*) FILTER (WHERE abs(COALESCE(s.v, 0) - COALESCE(t.v, 0)) > 1000) "
                       "FROM s FULL OUTER JOIN t ON s.k = t.k"))


def _cross_value(src, order, where, eq, name, names):
    return (
        C._sql_with(names)[:-1] + ", "
        f"s AS (SELECT k, sv FROM (SELECT conv_id k, {N('role')} sv, row_number() OVER (PARTITION BY conv_id ORDER BY {order}) rn "
        f"FROM {src} {where}) WHERE rn = 1), "
        f"t AS (SELECT conv_id k, MIN({N('first_role')}) tmin, MAX({N('first_role')}) tmax FROM conversation_meta {where} GROUP BY conv_id), "
        "j AS (SELECT s.k sk, s.sv, t.k tk, t.tmin, t.tmax, s.sv IS NOT NULL hs, t.tmin IS NOT NULL ht "
        f"FROM s FULL OUTER JOIN t ON s.k {eq} t.k) "
        + C._kpi_row(src, name, DV, "Cross Sheet Validation",
                     "SELECT COUNT(*) FILTER (WHERE CASE WHEN hs AND ht THEN NOT (tmin = tmax AND tmin = sv) "
                     "WHEN hs THEN sv <> '' ELSE tmax <> '' END) FROM j")
    )


def cross_first():
    return _cross_value("conversations", "turn", "WHERE conv_id IS NOT NULL", "=", C.CROSS_FIRST["name"],
                        ["conversation_meta"])


def cross_nulls():
    return _cross_value("conversations_keys", "_row_no", "", "IS NOT DISTINCT FROM", C.CROSS_NULLS["name"],
                        ["conversations_keys", "conversation_meta"])


def cross_keys():
    return (C._sql_with(["labels_shifted"])[:-1] + ", "
            "a AS (SELECT DISTINCT trim(CAST(doc_id AS VARCHAR)) k FROM documents WHERE doc_id IS NOT NULL), "
            "b AS (SELECT DISTINCT trim(CAST(doc_id AS VARCHAR)) k FROM labels_shifted WHERE doc_id IS NOT NULL) "
            + C._kpi_row("documents", C.CROSS_KEYS["name"], DV, "Cross Sheet Validation",
                         "SELECT COUNT(*) FROM a FULL OUTER JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL"))


def trend_lag():
    return _kpi("orders_dates", C.TREND_LAG["name"], DV, "Trend Validation", ["orders_dates"],
                "SELECT COUNT(*) FILTER (WHERE p IS NOT NULL AND p <> 0 AND abs((v - p) / p * 100) > 30) FROM "
                "(SELECT v, lag(v) OVER (PARTITION BY o_custkey ORDER BY yr, mo) p FROM "
                "(SELECT o_custkey, yr, mo, SUM(COALESCE(o_totalprice, 0)) v FROM orders_dates "
                "WHERE o_custkey IS NOT NULL AND yr IS NOT NULL AND mo IS NOT NULL GROUP BY ALL))")


def trend_two():
    return _kpi("events_trend", C.TREND_TWO["name"], DV, "Trend Validation", ["events_trend"],
                "SELECT COUNT(*) FILTER (WHERE p <> 0 AND abs((v - p) / p * 100) > 30) FROM "
                "(SELECT COALESCE(SUM(value), 0) v, COALESCE(SUM(prev_value), 0) p FROM events_trend "
                "WHERE user_id IS NOT NULL AND FiscalYear IS NOT NULL AND FiscalMonth IS NOT NULL "
                "GROUP BY user_id, FiscalYear, FiscalMonth)")


# ---------------------------------------------------------------------------- cell checks
DATE_RE = "[0-9]{4}-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12][0-9]|0[1-9]|[1-9])"


def check_ok(check: str, v: str, numeric: bool) -> str:
    """DuckDB predicate: value ``v`` passes ``check`` (blank cells excluded by caller)."""
    t = f"trim(CAST({v} AS VARCHAR))"
    if check == "numeric_only":
        return f"regexp_full_match({t}, '[0-9]+')"
    if check == "email":
        return f"regexp_full_match({t}, '[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\\.[a-zA-Z0-9.-]+')"
    if check == "phone_number":
        return f"regexp_full_match({t}, '(\\([0-9]{{3}}\\)\\s?|[0-9]{{3}}[-\\s]?)[0-9]{{3}}[-\\s]?[0-9]{{4}}')"
    if check in ("amount", "number"):
        p = C.COLUMN_CHECKS[check]
        x = f"CAST({v} AS DOUBLE)" if numeric else f"TRY_CAST({v} AS DOUBLE)"
        return f"COALESCE({x} >= {p['min_value']} AND {x} <= {p['max_value']}, FALSE)"
    if check == "date":
        s = f"CAST({v} AS VARCHAR)"
        return f"COALESCE(regexp_full_match({s}, '{DATE_RE}') AND try_strptime({s}, '%Y-%m-%d') IS NOT NULL, FALSE)"
    if check == "text_only":
        return f"regexp_full_match({t}, '[A-Za-z\\s]*')"
    return "TRUE"


def nonblank(v: str, numeric: bool) -> str:
    return f"({v} IS NOT NULL)" if numeric else f"({v} IS NOT NULL AND {v} <> '')"


# column -> numeric? for the derived tables used by cell checks
NUMERIC = {"c_acctbal", "value", "nation_limit", "c_custkey", "event_id", "r_regionkey"}
ERR = {
    "numeric_only": ("numeric", "Non-numeric value in column '{c}'"),
    "email": ("email", "Invalid email in column '{c}'"),
    "phone_number": ("phone_number", "Invalid phone number in column '{c}'"),
    "amount": ("amount", "Invalid amount in column '{c}'"),
    "number": ("number", "Out of range in column '{c}'"),
    "date": ("date", "Invalid date in column '{c}'"),
    "text_only": ("text_only", "Non-text value in column '{c}'"),
}


def failed_cells_sql(sheet, column, check, with_clause=True):
    num = column in NUMERIC
    label, msg = ERR[check]
    body = (f"SELECT '{sheet}' AS sheet_name, '{column}' AS field, CAST(_row_no + 2 AS BIGINT) AS row, "
            f"CAST({column} AS VARCHAR) AS value, '{check}' AS validation_type, '{label}' AS required_datatype, "
            f"'{msg.format(c=column).replace(chr(39), chr(39) * 2)}' AS error_message FROM {sheet} "
            f"WHERE {nonblank(column, num)} AND NOT {check_ok(check, column, num)}")
    return (C._sql_with([sheet]) + body) if with_clause else body


def cell_summary_sql(sheet, column, check):
    num = column in NUMERIC
    nb = nonblank(column, num)
    ok = check_ok(check, column, num) if check in ERR else "TRUE"
    return (f"SELECT '{sheet}' AS sheet_name, '{column}' AS field, 'Data Validation' AS test_type, "
            f"'{check}' AS test_name, CASE WHEN f = 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
            f"CAST(f AS BIGINT) AS failed_count, CAST(t AS BIGINT) AS total_checked, CAST(t - f AS BIGINT) AS passed_count "
            f"FROM (SELECT COUNT(*) FILTER (WHERE {nb}) t, COUNT(*) FILTER (WHERE {nb} AND NOT {ok}) f FROM {sheet})")


def _field_plan():
    present = {"customer_text", "orders_dates", "events_cells"}
    rows_exist, rows_data, cols_of = [], [], {
        "customer_text": ["c_custkey", "cust_id", "email", "phone", "c_acctbal", "segment", "balance_text", "nation_limit"],
        "orders_dates": ["o_orderkey", "o_custkey", "order_date_text", "date_text", "yr", "mo", "o_totalprice"],
        "events_cells": ["event_id", "value", "user_text", "event_type"],
    }
    for sheet, fmap in C.FIELDS.items():
        if sheet not in present:
            continue
        for column, checks in fmap.items():
            ok = column in cols_of[sheet]
            rows_exist.append((sheet, column, ok))
            if ok:
                for chk in checks:
                    if chk in C.FIELD_CONFIG["column_checks"]:
                        rows_data.append((sheet, column, chk))
    return rows_exist, rows_data


def field_summary():
    exist, data = _field_plan()
    parts = [required_tables()]
    for sheet, column, ok in exist:
        parts.append(_lit(sheet, column, "Field Validation", "Field Existence Testing", 0 if ok else 1, "fields"))
    for sheet, column, chk in data:
        parts.append(cell_summary_sql(sheet, column, chk))
    return C._sql_with(["customer_text", "orders_dates", "events_cells"]) + " UNION ALL ".join(
        f"SELECT * FROM ({p})" for p in parts)


def field_failed():
    _, data = _field_plan()
    parts = [failed_cells_sql(s, c, k, False) for s, c, k in data if k in ERR]
    return C._sql_with(["customer_text", "orders_dates", "events_cells"]) + " UNION ALL ".join(
        f"SELECT * FROM ({p})" for p in parts)


def _exec(summary_sql, rows_sql, inferred):
    metrics = [
        ("Total Sheets", "COUNT(*) FILTER (WHERE test_name = 'Sheet Existence Testing')"),
        ("Sheets Passed", "COUNT(*) FILTER (WHERE test_name = 'Sheet Existence Testing' AND status = 'PASS')"),
        ("Sheets Failed", "COUNT(*) FILTER (WHERE test_name = 'Sheet Existence Testing' AND status = 'FAIL')"),
    ]
    if inferred:
        metrics += [
            ("Total Columns Discovered", "COUNT(*) FILTER (WHERE test_type = 'Rule Determination')"),
            ("Total Columns Recognized", "COUNT(*) FILTER (WHERE test_type = 'Rule Determination' AND status = 'PASS')"),
            ("Total Columns Unrecognized", "COUNT(*) FILTER (WHERE test_type = 'Rule Determination' AND status = 'SKIPPED')"),
        ]
    metrics += [
        ("Total Rows Processed", f"({rows_sql})"),
        ("Total Validations Executed", "COUNT(*)"),
        ("Total Passed", "COUNT(*) FILTER (WHERE status = 'PASS')"),
        ("Total Failed", "COUNT(*) FILTER (WHERE status = 'FAIL')"),
    ]
    if inferred:
        metrics.append(("Total Skipped", "COUNT(*) FILTER (WHERE status = 'SKIPPED')"))
    metrics.append(("Total Failed Cells", "COALESCE(SUM(failed_count) FILTER (WHERE test_type = 'Data Validation'), 0)"))
    metrics.append(("Execution Status", "CASE WHEN COUNT(*) FILTER (WHERE test_name = 'Sheet Existence Testing' "
                                         "AND status = 'FAIL') = 0 THEN 'SUCCESS' ELSE 'COMPLETED WITH FAILURES' END"))
    sel = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST({e} AS VARCHAR) AS value" if e.startswith("(SELECT") else
        f"SELECT '{m}' AS metric, CAST({e} AS VARCHAR) AS value FROM s" for m, e in metrics)
    return f"WITH s AS ({summary_sql}) {sel}"


def exec_explicit():
    return _exec(field_summary(), "SELECT (SELECT COUNT(*) FROM customer) + (SELECT COUNT(*) FROM orders) + "
                                  "(SELECT COUNT(*) FROM events)", False)


# ---------------------------------------------------------------------------- inference
INFER_COLUMNS = {
    "customer_text": ["c_custkey", "cust_id", "email", "phone", "c_acctbal", "segment", "balance_text", "nation_limit"],
    "region": ["r_regionkey", "r_name"],
    "events_cells": ["event_id", "value", "user_text", "event_type"],
}
PRIORITY = ["email", "phone_number", "date", "amount", "number", "numeric_only", "text_only"]


def _winner_sql(sheet, column):
    num = column in NUMERIC
    rates = ", ".join(f"CAST(COUNT(*) FILTER (WHERE {check_ok(k, 'v', num)}) AS DOUBLE) / NULLIF(COUNT(*), 0) AS r{i}"
                      for i, k in enumerate(PRIORITY))
    sample = (f"SELECT {column} AS v FROM {sheet} WHERE {nonblank(column, num)}")
    winner = "CASE " + " ".join(f"WHEN r{i} >= 0.6 THEN '{k}'" for i, k in enumerate(PRIORITY)) + " END"
    best = f"greatest({', '.join(f'r{i}' for i in range(len(PRIORITY)))})"
    return (f"SELECT '{sheet}' AS sheet_name, '{column}' AS field, n, {winner} AS winner, {best} AS best "
            f"FROM (SELECT COUNT(*) n, {rates} FROM ({sample}))")


def _infer_names():
    return ["customer_text", "events_cells"]


def _determination_sql():
    parts = []
    for sheet, cols in INFER_COLUMNS.items():
        for c in cols:
            parts.append(_winner_sql(sheet, c))
    return " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


def infer_rules(with_clause=True):
    body = (f"SELECT sheet_name, field, 'Rule Determination' AS test_type, "
            "CASE WHEN n = 0 THEN 'Unrecognized (no data)' WHEN winner IS NOT NULL THEN winner "
            "ELSE 'Unrecognized (best match ' || CAST(CAST(round_even(best * 100, 0) AS INTEGER) AS VARCHAR) || '%)' END AS test_name, "
            "CASE WHEN winner IS NOT NULL AND n > 0 THEN 'PASS' ELSE 'SKIPPED' END AS status, CAST(0 AS BIGINT) AS failed_count, "
            "CAST(NULL AS BIGINT) AS total_checked, CAST(NULL AS BIGINT) AS passed_count "
            f"FROM ({_determination_sql()})")
    return (C._sql_with(_infer_names()) + body) if with_clause else body


def _infer_data_sql():
    parts = []
    for sheet, cols in INFER_COLUMNS.items():
        for c in cols:
            num = c in NUMERIC
            nb = nonblank(c, num)
            w = f"(SELECT winner FROM ({_winner_sql(sheet, c)}))"
            fails = " ".join(f"WHEN '{k}' THEN COUNT(*) FILTER (WHERE {nb} AND NOT {check_ok(k, c, num)})" for k in PRIORITY)
            parts.append(
                f"SELECT '{sheet}' AS sheet_name, '{c}' AS field, 'Data Validation' AS test_type, w AS test_name, "
                "CASE WHEN f = 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(f AS BIGINT) AS failed_count, "
                "CAST(t AS BIGINT) AS total_checked, CAST(t - f AS BIGINT) AS passed_count FROM "
                f"(SELECT {w} AS w, COUNT(*) FILTER (WHERE {nb}) t, CASE {w} {fails} END f FROM {sheet}) WHERE w IS NOT NULL")
    return " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


def _infer_sheet_rows():
    rows = []
    for sheet, rules in C.INFER_CONFIG["sheet_checks"].items():
        present = sheet in C.INFER_TABLES
        st = "PASS" if present else ("FAIL" if (rules or {}).get("required", True) else "SKIPPED")
        rows.append(f"SELECT '{sheet}' AS sheet_name, 'Sheet' AS field, 'Sheet Validation' AS test_type, "
                    f"'Sheet Existence Testing' AS test_name, '{st}' AS status, "
                    f"CAST({1 if st == 'FAIL' else 0} AS BIGINT) AS failed_count, CAST(NULL AS BIGINT) AS total_checked, "
                    "CAST(NULL AS BIGINT) AS passed_count")
    return " UNION ALL ".join(rows)


def infer_validate():
    return (C._sql_with(_infer_names()) + f"SELECT * FROM ({_infer_sheet_rows()}) UNION ALL SELECT * FROM "
            f"({infer_rules(False)}) UNION ALL SELECT * FROM ({_infer_data_sql()})")


def exec_inferred():
    summary = infer_validate()
    rows = ("SELECT COALESCE(SUM(n), 0) FROM (" + " UNION ALL ".join(
        f"SELECT (SELECT COUNT(*) FROM {base}) n FROM (SELECT 1) WHERE EXISTS (SELECT 1 FROM s "
        f"WHERE sheet_name = '{sheet}' AND test_type = 'Rule Determination' AND status = 'PASS')"
        for sheet, base in (("customer_text", "customer"), ("region", "region"), ("events_cells", "events"))) + ")")
    return _exec(summary, rows, True)


# ---------------------------------------------------------------------------- full KPI run
def run_kpi_ruleset():
    parts = [
        table_existence(), column_existence(),
        _dup(C.DUP_SINGLE, []), _dup(C.DUP_MULTI, []), _dup(C.DUP_NULLS, ["orders_keys"]),
        _lit("orders", "O_CUSTKEY", DQ, "Duplicate Check", 1),
        null_check(), _lit("ghost", "Sheet", DQ, "Null Check", 1),
        formula_rows(), formula_cmp_rows(), formula_cmp_grouped(),
        _lit("lineitem", "bad formula", DQ, "Formula Validation", 1),
        precision(C.PREC_RAW["columns"]),
        rule_dates(), rule_numbers(), rule_stale(), rule_lookup(),
        _lit("customer_text", "bad operator", DV, "Business Rule Validation", 1),
        reconcile_multi(), reconcile_tol(), cross_first(), cross_keys(),
        trend_lag(), trend_two(), _lit("orders", "nope, x, PracticeCode", DV, "Trend Validation", 3),
    ]
    return " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


def kpi_by_input():
    sides = _recon_sides('"Fiscal Year" y, "Fiscal Month" m, "Customer" c', '"Fiscal Year" y, "Fiscal Month" m, "Customer" c').format(
        nn_s='"Fiscal Month" IS NOT NULL AND "Customer" IS NOT NULL', nn_t='"Fiscal Month" IS NOT NULL AND "Customer" IS NOT NULL')
    row = lambda sheet, fld, tt, tn, n, rest: (
        f"SELECT CAST(i.y AS VARCHAR) AS source_file, '{sheet}' AS sheet_name, '{fld}' AS field, '{tt}' AS test_type, '{tn}' AS test_name, "
        f"CASE WHEN {n} = 0 THEN 'P' ELSE 'F' END AS status, CAST({n} AS BIGINT) AS failed_count FROM inputs i {rest}")
    off = f"COUNT(DISTINCT r.c) FILTER (WHERE abs(r.sv - r.tv) > {C.INPUT_RECON['tolerance']})"
    return (C._sql_with(["line_amounts", "order_amounts"])[:-1] + ", " + sides + ", "
            'inputs AS (SELECT DISTINCT "Fiscal Year" y FROM order_amounts WHERE "Fiscal Year" IS NOT NULL UNION SELECT "Fiscal Year" FROM line_amounts WHERE "Fiscal Year" IS NOT NULL), '
            "r AS (SELECT COALESCE(s.y, t.y) y, COALESCE(s.c, t.c) c, COALESCE(s.v, 0) sv, COALESCE(t.v, 0) tv "
            "FROM s FULL OUTER JOIN t ON s.y = t.y AND s.m = t.m AND s.c = t.c), "
            'a AS (SELECT DISTINCT "Fiscal Year" y, "Customer" c FROM line_amounts WHERE "Customer" IS NOT NULL), '
            'b AS (SELECT DISTINCT "Fiscal Year" y, "Customer" c FROM order_amounts WHERE "Customer" IS NOT NULL AND "Order Total" > 100000), '
            "k AS (SELECT COALESCE(a.y, b.y) y FROM a FULL OUTER JOIN b ON a.y = b.y AND a.c = b.c WHERE a.c IS NULL OR b.c IS NULL) "
            + " UNION ALL ".join([
                row("line_amounts", "Sheet", "Sheet Validation", "Sheet Existence Testing", "0", ""),
                row("warehouse", "Sheet", "Sheet Validation", "Sheet Existence Testing", "1", ""),
                row("line_amounts", C.INPUT_RECON["name"], DV, "Reconciliation Validation", off, "LEFT JOIN r ON r.y = i.y GROUP BY i.y"),
                row("line_amounts", C.INPUT_KEYS["name"], DV, "Cross Sheet Validation", "COUNT(k.y)", "LEFT JOIN k ON k.y = i.y GROUP BY i.y")]))


def batch_by_file():
    files = {"customer.parquet": ("customer", {"c_acctbal", "c_name"}),
             "supplier.parquet": ("supplier", {"s_acctbal", "s_name"})}
    nul = "CAST(NULL AS VARCHAR) AS source_file, "
    parts = [nul + "'accounts' AS sheet_name, 'Sheet' AS field, 'Sheet Validation' AS test_type, "
             "'Sheet Existence Testing' AS test_name, 'PASS' AS status, CAST(0 AS BIGINT) AS failed_count, "
             "CAST(NULL AS BIGINT) AS total_checked, CAST(NULL AS BIGINT) AS passed_count"]
    present = {"c_acctbal", "c_name", "s_acctbal", "s_name"}
    for column in C.BATCH_FIELDS:
        ok = column in present
        parts.append(nul + f"'accounts', '{column}', 'Field Validation', 'Field Existence Testing', "
                     f"'{'PASS' if ok else 'FAIL'}', CAST({0 if ok else 1} AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)")
    for column, checks in C.BATCH_FIELDS.items():
        if column not in present:
            continue
        for check in checks:
            for fname, (table, cols) in files.items():
                if column in cols:
                    num = column.endswith("acctbal")
                    nb = nonblank(column, num)
                    counts = (f"SELECT COUNT(*) FILTER (WHERE {nb}) t, "
                              f"COUNT(*) FILTER (WHERE {nb} AND NOT {check_ok(check, column, num)}) f FROM {table}")
                else:
                    counts = "SELECT 0 t, 0 f"
                parts.append(f"'{fname}' AS source_file, 'accounts', '{column}', 'Data Validation', '{check}', "
                             "CASE WHEN f = 0 THEN 'PASS' ELSE 'FAIL' END, CAST(f AS BIGINT), CAST(t AS BIGINT), "
                             f"CAST(t - f AS BIGINT) FROM ({counts})")
    return " UNION ALL ".join(f"SELECT {p}" for p in parts)


def required_tables_catalog():
    rows = ", ".join(f"('{t}', {str((r or {}).get('required', True)).upper()}, {i})"
                     for i, (t, r) in enumerate(C.REQUIRED_CHECKS.items()))
    return (
        f"SELECT e.name AS sheet_name, 'Sheet' AS field, 'Sheet Validation' AS test_type, "
        "'Sheet Existence Testing' AS test_name, "
        "CASE WHEN t.table_name IS NOT NULL THEN 'PASS' WHEN e.req THEN 'FAIL' ELSE 'SKIPPED' END AS status, "
        "CAST(CASE WHEN t.table_name IS NULL AND e.req THEN 1 ELSE 0 END AS BIGINT) AS failed_count, "
        "CAST(NULL AS BIGINT) AS total_checked, CAST(NULL AS BIGINT) AS passed_count "
        f"FROM (VALUES {rows}) e(name, req, ord) "
        "LEFT JOIN (SELECT DISTINCT table_name FROM information_schema.tables "
        "WHERE table_name IN ('orders', 'customer', 'events')) t ON t.table_name = e.name"
    )


def stream_counts():
    parts = []
    for column, checks in C.STREAM_FIELDS.items():
        num = column in NUMERIC
        nb = nonblank(column, num)
        for check in checks:
            parts.append(f"SELECT 'events_cells' AS sheet_name, '{column}' AS field, '{check}' AS test_name, "
                         f"CAST(COUNT(*) FILTER (WHERE {nb}) AS BIGINT) AS total_checked, "
                         f"CAST(COUNT(*) FILTER (WHERE {nb} AND NOT {check_ok(check, column, num)}) AS BIGINT) "
                         "AS failed_count FROM events_cells")
    return C._sql_with(["events_cells"]) + " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


def field_existence():
    rows = []
    for sheet, fmap in C.FIELD_EXIST.items():
        if sheet == "ledger":
            continue
        for column in fmap:
            rows.append(f"('{sheet}', '{column}')")
    return (
        f"SELECT e.sheet AS sheet_name, e.col AS field, 'Field Validation' AS test_type, "
        "'Field Existence Testing' AS test_name, CASE WHEN c.column_name IS NULL THEN 'FAIL' ELSE 'PASS' END AS status, "
        "CAST(CASE WHEN c.column_name IS NULL THEN 1 ELSE 0 END AS BIGINT) AS failed_count, "
        "CAST(NULL AS BIGINT) AS total_checked, CAST(NULL AS BIGINT) AS passed_count "
        f"FROM (VALUES {', '.join(rows)}) e(sheet, col) "
        "LEFT JOIN (SELECT DISTINCT table_name, column_name FROM information_schema.columns) c "
        "ON c.table_name = e.sheet AND c.column_name = e.col"
    )


def precision_formats():
    parts = []
    for column in C.PREC_FORMATS["columns"]:
        if column == "price_text":  # text cells are skipped when cell formats are known
            parts.append(_lit("orders_precision", column, DQ, "Numeric Precision", 0))
            continue
        fmt = f"({C.FORMAT_EXPRS[column]})"
        section = f"split_part({fmt}, ';', 1)"
        places = (f"(CASE WHEN {fmt} IS NULL OR {fmt} = '' OR {fmt} = 'General' THEN NULL "
                  f"WHEN position('.' IN {section}) = 0 THEN 0 "
                  f"ELSE length(regexp_extract({section}, '^.*\\.([0#]*)', 1)) END)")
        v = f"CAST({column} AS DOUBLE)"
        fail = f"({v} IS NOT NULL AND (CASE WHEN {places} IS NOT NULL THEN {places} > 2 ELSE {_prec_fail(v)} END))"
        parts.append(_wrap(_kpi("orders_precision", column, DQ, "Numeric Precision", ["orders_precision"],
                                f"SELECT SUM(CASE WHEN {fail} THEN 1 ELSE 0 END) FROM orders_precision")))
    return " UNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    return {
        "precision_formats": precision_formats(),
        "duplicate_single": _dup(C.DUP_SINGLE, []),
        "duplicate_multi": _dup(C.DUP_MULTI, []),
        "duplicate_null_keys": _dup(C.DUP_NULLS, ["orders_keys"]),
        "null_check": null_check(),
        "formula_threshold_rows": formula_rows(),
        "formula_threshold_grouped": formula_grouped(),
        "formula_comparison_grouped": formula_cmp_grouped(),
        "formula_comparison_rows": formula_cmp_rows(),
        "formula_typed": formula_typed(),
        "precision_raw": precision(C.PREC_RAW["columns"]),
        "precision_all_numeric": precision(["o_orderkey", "price_7th", "o_totalprice"]),
        "rule_compare_dates": rule_dates(),
        "rule_compare_numbers": rule_numbers(),
        "rule_stale": rule_stale(),
        "rule_local_dates": rule_local_dates(),
        "rule_lookup_match": rule_lookup(False),
        "rule_lookup_null_keys": rule_lookup(True),
        "reconcile_multi_key": reconcile_multi(),
        "reconcile_tolerance": reconcile_tol(),
        "cross_value_first_row": cross_first(),
        "cross_value_null_keys": cross_nulls(),
        "cross_key_difference": cross_keys(),
        "trend_lag": trend_lag(),
        "trend_two_columns": trend_two(),
        "cell_numeric_only": failed_cells_sql("customer_text", "cust_id", "numeric_only"),
        "cell_email": failed_cells_sql("customer_text", "email", "email"),
        "cell_phone": failed_cells_sql("customer_text", "phone", "phone_number"),
        "cell_amount": failed_cells_sql("customer_text", "c_acctbal", "amount"),
        "cell_number": failed_cells_sql("events_cells", "value", "number"),
        "cell_date": failed_cells_sql("orders_dates", "date_text", "date"),
        "cell_text_only": failed_cells_sql("customer_text", "segment", "text_only"),
        "field_summary": field_summary(),
        "field_failed_records": field_failed(),
        "exec_summary_explicit": exec_explicit(),
        "infer_rules": infer_rules(),
        "infer_and_validate": infer_validate(),
        "exec_summary_inferred": exec_inferred(),
        "run_kpi_ruleset": run_kpi_ruleset(),
        "batch_by_file": batch_by_file(),
        "kpi_by_input": kpi_by_input(),
        "stream_cell_counts": stream_counts(),
    }

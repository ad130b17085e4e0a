"""Checked queries over the benchmark tables: Spark plan + DuckDB oracle SQL.

Every query reads whole tables of a data directory. Blanks, drifts and odd
texts are injected by SQL expressions that are valid in BOTH Spark SQL
(``selectExpr``) and DuckDB, so the two engines see the same inputs. Row
order is the physical order of the Parquet file (``_metadata.row_index``);
oracles that depend on row order only use tables stored in key order
(``orders``, ``customer``, ``events``, ``conversations``, ``region``).
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import business, cells, crosstable, infer, quality, trend
from .operators.base import CONFIGURATION
from .plans.engine import run_fields, run_inferred, run_kpi, run_kpi_inputs
from .plans.planner import materialize, summary_columns
from .sources.sets import InputSets
from .sources.tables import FILE, ROW_NO, TableSet

# physical sort key of the tables used for row-order dependent checks
ORDER_KEYS = {
    "orders": "o_orderkey",
    "customer": "c_custkey",
    "events": "event_id",
    "conversations": "conv_id, turn",
    "region": "r_regionkey",
    "nation": "n_nationkey",
    "documents": "doc_id",
    "labels": "doc_id",
}

# ---------------------------------------------------------------------------- derived tables
_MONTH_NAME = "substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(month(o_orderdate) * 3 - 2 AS INT), 3)"
# name -> (base table, [SQL expressions valid in Spark SQL and DuckDB])
DERIVED: dict[str, tuple[str, list[str]]] = {
    "orders_keys": ("orders", [
        "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS cust",
        "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS status",
    ]),
    "orders_blank": ("orders", [
        "o_orderkey",
        "CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN '' "
        "WHEN o_orderkey % 83 = 0 THEN '   ' ELSE o_orderpriority END AS priority",
        "CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus",
    ]),
    "orders_parts": ("orders", [
        "o_orderkey",
        "o_totalprice * 0.25 AS part_a",
        "o_totalprice - o_totalprice * 0.25 AS part_b",
        "CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN o_totalprice + 0.01 "
        "ELSE o_totalprice END AS total",
    ]),
    "orders_wide": ("orders", [  # whole numbers beyond 2^53 and decimals
        "o_orderkey",
        "o_custkey AS cust",
        "o_custkey + 9007199254740992 AS big",
        "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS part",
        "CASE WHEN o_orderkey % 7 = 0 THEN 9007199254740993 ELSE 9007199254740992 END AS base",
        "o_orderkey % 5 AS fives",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS price",
        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 13 = 0 THEN 0.01 ELSE 0.00 END AS DECIMAL(18,2)) AS price_due",
    ]),
    "orders_precision": ("orders", [
        "o_orderkey",
        "o_totalprice / 7 AS price_7th",
        "o_totalprice",
        "CAST(o_totalprice AS STRING) AS price_text",
    ]),
    "orders_dates": ("orders", [
        "o_orderkey",
        "o_custkey",
        "CASE WHEN o_orderkey % 23 = 0 THEN 'null' WHEN o_orderkey % 29 = 0 THEN NULL "
        "ELSE concat(CAST(year(o_orderdate) AS STRING), '-', lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '-', "
        "lpad(CAST(day(o_orderdate) AS STRING), 2, '0')) END AS order_date_text",
        "CASE WHEN o_orderkey % 10 = 0 THEN concat(CAST(year(o_orderdate) AS STRING), '/', "
        "lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '/', lpad(CAST(day(o_orderdate) AS STRING), 2, '0')) "
        "WHEN o_orderkey % 10 = 1 THEN concat(CAST(year(o_orderdate) AS STRING), '-', CAST(month(o_orderdate) AS STRING), "
        "'-', CAST(day(o_orderdate) AS STRING)) "
        "WHEN o_orderkey % 10 = 2 THEN concat(CAST(year(o_orderdate) AS STRING), '-02-30') "
        "WHEN o_orderkey % 10 = 3 THEN '' "
        "ELSE concat(CAST(year(o_orderdate) AS STRING), '-', lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '-', "
        "lpad(CAST(day(o_orderdate) AS STRING), 2, '0')) END AS date_text",
        "year(o_orderdate) AS yr",
        "month(o_orderdate) AS mo",
        "o_totalprice",
    ]),
    "orders_local_dates": ("orders", [  # dates in local text forms
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        "CASE WHEN o_orderkey % 10 = 3 THEN concat(CAST(year(o_orderdate) AS STRING), '-', lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '-', "
        "lpad(CAST(day(o_orderdate) AS STRING), 2, '0')) WHEN o_orderkey % 10 = 7 THEN concat('31-Feb-', CAST(year(o_orderdate) AS STRING)) "
        "ELSE concat(CAST(day(o_orderdate) AS STRING), '-', " + _MONTH_NAME + ", '-', CAST(year(o_orderdate) AS STRING)) END AS local_date",
        "CASE o_orderkey % 7 WHEN 0 THEN concat(CAST(year(o_orderdate) AS STRING), '.', CAST(month(o_orderdate) AS STRING), '.', CAST(day(o_orderdate) AS STRING)) "
        "WHEN 1 THEN concat(" + _MONTH_NAME + ", ' ', CAST(day(o_orderdate) AS STRING), ', ', CAST(year(o_orderdate) AS STRING)) "
        "WHEN 2 THEN concat(CAST(year(o_orderdate) AS STRING), lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), lpad(CAST(day(o_orderdate) AS STRING), 2, '0')) "
        "WHEN 3 THEN concat(CAST(month(o_orderdate) AS STRING), '/', CAST(day(o_orderdate) AS STRING), '/', CAST(year(o_orderdate) AS STRING)) "
        "WHEN 4 THEN concat(CAST(day(o_orderdate) AS STRING), ' ', " + _MONTH_NAME + ", ' ', CAST(year(o_orderdate) AS STRING), ' 10:30') "
        "WHEN 5 THEN concat('30 ', 'Feb', ' ', CAST(year(o_orderdate) AS STRING)) "
        "ELSE concat(CAST(year(o_orderdate) AS STRING), '-', lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '-', lpad(CAST(day(o_orderdate) AS STRING), 2, '0')) END AS any_date",
    ]),
    "customer_text": ("customer", [
        "c_custkey",
        "CASE WHEN c_custkey % 13 = 0 THEN concat(CAST(c_custkey AS STRING), 'A') WHEN c_custkey % 17 = 0 THEN '' "
        "WHEN c_custkey % 19 = 0 THEN concat(' ', CAST(c_custkey AS STRING), ' ') "
        "ELSE CAST(c_custkey AS STRING) END AS cust_id",
        "CASE WHEN c_custkey % 11 = 0 THEN replace(lower(c_name), '#', '@') WHEN c_custkey % 31 = 0 THEN NULL "
        "ELSE concat(replace(lower(c_name), '#', '.'), '@example.com') END AS email",
        "CASE WHEN c_custkey % 9 = 0 THEN concat('(', substr(lpad(CAST(c_custkey * 7919 AS STRING), 10, '0'), 1, 3), ') ', "
        "substr(lpad(CAST(c_custkey * 7919 AS STRING), 10, '0'), 4, 3), '-', "
        "substr(lpad(CAST(c_custkey * 7919 AS STRING), 10, '0'), 7, 4)) "
        "WHEN c_custkey % 10 = 0 THEN substr(lpad(CAST(c_custkey * 7919 AS STRING), 10, '0'), 1, 9) "
        "ELSE concat(substr(lpad(CAST(c_custkey * 7919 AS STRING), 10, '0'), 1, 3), '-', "
        "substr(lpad(CAST(c_custkey * 7919 AS STRING), 10, '0'), 4, 3), '-', "
        "substr(lpad(CAST(c_custkey * 7919 AS STRING), 10, '0'), 7, 4)) END AS phone",
        "c_acctbal",
        "CASE WHEN c_custkey % 7 = 0 THEN concat(c_mktsegment, '1') WHEN c_custkey % 5 = 0 "
        "THEN concat(' ', lower(c_mktsegment), ' ') ELSE c_mktsegment END AS segment",
        "CASE WHEN c_custkey % 31 = 0 THEN 'n/a' WHEN c_custkey % 37 = 0 THEN NULL "
        "ELSE CAST(c_acctbal AS STRING) END AS balance_text",
        "c_nationkey * 400.0 AS nation_limit",
    ]),
    "conversations_keys": ("conversations", [
        "CASE WHEN conv_id % 9 = 0 THEN NULL ELSE conv_id END AS conv_id",
        "role",
    ]),
    "labels_shifted": ("labels", [
        "CASE WHEN doc_id % 2 = 0 THEN doc_id + 3 ELSE doc_id END AS doc_id",
        "quality",
    ]),
    "events_trend": ("events", [
        "user_id",
        "year(ts) AS FiscalYear",
        "month(ts) AS FiscalMonth",
        "value",
        "CASE WHEN event_id % 11 = 0 THEN NULL ELSE value * (0.5 + (event_id % 10) * 0.1) END AS prev_value",
    ]),
    "events_cells": ("events", [
        "event_id",
        "value",
        "CAST(user_id AS STRING) AS user_text",
        "event_type",
    ]),
}

# derived tables that need a join: name -> (Spark builder, DuckDB SQL)
JOINED_SQL = {
    "order_lines": (
        "SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, "
        "CASE WHEN l.l_orderkey % 17 = 0 THEN 'not applicable' WHEN l.l_orderkey % 19 = 0 THEN NULL "
        "ELSE concat(CAST(year(o.o_orderdate) AS STRING), '-', lpad(CAST(month(o.o_orderdate) AS STRING), 2, '0'), '-', "
        "lpad(CAST(day(o.o_orderdate) AS STRING), 2, '0')) END AS order_date, l.l_shipdate "
        "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"
    ),
    "customer_nation": (
        "SELECT CASE WHEN c.c_custkey % 41 = 0 THEN NULL WHEN c.c_custkey % 43 = 0 THEN c.c_nationkey + 100 "
        "ELSE c.c_nationkey END AS nation_key, "
        "CASE WHEN c.c_custkey % 19 = 0 THEN 'ATLANTIS' WHEN c.c_custkey % 29 = 0 THEN NULL "
        "WHEN c.c_custkey % 7 = 0 THEN concat(' ', lower(n.n_name)) ELSE n.n_name END AS nation_label "
        "FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"
    ),
    "line_amounts": (
        "SELECT year(o.o_orderdate) AS \"Fiscal Year\", month(o.o_orderdate) AS \"Fiscal Month\", "
        "o.o_custkey AS \"Customer\", l.l_extendedprice AS \"Line Amount\", l.l_orderkey AS orderkey "
        "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"
    ),
    "order_amounts": (
        "SELECT year(o_orderdate) AS \"Fiscal Year\", month(o_orderdate) AS \"Fiscal Month\", "
        "o_custkey AS \"Customer\", o_totalprice AS \"Order Total\", o_orderkey AS orderkey FROM orders"
    ),
    "conversation_meta": (
        "SELECT conv_id, CASE WHEN turn = 1 AND conv_id % 4 = 0 THEN 'ASSISTANT' ELSE 'User ' END AS first_role "
        "FROM conversations "
        "UNION ALL SELECT conv_id + 100000 AS conv_id, CASE WHEN conv_id % 2 = 0 THEN '' ELSE 'user' END AS first_role "
        "FROM conversations"
    ),
}


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(d, f"{name}.parquet"))
    return df.select("*", F.col("_metadata.row_index").alias(ROW_NO), F.col("_metadata.file_path").alias(FILE))


def tables(spark: SparkSession, d: str, names: list[str]) -> TableSet:
    """TableSet over base and derived tables of data directory ``d``."""
    ts = TableSet(spark)
    base_cache: dict[str, DataFrame] = {}

    def base(name):
        if name not in base_cache:
            base_cache[name] = _read(spark, d, name)
        return base_cache[name]

    for name in names:
        if name in DERIVED:
            src, exprs = DERIVED[name]
            ts.add_frame(name, base(src).selectExpr(ROW_NO, FILE, *exprs), order_col=ROW_NO)
        elif name in JOINED_SQL:
            ts.add_frame(name, _joined(spark, d, name))
        else:
            ts.add_path(name, os.path.join(d, f"{name}.parquet"))
    return ts


_BASES = ("lineitem", "orders", "customer", "nation", "conversations")


def _joined(spark: SparkSession, d: str, name: str) -> DataFrame:
    """Spark side of a joined derivation: the same SQL, run over private temp
    views of the base tables of ``d`` (names, not data copies; named so they
    never collide with a caller's views)."""
    tag = "rc_" + format(abs(hash(os.path.abspath(d))) % (1 << 40), "x")
    for t in _BASES:
        if not spark.catalog.tableExists(f"{tag}_{t}"):
            spark.read.parquet(os.path.join(d, f"{t}.parquet")).createOrReplaceTempView(f"{tag}_{t}")
    sql = re.sub(r"\b(" + "|".join(_BASES) + r")\b", lambda m: f"{tag}_{m.group(1)}", JOINED_SQL[name])
    return spark.sql(sql.replace('"', "`"))


def _sql_with(names: list[str]) -> str:
    parts = []
    for n in names:
        if n in DERIVED:
            src, exprs = DERIVED[n]
            key = ORDER_KEYS.get(src)
            rn = f"row_number() OVER (ORDER BY {key}) - 1 AS _row_no, " if key else ""
            parts.append(f"{n} AS (SELECT {rn}{', '.join(exprs)} FROM {src})")
        elif n in JOINED_SQL:
            parts.append(f"{n} AS ({JOINED_SQL[n]})")
    return ("WITH " + ",\n".join(parts) + "\n") if parts else ""


def _summary(spark: SparkSession, outcomes, style: str = "kpi") -> DataFrame:
    return materialize(spark, outcomes, style).select(*summary_columns(style))


def _kpi_row(sheet: str, field: str, test_type: str, test_name: str, count_sql: str) -> str:
    return (
        f"SELECT '{sheet}' AS sheet_name, '{field}' AS field, '{test_type}' AS test_type, '{test_name}' AS test_name, "
        f"CASE WHEN n = 0 THEN 'P' ELSE 'F' END AS status, CAST(n AS BIGINT) AS failed_count "
        f"FROM (SELECT COALESCE(({count_sql}), 0) AS n) q"
    )


def _distinct_count(key: str, fail: str) -> str:
    """DuckDB: distinct keys among failing rows, a NULL key counting once."""
    return (f"COUNT(DISTINCT CASE WHEN {fail} THEN {key} END) + "
            f"COALESCE(MAX(CASE WHEN ({fail}) AND {key} IS NULL THEN 1 ELSE 0 END), 0)")


def _norm(x: str) -> str:
    return f"lower(trim(COALESCE(CAST({x} AS VARCHAR), '')))"


DQ, DV = "Data Quality Validation", "Data Validation"

# ---------------------------------------------------------------------------- rule definitions
DUP_SINGLE = {"sheetname": "orders", "columns": ["o_custkey"]}
DUP_MULTI = {"sheetname": "lineitem", "columns": ["l_orderkey", "l_linenumber"]}
DUP_NULLS = {"sheetname": "orders_keys", "columns": ["cust", "status"]}
NULLS = {"sheetname": "orders_blank", "columns": ["priority", "o_orderstatus", "o_comment"]}
F_ROWS = {"name": "tax to discount", "sheetname": "lineitem", "validationtype": "threshold",
          "formula": "(l_tax / l_discount) * 100", "threshold": 100, "operator": "<="}
F_GROUPED = {"name": "order tax to discount", "sheetname": "lineitem", "validationtype": "threshold",
             "formula": "(l_tax / l_discount) * 100", "threshold": 100, "operator": "<=", "aggregate": True,
             "groupbycolumns": ["l_orderkey"], "sourcecolumns": ["l_tax", "l_discount"]}
F_CMP_GROUPED = {"name": "parts add up per customer", "sheetname": "orders_parts", "validationtype": "comparison",
                 "formula": "part_a + part_b", "sourcecolumns": ["part_a", "part_b"], "targetcolumn": "total",
                 "aggregate": True, "groupbycolumns": ["o_orderkey"]}
F_CMP_ROWS = {"name": "parts add up", "sheetname": "orders_parts", "validationtype": "comparison",
              "formula": "part_a + part_b", "sourcecolumns": ["part_a", "part_b"], "targetcolumn": "total"}
_WIDE = {"sheetname": "orders_wide", "validationtype": "threshold"}
_WIDE_PARTS = {"sheetname": "orders_wide", "validationtype": "comparison", "formula": "big - base", "sourcecolumns": ["big", "base"],
               "targetcolumn": "part"}
F_TYPED = [
    {"name": "exact differences", **_WIDE_PARTS},
    {"name": "exact differences per customer", "aggregate": True, "groupbycolumns": ["cust"], **_WIDE_PARTS},
    {"name": "whole division", "formula": "(big - 9007199254740992) // fives", "operator": "<=", "threshold": 1000, **_WIDE},
    {"name": "comparison as a number", "formula": "(price_due > price) * 1", "operator": "<=", "threshold": 0, **_WIDE},
    {"name": "remainder of a distance", "formula": "abs(part - o_orderkey) % 3", "operator": "<=", "threshold": 1, **_WIDE},
    {"name": "decimals agree", "formula": "price_due - price", "operator": "==", "threshold": 0, **_WIDE},
    {"name": "either", "formula": "not (part > 500 or 1 < fives <= 3 and price != price_due)", "operator": "==", "threshold": 1, **_WIDE},
]
PREC_RAW = {"sheetname": "orders_precision", "columns": ["price_7th", "o_totalprice", "price_text", "no_such"],
            "precision": 2}
PREC_ALL = {"sheetname": "orders_precision", "columns": "ALL_NUMERIC_COLUMNS", "precision": 2}
BR_DATES = {"name": "ordered before shipped", "type": "comparison", "sheetname": "order_lines",
            "leftcolumn": "order_date", "rightcolumn": "l_shipdate", "operator": "<", "datatype": "date",
            "distinctcolumn": "o_custkey", "blankindicators": ["Not Applicable", "none"]}
BR_NUMBERS = {"name": "balance above nation limit", "type": "comparison", "sheetname": "customer_text",
              "leftcolumn": "balance_text", "rightcolumn": "nation_limit", "operator": ">", "datatype": "number"}
BR_STALE = {"name": "stale order dates", "type": "staledata", "sheetname": "orders_dates",
            "column": "order_date_text", "referencecolumn": "date_text", "months": 3,
            "distinctcolumn": "o_custkey", "blankindicators": ["null"]}
STALE_AS_OF = "1998-08-01"
BR_LOCAL_DATES = [
    {"name": "stale local dates", "type": "staledata", "sheetname": "orders_local_dates", "column": "local_date",
     "referencecolumn": "o_orderdate", "months": 24},
    {"name": "dates in any form", "type": "comparison", "sheetname": "orders_local_dates", "leftcolumn": "any_date",
     "rightcolumn": "o_orderdate", "operator": ">=", "datatype": "date"},
]
BR_LOOKUP = {"name": "nation label matches", "type": "lookupmatch", "sheetname": "customer_nation",
             "leftcolumn": "nation_label", "lookupsheet": "nation", "lookupkeyleft": "nation_key",
             "lookupkeyright": "n_nationkey", "rightcolumn": "n_name"}
BR_LOOKUP_NULLS = dict(BR_LOOKUP, name="nation label matches, null keys kept", dropnullkeys=False)
RECON_MULTI = {"name": "line amounts vs order totals", "sourcesheet": "line_amounts", "targetsheet": "order_amounts",
               "matchcolumns": ["Fiscal Year", "Fiscal Month", "Customer"], "sourcecolumn": "Line Amount",
               "targetcolumn": "Order Total", "distinctcolumn": "Customer", "tolerance": 0.01}
RECON_TOL = {"name": "order totals within 1000", "sourcesheet": "line_amounts", "targetsheet": "order_amounts",
             "matchcolumns": ["orderkey"], "sourcecolumn": "Line Amount", "targetcolumn": "Order Total",
             "distinctcolumn": "not a column", "tolerance": 1000}
CROSS_FIRST = {"name": "first role", "sourcesheet": "conversations", "targetsheet": "conversation_meta",
               "matchcolumn": "CONV_ID", "sourcecolumn": "Role", "targetcolumn": "first_role",
               "validationtype": "valuecomparison"}
CROSS_NULLS = {"name": "first role, null keys kept", "sourcesheet": "conversations_keys",
               "targetsheet": "conversation_meta", "matchcolumn": "conv_id", "sourcecolumn": "role",
               "targetcolumn": "first_role", "validationtype": "valuecomparison", "dropnullkeys": False}
CROSS_KEYS = {"name": "labelled documents", "sourcesheet": "documents", "targetsheet": "labels_shifted",
              "matchcolumn": "doc_id", "validationtype": "existencecheck"}
TREND_LAG = {"name": "monthly order value", "sheet": "orders_dates", "metric": "o_totalprice",
             "previousmetric": "unused", "operator": ">", "threshold": 30, "aggregate": True,
             "groupbycolumns": ["o_custkey", "yr", "mo"]}
TREND_TWO = {"name": "event value vs previous", "sheet": "events_trend", "metric": "value",
             "previousmetric": "prev_value", "operator": ">", "threshold": 30, "distinctcolumn": "user_id"}

EXPECTED_TABLES = ["orders", "lineitem", "customer", "warehouse"]
EXPECTED_COLUMNS = {
    "orders": {"fields": [{"name": "O_OrderKey"}, {"name": "o order date"}, {"name": "o_totalprice"},
                          {"name": "o_comment"}]},
    "customer": {"fields": [{"name": "C_NAME"}, {"name": "c acct bal"}, {"name": "c_phone"}]},
    "warehouse": {"fields": [{"name": "w_id"}]},
}

COLUMN_CHECKS = {
    "numeric_only": {},
    "email": {},
    "phone_number": {},
    "amount": {"min_value": 0, "max_value": 5000},
    "number": {"min_value": 0, "max_value": 100},
    "date": {"format": "%Y-%m-%d"},
    "text_only": {},
}
SHEET_CHECKS = {"customer_text": {"required": True}, "orders_dates": {"required": True},
                "events_cells": {}, "warehouse": {"required": False}, "ledger": {"required": True}}
REQUIRED_CHECKS = {"orders": {"required": True}, "customer": {}, "events": {"required": False},
                   "warehouse": {"required": False}, "ledger": {"required": True}}
FIELDS = {
    "customer_text": {"cust_id": ["numeric_only"], "email": ["email"], "phone": ["phone_number"],
                      "c_acctbal": ["amount"], "segment": ["text_only"], "CUST_ID": ["numeric_only"],
                      "balance_text": ["amount", "zip_code"]},
    "orders_dates": {"date_text": ["date"]},
    "events_cells": {"value": ["number"], "user_text": ["numeric_only", "text_only"]},
    "ledger": {"amount": ["amount"]},
}
FIELD_TABLES = ["customer_text", "orders_dates", "events_cells"]
FIELD_CONFIG = {"sheet_checks": SHEET_CHECKS, "column_checks": dict(COLUMN_CHECKS, zip_code={}), "fields": FIELDS}
INFER_TABLES = ["customer_text", "region", "events_cells"]
INFER_CONFIG = {"sheet_checks": {"customer_text": {}, "region": {}, "events_cells": {}, "ledger": {"required": False}},
                "column_checks": COLUMN_CHECKS, "rule_detection": {"match_threshold": 0.6}}

KPI_RULESET = {
    "sheetlist": EXPECTED_TABLES,
    "sheetvalidation": EXPECTED_COLUMNS,
    "dataqualityvalidation": {
        "duplicatecheck": [DUP_SINGLE, DUP_MULTI, DUP_NULLS, {"sheetname": "orders", "columns": ["O_CUSTKEY"]}],
        "nullcheck": [NULLS, {"sheetname": "ghost", "columns": ["a"]}],
        "numericprecision": [PREC_RAW],
    },
    "formulavalidation": [F_ROWS, F_CMP_ROWS, F_CMP_GROUPED,
                          {"name": "bad formula", "sheetname": "lineitem", "validationtype": "threshold",
                           "formula": "l_tax / no_such_column", "threshold": 1, "operator": "<"}],
    "businessrulevalidation": [BR_DATES, BR_NUMBERS, BR_STALE, BR_LOOKUP,
                               dict(BR_NUMBERS, name="bad operator", operator="=<")],
    "reconciliationvalidation": [RECON_MULTI, RECON_TOL],
    "crosssheetvalidation": [CROSS_FIRST, CROSS_KEYS],
    "trendvalidation": [TREND_LAG, TREND_TWO, {"name": "no metric", "sheet": "orders", "metric": "nope",
                                              "previousmetric": "x", "operator": ">", "threshold": 1}],
}
KPI_RULESET_TABLES = ["orders", "lineitem", "customer", "nation", "documents", "conversations", "orders_keys",
                      "orders_blank", "orders_parts", "orders_precision", "order_lines", "customer_text",
                      "orders_dates", "customer_nation", "line_amounts", "order_amounts", "conversation_meta",
                      "labels_shifted", "events_trend"]


# ---------------------------------------------------------------------------- Spark queries
def _one(binder, names, style="kpi"):
    def q(spark: SparkSession, d: str) -> DataFrame:
        ts = tables(spark, d, names)
        return _summary(spark, binder(ts), style)
    return q


def _kpi_section(section_fn, rule, names, **kw):
    return _one(lambda ts: section_fn(ts, rule, **kw), names)


def _cell_failures(sheet: str, column: str, check: str):
    def q(spark: SparkSession, d: str) -> DataFrame:
        ts = tables(spark, d, [sheet])
        return cells.failed_cells(ts, [(sheet, column, check, COLUMN_CHECKS[check])])
    return q


def _field_summary(spark, d):
    ts = tables(spark, d, FIELD_TABLES)
    return run_fields(ts, FIELD_CONFIG).summary


def _fields_failed(spark, d):
    ts = tables(spark, d, FIELD_TABLES)
    return run_fields(ts, FIELD_CONFIG).failed


def _exec_explicit(spark, d):
    ts = tables(spark, d, FIELD_TABLES)
    return run_fields(ts, FIELD_CONFIG).execution


def _infer_rules(spark, d):
    ts = tables(spark, d, INFER_TABLES)
    return _summary(spark, infer.infer_rules(ts, INFER_TABLES, COLUMN_CHECKS)[0], "fields")


def _infer_validate(spark, d):
    ts = tables(spark, d, INFER_TABLES)
    return run_inferred(ts, INFER_CONFIG).summary


def _exec_inferred(spark, d):
    ts = tables(spark, d, INFER_TABLES)
    return run_inferred(ts, INFER_CONFIG).execution


FIELD_EXIST = {"orders": {"o_orderkey": [], "O_ORDERKEY": [], "o_totalprice": []},
               "customer": {"c_name": [], "c_phone": []}, "ledger": {"amount": []}}

# cell display formats of ``orders_precision``, derived from ``orders`` (a NULL format = none)
FORMAT_EXPRS = {
    "o_totalprice": "CASE o_orderkey % 4 WHEN 0 THEN '#,##0.00' WHEN 1 THEN '#,##0.0000' WHEN 2 THEN 'General' "
                    "ELSE '0' END",
    "price_7th": "CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN '0.00;[Red]-0.000' "
                 "WHEN o_orderkey % 3 = 1 THEN '' ELSE '0.000' END",
}
PREC_FORMATS = {"sheetname": "orders_precision", "columns": ["price_7th", "o_totalprice", "price_text"],
                "precision": 2}


def _precision_formats(spark, d):
    ts = tables(spark, d, ["orders_precision"])
    base = _read(spark, d, "orders")
    sidecar = None
    for field, expr in FORMAT_EXPRS.items():
        part = base.selectExpr(f"{ROW_NO} AS row_no", f"'{field}' AS field", f"{expr} AS number_format")
        sidecar = part if sidecar is None else sidecar.unionByName(part)
    ts.add_formats("orders_precision", sidecar)
    return _summary(spark, quality.numeric_precision(ts, PREC_FORMATS))


BATCH_FIELDS = {"c_acctbal": ["amount"], "s_acctbal": ["amount"], "c_name": ["text_only"], "s_name": ["text_only"],
                "c_phone": ["phone_number"]}
BATCH_CONFIG = {"sheet_checks": {"accounts": {}}, "column_checks": COLUMN_CHECKS, "fields": {"accounts": BATCH_FIELDS}}
BATCH_GLOB = "{customer,supplier}.parquet"


def _batch(spark, d):
    ts = TableSet(spark).add_batch("accounts", d, fmt="parquet", glob=BATCH_GLOB)
    summary = run_fields(ts, BATCH_CONFIG, by_file=True).summary
    # results are keyed by file path; the comparison uses the file name
    return summary.withColumn("source_file", F.regexp_extract("source_file", "[^/]*$", 0))


INPUT_RECON = {"name": "line amounts vs order totals", "sourcesheet": "line_amounts", "targetsheet": "order_amounts",
               "matchcolumns": ["Fiscal Month", "Customer"], "sourcecolumn": "Line Amount", "targetcolumn": "Order Total",
               "distinctcolumn": "Customer", "tolerance": 200000}
INPUT_KEYS = {"name": "customers of both", "sourcesheet": "line_amounts", "targetsheet": "large_orders", "matchcolumn": "Customer",
              "validationtype": "existencecheck"}
INPUT_RULES = {"sheetlist": ["line_amounts", "warehouse"], "reconciliationvalidation": [INPUT_RECON], "crosssheetvalidation": [INPUT_KEYS]}


def _by_input(spark, d):
    """Two-table rules for each of many inputs: the tables of each year are an input of their own."""
    frames = {n: _joined(spark, d, n) for n in ("line_amounts", "order_amounts")}
    frames["large_orders"] = frames["order_amounts"].filter(F.col("Order Total") > 100000)
    sets = InputSets.from_frames(spark, frames, "Fiscal Year")
    summary = run_kpi_inputs(sets, INPUT_RULES).summary
    return summary.filter(F.col("test_type") != CONFIGURATION)  # the sections that this rule set leaves out


STREAM_FIELDS = {"value": ["number"], "event_type": ["text_only"], "user_text": ["numeric_only", "email"]}


def _stream_counts(spark, d):
    """Cell checks over ``events`` read as a file STREAM (Structured
    Streaming, running counts in complete mode); the query is driven to the
    end of the available files and its result table is returned."""
    import uuid

    from .session import ensure_checkpoint_dir
    from .streaming.cells import cell_counts_stream

    schema = spark.read.parquet(os.path.join(d, "events.parquet")).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    stream = stream.selectExpr(*DERIVED["events_cells"][1])
    name = f"stream_counts_{uuid.uuid4().hex[:8]}"
    ckpt = os.path.join(ensure_checkpoint_dir(spark), name)
    q = (cell_counts_stream(stream, "events_cells", STREAM_FIELDS, COLUMN_CHECKS).writeStream
         .outputMode("complete").format("memory").queryName(name).option("checkpointLocation", ckpt).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.table(name)


def _run_kpi(spark, d):
    ts = tables(spark, d, KPI_RULESET_TABLES)
    return run_kpi(ts, KPI_RULESET, as_of=STALE_AS_OF).summary


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "precision_formats": _precision_formats,
        "duplicate_single": _kpi_section(quality.duplicate_check, DUP_SINGLE, ["orders"]),
        "duplicate_multi": _kpi_section(quality.duplicate_check, DUP_MULTI, ["lineitem"]),
        "duplicate_null_keys": _kpi_section(quality.duplicate_check, DUP_NULLS, ["orders_keys"]),
        "null_check": _kpi_section(quality.null_check, NULLS, ["orders_blank"]),
        "formula_threshold_rows": _kpi_section(quality.formula_rule, F_ROWS, ["lineitem"]),
        "formula_threshold_grouped": _kpi_section(quality.formula_rule, F_GROUPED, ["lineitem"]),
        "formula_comparison_grouped": _kpi_section(quality.formula_rule, F_CMP_GROUPED, ["orders_parts"]),
        "formula_comparison_rows": _kpi_section(quality.formula_rule, F_CMP_ROWS, ["orders_parts"]),
        "formula_typed": _one(lambda ts: [o for r in F_TYPED for o in quality.formula_rule(ts, r)], ["orders_wide"]),
        "precision_raw": _kpi_section(quality.numeric_precision, PREC_RAW, ["orders_precision"]),
        "precision_all_numeric": _kpi_section(quality.numeric_precision, PREC_ALL, ["orders_precision"]),
        "rule_compare_dates": _kpi_section(business.business_rule, BR_DATES, ["order_lines"]),
        "rule_compare_numbers": _kpi_section(business.business_rule, BR_NUMBERS, ["customer_text"]),
        "rule_stale": _kpi_section(business.business_rule, BR_STALE, ["orders_dates"], as_of=STALE_AS_OF),
        "rule_local_dates": _one(lambda ts: [o for r in BR_LOCAL_DATES for o in business.business_rule(ts, r, as_of=STALE_AS_OF)],
                                 ["orders_local_dates"]),
        "rule_lookup_match": _kpi_section(business.business_rule, BR_LOOKUP, ["customer_nation", "nation"]),
        "rule_lookup_null_keys": _kpi_section(business.business_rule, BR_LOOKUP_NULLS, ["customer_nation", "nation"]),
        "reconcile_multi_key": _kpi_section(crosstable.reconciliation, RECON_MULTI, ["line_amounts", "order_amounts"]),
        "reconcile_tolerance": _kpi_section(crosstable.reconciliation, RECON_TOL, ["line_amounts", "order_amounts"]),
        "cross_value_first_row": _kpi_section(crosstable.cross_sheet, CROSS_FIRST, ["conversations", "conversation_meta"]),
        "cross_value_null_keys": _kpi_section(crosstable.cross_sheet, CROSS_NULLS,
                                              ["conversations_keys", "conversation_meta"]),
        "cross_key_difference": _kpi_section(crosstable.cross_sheet, CROSS_KEYS, ["documents", "labels_shifted"]),
        "trend_lag": _kpi_section(trend.trend, TREND_LAG, ["orders_dates"]),
        "trend_two_columns": _kpi_section(trend.trend, TREND_TWO, ["events_trend"]),
        "cell_numeric_only": _cell_failures("customer_text", "cust_id", "numeric_only"),
        "cell_email": _cell_failures("customer_text", "email", "email"),
        "cell_phone": _cell_failures("customer_text", "phone", "phone_number"),
        "cell_amount": _cell_failures("customer_text", "c_acctbal", "amount"),
        "cell_number": _cell_failures("events_cells", "value", "number"),
        "cell_date": _cell_failures("orders_dates", "date_text", "date"),
        "cell_text_only": _cell_failures("customer_text", "segment", "text_only"),
        "field_summary": _field_summary,
        "field_failed_records": _fields_failed,
        "exec_summary_explicit": _exec_explicit,
        "infer_rules": _infer_rules,
        "infer_and_validate": _infer_validate,
        "exec_summary_inferred": _exec_inferred,
        "run_kpi_ruleset": _run_kpi,
        "batch_by_file": _batch,
        "kpi_by_input": _by_input,
        "stream_cell_counts": _stream_counts,
    }

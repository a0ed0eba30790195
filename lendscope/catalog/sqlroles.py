"""The role views of `lendscope.sources.roles`, written as DuckDB SQL.

Used only by the oracle side of the correctness check: every oracle query is
`WITH <roles it needs> SELECT ...` over the pre-registered driver tables.
"""

from __future__ import annotations

REF = "DATE '2001-12-01'"


def _days(ts: str) -> str:
    return f"date_diff('day', {REF}, CAST({ts} AS DATE))"


def _months(ts: str) -> str:
    return f"CAST(-((2001 - year({ts})) * 12 + 12 - month({ts})) AS INTEGER)"


_doc_flags = ",\n    ".join(f"CAST(c_custkey % {i} = 0 AS INTEGER) AS FLAG_DOCUMENT_{i}" for i in range(2, 22))

APP = f"""app AS (
  SELECT c_custkey AS SK_ID_CURR,
    CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_acctbal < 0 AS INTEGER) END AS TARGET,
    CASE WHEN c_custkey % 8 = 0 THEN 'Revolving loans' ELSE 'Cash loans' END AS NAME_CONTRACT_TYPE,
    CASE WHEN c_custkey % 50 = 0 THEN 'XNA' WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS CODE_GENDER,
    CASE WHEN c_nationkey % 2 = 0 THEN 'Y' ELSE 'N' END AS FLAG_OWN_CAR,
    CASE WHEN c_custkey % 3 = 0 THEN 'Y' ELSE 'N' END AS FLAG_OWN_REALTY,
    c_custkey % 4 AS CNT_CHILDREN,
    c_acctbal + CAST(1000 AS DOUBLE) AS AMT_INCOME_TOTAL,
    CAST(100 * (c_custkey % 97 + 1) AS DOUBLE) AS AMT_CREDIT,
    CAST(5 * (c_custkey % 13) AS DOUBLE) AS AMT_ANNUITY,
    CAST(nullif(90 * (c_custkey % 89), 0) AS DOUBLE) AS AMT_GOODS_PRICE,
    c_mktsegment AS ORGANIZATION_TYPE,
    c_nationkey AS REGION_POPULATION_RELATIVE,
    -(7000 + c_custkey % 18000) AS DAYS_BIRTH,
    CASE WHEN c_custkey % 6 = 0 THEN CAST(365243 AS BIGINT) ELSE -(c_custkey % 5000) - 1 END AS DAYS_EMPLOYED,
    -(c_custkey % 4000) AS DAYS_ID_PUBLISH,
    CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey % 25 AS DOUBLE) END AS OWN_CAR_AGE,
    CAST(-(c_custkey % 3000) AS DOUBLE) AS DAYS_LAST_PHONE_CHANGE,
    1 AS FLAG_MOBIL,
    CAST(c_custkey % 2 = 0 AS INTEGER) AS FLAG_EMP_PHONE,
    CAST(c_custkey % 7 = 0 AS INTEGER) AS FLAG_WORK_PHONE,
    CAST(c_custkey % 9 <> 0 AS INTEGER) AS FLAG_CONT_MOBILE,
    CAST(c_custkey % 3 = 1 AS INTEGER) AS FLAG_PHONE,
    CAST(c_custkey % 10 = 0 AS INTEGER) AS FLAG_EMAIL,
    CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE (c_custkey % 101) / CAST(101 AS DOUBLE) END AS EXT_SOURCE_1,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE (c_custkey % 89) / CAST(89 AS DOUBLE) END AS EXT_SOURCE_2,
    CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE (c_custkey % 73) / CAST(73 AS DOUBLE) END AS EXT_SOURCE_3,
    {_doc_flags}
  FROM customer)"""

CREDIT = f"""credit AS (
  SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_BUREAU,
    CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Active' ELSE 'Sold' END AS CREDIT_ACTIVE,
    CASE WHEN o_orderkey % 4 = 0 THEN 'currency 2' ELSE 'currency 1' END AS CREDIT_CURRENCY,
    {_days('o_orderdate')} AS DAYS_CREDIT,
    CASE WHEN o_orderkey % 23 = 0 THEN o_orderkey % 90 ELSE CAST(0 AS BIGINT) END AS CREDIT_DAY_OVERDUE,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL
         ELSE CAST({_days('o_orderdate')} + 365 * (o_orderkey % 7 + 1) AS DOUBLE) END AS DAYS_CREDIT_ENDDATE,
    CASE WHEN o_orderstatus = 'F' THEN CAST({_days('o_orderdate')} + 300 AS DOUBLE) END AS DAYS_ENDDATE_FACT,
    CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice / 7 END AS AMT_CREDIT_MAX_OVERDUE,
    nullif(o_orderkey % 4, 3) AS CNT_CREDIT_PROLONG,
    o_totalprice AS AMT_CREDIT_SUM,
    CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice / 3 END AS AMT_CREDIT_SUM_DEBT,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice / 9 END AS AMT_CREDIT_SUM_LIMIT,
    CASE WHEN o_orderkey % 9 = 0 THEN o_totalprice / 11 ELSE CAST(0 AS DOUBLE) END AS AMT_CREDIT_SUM_OVERDUE,
    o_orderpriority AS CREDIT_TYPE,
    {_days('o_orderdate')} + o_orderkey % 60 AS DAYS_CREDIT_UPDATE,
    CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_totalprice / 13 END AS AMT_ANNUITY
  FROM orders)"""

HIST = f"""hist AS (
  SELECT l_orderkey AS SK_ID_BUREAU,
    {_months('l_shipdate')} AS MONTHS_BALANCE,
    CASE WHEN l_returnflag = 'R' THEN CAST(l_linenumber % 5 + 1 AS VARCHAR)
         WHEN l_returnflag = 'A' THEN '0'
         WHEN l_linestatus = 'F' THEN 'C' ELSE 'X' END AS STATUS
  FROM lineitem)"""


def _sent(mod: int, expr: str) -> str:
    return f"CASE WHEN o_orderkey % {mod} = 0 THEN CAST(365243 AS DOUBLE) ELSE CAST({expr} AS DOUBLE) END"


_D = _days("o_orderdate")

PREV = f"""prev AS (
  SELECT o_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR,
    o_orderpriority AS NAME_CONTRACT_TYPE,
    CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'P' THEN 'Refused' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice / 23 END AS AMT_ANNUITY,
    o_totalprice AS AMT_APPLICATION,
    CASE WHEN o_orderkey % 13 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice / CAST(1.1 AS DOUBLE) END AS AMT_CREDIT,
    CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice / 11 END AS AMT_DOWN_PAYMENT,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS AMT_GOODS_PRICE,
    o_orderkey % 24 AS HOUR_APPR_PROCESS_START,
    CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey % 10) / CAST(99 AS DOUBLE) END AS RATE_DOWN_PAYMENT,
    {_D} AS DAYS_DECISION,
    CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(o_orderkey % 36 + 1 AS DOUBLE) END AS CNT_PAYMENT,
    {_sent(3, _D + ' - 30')} AS DAYS_FIRST_DRAWING,
    {_sent(4, _D + ' + 30')} AS DAYS_FIRST_DUE,
    {_sent(5, _D + ' + 365')} AS DAYS_LAST_DUE_1ST_VERSION,
    {_sent(10, _D)} AS DAYS_LAST_DUE,
    {_sent(8, _D + ' + 400')} AS DAYS_TERMINATION
  FROM orders)"""

_DPD = "CAST(greatest(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)), 0) AS BIGINT)"

POS = f"""pos AS (
  SELECT l_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR,
    {_months('l_shipdate')} AS MONTHS_BALANCE,
    CAST(nullif(l_linenumber, 7) AS DOUBLE) AS CNT_INSTALMENT,
    CAST(7 - l_linenumber AS DOUBLE) AS CNT_INSTALMENT_FUTURE,
    l_returnflag AS NAME_CONTRACT_STATUS,
    {_DPD} AS SK_DPD,
    CASE WHEN l_linenumber % 3 = 0 THEN {_DPD} ELSE CAST(0 AS BIGINT) END AS SK_DPD_DEF
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

INSTAL = f"""instal AS (
  SELECT l_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR,
    l_suppkey % 5 AS NUM_INSTALMENT_VERSION,
    l_linenumber AS NUM_INSTALMENT_NUMBER,
    CAST({_days('o_orderdate')} AS DOUBLE) AS DAYS_INSTALMENT,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST({_days('l_shipdate')} AS DOUBLE) END AS DAYS_ENTRY_PAYMENT,
    l_extendedprice AS AMT_INSTALMENT,
    l_extendedprice * (CAST(1 AS DOUBLE) - l_discount) + l_linenumber % 3 AS AMT_PAYMENT
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

CARD = """card AS (
  SELECT event_id % 20 AS SK_ID_PREV, user_id AS SK_ID_CURR,
    -CAST(dayofmonth(ts) AS INTEGER) AS MONTHS_BALANCE,
    value AS AMT_BALANCE,
    event_id % 5 AS CNT_DRAWINGS_CURRENT,
    event_type AS NAME_CONTRACT_STATUS
  FROM events)"""

SCORED = """scored AS (
  SELECT d.doc_id AS id, l.quality AS label, CAST(d.n_chars % 1000 AS DOUBLE) AS score,
         d.lang AS cat, d.source AS source
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

ROLE_SQL = {"app": APP, "credit": CREDIT, "hist": HIST, "prev": PREV, "pos": POS,
            "instal": INSTAL, "card": CARD, "scored": SCORED}

# Integer-typed role columns (oracle side needs them to cast sums back to BIGINT).
INT_COLS = {
    "SK_ID_CURR", "SK_ID_BUREAU", "SK_ID_PREV", "TARGET", "CNT_CHILDREN", "DAYS_BIRTH",
    "DAYS_EMPLOYED", "DAYS_ID_PUBLISH", "FLAG_MOBIL", "FLAG_EMP_PHONE", "FLAG_WORK_PHONE",
    "FLAG_CONT_MOBILE", "FLAG_PHONE", "FLAG_EMAIL", "REGION_POPULATION_RELATIVE",
    "DAYS_CREDIT", "CREDIT_DAY_OVERDUE", "CNT_CREDIT_PROLONG", "DAYS_CREDIT_UPDATE",
    "MONTHS_BALANCE", "HOUR_APPR_PROCESS_START", "DAYS_DECISION", "SK_DPD", "SK_DPD_DEF",
    "NUM_INSTALMENT_VERSION", "NUM_INSTALMENT_NUMBER", "CNT_DRAWINGS_CURRENT",
} | {f"FLAG_DOCUMENT_{i}" for i in range(2, 22)}


def with_roles(*names: str, extra: str = "") -> str:
    """`WITH role1 AS (...), role2 AS (...)[, extra]` prefix."""
    parts = [ROLE_SQL[n] for n in names]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"

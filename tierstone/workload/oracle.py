"""The same queries as plain SQL over the given tables, for an independent check."""

from __future__ import annotations

from tierstone.schema import ASSET_CLASSES, COLUMNS, HASH_COLUMNS, TRADE_SCHEMA
from tierstone.workload.fixtures import (
    AS_OF,
    ASSET_CLASS,
    COUNTERPARTY,
    FAILING_YEAR,
    FIRST_DAY,
    FIRST_YEAR,
    LAST_DAY,
    LAST_YEAR,
    MONTH,
    TRADE_ID,
    YEAR,
)

_CLASSES = ", ".join(f"'{c}'" for c in ASSET_CLASSES)
_COLS = ", ".join(COLUMNS)

TRADES = f"""
base AS (
  SELECT
    md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
      CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
      CAST(CAST(l_extendedprice AS DECIMAL(22,4)) AS VARCHAR),
      CAST(CAST(l_shipdate AS DATE) AS VARCHAR))) AS trade_id,
    CAST(l_shipdate AS DATE) AS trade_date,
    l_shipdate + CAST(l_orderkey % 86400 AS INT) * INTERVAL '1' SECOND AS trade_timestamp,
    list_extract([{_CLASSES}], CAST(l_partkey % 11 + 1 AS INT)) AS asset_class,
    'INS_' || lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS instrument_id,
    p_name AS instrument_name,
    p_type AS instrument_subtype,
    CAST(l_extendedprice AS DECIMAL(22,4)) AS notional_usd,
    CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(1 - l_discount AS DECIMAL(4,2))
      AS DECIMAL(22,4)) AS notional_local,
    list_extract(['USD', 'EUR', 'GBP', 'JPY'], CAST(c_nationkey % 4 + 1 AS INT)) AS local_currency,
    CAST(l_extendedprice / l_quantity AS DECIMAL(18,8)) AS price,
    CAST(l_quantity AS DECIMAL(20,4)) AS quantity,
    CASE WHEN l_linestatus = 'O' THEN 'BUY' ELSE 'SELL' END AS direction,
    'CP_' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS counterparty_id,
    upper(substr(md5(CAST(o_custkey AS VARCHAR)), 1, 20)) AS counterparty_lei,
    'TR_' || CAST(l_suppkey AS VARCHAR) AS trader_id,
    'BK_' || lpad(CAST(l_partkey % 200 AS VARCHAR), 4, '0') AS book_id,
    p_brand AS desk_id,
    'ENT_' || CAST(c_nationkey AS VARCHAR) AS entity_id,
    CASE WHEN l_returnflag = 'R' THEN 'CANCELLED' WHEN o_orderstatus = 'F' THEN 'SETTLED'
      WHEN o_orderstatus = 'O' THEN 'CONFIRMED' WHEN o_orderstatus = 'P' THEN 'AMENDED'
      END AS trade_status,
    CAST(l_shipdate AS DATE) + 2 AS settlement_date,
    CAST(l_shipdate AS DATE) + 1 AS value_date,
    n_regionkey = 3 AS mifid_flag,
    CASE WHEN n_regionkey <> 3 THEN 'EXEMPT' WHEN o_orderstatus = 'P' THEN 'PENDING'
      ELSE 'REPORTED' END AS reporting_status,
    CASE WHEN l_returnflag = 'A' THEN l_shipdate + INTERVAL '30' DAY END AS updated_at,
    list_extract(['MUREX', 'CALYPSO', 'SUMMIT'], CAST(l_linenumber % 3 + 1 AS INT)) AS source_system,
    CAST(year(l_shipdate) AS INT) AS trade_year,
    CAST(month(l_shipdate) AS INT) AS trade_month
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN part ON l_partkey = p_partkey
),
trades AS (
  SELECT {_COLS} FROM (
    SELECT *, trade_timestamp AS created_at,
      CASE WHEN asset_class IN ('RATES', 'CREDIT', 'DERIVATIVE') THEN trade_date + 365 END AS maturity_date,
      CASE WHEN mifid_flag THEN 'UTI' || trade_id END AS uti
    FROM base)
)"""

_D = f"DATE '{AS_OF}'"
TIERS = f"""
hot AS (SELECT * FROM trades WHERE trade_date >= {_D} - 30),
warm AS (SELECT * FROM trades WHERE trade_date >= {_D} - 90 AND trade_date < {_D} - 30),
cold AS (SELECT * FROM trades WHERE trade_date < {_D} - 90)"""
STALE = f"""
hot_stale AS (SELECT * FROM trades WHERE trade_date >= {_D} - 50
  OR (trade_date < {_D} - 110 AND substr(trade_id, 1, 2) = 'ff')),
warm_stale AS (SELECT * FROM trades WHERE (trade_date >= {_D} - 110 AND trade_date < {_D} - 50)
  OR (trade_date >= {_D} - 50 AND trade_date < {_D} - 30 AND substr(trade_id, 1, 1) = 'f')),
cold_stale AS (SELECT * FROM trades WHERE trade_date < {_D} - 110 AND substr(trade_id, 1, 2) <> 'ff'),
to_warm AS (SELECT * FROM hot_stale src WHERE trade_date < {_D} - 30 AND NOT EXISTS (
  SELECT 1 FROM warm_stale tgt WHERE tgt.trade_id = src.trade_id
    AND tgt.trade_year = year(src.trade_date) AND tgt.trade_month = month(src.trade_date))),
filled AS (SELECT * FROM warm_stale UNION ALL SELECT * FROM to_warm),
to_cold AS (SELECT * FROM filled src WHERE trade_date < {_D} - 90 AND NOT EXISTS (
  SELECT 1 FROM cold_stale tgt WHERE tgt.trade_id = src.trade_id
    AND tgt.trade_year = year(src.trade_date) AND tgt.trade_month = month(src.trade_date)))"""


def _digit(digit: str) -> str:
    return f"substr(trade_id, 1, 1) = '{digit}'"


# How each defect changes the history.
DEFECT_SQL = {
    "clean": "SELECT * FROM trades",
    "bad_0": f"SELECT * FROM trades WHERE NOT {_digit('0')}",
    "bad_1": f"SELECT * FROM trades UNION ALL SELECT * FROM trades WHERE {_digit('1')}",
    "bad_2": f"SELECT * REPLACE (CASE WHEN {_digit('2')} THEN 'HOLD' ELSE direction END AS direction) FROM trades",
    "bad_3": f"SELECT * REPLACE (CAST(CASE WHEN {_digit('3')} THEN notional_usd + 1 ELSE notional_usd END AS DECIMAL(22,4)) AS notional_usd) FROM trades",
    "bad_4": f"SELECT * REPLACE (CASE WHEN {_digit('4')} THEN NULL ELSE notional_usd END AS notional_usd) FROM trades",
    "bad_5": f"SELECT * REPLACE (CASE WHEN {_digit('5')} THEN trade_month % 12 + 1 ELSE trade_month END AS trade_month) FROM trades",
    "bad_6": f"SELECT * REPLACE (CASE WHEN {_digit('6')} THEN -notional_usd ELSE notional_usd END AS notional_usd) FROM trades",
    "bad_7": f"SELECT * REPLACE (CASE WHEN {_digit('7')} THEN trade_date + 3650 ELSE trade_date END AS trade_date) FROM trades",
    "bad_class": "SELECT * FROM trades WHERE asset_class <> 'CRYPTO'",
    "bad_empty": f"SELECT * FROM trades WHERE trade_year < {FIRST_DAY.year}",
    "bad_year": f"SELECT * FROM trades WHERE trade_year <> {FAILING_YEAR}",
    "bad_id": f"SELECT * REPLACE (CASE WHEN {_digit('8')} THEN NULL ELSE trade_id END AS trade_id) FROM trades",
}


def _q(body: str, *ctes: str) -> str:
    return "WITH " + ",".join([TRADES, *ctes]) + "\n" + body


def _in_month(year: str = "trade_year", month: str = "trade_month") -> str:
    return f"{year} = {YEAR} AND {month} = {MONTH}"


_SRC = f"src AS (SELECT * FROM trades WHERE {_in_month('year(trade_date)', 'month(trade_date)')})"


def _per_target(labels: list[str], body, *ctes: str, window: bool = True) -> str:
    """``body(tgt)`` once per defect, tagged with the name of the target."""
    parts, defs = [], [_SRC, *ctes]
    for label in labels:
        where = f" WHERE {_in_month()}" if window else ""
        defs.append(f"all_{label} AS ({DEFECT_SQL[label]})")
        defs.append(f"tgt_{label} AS (SELECT * FROM all_{label}{where})")
        parts.append(f"SELECT '{label}' AS target, q.* FROM ({body('tgt_' + label)}) q")
    return _q("\nUNION ALL\n".join(parts), *defs)


def _hash(columns: list[str] = HASH_COLUMNS) -> str:
    inner = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return f"md5(concat_ws('|', {inner}))"


def _money(expr: str) -> str:
    return f"CAST(SUM({expr}) AS DECIMAL(32,4))"


# Analytics ---------------------------------------------------------------


def _year_class() -> str:
    return _q(f"""SELECT trade_date, {_money('notional_usd')} AS total_notional,
  COUNT(*) AS trade_count, CAST(SUM(price) AS DOUBLE) / COUNT(price) AS avg_price,
  COUNT(DISTINCT counterparty_id) AS unique_counterparties
FROM trades WHERE trade_year = {YEAR} AND asset_class = '{ASSET_CLASS}'
GROUP BY trade_date ORDER BY trade_date""")


def _book_month() -> str:
    return _q(f"""SELECT book_id, asset_class, direction, {_money('notional_usd')} AS gross_notional,
  COUNT(*) AS trade_count, MIN(trade_timestamp) AS first_trade, MAX(trade_timestamp) AS last_trade
FROM trades WHERE {_in_month()} GROUP BY ALL ORDER BY gross_notional DESC""")


def _cross_year() -> str:
    return _q(f"""SELECT trade_year, asset_class, entity_id, COUNT(*) AS trade_count,
  {_money('notional_usd')} AS total_notional, COUNT(DISTINCT uti) AS uti_count
FROM trades WHERE trade_year BETWEEN {FIRST_YEAR} AND {LAST_YEAR} AND mifid_flag
GROUP BY ALL ORDER BY ALL""")


def _counterparty() -> str:
    return _q(f"""SELECT trade_id, trade_date, asset_class, notional_usd, trade_status FROM trades
WHERE counterparty_id = '{COUNTERPARTY}' ORDER BY trade_timestamp DESC, trade_id LIMIT 1000""")


# Validation --------------------------------------------------------------


def _v21(t: str) -> str:
    return f"""SELECT s.n AS source_rows, g.n AS target_rows, s.n - g.n AS delta,
  CASE WHEN s.n = g.n THEN 'LEVEL2-1 PASS ✓'
    ELSE 'LEVEL2-1 FAIL ✗  delta=' || CAST(s.n - g.n AS VARCHAR) END AS result
FROM (SELECT COUNT(*) n FROM src) s, (SELECT COUNT(*) n FROM {t}) g"""


def _v22(t: str) -> str:
    return f"""SELECT CASE WHEN COUNT(*) = COUNT(DISTINCT trade_id)
  THEN 'LEVEL2-2 PASS ✓ (no duplicate trade_id)'
  ELSE 'LEVEL2-2 FAIL ✗  duplicates found: ' || CAST(COUNT(*) - COUNT(DISTINCT trade_id) AS VARCHAR)
  END AS result FROM {t}"""


def _v23(t: str) -> str:
    return f"""SELECT trade_id, COUNT(*) AS occurrences FROM {t} GROUP BY trade_id
  HAVING COUNT(*) > 1 ORDER BY occurrences DESC, trade_id LIMIT 50"""


def _sums(t: str) -> str:
    return f"""SELECT {_money('notional_usd')} n, {_money('quantity')} q, MIN(trade_date) lo,
  MAX(trade_date) hi FROM {t}"""


_SUMS_AGREE = """coalesce(abs(s.n - g.n) < 0.01, s.n IS NULL AND g.n IS NULL)
    AND coalesce(abs(s.q - g.q) < 0.01, s.q IS NULL AND g.q IS NULL)
    AND s.lo IS NOT DISTINCT FROM g.lo AND s.hi IS NOT DISTINCT FROM g.hi"""


def _v31(t: str) -> str:
    return f"""SELECT s.n AS src_notional, g.n AS tgt_notional, s.q AS src_quantity, g.q AS tgt_quantity,
  s.lo AS src_min_date, g.lo AS tgt_min_date, s.hi AS src_max_date, g.hi AS tgt_max_date,
  CAST(abs(s.n - g.n) AS DECIMAL(33,4)) AS abs_delta,
  CASE WHEN {_SUMS_AGREE} THEN 'LEVEL3-1 PASS ✓' ELSE 'LEVEL3-1 FAIL ✗' END AS result
FROM ({_sums('src')}) s, ({_sums(t)}) g"""


# Alias and column of the NULL counts.
_NULLS = [
    ("null_trade_id", "trade_id"), ("null_trade_date", "trade_date"),
    ("null_trade_ts", "trade_timestamp"), ("null_asset_class", "asset_class"),
    ("null_notional", "notional_usd"), ("null_direction", "direction"),
    ("null_trade_year", "trade_year"), ("null_trade_month", "trade_month"),
    ("null_created_at", "created_at"),
]


def _v32(t: str) -> str:
    counts = ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS {a}" for a, c in _NULLS)
    anynull = " OR ".join(f"{c} IS NULL" for _, c in _NULLS)
    return f"""SELECT {counts}, CASE WHEN COUNT(*) FILTER (WHERE {anynull}) = 0 THEN 'LEVEL3-2 PASS ✓'
  ELSE 'LEVEL3-2 FAIL ✗  unexpected NULLs in NOT NULL columns' END AS result FROM {t}"""


_MISPLACED = "year(trade_date) <> trade_year OR month(trade_date) <> trade_month"


def _v33(t: str) -> str:
    return f"""SELECT direction, COUNT(*) AS occurrences FROM {t}
  WHERE direction NOT IN ('BUY', 'SELL') GROUP BY direction"""


def _v34(t: str) -> str:
    return f"SELECT COUNT(*) AS mismatched_partition_columns FROM {t} WHERE {_MISPLACED}"


def _both(t: str, key: str) -> str:
    return f"""(SELECT {key}, COUNT(*) n FROM src GROUP BY {key}) s FULL OUTER JOIN
  (SELECT {key}, COUNT(*) n FROM {t} GROUP BY {key}) g ON s.{key} = g.{key}"""


def _v41(t: str) -> str:
    return f"""SELECT coalesce(s.asset_class, g.asset_class) AS asset_class,
  coalesce(s.n, 0) AS src_count, coalesce(g.n, 0) AS tgt_count,
  CASE WHEN coalesce(s.n, 0) = coalesce(g.n, 0) THEN 'PASS ✓'
    ELSE 'FAIL ✗ delta=' || CAST(coalesce(s.n, 0) - coalesce(g.n, 0) AS VARCHAR) END AS result
FROM {_both(t, 'asset_class')}"""


def _v42(t: str) -> str:
    return f"""SELECT s.trade_date, s.n AS src_daily_count, g.n AS tgt_daily_count,
  s.n - coalesce(g.n, 0) AS delta,
  CASE WHEN s.n = coalesce(g.n, 0) THEN 'PASS ✓' ELSE 'FAIL ✗' END AS result
FROM (SELECT trade_date, COUNT(*) n FROM src GROUP BY trade_date) s LEFT JOIN
  (SELECT trade_date, COUNT(*) n FROM {t} GROUP BY trade_date) g ON s.trade_date = g.trade_date"""


_SAMPLE = """sample AS (SELECT trade_id FROM src ORDER BY md5(concat(trade_id, '42')), trade_id LIMIT 1000)"""


def _v54(t: str) -> str:
    """Ids are looked up in the whole target, not in the window."""
    whole = t.replace("tgt_", "all_")
    return f"""SELECT COUNT(*) AS total_sampled,
  COUNT(*) FILTER (WHERE s.h = g.h) AS matching_rows,
  COUNT(*) FILTER (WHERE s.h <> g.h) AS mismatched_rows,
  COUNT(*) FILTER (WHERE g.trade_id IS NULL) AS missing_in_target,
  CASE WHEN COUNT(*) FILTER (WHERE s.h <> g.h) = 0 AND COUNT(*) FILTER (WHERE g.trade_id IS NULL) = 0
    THEN 'LEVEL5 PASS ✓  All ' || CAST(COUNT(*) AS VARCHAR) || ' sampled rows match'
    ELSE 'LEVEL5 FAIL ✗  Hash or row mismatches detected' END AS result
FROM (SELECT trade_id, {_hash()} h FROM trades WHERE trade_id IN (SELECT trade_id FROM sample)) s
LEFT JOIN (SELECT trade_id, {_hash()} h FROM {whole} WHERE trade_id IN (SELECT trade_id FROM sample)) g
  ON s.trade_id = g.trade_id"""


def _report(t: str) -> str:
    def line(level: int, check: str, frm: str, ok: str, s: str, g: str, d: str) -> str:
        return f"""SELECT {level} AS level, '{check}' AS check_id, CAST({s} AS VARCHAR) AS source_value,
  CAST({g} AS VARCHAR) AS target_value, CAST({d} AS VARCHAR) AS delta,
  CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS result FROM {frm}"""

    def count(where: str) -> str:
        return f"(SELECT COUNT(*) n FROM {t} WHERE {where})"

    def keyed(check: str, key: str) -> str:
        inner = f"""(SELECT COUNT(*) FILTER (WHERE s.n > 0) a, COUNT(*) FILTER (WHERE g.n > 0) b,
  COUNT(*) FILTER (WHERE coalesce(s.n, 0) <> coalesce(g.n, 0)) m FROM {_both(t, key)})"""
        return line(4, check, inner, "m = 0", "a", "b", "m")

    anynull = " OR ".join(f"{c} IS NULL" for _, c in _NULLS)
    parts = [
        line(2, "V2.1", f"({_v21(t)})", "delta = 0", "source_rows", "target_rows", "delta"),
        line(2, "V2.2", f"(SELECT COUNT(*) n, COUNT(DISTINCT trade_id) k FROM {t})", "n = k", "NULL", "n", "n - k"),
        line(3, "V3.1", f"({_v31(t)})", "result LIKE '%PASS%'", "src_notional", "tgt_notional", "abs_delta"),
        line(3, "V3.2", count(anynull), "n = 0", "NULL", "n", "NULL"),
        line(3, "V3.3", count("direction NOT IN ('BUY', 'SELL')"), "n = 0", "NULL", "n", "NULL"),
        line(3, "V3.4", count(_MISPLACED), "n = 0", "NULL", "n", "NULL"),
        keyed("V4.1", "asset_class"),
        keyed("V4.2", "trade_date"),
        line(5, "V5.4", f"({_v54(t)})", "mismatched_rows + missing_in_target = 0", "total_sampled",
             "matching_rows", "mismatched_rows + missing_in_target"),
    ]
    return "\nUNION ALL\n".join(parts)


def _all_partitions(t: str) -> str:
    def side(name: str, y: str, m: str) -> str:
        return f"""(SELECT CAST({y} AS INT) y, CAST({m} AS INT) m, COUNT(*) n, COUNT(DISTINCT trade_id) k,
  {_money('notional_usd')} s, {_money('quantity')} q, COUNT(*) FILTER (WHERE {_MISPLACED}) bad
  FROM {name} GROUP BY 1, 2)"""

    return f"""SELECT coalesce(a.y, b.y) AS trade_year, coalesce(a.m, b.m) AS trade_month,
  coalesce(a.n, 0) AS source_rows, coalesce(b.n, 0) AS target_rows, coalesce(b.k, 0) AS target_ids,
  a.s AS source_notional, b.s AS target_notional, a.q AS source_quantity, b.q AS target_quantity,
  coalesce(b.bad, 0) AS misplaced_rows,
  CASE WHEN coalesce(a.n, 0) = coalesce(b.n, 0) AND coalesce(b.n, 0) = coalesce(b.k, 0)
    AND coalesce(abs(a.s - b.s) < 0.01, a.s IS NULL AND b.s IS NULL)
    AND coalesce(abs(a.q - b.q) < 0.01, a.q IS NULL AND b.q IS NULL)
    AND coalesce(b.bad, 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS result
FROM {side('trades', 'year(trade_date)', 'month(trade_date)')} a
FULL OUTER JOIN {side(t, 'trade_year', 'trade_month')} b ON a.y = b.y AND a.m = b.m"""


# Suite -------------------------------------------------------------------

_Y1, _Y2 = FIRST_DAY.year, LAST_DAY.year
_RANGE = f"trade_year BETWEEN {_Y1} AND {_Y2}"
_MONTHS = (_Y2 - _Y1) * 12 + LAST_DAY.month - FIRST_DAY.month + 1

# Description, observed value and pass rule of each check.
SUITE = {
    "V-001": ("Total row count > 0 in TRADES_COLD", f"COUNT(*) FILTER (WHERE {_RANGE})", "> 0"),
    "V-002": ("All expected years present in TRADES_COLD",
              f"COUNT(DISTINCT CASE WHEN {_RANGE} THEN trade_year END)", f"= {_Y2 - _Y1 + 1}"),
    "V-003": ("No NULL trade_id values in TRADES_COLD", "COUNT(*) FILTER (WHERE trade_id IS NULL)", "= 0"),
    "V-004": ("No duplicate trade_id in TRADES_COLD",
              f"COUNT(*) FILTER (WHERE {_RANGE}) - COUNT(DISTINCT CASE WHEN {_RANGE} THEN trade_id END)", "= 0"),
    "V-005": ("All 11 expected asset classes present", "COUNT(DISTINCT asset_class)", "= 11"),
    "C-001": ("No NULL notional_usd values", "COUNT(*) FILTER (WHERE notional_usd IS NULL)", "= 0"),
    "C-002": ("All direction values are BUY or SELL",
              "COUNT(*) FILTER (WHERE direction NOT IN ('BUY', 'SELL'))", "= 0"),
    "C-003": ("Partition columns consistent with trade_date", f"COUNT(*) FILTER (WHERE {_MISPLACED})", "= 0"),
    "C-004": ("Notional values are positive (no negative notional)",
              "COUNT(*) FILTER (WHERE notional_usd <= 0)", "= 0"),
    "C-005": ("No future-dated trades in cold tier", f"COUNT(*) FILTER (WHERE trade_date > {_D})", "= 0"),
}


def _line(check: str, text: str, observed: str, rule: str, frm: str) -> str:
    return f"""SELECT '{check}' AS check_id, '{text}' AS description, CAST(v AS BIGINT) AS observed,
  CASE WHEN v {rule} THEN 'PASS' ELSE 'FAIL' END AS result FROM (SELECT {observed} AS v FROM {frm})"""


def _suite_check(check: str):
    text, observed, rule = SUITE[check]
    return lambda t: _line(check, text, observed, rule, t)


def _suite_summary(table: str) -> str:
    checks = [c for c in SUITE if c in SUITE_KEYS]
    lines = "\nUNION ALL\n".join(f"({_suite_check(c)(table)})" for c in checks)
    return f"""SELECT COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE result = 'PASS') AS passed,
  COUNT(*) FILTER (WHERE result <> 'PASS') AS failed,
  CASE WHEN COUNT(*) FILTER (WHERE result <> 'PASS') = 0 THEN 'PASS' ELSE 'FAIL' END AS result FROM ({lines})"""


LOG = f"""log AS (SELECT 'TRADES_COLD_LEGACY' AS source_table, 'TRADES_COLD' AS target_table,
  make_date(trade_year, trade_month, 1) AS partition_start,
  last_day(make_date(trade_year, trade_month, 1)) AS partition_end,
  COUNT(*) AS rows_migrated, 'COMPLETED' AS status FROM trades GROUP BY trade_year, trade_month)"""
# A year is one job: its months are validated together, and the range stops after it.
FAILED_LOG = f"""failed AS (SELECT make_date(trade_year, trade_month, 1) AS partition_start,
  last_day(make_date(trade_year, trade_month, 1)) AS partition_end,
  CASE WHEN trade_year = {FAILING_YEAR} AND bool_or({_digit('2')}) THEN 'FAILED' ELSE 'COMPLETED' END AS status
  FROM trades WHERE trade_year <= {FAILING_YEAR} GROUP BY trade_year, trade_month)"""


def _l001(log: str) -> str:
    inside = f"partition_start >= DATE '{FIRST_DAY}' AND partition_end <= DATE '{LAST_DAY}'"
    return _line("L-001", "Migration log has entries for all months",
                 f"COUNT(DISTINCT partition_start) FILTER (WHERE status = 'COMPLETED' AND {inside})", f">= {_MONTHS}", log)


def _l002(log: str) -> str:
    return _line("L-002", "No failed migrations in log",
                 f"COUNT(*) FILTER (WHERE status = 'FAILED' AND partition_start >= DATE '{FIRST_DAY}')", "= 0", log)


def _q001() -> str:
    return _line("Q-001", "V_ALL_TRADES returns results without error",
                 f"COUNT(*) FILTER (WHERE trade_year = {_Y1})", "> 0", "trades")


def _q002() -> str:
    wanted = f"trade_year = {_Y1} AND trade_month = 1 AND asset_class = 'FX'"
    return f"""SELECT 'Q-002' AS check_id, 'Partition pruning works for a single asset class' AS description,
  scanned AS observed, CASE WHEN scanned > 0 AND scanned < total THEN 'PASS' ELSE 'FAIL' END AS result FROM (
  SELECT COUNT(*) FILTER (WHERE {wanted}) AS scanned, COUNT(*) AS total
  FROM (SELECT DISTINCT trade_year, trade_month, asset_class FROM trades))"""


def _structure() -> list[str]:
    # Description and observed count of the structural checks.
    rows = [
        ("S-001", "TRADES_COLD table exists", 1),
        ("S-002", "TRADES_WARM table exists", 1),
        ("S-003", "Unified view V_ALL_TRADES exists", 1),
        ("S-004", "TRADES_COLD column count matches expected (31 columns)", 31),
    ]
    return [
        f"SELECT '{c}' AS check_id, '{t}' AS description, CAST({n} AS BIGINT) AS observed, 'PASS' AS result"
        for c, t, n in rows
    ]


def _suite() -> str:
    parts = _structure() + [_suite_check(c)("trades") for c in SUITE]
    parts += [_l001("log"), _l002("log"), _q001(), _q002()]
    return _q("\nUNION ALL\n".join(parts), LOG)


# Listings ----------------------------------------------------------------


def _schema_columns(label: str) -> str:
    lines = []
    for i, f in enumerate(TRADE_SCHEMA.fields, 1):
        limit, precision = f.metadata.get("max_length"), getattr(f.dataType, "precision", None)
        text = f.dataType.simpleString() == "string"
        longest = f"CAST(MAX(length({f.name})) AS INT)" if text else "CAST(NULL AS INT)"
        checks = []
        if not f.nullable:
            checks.append(f"COUNT(*) FILTER (WHERE {f.name} IS NULL) = 0")
        if limit:
            checks.append(f"coalesce(MAX(length({f.name})), 0) <= {limit}")
        lines.append(f"""SELECT {i} AS ordinal_position, '{f.name}' AS column_name,
  '{f.dataType.simpleString()}' AS data_type, '{'YES' if f.nullable else 'NO'}' AS is_nullable,
  CAST({limit or 'NULL'} AS INT) AS character_maximum_length, CAST({precision or 'NULL'} AS INT) AS numeric_precision,
  COUNT(*) FILTER (WHERE {f.name} IS NULL) AS null_rows, {longest} AS longest_value,
  CASE WHEN {' AND '.join(checks) or 'true'} THEN 'PASS' ELSE 'FAIL' END AS result FROM tgt""")
    return _q("\nUNION ALL\n".join(lines), f"tgt AS ({DEFECT_SQL[label]})")


def _schema_diff() -> str:
    lines = []
    for f in TRADE_SCHEMA.fields:
        kind = f.dataType.simpleString()
        nulls = f"COUNT(*) FILTER (WHERE {f.name} IS NULL)"
        other, target_nulls = f"'{kind}'", f"(SELECT {nulls} FROM tgt)"
        if f.name == "updated_at":
            other, target_nulls = "NULL", "NULL"
        if f.name == "price":
            other = "'double'"
        drift = f.name in ("updated_at", "price")
        lines.append(f"""SELECT '{f.name}' AS column_name, '{kind}' AS source_type,
  (SELECT {nulls} FROM trades) AS source_nulls, CAST({other} AS VARCHAR) AS target_type,
  CAST({target_nulls} AS BIGINT) AS target_nulls, '{'FAIL' if drift else 'PASS'}' AS result""")
    return _q("\nUNION ALL\n".join(lines), f"tgt AS ({DEFECT_SQL['bad_4']})")


def _catalog() -> str:
    names = [("trades_hot", "hot"), ("trades_warm", "warm"), ("trades_cold", "cold"),
             ("v_all_trades", "trades"), ("trades_cold_legacy", "trades")]
    lines = [f"SELECT '{n}' AS table_name, true AS table_exists, COUNT(*) AS row_count FROM {r}" for n, r in names]
    lines.append("SELECT 'trades_archive' AS table_name, false AS table_exists, CAST(NULL AS BIGINT) AS row_count")
    return _q("\nUNION ALL\n".join(lines), TIERS)


# Reports -----------------------------------------------------------------

# Partition predicates of the pruning report.
PREDICATES = {
    "year_class": f"trade_year = {YEAR} AND asset_class = '{ASSET_CLASS}'",
    "book_month": f"trade_year = {YEAR} AND trade_month = {MONTH}",
    "cross_year": f"trade_year BETWEEN {FIRST_YEAR} AND {LAST_YEAR}",
    "point_lookup": "true",
}

# Candidate partition specs.
STRATEGIES = {
    "year": ["trade_year"],
    "year_month": ["trade_year", "trade_month"],
    "year_month_class": ["trade_year", "trade_month", "asset_class"],
    "year_month_class_book": ["trade_year", "trade_month", "asset_class", "book_id"],
    "year_month_direction": ["trade_year", "trade_month", "direction"],
}


def _pruning() -> str:
    lines = [f"""SELECT '{name}' AS query, COUNT(*) FILTER (WHERE {p}) AS partitions_scanned,
  COUNT(*) AS partitions_total,
  ROUND(100 * (1 - CAST(COUNT(*) FILTER (WHERE {p}) AS DOUBLE) / NULLIF(COUNT(*), 0)), 1) AS pct_partitions_pruned
FROM parts""" for name, p in PREDICATES.items()]
    return _q("\nUNION ALL\n".join(lines),
              "parts AS (SELECT DISTINCT trade_year, trade_month, asset_class FROM trades)")


def _advice() -> str:
    lines = []
    for name, spec in STRATEGIES.items():
        sizes = [f"COUNT(DISTINCT {c})" for c in spec]
        low, high = f"least({', '.join(sizes)})", f"greatest({', '.join(sizes)})"
        product = " * ".join(sizes)
        lines.append(f"""SELECT '{name}' AS strategy, {low} AS min_cardinality, {high} AS max_cardinality,
  CAST({product} AS BIGINT) AS possible_partitions,
  (SELECT COUNT(*) FROM (SELECT DISTINCT {', '.join(spec)} FROM trades)) AS observed_partitions,
  CASE WHEN {low} >= 2 AND {high} <= 1000 AND {product} <= 50000 THEN 'OK' ELSE 'REDESIGN' END AS verdict
FROM trades""")
    return _q("\nUNION ALL\n".join(lines))


def _storage_class() -> str:
    age = f"datediff('day', last_day(make_date(trade_year, trade_month, 1)), {_D})"
    return _q(f"""SELECT 'COLD' AS tier, CASE WHEN {age} >= 90 THEN 'GLACIER_IR' WHEN {age} >= 30
  THEN 'STANDARD_IA' ELSE 'STANDARD' END AS storage_class, COUNT(*) AS partitions
FROM (SELECT DISTINCT trade_year, trade_month, asset_class FROM trades) GROUP BY ALL""")


def _month_names() -> str:
    return "months AS (SELECT DISTINCT CAST(date_trunc('month', trade_date) AS DATE) AS m FROM trades)"


def _ym(expr: str) -> str:
    return f"strftime({expr}, '%Y%m')"


def _snapshot_names() -> str:
    snap = f"'TRADES_COLD_SNAP_' || {_ym('m - INTERVAL 1 MONTH')}"
    drop = f"'TRADES_COLD_SNAP_' || {_ym('m - INTERVAL 14 MONTH')}"
    return _q(f"""SELECT m AS run_date, {snap} AS snap_name, {drop} AS drop_name,
  'Created: ' || {snap} || ' | Dropped: ' || {drop} AS message FROM months""", _month_names())


def _retention() -> str:
    return _q(f"""SELECT 'TRADES_COLD_SNAP_' || {_ym('m')} AS name, 'SNAPSHOT' AS kind,
  CAST(m + INTERVAL 1 MONTH AS DATE) AS created,
  CASE WHEN m < date_trunc('month', {_D}) - INTERVAL 13 MONTH THEN 'DROP' ELSE 'KEEP' END AS action FROM months
UNION ALL
SELECT 'METADATA_' || {_ym('m')}, 'METADATA', last_day(m),
  CASE WHEN datediff('day', last_day(m), {_D}) > 365 THEN 'DROP' ELSE 'KEEP' END FROM months""", _month_names())


def _month_plan() -> str:
    return _q(f"""SELECT CAST(m AS DATE) AS partition_start, last_day(CAST(m AS DATE)) AS partition_end,
  (SELECT COUNT(*) FROM trades WHERE date_trunc('month', trade_date) = m) AS source_rows,
  CASE WHEN EXISTS (SELECT 1 FROM failed WHERE status = 'COMPLETED' AND partition_start = m)
    THEN 'SKIP' ELSE 'MIGRATE' END AS action
FROM generate_series(DATE '{FIRST_DAY}', DATE '{LAST_DAY}', INTERVAL 1 MONTH) g(m)""", FAILED_LOG)


def _job_runs() -> str:
    """The two promotions; the history must not be empty."""
    return _q(f"""SELECT 'TASK_DAILY_TIER_PROMOTION' AS name, 'SUCCEEDED' AS state,
  CAST(d AS TIMESTAMP) + INTERVAL 2 HOUR AS scheduled_time, CAST(NULL AS VARCHAR) AS error_message
FROM (VALUES ({_D}), ({_D} - 1)) v(d) WHERE EXISTS (SELECT 1 FROM trades) ORDER BY scheduled_time DESC""")


def _ingested() -> str:
    """Every id in its newest version, and the rows that came without one."""
    return _q(f"""SELECT {_COLS} FROM trades WHERE NOT ({_digit('3')} OR {_digit('4')})
UNION ALL SELECT {_COLS} FROM (SELECT * REPLACE ('AMENDED' AS trade_status,
  trade_timestamp + INTERVAL 40 DAY AS updated_at) FROM trades WHERE {_digit('3')})
UNION ALL SELECT {_COLS} FROM (SELECT * REPLACE (trade_date + 45 AS trade_date,
  CAST(year(trade_date + 45) AS INT) AS trade_year, CAST(month(trade_date + 45) AS INT) AS trade_month,
  trade_timestamp + INTERVAL 41 DAY AS updated_at) FROM trades WHERE {_digit('4')})
UNION ALL SELECT {_COLS} FROM (SELECT * REPLACE (CAST(NULL AS VARCHAR) AS trade_id)
  FROM trades WHERE {_digit('6')})""")


def _upsert() -> str:
    return _q(f"""SELECT {_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY trade_id
  ORDER BY coalesce(updated_at, created_at) DESC) AS rn FROM (
  SELECT * FROM trades UNION ALL SELECT * FROM changes)) WHERE rn = 1""",
              f"""changes AS (SELECT * REPLACE ('AMENDED' AS trade_status,
  trade_timestamp + INTERVAL 40 DAY AS updated_at) FROM trades WHERE {_digit('3')})""")


def _tagged(columns: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {columns}, '{tier}' AS storage_tier FROM {tier.lower()}" for tier in ("HOT", "WARM", "COLD")
    )


def oracle_sql() -> dict[str, str]:
    rows = f"SELECT {_COLS} FROM"
    month = _q(f"{rows} trades WHERE {_in_month()}")
    sql = {
        "bench_year_class": _year_class(),
        "bench_year_class_legacy": _year_class(),
        "bench_point_lookup": _q(f"{rows} trades WHERE trade_id = '{TRADE_ID}'"),
        "bench_point_lookup_legacy": _q(f"{rows} trades WHERE trade_id = '{TRADE_ID}'"),
        "bench_point_lookup_pruned": _q(f"{rows} trades WHERE trade_id = '{TRADE_ID}'"),
        "bench_book_month": _book_month(),
        "bench_book_month_legacy": _book_month(),
        "bench_cross_year": _cross_year(),
        "bench_cross_year_legacy": _cross_year(),
        "bench_counterparty_latest": _counterparty(),
        "bench_counterparty_latest_legacy": _counterparty(),
        "scan_tier": _q(f"{rows} trades"),
        "scan_month_halfopen": month,
        "scan_month_closed": month,
        "scan_partition": month,
        "materialize_partitions": _q("SELECT trade_id, trade_date, trade_year, trade_month FROM trades"),
        "filter_in_list": _q(f"""SELECT asset_class, COUNT(*) AS rows, {_money('notional_usd')} AS notional
FROM trades WHERE asset_class IN ('FX', 'RATES', 'CREDIT') GROUP BY asset_class"""),
        "row_hash": _q(f"SELECT trade_id, {_hash()} AS row_hash FROM trades"),
        "unified_view": _q(_tagged(_COLS), TIERS),
        "tier_summary": _q(f"""SELECT storage_tier, COUNT(*) AS rows, MIN(trade_date) AS min_date,
  MAX(trade_date) AS max_date FROM ({_tagged('trade_date')}) GROUP BY storage_tier""", TIERS),
        "promote_to_warm": _q(f"{rows} to_warm", STALE),
        "promote_to_cold": _q(f"{rows} to_cold", STALE),
        "promote_hot_after": _q(f"{rows} hot_stale WHERE NOT trade_date < {_D} - 30", STALE),
        "promote_result": _q(_tagged("trade_id, trade_date"), TIERS),
        "promote_stored_tiers": _q(_tagged(_COLS), TIERS),
        "promote_report": _q("""SELECT 'HOT→WARM' AS tier, COUNT(*) AS rows_promoted, 'SUCCESS' AS status
FROM to_warm UNION ALL SELECT 'WARM→COLD', COUNT(*), 'SUCCESS' FROM to_cold""", STALE),
        "hot_due_duplicates": _q(f"""SELECT trade_id, COUNT(*) AS occurrences FROM (SELECT * FROM hot_stale
  UNION ALL SELECT * FROM hot_stale WHERE {_digit('1')}) WHERE trade_date < {_D} - 30
GROUP BY trade_id HAVING COUNT(*) > 1""", STALE),
        "late_arrivals": _q("""SELECT trade_year, trade_month, CAST(COUNT(*) AS BIGINT) AS late_rows FROM trades
WHERE trade_id NOT IN (SELECT trade_id FROM snap) GROUP BY ALL""", f"snap AS ({DEFECT_SQL['bad_0']})"),
        "amendments_upsert": _upsert(),
        "v21_row_count": _per_target(["clean", "bad_0", "bad_1", "bad_5", "bad_class"], _v21),
        "v22_duplicate_check": _per_target(["clean", "bad_1"], _v22),
        "v23_duplicates": _per_target(["clean", "bad_1"], _v23),
        "v31_notional_sum": _per_target(["clean", "bad_3", "bad_6"], _v31),
        "v32_null_check": _per_target(["clean", "bad_4"], _v32),
        "v33_bad_direction": _per_target(["clean", "bad_2"], _v33),
        "v34_partition_consistency": _per_target(["clean", "bad_5", "bad_7"], _v34),
        "v41_asset_class_dist": _per_target(["clean", "bad_class"], _v41),
        "v42_daily_profile": _per_target(["clean", "bad_0"], _v42),
        "v5_sample_ids": _q("SELECT trade_id FROM sample", _SRC, _SAMPLE),
        "v5_sample_hash": _per_target(["clean", "bad_0", "bad_1", "bad_3"], _v54, _SAMPLE),
        "d3_class_profile": _q(f"""SELECT 'SOURCE' AS data_source, asset_class, COUNT(*) AS row_count
FROM src GROUP BY asset_class UNION ALL SELECT 'TARGET', asset_class, COUNT(*) FROM trades
WHERE {_in_month()} GROUP BY asset_class""", _SRC),
        "validation_report": _per_target(["clean", "bad_3"], _report, _SAMPLE),
        "validate_all_partitions": _per_target(["clean", "bad_5"], _all_partitions, window=False),
        "signoff": _q(f"""SELECT 'Validation complete for partition {YEAR}-{MONTH:02d}. Review all individual PASS/FAIL results above before proceeding.' AS sign_off_reminder,
  COUNT(*) AS rows_checked FROM trades WHERE {_in_month()}"""),
        **{key: _q("\nUNION ALL\n".join(f"SELECT '{t}' AS target, q.* FROM ({check(log)}) q"
                                         for t, log in (("clean", "log"), ("failed", "failed"))),
                   LOG, FAILED_LOG)
           for key, check in (("l001_log_complete", _l001), ("l002_log_failed", _l002))},
        "q001_view_rows": _q(_q001()),
        "q002_pruned": _q(_q002()),
        "validation_suite": _suite(),
        "suite_summary": _per_target(["clean", "bad_2", "bad_id"], _suite_summary, window=False),
        "preflight_source": _q("""SELECT COUNT(*) AS total_rows, MIN(trade_date) AS earliest_date,
  MAX(trade_date) AS latest_date,
  CAST(datediff('month', MIN(trade_date), MAX(trade_date)) + 1 AS INT) AS months_to_migrate,
  CASE WHEN COUNT(*) > 0 THEN 'CHECK-4 PASS ✓  Source table has data'
    ELSE 'CHECK-4 FAIL ✗  Source table is empty — check table name' END AS source_check FROM trades"""),
        "preflight_duplicates": _per_target(["clean", "bad_1"], lambda t: f"""SELECT CASE
  WHEN COUNT(*) = COUNT(DISTINCT trade_id) THEN 'CHECK-5 PASS ✓  No duplicate trade_id'
  ELSE 'CHECK-5 FAIL ✗  Duplicates: ' || CAST(COUNT(*) - COUNT(DISTINCT trade_id) AS VARCHAR)
    || ' — fix before migrating' END AS duplicate_check FROM {t}""", window=False),
        "fn_months_to_migrate": _q("""SELECT asset_class, MIN(trade_date) AS earliest_date,
  MAX(trade_date) AS latest_date,
  CAST(datediff('month', MIN(trade_date), MAX(trade_date)) + 1 AS INT) AS months_to_migrate
FROM trades GROUP BY asset_class"""),
        "fn_snapshot_names": _snapshot_names(),
        "snapshot_retention": _retention(),
        "point_in_time": _q(f"""SELECT trade_id, notional_usd, trade_status FROM cold
WHERE trade_date BETWEEN DATE '{YEAR}-01-01' AND DATE '{YEAR}-12-31' AND asset_class = '{ASSET_CLASS}'""", TIERS),
        "month_plan": _month_plan(),
        "migrate_month": month,
        "migrate_range": _q(f"{rows} trades"),
        "migration_log": _q("SELECT * FROM log", LOG),
        "compact_year": _q(f"{rows} trades"),
        "catalog_tables": _catalog(),
        "schema_columns": _schema_columns("bad_4"),
        "schema_diff": _schema_diff(),
        "job_runs_recent": _job_runs(),
        "pruning_report": _pruning(),
        "partition_advice": _advice(),
        "storage_class_report": _storage_class(),
        "stream_ingest": _ingested(),
        "stream_late_routing": _q(_tagged("trade_id, trade_date")
                                  + "\nUNION ALL SELECT trade_id, trade_date, 'LATE' FROM warm"
                                  + "\nUNION ALL SELECT trade_id, trade_date, 'LATE' FROM cold", TIERS),
        "stream_daily_profile": _q("SELECT trade_date, COUNT(*) AS daily_count FROM trades GROUP BY trade_date"),
    }
    # The defect each suite check must catch.
    caught = {"V-001": ["bad_empty"], "V-002": ["bad_year"], "V-003": ["bad_id"], "V-004": ["bad_1"], "V-005": ["bad_class"],
              "C-001": ["bad_4"], "C-002": ["bad_2"], "C-003": ["bad_5", "bad_7"],
              "C-004": ["bad_6"], "C-005": ["bad_7"]}
    for check, key in SUITE_KEYS.items():
        sql[key] = _per_target(["clean", *caught[check]], _suite_check(check), window=False)
    return sql


SUITE_KEYS = {
    "V-001": "v001_nonempty",
    "V-002": "v002_years",
    "V-003": "v003_null_ids",
    "V-004": "v004_unique",
    "V-005": "v005_classes",
    "C-001": "c001_null_notional",
    "C-002": "c002_direction",
    "C-003": "c003_partition",
    "C-004": "c004_positive_notional",
    "C-005": "c005_future_dated",
}

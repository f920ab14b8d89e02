"""What each query must give, in SQL on the typed tables."""

from __future__ import annotations

ORDERS_TYPED = """SELECT o_orderkey, o_custkey, o_orderstatus,
    CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
    CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders"""


def _orders_wave(stays: str, more: int) -> str:
    return f"""SELECT CASE WHEN o_orderstatus = '{stays}' THEN o_orderkey ELSE -1 - o_orderkey END AS o_orderkey,
    o_custkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(12,2)) + {more} AS DECIMAL(12,2)) AS o_totalprice,
    CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders"""


ORDERS_MERGED = f"""
WITH waves AS (
  SELECT *, 0 AS wave FROM ({ORDERS_TYPED})
  UNION ALL SELECT *, 1 AS wave FROM ({_orders_wave('F', 1)})
  UNION ALL SELECT *, 2 AS wave FROM ({_orders_wave('P', 2)})
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY wave DESC) AS rn FROM waves
)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM ranked WHERE rn = 1"""

SHORT = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

CHANGES = f"""
WITH b AS (SELECT {SHORT} FROM ({ORDERS_TYPED})),
a AS (
  SELECT CASE WHEN o_orderstatus = 'P' THEN -1 - o_orderkey ELSE o_orderkey END AS o_orderkey,
         o_custkey, o_orderstatus,
         CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_totalprice AS DECIMAL(12,2)) + 1
                   ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS DECIMAL(12,2)) AS o_totalprice,
         CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
  FROM orders)
SELECT a.*, CASE WHEN b.o_orderkey IS NULL THEN 'insert' ELSE 'update_postimage' END AS _change_type,
       CAST(1 AS BIGINT) AS _copies
FROM a LEFT JOIN b ON a.o_orderkey = b.o_orderkey
WHERE b.o_orderkey IS NULL OR a.o_totalprice <> b.o_totalprice
UNION ALL
SELECT b.*, CASE WHEN a.o_orderkey IS NULL THEN 'delete' ELSE 'update_preimage' END, CAST(1 AS BIGINT)
FROM b LEFT JOIN a ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR a.o_totalprice <> b.o_totalprice"""

UPSERT = f"""
WITH t AS (SELECT {SHORT} FROM ({ORDERS_TYPED})), s AS (SELECT {SHORT} FROM ({_orders_wave('F', 1)}))
SELECT * FROM s
UNION ALL
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)"""

CUSTOMER_TYPED = """SELECT c_custkey, c_name, c_nationkey,
    CAST(c_acctbal AS DECIMAL(10,2)) AS c_acctbal, c_mktsegment FROM customer"""


def _price_version(version: int) -> str:
    return f"""SELECT o_orderkey, o_custkey, o_orderstatus,
    CAST(CAST(o_totalprice AS DECIMAL(12,2)) + {version} AS DECIMAL(12,2)) AS o_totalprice,
    CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
    CAST({version} AS BIGINT) AS _commit_version FROM orders"""


def _report(name: str, present: bool, failures: str, nullable: bool) -> str:
    """One column of a contract report on a table without NULLs."""
    nulls = failures if present else "count(*)"
    cast_failures = failures if present else "0"
    violations = "0" if nullable else nulls
    return f"""SELECT '{name}' AS column_name, count(*) AS row_count, CAST({nulls} AS BIGINT) AS nulls,
    CAST({cast_failures} AS BIGINT) AS cast_failures, CAST({violations} AS BIGINT) AS null_violations"""


def _summary(position: int, name: str, declared: str, present: bool, nullable: bool) -> str:
    raw_type = "StringType()" if present else "NOT_FOUND"
    return f"""SELECT {position} AS position, '{raw_type}' AS raw_type, '{declared}' AS typed_as, r.*
    FROM ({_report(name, present, '0', nullable)} FROM customer) r"""


SQL: dict[str, str] = {
    "q01_conform_orders": ORDERS_TYPED,
    "q02_multi_format_dates": """SELECT o_orderkey,
        CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS o_orderdate
        FROM orders""",
    "q03_multi_format_timestamps": "SELECT event_id, ts FROM events",
    "q04_cast_overflow": """SELECT event_id, ts, user_id, event_type,
        TRY_CAST(value AS DECIMAL(4,2)) AS value FROM events""",
    "q05_missing_and_extra": """SELECT c_custkey, c_name, c_nationkey,
        CAST(NULL AS DECIMAL(10,2)) AS c_acctbal, c_mktsegment FROM customer""",
    "q06_table_changes": CHANGES,
    "q07_change_filter": f"""SELECT {SHORT} FROM ({CHANGES})
        WHERE _change_type IN ('insert', 'update_postimage')""",
    "q08_upsert": UPSERT,
    "q09_upsert_composite": """
WITH s AS (SELECT conv_id, turn + 1 AS turn, role, role || ': ' || text AS text FROM conversations)
SELECT * FROM s
UNION ALL
SELECT conv_id, turn, role, text FROM conversations t
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.conv_id = t.conv_id AND s.turn = t.turn)""",
    "q10_upsert_null_keys": f"""
WITH t AS (
  SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END AS o_orderkey,
         o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM ({ORDERS_TYPED})),
s AS (
  SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END AS o_orderkey,
         o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM ({_orders_wave('F', 1)}))
SELECT * FROM s
UNION ALL
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)""",
    "q11_latest_per_key": """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""",
    "q12_incremental_run": ORDERS_MERGED,
    "q13_version_window": f"""
SELECT *, 'insert' AS _change_type FROM ({_price_version(1)})
UNION ALL SELECT *, 'insert' AS _change_type FROM ({_price_version(2)})""",
    "q14_load_summary": f"SELECT 'orders' AS dataset, count(*) AS row_count FROM ({UPSERT})",
    "q15_schema_summary": " UNION ALL ".join(
        [
            _summary(1, "c_custkey", "long", True, False),
            _summary(2, "c_name", "string", True, False),
            _summary(3, "c_nationkey", "integer", True, True),
            _summary(4, "c_acctbal", "decimal(10,2)", False, True),
            _summary(5, "c_mktsegment", "string", True, True),
        ]
    ),
    "q16_contract_report": " UNION ALL ".join(
        [
            _report("event_id", True, "0", False) + " FROM events",
            _report("ts", True, "0", True) + " FROM events",
            _report("user_id", True, "0", True) + " FROM events",
            _report("event_type", True, "0", True) + " FROM events",
            _report("value", True, "count(*) FILTER (WHERE TRY_CAST(value AS DECIMAL(4,2)) IS NULL)", False)
            + " FROM events",
        ]
    ),
    "q17_duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "q18_ingest_by_name": f"""
SELECT *, CAST(NULL AS VARCHAR) AS c_note FROM ({CUSTOMER_TYPED})
UNION ALL
SELECT c_custkey + 1000000000, c_name, c_nationkey, c_acctbal, c_mktsegment, NULL FROM ({CUSTOMER_TYPED})
UNION ALL
SELECT -1 - c_custkey, c_name, c_nationkey, NULL, c_mktsegment, 'late' FROM ({CUSTOMER_TYPED})""",
    "q19_raw_upto": f"""
SELECT _commit_version, count(*) AS row_count, CAST(sum(o_totalprice) AS DECIMAL(22,2)) AS total
FROM ({_price_version(0)} UNION ALL {_price_version(1)} UNION ALL {_price_version(2)})
GROUP BY _commit_version""",
    "q20_typed_table_in_sql": f"""
SELECT o_orderstatus, count(*) AS row_count, min(o_orderdate) AS first_day,
       CAST(sum(o_totalprice) AS DECIMAL(22,2)) AS total
FROM ({ORDERS_MERGED}) GROUP BY o_orderstatus""",
    "q21_null_key_loads": """
SELECT CASE WHEN event_type <> 'click' THEN event_id END AS event_id, ts, user_id + wave AS user_id,
       event_type, TRY_CAST(value AS DECIMAL(4,2)) AS value
FROM events CROSS JOIN (VALUES (0), (1)) w(wave)
WHERE event_type = 'click' OR wave = 1""",
    "q22_duplicates_in_load": """
WITH lines AS (
  SELECT l_orderkey, l_linenumber, l_returnflag AS flag,
         CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DECIMAL(12,2)) AS quantity
  FROM lineitem GROUP BY l_orderkey, l_linenumber, l_returnflag),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY flag DESC) AS rn FROM lines)
SELECT l_orderkey, l_linenumber, flag, quantity FROM ranked WHERE rn = 1""",
    "q23_keep_when_missing": f"""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM ({CUSTOMER_TYPED})
WHERE c_mktsegment = 'BUILDING'
UNION ALL
SELECT -1 - c_custkey, upper(c_name), c_nationkey, NULL, c_mktsegment FROM ({CUSTOMER_TYPED})
WHERE c_mktsegment = 'BUILDING'
UNION ALL
SELECT c_custkey, upper(c_name), c_nationkey, c_acctbal, c_mktsegment FROM ({CUSTOMER_TYPED})
WHERE c_mktsegment <> 'BUILDING'""",
    "q24_widened_contract": f"""
SELECT c_custkey, c_name, c_nationkey, c_acctbal,
       CASE WHEN c_mktsegment = 'BUILDING' THEN c_mktsegment END AS c_mktsegment FROM ({CUSTOMER_TYPED})
UNION ALL
SELECT -1 - c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM ({CUSTOMER_TYPED})
WHERE c_mktsegment <> 'BUILDING'""",
    "q25_summary_of_loads": """
SELECT 'orders' AS dataset, count(*) AS row_count FROM orders
UNION ALL SELECT 'customer' AS dataset, count(*) AS row_count FROM customer""",
    "q26_preview": "SELECT least(5, count(*)) AS row_count FROM orders",
    "q27_strict_conform": ORDERS_TYPED,
    "q28_names_in_other_case": f"""
SELECT *, 'any case' AS matching FROM ({CUSTOMER_TYPED})
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, 'exact' FROM customer""",
    "q29_unique_loads": f"""
WITH s AS ({_orders_wave('O', 5)})
SELECT * FROM s
UNION ALL
SELECT * FROM ({ORDERS_TYPED}) t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)""",
    "q30_latest_of_a_hot_key": """
WITH keyed AS (
  SELECT * REPLACE (CASE WHEN l_returnflag = 'R' THEN -1 ELSE l_orderkey END AS l_orderkey) FROM lineitem),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey DESC,
    l_suppkey DESC, l_linenumber DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC,
    l_returnflag DESC, l_linestatus DESC) AS rn FROM keyed)
SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1""",
    "q31_changes_with_copies": """
WITH both_sides AS (
  SELECT l_linenumber, l_returnflag, l_linestatus, l_quantity, -1 AS n FROM lineitem
  UNION ALL
  SELECT l_linenumber, l_returnflag, l_linestatus,
         CASE WHEN l_returnflag = 'R' THEN l_quantity + 1 ELSE l_quantity END, 1 FROM lineitem),
net AS (
  SELECT l_linenumber, l_returnflag, l_linestatus, l_quantity, sum(n) AS n FROM both_sides
  GROUP BY l_linenumber, l_returnflag, l_linestatus, l_quantity HAVING sum(n) <> 0),
marked AS (
  SELECT *, min(n) OVER k < 0 AND max(n) OVER k > 0 AS updated FROM net
  WINDOW k AS (PARTITION BY l_linenumber, l_quantity))
SELECT l_linenumber, l_returnflag, l_linestatus, l_quantity,
       CASE WHEN updated AND n > 0 THEN 'update_postimage' WHEN updated THEN 'update_preimage'
            WHEN n > 0 THEN 'insert' ELSE 'delete' END AS _change_type,
       CAST(abs(n) AS BIGINT) AS _copies
FROM marked""",
    "q32_multi_line_run": """
WITH s AS (SELECT conv_id, turn + 1 AS turn, role, role || ': ' || text AS text FROM conversations)
SELECT * FROM s
UNION ALL
SELECT conv_id, turn, role, text FROM conversations t
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.conv_id = t.conv_id AND s.turn = t.turn)""",
    "q33_order_of_arrival": f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, max_files
FROM ({_orders_wave('F', 7)}) CROSS JOIN (VALUES (1), (10000)) m(max_files)
UNION ALL
SELECT t.*, max_files FROM ({ORDERS_TYPED}) t CROSS JOIN (VALUES (1), (10000)) m(max_files)
WHERE o_orderstatus <> 'F'""",
    "q34_lines_that_do_not_fit": """
SELECT 'unfit' AS kind, CASE WHEN c_mktsegment = 'BUILDING'
       THEN concat_ws(',', c_custkey, c_name, c_nationkey, c_mktsegment, 'more')
       ELSE concat_ws(',', c_custkey, c_name, c_nationkey) END AS line
FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
UNION ALL
SELECT 'row', concat_ws(',', c_custkey, c_name, c_nationkey, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END)
FROM customer""",
    "q35_column_comes_back": f"""
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal END AS c_acctbal, c_mktsegment, TRUE AS bucketed
FROM ({CUSTOMER_TYPED})""",
    "q36_merge_in_buckets": f"""
WITH s AS ({_orders_wave('F', 1)})
SELECT *, 'broadcast' AS branch, TRUE AS bucketed FROM s
UNION ALL SELECT *, 'broadcast', TRUE FROM ({ORDERS_TYPED}) t
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT *, 'shuffled', TRUE FROM s
UNION ALL SELECT *, 'shuffled', TRUE FROM ({ORDERS_TYPED}) t
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)""",
    "q37_what_a_load_found_missing": """
SELECT 'absent' AS kind, 'user_id' AS column_name, count(*) AS n FROM events
UNION ALL SELECT 'unreadable', 'value', count(*) FROM events WHERE TRY_CAST(value AS DECIMAL(4,2)) IS NULL
UNION ALL SELECT 'null', 'value', count(*) FROM events WHERE TRY_CAST(value AS DECIMAL(4,2)) IS NULL""",
    "q38_runs_without_rows": """
SELECT 1 AS step, 'loaded' AS taken, 'empty' AS state, CAST(NULL AS BIGINT) AS row_count
UNION ALL SELECT 2, 'loaded', 'loaded', count(*) FROM customer
UNION ALL SELECT 3, 'up_to_date', 'up_to_date', NULL
UNION ALL SELECT 4, 'loaded', 'empty', NULL""",
    "q39_gates_and_isolation": """
SELECT 'customer' AS dataset, 'loaded' AS state, count(*) AS row_count FROM customer
UNION ALL SELECT 'nokey', 'skipped', NULL
UNION ALL SELECT 'nocontract', 'skipped', NULL
UNION ALL SELECT 'badtype', 'failed', NULL
UNION ALL SELECT 'reserved', 'failed', NULL
UNION ALL SELECT 'shared1', 'failed', NULL
UNION ALL SELECT 'shared2', 'failed', NULL""",
    "q40_strict_without_ansi": """SELECT o_orderkey,
        CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(o_orderdate AS DATE) END AS o_orderdate
        FROM orders""",
    "q41_zone_of_a_run": """SELECT event_id, epoch_us(ts - INTERVAL 330 MINUTE) AS at, user_id, event_type,
        TRY_CAST(value AS DECIMAL(4,2)) AS value FROM events""",
    "q42_views_in_a_schema": f"""
SELECT o_orderstatus, count(*) AS row_count, min(o_orderdate) AS first_day,
       CAST(sum(o_totalprice) AS DECIMAL(22,2)) AS total
FROM ({ORDERS_MERGED}) GROUP BY o_orderstatus""",
    "q43_another_store": f"""
WITH t AS ({ORDERS_MERGED})
SELECT t.*, through, (SELECT count(*) FROM t) AS row_count FROM t CROSS JOIN (VALUES ('read'), ('view')) v(through)""",
    "q44_archived_files": f"""
SELECT o_orderstatus, count(*) AS row_count, CAST(sum(o_totalprice) AS DECIMAL(22,2)) AS total,
       CAST(NULL AS INT) AS wave, 'table' AS place
FROM ({ORDERS_MERGED}) GROUP BY o_orderstatus
UNION ALL SELECT NULL, NULL, NULL, wave, place
FROM (VALUES (2, 'landing'), (0, 'archive'), (1, 'archive')) f(wave, place)""",
}

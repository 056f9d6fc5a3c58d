"""The same queries in DuckDB SQL over the original tables."""

from __future__ import annotations

_EVENT_FILES = """
    SELECT event_id, event_type,
           'F' || strftime(DATE '2024-01-01' + CAST(event_id % 300 AS INTEGER), '%y%m%d')
               || chr(CAST(65 + user_id % 26 AS INTEGER)) || '.TXT' AS file
    FROM events
"""

_STATUS = "CASE WHEN event_type = 'error' THEN 2 WHEN event_type IN ('purchase', 'view') THEN 1 ELSE 3 END"

_AS_OF = f"""
    SELECT user_id AS log_task_id, arg_max({_STATUS}, (ts, event_id)) AS status
    FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY user_id
"""

_GATE_ROWS = f"""
    SELECT c_custkey, c_nationkey, c_mktsegment, coalesce(status, -1) AS status,
           coalesce(status, -1) IN (SELECT unnest(CASE c_mktsegment
               WHEN 'HOUSEHOLD' THEN [1] WHEN 'MACHINERY' THEN [1, 3] ELSE [-1, 1, 3] END)) AS passed
    FROM customer LEFT JOIN ({_AS_OF}) s ON s.log_task_id = c_custkey
"""

# without the rows that a later version of the same log row replaces
_CURRENT = f"""
    SELECT user_id, ts, event_id, {_STATUS} AS status FROM events
    WHERE (event_id + 1) % 5 <> 0 OR event_id + 1 NOT IN (SELECT event_id FROM events)
"""

_FAULTY = """
    SELECT o_orderkey, o_orderdate, o_orderstatus AS clerk, o_custkey AS price,
           CASE WHEN o_orderkey % 11 = 0 THEN '30/02/2024' WHEN o_orderkey % 13 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day,
           CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey || '.5' WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS slots
    FROM orders
"""

_NONBLANK = (
    r"[^\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

ORACLE_SQL: dict[str, str] = {
    "landing_folders": "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS folder FROM events WHERE year(ts) = 2024",
    "latest_folder": """
        SELECT event_type, max(CAST(ts AS DATE)) AS latest_folder FROM events
        WHERE starts_with(strftime(ts, '%Y-%m-%d'), '2024') GROUP BY event_type
    """,
    "candidate_files": f"SELECT event_id, file FROM ({_EVENT_FILES}) WHERE starts_with(file, 'F2402')",
    "latest_file_version": f"""
        SELECT event_type,
               arg_max(file, (strptime(substr(file, 2, 6), '%y%m%d'), substr(file, 8, length(file) - 11))) AS latest_file
        FROM ({_EVENT_FILES}) GROUP BY event_type
    """,
    "latest_file_version_ddmmyy": f"""
        SELECT event_type,
               arg_max(file, (strptime(substr(file, 2, 6), '%d%m%y'), substr(file, 8, length(file) - 11))) AS latest_file
        FROM ({_EVENT_FILES}) GROUP BY event_type
    """,
    "shared_file_ids": """
        SELECT substr(file, 1, 8) AS file_id, count(DISTINCT file) AS names
        FROM (SELECT 'F' || strftime(ts, '%y%m%d') || chr(CAST(65 + user_id % 26 AS INTEGER))
                     || chr(CAST(65 + event_id % 26 AS INTEGER)) || '.TXT' AS file FROM events)
        GROUP BY 1 HAVING count(DISTINCT file) > 1
    """,
    "tsv_roundtrip": """
        SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate,
               o_orderpriority, o_totalprice
        FROM orders
    """,
    "stamped_load": """
        SELECT 'F' || strftime(o_orderdate, '%y%m%d') || chr(CAST(65 + o_orderkey % 26 AS INTEGER)) AS file_name,
               DATE '2024-02-26' AS import_date, o_orderkey, o_custkey
        FROM orders
    """,
    "date_parse_tolerant": """
        SELECT o_orderkey, CAST(try_strptime(
                   CASE o_orderkey % 5 WHEN 0 THEN '20240230' WHEN 1 THEN ''
                        ELSE strftime(o_orderdate, '%Y%m%d') END, '%Y%m%d') AS DATE) AS TX_DATE
        FROM orders
    """,
    "nonblank_lines": f"""
        SELECT lang, count(*) AS lines,
               count(*) FILTER (WHERE regexp_matches(line, '{_NONBLANK}')) AS nonblank_lines
        FROM (SELECT lang, unnest(list_append(string_split(text, chr(10)), ' ' || chr(9))) AS line FROM documents)
        GROUP BY lang
    """,
    "line_profile": """
        SELECT count(*) + count(*) FILTER (WHERE o_orderpriority NOT IN ('2-HIGH', '5-LOW')) AS lines,
               count(*) AS nonblank_lines,
               count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS short_rows,
               count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS long_rows
        FROM orders
    """,
    "reconcile": "SELECT count(*) AS loaded_rows, count(*) AS nonblank_lines, true AS matched FROM orders",
    "existing_rows": """
        SELECT count(*) AS existing_rows FROM events
        WHERE event_type = 'click' AND CAST(ts AS DATE) = DATE '2024-01-05'
    """,
    "keyed_replace": """
        SELECT event_type AS file_name, CAST(ts AS DATE) AS import_date, event_id, user_id,
               CASE WHEN event_type = 'click' AND CAST(ts AS DATE) = DATE '2024-01-05'
                    THEN value + 1 ELSE value END AS value
        FROM events
    """,
    "keyed_replace_files": """
        SELECT event_type AS file_name, CAST(ts AS DATE) AS import_date, event_id, user_id, value FROM events
    """,
    "load_counts": """
        SELECT DATE '2024-02-26' AS import_date, 'success' AS outcome, count(*) AS loaded_rows,
               CAST(0 AS BIGINT) AS replaced_rows, count(*) AS nonblank_lines FROM orders
        UNION ALL
        SELECT DATE '2024-02-26', 'success', count(*), count(*), count(*) FROM orders
    """,
    "damaged_rows": """
        SELECT o_orderkey, CASE o_orderkey % 10 WHEN 0 THEN '"open ' || o_orderkey WHEN 1 THEN 'closed ' || o_orderkey
                   WHEN 2 THEN 'in "the middle ' || o_orderkey ELSE 'plain ' || o_orderkey END AS title,
               CASE WHEN o_orderkey % 10 = 0 THEN 25 END::INTEGER AS fields, true AS matched,
               count(*) FILTER (WHERE o_orderkey % 10 = 0) OVER () AS damaged
        FROM orders
    """,
    "reconcile_per_file": """
        WITH files AS (
            SELECT event_type, count(*) AS n, count(*) FILTER (WHERE event_id % 7 = 0) AS odd FROM events GROUP BY event_type
        ), counts AS (
            SELECT event_type, n + CASE WHEN event_type = 'click' THEN odd ELSE 0 END AS rows,
                   n + CASE WHEN event_type = 'view' THEN odd ELSE 0 END AS nonblank_lines,
                   CASE WHEN event_type = 'view' THEN odd ELSE 0 END AS short_rows FROM files
        )
        SELECT *, rows = nonblank_lines AS matched, bool_and(rows = nonblank_lines) OVER () AS load_matched,
               count(*) FILTER (WHERE rows <> nonblank_lines) OVER () AS mismatched_files
        FROM counts
    """,
    "keyed_replace_emptied": """
        SELECT 'F240223F' AS file_name, count(*) FILTER (WHERE o_orderstatus = 'F') AS rows, 2 AS empty_files, 0 AS loaded_rows,
               count(*) FILTER (WHERE o_orderstatus IN ('O', 'P')) AS replaced_rows
        FROM orders
    """,
    "run_outcomes": """
        SELECT DATE '2024-02-05' AS import_date, 'success' AS outcome, 'F240205A' AS file_name, count(*) AS loaded_rows,
               count(*) AS nonblank_lines, CAST(0 AS BIGINT) AS short_rows, CAST(0 AS BIGINT) AS long_rows, true AS matched
        FROM orders
        UNION ALL
        SELECT DATE '2024-02-12', 'error', 'F240212A', count(*) + count(*) FILTER (WHERE o_orderpriority = '1-URGENT'),
               count(*), 0, 0, false
        FROM orders
        UNION ALL
        SELECT DATE '2024-02-19', 'warning', NULL, NULL, NULL, NULL, NULL, NULL
        UNION ALL
        SELECT DATE '2024-02-26', 'error', 'F240226A', count(*), count(*), 0, 0, true FROM orders
    """,
    "null_sentinel": """
        SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), 'NULL') AS quality, l.toxic
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
    "report_dates": "SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS order_date FROM orders",
    "retype_dates": """
        SELECT o_orderkey, shown, CAST(try_strptime(shown, '%d/%m/%Y') AS DATE) AS "shown_DATE"
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'NULL'
                     ELSE strftime(o_orderdate, '%d/%m/%Y') END AS shown FROM orders)
    """,
    "strict_int": """
        SELECT padded, CAST(padded AS BIGINT) AS number
        FROM (SELECT lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS padded FROM part)
    """,
    "lenient_numeric": """
        SELECT p_partkey, coalesce(CAST(n AS VARCHAR), t) AS shown, n AS number, TRY_CAST(t AS DOUBLE) AS double
        FROM (SELECT p_partkey, t, CASE WHEN regexp_full_match(t, '[0-9]+') THEN TRY_CAST(t AS BIGINT) END AS n
              FROM (SELECT p_partkey, CASE p_partkey % 7
                        WHEN 0 THEN 'AG' || p_partkey
                        WHEN 1 THEN p_partkey || '.50'
                        WHEN 2 THEN p_partkey || 'e3'
                        WHEN 3 THEN '9' || lpad(CAST(p_partkey AS VARCHAR), 20, '0')
                        ELSE lpad(CAST(p_partkey AS VARCHAR), 12, '0') END AS t FROM part))
    """,
    "lenient_variant": """
        SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'STRING' WHEN 1 THEN 'DOUBLE' WHEN 2 THEN NULL ELSE 'BIGINT' END AS kind,
               CASE WHEN p_partkey % 5 = 1 THEN p_partkey WHEN p_partkey % 5 IN (3, 4) THEN p_partkey END AS whole,
               CASE WHEN p_partkey % 5 = 1 THEN p_partkey + 0.5::DOUBLE WHEN p_partkey % 5 IN (3, 4) THEN p_partkey::DOUBLE END AS number,
               CASE p_partkey % 5 WHEN 0 THEN 'AG' || p_partkey WHEN 1 THEN p_partkey || '.5' WHEN 2 THEN NULL ELSE p_partkey::VARCHAR END AS shown
        FROM part
    """,
    "report_param": """
        SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%d/%m/%Y') AS l_shipdate,
               CAST(l_quantity AS BIGINT) AS l_quantity, l_extendedprice
        FROM lineitem WHERE l_returnflag = 'R' AND l_shipdate >= DATE '1997-01-01'
    """,
    "report_faults": f"""
        SELECT o_orderkey, 'day' AS column, day AS value, CASE WHEN day IS NULL THEN 'null' ELSE 'not a date' END AS reason
        FROM ({_FAULTY}) WHERE day IS NULL OR day LIKE '%/%'
        UNION ALL
        SELECT o_orderkey, 'slots', slots, CASE WHEN slots IS NULL THEN 'null' ELSE 'not a whole number' END
        FROM ({_FAULTY}) WHERE slots IS NULL OR slots LIKE '%.%'
    """,
    "report_checked": f"""
        SELECT o_orderkey, CASE WHEN day NOT LIKE '%/%' THEN strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y') END AS day, clerk,
               CASE WHEN slots NOT LIKE '%.%' THEN o_orderkey END AS slots, price FROM ({_FAULTY})
    """,
    "secondary_report": """
        SELECT 'F240223B' AS file_name, '26/02/2024' AS import_date,
               strftime(o_orderdate, '%d/%m/%Y') AS TX_DATE,
               o_orderkey % 2400 AS START_TIME, o_orderkey % 180 + 1 AS SLOT_DURATION,
               o_orderpriority AS SLOT_NAME, 'NULL' AS MAIN_TITLE,
               CASE WHEN o_orderkey % 7 = 0 THEN 'AG' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS PROGRAMME_ID,
               CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS PROGRAMME_ID_NUMBER,
               o_custkey % 4 AS LOADING_FACTOR, CAST(o_orderkey AS VARCHAR) AS REFERENCE_ID
        FROM orders
    """,
    "title_semi": "SELECT p_partkey, p_name FROM part WHERE p_name IN ('red plate', 'small widget', 'hot ring')",
    "top_log_rows": "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 10",
    "log_row_list": """
        SELECT event_id, ts, value FROM events WHERE event_type = 'error' AND user_id <= 1000 ORDER BY ts DESC, event_id DESC LIMIT 20
    """,
    "log_current_state": f"""
        SELECT CAST(user_id AS VARCHAR) AS log_id, user_id AS log_task_id,
               arg_max({_STATUS}, (ts, event_id)) AS status_flag,
               arg_max(event_type, (ts, event_id)) AS log_msg, max(ts) AS event_ts
        FROM events GROUP BY user_id
    """,
    "log_append": f"""
        SELECT CAST(event_id AS VARCHAR) AS log_id, CAST(user_id AS INTEGER) AS log_task_id,
               CASE WHEN event_type = 'error' THEN 1 ELSE {_STATUS} END AS status_flag,
               CASE WHEN event_type = 'error' THEN 'error again' ELSE event_type END AS log_msg
        FROM events
    """,
    "log_upkeep": f"""
        SELECT CAST(event_id AS VARCHAR) AS log_id, CAST(user_id AS INTEGER) AS log_task_id,
               CASE WHEN event_id % 3 = 0 THEN 2 ELSE {_STATUS} END AS status_flag, 1 AS versions, true AS few_files
        FROM events
    """,
    "latest_status": f"""
        SELECT user_id AS log_task_id, arg_max({_STATUS}, (ts, event_id)) AS status
        FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15' GROUP BY user_id
    """,
    "latest_status_as_of": _AS_OF,
    "missing_fields": """
        SELECT p_partkey AS name, p_size % 10 = 0 AS no_task_id, p_size % 15 = 0 AS no_allowed_status
        FROM part WHERE p_size % 10 = 0 OR p_size % 15 = 0
    """,
    "invalid_allowed": """
        SELECT p_partkey, CAST(p_partkey % 6 - 1 AS INTEGER) AS bad_code FROM part WHERE p_partkey % 6 - 1 IN (0, 4)
    """,
    "latest_status_gate_rows": f"SELECT c_custkey, status, passed FROM ({_GATE_ROWS})",
    "gate_total": f"SELECT c_nationkey, c_mktsegment, bool_and(passed) AS passed FROM ({_GATE_ROWS}) GROUP BY 1, 2",
    "task_gate": f"SELECT coalesce(bool_and(passed), true) AS passed FROM ({_GATE_ROWS})",
    "gate_faults": f"""
        SELECT c_custkey, CASE WHEN c_custkey % 5 = 3 THEN -1 ELSE coalesce(status, -1) END AS status,
               CASE c_custkey % 5 WHEN 1 THEN false WHEN 2 THEN coalesce(status, -1) = 2 WHEN 3 THEN false
                    ELSE coalesce(status, -1) IN (-1, 1, 3) END AS passed
        FROM customer LEFT JOIN ({_AS_OF}) s ON s.log_task_id = c_custkey
    """,
    "latest_status_versions": f"""
        SELECT user_id AS log_task_id, arg_max(status, (ts, event_id)) AS status, as_of
        FROM ({_CURRENT}), (VALUES (false), (true)) AS kinds(as_of)
        WHERE CAST(ts AS DATE) <= DATE '2024-01-15' AND (as_of OR CAST(ts AS DATE) = DATE '2024-01-15')
        GROUP BY user_id, as_of
    """,
    "gate_calendar": f"""
        WITH statuses AS (
            SELECT user_id, CAST(ts AS DATE) AS day, arg_max(status, (ts, event_id)) AS status FROM ({_CURRENT}) GROUP BY ALL
        ), days AS (
            SELECT DISTINCT CAST(ts AS DATE) AS ref_date FROM events
        ), per_task AS (
            SELECT c_mktsegment, c_custkey, ref_date, as_of,
                   coalesce(arg_max(status, day), -1) AS status
            FROM customer CROSS JOIN days CROSS JOIN (VALUES (false), (true)) AS kinds(as_of)
            LEFT JOIN statuses ON user_id = c_custkey AND day <= ref_date AND (as_of OR day = ref_date)
            GROUP BY ALL
        ), sets AS (
            SELECT c_mktsegment, ref_date, as_of, count(*) AS tasks, count(*) FILTER (WHERE CASE c_mktsegment
                WHEN 'HOUSEHOLD' THEN status = 1 WHEN 'MACHINERY' THEN status IN (1, 3) ELSE status IN (-1, 1, 3) END) AS passing
            FROM per_task GROUP BY ALL
        )
        SELECT c_mktsegment, ref_date, as_of, tasks, passing, tasks = passing AS passed FROM sets
        UNION ALL SELECT 'none', ref_date, as_of, 0, 0, true FROM days, (VALUES (false), (true)) AS kinds(as_of)
    """,
    "holiday_flag": """
        SELECT event_id, CAST(ts AS DATE) AS day,
               CAST(ts AS DATE) IN (DATE '2024-01-01', DATE '2024-01-25') OR dayofweek(ts) IN (0, 6) AS is_holiday,
               CAST(ts AS DATE) IN (DATE '2024-01-01', DATE '2024-01-25') AS is_listed
        FROM events
    """,
    "stream_corrections": """
        SELECT n AS files_per_batch, 'F240131' || chr(CAST(65 + event_id % 4 AS INTEGER)) AS file_name, event_id
        FROM events, (VALUES (1::INTEGER), (1000::INTEGER)) AS batches(n)
        WHERE CASE event_id % 4 WHEN 1 THEN event_id % 3 = 0 WHEN 2 THEN false WHEN 3 THEN event_id % 5 = 0
                   ELSE event_id % 7 <> 0 END
    """,
    "stream_ingest": """
        SELECT CAST(n AS INTEGER) AS files_per_batch, event_id, user_id, event_type, CAST(ts AS DATE) AS day,
               strftime(ts, '%H%M') AS start_time, props, value
        FROM events, (VALUES (1), (1000)) AS batches(n)
    """,
}
ORACLE_SQL["report_export"] = f"""
    SELECT 'main' AS dataset, count(*) AS rows, sum(l_orderkey) AS keys, max(l_shipdate) AS last FROM ({ORACLE_SQL["report_param"]})
    UNION ALL
    SELECT 'second', count(*), sum(o_orderkey), max(file_name) FROM ({ORACLE_SQL["stamped_load"]})
"""
ORACLE_SQL["report_function"] = ORACLE_SQL["report_param"]

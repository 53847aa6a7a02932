"""The same results in DuckDB SQL over the same parquet tables."""

from __future__ import annotations

from runlens.functions.states import PENDING_BATCH_STATES, PENDING_STATEMENT_STATES
from runlens.operators.validate import ALLOWED_KINDS, ALLOWED_VERIFIERS
from runlens.plans.queries import RUN_TIMEOUT_SEC, SAMPLE_PERIOD_SEC, SAMPLE_TIMEOUT_SEC
from runlens.plans.tables import SHORT_PAGE


def _texts(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{value}'" for value in values) + ")"


PENDING = _texts(PENDING_BATCH_STATES)
LAST_POLL = SAMPLE_TIMEOUT_SEC // SAMPLE_PERIOD_SEC

STATE = """CASE WHEN event_type IN ('view', 'click') THEN 'running'
    WHEN event_type = 'signup' THEN 'starting'
    WHEN event_type = 'purchase' THEN 'success' ELSE event_type END"""


def batch_class(state: str) -> str:
    return (
        f"CASE WHEN {state} IN {PENDING} THEN 'pending' "
        f"WHEN {state} = 'success' THEN 'success' ELSE 'failed' END"
    )


OBS = f"obs AS (SELECT event_id, user_id AS run_id, ts, {STATE} AS state FROM events)"
STARTS = "starts AS (SELECT run_id, min(ts) AS start_ts FROM obs GROUP BY run_id)"
ALL_STARTS = """starts AS (SELECT user_id AS run_id, min(ts) AS start_ts FROM events GROUP BY user_id
    UNION ALL SELECT DISTINCT c_custkey, (SELECT min(ts) FROM events) FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM events))"""
FIRST_TERMINAL = f"""first_terminal AS (
    SELECT * FROM obs WHERE {batch_class('state')} <> 'pending'
    QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) = 1)"""

FIRST_TERMINAL_ROWS = f"""WITH {OBS}, {FIRST_TERMINAL}
SELECT s.run_id,
    CASE WHEN f.run_id IS NULL THEN 'pending' ELSE {batch_class('f.state')} END AS outcome,
    f.state, f.ts AS decided_ts, f.event_id
FROM (SELECT DISTINCT run_id FROM obs) s LEFT JOIN first_terminal f USING (run_id)"""

IN_TIME = f"""in_time AS (
    SELECT o.* FROM obs o JOIN starts s USING (run_id)
    WHERE {batch_class('o.state')} <> 'pending' AND o.ts <= s.start_ts + INTERVAL {RUN_TIMEOUT_SEC} SECOND
    QUALIFY row_number() OVER (PARTITION BY o.run_id ORDER BY o.ts, o.event_id) = 1)"""


def _deadline_outcomes() -> str:
    return f"""WITH {OBS}, {ALL_STARTS}, {IN_TIME},
    ends AS (SELECT run_id, start_ts + INTERVAL {RUN_TIMEOUT_SEC} SECOND AS deadline FROM starts),
    now AS (SELECT max(ts) AS ts FROM obs)
    SELECT e.run_id,
        CASE WHEN f.run_id IS NOT NULL THEN {batch_class('f.state')}
            WHEN e.deadline < (SELECT ts FROM now) THEN 'timeout' ELSE 'pending' END AS outcome,
        CASE WHEN f.run_id IS NOT NULL THEN f.ts
            WHEN e.deadline < (SELECT ts FROM now) THEN e.deadline END AS decided_ts,
        f.state
    FROM ends e LEFT JOIN in_time f USING (run_id)"""


SETTINGS = """settings AS (SELECT o_orderkey AS run_id,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderkey END AS app_id,
    CASE WHEN o_totalprice >= 325000 THEN 'yarn' WHEN o_totalprice >= 150000 THEN 'spark' END AS verify_in,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN true
        WHEN o_orderpriority IN ('3-MEDIUM', '5-LOW') THEN false END AS spill_logs
    FROM orders)"""
RUNS = """runs AS (SELECT o_orderkey AS run_id,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderkey END AS app_id,
    CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'running' ELSE 'error' END AS state,
    CASE WHEN o_totalprice >= 325000 THEN 'yarn' WHEN o_totalprice >= 150000 THEN 'spark' END AS verify_in,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN true
        WHEN o_orderpriority IN ('3-MEDIUM', '5-LOW') THEN false END AS spill_logs
    FROM orders)"""
JOBS = """app_jobs AS (SELECT l_orderkey AS app_id, l_linenumber AS ord, l_partkey AS job_id,
    CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCEEDED' END AS status FROM lineitem),
  bad_jobs AS (SELECT app_id, job_id, status FROM app_jobs WHERE status <> 'SUCCEEDED'
    QUALIFY row_number() OVER (PARTITION BY app_id ORDER BY ord, job_id) = 1)"""
FINAL = """app_final AS (SELECT l_orderkey AS app_id,
    CASE WHEN bool_and(l_linestatus = 'O') THEN 'UNDEFINED' WHEN count(*) >= 7 THEN 'KILLED'
        ELSE 'SUCCEEDED' END AS final_status
    FROM lineitem GROUP BY l_orderkey)"""
RECONCILED = f"""{RUNS}, {JOBS}, {FINAL}, reasons AS (
    SELECT r.*, {batch_class('r.state')} AS own, b.status AS job_status, f.final_status,
        CASE WHEN {batch_class('r.state')} = 'pending' THEN NULL
            WHEN {batch_class('r.state')} = 'failed' THEN 'run_failed'
            WHEN r.verify_in IS NULL THEN NULL
            WHEN r.app_id IS NULL THEN 'no_app_id'
            WHEN r.verify_in = 'spark' AND b.app_id IS NOT NULL THEN 'bad_job'
            WHEN r.verify_in = 'yarn' AND f.app_id IS NULL THEN 'no_final_status'
            WHEN r.verify_in = 'yarn' AND f.final_status <> 'SUCCEEDED' THEN 'bad_final_status'
        END AS reason
    FROM runs r LEFT JOIN bad_jobs b ON r.app_id = b.app_id
        LEFT JOIN app_final f ON r.app_id = f.app_id),
  reconciled AS (SELECT *, CASE WHEN own = 'pending' THEN 'pending' WHEN reason IS NULL THEN 'success'
        ELSE 'failed' END AS outcome,
    CASE reason WHEN 'bad_job' THEN job_status WHEN 'bad_final_status' THEN final_status END AS bad_status
    FROM reasons)"""
LOGS = """logs AS (SELECT l_orderkey AS run_id, l_linenumber AS pos, l_partkey AS part,
    concat_ws(' ', l_returnflag, l_linestatus, CAST(l_suppkey AS VARCHAR)) AS line FROM lineitem)"""


def _logs(kept: str) -> str:
    return f"""WITH {RUNS}, {LOGS}
    SELECT * FROM logs WHERE run_id {kept} (
        SELECT run_id FROM runs
        WHERE {batch_class('state')} = 'failed' OR coalesce(spill_logs, true))"""


RESPONSES = """responses AS (SELECT event_id, user_id AS run_id, ts,
    CASE event_type
      WHEN 'click' THEN '{"id": ' || event_id || ', "state": "running", "appId": null, "props": ' || props || '}'
      WHEN 'signup' THEN '{"id": "' || event_id || '", "state": null, "output": {"status": "ok"}}'
      WHEN 'purchase' THEN '[' || props || ']'
      WHEN 'error' THEN CASE event_id % 3 WHEN 0 THEN props || '}' WHEN 1 THEN props || ',"x":' || props
        ELSE props || '],[0,' || props END
      ELSE props END AS body FROM events),
  replies AS (SELECT * EXCLUDE (body), CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS j
    FROM responses),
  objects AS (SELECT * EXCLUDE (j), CASE WHEN json_type(j) = 'OBJECT' THEN j END AS j FROM replies)"""

LINES = """lines AS (SELECT doc_id AS run_id, lang, string_split("text", chr(10)) AS ls FROM documents),
  log_lines AS (SELECT run_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS pos FROM lines)"""
PAGES = f"""{LINES},
  offsets AS (SELECT *, len(ls) AS n, unnest(range(0, len(ls), {SHORT_PAGE})) AS f FROM lines),
  whole AS (SELECT run_id, lang, f, n AS total, least({SHORT_PAGE}, n - f) AS size FROM offsets),
  damaged AS (SELECT -1 - run_id AS run_id, lang, f,
      CASE WHEN lang = 'de' AND f > 0 THEN NULL ELSE total END AS total,
      CASE WHEN lang = 'fr' AND f > 0 THEN 0 ELSE size END AS size
    FROM whole WHERE NOT (lang = 'es' AND f = {SHORT_PAGE})),
  fetched AS (SELECT * FROM whole UNION ALL SELECT * FROM damaged
    UNION ALL SELECT * FROM damaged WHERE lang = 'en')"""


# Told by cutting the page at its tags, not by the pattern that the function uses: the pages at hand
# have no attributes on these elements, and no comment or self-closing tag in them.
def _tag_text(tag: str) -> str:
    bodies = f"list_transform(string_split(html, '<{tag}>')[2:], lambda b: string_split(b, '</')[1])"
    pieces = "list_transform(string_split('>' || b, '<'), lambda r: substr(r, strpos(r, '>') + 1))"
    runs = f"flatten(list_transform({bodies}, lambda b: {pieces}))"
    text = f"list_filter({runs}, lambda r: r <> '')[-1]"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    return text


STATEMENTS = """statements AS (SELECT conv_id AS session_id, turn AS pos,
    CASE WHEN role = 'system' THEN 'waiting' ELSE 'available' END AS state,
    CASE WHEN length("text") < 700 THEN 'ok' WHEN length("text") < 1500 THEN 'error' END AS status
    FROM conversations)"""
STATEMENT_CLASS = f"""CASE WHEN state IN {_texts(PENDING_STATEMENT_STATES)} THEN 'pending'
    WHEN state = 'available' AND status IS NULL THEN 'malformed'
    WHEN state = 'available' AND status = 'ok' THEN 'success' ELSE 'failed' END"""
FAIL_FAST = f"""{STATEMENTS}, classed AS (SELECT *, {STATEMENT_CLASS} AS class FROM statements),
  failures AS (SELECT session_id, min(pos) AS first_failed_pos FROM classed
    WHERE class IN ('failed', 'malformed') GROUP BY session_id),
  ran AS (SELECT c.session_id, c.pos, first_failed_pos,
      CASE WHEN c.pos > f.first_failed_pos THEN 'not_run' ELSE c.class END AS run_class
    FROM classed c LEFT JOIN failures f USING (session_id))"""

SUBMISSIONS = """submissions AS (SELECT p_partkey AS id,
    CASE p_type WHEN 'MEDIUM' THEN 'spark' WHEN 'STANDARD' THEN 'pyspark' WHEN 'LARGE' THEN 'sparkr'
        WHEN 'SMALL' THEN 'sql' WHEN 'PROMO' THEN 'scala' END AS kind,
    CASE WHEN p_size <= 15 THEN 'spark' WHEN p_size <= 30 THEN 'yarn' WHEN p_size <= 35 THEN 'mesos' END
        AS verify_in,
    p_size - 3 AS poke_interval, CAST(length(p_name) * 2 AS INTEGER) AS timeout FROM part)"""
VALIDATED = f"""{SUBMISSIONS}, validated AS (SELECT *,
    CASE WHEN kind NOT IN {_texts(ALLOWED_KINDS)} THEN 'unknown_kind'
        WHEN verify_in NOT IN {_texts(ALLOWED_VERIFIERS)} THEN 'unknown_verifier'
        WHEN poke_interval < 1 THEN 'poll_period_too_small'
        WHEN poke_interval > timeout THEN 'poll_period_above_timeout' END AS reason
    FROM submissions)"""

ORACLE: dict[str, str] = {
    "scan_csv_schema": "SELECT * FROM customer",
    "scan_csv_infer": """SELECT CAST(o_orderkey AS INTEGER) AS _c0, CAST(o_custkey AS INTEGER) AS _c1,
        o_orderstatus AS _c2, o_totalprice AS _c3, o_orderdate AS _c4, o_orderpriority AS _c5
        FROM orders""",
    "scan_rejects": """WITH kinds AS (SELECT *, c_custkey % 10 AS kind,
                concat_ws(',', c_custkey, c_name, c_nationkey) AS head FROM customer)
        SELECT CASE kind WHEN 1 THEN 'short_row' WHEN 2 THEN 'long_row' WHEN 3 THEN 'bad_value' END AS reason,
            CASE kind WHEN 1 THEN 'c_acctbal' WHEN 3 THEN 'c_nationkey' END AS "column",
            count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys,
            min(CASE kind WHEN 1 THEN head WHEN 2 THEN concat_ws(',', head, c_acctbal, c_mktsegment, 'more')
                WHEN 3 THEN concat_ws(',', c_custkey, c_name, 'none', c_acctbal, c_mktsegment) END) AS example
        FROM kinds GROUP BY 1, 2""",
    "scan_good_rows": """SELECT c_custkey, CASE WHEN c_custkey % 10 <> 4 THEN c_name END AS c_name, c_nationkey,
            CASE WHEN c_custkey % 10 <> 4 THEN c_acctbal END AS c_acctbal, c_mktsegment
        FROM customer WHERE c_custkey % 10 NOT IN (1, 2, 3)""",
    "sink_mounted": """SELECT *, CASE WHEN o_orderstatus = 'F' THEN CAST(2 AS BIGINT) ELSE 1 END AS n FROM orders""",
    "sink_csv_roundtrip": "SELECT * FROM orders",
    "sink_append_twice": "SELECT *, 2 AS n FROM orders",
    "sink_ignore_existing": "SELECT * FROM orders",
    "join_two_files": """SELECT c_custkey, c_name, n_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "join_renamed": """SELECT c_custkey AS id, c_name AS full_name, n_name || ', ' || c_mktsegment AS place
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "join_diff_keys": """SELECT o_orderkey, c_name, c_mktsegment AS segment
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "join_dup_null_keys": """SELECT o_orderkey, o_custkey, copy
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN (VALUES ('a'), ('b')) t(copy) ON true
        WHERE o_orderpriority <> '4-NOT SPECIFIED' AND c_mktsegment <> 'HOUSEHOLD'""",
    "join_mixed_key_types": """SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, c_name
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment <> 'MACHINERY'""",
    "preview_top50": """SELECT o_orderkey, o_totalprice, c_name
        FROM orders JOIN customer ON o_custkey = c_custkey
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 50""",
    "range_count": """SELECT count(*) AS n_ids,
            count(*) FILTER (WHERE id NOT IN (SELECT l_orderkey FROM lineitem)) AS n_without_lines
        FROM (SELECT unnest(range(min(o_orderkey), max(o_orderkey) + 1)) AS id FROM orders)""",
    "literal_rows": """SELECT label, count(*) AS n_orders
        FROM orders JOIN (VALUES ('finished', 'F'), ('open', 'O'), ('partial', 'P')) t(label, status)
            ON o_orderstatus = status GROUP BY label""",
    "literal_column": """SELECT event_type, event_type IN ('click', 'purchase', 'refund') AS wanted,
        count(*) AS n_events FROM events GROUP BY 1, 2""",
    "select_literal": """SELECT o_orderstatus, (SELECT 'orders by status') AS note, count(*) AS n_orders
        FROM orders GROUP BY o_orderstatus""",
    "sql_over_views": """SELECT c_mktsegment, o_orderstatus, count(*) AS n_orders
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
    "sql_params": """SELECT o_orderpriority AS grp, 'it''s "quoted"' AS label, '' AS note, count(*) AS n_orders
        FROM orders WHERE o_totalprice >= 250000 GROUP BY 1""",
    "sql_script": """SELECT c_mktsegment, count(*) AS n_customers, count(n) AS n_active,
            CAST(sum(n) AS BIGINT) AS n_orders
        FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
            ON c_custkey = o_custkey GROUP BY 1""",
    "script_status": """SELECT * FROM (VALUES (0, 'ok', NULL, 1),
            (1, 'ok', NULL, (SELECT count(DISTINCT o_orderstatus) FROM orders)),
            (2, 'failed', 'UNRESOLVED_COLUMN.WITH_SUGGESTION', NULL), (3, 'not_run', NULL, NULL))
        t(pos, status, error, n_rows)""",
    "concat_params": """SELECT c_custkey, c_name || ' buys ' || c_mktsegment || ' #' || c_nationkey AS label
        FROM customer""",
    "path_safe": "SELECT page_id, replace(url, ':', '-') AS path FROM pages",
    "classify_batch": f"""WITH {OBS}
        SELECT state, {batch_class('state')} AS class, count(*) AS n FROM obs GROUP BY 1, 2""",
    "classify_session": """SELECT event_id, state, CASE state WHEN 'starting' THEN 'pending'
            WHEN 'idle' THEN 'ready' ELSE 'failed' END AS class
        FROM (SELECT event_id, CASE event_type WHEN 'signup' THEN 'starting' WHEN 'purchase' THEN 'idle'
            ELSE event_type END AS state FROM events)""",
    "classify_statement": f"WITH {STATEMENTS} SELECT *, {STATEMENT_CLASS} AS class FROM statements",
    "validate_config": f"WITH {VALIDATED} SELECT * FROM validated",
    "validate_reason_counts": f"""WITH {VALIDATED}
        SELECT reason, count(*) AS n FROM validated WHERE reason IS NOT NULL GROUP BY 1""",
    "sample_states_asof": f"""WITH {OBS}, {STARTS},
        polls AS (SELECT run_id, CAST(k AS INTEGER) AS poll_no,
                start_ts + to_seconds(k * {SAMPLE_PERIOD_SEC}) AS poll_ts
            FROM starts, range(0, {LAST_POLL} + 1) t(k))
        SELECT p.run_id, p.poll_no, p.poll_ts, o.state
        FROM polls p ASOF LEFT JOIN obs o ON p.run_id = o.run_id AND p.poll_ts >= o.ts""",
    "first_terminal": FIRST_TERMINAL_ROWS,
    "run_outcome_timeout": f"""WITH {OBS}, {STARTS}, decided AS (
            SELECT o.run_id, o.ts, o.state FROM obs o JOIN starts s USING (run_id)
            WHERE {batch_class('o.state')} <> 'pending'
                OR o.ts > s.start_ts + INTERVAL {RUN_TIMEOUT_SEC} SECOND
            QUALIFY row_number() OVER (PARTITION BY o.run_id ORDER BY o.ts, o.event_id) = 1)
        SELECT s.run_id, CASE WHEN d.run_id IS NULL THEN 'pending'
                WHEN {batch_class('d.state')} = 'pending' THEN 'timeout' ELSE {batch_class('d.state')} END
                AS outcome,
            d.ts AS decided_ts, d.state
        FROM starts s LEFT JOIN decided d USING (run_id)""",
    "run_outcome_deadline": _deadline_outcomes(),
    "polls_until_done": f"""WITH {OBS}, {FIRST_TERMINAL}
        SELECT o.run_id, count(*) AS n_polls, bool_or(f.run_id IS NOT NULL) AS decided
        FROM obs o LEFT JOIN first_terminal f USING (run_id)
        WHERE f.run_id IS NULL OR (o.ts, o.event_id) <= (f.ts, f.event_id)
        GROUP BY o.run_id""",
    "first_nonempty": """SELECT user_id AS run_id,
            arg_min('http://logs/' || event_id, (ts, event_id)) FILTER (WHERE event_type = 'click')
                AS driver_log_url
        FROM events GROUP BY user_id""",
    "session_outcome": f"""WITH obs AS (SELECT event_id, user_id AS run_id, ts,
            CASE WHEN event_type IN ('view', 'click', 'signup') THEN 'starting'
                WHEN event_type = 'purchase' THEN 'idle' ELSE event_type END AS state FROM events),
        {STARTS}, decided AS (
            SELECT o.run_id, o.ts, o.state FROM obs o JOIN starts s USING (run_id)
            WHERE o.state <> 'starting' OR o.ts > s.start_ts + INTERVAL {RUN_TIMEOUT_SEC} SECOND
            QUALIFY row_number() OVER (PARTITION BY o.run_id ORDER BY o.ts, o.event_id) = 1)
        SELECT s.run_id, CASE WHEN d.run_id IS NULL THEN 'pending' WHEN d.state = 'starting' THEN 'timeout'
                WHEN d.state = 'idle' THEN 'ready' ELSE 'failed' END AS outcome,
            d.ts AS decided_ts, d.state
        FROM starts s LEFT JOIN decided d USING (run_id)""",
    "statement_outcome": """WITH classed AS (SELECT user_id AS run_id, ts, event_id,
            CASE WHEN event_type = 'view' THEN 'waiting' WHEN event_type = 'click' THEN 'running'
                WHEN event_type IN ('signup', 'purchase') THEN 'available' ELSE 'malformed' END AS state,
            CASE WHEN event_type = 'signup' THEN 'success' WHEN event_type <> 'purchase' THEN 'failed'
                WHEN event_id % 2 = 0 THEN 'malformed' ELSE 'failed' END AS class FROM events),
        decided AS (SELECT * FROM classed WHERE state NOT IN ('waiting', 'running')
            QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) = 1)
        SELECT r.run_id, coalesce(d.class, 'pending') AS outcome, d.state, d.ts AS decided_ts, d.event_id
        FROM (SELECT DISTINCT run_id FROM classed) r LEFT JOIN decided d USING (run_id)""",
    "fail_fast_prefix": f"WITH {FAIL_FAST} SELECT session_id, pos, run_class FROM ran",
    "script_summary": f"""WITH {FAIL_FAST}
        SELECT session_id, count(*) AS n_statements,
            count(*) FILTER (WHERE run_class <> 'not_run') AS n_submitted,
            bool_and(run_class = 'success') AS all_succeeded, min(first_failed_pos) AS first_failed_pos
        FROM ran GROUP BY session_id""",
    "verify_jobs": f"""WITH {RUNS}, {JOBS}
        SELECT r.run_id, r.app_id,
            CASE WHEN r.app_id IS NULL THEN 'no_app_id' WHEN b.app_id IS NULL THEN 'passed'
                ELSE 'failed' END AS verdict,
            b.job_id AS bad_job_id, b.status AS bad_status
        FROM runs r LEFT JOIN bad_jobs b ON r.app_id = b.app_id""",
    "verify_final": f"""WITH {RUNS}, {FINAL}
        SELECT r.run_id, r.app_id,
            CASE WHEN r.app_id IS NULL THEN 'no_app_id' WHEN f.app_id IS NULL THEN 'malformed'
                WHEN f.final_status = 'SUCCEEDED' THEN 'passed' ELSE 'failed' END AS verdict,
            f.final_status
        FROM runs r LEFT JOIN app_final f ON r.app_id = f.app_id""",
    "reconcile_outcome": f"""WITH {RECONCILED}
        SELECT run_id, outcome, reason, bad_status FROM reconciled""",
    "disagreement_counts": f"""WITH {RECONCILED}
        SELECT verify_in, reason, bad_status, count(*) AS n_runs FROM reconciled
        WHERE own = 'success' AND outcome = 'failed' GROUP BY 1, 2, 3""",
    "select_logs_semi": _logs("IN"),
    "dropped_logs_anti": _logs("NOT IN"),
    "run_report": f"""WITH {RECONCILED}, {LOGS}, per_run AS (SELECT run_id, count(*) AS n FROM logs GROUP BY 1)
        SELECT outcome, reason, count(*) AS n_runs,
            CAST(coalesce(sum(n) FILTER (WHERE outcome = 'failed' OR coalesce(spill_logs, true)), 0) AS BIGINT)
                AS n_log_lines
        FROM reconciled LEFT JOIN per_run USING (run_id) GROUP BY 1, 2""",
    "json_extract": f"""WITH {RESPONSES}, paths AS (SELECT *, CASE
                WHEN j IS NULL THEN NULL
                WHEN json_type(j, '$.id') IS NULL THEN '$.id'
                WHEN json_type(j, '$.state') IS NULL THEN '$.state'
                WHEN json_type(j, '$.props.k') IS NULL THEN '$.props.k' END AS missing_path FROM objects)
        SELECT event_id, json_extract_string(j, '$.id') AS id, json_extract_string(j, '$.state') AS state,
            CAST(json_extract_string(j, '$.props.k') AS BIGINT) AS k, missing_path,
            CASE WHEN j IS NULL THEN 'malformed' WHEN missing_path IS NOT NULL THEN 'missing_path' END AS error
        FROM paths""",
    "json_error_class": f"""WITH {RESPONSES}, paths AS (SELECT *, CASE
                WHEN j IS NULL THEN NULL
                WHEN json_type(j, '$.state') IS NULL THEN '$.state'
                WHEN json_type(j, '$.output.status') IS NULL THEN '$.output.status' END AS missing_path,
                json_extract_string(j, '$.output.status') AS status FROM objects)
        SELECT CASE WHEN j IS NULL THEN 'malformed' WHEN missing_path IS NOT NULL THEN 'missing_path' END
                AS error, missing_path, status, count(*) AS n
        FROM paths GROUP BY 1, 2, 3""",
    "json_numeric_id": f"""WITH {RESPONSES}, kinds AS (SELECT *, json_type(j, '$.id') AS kind FROM objects),
        errors AS (SELECT *, CASE WHEN j IS NULL THEN 'malformed' WHEN kind IS NULL THEN 'missing_path'
            WHEN kind NOT IN ('UBIGINT', 'BIGINT', 'HUGEINT', 'DOUBLE') THEN 'not_a_number' END AS error
            FROM kinds)
        SELECT event_id, error, CASE WHEN error IS NULL THEN json_extract_string(j, '$.id') END AS id
        FROM errors""",
    "reply_outcomes": f"""WITH {RESPONSES}, states AS (SELECT run_id, ts, event_id,
            CASE WHEN j IS NULL THEN 'malformed' WHEN json_type(j, '$.state') IS NULL THEN 'missing_path'
                ELSE json_extract_string(j, '$.state') END AS state FROM objects),
        decided AS (SELECT * FROM states WHERE {batch_class('state')} <> 'pending'
            QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) = 1)
        SELECT r.run_id, CASE WHEN d.run_id IS NULL THEN 'pending' ELSE {batch_class('d.state')} END AS outcome,
            d.state, d.ts AS decided_ts, d.event_id
        FROM (SELECT DISTINCT run_id FROM states) r LEFT JOIN decided d USING (run_id)""",
    "json_explode_jobs": """WITH kinds AS (SELECT l_orderkey, l_linenumber, l_partkey,
            l_returnflag || l_linestatus AS kind FROM lineitem)
        SELECT l_orderkey, l_linenumber, 0 AS job_pos, CAST(l_linenumber AS BIGINT) AS job_id,
            'SUCCEEDED' AS status, NULL AS error FROM kinds WHERE kind IN ('AO', 'AF', 'NO')
        UNION ALL
        SELECT l_orderkey, l_linenumber, 1, CASE WHEN l_linenumber NOT IN (6, 7) THEN l_partkey END, 'FAILED',
            CASE WHEN l_linenumber IN (6, 7) THEN 'bad_job_id' END FROM kinds WHERE kind = 'AO'
        UNION ALL
        SELECT l_orderkey, l_linenumber, 1, NULL, 'SUCCEEDED', 'missing_path' FROM kinds WHERE kind = 'NO'
        UNION ALL
        SELECT l_orderkey, l_linenumber, NULL, NULL, NULL, 'malformed' FROM kinds WHERE kind IN ('RO', 'RF')""",
    "end_to_end": f"""WITH {RESPONSES}, {ALL_STARTS}, {SETTINGS}, {FINAL}, {LOGS},
        states AS (SELECT run_id, ts, event_id,
            CASE WHEN j IS NULL THEN 'malformed' WHEN json_type(j, '$.state') IS NULL THEN 'missing_path'
                ELSE json_extract_string(j, '$.state') END AS state FROM objects),
        decided AS (SELECT o.run_id, o.state FROM states o JOIN starts s USING (run_id)
            WHERE {batch_class('o.state')} <> 'pending' OR o.ts > s.start_ts + INTERVAL {RUN_TIMEOUT_SEC} SECOND
            QUALIFY row_number() OVER (PARTITION BY o.run_id ORDER BY o.ts, o.event_id) = 1),
        owns AS (SELECT s.run_id, CASE WHEN d.run_id IS NULL THEN 'pending'
                WHEN {batch_class('d.state')} = 'pending' THEN 'timeout' ELSE {batch_class('d.state')} END AS own
            FROM starts s LEFT JOIN decided d USING (run_id)),
        lists AS (SELECT l_orderkey AS app_id,
                bool_or(l_returnflag = 'R' OR (l_returnflag = 'N' AND l_linestatus = 'O')
                    OR (l_returnflag = 'A' AND l_linestatus = 'O' AND l_linenumber IN (6, 7))) AS unread,
                bool_or(l_returnflag = 'A' AND l_linestatus = 'O') AS failed
            FROM lineitem GROUP BY 1),
        reasons AS (SELECT r.run_id, r.own, r.spill_logs, f.final_status, CASE WHEN r.own = 'pending' THEN NULL
                WHEN r.own = 'timeout' THEN 'timeout' WHEN r.own <> 'success' THEN 'run_failed'
                WHEN r.verify_in IS NULL THEN NULL WHEN r.app_id IS NULL THEN 'no_app_id'
                WHEN r.verify_in = 'spark' AND l.unread THEN 'bad_jobs_reply'
                WHEN r.verify_in = 'spark' AND l.failed THEN 'bad_job'
                WHEN r.verify_in = 'yarn' AND f.app_id IS NULL THEN 'no_final_status'
                WHEN r.verify_in = 'yarn' AND f.final_status <> 'SUCCEEDED' THEN 'bad_final_status' END AS reason
            FROM (SELECT s.*, coalesce(o.own, 'pending') AS own FROM settings s LEFT JOIN owns o USING (run_id)) r
                LEFT JOIN lists l ON r.app_id = l.app_id
                LEFT JOIN app_final f ON r.app_id = f.app_id),
        results AS (SELECT *, CASE WHEN own = 'pending' THEN 'pending' WHEN reason IS NULL THEN 'success'
                ELSE 'failed' END AS outcome FROM reasons),
        per_run AS (SELECT run_id, count(*) AS n FROM logs GROUP BY 1)
        SELECT r.run_id, own, outcome, reason,
            CASE reason WHEN 'bad_job' THEN 'FAILED' WHEN 'bad_final_status' THEN final_status END AS bad_status,
            CASE WHEN outcome = 'failed' OR coalesce(spill_logs, true) THEN n END AS n_lines
        FROM results r LEFT JOIN per_run p ON r.run_id = p.run_id""",
    "compact_json": """SELECT p_partkey AS id, '{"file":"' || p_name || '"'
            || CASE WHEN p_size % 2 = 0 THEN ',"proxyUser":"user-' || p_size || '"' ELSE '' END
            || CASE WHEN p_type <> 'PROMO' THEN ',"className":"' || p_type || '"' ELSE '' END
            || CASE WHEN p_size > 25 THEN ',"args":["' || replace(p_name, ' ', '","') || '"]' ELSE '' END
            || CASE WHEN p_size % 3 = 0 THEN ',"jars":["' || lower(p_brand) || '.jar"]' ELSE '' END
            || CASE WHEN p_size % 5 = 0 THEN ',"pyFiles":["' || lower(p_brand) || '.py"]' ELSE '' END
            || CASE WHEN p_size % 7 = 0 THEN ',"files":["' || lower(p_brand) || '.txt"]' ELSE '' END
            || CASE WHEN p_size > 30 THEN ',"driverMemory":"' || p_size || 'g"' ELSE '' END
            || CASE WHEN p_size > 20 THEN ',"driverCores":' || (p_size - 20) ELSE '' END
            || CASE WHEN p_size <= 10 THEN ',"executorMemory":"' || p_size || 'g"' ELSE '' END
            || CASE WHEN p_size > 30 THEN ',"executorCores":' || (p_size - 30) ELSE '' END
            || CASE WHEN p_size > 40 THEN ',"numExecutors":' || (p_size - 40) ELSE '' END
            || CASE WHEN p_size % 11 = 0 THEN ',"archives":["' || lower(p_brand) || '.zip"]' ELSE '' END
            || ',"queue":"' || lower(p_brand) || '"'
            || CASE WHEN p_size % 4 = 0 THEN ',"name":"part ' || p_partkey || '"' ELSE '' END
            || CASE WHEN p_size > 40 THEN ',"conf":{"spark.app.size":"' || p_size || '"}' ELSE '' END
            || '}' AS payload
        FROM part""",
    "compact_session_json": """SELECT s_suppkey AS id, '{"kind":"' || CASE WHEN s_suppkey % 2 = 0 THEN 'sql'
                ELSE 'spark' END || '"'
            || CASE WHEN s_suppkey % 3 <> 0 THEN ',"proxyUser":"' || s_name || '"' ELSE '' END
            || CASE WHEN s_suppkey % 4 = 0 THEN ',"jars":["a.jar","b.jar"]' ELSE '' END
            || CASE WHEN s_suppkey % 5 = 0 THEN ',"pyFiles":["a.py"]' ELSE '' END
            || CASE WHEN s_suppkey % 6 = 0 THEN ',"files":["a.txt"]' ELSE '' END
            || CASE WHEN s_suppkey % 7 = 0 THEN ',"driverMemory":"2g"' ELSE '' END
            || CASE WHEN s_suppkey % 8 <> 0 THEN ',"driverCores":' || (s_suppkey % 8) ELSE '' END
            || CASE WHEN s_suppkey % 9 = 0 THEN ',"executorMemory":"3g"' ELSE '' END
            || CASE WHEN s_suppkey % 10 <> 0 THEN ',"executorCores":' || (s_suppkey % 10) ELSE '' END
            || CASE WHEN s_nationkey <> 0 THEN ',"numExecutors":' || s_nationkey ELSE '' END
            || CASE WHEN s_suppkey % 11 = 0 THEN ',"archives":["a.zip"]' ELSE '' END
            || CASE WHEN s_suppkey % 12 = 0 THEN ',"queue":"nightly"' ELSE '' END
            || CASE WHEN s_suppkey % 13 = 0 THEN ',"name":"probe"' ELSE '' END
            || CASE WHEN s_suppkey % 14 = 0 THEN ',"conf":{"spark.app.key":"' || s_suppkey || '"}' ELSE '' END
            || CASE WHEN s_suppkey % 15 = 0 AND s_suppkey <> 0
                THEN ',"heartbeatTimeoutInSecond":' || s_suppkey ELSE '' END
            || '}' AS payload
        FROM supplier""",
    "paginate_full_pages": f"""WITH {LINES}
        SELECT run_id, (pos // 100) * 100 AS "from", CAST(count(*) AS INTEGER) AS n_lines,
            string_agg(line, chr(10) ORDER BY pos) AS log_text
        FROM log_lines GROUP BY 1, 2""",
    "page_counts_empty_logs": """SELECT o_orderkey AS run_id, count(l_orderkey) AS n_lines,
            greatest(1, CAST(ceil(count(l_orderkey) / 100) AS BIGINT)) AS n_pages
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
    "paginate_lines": f"""WITH {LINES}
        SELECT run_id, (pos // {SHORT_PAGE}) * {SHORT_PAGE} AS "from", CAST(count(*) AS INTEGER) AS n_lines,
            string_agg(line, chr(10) ORDER BY pos) AS log_text
        FROM log_lines GROUP BY 1, 2""",
    "page_counts": f"""WITH {LINES}
        SELECT run_id, count(*) AS n_lines,
            greatest(1, CAST(ceil(count(*) / {SHORT_PAGE}) AS BIGINT)) AS n_pages
        FROM log_lines GROUP BY 1""",
    "assemble_log_lines": f"WITH {LINES} SELECT run_id, pos, line FROM log_lines",
    "log_completeness": f"""WITH {PAGES}, counts AS (SELECT run_id, count(*) AS n_pages FROM fetched GROUP BY 1),
        once AS (SELECT DISTINCT run_id, lang, f, total, size FROM fetched),
        good AS (SELECT run_id, lang, sum(size) AS n_lines, max(total) AS total, max(f) AS last,
                bool_or(f = {SHORT_PAGE}) AS has_second
            FROM once WHERE total IS NOT NULL GROUP BY 1, 2)
        SELECT run_id, n_pages, CAST(n_lines AS BIGINT) AS n_lines,
            CASE WHEN run_id < 0 AND lang IN ('de', 'fr', 'es') AND total > {SHORT_PAGE} THEN {SHORT_PAGE}
                ELSE total END AS next_from,
            CASE WHEN run_id >= 0 OR total <= {SHORT_PAGE} THEN 'complete' WHEN lang = 'de' THEN 'malformed'
                WHEN lang = 'fr' THEN 'stalled' WHEN lang = 'es' THEN 'incomplete' ELSE 'complete' END AS status
        FROM good JOIN counts USING (run_id)""",
    "unescape_lines": """SELECT doc_id, CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS pos,
            unnest(ls) AS line
        FROM (SELECT doc_id, string_split("text", chr(10)) AS ls FROM documents)""",
    "html_tag_text": f"""SELECT page_id, {_tag_text('title')} AS title, {_tag_text('p')} AS last_p,
            {_tag_text('h1')} AS heading
        FROM pages""",
    "html_raw_text": f"""SELECT page_id, {_tag_text('h1')} AS heading, 'a < "<h1>no</h1>" &amp;' AS script,
            '<p>no</p>' AS style, CAST(NULL AS VARCHAR) AS pre
        FROM pages""",
    "paginate_unnumbered": """WITH numbered AS (SELECT CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS run_id,
                event_type || ' ' || event_id AS line, ts, event_id FROM events),
            placed AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) - 1 AS pos FROM numbered)
        SELECT run_id, CAST(pos // 100 * 100 AS BIGINT) AS "from", CAST(count(*) AS INTEGER) AS n_lines,
            string_agg(line, chr(10) ORDER BY pos) AS log_text
        FROM placed GROUP BY run_id, pos // 100""",
    "stream_first_terminal": f"SELECT * FROM ({FIRST_TERMINAL_ROWS}) WHERE outcome <> 'pending'",
    # A drained stream has seen time pass up to its last whole millisecond.
    "stream_run_outcome": f"""SELECT * FROM ({_deadline_outcomes()})
        WHERE outcome <> 'pending'
            AND epoch_us(decided_ts) <= (SELECT epoch_ms(max(ts)) * 1000 FROM events)""",
}

"""SQL counterparts of the registered queries, over the same tables."""

from __future__ import annotations

CTES = {
    "trades": (
        [],
        """SELECT concat('T', cast(l_orderkey AS varchar)) AS trade_id, l_linenumber AS version,
  concat('CP-', cast(l_suppkey AS varchar)) AS counter_party_id,
  concat('B', cast(l_partkey % 50 AS varchar)) AS book_id,
  cast(l_shipdate AS date) AS maturity_date, cast(o_orderdate AS date) AS created_date,
  concat('{"notional":"', cast(cast(l_extendedprice AS decimal(18,2)) AS varchar), '","status":"', l_linestatus, '"}') AS payload,
  cast(l_extendedprice AS decimal(18,2)) AS notional, l_linestatus AS st,
  md5(concat_ws('|', cast(l_orderkey AS varchar), cast(l_linenumber AS varchar), cast(l_partkey AS varchar),
    cast(l_suppkey AS varchar), cast(l_extendedprice AS varchar))) AS arrival
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "incoming": (["trades"], "SELECT * FROM trades WHERE st = 'O'"),
    "filed": (["trades"], "SELECT * FROM trades WHERE st = 'F'"),
    "store": (
        ["filed"],
        """SELECT trade_id, version, counter_party_id, book_id, maturity_date, created_date, payload,
  maturity_date < DATE '1996-06-01' AS expired_flag
FROM (SELECT *, row_number() OVER (PARTITION BY trade_id, version ORDER BY arrival DESC) AS rn FROM filed)
WHERE rn = 1""",
    ),
    "whole_store": (
        ["trades"],
        """SELECT trade_id, version, counter_party_id, book_id, maturity_date, created_date, payload,
  maturity_date < DATE '1996-06-01' AS expired_flag
FROM (SELECT *, row_number() OVER (PARTITION BY trade_id, version ORDER BY arrival DESC) AS rn FROM trades)
WHERE rn = 1""",
    ),
    "levels": (
        ["store"],
        "SELECT trade_id, max(version) AS active_version FROM store WHERE NOT expired_flag GROUP BY trade_id",
    ),
    "marked": (
        ["incoming", "levels"],
        """SELECT i.*, l.active_version AS l0,
  max(version) OVER (PARTITION BY i.trade_id ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s
FROM incoming i LEFT JOIN levels l ON i.trade_id = l.trade_id""",
    ),
    "topped": (["marked"], "SELECT *, greatest(coalesce(s, l0), coalesce(l0, s)) AS top FROM marked"),
    "judged": (
        ["topped"],
        """SELECT *, CASE
    WHEN version < s THEN 'RULE_1_LOWER_VERSION_THAN_ACTIVE'
    WHEN version = s AND maturity_date < DATE '1998-09-01' THEN 'RULE_2_MATURITY_BEFORE_TODAY_FOR_ACTIVE_VERSION'
    WHEN version < top OR (version = top AND maturity_date < DATE '1998-09-01') THEN 'DB_GUARDRAIL_REJECT' END AS reason,
  CASE WHEN version < top THEN concat('REJECTED_BY_DB_GUARDRAIL: active higher version exists for trade_id=',
      trade_id, ', incoming_version=', cast(version AS varchar))
    ELSE concat('REJECTED_BY_DB_GUARDRAIL: inserting/updating active trade with maturity before today for trade_id=',
      trade_id, ' version=', cast(version AS varchar)) END AS error_text
FROM topped""",
    ),
    "accepted": (["judged"], "SELECT * FROM judged WHERE reason IS NULL"),
    "newest": (
        ["accepted"],
        """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trade_id, version ORDER BY arrival DESC) AS rn
FROM accepted) WHERE rn = 1""",
    ),
    "raw_lines": (
        [],
        """SELECT event_id, ts, event_type, CASE WHEN event_type = 'error' THEN substr(full_line, 1, 25) ELSE full_line END AS line
FROM (SELECT event_id, ts, event_type,
  concat('{"trade_id":"U', cast(user_id AS varchar), '","version":',
    cast(cast(regexp_extract(props, '[0-9]+', 0) AS int) % 5 AS varchar),
    CASE WHEN event_type = 'signup' THEN ''
      WHEN event_type = 'view' THEN concat(',"maturity_date":"', d, 'T00:00:00"')
      WHEN event_type = 'purchase' THEN concat(',"maturity_date":"', substr(d,9,2), '/', substr(d,6,2), '/', substr(d,1,4), '"')
      ELSE concat(',"maturity_date":"', d, '"') END,
    ',"created_date":"', d, '","payload":', props, '}') AS full_line
  FROM (SELECT *, cast(cast(ts AS date) AS varchar) AS d FROM events))""",
    ),
    "fields": (
        ["raw_lines"],
        """SELECT *, json_extract_string(j, '$.trade_id') AS trade_id,
  CASE WHEN ok THEN coalesce(try_cast(json_extract_string(j, '$.version') AS int), 0) END AS version,
  json_extract_string(j, '$.maturity_date') AS maturity_text,
  json_extract_string(j, '$.created_date') AS created_text,
  CASE WHEN ok THEN cast(json_extract(j, '$.payload') AS varchar) END AS payload
FROM (SELECT *, json_valid(line) AS ok, CASE WHEN json_valid(line) THEN line ELSE '{}' END AS j FROM raw_lines)""",
    ),
    "decoded": (
        ["fields"],
        """SELECT event_id, ts, event_type, line, ok, trade_id, version, payload, maturity_text,
  CASE WHEN regexp_full_match(split_part(maturity_text, 'T', 1), '[0-9]{4}-[0-9]{2}-[0-9]{2}')
         THEN try_cast(split_part(maturity_text, 'T', 1) AS date)
       WHEN regexp_full_match(maturity_text, '[0-9]{2}/[0-9]{2}/[0-9]{4}')
         THEN cast(try_strptime(maturity_text, '%d/%m/%Y') AS date) END AS maturity_date,
  try_cast(created_text AS date) AS created_date
FROM fields""",
    ),
    "checked": (
        ["decoded"],
        """SELECT *, CASE WHEN NOT ok THEN 'PARSE_ERROR'
  WHEN trade_id IS NULL OR version IS NULL OR maturity_date IS NULL OR created_date IS NULL
    THEN 'CONSTRAINT_NOT_NULL' END AS reject_code FROM decoded""",
    ),
    "line_judged": (
        ["checked"],
        """SELECT event_id, trade_id, version, maturity_date, created_date, payload, CASE
    WHEN version < s THEN 'RULE_1_LOWER_VERSION_THAN_ACTIVE'
    WHEN version = s AND maturity_date < DATE '2024-01-15' THEN 'RULE_2_MATURITY_BEFORE_TODAY_FOR_ACTIVE_VERSION'
  END AS reason
FROM (SELECT *, max(version) OVER (PARTITION BY trade_id ORDER BY event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s FROM checked WHERE reject_code IS NULL)
UNION ALL
SELECT event_id, trade_id, version, maturity_date, created_date, payload, reject_code FROM checked
WHERE reject_code IS NOT NULL""",
    ),
    "early": (["line_judged"], "SELECT * FROM line_judged WHERE event_id < (SELECT (max(event_id) + 1) * 2 // 3 FROM events)"),
    "early_lines": (["raw_lines"], "SELECT * FROM raw_lines"),
    "reasons_of": (
        ["decoded"],
        """SELECT event_id, ok, trade_id, version, concat_ws(',',
  CASE WHEN NOT ok THEN 'PARSE_ERROR' END,
  CASE WHEN trade_id IS NULL THEN 'CONSTRAINT_NOT_NULL:trade_id' END,
  CASE WHEN version IS NULL THEN 'CONSTRAINT_NOT_NULL:version' END,
  CASE WHEN maturity_date IS NULL THEN 'CONSTRAINT_NOT_NULL:maturity_date' END,
  CASE WHEN created_date IS NULL THEN 'CONSTRAINT_NOT_NULL:created_date' END) AS reasons
FROM decoded""",
    ),
    "strict": (
        ["fields"],
        """SELECT event_id, trade_id, CASE WHEN ok THEN version END AS version, maturity_date,
  CASE WHEN trade_id IS NULL OR version IS NULL OR maturity_date IS NULL THEN 'parse_error' END AS reject_code
FROM (SELECT *, CASE WHEN regexp_full_match(maturity_text, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
  THEN try_cast(maturity_text AS date) END AS maturity_date FROM fields)""",
    ),
    "recon_left": (
        ["whole_store"],
        """SELECT *, version + length(trade_id) + cast(substr(book_id, 2, 2) AS int) AS mix FROM whole_store""",
    ),
    "recon_right": (
        ["recon_left"],
        """SELECT * REPLACE (CASE WHEN mix % 5 = 0 THEN 'B99' ELSE book_id END AS book_id,
  CASE WHEN mix % 4 <> 0 THEN counter_party_id END AS counter_party_id,
  CASE WHEN mix % 9 = 0 THEN maturity_date + 1 ELSE maturity_date END AS maturity_date) FROM recon_left WHERE mix % 7 <> 0""",
    ),
    "mismatches": (
        ["recon_left", "recon_right"],
        """SELECT trade_id, version, CASE WHEN no_a THEN 'missing_left' WHEN no_b THEN 'missing_right' ELSE 'differs' END AS status,
  CASE WHEN NOT no_a AND NOT no_b THEN columns END AS differing
FROM (SELECT coalesce(a.trade_id, b.trade_id) AS trade_id, coalesce(a.version, b.version) AS version,
    a.trade_id IS NULL AS no_a, b.trade_id IS NULL AS no_b,
    concat_ws(',', CASE WHEN a.counter_party_id IS DISTINCT FROM b.counter_party_id THEN 'counter_party_id' END,
      CASE WHEN a.book_id IS DISTINCT FROM b.book_id THEN 'book_id' END,
      CASE WHEN a.maturity_date IS DISTINCT FROM b.maturity_date THEN 'maturity_date' END) AS columns
  FROM (SELECT * FROM recon_left WHERE mix % 11 <> 0) a
  FULL OUTER JOIN recon_right b ON a.trade_id = b.trade_id AND a.version = b.version)
WHERE no_a OR no_b OR columns <> ''""",
    ),
    "replayed": (
        ["trades"],
        """SELECT *, CASE
    WHEN version < s THEN 'RULE_1_LOWER_VERSION_THAN_ACTIVE'
    WHEN version = s AND maturity_date < DATE '1998-09-01' THEN 'RULE_2_MATURITY_BEFORE_TODAY_FOR_ACTIVE_VERSION'
  END AS reason
FROM (SELECT *, max(version) OVER (PARTITION BY trade_id ORDER BY arrival
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s FROM trades)""",
    ),
}


def sql(body: str, *names: str) -> str:
    """A statement with the named common tables and all they depend on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in CTES[name][0]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    ctes = ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in ordered)
    return f"WITH {ctes}\n{body}" if ctes else body


TRADE = "trade_id, version, counter_party_id, book_id, maturity_date, created_date, payload"
STORE = f"{TRADE}, expired_flag"

UPSERTED = f"""SELECT {TRADE}, false AS expired_flag FROM newest
UNION ALL
SELECT {STORE} FROM store s WHERE NOT EXISTS
  (SELECT 1 FROM newest n WHERE n.trade_id = s.trade_id AND n.version = s.version)"""

LINES_OUTCOME = """SELECT DISTINCT 'store' AS place, trade_id, version, NULL AS reason, NULL AS raw, 1 AS records
FROM line_judged WHERE reason IS NULL
UNION ALL
SELECT 'dlq', CASE WHEN reason <> 'PARSE_ERROR' THEN trade_id END, CASE WHEN reason <> 'PARSE_ERROR' THEN version END,
  reason, raw, cast(count(*) AS int)
FROM (SELECT j.*, CASE WHEN reason = 'PARSE_ERROR' THEN r.line END AS raw
  FROM line_judged j JOIN raw_lines r ON r.event_id = j.event_id WHERE reason IS NOT NULL)
GROUP BY 2, 3, 4, 5"""

ORACLE = {
    "jsonl_scan": sql(
        """SELECT ok AS parsed, trade_id, version, maturity_text AS maturity_date,
  json_extract_string(j, '$.created_date') AS created_date, cast(json_extract(j, '$.payload.k') AS int) AS k FROM fields""",
        "fields",
    ),
    "csv_scan": sql(f"SELECT {TRADE} FROM trades", "trades"),
    "infer_scan": sql("""SELECT trade_id, cast(version AS bigint) AS version, counter_party_id, book_id, cast(maturity_date AS varchar) AS maturity_date,
  cast(created_date AS varchar) AS created_date, payload, arrival FROM trades""",
        "trades",
    ),
    "landing_routes": sql(
        """SELECT line, book_id, cast(size AS bigint) AS size, CASE WHEN size > 60000 THEN 'large' ELSE 'small' END AS route
FROM (SELECT line, book_id, sum(strlen(line) + 1) OVER (PARTITION BY book_id) AS size
  FROM (SELECT book_id, concat(arrival, '|', trade_id) AS line FROM trades))""",
        "trades",
    ),
    "lineage_scan": sql("SELECT arrival, version AS folder, true AS from_own_file FROM trades", "trades"),
    "manifest_scan": sql(f"SELECT {TRADE}, arrival FROM trades", "trades"),
    "store_lookup": sql(
        f"SELECT {STORE} FROM store WHERE (trade_id, version) IN (SELECT trade_id, version FROM incoming)",
        "store",
        "incoming",
    ),
    "laid_lookup": sql(
        f"SELECT {STORE} FROM store WHERE (trade_id, version) IN (SELECT trade_id, version FROM incoming)",
        "store",
        "incoming",
    ),
    "dlq_scan": sql(
        """SELECT trade_id, version, cast(maturity_date AS varchar) AS maturity_date, reason, NULL AS raw
FROM judged WHERE reason IS NOT NULL
UNION ALL SELECT NULL, NULL, NULL, NULL, line FROM raw_lines WHERE event_type = 'error'""",
        "judged",
        "raw_lines",
    ),
    "canonicalize": sql(
        "SELECT event_id, trade_id, version, maturity_date, created_date, payload, reject_code FROM checked", "checked"
    ),
    "canonicalize_fields": sql(
        """SELECT trade_id, version, counter_party_id, book_id, maturity_date, created_date, '{}' AS payload, arrival
FROM trades""",
        "trades",
    ),
    "csv_convert": sql(
        """SELECT trade_id, version, counter_party_id, book_id, maturity_date, created_date, '{}' AS payload, arrival
FROM trades""",
        "trades",
    ),
    "array_scan": sql(
        """SELECT trade_id, version, counter_party_id, book_id, maturity_date, created_date, payload, arrival, true AS parsed
FROM trades""",
        "trades",
    ),
    "array_files": sql("SELECT trade_id, cast(version AS bigint) AS version, arrival FROM trades", "trades"),
    "month_upsert": sql(
        f"SELECT *, strftime(maturity_date, '%Y-%m') AS maturity_month FROM ({UPSERTED})", "newest", "store"
    ),
    "strict_decode": sql("SELECT event_id, trade_id, version, maturity_date, reject_code FROM strict", "strict"),
    "payload_fields": sql(
        "SELECT arrival, notional, st AS status, cast(NULL AS varchar) AS missing FROM trades", "trades"
    ),
    "reject_envelopes": sql(
        """SELECT arrival, trade_id, version, cast(notional AS varchar) AS notional, reason,
  CASE WHEN reason LIKE 'RULE_1%' THEN s END AS detected_latest_active_version,
  CASE WHEN reason = 'DB_GUARDRAIL_REJECT' THEN error_text END AS db_error,
  reason <> 'DB_GUARDRAIL_REJECT' AS has_detected_at, reason = 'DB_GUARDRAIL_REJECT' AS has_rejected_at
FROM judged WHERE reason IS NOT NULL""",
        "judged",
    ),
    "tagged_routes": sql(
        """SELECT CASE WHEN reason IS NULL THEN 'accept' ELSE 'dlq' END AS route, trade_id, version, reason,
  reason IS NULL AS has_accepted_at FROM judged""",
        "judged",
    ),
    "message_keys": sql(
        """SELECT trade_id AS key, concat('{"trade_id":"', trade_id, '","version":', cast(version AS varchar),
  ',"counter_party_id":"', counter_party_id, '","book_id":"', book_id, '","maturity_date":"', cast(maturity_date AS varchar),
  '","created_date":"', cast(created_date AS varchar), '","payload":"', replace(payload, '"', '\\"'), '"}') AS value, true AS placed FROM trades""",
        "trades",
    ),
    "convert_roundtrip": sql(
        """SELECT event_id, trade_id, version, maturity_date, created_date, payload FROM checked
WHERE reject_code IS NULL""",
        "checked",
    ),
    "validate_records": sql("SELECT event_id, reasons = '' AS is_valid, reasons FROM reasons_of", "reasons_of"),
    "constraint_check": sql("SELECT event_id, reject_code FROM checked", "checked"),
    "duplicate_keys": sql(
        "SELECT trade_id, version, count(*) AS rows FROM trades GROUP BY trade_id, version HAVING count(*) > 1", "trades"
    ),
    "spec_rules": sql(
        """SELECT arrival, concat_ws(',', CASE WHEN maturity_date < created_date THEN 'MATURITY_BEFORE_CREATED' END,
  CASE WHEN version > 6 THEN 'VERSION_TOO_HIGH' END, CASE WHEN book_id IN ('B0', 'B1') THEN 'HOUSE_BOOK' END) AS reasons
FROM trades""",
        "trades",
    ),
    "active_trades": sql(f"SELECT {STORE} FROM whole_store WHERE NOT expired_flag", "whole_store"),
    "active_by_maturity": sql(
        f"""SELECT {STORE} FROM whole_store
WHERE NOT expired_flag AND maturity_date BETWEEN DATE '1997-01-15' AND DATE '1997-12-15'""",
        "whole_store",
    ),
    "prefilter_accepts": sql(f"SELECT {TRADE}, arrival FROM replayed WHERE reason IS NULL", "replayed"),
    "prefilter_rejects": sql(
        "SELECT arrival, trade_id, version, s AS seen_version, reason FROM replayed WHERE reason IS NOT NULL", "replayed"
    ),
    "prefilter_strict": sql(
        """SELECT event_id, trade_id, version, CASE WHEN version < s THEN 'lower_version'
  WHEN version = s AND maturity_date < DATE '2024-01-15' THEN 'expired_same_version' END AS reason
FROM (SELECT *, max(version) OVER (PARTITION BY trade_id ORDER BY event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s FROM strict WHERE reject_code IS NULL)
UNION ALL SELECT event_id, trade_id, version, reject_code FROM strict WHERE reject_code IS NOT NULL""",
        "strict",
    ),
    "guardrail": sql(
        """SELECT arrival, trade_id, version, CASE WHEN bad THEN 'DB_GUARDRAIL_REJECT' END AS reason,
  CASE WHEN bad THEN error_text END AS db_error
FROM (SELECT *, coalesce(version < top OR (version = top AND maturity_date < DATE '1998-09-01'), false) AS bad FROM judged)""",
        "judged",
    ),
    "two_tier_rules": sql(
        """SELECT arrival, trade_id, version, maturity_date, reason, s AS seen_version,
  CASE WHEN reason = 'DB_GUARDRAIL_REJECT' THEN error_text END AS db_error FROM judged""",
        "judged",
    ),
    "active_scope_rules": sql(
        """SELECT arrival, trade_id, version, CASE WHEN version < top THEN 'RULE_1_LOWER_VERSION_THAN_ACTIVE'
  WHEN version = top AND maturity_date < DATE '1998-09-01' THEN 'RULE_2_MATURITY_BEFORE_TODAY_FOR_ACTIVE_VERSION' END AS reason
FROM topped""",
        "topped",
    ),
    "line_rules": sql("SELECT event_id, trade_id, version, reason FROM line_judged", "line_judged"),
    "upsert_status": sql(
        """SELECT arrival, trade_id, version, CASE WHEN version < top THEN 'REJECTED: lower_version'
  WHEN version = top AND maturity_date < DATE '1998-09-01' THEN 'REJECTED: same_version_maturity_before_today'
  WHEN blocked THEN 'REJECTED: db_guardrail_prevented_update' ELSE 'OK' END AS status
FROM (SELECT *, greatest(coalesce(s, l0), coalesce(l0, s)) AS top FROM (
  SELECT i.*, l.active_version AS l0, x.trade_id IS NOT NULL AS blocked,
    max(CASE WHEN x.trade_id IS NULL THEN i.version END) OVER (PARTITION BY i.trade_id ORDER BY i.arrival
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s
  FROM incoming i LEFT JOIN levels l ON i.trade_id = l.trade_id
  LEFT JOIN (SELECT trade_id, version FROM store WHERE expired_flag) x
    ON i.trade_id = x.trade_id AND i.version = x.version))""",
        "incoming",
        "levels",
    ),
    "maturity_regression": sql(
        """SELECT arrival, trade_id, maturity_date, greatest(coalesce(r, m0), coalesce(m0, r)) AS floor_maturity,
  CASE WHEN maturity_date < greatest(coalesce(r, m0), coalesce(m0, r)) THEN 'MATURITY_BEFORE_STORED' END AS reason
FROM (SELECT i.*, m.m0, max(i.maturity_date) OVER (PARTITION BY i.trade_id ORDER BY i.arrival
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r
  FROM incoming i LEFT JOIN (SELECT trade_id, arg_max(maturity_date, version) AS m0 FROM store GROUP BY trade_id) m
    ON i.trade_id = m.trade_id)""",
        "incoming",
        "store",
    ),
    "upsert_store": sql(UPSERTED, "newest", "store"),
    "bulk_load": sql(UPSERTED, "newest", "store"),
    "upsert_active_only": sql(
        f"""SELECT {TRADE}, false AS expired_flag FROM newest n WHERE NOT EXISTS
  (SELECT 1 FROM store s WHERE n.trade_id = s.trade_id AND n.version = s.version AND s.expired_flag)
UNION ALL
SELECT {STORE} FROM store s WHERE s.expired_flag OR NOT EXISTS
  (SELECT 1 FROM newest n WHERE n.trade_id = s.trade_id AND n.version = s.version)""",
        "newest",
        "store",
    ),
    "insert_if_absent": sql(
        f"""SELECT {STORE} FROM store
UNION ALL
SELECT {TRADE}, false FROM (SELECT *, row_number() OVER (PARTITION BY trade_id, version ORDER BY arrival) AS rn FROM incoming) i
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM store s WHERE s.trade_id = i.trade_id AND s.version = i.version)""",
        "store",
        "incoming",
    ),
    "delete_trades": sql(
        f"""SELECT {STORE} FROM store
WHERE trade_id NOT IN (SELECT trade_id FROM incoming WHERE maturity_date < DATE '1998-09-01')""",
        "store",
        "incoming",
    ),
    "merge_last_wins": sql(
        """SELECT coalesce(t.trade_id, s.trade_id) AS trade_id,
  CASE WHEN take THEN s.version ELSE t.version END AS version,
  CASE WHEN take THEN s.maturity_date ELSE t.maturity_date END AS maturity_date,
  CASE WHEN take THEN s.counter_party_id ELSE t.counter_party_id END AS counter_party_id,
  CASE WHEN take THEN s.book_id ELSE t.book_id END AS book_id,
  CASE WHEN take THEN s.payload ELSE t.payload END AS payload
FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY version DESC) AS rn FROM store) WHERE rn = 1) t
FULL OUTER JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY version DESC, arrival DESC) AS rn
  FROM incoming) WHERE rn = 1) s ON t.trade_id = s.trade_id
CROSS JOIN LATERAL (SELECT s.trade_id IS NOT NULL AND (t.trade_id IS NULL
  OR (s.version >= t.version AND s.maturity_date >= t.maturity_date)) AS take) x""",
        "store",
        "incoming",
    ),
    "expire_matured": sql(
        f"""SELECT {TRADE}, expired_flag OR maturity_date < DATE '1997-06-01' AS expired_flag FROM whole_store""", "whole_store"
    ),
    "hash_layout": sql(
        "SELECT trade_id, count(*) AS rows, cast(1 AS bigint) AS buckets FROM whole_store GROUP BY trade_id", "whole_store"
    ),
    "maturity_months": sql(
        """SELECT strftime(maturity_date, '%Y-%m') AS maturity_month, count(*) AS rows, max(version) AS top_version
FROM whole_store GROUP BY 1""",
        "whole_store",
    ),
    "latest_per_trade": sql(
        f"""SELECT {TRADE}, arrival FROM (SELECT *, row_number() OVER (PARTITION BY trade_id
  ORDER BY version DESC, arrival DESC) AS rn FROM trades) WHERE rn = 1""",
        "trades",
    ),
    "rebuild_store": sql(
        f"""SELECT {TRADE}, false AS expired_flag FROM (SELECT *, row_number() OVER (PARTITION BY trade_id, version
  ORDER BY arrival DESC) AS rn FROM replayed WHERE reason IS NULL) WHERE rn = 1""",
        "replayed",
    ),
    "latest_active_version": sql("SELECT trade_id, max(version) AS active_version FROM whole_store WHERE NOT expired_flag GROUP BY trade_id", "whole_store"),
    "active_counts": sql(
        """SELECT p.trade_id, p.version, count(*) FILTER (s.version > p.version) AS higher_active,
  count(*) FILTER (s.version = p.version) AS same_active
FROM (SELECT DISTINCT trade_id, version FROM incoming) p
LEFT JOIN (SELECT trade_id, version FROM store WHERE NOT expired_flag) s ON p.trade_id = s.trade_id
GROUP BY p.trade_id, p.version""",
        "incoming",
        "store",
    ),
    "array_chunks": sql(
        """SELECT 'chunk' AS kind, cast(chunk AS varchar) AS trade_id, least(1000, n - chunk * 1000) AS number
FROM (SELECT count(*) AS n FROM trades) t, LATERAL (SELECT unnest(range((n + 999) // 1000)) AS chunk) c
UNION ALL SELECT 'record', trade_id, cast(version AS bigint) FROM trades""",
        "trades",
    ),
    "chunk_manifest": sql(
        """SELECT 'load-2' AS correlation_id, count(*) AS rows, true AS all_listed, true AS same_checksums, true AS within_limit
FROM trades""",
        "trades",
    ),
    "sized_parts": sql("SELECT arrival, true AS as_drawn, true AS known_part FROM trades", "trades"),
    "audit_recent": """SELECT concat('load-', cast(o_orderkey AS varchar)) AS correlation_id,
  concat('job-', cast(o_custkey AS varchar)) AS job_id,
  CASE WHEN o_orderstatus = 'F' THEN 'SUCCESS' ELSE 'RUNNING' END AS status, cast(o_orderdate AS date) AS created_on
FROM orders ORDER BY o_orderdate DESC, correlation_id LIMIT 25""",
    "ingest_metrics": sql(
        """SELECT coalesce(outcome, 'ALL') AS outcome, count(*) AS records,
  count(*) FILTER (reason IS NULL AND version = s) AS replacements,
  count(*) FILTER (reason = 'DB_GUARDRAIL_REJECT') AS failed_upserts
FROM (SELECT *, coalesce(reason, 'accept') AS outcome FROM judged) GROUP BY ROLLUP (outcome)""",
        "judged",
    ),
    "converge_sources": sql(
        """SELECT arrival, trade_id, version, CASE WHEN st = 'O' THEN 'stream' ELSE 'file' END AS source_system, reason
FROM replayed""",
        "replayed",
    ),
    "reconcile": sql("SELECT trade_id, version, status, differing FROM mismatches", "mismatches"),
    "reconcile_summary": sql(
        "SELECT status, differing, count(*) AS rows FROM mismatches GROUP BY status, differing", "mismatches"
    ),
    "reconcile_three_ways": sql(
        """SELECT trade_id, version, CASE WHEN mix % 41 = 0 THEN 'stream' WHEN mix % 47 = 0 THEN 'snapshot' ELSE '' END AS missing,
  CASE WHEN mix % 43 = 0 THEN 'book_id' WHEN mix % 53 = 0 THEN 'maturity_date' ELSE '' END AS differing
FROM (SELECT *, version + length(trade_id) + cast(substr(book_id, 2, 2) AS int) AS mix FROM whole_store)
WHERE mix % 41 = 0 OR mix % 43 = 0 OR mix % 47 = 0 OR mix % 53 = 0""",
        "whole_store",
    ),
    "worker_metrics": sql(
        """, w AS (SELECT *, cast(cast(substr(book_id, 2, 2) AS int) % 4 AS varchar) AS worker, coalesce(reason, 'accept') AS outcome FROM judged),
d AS (SELECT worker, count(*) - count(DISTINCT (trade_id, version)) AS duplicates FROM w GROUP BY worker),
t AS (SELECT worker, duplicates FROM d UNION ALL SELECT 'ALL', sum(duplicates) FROM d),
m AS (SELECT coalesce(worker, 'ALL') AS worker, coalesce(outcome, 'ALL') AS outcome, count(*) AS records,
  count(*) FILTER (reason IS NULL AND version = s) AS replacements, count(*) FILTER (reason = 'DB_GUARDRAIL_REJECT') AS failed_upserts
FROM w GROUP BY ROLLUP (worker, outcome))
SELECT m.*, CASE WHEN outcome = 'ALL' THEN cast(t.duplicates AS bigint) END AS duplicates FROM m JOIN t USING (worker)""",
        "judged",
    ),
    "settled_landing": sql(
        LINES_OUTCOME.replace("FROM line_judged", "FROM early").replace("JOIN raw_lines", "JOIN early_lines"), "early", "early_lines"
    ),
    "stateful_rules": sql("SELECT arrival, trade_id, version, reason, s AS seen_version FROM replayed", "replayed"),
    "stream_progress": sql(
        """SELECT 'counts.records' AS metric, count(*) AS records FROM checked
UNION ALL SELECT 'counts.refused', count(reject_code) FROM checked""",
        "checked",
    ),
    "dedup_ttl": """SELECT event_id, user_id, event_type FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id, event_type
  ORDER BY ts, event_id) AS previous FROM events) WHERE previous IS NULL OR ts > previous + INTERVAL 6 HOUR""",
    "dedup_history": """SELECT event_id, user_id, event_type, batch FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
  ORDER BY batch, ts, event_id) AS rn FROM (SELECT *, cast(dayofyear(ts) % 3 AS int) AS batch FROM events)) WHERE rn = 1""",
    "stream_ingest": sql(LINES_OUTCOME, "line_judged", "raw_lines"),
    "bulk_rejects": sql(LINES_OUTCOME, "line_judged", "raw_lines"),
    "line_status": sql(
        """SELECT event_id, trade_id, version, CASE WHEN version < s THEN 'REJECTED: lower_version'
  WHEN version = s AND maturity_date < DATE '2024-01-15' THEN 'REJECTED: same_version_maturity_before_today' ELSE 'OK' END AS status
FROM (SELECT *, max(version) OVER (PARTITION BY trade_id ORDER BY event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s FROM checked WHERE reject_code IS NULL)
UNION ALL SELECT event_id, trade_id, version, reject_code FROM checked WHERE reject_code IS NOT NULL""",
        "checked",
    ),
    "small_file_flow": sql(
        """SELECT CASE WHEN reasons = '' THEN 'message' ELSE 'dlq' END AS place,
  CASE WHEN reasons = '' THEN trade_id END AS key, reasons, true AS traced, count(*) AS records
FROM reasons_of GROUP BY 1, 2, 3, 4""",
        "reasons_of",
    ),
    # the stream reads one file in one batch, before the watermark forgets anything
    "dedup_stream": "SELECT DISTINCT user_id, event_type FROM events",
    "generated_trades": """SELECT kind, cast(CASE kind WHEN 'v1' THEN v1 WHEN 'vn' THEN vn ELSE n - v1 - vn END AS bigint) AS records,
  cast(CASE kind WHEN 'vn' THEN 2 ELSE 1 END AS bigint) AS low_version,
  cast(CASE kind WHEN 'v1' THEN 1 ELSE 4 END AS bigint) AS high_version
FROM (SELECT count(*) AS n, round(count(*) * 0.2) AS v1, round(count(*) * 0.3) AS vn FROM lineitem) t,
  (VALUES ('v1'), ('vn'), ('other')) k(kind)""",
}

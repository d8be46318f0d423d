"""The answers of the sample queries as plain SQL over the same tables."""

from __future__ import annotations

_MAIN = (
    "'<main><ean>' || p_partkey || '</ean><title>' || p_name || '</title><size>' || p_size || '</size></main>'"
)
_PAYLOAD = f"'<product>' || {_MAIN} || '<price><amount>' || p_retailprice || '</amount></price></product>'"
_MARKET = "CASE p_size % 3 WHEN 0 THEN 'EU' WHEN 1 THEN '' ELSE 'ASIA' END"
_RECORD = f"""'<product><ean>' || p_partkey || '</ean><group>' || p_type || '</group><group /><group>' || p_brand
  || '</group><group>' || p_type || '</group><sold>' || CASE WHEN {_MARKET} = '' THEN '<market />'
  ELSE '<market>' || {_MARKET} || '</market>' END || '</sold></product>'"""
_ENVELOPE = (
    "'<?xml version=\"1.0\" encoding=\"UTF-8\" standalone=\"yes\"?><response><errors><error><description>"
    "General problem with the data URL.</description></error></errors></response>'"
)
_NOW = "TIMESTAMP '2024-06-01 00:00:00'"
_BEFORE = "TIMESTAMP '2024-01-01 00:00:00'"

_LEDGER = """WITH runs AS (
  SELECT o_custkey AS process_id, o_orderkey AS change_id,
         CASE o_orderstatus WHEN 'O' THEN 'C' ELSE o_orderstatus END AS status, o_orderdate AS start_dtime,
         CASE WHEN o_orderpriority LIKE '4%' THEN '' ELSE o_orderpriority END AS last_anchor
  FROM orders)"""

_EVENTS = """WITH updates AS (
  SELECT user_id, event_id, CASE WHEN event_type <> 'error' THEN event_type END AS last_type,
         CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN CAST(value AS VARCHAR) END AS last_value
  FROM events)"""

_UPSERT = f"""WITH target AS (
  SELECT s_suppkey, s_name, s_acctbal, s_nationkey FROM supplier WHERE s_nationkey < 15
), incoming AS (
  SELECT s_suppkey, s_suppkey % 4 AS kind,
         CASE s_suppkey % 4 WHEN 1 THEN s_name || '!' WHEN 2 THEN NULL ELSE s_name END AS s_name,
         CASE WHEN s_suppkey % 4 <> 3 THEN s_acctbal END AS s_acctbal
  FROM supplier WHERE s_nationkey >= 5
), merged AS (
  SELECT coalesce(t.s_suppkey, i.s_suppkey) AS s_suppkey,
         CASE WHEN i.kind <> 0 THEN i.s_name ELSE t.s_name END AS s_name,
         CASE WHEN i.kind <> 3 THEN i.s_acctbal ELSE t.s_acctbal END AS s_acctbal,
         t.s_nationkey,
         CASE WHEN t.s_suppkey IS NULL THEN 'inserted' WHEN i.s_suppkey IS NULL THEN 'untouched'
              WHEN (i.kind <> 0 AND i.s_name IS DISTINCT FROM t.s_name)
                OR (i.kind <> 3 AND i.s_acctbal IS DISTINCT FROM t.s_acctbal) THEN 'updated'
              ELSE 'unchanged' END AS action
  FROM target t FULL OUTER JOIN incoming i ON t.s_suppkey = i.s_suppkey)"""

_APPLIED = f"""
SELECT p_partkey AS ean,
       CASE WHEN p_size < 20 THEN p_name
            WHEN p_partkey % 4 = 0 THEN upper(p_name)
            WHEN p_partkey % 4 = 1 THEN NULL
            WHEN p_size < 40 THEN p_name END AS title,
       p_size AS size,
       CASE WHEN p_size >= 20 AND p_partkey % 4 = 2
            THEN CAST(CAST(p_retailprice + 1 AS DECIMAL(38,10)) AS DOUBLE)
            WHEN p_size < 40 THEN p_retailprice END AS price,
       CASE WHEN p_size < 40 THEN {_BEFORE} ELSE {_NOW} END AS add_dtime,
       CASE WHEN p_size >= 40 OR (p_size >= 20 AND p_partkey % 4 <> 3) THEN {_NOW} ELSE {_BEFORE} END AS upd_dtime
FROM part"""

_RUN = f"""
SELECT CAST(1 AS BIGINT) AS change_id, p_partkey AS ean, CASE WHEN p_size = 7 THEN {_ENVELOPE} ELSE {_PAYLOAD} END AS data,
       'C' AS status, count(*) OVER () AS total_records
FROM part WHERE p_size % 3 IN (0, 1)"""

ORACLE: dict[str, str] = {
    "extract_xml_scalar": "SELECT p_partkey AS ean, p_name AS title, p_size AS size, p_retailprice AS price FROM part",
    "extract_absent_vs_empty": """
SELECT p_partkey AS ean,
       CASE p_partkey % 3 WHEN 0 THEN 'absent' WHEN 1 THEN 'empty' ELSE 'value' END AS state,
       CASE WHEN p_partkey % 3 = 2 THEN p_name END AS title
FROM part""",
    "extract_xml_body": f"SELECT p_partkey AS ean, {_MAIN} AS main_xml FROM part",
    "extract_full_xpath": """
SELECT p_partkey AS ean,
       CASE WHEN p_partkey % 4 = 0 THEN CAST(p_size AS VARCHAR)
            WHEN p_size > 25 OR p_size < 5 THEN p_name END AS label
FROM part""",
    "extract_json_path": """
SELECT event_id, event_type AS kind, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "quarantine_split": """
WITH payloads AS (
  SELECT CASE p_partkey % 7 WHEN 0 THEN 'error_payload' WHEN 1 THEN 'not_a_document' WHEN 2 THEN 'too_few_attributes'
         WHEN 3 THEN 'bad_value' WHEN 4 THEN 'blank_target_key' WHEN 5 THEN 'not_a_document' ELSE 'usable' END AS reason,
         CASE p_partkey % 7 WHEN 3 THEN 'price' WHEN 4 THEN 'ean' ELSE '' END AS detail
  FROM part
  UNION ALL
  SELECT CASE WHEN html LIKE '%<errors>%' OR html LIKE '%<error>%' THEN 'error_payload' ELSE 'not_a_document' END, ''
  FROM pages)
SELECT reason, detail, count(*) AS records FROM payloads GROUP BY reason, detail""",
    "value_losses": """
WITH kinds AS (
  SELECT p_partkey AS ean, CASE p_partkey % 7 WHEN 1 THEN 'cost' WHEN 4 THEN 'ratio' WHEN 5 THEN 'seen'
         WHEN 3 THEN CASE WHEN p_partkey % 10 <> 0 THEN 'ratio' ELSE '' END ELSE '' END AS detail
  FROM part)
SELECT ean, CASE WHEN detail <> '' THEN 'value_altered' ELSE '' END AS reason, detail,
       CASE WHEN detail = '' THEN ean + CASE WHEN ean % 7 = 2 THEN 0.25::DOUBLE ELSE 0 END END AS cost,
       CASE WHEN detail = '' THEN CASE WHEN ean % 7 = 3 THEN ean // 10 ELSE ean END END AS ratio
FROM kinds""",
    "bucket_presence": """
SELECT p_partkey AS ean, 'main' AS bucket FROM part WHERE p_partkey % 4 < 2
UNION ALL
SELECT p_partkey, 'price' FROM part WHERE p_partkey % 2 = 0""",
    "truncated_text": """
SELECT p_partkey AS ean, left(p_name, 8) AS title, CASE WHEN length(p_name) > 8 THEN 'title' ELSE '' END AS truncated
FROM part""",
    "records_of_pages": f"""
SELECT p_partkey // 50 AS page_no,
       CAST(row_number() OVER (PARTITION BY p_partkey // 50 ORDER BY p_partkey) - 1 AS INTEGER) AS record_no,
       p_partkey AS ean, {_RECORD} AS notification
FROM part""",
    "json_array_records": """
SELECT p_partkey // 50 AS page_no,
       CAST(row_number() OVER (PARTITION BY p_partkey // 50 ORDER BY p_partkey) - 1 AS INTEGER) AS record_no,
       p_partkey AS ean, p_name AS title, p_size AS size
FROM part""",
    "response_filter": "SELECT p_partkey AS ean FROM part WHERE p_size % 3 IN (0, 1)",
    "filter_args": f"""
SELECT p_partkey AS ean,
       'http://catalog.example/product?detail=full&part=' || p_partkey || '&groups=' || p_type || ',' || p_brand
       || CASE WHEN {_MARKET} = '' THEN '' ELSE '&markets=' || {_MARKET} END AS request_url
FROM part""",
    "xpath_args": """
SELECT p_partkey AS ean,
       'http://catalog.example/product?names=' || p_name || p_brand || ',' || p_type
       || CASE WHEN p_brand LIKE '%Brand#3%' THEN '&kind=' || p_type ELSE '' END
       || '&bare=' || p_name || p_brand AS request_url
FROM part""",
    "page_chain": """
SELECT DISTINCT 'http://catalog.example/products?list=spares'
       || CASE WHEN p_partkey // 20 = 0 THEN '' ELSE '&page=' || (p_partkey // 20) END AS url,
       p_partkey // 20 AS page_no
FROM part""",
    "key_manifests": """
SELECT DISTINCT l_partkey AS ean, '<product><ean>' || l_partkey || '</ean></product>' AS notification,
       CAST(1 AS BIGINT) AS ids,
       'http://catalog.example/product?detail=full&part=' || l_partkey AS request_url
FROM lineitem""",
    "parse_kv_list": """
SELECT p_partkey, 'brand,size,type,blank' AS arg_names, p_brand AS brand, CAST(p_size + 1 AS VARCHAR) AS size, '' AS blank
FROM part""",
    "format_url": """
SELECT s_suppkey,
       'http://h/s?id=' || s_suppkey || CASE WHEN s_nationkey > 5 THEN '&nation=' || s_nationkey ELSE '' END AS url,
       'http://h/s' AS bare_url
FROM supplier""",
    "anchor_url": """
SELECT c_custkey,
       CASE c_custkey % 3 WHEN 0 THEN 'HTTP://other/' || c_custkey
            WHEN 1 THEN 'http://catalog.example/products?list=spares&anchor=' || c_custkey END AS url
FROM customer""",
    "since_epoch_ms": f"""
SELECT o_orderkey, epoch_ms(o_orderdate) AS start_ms,
       CASE o_orderkey % 3
            WHEN 0 THEN epoch_ms({_NOW} - to_days(CAST(o_orderkey % 40 AS INTEGER)))
            WHEN 2 THEN epoch_ms(o_orderdate - INTERVAL 15 MINUTE) END AS since_ms
FROM orders""",
    "config_specs": """
SELECT c_custkey AS process_id, c_name AS process_name,
       CASE WHEN c_acctbal > 0 THEN 'http://h/c' END AS change_url, 'http://h/d' AS data_url,
       CASE WHEN c_nationkey % 3 = 0 THEN 'JSON' ELSE 'XML' END AS content_type,
       c_mktsegment AS segment, CAST(2 AS INTEGER) AS arg_count,
       'EAN,' || CASE WHEN c_mktsegment < 'TITLE' THEN c_mktsegment || ',TITLE' ELSE 'TITLE,' || c_mktsegment END AS columns
FROM customer WHERE c_nationkey % 2 = 0""",
    "config_bucket_rows": """
SELECT c_custkey AS process_id, 'main' AS bucket_nm, attr_nm, CAST(-1 AS INTEGER) AS attr_len, attr_nm = 'EAN' AS is_key,
       '//main/' || lower(attr_nm) AS attr_xpath
FROM (SELECT c_custkey, unnest(['TITLE', 'EAN', c_mktsegment]) AS attr_nm FROM customer)""",
    "key_list": """
SELECT CAST(p_partkey AS VARCHAR) AS key FROM part UNION SELECT CAST(p_size AS VARCHAR) FROM part
UNION SELECT CAST(l_partkey AS VARCHAR) FROM lineitem""",
    "lookup_payload": f"""
SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS key,
       CASE WHEN p_partkey IS NULL THEN {_ENVELOPE} ELSE {_PAYLOAD} END AS data
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 5) ON l_partkey = p_partkey""",
    "lookup_stored": f"""
WITH stored AS (
  SELECT CAST(p_partkey AS VARCHAR) AS key,
         CASE WHEN p_partkey % 3 = 0 AND p_size > 2
              THEN '<product>' || {_MAIN} || '<price><amount>' || (p_retailprice + 1) || '</amount></price></product>'
              ELSE {_PAYLOAD} END AS body
  FROM part WHERE p_size > 5 OR (p_partkey % 3 = 0 AND p_size > 2))
SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS key, coalesce(body, {_ENVELOPE}) AS data
FROM lineitem LEFT JOIN stored ON CAST(l_partkey AS VARCHAR) = stored.key""",
    "ledger_argmax": f"""{_LEDGER}
SELECT process_id, change_id, status, start_dtime, last_anchor FROM runs r
WHERE status = 'C' AND change_id = (SELECT max(change_id) FROM runs m WHERE m.process_id = r.process_id AND m.status = 'C')""",
    "resume_point": f"""{_LEDGER}
SELECT process_id, max(change_id) AS change_id, arg_max(last_anchor, change_id) AS last_anchor
FROM runs WHERE status IN ('F', 'P') GROUP BY process_id""",
    "incremental_window": f"""{_LEDGER}, latest AS (
  SELECT process_id,
         arg_max(start_dtime, change_id) FILTER (WHERE status = 'C') AS done_start,
         arg_max(start_dtime, change_id) FILTER (WHERE status = 'F') AS failed_start,
         arg_max(last_anchor, change_id) FILTER (WHERE status = 'F') AS failed_anchor
  FROM runs GROUP BY process_id
), filled AS (
  SELECT c_custkey AS process_id, coalesce(done_start, {_NOW} - INTERVAL 30 DAY) AS done_start,
         coalesce(failed_start, {_NOW} - INTERVAL 30 DAY) AS failed_start, failed_anchor
  FROM customer LEFT JOIN latest ON c_custkey = process_id
), chosen AS (
  SELECT *, failed_start > done_start AND coalesce(failed_anchor, '') <> '' AS resumes FROM filled)
SELECT process_id, CASE WHEN resumes THEN failed_start ELSE done_start END AS start_dtime,
       CASE WHEN resumes THEN failed_anchor END AS last_anchor,
       epoch_ms(CASE WHEN resumes THEN failed_start ELSE done_start END - INTERVAL 15 MINUTE) AS since_ms
FROM chosen""",
    "ledger_events": """
SELECT o_orderkey AS change_id, o_custkey AS process_id, o_orderdate AS start_dtime,
       o_orderdate + INTERVAL 1 DAY AS end_dtime,
       CASE WHEN o_orderstatus = 'O' THEN o_custkey END AS total_records,
       CASE WHEN o_orderkey % 2 = 0 THEN 'last' ELSE o_orderpriority END AS last_anchor,
       CASE WHEN o_orderstatus = 'O' THEN 'C' ELSE 'F' END AS status,
       o_orderdate AS add_dtime, o_orderdate + INTERVAL 3 HOUR AS upd_dtime
FROM orders""",
    "typed_diff": """
SELECT l_orderkey, count(*) FILTER (WHERE l_orderkey % 4 IN (1, 3)) AS same,
       count(*) FILTER (WHERE l_orderkey % 4 IN (0, 3)) AS same_text,
       count(*) FILTER (WHERE l_shipdate = date_trunc('day', l_shipdate)) AS same_date
FROM lineitem GROUP BY l_orderkey""",
    "fold_updates": f"""{_EVENTS}
SELECT user_id, arg_max(last_type, event_id) FILTER (WHERE last_type IS NOT NULL) AS last_type,
       arg_max(last_value, event_id) FILTER (WHERE last_value IS NOT NULL) AS last_value
FROM updates GROUP BY user_id""",
    "fold_whole_rows": f"""{_EVENTS}
SELECT user_id, last_type, last_value FROM updates
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
    "upsert_full": f"""{_UPSERT}
SELECT s_suppkey, s_name, s_acctbal, s_nationkey,
       CASE action WHEN 'inserted' THEN {_NOW} ELSE {_BEFORE} END AS add_dtime,
       CASE WHEN action IN ('inserted', 'updated') THEN {_NOW} ELSE {_BEFORE} END AS upd_dtime, action
FROM merged""",
    "upsert_counts": f"""{_UPSERT}
SELECT count(*) FILTER (WHERE action = 'inserted') AS inserted, count(*) FILTER (WHERE action = 'updated') AS updated,
       count(*) FILTER (WHERE action = 'unchanged') AS unchanged, count(*) FILTER (WHERE action = 'untouched') AS untouched
FROM merged""",
    "target_by_key": """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_quantity > 49)""",
    "target_count": "SELECT count(*) AS row_count FROM lineitem",
    "apply_parts": _APPLIED,
    "stream_applied": _APPLIED,
    "apply_lines": """
WITH numbered AS (
  SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) * 10000000 + l_partkey AS id FROM lineitem)
SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_quantity AS quantity, l_extendedprice AS price,
       l_returnflag AS flag, l_shipdate AS shipped
FROM numbered QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY id DESC) = 1""",
    "full_run": f"""
SELECT p_partkey AS ean, p_name AS title, p_size AS size, p_retailprice AS price,
       {_NOW} AS add_dtime, {_NOW} AS upd_dtime, 'manifest' AS source
FROM part WHERE p_size % 3 IN (0, 1) AND p_size <> 7
UNION ALL
SELECT p_partkey, p_name, p_size, p_retailprice, {_NOW}, {_NOW}, 'key list'
FROM part WHERE p_size <> 7 AND p_partkey IN (SELECT l_partkey FROM lineitem)""",
    "full_run_ledger": f"""
WITH listed AS (
  SELECT DISTINCT l_partkey, p_partkey FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size <> 7
), runs AS (
  SELECT CAST(1 AS BIGINT) AS change_id, count(*) AS total_records, count(*) FILTER (WHERE p_size = 7) AS bad
  FROM part WHERE p_size % 3 IN (0, 1)
  UNION ALL
  SELECT 2, count(*), count(*) FILTER (WHERE p_partkey IS NULL) FROM listed)
SELECT change_id, change_id AS process_id, {_NOW} AS start_dtime, total_records, 'C' AS status,
       CASE WHEN bad > 0 THEN 'error_payload' END AS reason, CASE WHEN bad > 0 THEN bad END AS bad
FROM runs""",
    "incremental_runs": """
SELECT p_partkey AS ean, p_name AS title, p_size AS size, p_retailprice AS price,
       CASE p_partkey % 3 WHEN 0 THEN TIMESTAMP '2024-03-01' ELSE TIMESTAMP '2024-05-01' END AS add_dtime, add_dtime AS upd_dtime
FROM part WHERE p_size % 3 IN (0, 1) AND p_size <> 7""",
    "many_processes": """
WITH wanted AS (
  SELECT p_partkey % 8 + 1 AS process_id, * FROM part WHERE p_size % 3 IN (0, 1) AND p_partkey % 8 + 1 NOT IN (3, 6)
), runs AS (
  SELECT process_id, 'C' AS status, count(*) AS total_records FROM wanted GROUP BY process_id
  UNION ALL SELECT 3, 'F', NULL UNION ALL SELECT 6, 'F', NULL)
SELECT process_id, status, total_records, p_partkey AS ean, p_name AS title, p_size AS size, p_retailprice AS price
FROM runs LEFT JOIN (SELECT * FROM wanted WHERE p_size <> 7) USING (process_id)""",
    "apply_counts": """
SELECT count(*) AS total, count(*) FILTER (WHERE p_partkey % 4 IN (1, 3)) AS failed, CAST(0 AS BIGINT) AS cut,
       count(*) FILTER (WHERE p_size >= 40 AND p_partkey % 4 IN (0, 2)) AS inserted,
       count(*) FILTER (WHERE p_size < 40 AND p_partkey % 4 = 0) AS updated,
       count(*) FILTER (WHERE p_size < 40 AND p_partkey % 4 = 2) AS unchanged
FROM part WHERE p_size >= 20""",
    "manifest_key_problems": """
SELECT p_partkey, CASE WHEN p_partkey % 5 <> 4 THEN 0 END AS record_no,
       CASE p_partkey % 5 WHEN 1 THEN '' WHEN 2 THEN p_name WHEN 3 THEN CAST(p_partkey AS VARCHAR) END AS key,
       CASE p_partkey % 5 WHEN 0 THEN 'blank_key' WHEN 1 THEN 'blank_key' WHEN 2 THEN 'key_not_numeric'
            WHEN 4 THEN 'page_not_a_document' END AS reason
FROM part""",
    "sql_functions": f"""
SELECT p_partkey AS ean, p_name AS title, '<price><amount>' || p_retailprice || '</amount></price>' AS price,
       CAST(NULL AS VARCHAR) AS nothing, {_RECORD} AS record
FROM part""",
    "archive_order": f"""
SELECT p_partkey AS ean, p_partkey // 50 AS page_no,
       CAST(row_number() OVER (PARTITION BY p_partkey // 50 ORDER BY p_partkey) AS INTEGER) AS place,
       {_RECORD} AS notification, CASE WHEN p_size = 7 THEN {_ENVELOPE} ELSE {_PAYLOAD} END AS data
FROM part WHERE p_size % 3 IN (0, 1)""",
    "stream_replayed": f"""
SELECT *, CAST(2 AS INTEGER) AS versions, CAST(0 AS INTEGER) AS runs_to_apply FROM ({_APPLIED})""",
    "live_payloads": _RUN,
    "stream_pulled": _RUN,
    "resumed_run": f"""
SELECT *, 'http://catalog.example/products?list=spares&page=' || (SELECT (max(p_partkey) // 50 + 1) // 2 FROM part) AS failed_at,
       'failed,complete' AS outcomes FROM ({_RUN})""",
    "windowed_run": """
WITH dated AS (
  SELECT *, TIMESTAMP '2024-01-01 12:00:00' + to_days(CAST(p_partkey % 140 AS INTEGER)) AS changed
  FROM part WHERE p_size % 3 IN (0, 1) AND p_size <> 7
), found AS (
  SELECT *, CASE WHEN changed >= TIMESTAMP '2024-01-30 23:45:00' AND changed < TIMESTAMP '2024-03-01' THEN TIMESTAMP '2024-03-01'
                 WHEN changed >= TIMESTAMP '2024-02-29 23:45:00' AND changed < TIMESTAMP '2024-04-01' THEN TIMESTAMP '2024-04-01'
                 WHEN changed >= TIMESTAMP '2024-04-21' AND changed < TIMESTAMP '2024-05-01' THEN TIMESTAMP '2024-05-01' END AS run
  FROM dated)
SELECT p_partkey AS ean, p_name AS title, p_size AS size, p_retailprice AS price, run AS add_dtime, run AS upd_dtime
FROM found WHERE run IS NOT NULL""",
    "stream_archived": f"""
SELECT p_partkey AS ean, CASE WHEN p_size = 7 THEN {_ENVELOPE} ELSE {_PAYLOAD} END AS data
FROM part WHERE p_size % 3 IN (0, 1)""",
}

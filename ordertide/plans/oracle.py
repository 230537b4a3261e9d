"""The registered queries in DuckDB's SQL, written against the given tables.

Each statement works from the source rows: where the engine decodes message text, the
SQL states what the message's row must lead to.
"""

from __future__ import annotations

from ordertide.plans.views import (
    DIM_CUSTOMER_SQL, DUP_EVENTS_SQL, EXPECTED_SQL, INGEST_LOG_SQL, MID_FAULTS_SQL, MID_POSITIONS_SQL,
    ORDER_WRITES_SQL, SENT_AGAIN_SQL, SRC_EVENTS_SQL,
)

_MINUTE = "date_trunc('minute', event_time) + INTERVAL 8 HOUR"

_AGG = f"""agg AS (
  SELECT {_MINUTE} AS window_start, biz_type, customer_id,
         count(*) AS order_cnt, CAST(coalesce(sum(amount), 0) AS DECIMAL(18,4)) AS amount_sum
  FROM src_events GROUP BY ALL)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_STEPS = """steps AS (
  SELECT date_trunc('minute', arrival_ts) AS step, count(*) AS received,
         count(*) FILTER (outcome = 'failed') AS failed
  FROM ingest_log GROUP BY 1),
ratios AS (
  SELECT step - to_minutes(CAST(k AS INTEGER)) AS window_start,
         CAST(sum(received) AS BIGINT) AS received, CAST(sum(failed) AS BIGINT) AS failed
  FROM steps, range(5) AS r(k) GROUP BY 1),
rated AS (
  SELECT window_start, received, failed, failed / received AS ratio,
         CAST(failed / received > 0.01 AS INTEGER) AS breach
  FROM ratios)"""

# The rule itself: an id is claimed by its first arrival, and again by the first more than seven days on.
_CLAIMS = "WITH RECURSIVE " + EXPECTED_SQL + """,
chain AS (
  SELECT event_id, min(arrival_ts) AS claimed_at FROM good GROUP BY event_id
  UNION ALL
  SELECT good.event_id, min(arrival_ts) FROM chain JOIN good
    ON good.event_id = chain.event_id AND arrival_ts > claimed_at + INTERVAL 7 DAY
  GROUP BY good.event_id),
claims AS (
  SELECT good.* FROM good JOIN chain ON good.event_id = chain.event_id AND arrival_ts = claimed_at
  QUALIFY row_number() OVER (PARTITION BY good.event_id, arrival_ts ORDER BY "partition", "offset") = 1)"""


def statements() -> dict[str, str]:
    return {
        "dim_scan": _with(DIM_CUSTOMER_SQL) + "SELECT * FROM dim_customer",

        "parse_raw_events": _with(EXPECTED_SQL) + """
SELECT "partition", "offset", event_id, biz_type, biz_key, customer_id,
       CAST(amount AS DOUBLE) AS amount, event_time
FROM good""",

        "parse_mid_events": _with(MID_FAULTS_SQL) + """
SELECT event_id, biz_type, biz_key, CAST(customer_id AS VARCHAR) AS customer_id,
       CAST(amount AS DOUBLE) AS amount, event_time
FROM mid_expected""",

        "synthetic_events": """WITH drawn AS (
  SELECT event_id AS seq, sha256('42/' || event_id) AS h FROM events),
parts AS (
  SELECT seq, h,
         (CAST('0x' || substr(h, 1, 8) AS BIGINT) * 100) >> 32 AS kind,
         ((CAST('0x' || substr(h, 9, 8) AS BIGINT) * 9989901) >> 32) + 10000 AS units,
         ((CAST('0x' || substr(h, 17, 8) AS BIGINT) * 50) >> 32) + 1 AS customer_id,
         (CAST('0x' || substr(h, 25, 8) AS BIGINT) * 100) >> 32 AS dup
  FROM drawn)
SELECT printf('evt-%010d', seq) AS event_id,
       CASE WHEN kind >= 95 THEN 'REFUND' ELSE 'ORDER' END AS biz_type,
       printf('order-%010d', seq) AS biz_key,
       customer_id,
       CAST(CAST(CASE WHEN kind >= 95 THEN -units ELSE units END AS DECIMAL(18,4)) / 10000 AS DOUBLE) AS amount,
       TIMESTAMP '2024-01-01 08:00:00' + to_seconds(seq // 200) AS event_time,
       'trace-' || substr(h, 33, 16) AS trace_id,
       CAST(copy_no AS INTEGER) AS copy_no
FROM parts, range(1, 3) AS c(copy_no)
WHERE copy_no = 1 OR dup < 5""",

        "order_fact_first_write": _with(ORDER_WRITES_SQL) + """
SELECT order_id, customer_id, biz_type, CAST(amount AS DOUBLE) AS amount, written_at, line_no
FROM order_writes
WHERE order_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY written_at, line_no, amount) = 1""",

        "dedup_claim": _with(DUP_EVENTS_SQL) + """
SELECT event_id, biz_type, customer_id, CAST(amount AS DOUBLE) AS amount, copy_no
FROM dup_events
WHERE event_id NOT IN (SELECT event_id FROM src_events WHERE biz_type = 'signup')
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY "partition", "offset") = 1""",

        "mid_wire_json": _with(EXPECTED_SQL) + """
SELECT biz_key AS key,
       '{"event_id":"' || event_id || '","biz_type":"' || biz_type || '","biz_key":"' || biz_key
       || '","customer_id":' || customer_id
       || coalesce(',"amount":"' || CAST(amount AS VARCHAR) || '"', '')
       || ',"event_time":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%gZ') || '"}' AS value
FROM good""",

        "upsert_latest_wins": """WITH versions AS (
  SELECT o_custkey AS customer_id, o_orderstatus AS biz_type,
         year(o_orderdate) * 12 + month(o_orderdate) AS batch_id,
         count(*) AS order_cnt, sum(CAST(o_totalprice AS DECIMAL(18,4))) AS amount_sum
  FROM orders GROUP BY ALL)
SELECT customer_id, biz_type, order_cnt, CAST(amount_sum AS DOUBLE) AS amount_sum
FROM versions
QUALIFY row_number() OVER (PARTITION BY customer_id, biz_type ORDER BY batch_id DESC) = 1""",

        "fan_out_counts": _with(EXPECTED_SQL) + """
SELECT 'events' AS table_name, count(*) AS row_cnt FROM good
UNION ALL SELECT 'mid', count(*) FROM good
UNION ALL SELECT 'rejects', count(*) FROM expected WHERE reject_reason IS NOT NULL""",

        "dim_seed_defaults": _with(DIM_CUSTOMER_SQL) + """
SELECT customer_id, name,
       CASE WHEN level = 'MACHINERY' THEN 'NORMAL' ELSE level END AS level,
       CASE WHEN region = 'ASIA' THEN 'CN-UNKNOWN' ELSE region END AS region
FROM dim_customer
WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = customer_id)""",

        "ledger_expire": _with(SRC_EVENTS_SQL) + """
SELECT event_id, arrival_ts AS created_at FROM src_events
WHERE arrival_ts >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 7 DAY""",

        "rejects_by_reason": _with(EXPECTED_SQL) + """
SELECT reject_reason, count(*) AS row_cnt, CAST(sum("offset") AS BIGINT) AS offset_sum
FROM expected WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",

        "reject_texts": _with(EXPECTED_SQL) + """
SELECT "offset", 'malformed' AS reject_reason, left(t, 256) AS value_head, CAST(length(t) AS BIGINT) AS value_length, sha256(t) AS value_sha256
FROM (SELECT "offset", '{bad' || repeat('x', CAST(300 + "offset" % 100 AS INTEGER)) AS t FROM src_events WHERE k = 0)""",

        "mid_balance": _with(MID_FAULTS_SQL) + """,
checked AS (
  SELECT concat_ws(',', CASE WHEN event_time IS NULL THEN 'event_time' END, CASE WHEN biz_type IS NULL THEN 'biz_type' END,
                   CASE WHEN customer_id IS NULL THEN 'customer_id' END) AS missing FROM mid_expected)
SELECT count(*) AS read_cnt, count(*) FILTER (missing = '') AS stored_cnt, count(*) FILTER (missing <> '') AS aside_cnt,
       count(*) FILTER (missing = 'event_time') AS no_time_cnt, CAST(0 AS BIGINT) AS difference
FROM checked""",

        "order_projection": _with(EXPECTED_SQL) + """
SELECT order_id, customer_id, biz_type, CAST(coalesce(amount, 0) AS DOUBLE) AS amount, 'NEW' AS status,
       event_time + INTERVAL 8 HOUR AS created_at, arrival_ts + INTERVAL 8 HOUR AS updated_at
FROM good""",

        "order_id_from_biz_key": _with(EXPECTED_SQL) + """
SELECT "offset",
       CASE k WHEN 13 THEN 'order-x' WHEN 14 THEN NULL WHEN 15 THEN 'order-'
              WHEN 38 THEN 'order-99999999999999999999' ELSE e.biz_key END AS biz_key,
       CASE WHEN reject_reason IS NULL THEN CAST(order_id AS VARCHAR) END AS order_id
FROM expected e JOIN (SELECT event_no, k FROM src_events) s USING (event_no)
WHERE reject_reason IS NULL OR reject_reason = 'bad_biz_key'""",

        "agg_null_policy": _with(MID_FAULTS_SQL) + f"""
SELECT {_MINUTE} AS window_start, biz_type, customer_id, count(*) AS order_cnt,
       CAST(CAST(coalesce(sum(amount), 0) AS DECIMAL(18,4)) AS DOUBLE) AS amount_sum
FROM mid_expected
WHERE biz_type IS NOT NULL AND customer_id IS NOT NULL AND event_time IS NOT NULL
GROUP BY ALL""",

        "enriched_events": _with(SRC_EVENTS_SQL, DIM_CUSTOMER_SQL) + """
SELECT customer_id, event_id, biz_type, CAST(amount AS DOUBLE) AS amount, event_time,
       level AS customer_level, region AS customer_region
FROM src_events LEFT JOIN dim_customer USING (customer_id)""",

        "lookup_miss_count": _with(SRC_EVENTS_SQL, DIM_CUSTOMER_SQL) + """
SELECT count(*) AS event_cnt, count(*) FILTER (name IS NULL) AS miss_cnt
FROM src_events LEFT JOIN dim_customer USING (customer_id)""",

        "orphan_customers": _with(SRC_EVENTS_SQL, DIM_CUSTOMER_SQL) + """
SELECT customer_id, count(*) AS event_cnt FROM src_events s
WHERE NOT EXISTS (SELECT 1 FROM dim_customer d WHERE d.customer_id = s.customer_id)
GROUP BY customer_id""",

        "agg_order_1min": _with(SRC_EVENTS_SQL, _AGG) + """
SELECT window_start, biz_type, customer_id, order_cnt, CAST(amount_sum AS DOUBLE) AS amount_sum FROM agg""",

        "agg_order_daily": _with(SRC_EVENTS_SQL, _AGG) + """
SELECT strftime(window_start, '%Y-%m-%d') AS stat_date, biz_type,
       CAST(sum(order_cnt) AS BIGINT) AS order_cnt, CAST(sum(amount_sum) AS DOUBLE) AS amount_sum
FROM agg GROUP BY 1, 2""",

        "recent_minutes_rollup": _with(SRC_EVENTS_SQL, _AGG) + """
SELECT window_start, biz_type,
       CAST(sum(order_cnt) AS BIGINT) AS order_cnt, CAST(sum(amount_sum) AS DOUBLE) AS amount_sum
FROM agg
WHERE window_start >= TIMESTAMP '2024-01-31 08:00:00' - INTERVAL 1440 MINUTE
GROUP BY 1, 2 ORDER BY window_start DESC, biz_type LIMIT 20""",

        "customers_by_level": _with(DIM_CUSTOMER_SQL) + """
SELECT level, count(*) AS row_cnt FROM dim_customer GROUP BY level""",

        "table_counts": """SELECT 'customer' AS table_name, count(*) AS row_cnt FROM customer
UNION ALL SELECT 'events', count(*) FROM events
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders""",

        "agg_key_uniqueness": _with(SRC_EVENTS_SQL) + """
SELECT count(*) AS row_cnt,
       count(DISTINCT (date_trunc('minute', event_time), biz_type, customer_id)) AS key_cnt
FROM src_events""",

        "agg_by_level_region": _with(SRC_EVENTS_SQL, DIM_CUSTOMER_SQL) + f"""
SELECT {_MINUTE} AS window_start, biz_type, level AS customer_level, region AS customer_region,
       count(*) AS order_cnt, CAST(sum(amount) AS DOUBLE) AS amount_sum
FROM src_events LEFT JOIN dim_customer USING (customer_id)
GROUP BY ALL""",

        "latest_agg_rows": _with(SRC_EVENTS_SQL, _AGG) + """
SELECT window_start, biz_type, customer_id, order_cnt, CAST(amount_sum AS DOUBLE) AS amount_sum
FROM agg ORDER BY window_start DESC, biz_type, customer_id LIMIT 10""",

        "ingest_throughput": _with(INGEST_LOG_SQL) + """
SELECT date_trunc('minute', arrival_ts) AS minute, count(*) AS received,
       count(*) FILTER (outcome = 'persisted') AS persisted,
       count(*) FILTER (outcome = 'duplicate') AS duplicate,
       count(*) FILTER (outcome = 'parse_error') AS parse_error,
       count(*) / 60.0 AS received_per_sec
FROM ingest_log GROUP BY 1""",

        "latency_p95": _with(INGEST_LOG_SQL) + """
SELECT date_trunc('minute', arrival_ts) AS minute, count(*) AS samples,
       round(quantile_cont(proc_ms, 0.95), 6) AS p95_ms
FROM ingest_log GROUP BY 1""",

        "failure_ratio_5m": _with(INGEST_LOG_SQL, _STEPS) + """
SELECT window_start, received, failed, round(ratio, 9) AS ratio, breach FROM rated""",

        "sustained_threshold": _with(INGEST_LOG_SQL, _STEPS) + """,
hits AS (
  SELECT window_start,
         window_start - to_minutes(CAST(row_number() OVER (ORDER BY window_start) AS INTEGER)) AS island
  FROM rated WHERE breach = 1)
SELECT min(window_start) AS run_start, max(window_start) AS run_end, count(*) AS buckets
FROM hits GROUP BY island HAVING count(*) >= 5""",

        "stream_alarms": _with(INGEST_LOG_SQL, _STEPS) + """,
hits AS (
  SELECT window_start,
         window_start - to_minutes(CAST(row_number() OVER (ORDER BY window_start) AS INTEGER)) AS island
  FROM rated WHERE breach = 1)
SELECT min(window_start) AS run_start, max(window_start) AS run_end, count(*) AS buckets
FROM hits GROUP BY island HAVING count(*) >= 5""",

        "outcome_balance": _with(INGEST_LOG_SQL) + """
SELECT count(*) AS received,
       count(*) FILTER (outcome = 'parse_error') AS parse_error,
       count(*) FILTER (outcome = 'duplicate') AS duplicate,
       count(*) FILTER (outcome = 'persisted') AS persisted,
       count(*) FILTER (outcome = 'failed') AS failed,
       CAST(0 AS BIGINT) AS difference
FROM ingest_log""",

        "reconcile_detail_vs_agg": _with(SRC_EVENTS_SQL, _AGG) + f""",
stored AS (
  SELECT {_MINUTE} AS window_start, biz_type, customer_id, count(*) AS order_cnt, sum(amount) AS amount_sum
  FROM src_events WHERE amount > -100 GROUP BY ALL)
SELECT window_start, biz_type, customer_id,
       coalesce(agg.order_cnt, 0) AS expected_cnt, coalesce(stored.order_cnt, 0) AS actual_cnt,
       CAST(coalesce(agg.amount_sum, 0) AS DOUBLE) AS expected_sum,
       CAST(coalesce(stored.amount_sum, 0) AS DOUBLE) AS actual_sum
FROM agg FULL JOIN stored USING (window_start, biz_type, customer_id)
WHERE coalesce(agg.order_cnt, 0) <> coalesce(stored.order_cnt, 0)
   OR coalesce(agg.amount_sum, 0) <> coalesce(stored.amount_sum, 0)""",

        "reconcile_digests": _with(SRC_EVENTS_SQL, _AGG) + f""",
stored AS (
  SELECT {_MINUTE} AS window_start, biz_type, customer_id, count(*) AS order_cnt, sum(amount) AS amount_sum
  FROM src_events WHERE amount > -100 GROUP BY ALL)
SELECT window_start, biz_type, customer_id,
       coalesce(agg.order_cnt, 0) AS expected_cnt, coalesce(stored.order_cnt, 0) AS actual_cnt,
       CAST(coalesce(agg.amount_sum, 0) AS DOUBLE) AS expected_sum,
       CAST(coalesce(stored.amount_sum, 0) AS DOUBLE) AS actual_sum
FROM agg FULL JOIN stored USING (window_start, biz_type, customer_id)
WHERE coalesce(agg.order_cnt, 0) <> coalesce(stored.order_cnt, 0)
   OR coalesce(agg.amount_sum, 0) <> coalesce(stored.amount_sum, 0)""",

        "stream_agg_1min": _with(SRC_EVENTS_SQL, _AGG) + """
SELECT window_start, biz_type, customer_id, order_cnt, CAST(amount_sum AS DOUBLE) AS amount_sum FROM agg""",

        "restart_agg_no_dup": _with(SRC_EVENTS_SQL, _AGG) + """
SELECT window_start, biz_type, customer_id, order_cnt, CAST(amount_sum AS DOUBLE) AS amount_sum FROM agg""",

        "stream_agg_mid_twice": _with(SRC_EVENTS_SQL, _AGG) + """
SELECT window_start, biz_type, customer_id, order_cnt, CAST(amount_sum AS DOUBLE) AS amount_sum FROM agg""",

        "stream_dedup": _with(DUP_EVENTS_SQL) + """
SELECT biz_type, count(DISTINCT event_id) AS kept_cnt FROM dup_events GROUP BY biz_type""",

        "restart_no_dup": _CLAIMS + """
SELECT event_id, biz_type, biz_key, customer_id, CAST(amount AS DOUBLE) AS amount FROM claims""",

        "restart_mid_follow": _with(SRC_EVENTS_SQL, _AGG) + """
SELECT window_start, biz_type, customer_id, order_cnt, CAST(amount_sum AS DOUBLE) AS amount_sum FROM agg""",

        "stream_order_facts": _CLAIMS + """
SELECT order_id, customer_id, biz_type, CAST(coalesce(amount, 0) AS DOUBLE) AS amount, 'NEW' AS status,
       event_time + INTERVAL 8 HOUR AS created_at
FROM claims QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY arrival_ts, "partition", "offset") = 1""",

        "stream_dedup_late_partition": "WITH RECURSIVE " + SENT_AGAIN_SQL + """,
chain AS (
  SELECT event_id, min(arrival_ts) AS claimed_at FROM sent_again GROUP BY event_id
  UNION ALL
  SELECT s.event_id, min(arrival_ts) FROM chain JOIN sent_again s
    ON s.event_id = chain.event_id AND arrival_ts > claimed_at + INTERVAL 7 DAY
  GROUP BY s.event_id)
SELECT biz_type, "partition", count(*) AS kept_cnt, CAST(sum("offset") AS BIGINT) AS offset_sum
FROM sent_again s JOIN chain ON s.event_id = chain.event_id AND arrival_ts = claimed_at
GROUP BY biz_type, "partition\"""",

        "stream_daily": _with(SRC_EVENTS_SQL, _AGG) + """
SELECT strftime(window_start, '%Y-%m-%d') AS stat_date, biz_type,
       CAST(sum(order_cnt) AS BIGINT) AS order_cnt, CAST(sum(amount_sum) AS DOUBLE) AS amount_sum
FROM agg GROUP BY 1, 2""",

        "stream_enriched": _with(SRC_EVENTS_SQL, DIM_CUSTOMER_SQL) + """
SELECT customer_id, event_id, biz_type, CAST(amount AS DOUBLE) AS amount,
       date_trunc('millisecond', event_time) AS event_time,
       level AS customer_level, region AS customer_region
FROM src_events LEFT JOIN dim_customer USING (customer_id)""",

        "stream_late_rows": _with(SRC_EVENTS_SQL, """ends AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events),
cuts AS (
  SELECT lo + to_microseconds(CAST(round(epoch_us(hi) - epoch_us(lo)) / 3 AS BIGINT)) AS first_cut,
         lo + to_microseconds(CAST(round((epoch_us(hi) - epoch_us(lo)) * 2) / 3 AS BIGINT)) AS last_cut,
         hi - INTERVAL 15 DAY AS watermark
  FROM ends),
counted AS (
  SELECT src_events.* FROM src_events, cuts
  WHERE event_time < first_cut OR event_time >= last_cut
     OR date_trunc('minute', event_time) + INTERVAL 1 MINUTE > watermark)""") + f"""
SELECT strftime({_MINUTE}, '%Y-%m-%d') AS stat_date, biz_type,
       count(*) AS order_cnt, CAST(CAST(coalesce(sum(amount), 0) AS DECIMAL(18,4)) AS DOUBLE) AS amount_sum
FROM counted GROUP BY 1, 2""",

        "job_minutes": _CLAIMS + f"""
SELECT {_MINUTE} AS window_start, biz_type, customer_id, count(*) AS order_cnt,
       CAST(CAST(coalesce(sum(amount), 0) AS DECIMAL(18,4)) AS DOUBLE) AS amount_sum
FROM claims GROUP BY ALL""",

        "step_p95": _with(INGEST_LOG_SQL) + """
SELECT outcome AS step, count(*) AS samples, round(quantile_cont(proc_ms, 0.95), 6) AS p95_ms FROM ingest_log GROUP BY 1""",

        "order_violations": _with(MID_POSITIONS_SQL) + """
SELECT * FROM (
  SELECT key, "partition", "offset", event_time,
         lag("offset") OVER w AS after_offset, lag(event_time) OVER w AS after_event_time
  FROM mid_positions WINDOW w AS (PARTITION BY key, "partition" ORDER BY "offset"))
WHERE event_time < after_event_time""",

        "replay_no_growth": _CLAIMS + """,
sizes AS (
  SELECT 'ledger' AS table_name, count(*) AS n FROM claims
  UNION ALL SELECT 'mid', count(*) FROM claims
  UNION ALL SELECT 'orders', count(DISTINCT order_id) FROM claims)
SELECT table_name, n AS before_cnt, n AS after_cnt, CAST(0 AS BIGINT) AS grown_by FROM sizes""",
    }

"""DuckDB oracle SQL for every registered query (the correctness gate).

Each string runs on the driver's tables (views ``orders``, ``lineitem``,
``events``, ``documents``, ``pages`` ...).  Fixtures are rebuilt here in plain
SQL: windows over the whole key are fine for a single-node oracle.
"""

from __future__ import annotations

from utxoflow.plans.queries import COIN_TARGET, DUST_TARGET, EXTRA_PATTERNS
from utxoflow.operators.reaimed import SUSPICIOUS_PATTERNS

# --------------------------------------------------------------- FX-A

FXA = """
fxa_o AS (
  SELECT o_orderkey AS okey, o_custkey, o_totalprice, epoch_us(o_orderdate) // 1000 AS ts,
         lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY epoch_us(o_orderdate) // 1000, o_orderkey) AS prev_key
  FROM orders),
fxa_out AS (
  SELECT l_orderkey AS okey, 's' || CAST(l_suppkey AS VARCHAR) AS address,
         CAST(l_extendedprice AS DECIMAL(18,8)) AS value,
         CAST(row_number() OVER (PARTITION BY l_orderkey
              ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS INTEGER) AS output_index
  FROM lineitem),
fxa_in AS (
  SELECT okey, 'c' || CAST(o_custkey AS VARCHAR) AS address, CAST(o_totalprice AS DECIMAL(18,8)) AS value,
         'o' || CAST(prev_key AS VARCHAR) AS prev_tx_id, CAST(0 AS INTEGER) AS prev_output_index
  FROM fxa_o WHERE prev_key IS NOT NULL),
fxa_oagg AS (
  SELECT okey, count(*) AS n_out, sum(value) AS tot_out, arg_min(address, output_index) AS first_out,
         to_json(list({'address': address, 'value': CAST(value AS DOUBLE), 'output_index': output_index}
                      ORDER BY output_index))::VARCHAR AS outputs_json
  FROM fxa_out GROUP BY okey),
fxa_iagg AS (
  SELECT okey, count(*) AS n_in, sum(value) AS tot_in, min(address) AS first_in,
         to_json(list({'address': address, 'value': CAST(value AS DOUBLE), 'prev_tx_id': prev_tx_id,
                       'prev_output_index': prev_output_index}))::VARCHAR AS inputs_json
  FROM fxa_in GROUP BY okey),
fxa_tx AS (
  SELECT 'o' || CAST(t.okey AS VARCHAR) AS tx_id, t.okey, t.ts AS timestamp, 'orders' AS source,
         t.ts AS ingest_time,
         CAST(coalesce(i.n_in, 0) AS INTEGER) AS input_count, CAST(coalesce(o.n_out, 0) AS INTEGER) AS output_count,
         coalesce(i.tot_in, 0) AS total_input, coalesce(o.tot_out, 0) AS total_output,
         coalesce(i.inputs_json, '[]')::VARCHAR AS inputs_json, coalesce(o.outputs_json, '[]')::VARCHAR AS outputs_json,
         i.first_in, o.first_out,
         max(t.ts) OVER (ORDER BY t.ts, t.okey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 30000 AS watermark_ms
  FROM fxa_o t LEFT JOIN fxa_iagg i ON i.okey = t.okey LEFT JOIN fxa_oagg o ON o.okey = t.okey)
"""

# --------------------------------------------------------------- FX-B


def fxb(variant: str | None = None, tol: int = 86_400_000) -> str:
    has_out = "(event_id % 50 <> 7)" if variant == "orphan" else "TRUE"
    address = "'u' || CAST(user_id AS VARCHAR)"
    if variant in ("hot", "burst"):
        address = f"CASE WHEN event_id % 3 = 0 THEN 'u0' ELSE {address} END"
    value = "CAST(value AS DECIMAL(18,8))"
    if variant == "large":
        value = f"CAST({value} * 10000000 AS DECIMAL(28,8))"
    arrival, seq = {"ties": ("arrival_ms - arrival_ms % 86400000 AS arrival_ms", "seq // 2 AS seq"),
                    "burst": ("arrival_ms - arrival_ms % 2592000000 AS arrival_ms", "seq")}.get(variant, ("arrival_ms", "seq"))
    repeat = ""
    if variant in ("double", "ties"):
        repeat = """
  UNION ALL
  SELECT tx_id || 'r', timestamp, arrival_ms + 3600000, seq, address, value, has_in, prev_tx_id, FALSE
  FROM fxb_b0 WHERE seq % 40 = 3 AND has_in"""
    return f"""
fxb_ev AS (
  SELECT event_id, event_type, value, {address} AS address,
         epoch_us(ts) // 1000 AS tms
  FROM events),
fxb_ev2 AS (
  SELECT *, lag(event_id) OVER (PARTITION BY address ORDER BY tms, event_id) AS prev_id,
         tms + (event_id * 7919) % 86400000 + CASE WHEN event_id % 10 = 0 THEN 400000000 ELSE 0 END AS arr
  FROM fxb_ev),
fxb_b0 AS (
  SELECT CAST(event_id AS VARCHAR) AS tx_id, tms AS timestamp, arr AS arrival_ms, event_id AS seq, address,
         {value} AS value,
         (event_type IN ('purchase', 'click') AND prev_id IS NOT NULL) AS has_in,
         CAST(prev_id AS VARCHAR) AS prev_tx_id, {has_out} AS has_out, event_type
  FROM fxb_ev2),
fxb_b1 AS (
  SELECT tx_id, timestamp, arrival_ms, seq, address, value, has_in, prev_tx_id, has_out FROM fxb_b0{repeat}),
fxb_b AS (
  SELECT tx_id, timestamp, {arrival}, {seq}, address, value, has_in, prev_tx_id, has_out FROM fxb_b1),
fxb_tx AS (
  SELECT *, 'events' AS source, arrival_ms AS ingest_time,
         max(timestamp) OVER (ORDER BY arrival_ms, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {tol}
           AS watermark_ms,
         CAST(CASE WHEN has_in THEN 1 ELSE 0 END AS INTEGER) AS input_count,
         CAST(CASE WHEN has_out THEN 1 ELSE 0 END AS INTEGER) AS output_count,
         CASE WHEN has_in THEN value ELSE 0 END AS total_input,
         CASE WHEN has_out THEN value ELSE 0 END AS total_output
  FROM fxb_b),
fxb_upd AS (
  SELECT address, tx_id, timestamp, 'input' AS kind, CAST(0 AS INTEGER) AS pos, value, prev_tx_id,
         CAST(0 AS INTEGER) AS prev_output_index, CAST(NULL AS INTEGER) AS output_index, source, watermark_ms,
         arrival_ms, seq, prev_tx_id AS ref_tx, 0 AS ref_idx
  FROM fxb_tx WHERE has_in
  UNION ALL
  SELECT address, tx_id, timestamp, 'output', CAST(CASE WHEN has_in THEN 1 ELSE 0 END AS INTEGER), value,
         CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER), CAST(0 AS INTEGER), source, watermark_ms,
         arrival_ms, seq, tx_id, 0
  FROM fxb_tx WHERE has_out),
fxb_rk AS (
  SELECT *, row_number() OVER (PARTITION BY address ORDER BY arrival_ms, seq, tx_id, pos) AS rk FROM fxb_upd),
fxb_d AS (
  SELECT *,
    min(CASE WHEN kind = 'input' THEN rk END) OVER k AS first_in,
    max(CASE WHEN kind = 'input' THEN rk END) OVER k AS last_in,
    count(CASE WHEN kind = 'input' THEN 1 END) OVER k AS n_in,
    min(CASE WHEN kind = 'output' THEN rk END) OVER k AS out_rk,
    max(CASE WHEN kind = 'output' THEN value END) OVER k AS out_val
  FROM fxb_rk WINDOW k AS (PARTITION BY address, ref_tx, ref_idx)),
fxb_d2 AS (
  SELECT *,
    CASE WHEN kind = 'output' AND (first_in IS NULL OR first_in > rk) THEN 1
         WHEN kind = 'input' AND rk = first_in AND out_rk < rk THEN -1 ELSE 0 END AS d_cnt,
    CASE WHEN kind = 'output' AND (first_in IS NULL OR first_in > rk) THEN value
         WHEN kind = 'input' AND rk = first_in AND out_rk < rk THEN -out_val ELSE 0 END AS d_bal
  FROM fxb_d),
fxb_led AS (
  SELECT *, sum(d_bal) OVER w AS balance, CAST(sum(d_cnt) OVER w AS BIGINT) AS utxo_count,
         max(timestamp) OVER w AS max_ts
  FROM fxb_d2 WINDOW w AS (PARTITION BY address ORDER BY rk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
fxb_act AS (
  SELECT i.address, i.tx_id, i.timestamp, i.rk,
    count(*) FILTER (WHERE i.timestamp - j.timestamp <= 172800000) AS velocity_count,
    count(*) FILTER (WHERE j.kind = 'output' AND j.value <= 20 AND i.timestamp - j.timestamp <= 345600000)
      AS structuring_count
  FROM fxb_led i JOIN fxb_led j
    ON i.address = j.address AND j.rk <= i.rk AND j.max_ts >= i.max_ts - 345600000
  GROUP BY i.address, i.tx_id, i.timestamp, i.rk),
fxb_bal AS (
  SELECT address, timestamp AS timestamp_ms, source, CAST(balance AS DOUBLE) AS balance, utxo_count,
         arrival_ms, seq, pos, rk
  FROM fxb_led),
fxb_alert_velocity AS (
  SELECT tx_id || ':' || address || ':velocity' AS alert_id, 'velocity_spike' AS alert_type,
         'medium' AS severity, timestamp AS timestamp_ms, tx_id, address,
         to_json({{'events_in_window': velocity_count, 'window_ms': CAST(172800000 AS BIGINT)}})::VARCHAR AS details_json
  FROM fxb_act WHERE velocity_count >= 10),
fxb_alert_structuring AS (
  SELECT tx_id || ':' || address || ':structuring' AS alert_id, 'structuring' AS alert_type, 'high' AS severity,
         timestamp AS timestamp_ms, tx_id, address,
         to_json({{'events_in_window': structuring_count, 'window_ms': CAST(345600000 AS BIGINT),
                  'ceiling': CAST(20.0 AS DOUBLE)}})::VARCHAR AS details_json
  FROM fxb_act WHERE structuring_count >= 6),
fxb_alert_late AS (
  SELECT tx_id || ':' || address || ':late' AS alert_id, 'late_event' AS alert_type, 'low' AS severity,
         timestamp AS timestamp_ms, tx_id, address,
         to_json({{'watermark': watermark_ms, 'lateness_ms': watermark_ms - timestamp}})::VARCHAR AS details_json
  FROM fxb_upd WHERE timestamp < watermark_ms),
fxb_alert_whale AS (
  SELECT tx_id || ':whale' AS alert_id, 'whale_transaction' AS alert_type, 'high' AS severity,
         timestamp AS timestamp_ms, tx_id, CASE WHEN has_out THEN address ELSE 'unknown' END AS address,
         to_json({{'total_output': CAST(total_output AS DOUBLE)}})::VARCHAR AS details_json
  FROM fxb_tx WHERE total_output >= 450),
fxb_alerts AS (
  SELECT * FROM fxb_alert_whale UNION ALL SELECT * FROM fxb_alert_velocity
  UNION ALL SELECT * FROM fxb_alert_structuring UNION ALL SELECT * FROM fxb_alert_late),
fxb_latest_t AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY address
                   ORDER BY timestamp_ms DESC, arrival_ms DESC, seq DESC, pos DESC) AS r FROM fxb_bal) WHERE r = 1),
fxb_cnt AS (SELECT address, count(*) AS updates FROM fxb_bal GROUP BY address),
fxb_metrics AS (
  SELECT 'transaction' AS metric_type, tx_id, timestamp, ingest_time, source, input_count, output_count,
         CAST(total_input AS DOUBLE) AS total_input, CAST(total_output AS DOUBLE) AS total_output,
         CAST(greatest(total_input - total_output, 0) AS DOUBLE) AS fee_estimate,
         coalesce(timestamp < watermark_ms, FALSE) AS is_late
  FROM fxb_tx)
"""


# Delivery batches of the streams: equal time ranges of the arrival; the
# watermark a batch meets is the max event time of the batches before it minus
# the tolerance.
FXB_STREAM = """
fxb_range AS (
  SELECT min(arrival_ms) AS lo, max(arrival_ms) - min(arrival_ms) + 1 AS span,
         greatest(4, (count(*) + 999999) // 1000000) AS k FROM fxb_tx),
fxb_batch AS (
  SELECT t.*, (t.arrival_ms - r.lo) // ((r.span + r.k - 1) // r.k) AS b FROM fxb_tx t, fxb_range r),
fxb_marks AS (
  SELECT b, max(max(timestamp)) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 86400000 AS mark
  FROM fxb_batch GROUP BY b),
fxb_stream_tx AS (SELECT t.*, m.mark FROM fxb_batch t JOIN fxb_marks m USING (b)),
fxb_stream_late AS (
  SELECT u.tx_id || ':' || u.address || ':late' AS alert_id, 'late_event' AS alert_type, 'low' AS severity,
         u.timestamp AS timestamp_ms, u.tx_id, u.address,
         to_json({'watermark': s.mark, 'lateness_ms': s.mark - u.timestamp})::VARCHAR AS details_json
  FROM fxb_upd u JOIN fxb_stream_tx s ON s.tx_id = u.tx_id WHERE u.timestamp < s.mark),
fxb_stream_alerts AS (
  SELECT * FROM fxb_alert_velocity UNION ALL SELECT * FROM fxb_alert_structuring
  UNION ALL SELECT * FROM fxb_stream_late)
"""


FXA_FAN_OUT = """
SELECT tx_id || ':fanout' AS alert_id, 'fan_out' AS alert_type, 'medium' AS severity, timestamp AS timestamp_ms,
       tx_id, coalesce(first_in, 'coinbase') AS address,
       to_json({'output_count': output_count, 'total_output': CAST(total_output AS DOUBLE)})::VARCHAR AS details_json
FROM fxa_tx WHERE output_count >= 8"""
FXA_WHALE = """
SELECT tx_id || ':whale' AS alert_id, 'whale_transaction' AS alert_type, 'high' AS severity,
       timestamp AS timestamp_ms, tx_id, coalesce(first_out, 'unknown') AS address,
       to_json({'total_output': CAST(total_output AS DOUBLE)})::VARCHAR AS details_json
FROM fxa_tx WHERE total_output >= 400000"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip().rstrip(",") for p in parts) + "\n"


FXB = fxb()
ALERT_COLS = "alert_id, alert_type, severity, timestamp_ms, tx_id, address, details_json"


def _sql_list(items: list[str]) -> str:
    return "[" + ", ".join("'" + p.replace("'", "''") + "'" for p in items) + "]"


def oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    q["normalize_transactions"] = _with(FXA) + """
SELECT 'o' || CAST(okey AS VARCHAR) AS tx_id, t.ts AS timestamp, 'orders' AS source, t.ts AS ingest_time,
       'input' AS kind, CAST(0 AS INTEGER) AS pos, i.address, CAST(i.value AS DOUBLE) AS value, i.prev_tx_id,
       i.prev_output_index, CAST(NULL AS INTEGER) AS output_index
FROM fxa_in i JOIN fxa_o t USING (okey)
UNION ALL
SELECT 'o' || CAST(okey AS VARCHAR), t.ts, 'orders', t.ts, 'output',
       CAST(o.output_index + CASE WHEN t.prev_key IS NULL THEN 0 ELSE 1 END AS INTEGER),
       o.address, CAST(o.value AS DOUBLE), NULL, CAST(NULL AS INTEGER), o.output_index
FROM fxa_out o JOIN fxa_o t USING (okey)"""
    q["tx_metrics"] = _with(FXB) + "SELECT * FROM fxb_metrics"
    q["tx_rows"] = _with(FXA) + """
SELECT tx_id, timestamp AS timestamp_ms, ingest_time AS ingest_time_ms, source, input_count, output_count,
       CAST(total_input AS DOUBLE) AS total_input, CAST(total_output AS DOUBLE) AS total_output,
       inputs_json, outputs_json, CAST(coalesce(timestamp < watermark_ms, FALSE) AS INTEGER) AS is_late
FROM fxa_tx"""
    q["address_updates"] = _with(FXB) + """
SELECT address, tx_id, timestamp, kind, pos, CAST(value AS DOUBLE) AS value, prev_tx_id, prev_output_index,
       output_index, source, coalesce(watermark_ms, -1) AS watermark
FROM fxb_upd"""
    q["alerts_fan_out"] = _with(FXA) + FXA_FAN_OUT
    q["alerts_whale"] = _with(FXA) + FXA_WHALE
    q["metrics_table"] = _with(FXB) + """
SELECT metric_type, timestamp AS timestamp_ms, source, tx_id, '' AS address,
       to_json({'metric_type': metric_type, 'tx_id': tx_id, 'timestamp': timestamp, 'ingest_time': ingest_time,
                'source': source, 'input_count': input_count, 'output_count': output_count,
                'total_input': total_input, 'total_output': total_output, 'fee_estimate': fee_estimate,
                'is_late': is_late})::VARCHAR AS payload_json
FROM fxb_metrics"""
    q["utxo_snapshot"] = _with(FXB) + """
SELECT address, tx_id, output_index, CAST(value AS DOUBLE) AS value, timestamp
FROM fxb_d WHERE kind = 'output' AND n_in = 0"""
    pend = """
SELECT DISTINCT address, ref_tx AS prev_tx_id, CAST(ref_idx AS INTEGER) AS prev_output_index
FROM fxb_d
WHERE n_in > 0 AND (out_rk IS NULL OR (first_in < out_rk AND last_in > out_rk)
                    OR (first_in > out_rk AND n_in >= 2))"""
    q["pending_spends"] = _with(fxb("orphan")) + pend
    q["pending_spends_double"] = _with(fxb("double")) + pend
    bal = """
SELECT 'balance_update' AS metric_type, address, tx_id, kind, CAST(balance AS DOUBLE) AS balance, utxo_count,
       timestamp AS timestamp_ms, source
FROM fxb_led"""
    q["balance_updates"] = _with(FXB) + bal
    q["balance_updates_double"] = _with(fxb("double")) + bal
    q["balance_updates_hot"] = _with(fxb("hot")) + bal
    q["alerts_activity_hot"] = _with(fxb("hot")) + """
SELECT * FROM fxb_alert_velocity UNION ALL SELECT * FROM fxb_alert_structuring"""
    q["latest_balance"] = _with(FXB) + """
SELECT address, balance, utxo_count, timestamp_ms, source FROM (
  SELECT *, row_number() OVER (PARTITION BY address ORDER BY rk DESC) AS r FROM fxb_bal) WHERE r = 1"""
    q["alerts_velocity"] = _with(FXB) + f"SELECT {ALERT_COLS} FROM fxb_alert_velocity"
    q["alerts_structuring"] = _with(FXB) + "SELECT * FROM fxb_alert_structuring"
    q["alerts_late"] = _with(FXB) + "SELECT * FROM fxb_alert_late"
    q["alerts_all"] = _with(FXB) + "SELECT * FROM fxb_alerts"
    q["tps_last_minute"] = _with(FXB) + """
SELECT count(*) / CAST(60.0 AS DOUBLE) AS tps FROM fxb_tx
WHERE timestamp >= (SELECT max(timestamp) FROM fxb_tx) - 60000"""
    q["tps_last_day"] = _with(FXB) + """
SELECT count(*) / CAST(86400.0 AS DOUBLE) AS tps FROM fxb_tx
WHERE timestamp >= (SELECT max(timestamp) FROM fxb_tx) - 86400000"""
    q["alerts_last_hour"] = _with(FXB) + """
SELECT count(*) AS alerts_last_hour FROM fxb_alerts
WHERE timestamp_ms >= (SELECT max(timestamp_ms) FROM fxb_alerts) - 3600000"""
    vol = """
SELECT timestamp - timestamp % 60000 AS minute, count(*) AS txs FROM fxb_tx
WHERE timestamp >= (SELECT max(timestamp) FROM fxb_tx) - {span}
GROUP BY 1 ORDER BY 1"""
    q["tx_volume_per_minute"] = _with(FXB) + vol.format(span=3_600_000)
    q["tx_volume_last_day"] = _with(FXB) + vol.format(span=86_400_000)
    q["top_addresses"] = _with(FXB) + """
SELECT address, balance FROM fxb_latest_t ORDER BY balance DESC, address LIMIT 10"""
    q["balance_distribution"] = _with(FXB) + """
SELECT bucket, addresses FROM (
  SELECT CAST(floor(l.balance) AS BIGINT) AS bucket, c.updates AS addresses, l.address
  FROM fxb_latest_t l JOIN fxb_cnt c USING (address))
WHERE bucket >= 0 ORDER BY bucket, address LIMIT 30"""
    q["balance_histogram"] = _with(FXB) + """
SELECT CAST(floor(balance) AS BIGINT) AS bucket, count(*) AS addresses FROM fxb_latest_t
GROUP BY 1 HAVING CAST(floor(balance) AS BIGINT) >= 0 ORDER BY 1 LIMIT 30"""
    rates = """
SELECT timestamp_ms - timestamp_ms % 60000 AS minute, alert_type, count(*) AS total FROM fxb_alerts
WHERE timestamp_ms >= (SELECT max(timestamp_ms) FROM fxb_alerts) - {span}
GROUP BY 1, 2 ORDER BY 1, 2"""
    q["alert_rates"] = _with(FXB) + rates.format(span=3_600_000)
    q["alert_rates_last_day"] = _with(FXB) + rates.format(span=86_400_000)
    q["balance_updates_final"] = _with(FXB) + """
SELECT address, timestamp_ms, source, balance, utxo_count FROM (
  SELECT *, row_number() OVER (PARTITION BY address, timestamp_ms ORDER BY rk DESC) AS r FROM fxb_bal)
WHERE r = 1"""
    q["coin_selection"] = _with(FXB) + f"""
SELECT address, tx_id, output_index, CAST(value AS DOUBLE) AS value, CAST(running AS DOUBLE) AS running,
       CAST({COIN_TARGET} AS DOUBLE) AS target
FROM (
  SELECT *, sum(value) OVER (PARTITION BY address ORDER BY value DESC, tx_id, output_index
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running,
         sum(value) OVER (PARTITION BY address) AS total
  FROM fxb_d WHERE kind = 'output' AND n_in = 0)
WHERE total >= {COIN_TARGET} AND running - value < {COIN_TARGET}"""
    q["pattern_mix"] = """
WITH l AS (SELECT regexp_extract(event_type || '-' || CAST(event_id AS VARCHAR), '^([a-z]+)-', 1) AS label
           FROM events)
SELECT label, count(*) AS txs, count(*) / (SELECT count(*) FROM events) AS share FROM l GROUP BY label"""
    pats = _sql_list(SUSPICIOUS_PATTERNS + EXTRA_PATTERNS)
    q["pattern_scan"] = f"""
SELECT doc_id, p AS pattern FROM documents, unnest({pats}) AS t(p)
WHERE regexp_matches(text, '(?i)' || p)"""
    q["pattern_scan_pages"] = f"""
SELECT page_id AS doc_id, p AS pattern FROM pages, unnest({pats}) AS t(p)
WHERE regexp_matches(html, '(?i)' || p)"""
    q["archive_blocks"] = """
SELECT CAST(page_id % 100 AS VARCHAR) AS height, CAST(page_id % 100 AS VARCHAR) || '.json' AS object_key,
       max(page_id) AS offset,
       CAST(arg_max(length(to_json({'height': page_id % 100, 'page_id': page_id, 'url': url, 'html': html})),
                    page_id) AS INTEGER) AS n_chars
FROM pages WHERE page_id % 7 <> 3 AND page_id % 11 <> 5 GROUP BY 1"""
    q["archive_packed"] = """
SELECT * FROM (""" + q["archive_blocks"] + """) WHERE CAST(height AS INTEGER) BETWEEN 10 AND 89"""
    q["archive_rejected"] = """
SELECT page_id AS offset, CASE WHEN page_id % 11 = 5 THEN 'bad_json' ELSE 'missing_height' END AS reason
FROM pages WHERE page_id % 11 = 5 OR page_id % 7 = 3"""
    q["parse_transactions"] = _with(FXB) + """
SELECT metric_type, tx_id, timestamp, ingest_time, source, input_count, output_count, total_input,
       total_output, fee_estimate, FALSE AS is_late
FROM fxb_metrics WHERE CAST(tx_id AS BIGINT) % 97 <> 0"""
    q["source_blocks"] = _with(FXB) + """
SELECT metric_type, tx_id, timestamp, ingest_time, source, input_count, output_count, total_input,
       total_output, fee_estimate, FALSE AS is_late
FROM fxb_metrics"""
    q["quarantine"] = """
SELECT event_id AS offset, 'malformed_json' AS reason FROM events WHERE event_id % 97 = 0"""
    q["stream_balances"] = q["balance_updates"]
    q["stream_latest_balance"] = q["latest_balance"]
    q["stream_utxo_snapshot"] = q["utxo_snapshot"]
    q["stream_pending_spends"] = q["pending_spends_double"]
    q["stream_alert_rates"] = _with(FXB, FXB_STREAM) + """
SELECT timestamp_ms - timestamp_ms % 60000 AS minute, alert_type, count(*) AS total FROM fxb_stream_alerts
GROUP BY 1, 2"""
    q["stream_tx_alerts"] = _with(FXA) + FXA_FAN_OUT + "\nUNION ALL\n" + FXA_WHALE
    q["stream_alerts"] = _with(FXB, FXB_STREAM) + "SELECT * FROM fxb_stream_alerts"
    q["stream_late_alerts"] = _with(FXB, FXB_STREAM) + "SELECT * FROM fxb_stream_late"
    q["stream_tx_rows"] = _with(FXB, FXB_STREAM) + """
SELECT tx_id, timestamp AS timestamp_ms, ingest_time AS ingest_time_ms, source, input_count, output_count,
       CAST(total_input AS DOUBLE) AS total_input, CAST(total_output AS DOUBLE) AS total_output,
       CAST(coalesce(timestamp < mark, FALSE) AS INTEGER) AS is_late
FROM fxb_stream_tx"""
    q["stream_dedupe_late"] = q["balance_updates"]
    q["balance_updates_large"] = _with(fxb("large")) + bal
    q["balance_updates_ties"] = _with(fxb("ties")) + bal
    q["balance_updates_burst"] = _with(fxb("burst")) + bal
    q["coin_selection_dust"] = _with(fxb("hot")) + f"""
SELECT address, tx_id, output_index, CAST(value AS DOUBLE) AS value, CAST(running AS DOUBLE) AS running,
       CAST({DUST_TARGET} AS DOUBLE) AS target
FROM (
  SELECT address, tx_id, output_index, value, sum(value) OVER (PARTITION BY address ORDER BY value DESC, tx_id, output_index
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running,
         sum(value) OVER (PARTITION BY address) AS total
  FROM (SELECT * REPLACE (value * 0.001 AS value) FROM fxb_d WHERE kind = 'output' AND n_in = 0))
WHERE total >= {DUST_TARGET} AND running - value < {DUST_TARGET}"""
    q["coin_selection_exact"] = _with(FXB) + """
SELECT address, tx_id, output_index, CAST(value AS DOUBLE) AS value, CAST(running AS DOUBLE) AS running, CAST(target AS DOUBLE) AS target
FROM (
  SELECT address, tx_id, output_index, value, sum(value) OVER by_size AS running,
         sum(CASE WHEN r <= 2 THEN value END) OVER (PARTITION BY address) AS target
  FROM (SELECT *, row_number() OVER (PARTITION BY address ORDER BY value DESC, tx_id, output_index) AS r
        FROM (SELECT * REPLACE (value * 0.1 AS value) FROM fxb_d WHERE kind = 'output' AND n_in = 0))
  WINDOW by_size AS (PARTITION BY address ORDER BY value DESC, tx_id, output_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
WHERE running - value < target"""
    q["quarantine_values"] = """
SELECT event_id AS offset, CASE event_id % 13 WHEN 5 THEN 'bad_timestamp' WHEN 4 THEN 'missing_field' ELSE 'bad_value' END AS reason
FROM events WHERE event_id % 13 BETWEEN 1 AND 5"""
    q["job_quarantine"] = """
SELECT CASE WHEN event_id % 13 BETWEEN 1 AND 3 THEN 'bad_value' WHEN event_id % 13 = 4 THEN 'missing_field'
            WHEN event_id % 13 = 5 THEN 'bad_timestamp' ELSE 'accepted' END AS reason, count(*) AS records
FROM events GROUP BY 1"""
    q["stream_balances_hot"] = q["balance_updates_hot"]
    q["stream_balances_split_double"] = q["balance_updates_double"]
    q["stream_pending_split"] = q["pending_spends_double"]
    q["stream_activity_hot"] = q["alerts_activity_hot"]
    q["stream_watermark"] = _with(fxb("hot"), FXB_STREAM) + """
SELECT u.address, u.tx_id, u.kind, s.mark AS watermark_ms FROM fxb_upd u JOIN fxb_stream_tx s ON s.tx_id = u.tx_id"""
    q["topic_replay"] = _with(FXB, FXB_STREAM) + """
SELECT 'metrics' AS topic, address AS record_key, tx_id, kind AS what, CAST(balance AS DOUBLE) AS amount FROM fxb_led
UNION ALL
SELECT 'alerts', alert_id, tx_id, alert_type, CAST(timestamp_ms AS DOUBLE) FROM fxb_stream_alerts"""
    q["table_compacted"] = q["balance_updates"]
    q["latest_balance_as_of"] = _with(FXB, FXB_STREAM) + """
SELECT address, balance, utxo_count, timestamp_ms, source FROM (
  SELECT l.address, CAST(l.balance AS DOUBLE) AS balance, l.utxo_count, l.timestamp AS timestamp_ms, l.source,
         row_number() OVER (PARTITION BY l.address ORDER BY l.rk DESC) AS r
  FROM fxb_led l JOIN fxb_stream_tx s ON s.tx_id = l.tx_id WHERE s.b <= 1) WHERE r = 1"""
    q["table_rerun"] = _with(FXB) + """
SELECT 'transactions' AS name, tx_id AS key, CAST(total_output AS DOUBLE) AS amount FROM fxb_tx
UNION ALL SELECT 'alerts', alert_id, CAST(timestamp_ms AS DOUBLE) FROM fxb_alerts
UNION ALL SELECT 'balance_updates', address, balance FROM fxb_bal
UNION ALL SELECT 'latest_balances', address, balance FROM (
  SELECT *, row_number() OVER (PARTITION BY address ORDER BY rk DESC) AS r FROM fxb_bal) WHERE r = 1
UNION ALL SELECT 'metrics', tx_id, CAST(timestamp AS DOUBLE) FROM fxb_metrics"""
    q["archive_incremental"] = q["archive_blocks"]
    q["stream_tx_volume"] = _with(FXB) + """
SELECT timestamp - timestamp % 60000 AS minute, count(*) AS txs FROM fxb_tx GROUP BY 1"""
    return q

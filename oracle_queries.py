"""Independent SQL for the registered queries, run by DuckDB on the same tables.

None of it shares code with the Spark side: damaged records, for example, are never
parsed here; their outcome follows from how they were damaged.
"""

from __future__ import annotations

# One transaction per row of events.
TX = """
base AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
),
tx AS (
  SELECT
    CAST(1 AS INTEGER) AS schema_version,
    'txn_' || event_id AS transaction_id,
    'acct_' || (1001 + user_id % 20) AS account_id,
    make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 48) AS event_timestamp,
    CAST(value AS DECIMAL(12,2)) AS amount,
    list_extract(['INR','USD','EUR','GBP','SGD','AUD'], event_id % 6 + 1) AS currency,
    'm_' || (k % 10) AS merchant_id,
    list_extract(['ELECTRONICS','GROCERY','RESTAURANT','FUEL','TRAVEL','CLOTHING',
                  'ENTERTAINMENT','HEALTH','JEWELRY','UTILITIES'], k % 10 + 1) AS merchant_category,
    'dev_' || (event_id % 3) AS device_id,
    12.0::DOUBLE + (k % 7) * 0.1::DOUBLE AS latitude,
    77.0::DOUBLE + (event_id % 5) * 0.1::DOUBLE AS longitude,
    list_extract(['IN','US','GB','DE','SG','AU'], event_id % 6 + 1) AS country,
    list_extract(['ECOMMERCE','POS','MOBILE','ATM'], event_id % 4 + 1) AS channel,
    list_extract(['PURCHASE','REFUND','WITHDRAWAL','TRANSFER'], k % 4 + 1) AS transaction_type,
    event_id
  FROM base
)
"""

CONTRACT = """schema_version, transaction_id, account_id, event_timestamp, amount, currency,
  merchant_id, merchant_category, device_id, latitude, longitude, country, channel, transaction_type"""
CONTRACT_PLAIN = CONTRACT.replace("amount,", "CAST(amount AS DOUBLE) AS amount,")

# What survives the wire: instants cut to milliseconds.
MS = f"""
ms AS (
  SELECT * REPLACE (date_trunc('millisecond', event_timestamp) AS event_timestamp) FROM tx
)
"""

# Records that were damaged on purpose, and what becomes of the rest.
OUTCOME = """
outcome AS (
  SELECT *, CASE event_id % 16
      WHEN 0 THEN 'MALFORMED_JSON' WHEN 1 THEN 'INVALID_AMOUNT' WHEN 2 THEN 'INVALID_ENUM'
      WHEN 3 THEN 'UNEXPECTED_FIELD' WHEN 4 THEN 'INVALID_COORDINATES' WHEN 5 THEN 'MISSING_FIELD'
      WHEN 6 THEN 'EMPTY_PAYLOAD' WHEN 7 THEN 'SCHEMA_VALIDATION' WHEN 8 THEN 'MALFORMED_JSON'
      WHEN 9 THEN 'MALFORMED_JSON'
    END AS damage
  FROM ms
),
judged AS (
  SELECT *, CASE
      WHEN damage IN ('MALFORMED_JSON','EMPTY_PAYLOAD','SCHEMA_VALIDATION','MISSING_FIELD') THEN damage
      WHEN amount <= 0 THEN 'INVALID_AMOUNT'
      ELSE damage END AS error_type
  FROM outcome
)
"""

HAVERSINE = """
round(2 * 6371.0::DOUBLE * asin(sqrt(greatest(0.0::DOUBLE, least(1.0::DOUBLE,
  pow(sin(radians({lat2} - {lat1}) / 2), 2)
  + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))), 3)
"""


def windows(source: str, sizes: dict[str, str], name: str = "feat") -> str:
    """CTE with the account features of each window size over ``source``."""
    parts = []
    for label, interval in sizes.items():
        parts.append(f"""
  SELECT account_id,
    time_bucket(INTERVAL '{interval}', event_timestamp, TIMESTAMP '1970-01-01') AS window_start,
    time_bucket(INTERVAL '{interval}', event_timestamp, TIMESTAMP '1970-01-01') + INTERVAL '{interval}' AS window_end,
    '{label}' AS window_size,
    count(*) AS txn_count,
    CAST(sum(amount) AS DOUBLE) AS amount_sum,
    CAST(sum(CAST(amount * 100 AS HUGEINT)) AS HUGEINT) AS s,
    count(amount) AS n,
    CAST(max(amount) AS DOUBLE) AS amount_max,
    CAST(count(DISTINCT merchant_id) AS INTEGER) AS unique_merchants,
    CAST(count(DISTINCT device_id) AS INTEGER) AS unique_devices,
    CAST(count(DISTINCT round(latitude, 3)::VARCHAR || ',' || round(longitude, 3)::VARCHAR) AS INTEGER) AS unique_locations,
    {HAVERSINE.format(lat1="min(latitude)", lat2="max(latitude)", lon1="min(longitude)", lon2="max(longitude)")} AS location_spread_km,
    CAST(sum(CASE WHEN amount >= 110 THEN 1 ELSE 0 END) AS BIGINT) AS high_amount_count
  FROM {source} GROUP BY 1, 2, 3""")
    return f"""
{name}_raw AS ({" UNION ALL ".join(parts)}),
{name} AS (
  SELECT account_id, window_start, window_end, window_size, txn_count, amount_sum,
    -- exact mean: half-up to six digits, then to two (away from zero for negatives)
    CAST(sign(s) * (((2 * abs(s) * 10000 + n) // (2 * n) + 5000) // 10000) AS DOUBLE) / 100 AS amount_avg,
    amount_max, unique_merchants, unique_devices, unique_locations, location_spread_km,
    high_amount_count,
    unique_devices >= 2 AS multi_device_signal,
    txn_count >= 5 AS rapid_transaction_signal,
    unique_locations >= 2 AND location_spread_km >= 25.0 AS rapid_location_change_signal
  FROM {name}_raw
)"""


BOTH = {"5m": "5 minutes", "30m": "30 minutes"}
GOLD = "SELECT *, CAST(window_start AS DATE) AS window_date FROM feat"

CANONICAL = """
'{"schema_version":1,"transaction_id":"' || transaction_id || '","account_id":"' || account_id
 || '","event_timestamp":"' || strftime(date_trunc('millisecond', event_timestamp), '%Y-%m-%dT%H:%M:%S.%g') || 'Z'
 || '"' || {amount} || ',"currency":"' || {currency}
 || '","merchant_id":"' || merchant_id || '","merchant_category":"' || merchant_category
 || '","device_id":"' || device_id || '","latitude":' || {latitude} || ',"longitude":' || longitude::VARCHAR
 || ',"country":"' || country || '","channel":"' || channel
 || '","transaction_type":"' || transaction_type || '"' || {extra} || '}}'
"""


def canonical(amount="amount::VARCHAR", currency="currency", latitude="latitude::VARCHAR", extra="''"):
    quoted = f"""',"amount":"' || {amount} || '"'"""
    return CANONICAL.replace("'{\"schema", "'{{\"schema").format(
        amount=quoted, currency=currency, latitude=latitude, extra=extra
    )


# --- behaviour ----------------------------------------------------------------------

LABELLED = """
lab AS (
  SELECT tx.*, l.toxic = 1 AS is_fraud FROM tx LEFT JOIN labels l ON l.doc_id = tx.event_id
)
"""

PRIOR = "RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL '1 microsecond' PRECEDING"


def last(interval: str) -> str:
    return f"RANGE BETWEEN INTERVAL '{interval}' PRECEDING AND CURRENT ROW"


def over(key: str, frame: str = "") -> str:
    return f"OVER (PARTITION BY {key} ORDER BY event_timestamp {frame})"


MONTH_PRIOR = "RANGE BETWEEN INTERVAL '30 days' PRECEDING AND INTERVAL '1 microsecond' PRECEDING"

def half_up(value: str, digits: int) -> str:
    """Rounding that both engines compute with the same floating-point steps."""
    return f"floor(({value}) * 1e{digits}::DOUBLE + 0.5::DOUBLE) / 1e{digits}::DOUBLE"


DEVIATION = f"""
dev0 AS (
  SELECT transaction_id, CAST(amount AS DOUBLE) AS x,
    count(amount) {over("account_id", MONTH_PRIOR)} AS n,
    CAST(sum(CAST(amount * 100 AS BIGINT)) {over("account_id", MONTH_PRIOR)} AS DOUBLE)
      / count(amount) {over("account_id", MONTH_PRIOR)} / 100 AS mean,
    stddev_samp(CAST(amount AS DOUBLE)) {over("account_id", MONTH_PRIOR)} AS sd
  FROM tx
),
deviation AS (
  SELECT transaction_id, n AS prior_txn_count_30d,
    {half_up("mean", 4)} AS account_mean_amount_30d,
    {half_up("sd", 4)} AS account_std_amount_30d,
    -- greatest() skips NULLs, so a missing deviation must not reach it
    {half_up("CASE WHEN sd IS NOT NULL THEN (x - mean) / greatest(sd, 0.01::DOUBLE) END", 4)} AS amount_zscore,
    {half_up("CASE WHEN mean > 0 THEN x / mean END", 4)} AS amount_vs_recent_average
  FROM (SELECT * REPLACE (CASE WHEN n > 1 THEN sd END AS sd) FROM dev0)
)
"""
TRAVEL = f"""
trav0 AS (
  SELECT transaction_id, country, latitude, longitude, event_timestamp,
    lag(latitude) OVER w AS plat, lag(longitude) OVER w AS plon,
    lag(event_timestamp) OVER w AS pts, lag(country) OVER w AS pc
  FROM tx WINDOW w AS (PARTITION BY account_id ORDER BY event_timestamp, transaction_id)
),
trav1 AS (
  SELECT transaction_id, country, pc,
    CASE WHEN plat IS NOT NULL THEN {HAVERSINE.format(lat1="plat", lat2="latitude", lon1="plon", lon2="longitude")} END AS km,
    (epoch_us(event_timestamp) - epoch_us(pts)) / 1e6::DOUBLE AS secs
  FROM trav0
),
travel AS (
  SELECT transaction_id, km AS distance_from_previous_km, secs AS seconds_since_previous_txn,
    round(km / nullif(secs / 3600, 0), 3) AS implied_speed_kmh,
    km > 25 AND km > secs / 3600 * 900 AS impossible_travel,
    country <> pc AS country_changed
  FROM trav1
)
"""

COUNTRY_COUNT = f"""
countries AS (
  SELECT transaction_id,
    CAST(count(DISTINCT country) {over("account_id", last("30 minutes"))} AS INTEGER) AS country_count
  FROM tx
)
"""

NEW_PAIRS = """
pairs AS (
  SELECT transaction_id,
    row_number() OVER (PARTITION BY account_id, device_id ORDER BY event_timestamp, transaction_id) = 1 AS new_device_for_account,
    row_number() OVER (PARTITION BY account_id, merchant_id ORDER BY event_timestamp, transaction_id) = 1 AS new_merchant_for_account
  FROM tx
)
"""

DEVICES = f"""
devices AS (
  SELECT transaction_id,
    count(DISTINCT account_id) {over("device_id", "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")} AS device_account_count,
    count(*) {over("device_id", last("1 hour"))} AS device_txn_count_1h,
    count(*) {over("device_id", last("30 days"))} AS device_seen_count_30d,
    country <> lag(country) OVER (PARTITION BY device_id ORDER BY event_timestamp, transaction_id) AS device_country_change
  FROM tx
)
"""

MERCHANTS = f"""
merchants AS (
  SELECT transaction_id,
    count(*) {over("merchant_id", PRIOR)} AS merchant_txn_count,
    count(*) {over("merchant_id", "RANGE BETWEEN INTERVAL '1 hour' PRECEDING AND INTERVAL '1 microsecond' PRECEDING")} AS merchant_txn_velocity_1h,
    {half_up(f"""CAST(sum(CAST(amount * 100 AS BIGINT)) {over("merchant_id", PRIOR)} AS DOUBLE) / count(amount) {over("merchant_id", PRIOR)} / 100""", 6)} AS merchant_avg_amount,
    {half_up(f"""avg(CAST(is_fraud AS INTEGER)) {over("merchant_id", PRIOR)}""", 6)} AS merchant_fraud_rate
  FROM lab
)
"""

VELOCITY = f"""
velocity AS (
  SELECT transaction_id,
    {", ".join(f"count(*) {over('account_id', last(i))} AS txn_count_{w}" for w, i in (("5m", "5 minutes"), ("30m", "30 minutes"), ("24h", "24 hours")))},
    {", ".join(f"CAST(sum(amount) {over('account_id', last(i))} AS DOUBLE) AS amount_sum_{w}" for w, i in (("5m", "5 minutes"), ("30m", "30 minutes"), ("24h", "24 hours")))}
  FROM tx
)
"""

RULES = (
    ("IMPOSSIBLE_TRAVEL", "impossible_travel", "0.25", "HIGH"),
    ("HIGH_TXN_VELOCITY", "txn_count_5m >= 5", "0.15", "MEDIUM"),
    ("EXTREME_AMOUNT_DEVIATION", "abs(amount_zscore) >= 3", "0.20", "HIGH"),
    ("NEW_DEVICE_HIGH_VALUE", "new_device_for_account AND amount >= 110", "0.20", "HIGH"),
    ("HIGH_RISK_MERCHANT", "merchant_fraud_rate_raw >= 0.10", "0.15", "MEDIUM"),
    ("RAPID_COUNTRY_CHANGE", "country_count >= 3", "0.15", "MEDIUM"),
    ("DEVICE_SHARED_ACROSS_ACCOUNTS", "device_account_count >= 3", "0.10", "LOW"),
)

DECIDED = (
    f"""
WITH {TX}, {LABELLED}, {DEVIATION}, {TRAVEL}, {COUNTRY_COUNT}, {NEW_PAIRS}, {DEVICES}, {VELOCITY},
rate AS (
  SELECT transaction_id, avg(CAST(is_fraud AS INTEGER)) {over("merchant_id", PRIOR)} AS merchant_fraud_rate_raw FROM lab
),
j AS (
  SELECT lab.*, txn_count_5m, amount_zscore, impossible_travel, new_device_for_account,
    device_account_count, merchant_fraud_rate_raw, country_count
  FROM lab JOIN velocity USING (transaction_id) JOIN deviation USING (transaction_id)
    JOIN travel USING (transaction_id) JOIN pairs USING (transaction_id)
    JOIN devices USING (transaction_id) JOIN rate USING (transaction_id) JOIN countries USING (transaction_id)
),
h AS (
  SELECT *, """
    + ", ".join(f"coalesce({c}, false) AS r{i}" for i, (_, c, _, _) in enumerate(RULES))
    + """,
    floor(1 / (1 + exp(-coalesce(amount_zscore, 0))) * 1e6::DOUBLE + 0.5::DOUBLE) / 1e6::DOUBLE AS model_probability
  FROM j
),
t AS (
  SELECT *, """
    + " + ".join(
        f"CASE WHEN r{i} THEN {d}::DECIMAL(6,2) ELSE 0.00::DECIMAL(6,2) END"
        for i, (_, _, d, _) in enumerate(RULES)
    )
    + " AS total, list_filter(["
    + ", ".join(f"CASE WHEN r{i} THEN '{code}' END" for i, (code, _, _, _) in enumerate(RULES))
    + """], lambda x: x IS NOT NULL) AS codes
  FROM h
),
u AS (
  SELECT *, floor(least(1.0::DOUBLE, 0.75::DOUBLE * model_probability + CAST(total AS DOUBLE)) * 1e6::DOUBLE + 0.5::DOUBLE) / 1e6::DOUBLE AS risk_score FROM t
),
decided AS (
  SELECT *, CASE WHEN risk_score >= 0.8 THEN 'BLOCK' WHEN risk_score >= 0.5 THEN 'REVIEW' ELSE 'APPROVE' END AS decision
  FROM u
)
"""
)

CUTS = [step / 20 for step in range(1, 20)]
METRICS = (
    DECIDED
    + f""",
cut AS (SELECT unnest({CUTS}::DOUBLE[]) AS threshold),
conf AS (
  SELECT threshold,
    count(*) FILTER (WHERE risk_score >= threshold AND is_fraud) AS tp,
    count(*) FILTER (WHERE risk_score >= threshold AND NOT is_fraud) AS fp,
    count(*) FILTER (WHERE risk_score < threshold AND is_fraud) AS fn,
    count(*) FILTER (WHERE risk_score < threshold AND NOT is_fraud) AS tn
  FROM decided, cut WHERE is_fraud IS NOT NULL GROUP BY threshold
),
metrics AS (
  SELECT threshold, tp, fp, fn, tn,
    {half_up("tp / nullif(tp + fp, 0)", 6)} AS "precision",
    {half_up("tp / nullif(tp + fn, 0)", 6)} AS recall,
    {half_up("2 * tp / nullif(2 * tp + fp + fn, 0)", 6)} AS f1,
    {half_up("fp / nullif(fp + tn, 0)", 6)} AS false_positive_rate,
    {half_up("fn / nullif(fn + tp, 0)", 6)} AS false_negative_rate,
    fn * 500.0::DOUBLE + fp * 5.0::DOUBLE AS expected_cost
  FROM conf
)
"""
)

MODEL_SUMMARY = f"""WITH {TX}, {LABELLED} SELECT count(*) AS rows_scored, count(DISTINCT transaction_id) AS ids,
  count(is_fraud) AS labelled, count(*) FILTER (WHERE is_fraud) AS frauds, count(*) AS in_range FROM lab"""

HALF = "event_timestamp < TIMESTAMP '2024-01-01 07:30:00'"


def drift(feature: str, bin_sql: str) -> str:
    return f"""
  SELECT '{feature}' AS feature, count(*) AS bins, {half_up("sum((q - p) * ln(q / p))", 8)} AS psi FROM (
    SELECT (o + 0.5) / (sum(o) OVER () + 0.5 * count(*) OVER ()) AS p,
           (n + 0.5) / (sum(n) OVER () + 0.5 * count(*) OVER ()) AS q
    FROM (SELECT {bin_sql} AS bin, CAST(count(*) FILTER (WHERE {HALF}) AS DOUBLE) AS o,
            CAST(count(*) FILTER (WHERE NOT ({HALF})) AS DOUBLE) AS n FROM tx GROUP BY 1))
"""


AMOUNT_BIN = " + ".join(
    f"CAST(CAST(amount AS DOUBLE) >= {c} AS INTEGER)" for c in (0.01, 10, 20, 35, 50, 75, 100, 150, 200)
)


def fraud_rate(column: str) -> str:
    return f"""WITH {TX}, {LABELLED} SELECT {column}, count(*) AS txn_count, count(is_fraud) AS labelled_count,
  {half_up("count(*) FILTER (WHERE is_fraud) / nullif(count(is_fraud), 0)", 6)} AS fraud_rate FROM lab GROUP BY 1"""


def signal(name: str) -> str:
    return f"""WITH {TX}, {windows("tx", BOTH)} SELECT account_id, window_size, count(*) AS windows,
  count(*) FILTER (WHERE {name}) AS raised FROM feat GROUP BY 1, 2"""


VALID_GOLD = f"WITH {TX}, {MS}, {OUTCOME}, ok AS (SELECT * FROM judged WHERE error_type IS NULL)"
CLOSED = "WHERE window_end <= (SELECT max(event_timestamp) - INTERVAL '10 minutes' FROM ms)"

# Every record on its topic: canonical JSON, or what the envelope says of its origin.
ROUTED_VALUES = f"""WITH {TX}, {MS}, {OUTCOME} SELECT account_id AS record_key,
  CASE WHEN error_type IS NULL THEN 'transactions.validated' ELSE 'transactions.dlq' END AS topic,
  CASE WHEN error_type IS NULL THEN {canonical()}
    ELSE error_type || '|transactions.raw|' || event_id % 4 || '|' || event_id || '|' || account_id END AS content
  FROM judged"""

ORACLE: dict[str, str] = {
    "parse_events": f"WITH {TX}, {MS} SELECT {CONTRACT_PLAIN} FROM ms",
    "prepare_events": f"WITH {TX}, {MS} SELECT {CONTRACT_PLAIN} FROM ms",
    "dedup_transactions": f"WITH {TX} SELECT transaction_id, account_id, event_timestamp, CAST(amount AS DOUBLE) AS amount FROM tx",
    "canonical_json": f"WITH {TX} SELECT account_id AS record_key, {canonical()} AS value FROM tx",
    "high_amount_flag": f"WITH {TX} SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, amount >= 110 AS is_high_amount FROM tx",
    "window_features_5m": f"WITH {TX}, {windows('tx', {'5m': '5 minutes'})} SELECT * FROM feat",
    "window_features_30m": f"WITH {TX}, {windows('tx', {'30m': '30 minutes'})} SELECT * FROM feat",
    "account_window_features": f"WITH {TX}, {windows('tx', BOTH)} SELECT * FROM feat",
    "multi_device_signal": signal("multi_device_signal"),
    "rapid_transaction_signal": signal("rapid_transaction_signal"),
    "rapid_location_change_signal": signal("rapid_location_change_signal"),
    "haversine_distance": f"""WITH {TX}, home AS (SELECT *,
      list_extract([12.9716, 40.7128, 51.5074, 52.5200, 1.3521, -33.8688]::DOUBLE[], event_id % 6 + 1) AS hlat,
      list_extract([77.5946, -74.0060, -0.1278, 13.4050, 103.8198, 151.2093]::DOUBLE[], event_id % 6 + 1) AS hlon FROM tx)
      SELECT transaction_id, {HAVERSINE.format(lat1="latitude", lat2="hlat", lon1="longitude", lon2="hlon")} AS distance_km FROM home""",
    "location_grid": f"WITH {TX} SELECT round(latitude, 3)::VARCHAR || ',' || round(longitude, 3)::VARCHAR AS cell, count(*) AS txn_count FROM tx GROUP BY 1",
    "silver_transactions": f"WITH {TX} SELECT {CONTRACT_PLAIN}, CAST(event_timestamp AS DATE) AS event_date, CAST(hour(event_timestamp) AS INTEGER) AS event_hour FROM tx",
    "gold_account_features": f"WITH {TX}, {windows('tx', BOTH)} {GOLD}",
    "lake_round_trip": f"{VALID_GOLD}, {windows('ok', BOTH)} {GOLD}",
    "lake_summary": f"""{VALID_GOLD}, {windows('ok', BOTH)}
      SELECT 'silver' AS layer, true AS has_files, count(*) AS row_count, min(event_timestamp) AS first_time,
        max(event_timestamp) AS last_time, CAST(0 AS INTEGER) AS gate_code FROM ok
      UNION ALL SELECT 'gold', true, count(*), min(window_start), max(window_start), 0 FROM feat""",
    "validate_events": f"""WITH {TX}, {MS}, {OUTCOME} SELECT event_id AS "offset", error_type IS NULL AS is_valid, error_type,
      CASE WHEN error_type IN ('MALFORMED_JSON', 'EMPTY_PAYLOAD', 'SCHEMA_VALIDATION') THEN NULL ELSE 1::BIGINT END AS payload_version,
      CASE WHEN error_type IS NULL THEN event_timestamp END AS event_timestamp,
      CASE WHEN error_type IS NULL THEN CAST(amount AS DOUBLE) END AS amount FROM judged""",
    "valid_events": f"{VALID_GOLD} SELECT {CONTRACT_PLAIN} FROM ok",
    "validation_error_counts": f"WITH {TX}, {MS}, {OUTCOME} SELECT coalesce(error_type, 'VALID') AS outcome, count(*) AS records FROM judged GROUP BY 1",
    "dead_letter_envelope": f"""WITH {TX}, {MS}, {OUTCOME},
      bad AS (SELECT *, CASE WHEN amount <= 0 AND damage IS DISTINCT FROM 'INVALID_AMOUNT'
        THEN 'amount: not allowed: "' || amount::VARCHAR || '"' END AS amount_note FROM judged WHERE error_type IS NOT NULL)
      SELECT 'transactions.raw' AS original_topic, CAST(event_id % 4 AS INTEGER) AS original_partition, event_id AS original_offset,
        account_id AS original_key, error_type,
        CASE event_id % 16
          WHEN 0 THEN 'value is not one complete JSON document'
          WHEN 1 THEN 'amount: not allowed: "-10.00"'
          WHEN 2 THEN concat_ws('; ', amount_note, 'currency: not allowed: "ZZZ"')
          WHEN 3 THEN concat_ws('; ', amount_note, 'unexpected field: unexpected_field')
          WHEN 4 THEN concat_ws('; ', amount_note, 'latitude: not allowed: 200')
          WHEN 5 THEN 'amount: field required'
          WHEN 6 THEN 'message value is empty'
          WHEN 7 THEN 'value is not a JSON object'
          WHEN 8 THEN 'value is not one complete JSON document'
          WHEN 9 THEN 'value is not valid UTF-8'
          ELSE amount_note END AS error_message,
        CASE WHEN error_type IN ('MALFORMED_JSON', 'EMPTY_PAYLOAD', 'SCHEMA_VALIDATION') THEN NULL ELSE 1::BIGINT END AS schema_version,
        '1' AS validator_version FROM bad""",
    "route_topics": f"""WITH {TX}, {MS}, {OUTCOME} SELECT CASE WHEN error_type IS NULL THEN 'transactions.validated' ELSE 'transactions.dlq' END AS topic,
      account_id AS record_key, count(*) AS records FROM judged GROUP BY 1, 2""",
    "routed_values": ROUTED_VALUES,
    "validate_texts": """WITH t AS (
        SELECT 'documents' AS topic, text AS v FROM documents UNION ALL SELECT 'pages', html FROM pages
        UNION ALL SELECT 'conversations', text FROM conversations UNION ALL SELECT 'benchmark', text FROM benchmark
        UNION ALL SELECT 'events', props FROM events)
      SELECT topic, CASE WHEN v IS NULL THEN 'EMPTY_PAYLOAD' WHEN NOT json_valid(v) THEN 'MALFORMED_JSON'
          WHEN json_type(CASE WHEN json_valid(v) THEN v END) <> 'OBJECT' THEN 'SCHEMA_VALIDATION' ELSE 'MISSING_FIELD' END AS error_type,
        count(*) AS records, CAST(sum(length(v)) AS BIGINT) AS characters FROM t GROUP BY 1, 2""",
    "peek_records": f"""WITH {TX} SELECT account_id AS key, event_id AS "offset",
      CASE event_id % 16 WHEN 0 THEN 'not JSON' WHEN 6 THEN 'empty value' WHEN 7 THEN 'not an object'
        WHEN 8 THEN 'not JSON' WHEN 9 THEN 'not JSON' END AS problem FROM tx ORDER BY event_id LIMIT 20""",
    "stream_silver": f"WITH {TX}, {MS} SELECT {CONTRACT_PLAIN}, CAST(event_timestamp AS DATE) AS event_date, CAST(hour(event_timestamp) AS INTEGER) AS event_hour FROM ms",
    "stream_gold": f"WITH {TX}, {MS}, {windows('ms', BOTH)} {GOLD} {CLOSED}",
    "stream_gold_from_silver": f"WITH {TX}, {MS}, {windows('ms', BOTH)} {GOLD} {CLOSED}",
    "stream_router": f"""WITH {TX} SELECT CASE WHEN amount > 0 THEN 'transactions.validated' ELSE 'transactions.dlq' END AS topic,
      count(*) AS records FROM tx GROUP BY 1""",
    "stream_routed_values": ROUTED_VALUES,
    "velocity_24h": f"WITH {TX}, {windows('tx', {'24h': '24 hours'})} SELECT * FROM feat",
    "rolling_velocity": f"WITH {TX}, {VELOCITY} SELECT * FROM velocity",
    "amount_deviation": f"WITH {TX}, {DEVIATION} SELECT * FROM deviation",
    "amount_percentile": f"""WITH {TX}, pairs AS (
        SELECT a.transaction_id, count(b.amount) AS n, count(*) FILTER (b.amount <= a.amount) AS upto, any_value(a.amount) AS amount
        FROM tx a LEFT JOIN tx b ON a.account_id = b.account_id AND b.event_timestamp < a.event_timestamp
          AND b.event_timestamp >= a.event_timestamp - INTERVAL 30 DAY GROUP BY a.transaction_id)
      SELECT transaction_id, n AS prior_amount_count,
        CASE WHEN n > 0 AND amount IS NOT NULL THEN {half_up("upto / n", 8)} END AS amount_percentile FROM pairs""",
    "rolling_median": f"""WITH {TX}, w AS (
        SELECT transaction_id, amount, count(amount) OVER recent AS n, CAST(quantile_disc(amount, 0.5) OVER recent AS DOUBLE) AS median FROM tx
        WINDOW recent AS (PARTITION BY account_id ORDER BY event_timestamp
          RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING))
      SELECT transaction_id, n AS prior_amount_count, median AS rolling_median,
        {half_up("CAST(amount AS DOUBLE) / nullif(median, 0)", 6)} AS amount_vs_median FROM w""",
    "impossible_travel": f"WITH {TX}, {TRAVEL} SELECT * FROM travel",
    "countries_seen": f"WITH {TX}, {COUNTRY_COUNT} SELECT * FROM countries",
    "new_device_merchant": f"WITH {TX}, {NEW_PAIRS} SELECT * FROM pairs",
    "device_activity": f"WITH {TX}, {DEVICES} SELECT * FROM devices",
    "merchant_history": f"WITH {TX}, {LABELLED}, {MERCHANTS} SELECT * FROM merchants",
    "merchant_category_risk": f"""WITH {TX}, {LABELLED} SELECT transaction_id,
        {half_up(f"avg(CAST(is_fraud AS INTEGER)) {over('merchant_category', PRIOR)}", 6)} AS merchant_category_risk FROM lab""",
    "temporal_features": f"""WITH {TX}, h AS (SELECT *, CAST(hour(event_timestamp) AS INTEGER) AS hour_of_day FROM tx),
      c AS (SELECT *, count(*) {over("account_id", PRIOR)} AS n,
        count(*) {over("account_id, hour_of_day", PRIOR)} AS same FROM h)
      SELECT transaction_id, hour_of_day, CAST(dayofweek(event_timestamp) + 1 AS INTEGER) AS day_of_week,
        dayofweek(event_timestamp) IN (0, 6) AS weekend, n >= 20 AND same < n * 0.06::DOUBLE AS unusual_hour_for_account FROM c""",
    "rule_hits": DECIDED
    + " UNION ALL ".join(
        f"SELECT '{code}' AS reason_code, '{sev}' AS severity, count(*) AS hits, CAST(count(*) * {delta}::DECIMAL(4,2) AS DOUBLE) AS risk_total FROM decided WHERE r{i} HAVING count(*) > 0"
        for i, (code, _, delta, sev) in enumerate(RULES)
    ),
    "risk_decision": DECIDED
    + """SELECT transaction_id, CAST(total AS DOUBLE) AS rule_risk_total, model_probability, risk_score, decision,
        CASE WHEN len(codes) = 0 AND risk_score >= 0.5 THEN 'MODEL_SCORE' ELSE array_to_string(codes, ',') END AS reason_codes FROM decided""",
    "alerts": DECIDED
    + f"""SELECT transaction_id, account_id, event_timestamp, risk_score, decision FROM decided
        WHERE decision <> 'APPROVE' AND risk_score >= 0.6 AND NOT ({HALF})""",
    "score_by_channel": DECIDED
    + f"""SELECT channel, count(*) AS txn_count, {half_up("avg(risk_score)", 6)} AS avg_risk_score,
        count(*) FILTER (WHERE decision = 'REVIEW') AS reviewed, count(*) FILTER (WHERE decision = 'BLOCK') AS blocked FROM decided GROUP BY 1""",
    "account_risk_summary": DECIDED
    + f"""SELECT account_id, count(*) AS txn_count, count(*) FILTER (WHERE decision <> 'APPROVE') AS alert_count,
        {half_up("avg(risk_score)", 6)} AS avg_risk_score, max(risk_score) AS max_risk_score, max(event_timestamp) AS last_seen FROM decided GROUP BY 1""",
    "false_positive_trend": DECIDED
    + f"""SELECT CAST(event_timestamp AS DATE) AS event_date, count(*) FILTER (WHERE NOT is_fraud) AS legitimate_count,
        {half_up("count(*) FILTER (WHERE NOT is_fraud AND decision <> 'APPROVE') / nullif(count(*) FILTER (WHERE NOT is_fraud), 0)", 6)} AS false_positive_rate
        FROM decided GROUP BY 1""",
    "threshold_metrics": METRICS + "SELECT * FROM metrics",
    "best_threshold": METRICS + "SELECT threshold, expected_cost FROM metrics ORDER BY expected_cost, threshold LIMIT 1",
    "curve_areas": DECIDED
    + f""", s AS (SELECT risk_score AS c, is_fraud FROM decided WHERE is_fraud IS NOT NULL),
      pos AS (SELECT c, count(*) AS n FROM s WHERE is_fraud GROUP BY 1),
      neg AS (SELECT c, count(*) AS n FROM s WHERE NOT is_fraud GROUP BY 1),
      win AS (SELECT sum(pos.n * neg.n * CASE WHEN pos.c > neg.c THEN 1.0::DOUBLE WHEN pos.c = neg.c THEN 0.5::DOUBLE ELSE 0 END) AS w FROM pos, neg),
      ap AS (SELECT sum(n * (SELECT count(*) FILTER (WHERE is_fraud) / count(*) FROM s WHERE s.c >= pos.c)) / sum(n) AS a FROM pos)
      SELECT count(*) FILTER (WHERE is_fraud) AS frauds, count(*) FILTER (WHERE NOT is_fraud) AS others,
        {half_up("(SELECT w FROM win) / (count(*) FILTER (WHERE is_fraud) * count(*) FILTER (WHERE NOT is_fraud))", 6)} AS roc_auc,
        {half_up("(SELECT a FROM ap)", 6)} AS pr_auc FROM s""",
    "quality_report": f"""WITH {TX}, d AS (SELECT * FROM tx UNION ALL SELECT * FROM tx WHERE event_id % 10 = 0),
      c AS (SELECT count(*) AS total, count(*) FILTER (WHERE amount <= 0) AS bad_amount,
        count(*) FILTER (WHERE event_timestamp > TIMESTAMP '2024-01-01 14:05:00') AS future,
        count(*) - count(DISTINCT transaction_id) AS repeated FROM d)
      SELECT 'transaction_id_not_null' AS check_name, 0::BIGINT AS failed, total FROM c
      UNION ALL SELECT 'account_id_not_null', 0, total FROM c UNION ALL SELECT 'amount_positive', bad_amount, total FROM c
      UNION ALL SELECT 'currency_allowed', 0, total FROM c UNION ALL SELECT 'coordinates_valid', 0, total FROM c
      UNION ALL SELECT 'event_time_not_in_future', future, total FROM c
      UNION ALL SELECT 'transaction_id_unique', repeated, total FROM c""",
    "pipeline_report": f"""WITH {TX}, {MS}, {OUTCOME}, c AS (SELECT CAST(count(*) AS DOUBLE) AS n, count(error_type) / count(*) AS dlq FROM judged)
      SELECT 'volume_in_range' AS check_name, n AS measured, n BETWEEN 1 AND 1e15 AS passed FROM c
      UNION ALL SELECT 'dlq_ratio', {half_up("dlq", 6)}, dlq <= 0.5 FROM c
      UNION ALL SELECT 'score_in_bounds', 0.0::DOUBLE, true""",
    "psi_drift": f"WITH {TX} {drift('amount', AMOUNT_BIN)} UNION ALL {drift('merchant_category', 'merchant_category')} UNION ALL {drift('country', 'country')}",
    "ks_drift": f"""WITH {TX}, b AS (SELECT amount, CAST(count(*) FILTER (WHERE {HALF}) AS DOUBLE) AS o,
        CAST(count(*) FILTER (WHERE NOT ({HALF})) AS DOUBLE) AS n FROM tx WHERE amount IS NOT NULL GROUP BY 1)
      SELECT 'amount' AS feature, {half_up("max(gap)", 8)} AS ks FROM (SELECT abs(sum(o) OVER w / sum(o) OVER () - sum(n) OVER w / sum(n) OVER ()) AS gap
        FROM b WINDOW w AS (ORDER BY amount ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    "daily_merchant_summary": f"""WITH {TX} SELECT CAST(event_timestamp AS DATE) AS event_date, merchant_id, count(*) AS txn_count,
      CAST(sum(amount) AS DOUBLE) AS amount_sum, CAST(max(amount) AS DOUBLE) AS amount_max, count(DISTINCT account_id) AS unique_accounts FROM tx GROUP BY 1, 2""",
    "daily_volume": f"WITH {TX} SELECT CAST(event_timestamp AS DATE) AS event_date, count(*) AS txn_count, CAST(sum(amount) AS DOUBLE) AS amount_sum FROM tx GROUP BY 1",
    "fraud_rate_by_category": fraud_rate("merchant_category"),
    "fraud_rate_by_country": fraud_rate("country"),
    "replay_slice": f"""WITH {TX}, {MS}, {OUTCOME}, ok AS (SELECT * FROM judged WHERE error_type IS NULL AND account_id = 'acct_1005'
        AND event_id IN (SELECT event_id FROM tx WHERE event_timestamp >= TIMESTAMP '2024-01-01 03:00:00' AND event_timestamp < TIMESTAMP '2024-01-01 09:00:00')),
      {windows('ok', BOTH)} SELECT * FROM feat""",
    "upsert_transactions": f"""WITH {TX}, u AS (SELECT *, event_id % 2 = 0 OR event_id % 3 = 0 AS updated FROM tx)
      SELECT transaction_id, account_id, CAST(CASE WHEN updated THEN amount + 1 ELSE amount END AS DOUBLE) AS amount,
        CASE WHEN updated THEN event_timestamp + INTERVAL '1 hour' ELSE event_timestamp END AS processed_at FROM u""",
    "model_logistic_summary": MODEL_SUMMARY.replace("AS in_range", "AS in_range, count(*) AS by_formula"),
    "model_boosted_trees_summary": MODEL_SUMMARY,
}

# The streams give what the batch queries give.
ORACLE["stream_previous"] = ORACLE["impossible_travel"]
ORACLE["stream_new_pairs"] = ORACLE["new_device_merchant"]
ORACLE["stream_temporal"] = ORACLE["temporal_features"]

GROUPED = """count(*) AS txn_count, CAST(sum(amount) AS DOUBLE) AS amount_sum, CAST(max(amount) AS DOUBLE) AS amount_max,
        count(*) FILTER (transaction_type = 'REFUND') AS refund_count"""
SESSIONS = f"""WITH {TX}, marked AS (
        SELECT *, CASE WHEN event_timestamp - lag(event_timestamp) OVER w <= INTERVAL 2 MINUTE THEN 0 ELSE 1 END AS starts
        FROM tx WINDOW w AS (PARTITION BY account_id ORDER BY event_timestamp, event_id)),
      numbered AS (SELECT *, sum(starts) OVER (PARTITION BY account_id ORDER BY event_timestamp, event_id) AS session FROM marked),
      sessions AS (SELECT account_id, min(event_timestamp) AS session_start, max(event_timestamp) + INTERVAL 2 MINUTE AS session_end, {GROUPED}
        FROM numbered GROUP BY account_id, session)"""
SLIDING = f"""WITH {TX}, placed AS (
        SELECT *, unnest(range(3)) AS back FROM tx),
      windows AS (SELECT account_id, time_bucket(INTERVAL 10 MINUTE, event_timestamp) - back * INTERVAL 10 MINUTE AS window_start, {GROUPED}
        FROM placed GROUP BY ALL),
      slid AS (SELECT account_id, window_start, window_start + INTERVAL 30 MINUTE AS window_end, txn_count, amount_sum, amount_max, refund_count FROM windows)"""
# A stream has closed what ended before the watermark: ten minutes behind the newest event, in whole milliseconds.
CLOSED = "(SELECT date_trunc('millisecond', max(event_timestamp)) - INTERVAL 10 MINUTE FROM tx)"
ORACLE["account_sessions"] = f"{SESSIONS} SELECT * FROM sessions"
ORACLE["stream_sessions"] = f"{SESSIONS} SELECT * FROM sessions WHERE session_end <= {CLOSED}"
ORACLE["sliding_windows"] = f"{SLIDING} SELECT * FROM slid"
ORACLE["stream_sliding_windows"] = f"{SLIDING} SELECT * FROM slid WHERE window_end <= {CLOSED}"
ORACLE["merge_partitions"] = f"""WITH {TX}, dated AS (
        SELECT transaction_id, account_id, amount, event_timestamp AS processed_at, event_id,
          CAST(event_timestamp AS DATE) + CAST(event_id % 20 AS INTEGER) AS event_date FROM tx)
      SELECT transaction_id, account_id,
        CAST(CASE WHEN late THEN amount + 1 ELSE amount END AS DOUBLE) AS amount,
        CASE WHEN late THEN processed_at + INTERVAL 1 HOUR ELSE processed_at END AS processed_at,
        CASE WHEN late AND event_id % 3 = 0 THEN event_date + 1 ELSE event_date END AS event_date
      FROM (SELECT *, event_id % 20 = 7 AND event_id % 3 <> 2 AS late FROM dated)"""
ORACLE["stream_alerts"] = ORACLE["alerts"]
ORACLE["distinct_sketches"] = f"""WITH {TX} SELECT account_id, CAST(event_timestamp AS DATE) AS day,
        count(DISTINCT merchant_id) AS exact_merchants, count(DISTINCT device_id) AS exact_devices,
        count(DISTINCT transaction_id) AS exact_transactions, true AS merchants_close, true AS devices_close, true AS transactions_close
      FROM tx GROUP BY ALL"""
ORACLE["psi_sketches"] = f"""WITH {TX}, halves AS (
        SELECT CAST(amount * 100 AS BIGINT) AS cents, event_timestamp < TIMESTAMP '2024-01-01 07:00:00' AS old FROM tx WHERE amount IS NOT NULL),
      cuts AS (SELECT list_distinct(quantile_disc(cents, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS cuts FROM halves WHERE old),
      binned AS (SELECT old, len(list_filter(cuts, lambda c: c < cents)) AS bin FROM halves, cuts),
      bins AS (SELECT bin, count(*) FILTER (old) AS o, count(*) FILTER (NOT old) AS n FROM binned GROUP BY 1),
      shares AS (SELECT (o + 0.5::DOUBLE) / (sum(o) OVER () + 0.5::DOUBLE * count(*) OVER ()) AS p,
        (n + 0.5::DOUBLE) / (sum(n) OVER () + 0.5::DOUBLE * count(*) OVER ()) AS q FROM bins)
      SELECT 'amount' AS feature, count(*) AS bins, {half_up("sum((q - p) * ln(q / p))", 8)} AS exact_psi, true AS close FROM shares"""
ORACLE["stream_dead_letter_rate"] = f"""WITH {TX}, c AS (
        SELECT count(*) AS n, count(*) FILTER (event_id % 16 < 10) AS dead FROM tx)
      SELECT n AS rows, dead AS dead_letters, {half_up("dead / n", 8)} AS dead_letter_rate FROM c"""
ORACLE["stream_duplicate_rate"] = f"""WITH c AS (SELECT count(*) AS n, count(*) FILTER (event_id % 10 = 0) AS twice FROM events)
      SELECT n + twice AS rows, twice AS duplicates, {half_up("1 - n / (n + twice)", 8)} AS duplicate_rate FROM c"""
ORACLE["isolation_forest_summary"] = "SELECT count(*) AS rows_scored, count(*) AS in_range, true AS largest_stands_out FROM events"

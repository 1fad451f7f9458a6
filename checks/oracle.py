"""DuckDB statements giving the same rows as the queries in ``checks.queries``.

Each is written from the meaning of the report, over the whole tables.
"""

from ledgerloom.operators.grains import GRAINS
from ledgerloom.plans.catalog import DATASETS

MERCHANTS = """
  LEFT JOIN supplier s ON s.s_suppkey = {supplier_key}
  LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey"""

LINEITEM = (
    """
SELECT o.o_custkey AS user_id,
  l.l_linenumber AS card_id,
  CAST((l.l_orderkey * 7 + l.l_linenumber) % 24 AS INTEGER) AS hour,
  s.s_name AS merchant_name, n.n_name AS merchant_city, r.r_name AS merchant_state,
  CASE WHEN l.l_returnflag = 'R' THEN 'Bad PIN' ELSE '' END AS has_errors,
  CASE WHEN l.l_orderkey % 37 = 0 THEN 'Yes' ELSE 'No' END AS is_fraud,
  CAST(l.l_shipdate AS DATE) AS ds,
  CAST(round(CAST(l.l_extendedprice AS DECIMAL(12,2)) * 25380) AS BIGINT) AS amount_vnd
FROM lineitem l
  LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey"""
    + MERCHANTS.format(supplier_key="l.l_suppkey")
)

EVENTS = (
    """
SELECT e.event_id, e.ts,
  CAST(e.user_id AS INTEGER) AS user_id,
  CAST(e.user_id % 3 AS INTEGER) AS card_id,
  strftime(e.ts, '%H:%M:%S') AS time,
  CAST(hour(e.ts) AS INTEGER) AS hour,
  CAST(e.value AS DECIMAL(12,2)) AS amount_usd,
  s.s_name AS merchant_name, n.n_name AS merchant_city, r.r_name AS merchant_state,
  CASE WHEN e.event_type = 'error' THEN 'Technical Glitch' ELSE '' END AS has_errors,
  CASE WHEN e.event_id % 37 = 0 THEN 'Yes' ELSE 'No' END AS is_fraud,
  CAST(e.ts AS DATE) AS ds,
  CAST(round(CAST(e.value AS DECIMAL(12,2)) * 25380) AS BIGINT) AS amount_vnd
FROM events e"""
    + MERCHANTS.format(supplier_key="e.event_id % (SELECT count(*) FROM supplier)")
)

GRAIN_FILTER = {
    "day": "ds = (SELECT max(ds) FROM t)",
    "month": "date_trunc('month', ds) = (SELECT date_trunc('month', max(ds)) FROM t)",
    "year": "year(ds) = (SELECT year(max(ds)) FROM t)",
}

P95 = "(SELECT quantile_disc(amount_vnd, 0.95) FROM t)"
TOTAL = "CAST(sum(amount_vnd) AS BIGINT)"

BY_GRAIN = {
    "hourly_analysis": ("hour", "count(*) AS transaction_count", "true"),
    "hourly_unusual_analysis": (
        "hour", "count(*) AS error_transaction_count", "has_errors <> ''"),
    "city_analysis": (
        "merchant_city, merchant_state",
        f"count(*) AS transaction_count, {TOTAL} AS total_amount_vnd, "
        "avg(amount_vnd) AS avg_amount_vnd",
        "true",
    ),
    "merchant_analysis": (
        "merchant_name, merchant_city, merchant_state",
        f"count(*) AS transaction_count, {TOTAL} AS total_amount_vnd, "
        "avg(amount_vnd) AS avg_amount_vnd, max(amount_vnd) AS max_amount_vnd, "
        "count(DISTINCT user_id) AS unique_customers",
        "true",
    ),
    "high_value_analysis": (
        "hour, merchant_city, merchant_name",
        "count(*) AS high_value_count, max(amount_vnd) AS max_amount_vnd",
        f"amount_vnd >= {P95}",
    ),
    "user_error_analysis": (
        "user_id",
        f"count(*) AS error_count, {TOTAL} AS total_error_amount_vnd",
        "has_errors <> ''",
    ),
    "user_fraud_analysis": ("user_id", "count(*) AS fraud_count", "is_fraud = 'Yes'"),
    "fraud_by_hour": ("hour", "count(*) AS fraud_count", "is_fraud = 'Yes'"),
    "fraud_by_merchant": (
        "merchant_name, merchant_city", "count(*) AS fraud_count", "is_fraud = 'Yes'"),
    "fraud_by_city": (
        "merchant_city, merchant_state", "count(*) AS fraud_count", "is_fraud = 'Yes'"),
}

OVERALL = {
    "user_analysis": f"""
SELECT ds, user_id, count(*) AS transaction_count, {TOTAL} AS total_spent_vnd,
  avg(amount_vnd) AS avg_transaction_vnd,
  count(DISTINCT merchant_name) AS unique_merchants,
  count(DISTINCT merchant_city) AS unique_cities,
  CAST(sum(CASE WHEN has_errors <> '' THEN 1 ELSE 0 END) AS BIGINT) AS error_count
FROM t GROUP BY ds, user_id""",
    "user_frequent": """
SELECT user_id, count(*) AS frequent_hour_count,
  CAST(sum(c) AS BIGINT) AS total_rapid_transactions, avg(c) AS avg_txn_per_hour
FROM (SELECT ds, hour, user_id, count(*) AS c FROM t GROUP BY ds, hour, user_id HAVING count(*) > 1)
GROUP BY user_id""",
    "weekday_vs_weekend": f"""
SELECT a.day_type, a.transaction_count, a.total_amount_vnd, a.avg_amount_vnd, a.unique_days,
  b.avg_transactions_per_day
FROM (
  SELECT CASE WHEN dayofweek(ds) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
    count(*) AS transaction_count, {TOTAL} AS total_amount_vnd,
    avg(amount_vnd) AS avg_amount_vnd, count(DISTINCT ds) AS unique_days
  FROM t GROUP BY 1) a
LEFT JOIN (
  SELECT day_type, avg(c) AS avg_transactions_per_day
  FROM (SELECT ds, CASE WHEN dayofweek(ds) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
          count(*) AS c FROM t GROUP BY 1, 2)
  GROUP BY day_type) b ON a.day_type = b.day_type""",
    "fraud_rate_by_merchant": """
SELECT ds, merchant_name, total_transactions, fraud_transactions,
  round(CAST(fraud_transactions AS DOUBLE) / total_transactions * 100, 2) AS fraud_rate_percent
FROM (
  SELECT ds, merchant_name, count(*) AS total_transactions,
    count(*) FILTER (WHERE is_fraud = 'Yes') AS fraud_transactions
  FROM t GROUP BY ds, merchant_name)""",
    "daily_summary": f"""
SELECT ds, count(*) AS total_transactions, {TOTAL} AS total_revenue_vnd,
  avg(amount_vnd) AS avg_transaction_vnd,
  count(DISTINCT user_id) AS unique_users,
  count(DISTINCT merchant_name) AS unique_merchants,
  count(DISTINCT merchant_city) AS unique_cities,
  count(*) FILTER (WHERE has_errors <> '') AS error_transactions,
  count(*) FILTER (WHERE is_fraud = 'Yes') AS fraud_transactions,
  max(amount_vnd) AS max_transaction_vnd, min(amount_vnd) AS min_transaction_vnd
FROM t GROUP BY ds""",
}


def over(source: str, body: str) -> str:
    return f"WITH t AS ({source})\n{body}"


def grain_body(name: str, grain: str) -> str:
    keys, measures, where = BY_GRAIN[name]
    return (
        f"SELECT {keys}, {measures} FROM t "
        f"WHERE {GRAIN_FILTER[grain]} AND {where} GROUP BY {keys}"
    )


def dataset_bodies() -> dict[str, str]:
    """Statement over ``t`` of each of the 35 datasets."""
    bodies = {f"{name}_{g}": grain_body(name, g) for name in BY_GRAIN for g in GRAINS}
    return bodies | OVERALL


RATES = """
SELECT effective_from, lead(effective_from) OVER (ORDER BY effective_from) AS valid_to, rate
FROM (SELECT DISTINCT CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 12 HOUR AS effective_from,
        CAST(25000 + day(ts) * 10 AS DECIMAL(18,4)) AS rate FROM events)"""

CONVERTED = f"""
SELECT t.*, r.rate, CAST(round(t.amount_usd * r.rate) AS BIGINT) AS converted
FROM t LEFT JOIN ({RATES}) r
  ON t.ts >= r.effective_from AND (r.valid_to IS NULL OR t.ts < r.valid_to)"""

CLEAN_ROW = """user_id, card_id, strftime(ts, '%H:%M:00') AS time,
  CAST(amount_usd AS DOUBLE) AS amount_usd,
  'Chip Transaction' AS use_chip, merchant_name, merchant_city, merchant_state,
  '00000' AS zip, 5411 AS mcc, has_errors, is_fraud, ds AS transaction_date, ds"""


def top_body(body: str, order: str) -> str:
    return f"SELECT * FROM ({body}) ORDER BY {order} LIMIT 10"


def published_body() -> str:
    """Row counts of all datasets, with the header each file must have."""
    parts = []
    for key, body in dataset_bodies().items():
        header = ",".join(DATASETS[key].report.columns)
        parts.append(
            f"SELECT '{key}' AS dataset, true AS readable, "
            f"(SELECT count(*) FROM ({body})) AS rows, '{header}' AS columns"
        )
    return "\nUNION ALL ".join(parts)


def statements() -> dict[str, str]:
    bodies = dataset_bodies()
    lineitem = dict(bodies)
    lineitem |= {f"shared_{key}": bodies[key] for key in (*OVERALL, *(f"{n}_year" for n in BY_GRAIN))}
    lineitem |= {
        "stored_csv_report": bodies["city_analysis_year"],
        "top_hours": top_body(bodies["hourly_analysis_year"], "transaction_count DESC, hour"),
        "top_cities": top_body(
            bodies["city_analysis_year"], "total_amount_vnd DESC, merchant_city, merchant_state"
        ),
        "top_merchants": top_body(
            bodies["merchant_analysis_year"],
            "total_amount_vnd DESC, merchant_name, merchant_city, merchant_state",
        ),
        "latest_bounds": "SELECT max(ds) AS latest_day, "
        "CAST(date_trunc('month', max(ds)) AS DATE) AS month_start, "
        "CAST(date_trunc('year', max(ds)) AS DATE) AS year_start FROM t",
        "high_value_limit": "SELECT min(amount_vnd) AS threshold, count(*) AS row_count "
        f"FROM t WHERE amount_vnd >= {P95}",
        "sorted_report": "SELECT *, row_number() OVER (ORDER BY total_amount_vnd DESC, merchant_city, "
        f"merchant_state) AS place FROM ({bodies['city_analysis_year']})",
        "high_value_approx_limit": "SELECT true AS within",
        "moved_weekdays": bodies["weekday_vs_weekend"],
        "shared_moved_weekdays": bodies["weekday_vs_weekend"],
        "row_count": "SELECT count(*) AS row_count FROM t",
        "published_files": published_body(),
    }
    same_rate = f"SELECT {CLEAN_ROW}, amount_vnd FROM t"
    each_once = f"""
SELECT user_id, strftime(ts, '%H:%M:00') AS time, CASE WHEN rate IS NOT NULL THEN ds END AS ds,
  CASE WHEN rate IS NULL THEN 'rejected' ELSE 'clean' END AS outcome FROM ({CONVERTED})"""
    events = {
        "clean_from_json": same_rate,
        "clean_from_csv": same_rate,
        "ingest_stream": f"SELECT {CLEAN_ROW}, converted AS amount_vnd "
        f"FROM ({CONVERTED}) WHERE rate IS NOT NULL",
        "fx_conversion": "SELECT user_id, strftime(ts, '%H:%M:00') AS time, ds, "
        f"CAST(rate AS DOUBLE) AS vnd_per_usd, converted AS amount_vnd FROM ({CONVERTED})",
        "ingest_outcomes": f"""
SELECT CASE WHEN reason = 'none' THEN 'clean' ELSE 'rejected' END AS outcome, reason,
  count(*) AS row_count
FROM (SELECT CASE WHEN event_id % 11 = 0 THEN 'malformed_message'
        WHEN event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0 OR event_id % 23 = 0 THEN 'no_date'
        WHEN event_id % 29 = 0 THEN 'amount_out_of_range'
        WHEN event_id % 31 = 0 THEN 'amount_not_a_number'
        WHEN rate IS NULL THEN 'no_rate' ELSE 'none' END AS reason
      FROM ({CONVERTED}))
GROUP BY 1, 2""",
        "csv_outcomes": """
SELECT CASE WHEN ragged THEN 'rejected' ELSE 'clean' END AS outcome,
  CASE WHEN ragged THEN 'malformed_message' ELSE 'none' END AS reason,
  CASE WHEN NOT ragged THEN merchant_city END AS merchant_city,
  CASE WHEN NOT ragged THEN merchant_state END AS merchant_state, count(*) AS row_count,
  CAST(sum(CASE WHEN NOT ragged THEN amount_vnd END) AS BIGINT) AS total_vnd
FROM (SELECT *, event_id % 7 = 0 OR event_id % 11 = 0 AS ragged FROM t) GROUP BY ALL""",
        "sent_messages": same_rate,
        "rates_from_json": "SELECT user_id, strftime(ts, '%H:%M:00') AS time, ds, "
        "CAST(25000 + day(ts) * 10 AS DOUBLE) AS vnd_per_usd, "
        "CAST(round(amount_usd * CAST(25000 + day(ts) * 10 AS DECIMAL(18,4))) AS BIGINT) AS amount_vnd FROM t",
        "incremental_daily_summary": bodies["daily_summary"],
        "kept_merchant_analysis_month": bodies["merchant_analysis_month"],
        "kept_high_value_analysis_month": bodies["high_value_analysis_month"],
        "replayed_stream": each_once,
        "retaken_records": each_once,
        "compacted_lake": same_rate,
        "batch_counts": """
SELECT 'b' || (event_id % 7) AS batch,
  CAST(count(*) FILTER (WHERE event_id % 7 <> 3) AS BIGINT) AS accepted,
  CAST(count(*) FILTER (WHERE event_id % 7 = 3) AS BIGINT) AS refused
FROM t GROUP BY 1""",
    }
    return {key: over(LINEITEM, body) for key, body in lineitem.items()} | {
        key: over(EVENTS, body) for key, body in events.items()
    }

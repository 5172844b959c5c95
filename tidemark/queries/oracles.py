"""The same answers as plain SQL for another engine, straight from the definitions.

Windows are written as range joins from each row to the events inside its window, with
nothing shared with the tiled way the library computes them.
"""

from __future__ import annotations

TXN = """txn AS (
  SELECT event_id, 'user_' || CAST(user_id AS VARCHAR) AS user_id,
         'm_' || regexp_extract(props, '[0-9]+', 0) AS merchant,
         ts AS "timestamp", value AS amt,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_fraud
  FROM events)"""

CUST = """cust AS (
  SELECT 'user_' || CAST(user_id AS VARCHAR) AS user_id,
         (3 + event_id % 5) * 1000000000000 + event_id AS cc_num,
         ts AS signup_timestamp
  FROM events WHERE event_type = 'signup')"""

ISSUER = """CASE substring(CAST(cc_num AS VARCHAR), 1, 1)
  WHEN '4' THEN 'Visa' WHEN '5' THEN 'MasterCard' WHEN '6' THEN 'Discover'
  ELSE 'other' END"""

CARDS = f"""{CUST}, cards AS (
  SELECT user_id, cc_num, signup_timestamp, {ISSUER} AS issuer,
         date_trunc('day', signup_timestamp) + INTERVAL 1 DAY AS effective_ts
  FROM cust),
daily AS (
  SELECT user_id, effective_ts, max(signup_timestamp) AS signup_timestamp,
         arg_max(issuer, signup_timestamp) AS issuer
  FROM cards GROUP BY user_id, effective_ts)"""

ORACLES: dict[str, str] = {}


def windows(name: str, key: str, interval: str, columns: dict[str, tuple[str, str]],
            spine: str = "SELECT event_id, user_id, merchant, \"timestamp\" AS t FROM txn") -> str:
    """A CTE: per spine row, expressions over the events of trailing windows.

    ``columns`` maps a name to an aggregate with ``{}`` for the window's condition,
    and the window's length.
    """
    longest = f"greatest({', '.join(f'INTERVAL {w}' for _, w in columns.values())})"
    outs = ",\n    ".join(
        f"{agg.format(f'f.{chr(34)}timestamp{chr(34)} >= s.b - INTERVAL {w}')} AS {column}"
        for column, (agg, w) in columns.items()
    )
    return f"""{name} AS (
  SELECT s.event_id, {outs}
  FROM (SELECT *, time_bucket(INTERVAL {interval}, t) AS b FROM ({spine})) s
  LEFT JOIN txn f ON f.{key} = s.{key} AND f."timestamp" < s.b
    AND f."timestamp" >= s.b - {longest}
  GROUP BY s.event_id)"""


def amount_columns(windows_: list[str], functions=("mean", "sum")) -> dict[str, tuple[str, str]]:
    lengths = {"1h": "1 HOUR", "12h": "12 HOUR", "1d": "1 DAY", "3d": "3 DAY"}
    sql = {"mean": "round(avg(f.amt) FILTER ({}), 6)", "sum": "round(sum(f.amt) FILTER ({}), 6)"}
    return {
        f"amt_{f}_{w}_10m": (sql[f], lengths[w]) for f in functions for w in windows_
    }


def prefixed(view: str, columns) -> str:
    return ", ".join(f"{view}.{c} AS {view}__{c}" for c in columns)


ALL = ["1h", "12h", "1d", "3d"]
MINUTES = {"15m": "15 MINUTE", "30m": "30 MINUTE", "1h": "1 HOUR"}
AMOUNTS = amount_columns(ALL)
DAYS = {"1d": "1 DAY", "7d": "7 DAY", "30d": "30 DAY", "90d": "90 DAY"}
COUNTS = {f"event_id_count_{w}_1d": ("count(f.event_id) FILTER ({})", DAYS[w]) for w in ("1d", "7d", "30d")}
RATES = {
    f"is_fraud_mean_{w}_1d": ("round(avg(f.is_fraud) FILTER ({}), 6)", DAYS[w])
    for w in ("1d", "30d", "90d")
}
VARIETY = {"merchant_distinct_30d_1d": ("count(DISTINCT f.merchant) FILTER ({})", "30 DAY")}

# -- windows ----------------------------------------------------------------

OVER = {f"over_50_count_{w}_5m": ("count(*) FILTER (f.amt > 50 AND {})", n) for w, n in MINUTES.items()}
FLAGS = {f"over_50_count_{w}_5m": ("count(f.event_id) FILTER ({})", n) for w, n in MINUTES.items()}
FLAGS |= {
    f"over_50_sum_{w}_5m": ("CAST(sum(CAST(f.amt > 50 AS INT)) FILTER ({}) AS BIGINT)", n)
    for w, n in MINUTES.items()
}

ORACLES["flagship_over50_counts"] = f"""WITH {TXN}, {windows('w', 'user_id', '5 MINUTE', OVER)}
SELECT w.*, txn.user_id, txn."timestamp" FROM w JOIN txn USING (event_id)"""
ORACLES["stream_asof"] = f"""WITH {TXN}, {windows('w', 'user_id', '5 MINUTE', OVER)}
SELECT * FROM w"""
ORACLES["over50_literal_count"] = f"""WITH {TXN}, {windows('w', 'user_id', '5 MINUTE', FLAGS)}
SELECT * FROM w"""
ORACLES["amount_metrics"] = f"""WITH {TXN}, {windows('w', 'user_id', '10 MINUTE', AMOUNTS)}
SELECT * FROM w"""
ORACLES["from_source_parity"] = ORACLES["amount_metrics"]
ORACLES["partly_loaded_store"] = ORACLES["amount_metrics"]
ORACLES["store_after_redeclaration"] = ORACLES["amount_metrics"]
ORACLES["store_compacted"] = ORACLES["amount_metrics"]
ORACLES["hybrid_store_stream"] = ORACLES["amount_metrics"]
LATE = windows("w", "user_id", "10 MINUTE", AMOUNTS).replace(
    "LEFT JOIN txn f ON", """LEFT JOIN txn f ON f."timestamp" >= TIMESTAMP '2024-01-15' AND"""
)
ORACLES["view_start_respected"] = f"""WITH {TXN}, {LATE}
SELECT * FROM w"""
ORACLES["adhoc_from_source"] = f"""WITH {TXN}, {windows('amounts', 'user_id', '10 MINUTE', AMOUNTS)}
SELECT event_id, {prefixed('amounts', AMOUNTS)} FROM amounts"""
ORACLES["user_txn_counts"] = f"""WITH {TXN}, {windows('w', 'user_id', '1 DAY', COUNTS)}
SELECT * FROM w"""
ORACLES["merchant_fraud_rate"] = f"""WITH {TXN}, {windows('w', 'merchant', '1 DAY', RATES)}
SELECT w.*, txn.merchant FROM w JOIN txn USING (event_id)"""
ORACLES["distinct_merchants_30d"] = f"""WITH {TXN}, {windows('w', 'user_id', '1 DAY', VARIETY)}
SELECT * FROM w"""
LAST = {
    "merchants": (
        """array_to_string((list(f.merchant ORDER BY f."timestamp" DESC) FILTER ({}))[1:10], ',')""",
        "14 DAY",
    )
}
ORACLES["last10_merchants_14d"] = f"""WITH {TXN}, {windows('w', 'user_id', '1 DAY', LAST)}
SELECT event_id, CASE WHEN merchants <> '' THEN merchants END AS merchants FROM w"""
DIFFERENT = f"""WITH {TXN}, visits AS (
  SELECT s.event_id, f.merchant, max(f."timestamp") AS t
  FROM (SELECT event_id, user_id, time_bucket(INTERVAL 1 DAY, "timestamp") AS b FROM txn) s
  JOIN txn f ON f.user_id = s.user_id AND f."timestamp" < s.b AND f."timestamp" >= s.b - INTERVAL 14 DAY
  WHERE f.merchant IS NOT NULL GROUP BY s.event_id, f.merchant),
lists AS (
  SELECT event_id, array_to_string((list(merchant ORDER BY t DESC, merchant DESC))[1:10], ',') AS merchants
  FROM visits GROUP BY event_id)
SELECT txn.event_id, merchants FROM txn LEFT JOIN lists USING (event_id)"""
ORACLES["last10_different_stores"] = DIFFERENT
ORACLES["stream_different_stores"] = DIFFERENT
EXTREMES = {
    f"amt_{f}_{w}_10m": (f"round({f}(f.amt) FILTER ({{}}), 6)", n)
    for f in ("min", "max") for w, n in (("1h", "1 HOUR"), ("3d", "3 DAY"))
}
ORACLES["amount_extremes"] = f"""WITH {TXN}, {windows('w', 'user_id', '10 MINUTE', EXTREMES)}
SELECT * FROM w"""
ORACLES["continuous_extremes"] = f"""WITH {TXN}
SELECT s.event_id,
  round(min(f.amt) FILTER (f."timestamp" > s."timestamp" - INTERVAL 1 HOUR), 6) AS amt_min_1h_continuous,
  round(min(f.amt), 6) AS amt_min_3d_continuous,
  round(max(f.amt) FILTER (f."timestamp" > s."timestamp" - INTERVAL 1 HOUR), 6) AS amt_max_1h_continuous,
  round(max(f.amt), 6) AS amt_max_3d_continuous
FROM txn s LEFT JOIN txn f ON f.user_id = s.user_id AND f."timestamp" <= s."timestamp"
  AND f."timestamp" > s."timestamp" - INTERVAL 3 DAY
GROUP BY s.event_id"""
USERS = {f"user_id_distinct_{w}_1d": ("count(DISTINCT f.user_id) FILTER ({})", DAYS[w]) for w in ("7d", "30d")}
ORACLES["approximate_users"] = f"""WITH {TXN}, {windows('w', 'merchant', '1 DAY', USERS)}
SELECT *, true AS within_7d, true AS within_30d FROM w"""
ORACLES["continuous_count_1h"] = f"""WITH {TXN}
SELECT s.event_id,
  count(f.amt) FILTER (f."timestamp" > s."timestamp" - INTERVAL 1 HOUR) AS amt_count_1h_continuous,
  round(sum(f.amt) FILTER (f."timestamp" > s."timestamp" - INTERVAL 1 HOUR), 6) AS amt_sum_1h_continuous,
  round(avg(f.amt), 6) AS amt_mean_3d_continuous
FROM txn s LEFT JOIN txn f ON f.user_id = s.user_id AND f."timestamp" <= s."timestamp"
  AND f."timestamp" > s."timestamp" - INTERVAL 3 DAY
GROUP BY s.event_id"""

ORACLES["continuous_stores"] = f"""WITH {TXN}
SELECT s.event_id,
  count(DISTINCT f.merchant) FILTER (f."timestamp" > s."timestamp" - INTERVAL 1 DAY)
    AS merchant_distinct_1d_continuous,
  count(DISTINCT f.merchant) AS merchant_distinct_7d_continuous,
  array_to_string((list(f.merchant ORDER BY f."timestamp" DESC))[1:5], ',') AS merchants
FROM txn s LEFT JOIN txn f ON f.user_id = s.user_id AND f."timestamp" <= s."timestamp"
  AND f."timestamp" > s."timestamp" - INTERVAL 7 DAY
GROUP BY s.event_id"""

LISTING = """SELECT k.merchant, k.b AS window_end,
  round(avg(f.is_fraud) FILTER (f."timestamp" >= k.b - INTERVAL 1 DAY), 6) AS is_fraud_mean_1d_1d,
  round(avg(f.is_fraud) FILTER (f."timestamp" >= k.b - INTERVAL 30 DAY), 6) AS is_fraud_mean_30d_1d,
  round(avg(f.is_fraud), 6) AS is_fraud_mean_90d_1d
FROM (SELECT merchant, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS b
      FROM (SELECT DISTINCT merchant FROM txn),
           (SELECT date_trunc('day', min("timestamp")) AS lo,
                   date_trunc('day', max("timestamp")) + INTERVAL 91 DAY AS hi FROM txn)) k
JOIN txn f ON f.merchant = k.merchant AND f."timestamp" < k.b AND f."timestamp" >= k.b - INTERVAL 90 DAY
GROUP BY k.merchant, k.b"""
ORACLES["merchant_rate_listing"] = f"WITH {TXN} {LISTING}"
ORACLES["merchant_rate_range"] = f"""WITH {TXN}
SELECT k.merchant, k.b AS window_end,
  round(avg(f.is_fraud) FILTER (f."timestamp" >= k.b - INTERVAL 1 DAY), 6) AS is_fraud_mean_1d_1d,
  round(avg(f.is_fraud), 6) AS is_fraud_mean_30d_1d, round(avg(f.is_fraud), 6) AS is_fraud_mean_90d_1d,
  k.b - INTERVAL 1 DAY >= TIMESTAMP '2024-01-08' AS window_complete_is_fraud_mean_1d_1d,
  false AS window_complete_is_fraud_mean_30d_1d, false AS window_complete_is_fraud_mean_90d_1d
FROM (SELECT DISTINCT merchant, unnest(generate_series(TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-21',
        INTERVAL 1 DAY)) AS b FROM txn) k
JOIN txn f ON f.merchant = k.merchant AND f."timestamp" < k.b AND f."timestamp" >= TIMESTAMP '2024-01-08'
GROUP BY k.merchant, k.b"""
ORACLES["merchant_rate_top50"] = f"""WITH {TXN}
SELECT merchant, date_trunc('day', "timestamp") + INTERVAL 1 DAY AS window_end,
  round(avg(is_fraud), 6) AS is_fraud_mean_1d_1d
FROM txn GROUP BY ALL ORDER BY avg(is_fraud) DESC NULLS LAST, merchant, window_end LIMIT 50"""
ORACLES["sliding_1h_by_5m"] = f"""WITH {TXN}
SELECT user_id, b AS window_end, count(amt) AS amt_count_1h_5m
FROM (SELECT user_id, amt, unnest(generate_series(
        time_bucket(INTERVAL 5 MINUTE, "timestamp") + INTERVAL 5 MINUTE,
        time_bucket(INTERVAL 5 MINUTE, "timestamp") + INTERVAL 1 HOUR, INTERVAL 5 MINUTE)) AS b
      FROM txn) GROUP BY user_id, b"""
ORACLES["distinct_window_emitted"] = f"""WITH {TXN}
SELECT user_id, TIMESTAMP '2024-01-31' AS window_end, count(DISTINCT merchant) AS merchant_distinct_30d_1d
FROM txn WHERE "timestamp" < TIMESTAMP '2024-01-31' AND "timestamp" >= TIMESTAMP '2024-01-01'
GROUP BY user_id"""
ORACLES["staleness_invariant"] = """SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_mismatches,
  max(epoch_us(ts) - epoch_us(time_bucket(INTERVAL 5 MINUTE, ts))) AS oldest_micros FROM events"""
ORACLES["merchant_rate_widened"] = f"""WITH {TXN}
SELECT k.merchant, k.b AS window_end,
  round(avg(f.is_fraud) FILTER (f."timestamp" >= k.b - INTERVAL 1 DAY), 6) AS is_fraud_mean_1d_1d,
  round(avg(f.is_fraud) FILTER (f."timestamp" >= k.b - INTERVAL 30 DAY), 6) AS is_fraud_mean_30d_1d,
  round(avg(f.is_fraud), 6) AS is_fraud_mean_90d_1d
FROM (SELECT DISTINCT merchant, unnest(generate_series(TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-21',
        INTERVAL 1 DAY)) AS b FROM txn) k
JOIN txn f ON f.merchant = k.merchant AND f."timestamp" < k.b AND f."timestamp" >= k.b - INTERVAL 90 DAY
GROUP BY k.merchant, k.b"""
ORACLES["string_times"] = ORACLES["amount_metrics"]
ORACLES["customer_spend_windows"] = """SELECT s.o_orderkey,
  round(sum(f.o_totalprice), 6) AS o_totalprice_sum_365d_1d,
  count(f.o_totalprice) FILTER (f.o_orderdate >= date_trunc('day', s.o_orderdate) - INTERVAL 90 DAY)
    AS o_totalprice_count_90d_1d,
  count(DISTINCT f.o_orderpriority) AS o_orderpriority_distinct_365d_1d
FROM orders s LEFT JOIN orders f ON f.o_custkey = s.o_custkey
  AND f.o_orderdate < date_trunc('day', s.o_orderdate)
  AND f.o_orderdate >= date_trunc('day', s.o_orderdate) - INTERVAL 365 DAY
GROUP BY s.o_orderkey"""

# -- rows as of a time ------------------------------------------------------

ORACLES["card_issuer"] = f"""WITH {CUST}
SELECT cc_num, user_id, {ISSUER} AS issuer, signup_timestamp FROM cust"""
ORACLES["card_issuer_history"] = f"""WITH {CARDS}
SELECT user_id, signup_timestamp, issuer, effective_ts FROM cards
WHERE signup_timestamp >= TIMESTAMP '2024-01-05' AND signup_timestamp < TIMESTAMP '2024-01-25'"""
ORACLES["sql_view_over50"] = f"""WITH {TXN}
SELECT event_id, user_id, "timestamp", CASE WHEN amt > 50 THEN 1 ELSE 0 END AS over_50 FROM txn"""
ORACLES["stream_preview"] = ORACLES["sql_view_over50"]
ORACLES["asof_plain"] = f"""WITH {TXN}, {CARDS}
SELECT txn.event_id, txn.user_id, cards.cc_num, cards.issuer
FROM txn ASOF LEFT JOIN cards
  ON txn.user_id = cards.user_id AND txn."timestamp" >= cards.signup_timestamp"""
ORACLES["stream_row_history"] = ORACLES["asof_plain"]
AGED = 'daily.signup_timestamp > txn."timestamp" - INTERVAL 10 DAY'
CARD_ASOF = f"""card AS (
  SELECT txn.event_id, CASE WHEN {AGED} THEN daily.issuer END AS issuer,
         CASE WHEN {AGED} THEN daily.effective_ts END AS effective_ts
  FROM txn ASOF LEFT JOIN daily
    ON txn.user_id = daily.user_id AND txn."timestamp" >= daily.effective_ts)"""
ORACLES["asof_card_issuer"] = f"""WITH {TXN}, {CARDS}, {CARD_ASOF}
SELECT event_id, txn.user_id, issuer, effective_ts FROM txn JOIN card USING (event_id)"""
ORACLES["asof_order_ties"] = """WITH best AS (
  SELECT o_custkey, o_orderdate, max(o_totalprice) AS p,
         arg_max(o_orderstatus, o_totalprice) AS st FROM orders GROUP BY ALL)
SELECT s.o_orderkey, s.o_custkey, s.asked, best.p AS latest_o_totalprice, best.st AS latest_o_orderstatus
FROM (SELECT *, o_orderdate + INTERVAL 30 DAY AS asked FROM orders) s
ASOF LEFT JOIN best ON s.o_custkey = best.o_custkey AND s.asked >= best.o_orderdate"""
ORACLES["score_at_fixed_now"] = f"""WITH {TXN}, {CARDS},
issued AS (SELECT user_id, max(signup_timestamp) AS signed_up, arg_max(issuer, signup_timestamp) AS issuer
  FROM cards WHERE effective_ts <= TIMESTAMP '2024-01-26 12:00:00' GROUP BY user_id),
spent AS (SELECT user_id, round(sum(amt), 6) AS s FROM txn
  WHERE "timestamp" < TIMESTAMP '2024-01-26 12:00:00'
    AND "timestamp" >= TIMESTAMP '2024-01-23 12:00:00' GROUP BY user_id)
SELECT event_id,
  CASE WHEN signed_up > TIMESTAMP '2024-01-16 12:00:00' THEN issuer END AS card__issuer,
  s AS amounts__amt_sum_3d_10m
FROM txn LEFT JOIN issued USING (user_id) LEFT JOIN spent USING (user_id)"""
ORACLES["view_contract_report"] = f"""WITH {CUST}
SELECT count(*) AS n_rows, count(*) FILTER (user_id IS NULL) AS null_user_id,
  count(*) FILTER (signup_timestamp IS NULL) AS null_signup_timestamp FROM cust"""

# -- services ---------------------------------------------------------------

ONE_COUNT = {"event_id_count_1d_1d": COUNTS["event_id_count_1d_1d"]}
ORACLES["service_training"] = f"""WITH {TXN}, {CARDS}, {CARD_ASOF},
{windows('amounts', 'user_id', '10 MINUTE', AMOUNTS)},
{windows('txn_counts', 'user_id', '1 DAY', ONE_COUNT)},
{windows('merchant_fraud', 'merchant', '1 DAY', RATES)},
{windows('variety', 'user_id', '1 DAY', VARIETY)}
SELECT txn.event_id, txn.user_id, txn.merchant, txn."timestamp", txn.amt, txn.is_fraud,
  {prefixed('amounts', AMOUNTS)}, {prefixed('txn_counts', ONE_COUNT)},
  {prefixed('merchant_fraud', RATES)}, {prefixed('variety', VARIETY)},
  txn.amt > coalesce(amt_mean_3d_10m, 0) AS amount_check__above_mean, card.issuer AS card__issuer
FROM txn JOIN amounts USING (event_id) JOIN txn_counts USING (event_id)
  JOIN merchant_fraud USING (event_id) JOIN variety USING (event_id) JOIN card USING (event_id)"""
FEW = {c: AMOUNTS[c] for c in ("amt_mean_1h_10m", "amt_mean_3d_10m", "amt_sum_1h_10m", "amt_sum_3d_10m")}
ORACLES["service_variant"] = f"""WITH {TXN},
{windows('amounts', 'user_id', '10 MINUTE', FEW)},
{windows('txn_counts', 'user_id', '1 DAY', COUNTS)},
{windows('merchant_fraud', 'merchant', '1 DAY', RATES)}
SELECT txn.event_id, txn.user_id, txn.merchant, txn."timestamp", txn.is_fraud,
  {prefixed('amounts', FEW)}, {prefixed('txn_counts', COUNTS)}, {prefixed('merchant_fraud', RATES)}
FROM txn JOIN amounts USING (event_id) JOIN txn_counts USING (event_id)
  JOIN merchant_fraud USING (event_id)"""
WEEK = {"event_id_count_7d_1d": COUNTS["event_id_count_7d_1d"]}
ORACLES["service_effective_times"] = f"""WITH {TXN}, {CARDS}, {CARD_ASOF},
{windows('txn_counts', 'user_id', '1 DAY', WEEK)}
SELECT txn.event_id, card.issuer AS card__issuer, c.issuer AS card_now__issuer,
  {prefixed('txn_counts', WEEK)}, card.effective_ts AS card__effective_ts,
  c.signup_timestamp AS card_now__effective_ts,
  date_trunc('day', txn."timestamp") AS txn_counts__effective_ts
FROM txn ASOF LEFT JOIN cards c ON txn.user_id = c.user_id AND txn."timestamp" >= c.signup_timestamp
  JOIN card ON card.event_id = txn.event_id JOIN txn_counts ON txn_counts.event_id = txn.event_id"""
MEAN = amount_columns(["3d"], ("mean",))
for mode in ("native", "pandas", "python"):
    ORACLES[f"on_demand_{mode}"] = f"""WITH {TXN}, {windows('amounts', 'user_id', '10 MINUTE', MEAN)}
SELECT event_id, amt_mean_3d_10m AS amounts__amt_mean_3d_10m,
  amt > coalesce(amt_mean_3d_10m, 0) AS amount_check__above_mean
FROM txn JOIN amounts USING (event_id)"""
ORACLES["on_demand_run"] = f"""WITH {TXN}
SELECT event_id, amt > CASE WHEN is_fraud = 1 THEN 75 ELSE 0 END AS above_mean FROM txn"""

# -- stored history ---------------------------------------------------------

ORACLES["training_period"] = f"""WITH {TXN}, {CARDS}, {CARD_ASOF},
{windows('amounts', 'user_id', '10 MINUTE', MEAN)}
SELECT txn.event_id, {prefixed('amounts', MEAN)}, card.issuer AS card__issuer
FROM txn JOIN amounts USING (event_id) JOIN card USING (event_id)
WHERE txn."timestamp" >= TIMESTAMP '2024-01-20' AND txn."timestamp" < TIMESTAMP '2024-01-27'"""
ORACLES["incremental_day"] = f"""WITH {TXN}
SELECT user_id, time_bucket(INTERVAL 10 MINUTE, "timestamp") AS tile_start,
  count(amt) AS n_amt, round(sum(amt), 6) AS s_amt
FROM txn WHERE "timestamp" >= TIMESTAMP '2024-01-15' AND "timestamp" < TIMESTAMP '2024-01-16'
GROUP BY ALL"""
ORACLES["coverage_report"] = f"""WITH {TXN}
SELECT event_id, time_bucket(INTERVAL 5 MINUTE, "timestamp") AS boundary FROM txn
WHERE time_bucket(INTERVAL 5 MINUTE, "timestamp") > TIMESTAMP '2024-01-25'
  OR time_bucket(INTERVAL 5 MINUTE, "timestamp") > TIMESTAMP '2024-01-10'
  AND time_bucket(INTERVAL 5 MINUTE, "timestamp") < TIMESTAMP '2024-01-12'"""
ORACLES["partition_pruned_spine"] = f"""WITH {TXN}
SELECT event_id, user_id, merchant, "timestamp", amt, '01' AS partition_1, '15' AS partition_2
FROM txn WHERE date_trunc('day', "timestamp") = TIMESTAMP '2024-01-15'"""

# -- lookups ----------------------------------------------------------------

NEWEST = f"""{TXN}, {CARDS},
issued AS (SELECT user_id, max(effective_ts) AS e, max(signup_timestamp) AS signed_up,
  arg_max(issuer, signup_timestamp) AS issuer FROM cards GROUP BY user_id),
recent AS (SELECT user_id, round(avg(amt), 6) AS m,
  round(sum(amt) FILTER ("timestamp" >= TIMESTAMP '2024-01-30'), 6) AS s
  FROM txn WHERE "timestamp" >= TIMESTAMP '2024-01-28' AND "timestamp" < TIMESTAMP '2024-01-31'
  GROUP BY user_id)"""
FRESH = "signed_up > TIMESTAMP '2024-01-21'"
ORACLES["latest_lookup"] = f"""WITH {NEWEST}
SELECT event_id, user_id, amt, CASE WHEN {FRESH} THEN issuer END AS card__issuer,
  CASE WHEN {FRESH} THEN e END AS card__effective_ts,
  m AS amounts__amt_mean_3d_10m, s AS amounts__amt_sum_1d_10m
FROM txn LEFT JOIN issued USING (user_id) LEFT JOIN recent USING (user_id)"""
ORACLES["latest_published"] = ORACLES["latest_lookup"]
ORACLES["latest_published_twice"] = ORACLES["latest_lookup"]
ORACLES["latest_vector"] = f"""WITH {NEWEST}
SELECT event_id, 'card__issuer' AS name, CASE WHEN {FRESH} THEN issuer END AS value
FROM txn LEFT JOIN issued USING (user_id)
UNION ALL SELECT event_id, 'user_id', user_id FROM txn"""
ORACLES["lookup_parity"] = """SELECT count(*) AS n_rows,
  CAST(0 AS BIGINT) AS n_mismatches FROM events"""
ORACLES["on_demand_lookup"] = f"""WITH {NEWEST}
SELECT event_id, m AS amounts__amt_mean_3d_10m, amt > coalesce(m, 0) AS amount_check__above_mean
FROM txn LEFT JOIN recent USING (user_id)"""
ORACLES["latest_windows"] = f"""WITH {TXN}
SELECT user_id,
  count(DISTINCT merchant) FILTER ("timestamp" >= TIMESTAMP '2024-01-24') AS merchant_distinct_7d_1h,
  array_to_string((list(merchant ORDER BY "timestamp" DESC))[1:3], ',') AS merchant_last3_14d_1h,
  count(amt) FILTER ("timestamp" >= TIMESTAMP '2024-01-30') AS amt_count_1d_1h,
  round(avg(amt) FILTER ("timestamp" >= TIMESTAMP '2024-01-24'), 6) AS amt_mean_7d_1h
FROM txn WHERE "timestamp" < TIMESTAMP '2024-01-31' AND "timestamp" >= TIMESTAMP '2024-01-17'
GROUP BY user_id"""

# -- streams and pushed events ----------------------------------------------

ORACLES["stream_tiles_5m"] = f"""WITH {TXN}
SELECT user_id, time_bucket(INTERVAL 5 MINUTE, "timestamp") AS tile_start,
  count(*) AS n_over_50, CAST(sum(CAST(amt > 50 AS INT)) AS BIGINT) AS s_over_50
FROM txn GROUP BY ALL"""
ORACLES["stream_tiles_shuffled"] = ORACLES["stream_tiles_5m"]
NOON = "TIMESTAMP '2024-01-20 12:00:00'"
AT_NOON = ", ".join(
    agg.format(f"""f."timestamp" >= {NOON} - INTERVAL {w}""") + f" AS {c}" for c, (agg, w) in AMOUNTS.items()
)
ORACLES["stream_latest_counts"] = f"""WITH {TXN}
SELECT user_id, {AT_NOON} FROM txn f
WHERE f."timestamp" < {NOON} AND f."timestamp" >= {NOON} - INTERVAL 3 DAY GROUP BY user_id"""
ORACLES["stream_latest_card"] = f"""WITH {CARDS}
SELECT user_id, max(signup_timestamp) AS signup_timestamp, arg_max(cc_num, signup_timestamp) AS cc_num,
  arg_max(issuer, signup_timestamp) AS issuer FROM cards GROUP BY user_id"""
ORACLES["ingest_explode"] = """SELECT date_trunc('second', ts) AS "timestamp",
  'user_' || CAST(user_id AS VARCHAR) AS user_id, CAST(clicked AS INT) AS clicked, count(*) AS n
FROM (SELECT ts, user_id, 1 AS clicked FROM events WHERE event_type <> 'signup'
      UNION ALL SELECT ts, user_id, event_id % 5 FROM events
      WHERE event_type NOT IN ('signup', 'error'))
GROUP BY ALL"""
ORACLES["ingest_dry_run"] = """SELECT source, event_type = 'signup' AS dry_run,
  count(*) FILTER (good) AS n_good, count(*) FILTER (NOT good) AS n_bad
FROM (SELECT 'clicks' AS source, event_type, true AS good FROM events
      UNION ALL SELECT 'user_clicks', event_type, true FROM events
      UNION ALL SELECT 'user_clicks', event_type, event_type <> 'error' FROM events)
GROUP BY ALL"""
ORACLES["ingest_rejects"] = """SELECT kind, count(*) AS n FROM (
  SELECT 'clicks' AS kind FROM events WHERE event_type <> 'signup'
  UNION ALL SELECT 'user_clicks' FROM events WHERE event_type <> 'signup'
  UNION ALL SELECT CASE WHEN event_type = 'error' THEN 'does not fit' ELSE 'user_clicks' END FROM events
    WHERE event_type <> 'signup'
  UNION ALL SELECT CASE WHEN event_id % 3 = 2 THEN 'unknown source' ELSE 'malformed' END FROM events
) GROUP BY kind"""
ORACLES["stream_ingest_tiles"] = """SELECT event_type AS content_keyword,
  date_trunc('hour', ts) AS tile_start, count(*) AS n_clicked,
  CAST(sum(event_id % 5) AS BIGINT) AS s_clicked
FROM events WHERE event_type <> 'signup' GROUP BY ALL"""

# -- export -----------------------------------------------------------------

ORACLES["export_csv_row"] = f"""WITH {TXN}
SELECT event_id, concat_ws(',', user_id, merchant, is_fraud) AS line FROM txn"""
ORACLES["export_joined_row"] = f"""WITH {TXN}
SELECT event_id, concat_ws('|', user_id, merchant, is_fraud) AS line FROM txn"""
ORACLES["export_json_row"] = f"""WITH {TXN}
SELECT event_id, '{{"user_id":"' || user_id || '","merchant":"' || merchant || '","is_fraud":'
  || CAST(is_fraud AS VARCHAR) || '}}' AS line FROM txn"""
ORACLES["export_csv_files"] = f"""WITH {TXN}
SELECT event_id, merchant, amt, "timestamp" FROM txn"""

ORACLES["service_from_stream"] = f"""SELECT a.*, c.cc_num AS card_now__cc_num, c.issuer AS card_now__issuer
FROM ({ORACLES['adhoc_from_source']}) a JOIN ({ORACLES['stream_row_history']}) c USING (event_id)"""

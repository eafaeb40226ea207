"""Common table expressions of the check SQL, written from the definitions, not from the jobs."""

from __future__ import annotations

from tidemark.sources.samples import CREDIT_CATEGORIES, CREDIT_NUMBERS

TX = """tx AS (
  SELECT event_id AS transaction_id, ts AS tx_datetime, user_id AS customer_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS terminal_id,
         CAST(value AS DECIMAL(18,2)) AS tx_amount,
         CAST(date_diff('second', TIMESTAMP '2024-01-01 00:00:00', date_trunc('second', ts)) AS BIGINT) AS tx_time_seconds,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS tx_time_days,
         CAST(CASE WHEN event_type = 'error' AND value > 100 THEN 1 ELSE 0 END AS BIGINT) AS tx_fraud,
         CAST(CASE WHEN event_type = 'error' AND value > 100 THEN 1 ELSE 0 END AS BIGINT) AS tx_fraud_scenario,
         CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS tx_during_weekend,
         CASE WHEN hour(ts) < 6 OR hour(ts) > 20 THEN 1 ELSE 0 END AS tx_during_night
  FROM events)"""


def days(last_day: bool = True) -> str:
    """All days of the data; without the last one there is one row per crossed midnight."""
    return f"""bounds AS (SELECT min(CAST(tx_datetime AS DATE)) AS d0, max(CAST(tx_datetime AS DATE)) AS d1 FROM tx),
days AS (SELECT CAST(d0 + CAST(i AS INTEGER) AS DATE) AS tx_date
         FROM bounds, generate_series(0, date_diff('day', (SELECT d0 FROM bounds), (SELECT d1 FROM bounds)) - {0 if last_day else 1}) g(i))"""


DAYS = days()

CUST_DAY = """cust_day AS (SELECT customer_id, tx_date FROM days CROSS JOIN (SELECT DISTINCT customer_id FROM tx)),
cust_daily AS (
  SELECT s.customer_id, s.tx_date, SUM(COALESCE(t.tx_amount, 0)) AS tot_amount,
         CAST(SUM(CASE WHEN t.tx_amount > 0 THEN 1 ELSE 0 END) AS BIGINT) AS no_trx
  FROM tx t RIGHT JOIN cust_day s ON t.customer_id = s.customer_id AND CAST(t.tx_datetime AS DATE) = s.tx_date
  GROUP BY s.customer_id, s.tx_date),
cust_feat AS (
  SELECT *, lag(no_trx, 1) OVER w AS cust_tx_prev_1, lag(tot_amount, 1) OVER w AS cust_tot_amt_prev_1,
         CAST(SUM(no_trx) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS BIGINT) AS cust_tx_prev_7,
         CAST(SUM(no_trx) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS BIGINT) AS cust_tx_prev_30,
         SUM(tot_amount) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS cust_tot_amt_prev_7,
         SUM(tot_amount) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS cust_tot_amt_prev_30
  FROM cust_daily WINDOW w AS (PARTITION BY customer_id ORDER BY tx_date))"""


def term_day(literal: bool) -> str:
    """Terminal days; the literal form gives the 7-day columns the 1-day frame."""
    week = 8 if literal else 14
    sums = ",\n         ".join(
        f"CAST(SUM({source}) OVER (w ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING) AS BIGINT) AS {name}{suffix}"
        for suffix, rows in (("", 7), ("_window_1", 8), ("_window_7", week), ("_window_30", 37))
        for source, name in (("no_trx", "nb_tx_delay"), ("nb_fraud", "nb_fraud_delay"))
    )
    return f"""term_day AS (SELECT terminal_id, tx_date FROM days CROSS JOIN (SELECT DISTINCT terminal_id FROM tx)),
term_daily AS (
  SELECT s.terminal_id, s.tx_date, CAST(SUM(COALESCE(t.tx_fraud, 0)) AS BIGINT) AS nb_fraud,
         CAST(SUM(CASE WHEN t.tx_fraud IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS no_trx
  FROM tx t RIGHT JOIN term_day s ON t.terminal_id = s.terminal_id AND CAST(t.tx_datetime AS DATE) = s.tx_date
  GROUP BY s.terminal_id, s.tx_date),
term_feat AS (
  SELECT *, {sums}
  FROM term_daily WINDOW w AS (PARTITION BY terminal_id ORDER BY tx_date))"""


def features(literal: bool, last_day: bool = True) -> str:
    """The whole feature table, on dense calendars and row frames."""
    cust = ",\n         ".join(
        f"COALESCE(cust_tx_prev_{w}, 0) + cur_n AS cust_cnt_tx_{w}, "
        f"CAST(COALESCE(cust_tot_amt_prev_{w}, 0) + cur_amt AS DOUBLE) / (COALESCE(cust_tx_prev_{w}, 0) + cur_n) AS cust_avg_amount_{w}"
        for w in (1, 7, 30)
    )
    shifted = ",\n         ".join(
        f"(nb_tx_delay_window_{w} + cur_tx) - (nb_tx_delay + cur_tx) AS nb_tx_window_{w}, "
        f"(nb_fraud_delay_window_{w} + cur_fraud) - (nb_fraud_delay + cur_fraud) AS fraud_{w}"
        for w in (1, 7, 30)
    )
    risk = ",\n         ".join(
        f"nb_tx_window_{w}, CASE WHEN fraud_{w} > 0 THEN CAST(fraud_{w} AS DOUBLE) / nb_tx_window_{w} ELSE 0.0 END AS term_risk_{w}"
        for w in (1, 7, 30)
    )
    cust_cols = ", ".join(f"cust_avg_amount_{w}, cust_cnt_tx_{w}" for w in (1, 7, 30))
    return f"""{TX},
{days(last_day)},
{CUST_DAY},
{term_day(literal)},
cust_now AS (
  SELECT t.*, f.* EXCLUDE (customer_id, tx_date, tot_amount, no_trx),
         COUNT(t.customer_id) OVER w AS cur_n, SUM(t.tx_amount) OVER w AS cur_amt
  FROM tx t JOIN cust_feat f ON t.customer_id = f.customer_id AND CAST(t.tx_datetime AS DATE) = f.tx_date
  WINDOW w AS (PARTITION BY t.customer_id, CAST(t.tx_datetime AS DATE) ORDER BY t.tx_datetime
               RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
behaviour AS (
  SELECT transaction_id, tx_datetime, customer_id, terminal_id, tx_time_seconds, tx_time_days, tx_amount,
         tx_fraud, tx_fraud_scenario, tx_during_weekend, tx_during_night, {cust}
  FROM cust_now),
term_now AS (
  SELECT b.*, f.* EXCLUDE (terminal_id, tx_date, nb_fraud, no_trx),
         COUNT(b.terminal_id) OVER w AS cur_tx, CAST(SUM(b.tx_fraud) OVER w AS BIGINT) AS cur_fraud
  FROM behaviour b JOIN term_feat f ON b.terminal_id = f.terminal_id AND CAST(b.tx_datetime AS DATE) = f.tx_date
  WINDOW w AS (PARTITION BY b.terminal_id, CAST(b.tx_datetime AS DATE) ORDER BY b.tx_datetime
               RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
shifted AS (SELECT *, {shifted} FROM term_now),
features AS (
  SELECT transaction_id, tx_datetime, customer_id, terminal_id, tx_time_seconds, tx_time_days,
         CAST(tx_amount AS DOUBLE) AS tx_amount, tx_fraud, tx_fraud_scenario, tx_during_weekend, tx_during_night,
         {cust_cols},
         {risk}
  FROM shifted)"""


def split_by_loop(source: str, start: str, train: int = 7, delay: int = 7, test: int = 7) -> str:
    """Training and test rows of ``source``, one test day after the other."""
    parts = [
        f"""study AS (SELECT * FROM {source} WHERE tx_datetime >= TIMESTAMP '{start}'
          AND tx_datetime <= TIMESTAMP '{start}' + INTERVAL {train + delay + test + 1} DAY)""",
        f"""train AS (SELECT * FROM study WHERE tx_datetime >= TIMESTAMP '{start}'
          AND tx_datetime <= TIMESTAMP '{start}' + INTERVAL {train} DAY)""",
        "first_day AS (SELECT min(tx_time_days) AS d FROM train)",
    ]
    pool = "SELECT customer_id FROM train WHERE tx_fraud = 1"
    for day in range(test):
        parts.append(
            f"""known_{day} AS ({pool} UNION SELECT customer_id FROM study, first_day
          WHERE tx_time_days = d + {train + day - 1} AND tx_fraud = 1)"""
        )
        parts.append(
            f"""test_{day} AS (SELECT s.* FROM study s, first_day
          WHERE tx_time_days = d + {train + delay + day} AND customer_id NOT IN (SELECT customer_id FROM known_{day}))"""
        )
        pool = f"SELECT customer_id FROM known_{day}"
    union = " UNION ".join(f"SELECT * FROM test_{day}" for day in range(test))
    parts.append(f"test AS ({union})")
    return ",\n".join(parts)


WEATHER = """weather AS (
  SELECT l_returnflag AS state, CAST(l_shipdate AS DATE) AS observation_date,
         CASE WHEN COUNT(*) > 1
              THEN CAST((CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) * 10) // COUNT(*) AS DOUBLE) / 10.0 END AS temp_avg_f
  FROM lineitem GROUP BY l_returnflag, CAST(l_shipdate AS DATE))"""

BOOKINGS = """bookings_1 AS (
  SELECT o_custkey AS id, o_orderkey AS booking_reference, o_orderpriority AS hotel,
         CAST(o_orderdate AS DATE) AS booking_date, CAST(round(o_totalprice * 100) AS BIGINT) AS cost
  FROM orders WHERE o_orderdate < TIMESTAMP '1998-07-01'),
bookings_2 AS (
  SELECT o_custkey AS id, o_orderkey AS booking_reference, o_orderpriority AS hotel,
         CAST(o_orderdate AS DATE) AS booking_date, CAST(round(o_totalprice * 100) AS BIGINT) AS cost
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-01'),
combined AS (
  SELECT *, 'bookings_1' AS source_relation FROM bookings_1
  UNION ALL BY NAME SELECT *, 'bookings_2' AS source_relation FROM bookings_2),
customers AS (
  SELECT c_custkey AS id, c_mktsegment AS first_name, c_name AS last_name,
         CAST(DATE '1970-01-01' + c_nationkey AS DATE) AS birthdate FROM customer),
prepped AS (
  SELECT a.id, first_name, last_name, birthdate, booking_reference, hotel, booking_date, cost
  FROM customers a JOIN combined b ON a.id = b.id)"""

_CREDIT_NUMBERS = ", ".join(
    f"CAST({low} + c_custkey * {factor} % {width} AS INTEGER) AS {name}" for name, low, factor, width in CREDIT_NUMBERS
)
_CREDIT_CATEGORIES = ", ".join(
    "CASE c_custkey // {} % {} {} END AS {}".format(
        step, len(values), " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)), name
    )
    for name, step, values in CREDIT_CATEGORIES
)
CREDIT = f"""credit AS (
  SELECT c_custkey AS credit_request_id, c_acctbal AS credit_amount, {_CREDIT_NUMBERS}, c_nationkey AS age,
         c_acctbal - 500 AS checking_balance, abs(c_acctbal) / 2 AS savings_balance,
         c_mktsegment AS purpose, r_name AS credit_standing, n_name AS housing, {_CREDIT_CATEGORIES}
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

MEMBERS = """members AS (
  SELECT c_custkey AS member_id, c_mktsegment = 'BUILDING' AS is_current_customer,
         c_nationkey AS years_tenure, CAST(floor(c_acctbal / 1000) AS INTEGER) AS average_weekly_workout_count
  FROM customer)"""

SPEND = """spend AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice AS spent, l_quantity AS session_length,
         l_discount AS time_on_app, l_tax AS time_on_website, CAST(l_linenumber AS DOUBLE) AS membership_length,
         CAST('0x' || substr(md5(l_orderkey || '|' || l_linenumber || '|101'), 1, 8) AS BIGINT) / 4294967296.0 < 0.7 AS in_train
  FROM lineitem)"""

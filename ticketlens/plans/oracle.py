"""Reference SQL (DuckDB dialect) for every registered query.

Each oracle is the same derivation written as plain SQL over the driver's tables: the CTEs below
define ``rides`` and the tables built from it, and each query appends its report SELECT.
"""

from __future__ import annotations


def hms(s: str) -> str:
    return (f"lpad(CAST(({s}) // 3600 AS VARCHAR), 2, '0') || ':' || "
            f"lpad(CAST((({s}) % 3600) // 60 AS VARCHAR), 2, '0') || ':' || "
            f"lpad(CAST(({s}) % 60 AS VARCHAR), 2, '0')")


def secs(t: str) -> str:
    return (f"(CASE WHEN regexp_matches({t}, '^([01]?[0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$') THEN "
            f"CAST(split_part({t}, ':', 1) AS INTEGER) * 3600 + CAST(split_part({t}, ':', 2) AS INTEGER) * 60 "
            f"+ CAST(split_part({t}, ':', 3) AS INTEGER) END)")


def r2(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,6)), 2) AS DOUBLE)"


def pct(part: str, total: str) -> str:
    return f"(100.0::DOUBLE * CAST({part} AS DOUBLE) / NULLIF(CAST({total} AS DOUBLE), 0))"


_A = "((((o_orderkey * 101) % 96) * 900 + 1800 + (o_custkey % 12) * 600) % 86400)"

CTES: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def cte(name: str, sql: str, deps: list[str] | None = None) -> None:
    CTES[name] = sql
    DEPS[name] = deps or []


cte("rides_k", f"""
SELECT 'T' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS transaction_id,
  CAST(o_orderdate AS DATE) AS date_of_purchase,
  {hms('(o_orderkey * 7919) % 86400')} AS time_of_purchase,
  CASE WHEN o_orderkey % 5 < 3 THEN 'Online' ELSE 'Station' END AS purchase_type,
  CASE o_custkey % 3 WHEN 0 THEN 'Credit Card' WHEN 1 THEN 'Contactless' ELSE 'Debit Card' END AS payment_method,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Adult' WHEN 'MACHINERY' THEN 'Senior' WHEN 'HOUSEHOLD' THEN 'Disabled' END AS railcard,
  CASE WHEN c_acctbal > 8000 THEN 'First Class' ELSE 'Standard' END AS ticket_class,
  CASE WHEN o_orderpriority < '3' THEN 'Advance' WHEN o_orderpriority < '4' THEN 'Anytime' ELSE 'Off-Peak' END AS ticket_type,
  CAST(o_totalprice AS DECIMAL(18,2)) AS price,
  n_name AS departure_station,
  'NATION_' || CAST(o_orderkey % 25 AS VARCHAR) AS arrival_destination,
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 29 AS INTEGER) AS date_of_journey,
  {hms('((o_orderkey * 101) % 96) * 900')} AS departure_time,
  {hms(_A)} AS arrival_time,
  CASE o_orderstatus WHEN 'F' THEN {hms(_A)} WHEN 'O' THEN {hms(f'({_A} + (1 + o_custkey % 180) * 60) % 86400')} END AS actual_arrival_time,
  CASE o_orderstatus WHEN 'F' THEN 'On Time' WHEN 'O' THEN 'Delayed' WHEN 'P' THEN 'Cancelled' END AS journey_status,
  CASE WHEN o_orderstatus <> 'F' THEN CASE o_custkey % 5 WHEN 0 THEN 'Weather' WHEN 1 THEN 'Technical Issue'
       WHEN 2 THEN 'Signal Failure' WHEN 3 THEN 'Staffing' WHEN 4 THEN 'Traffic' END END AS reason_for_delay,
  CASE WHEN o_orderstatus <> 'F' AND o_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS refund_request,
  o_orderkey AS order_key
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")

cte("rides", "SELECT * EXCLUDE (order_key) FROM rides_k", ["rides_k"])


def with_ctes(needed: list[str], body: str) -> str:
    """``WITH`` clause holding ``needed`` and their dependencies, in dependency order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in DEPS[n]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + body


# ---------------------------------------------------------------- derived tables (SQL side)

cte("rides_clean", """
SELECT transaction_id, date_of_purchase, time_of_purchase, purchase_type, payment_method,
  coalesce(railcard, 'No Railcard') AS railcard, ticket_class, ticket_type, price, departure_station,
  arrival_destination, date_of_journey, departure_time, arrival_time,
  coalesce(actual_arrival_time, arrival_time) AS actual_arrival_time, journey_status,
  coalesce(reason_for_delay, 'No Delay') AS reason_for_delay, refund_request
FROM rides""", ["rides"])

cte("ided", """
SELECT *, row_number() OVER (ORDER BY date_of_purchase NULLS FIRST, time_of_purchase NULLS FIRST,
                             transaction_id NULLS FIRST) AS row_id
FROM rides_clean""", ["rides_clean"])

cte("dim_location", """
SELECT CAST(row_number() OVER (ORDER BY station_name) AS INTEGER) AS station_id, station_name
FROM (SELECT departure_station AS station_name FROM rides UNION SELECT arrival_destination FROM rides) s
WHERE station_name IS NOT NULL""", ["rides"])

cte("dim_time", f"""
SELECT row_id AS time_id, date_of_purchase AS purchase_date, time_of_purchase,
  CAST(day(date_of_purchase) AS INTEGER) AS day, CAST(month(date_of_purchase) AS INTEGER) AS month,
  CAST(year(date_of_purchase) AS INTEGER) AS year,
  concat_ws('_', CAST(date_of_purchase AS VARCHAR), time_of_purchase) AS time_key,
  CAST({secs('time_of_purchase')} // 3600 AS INTEGER) AS hour_of_day
FROM ided""", ["ided"])

cte("dim_journey", f"""
SELECT row_id AS journey_id, date_of_journey AS journey_date, departure_time, arrival_time,
  actual_arrival_time, reason_for_delay,
  ({secs('arrival_time')} - {secs('departure_time')}) / 60.0::DOUBLE AS duration_time,
  greatest(0.0::DOUBLE, ({secs('actual_arrival_time')} - {secs('arrival_time')}) / 60.0::DOUBLE) AS delay_period,
  concat_ws('_', CAST(date_of_journey AS VARCHAR), departure_time) AS journey_key
FROM ided""", ["ided"])

cte("fact", """
SELECT i.transaction_id, purchase_type, payment_method, railcard, ticket_class, ticket_type, price,
  journey_status, d.station_id AS departure_station_id, a.station_id AS arrival_station_id,
  row_id AS time_id, row_id AS journey_id, refund_request
FROM ided i LEFT JOIN dim_location d ON i.departure_station = d.station_name
            LEFT JOIN dim_location a ON i.arrival_destination = a.station_name""",
    ["ided", "dim_location"])

cte("denorm", """
SELECT f.*, t.year, t.purchase_date, t.hour_of_day, j.journey_date, j.delay_period,
  j.reason_for_delay, d.station_name AS departure_station_name,
  a.station_name AS arrival_station_name, CAST(month(t.purchase_date) AS INTEGER) AS month,
  strftime(t.purchase_date, '%B') AS month_name
FROM fact f LEFT JOIN dim_time t ON f.time_id = t.time_id
  LEFT JOIN dim_journey j ON f.journey_id = j.journey_id
  LEFT JOIN dim_location d ON f.departure_station_id = d.station_id
  LEFT JOIN dim_location a ON f.arrival_station_id = a.station_id""",
    ["fact", "dim_time", "dim_journey", "dim_location"])

cte("sql_source", """
SELECT * REPLACE ('£' || format('{:,.2f}', CAST(price AS DOUBLE)) AS price,
                  coalesce(railcard, 'None') AS railcard,
                  coalesce(reason_for_delay, 'None') AS reason_for_delay)
FROM rides""", ["rides"])

cte("priced_rides", """
SELECT * REPLACE (
    CASE WHEN lower(journey_status) = 'on time' AND lower(reason_for_delay) = 'none' THEN 'No delay'
         ELSE reason_for_delay END AS reason_for_delay,
    CASE WHEN lower(railcard) = 'none' THEN 'No Card' ELSE railcard END AS railcard),
  CAST(TRY_CAST(replace(replace(price, '£', ''), ',', '') AS DECIMAL(10,0)) AS INTEGER) AS price2
FROM sql_source""", ["sql_source"])

cte("tickets", """
SELECT r.* EXCLUDE (order_key), l.l_linenumber AS line_number
FROM rides_k r JOIN lineitem l ON r.order_key = l.l_orderkey""", ["rides_k"])

cte("dim_time_b", """
SELECT row_number() OVER (ORDER BY purchase_date NULLS FIRST, time_of_purchase NULLS FIRST) AS time_id,
  purchase_date, time_of_purchase, purchase_date AS date, CAST(day(purchase_date) AS INTEGER) AS day,
  CAST(month(purchase_date) AS INTEGER) AS month, CAST(year(purchase_date) AS INTEGER) AS year,
  time_of_purchase AS time_of_day,
  concat_ws(' ', coalesce(CAST(purchase_date AS VARCHAR), 'NaT'), coalesce(time_of_purchase, 'nan')) AS time_key
FROM (SELECT DISTINCT date_of_purchase AS purchase_date, time_of_purchase FROM tickets) s""",
    ["tickets"])

cte("dim_journey_b", """
SELECT row_number() OVER (ORDER BY journey_date NULLS FIRST, departure_time NULLS FIRST,
    arrival_time NULLS FIRST, actual_arrival_time NULLS FIRST, reason_for_delay NULLS FIRST) AS journey_id,
  journey_date, departure_time, arrival_time, actual_arrival_time, reason_for_delay,
  concat_ws(' ', coalesce(CAST(journey_date AS VARCHAR), 'NaT'), coalesce(departure_time, 'nan'),
            coalesce(arrival_time, 'nan'), coalesce(actual_arrival_time, 'nan'),
            coalesce(reason_for_delay, 'nan')) AS journey_key
FROM (SELECT DISTINCT date_of_journey AS journey_date, departure_time, arrival_time,
             actual_arrival_time, reason_for_delay FROM tickets) s""", ["tickets"])

cte("fact_b", """
SELECT k.transaction_id, k.line_number, k.purchase_type, k.payment_method, k.railcard,
  k.ticket_class, k.ticket_type, k.price, k.journey_status, t.time_id, j.journey_id
FROM tickets k
LEFT JOIN dim_time_b t ON k.date_of_purchase IS NOT DISTINCT FROM t.purchase_date
  AND k.time_of_purchase IS NOT DISTINCT FROM t.time_of_purchase
LEFT JOIN dim_journey_b j ON k.date_of_journey IS NOT DISTINCT FROM j.journey_date
  AND k.departure_time IS NOT DISTINCT FROM j.departure_time
  AND k.arrival_time IS NOT DISTINCT FROM j.arrival_time
  AND k.actual_arrival_time IS NOT DISTINCT FROM j.actual_arrival_time
  AND k.reason_for_delay IS NOT DISTINCT FROM j.reason_for_delay""",
    ["tickets", "dim_time_b", "dim_journey_b"])

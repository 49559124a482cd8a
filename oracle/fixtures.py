"""DuckDB spelling of the raw-table mapping (FIXTURES.md section 2), as CTEs
over the pre-registered test-table views."""

from __future__ import annotations

STG = {
    "stg_payment": """
SELECT CAST(o_custkey AS INT) AS user_id, o_orderstatus AS pay_doc_type, CAST(o_orderkey AS INT) AS pay_doc_num,
  CASE WHEN o_orderkey % 101 = 0 THEN NULL
       WHEN o_orderkey % 7 = 0 THEN ' acc-' || (o_custkey % 500) || ' '
       ELSE 'ACC-' || (o_custkey % 500) END AS account,
  CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE o_orderpriority END AS phone,
  strftime(o_orderdate, '%Y-%m') AS billing_period, strftime(o_orderdate, '%Y-%m-%d') AS pay_date,
  o_totalprice AS sum
FROM orders""",
    "stg_payment_typed": """
SELECT CAST(o_custkey AS INT) AS user_id, o_orderstatus AS pay_doc_type, CAST(o_orderkey AS INT) AS pay_doc_num,
  CASE WHEN o_orderkey % 101 = 0 THEN NULL
       WHEN o_orderkey % 7 = 0 THEN ' acc-' || (o_custkey % 500) || ' '
       ELSE 'ACC-' || (o_custkey % 500) END AS account,
  CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE o_orderpriority END AS phone,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS billing_period,
  CASE WHEN o_orderkey % 113 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS pay_date,
  CAST(o_totalprice AS DECIMAL(10,2)) AS sum
FROM orders""",
    "stg_billing": """
SELECT CAST(l_suppkey AS INT) AS user_id, strftime(l_shipdate, '%Y-%m') AS billing_period,
  l_returnflag AS service, l_linestatus AS tariff,
  CASE WHEN l_orderkey % 97 = 0 THEN 'n/a' ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS sum,
  strftime(l_shipdate, '%Y-%m-%d') AS created_at
FROM lineitem""",
    "stg_issue": """
SELECT CASE WHEN event_id % 53 = 0 THEN 'unknown' ELSE CAST(user_id AS VARCHAR) END AS user_id,
  CAST(ts AS VARCHAR) AS start_time,
  CASE WHEN event_id % 41 = 0 THEN 'open' ELSE CAST(ts + INTERVAL 1 HOUR AS VARCHAR) END AS end_time,
  event_type AS title, props AS description, CASE WHEN event_id % 2 = 0 THEN 'internet' ELSE 'tv' END AS service
FROM events""",
    "stg_traffic": """
SELECT CAST(user_id AS INT) AS user_id,
  epoch_us(ts) // 1000 + (event_id % 3) * 31536000000 AS "timestamp",
  concat('dev-', event_id % 97) AS device_id, concat('10.0.', event_id % 256, '.', user_id % 256) AS device_ip_addr,
  CAST((event_id * 104729) % 65537 AS INT) AS bytes_sent, CAST((event_id * 7919) % 100003 AS INT) AS bytes_received
FROM events""",
    "mdm_user": """
SELECT CAST(CASE WHEN c_custkey % 37 = 0 THEN -1 - c_custkey ELSE c_custkey END AS INT) AS id, CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE c_mktsegment END AS legal_type,
  n_name AS district, make_date(1990 + CAST(c_custkey % 10 AS INT), 1, 1) AS registered_at,
  c_acctbal > 5000 AS is_vip, CASE WHEN c_custkey % 2 = 0 THEN 'PREPAID' ELSE 'POSTPAID' END AS billing_mode
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
}

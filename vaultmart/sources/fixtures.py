"""Raw lake tables derived from the driver's test tables (FIXTURES.md section 2).

The reference ships no data; its inputs are external parquet tables.  We
derive them, with Spark, from ``/root/testdata/<sf>/*.parquet`` so that every
query's work grows with the given tables.  The mapping deliberately carries
dirty values (NULL or padded accounts, blank phones, unparseable amounts,
users and end times, NULL legal types, users absent from master data).

Each builder returns a DataFrame with exactly the declared STG schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultmart.functions.joins import checked_broadcast
from vaultmart.functions.lineage import cut_measured
from vaultmart.sources import schemas as S
from vaultmart.sources.lake import spread


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; spread over the cores when it is a single row group."""
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def _conform(df: DataFrame, schema) -> DataFrame:
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


PAYMENT_TEXT = [
    "CAST(o_custkey AS INT) AS user_id",
    "o_orderstatus AS pay_doc_type",
    "CAST(o_orderkey AS INT) AS pay_doc_num",
    """CASE WHEN o_orderkey % 101 = 0 THEN NULL
            WHEN o_orderkey % 7 = 0 THEN ' acc-' || (o_custkey % 500) || ' '
            ELSE 'ACC-' || (o_custkey % 500) END AS account""",
    "CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE o_orderpriority END AS phone",
]


def stg_payment_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed payment source; 1 payment in 113 has no date yet."""
    df = read_table(spark, sf_dir, "orders").selectExpr(
        *PAYMENT_TEXT,
        "CAST(trunc(o_orderdate, 'MM') AS DATE) AS billing_period",
        "CASE WHEN o_orderkey % 113 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS pay_date",
        "o_totalprice AS sum",
    )
    return _conform(df, S.STG_PAYMENT_TYPED)


def stg_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    df = orders.selectExpr(
        *PAYMENT_TEXT,
        "date_format(o_orderdate, 'yyyy-MM') AS billing_period",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS pay_date",
        "o_totalprice AS sum",
    )
    return _conform(df, S.STG_PAYMENT)


def stg_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = read_table(spark, sf_dir, "lineitem")
    df = lineitem.selectExpr(
        "CAST(l_suppkey AS INT) AS user_id",
        "date_format(l_shipdate, 'yyyy-MM') AS billing_period",
        "l_returnflag AS service",
        "l_linestatus AS tariff",
        """CASE WHEN l_orderkey % 97 = 0 THEN 'n/a'
                ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) END AS sum""",
        "date_format(l_shipdate, 'yyyy-MM-dd') AS created_at",
    )
    return _conform(df, S.STG_BILLING)


def stg_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    df = events.selectExpr(
        "CASE WHEN event_id % 53 = 0 THEN 'unknown' ELSE CAST(user_id AS STRING) END AS user_id",
        "CAST(ts AS STRING) AS start_time",
        "CASE WHEN event_id % 41 = 0 THEN 'open' ELSE CAST(ts + INTERVAL 1 HOUR AS STRING) END AS end_time",
        "event_type AS title",
        "props AS description",
        "CASE WHEN event_id % 2 = 0 THEN 'internet' ELSE 'tv' END AS service",
    )
    return _conform(df, S.STG_ISSUE)


def stg_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    df = events.selectExpr(
        "CAST(user_id AS INT) AS user_id",
        # epoch milliseconds of the (zone-less) event time, spread over 3 years
        "unix_millis(CAST(ts AS TIMESTAMP)) + (event_id % 3) * 31536000000 AS `timestamp`",
        "concat('dev-', event_id % 97) AS device_id",
        "concat('10.0.', event_id % 256, '.', user_id % 256) AS device_ip_addr",
        "CAST((event_id * 104729) % 65537 AS INT) AS bytes_sent",
        "CAST((event_id * 7919) % 100003 AS INT) AS bytes_received",
    )
    return _conform(df, S.STG_TRAFFIC)


def mdm_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    nation = spark.read.parquet(f"{sf_dir.rstrip('/')}/nation.parquet")
    # 25 nations: broadcast once measured, so customers are not shuffled on 25 values
    nation, size = cut_measured(nation.select("n_nationkey", "n_name"), "nation")
    df = (customer.join(checked_broadcast(nation, size.rows), customer.c_nationkey == nation.n_nationkey)
          .selectExpr(
              # 1 customer in 37 is known under an id that no payment has
              "CAST(CASE WHEN c_custkey % 37 = 0 THEN -1 - c_custkey ELSE c_custkey END AS INT) AS id",
              "CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE c_mktsegment END AS legal_type",
              "n_name AS district",
              "make_date(1990 + CAST(c_custkey % 10 AS INT), 1, 1) AS registered_at",
              "c_acctbal > 5000 AS is_vip",
              "CASE WHEN c_custkey % 2 = 0 THEN 'PREPAID' ELSE 'POSTPAID' END AS billing_mode",
          ))
    return _conform(df, S.MDM_USER)


BUILDERS = {
    "stg_payment": stg_payment,
    "stg_payment_typed": stg_payment_typed,
    "stg_billing": stg_billing,
    "stg_issue": stg_issue,
    "stg_traffic": stg_traffic,
    "mdm_user": mdm_user,
}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return BUILDERS[name](spark, sf_dir)

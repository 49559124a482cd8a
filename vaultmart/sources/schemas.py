"""Schema registry (S1, S10): every table has a fixed, declared schema.

Nothing is inferred.  Partitioned lake tables carry ``year`` as a STRING
partition column; on read we pass the full schema so Spark does not infer the
partition value as an integer.
"""

from __future__ import annotations

from pyspark.sql import types as T

INT = T.IntegerType()
BIGINT = T.LongType()
DOUBLE = T.DoubleType()
STRING = T.StringType()
DATE = T.DateType()
TIMESTAMP = T.TimestampNTZType()  # "timestamp without time zone"
BOOLEAN = T.BooleanType()
MONEY = T.DecimalType(10, 2)
MONEY_SUM = T.DecimalType(20, 2)


def _st(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---- raw lake (STG) -------------------------------------------------------
STG_BILLING = _st(("user_id", INT), ("billing_period", STRING), ("service", STRING),
                  ("tariff", STRING), ("sum", STRING), ("created_at", STRING))
STG_ISSUE = _st(("user_id", STRING), ("start_time", STRING), ("end_time", STRING),
                ("title", STRING), ("description", STRING), ("service", STRING))
STG_PAYMENT = _st(("user_id", INT), ("pay_doc_type", STRING), ("pay_doc_num", INT),
                  ("account", STRING), ("phone", STRING), ("billing_period", STRING),
                  ("pay_date", STRING), ("sum", DOUBLE))
# the warehouse's external payment table is typed
STG_PAYMENT_TYPED = _st(("user_id", INT), ("pay_doc_type", STRING), ("pay_doc_num", INT),
                        ("account", STRING), ("phone", STRING), ("billing_period", DATE),
                        ("pay_date", DATE), ("sum", MONEY))
STG_TRAFFIC = _st(("user_id", INT), ("timestamp", BIGINT), ("device_id", STRING),
                  ("device_ip_addr", STRING), ("bytes_sent", INT), ("bytes_received", INT))

# ---- typed ODS; lake tables add the ``year`` partition column -------------
ODS_BILLING = _st(("user_id", INT), ("billing_period", DATE), ("service", STRING),
                  ("tariff", STRING), ("sum", INT), ("created_at", DATE))
ODS_ISSUE = _st(("user_id", INT), ("start_time", TIMESTAMP), ("end_time", TIMESTAMP),
                ("title", STRING), ("description", STRING), ("service", STRING))
ODS_PAYMENT = _st(("user_id", INT), ("pay_doc_type", STRING), ("pay_doc_num", INT),
                  ("account", STRING), ("phone", STRING), ("billing_period", DATE),
                  ("pay_date", DATE), ("sum", MONEY))
ODS_TRAFFIC = _st(("user_id", INT), ("timestamp", TIMESTAMP), ("device_id", STRING),
                  ("device_ip_addr", STRING), ("bytes_sent", INT), ("bytes_received", INT))

DM_BYTES_RECEIVED = _st(("user_id", INT), ("max_traffic", INT), ("min_traffic", INT),
                        ("avg_traffic", INT))

# ---- master data ------------------------------------------------------------
MDM_USER = _st(("id", INT), ("legal_type", STRING), ("district", STRING),
               ("registered_at", DATE), ("is_vip", BOOLEAN), ("billing_mode", STRING))

# ---- Data Vault -------------------------------------------------------------
HUB_USER = _st(("user_pk", STRING), ("user_key", STRING), ("load_date", TIMESTAMP),
               ("record_source", STRING))
HUB_ACCOUNT = _st(("account_pk", STRING), ("account_key", STRING), ("load_date", TIMESTAMP),
                  ("record_source", STRING))
HUB_BILLING_PERIOD = _st(("billing_period_pk", STRING), ("billing_period_key", STRING),
                         ("load_date", TIMESTAMP), ("record_source", STRING))
HUB_PAY_DOC = _st(("pay_doc_pk", STRING), ("pay_doc_type_key", STRING),
                  ("pay_doc_num_key", STRING), ("load_date", TIMESTAMP),
                  ("record_source", STRING))
LINK_USER_ACCOUNT_BILLING_PAY = _st(
    ("user_account_billing_pay_pk", STRING), ("user_pk", STRING), ("account_pk", STRING),
    ("billing_period_pk", STRING), ("pay_doc_pk", STRING), ("load_date", TIMESTAMP),
    ("record_source", STRING))
SAT_PAY_DETAILS = _st(("user_account_billing_pay_pk", STRING), ("pay_doc_hashdiff", STRING),
                      ("pay_date", DATE), ("sum", MONEY), ("effective_from", DATE),
                      ("load_date", TIMESTAMP), ("record_source", STRING))
SAT_USER_DETAILS = _st(("user_pk", STRING), ("user_hashdiff", STRING), ("phone", STRING),
                       ("effective_from", DATE), ("load_date", TIMESTAMP),
                       ("record_source", STRING))

# second vault (column lists only in the reference; types follow the first vault)
HUB_PAYMENT = _st(("pay_pk", STRING), ("pay_doc_type_id", STRING), ("pay_doc_num", INT),
                  ("load_date", TIMESTAMP), ("record_source", STRING))
T_LINK_PAYMENT = _st(("pay_pk", STRING), ("user_pk", STRING), ("account_pk", STRING),
                     ("billing_period_pk", STRING), ("sum", MONEY), ("pay_doc_type", STRING),
                     ("pay_doc_num", INT), ("effective_from", DATE), ("load_date", TIMESTAMP),
                     ("record_source", STRING))
SAT_PAYMENT_DOC_TYPE = _st(("pk_id", STRING), ("pay_doc_type", STRING))
SAT_USER_AS_CLIENT = _st(("user_pk", STRING), ("legal_type", STRING), ("district", STRING),
                         ("registered_at", DATE), ("billing_mode", STRING), ("is_vip", BOOLEAN),
                         ("load_date", TIMESTAMP), ("record_source", STRING))

# ---- report star --------------------------------------------------------------
def dim_schema(key: str, key_type: T.DataType) -> T.StructType:
    return _st(("id", BIGINT), (key, key_type))


REPORT_FACT = _st(("billing_year_id", BIGINT), ("legal_type_id", BIGINT), ("district_id", BIGINT),
                  ("registration_year_id", BIGINT), ("is_vip", BOOLEAN), ("sum", MONEY_SUM))

REGISTRY: dict[str, T.StructType] = {
    "stg_billing": STG_BILLING, "stg_issue": STG_ISSUE, "stg_payment": STG_PAYMENT,
    "stg_payment_typed": STG_PAYMENT_TYPED,
    "stg_traffic": STG_TRAFFIC, "ods_billing": ODS_BILLING, "ods_issue": ODS_ISSUE,
    "ods_payment": ODS_PAYMENT, "ods_traffic": ODS_TRAFFIC,
    "dm_bytes_received": DM_BYTES_RECEIVED, "mdm_user": MDM_USER,
    "hub_user": HUB_USER, "hub_account": HUB_ACCOUNT, "hub_billing_period": HUB_BILLING_PERIOD,
    "hub_pay_doc": HUB_PAY_DOC, "link_user_account_billing_pay": LINK_USER_ACCOUNT_BILLING_PAY,
    "sat_pay_details": SAT_PAY_DETAILS, "sat_user_details": SAT_USER_DETAILS,
    "hub_payment": HUB_PAYMENT, "t_link_payment": T_LINK_PAYMENT,
    "sat_payment_doc_type": SAT_PAYMENT_DOC_TYPE, "sat_user_as_client": SAT_USER_AS_CLIENT,
    "report_fact": REPORT_FACT,
}

# Lake tables partitioned by ``year STRING``.
PARTITIONED_BY_YEAR = {"ods_billing", "ods_issue", "ods_payment", "ods_traffic",
                       "dm_bytes_received"}


def schema_of(table: str, with_partition: bool = True) -> T.StructType:
    st = REGISTRY[table]
    if with_partition and table in PARTITIONED_BY_YEAR:
        return T.StructType(st.fields + [T.StructField("year", STRING, True)])
    return st

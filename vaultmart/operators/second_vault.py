"""Second vault model (Q14, Q16, Q19, Q20) [inferred].

The reference inserts these tables from delta views it never defines; only
the insert column lists exist.  The definitions follow those lists and the
pattern of the first vault (SURVEY 2.8 "Definitions for the second vault"):

* hub_payment: pay_pk = hash(pay_doc_type, pay_doc_num),
  pay_doc_type_id = hash(pay_doc_type); hub load on pay_pk.
* t_link_payment: transactional link keyed by pay_pk with the first vault's
  foreign keys and the measures sum, pay_doc_type, pay_doc_num,
  effective_from = pay_date; link load on pay_pk.
* sat_payment_doc_type: reference list pk_id = hash(pay_doc_type) -> text;
  distinct, insert if pk_id is new.
* sat_user_as_client: client attributes from master data for users the hub
  knows; versioned like the first vault's satellites, the hashdiff being
  recomputed on both sides because the table stores none.

The views take no year: each run loads the whole ODS with one LOAD_DATE.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultmart.functions import dates as D
from vaultmart.functions.joins import anti_join_existing
from vaultmart.functions.keys import hash_key, hashdiff
from vaultmart.operators import vault as V

# Record source of the master-data feed (not named by the reference) [inferred].
MDM_RECORD_SOURCE = "MDM - USERS"

HUB_PAYMENT_COLS = ["pay_pk", "pay_doc_type_id", "pay_doc_num", *V.AUDIT]
T_LINK_COLS = ["pay_pk", "user_pk", "account_pk", "billing_period_pk", "sum", "pay_doc_type",
               "pay_doc_num", "effective_from", *V.AUDIT]
CLIENT_ATTRS = ["legal_type", "district", "registered_at", "billing_mode", "is_vip"]
SAT_CLIENT_COLS = ["user_pk", *CLIENT_ATTRS, *V.AUDIT]


def payment_stage_v2(ods: DataFrame, load_date: _dt.datetime | str) -> DataFrame:
    """The first vault's stage over the whole ODS, rows without pay_date
    included (the views have no date filter), plus the payment hub's keys."""
    return (V.payment_stage(ods, year=None, load_date=load_date, undated=True)
            .withColumn("pay_pk", hash_key("pay_doc_type", "pay_doc_num"))
            .withColumn("pay_doc_type_id", hash_key("pay_doc_type")))


def hub_payment(stage: DataFrame, hub: DataFrame, hub_rows: int | None = None,
                batch_rows: int | None = None) -> DataFrame:
    """Q14."""
    return V.hub_load(stage, hub, "pay_pk", ["pay_doc_type_id", "pay_doc_num"], hub_rows, batch_rows)


def t_link_payment(stage: DataFrame, tlink: DataFrame, link_rows: int | None = None,
                   batch_rows: int | None = None) -> DataFrame:
    """Q16."""
    return V.link_load(stage, tlink, "pay_pk", T_LINK_COLS, link_rows, batch_rows)


def sat_payment_doc_type(stage: DataFrame, sat: DataFrame, sat_rows: int | None = None,
                         batch_rows: int | None = None) -> DataFrame:
    """Q19."""
    rows = stage.select(hash_key("pay_doc_type").alias("pk_id"), "pay_doc_type").distinct()
    return anti_join_existing(rows, sat, ["pk_id"], sat_rows, batch_rows).select(
        "pk_id", "pay_doc_type")


def sat_user_as_client(mdm: DataFrame, hub_user: DataFrame, sat: DataFrame,
                       load_date: _dt.datetime | str,
                       record_source: str = MDM_RECORD_SOURCE, on_time: bool = False, **bounds) -> DataFrame:
    """Q20: new client-attribute versions for users present in hub_user.  ``on_time``:
    nothing in ``sat`` is newer than ``load_date``."""
    src = (mdm.select(hash_key("id").alias("user_pk"), *CLIENT_ATTRS)
           .join(hub_user.select("user_pk"), "user_pk", "left_semi")
           .withColumn("load_date", D.ts_literal(load_date))
           .withColumn("record_source", F.lit(record_source))
           .withColumn("_hd", hashdiff(*CLIENT_ATTRS)))
    existing = sat.withColumn("_hd", hashdiff(*CLIENT_ATTRS))
    if on_time:
        bounds.update(current=existing.where(F.col("user_pk").isNotNull()), current_rows=bounds.get("sat_rows"), whole=True)
    return V.sat_load(src, existing, "user_pk", "_hd", SAT_CLIENT_COLS + ["_hd"],
                      **bounds).select(*SAT_CLIENT_COLS)

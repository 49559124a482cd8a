"""Marts: traffic mart (Q05) and the payment report star (Q21-Q27).

Report plan, Spark-first:
* the billing-period hub, filtered to the year, is tiny (12 keys a year):
  broadcast after a size check, so the link is only scanned, not shuffled;
* where link and satellite are stored by billing year, a yearly report reads that
  year's partitions of both, whatever run loaded them (late versions too);
* link x satellite on the link key is the one big-big join;
* revenue is pre-aggregated per (user, billing year) right after it, before
  the user hub and master data are joined.  SUM distributes over the
  user-level joins, so the result is identical, and a hot user or NULL-keyed
  rows collapse map-side instead of landing on one reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultmart.functions import dates as D
from vaultmart.functions.ids import append_sequence_ids
from vaultmart.functions.joins import checked_broadcast
from vaultmart.operators.vault import LINK_PK, newest_per_key

REPORT_KEYS = ["billing_year", "legal_type", "district", "registration_year", "is_vip"]


def dm_bytes_received(ods_traffic: DataFrame, year: int | None = None) -> DataFrame:
    """Q05: max, min and truncated average of bytes_received per user and year."""
    df = ods_traffic if year is None else ods_traffic.where(F.col("year") == F.lit(str(year)))
    return (df.groupBy("year", "user_id")
            .agg(F.max("bytes_received").alias("max_traffic"),
                 F.min("bytes_received").alias("min_traffic"),
                 F.avg("bytes_received").cast("int").alias("avg_traffic"))
            .select("user_id", "max_traffic", "min_traffic", "avg_traffic", "year"))


def _billing_years(hub_bp: DataFrame, year: int | None) -> DataFrame:
    bp = hub_bp.select("billing_period_pk",
                       D.period_key_year("billing_period_key").alias("billing_year"))
    if year is None:
        return bp.where(F.col("billing_year").isNotNull())
    return bp.where(F.col("billing_year") == F.lit(year))


def _of_year(rows: DataFrame, year: int | None) -> DataFrame:
    """Rows of the year's partition, where a table is stored by billing year: a payment's
    key holds its billing period, so all its versions lie in the same year."""
    if year is None or "billing_year" not in rows.columns:
        return rows
    return rows.where(F.col("billing_year") == F.lit(year))


def _rollup(per_user: DataFrame, hub_user: DataFrame, attrs: DataFrame, how: str) -> DataFrame:
    users = per_user.join(hub_user.select("user_pk", "user_key"), "user_pk")
    rows = users.join(attrs, users["user_key"] == attrs["_uid"], how)
    return (rows.groupBy(*REPORT_KEYS)
            .agg(F.sum("_s").cast("decimal(20,2)").alias("sum")))


def payment_report(link: DataFrame, hub_bp: DataFrame, sat_pay: DataFrame,
                   hub_user: DataFrame, mdm: DataFrame, year: int | None = None,
                   hub_bp_rows: int | None = None, latest_only: bool = False) -> DataFrame:
    """Q21: revenue by billing year, legal type, district, registration year, VIP.

    Variant A: payments from the link and its satellite (all versions, t12),
    client attributes from master data by ``user_key = id::text`` (left join).
    ``year=None`` gives every billing year (the union of the yearly reports).
    ``latest_only``: only each payment's newest versions count.
    A link and satellite with a ``billing_year`` column (their partition) are pruned by it.
    """
    bp = checked_broadcast(_billing_years(hub_bp, year), hub_bp_rows)
    link, sat_pay = _of_year(link, year), _of_year(sat_pay, year)
    if latest_only:
        hd = "pay_doc_hashdiff"
        sat_pay = sat_pay.join(newest_per_key(sat_pay, LINK_PK, hd), [LINK_PK, hd, "load_date"], "left_semi")
    lk = link.select(LINK_PK, "user_pk", "billing_period_pk").join(bp, "billing_period_pk")
    pays = lk.join(sat_pay.select(LINK_PK, "sum"), LINK_PK)
    per_user = pays.groupBy("user_pk", "billing_year").agg(F.sum("sum").alias("_s"))
    attrs = mdm.select(F.col("id").cast("string").alias("_uid"), "legal_type", "district",
                       F.year("registered_at").alias("registration_year"), "is_vip")
    return _rollup(per_user, hub_user, attrs, "left")


def payment_report_client(tlink: DataFrame, hub_bp: DataFrame, hub_user: DataFrame,
                          sat_client: DataFrame, year: int | None = None,
                          hub_bp_rows: int | None = None, latest_only: bool = False) -> DataFrame:
    """Q22: the same measures from the second vault (transactional link, client
    satellite joined without a latest filter, as the reference does; ``latest_only``:
    only each client's newest versions).  A link with a ``billing_year`` column (its
    partition) is pruned by it."""
    bp = checked_broadcast(_billing_years(hub_bp, year), hub_bp_rows)
    tlink = _of_year(tlink, year)
    if latest_only:
        newest = sat_client.groupBy("user_pk").agg(F.max("load_date").alias("load_date"))
        sat_client = sat_client.join(newest, ["user_pk", "load_date"], "left_semi")
    pays = tlink.select("user_pk", "billing_period_pk", "sum").join(bp, "billing_period_pk")
    per_user = pays.groupBy("user_pk", "billing_year").agg(F.sum("sum").alias("_s"))
    users = per_user.join(hub_user.select("user_pk"), "user_pk")
    client = sat_client.select("user_pk", "legal_type", "district",
                               F.year("registered_at").alias("registration_year"), "is_vip")
    rows = users.join(client, "user_pk", "left")
    return (rows.groupBy(*REPORT_KEYS)
            .agg(F.sum("_s").cast("decimal(20,2)").alias("sum")))


# ---------------------------------------------------------------- dimensions (Q23-Q26)

DIMS = {
    # dimension: (report column, key column, key type in variant A)
    "dim_billing_year": ("billing_year", "billing_year_key", "int"),
    "dim_legal_type": ("legal_type", "legal_type_key", "string"),
    "dim_district": ("district", "district_key", "string"),
    "dim_registration_year": ("registration_year", "registration_year_key", "string"),
}
# Variant B (the combined run) keeps the registration year as a number (t21).
DIMS_B = {**DIMS, "dim_registration_year": ("registration_year", "registration_year_key", "int")}


def dim_load(report: DataFrame, dim: DataFrame | None, column: str, key: str,
             key_type: str, report_rows: int | None = None) -> DataFrame:
    """Rows to insert into a dimension from one report: new distinct values,
    ids continuing from the dimension's maximum, in key order (NULLs last;
    ``dim=None``: a new dimension).  A NULL value never matches, so it is
    inserted by every batch (t11).
    ``report_rows``: optional bound on the report's rows (bounds the new values)."""
    vals = report.select(F.col(column).cast(key_type).alias(key)).distinct()
    new = vals.join(dim.select(key), key, "left_anti") if dim is not None else vals
    return append_sequence_ids(new, [F.col(key).asc_nulls_last()], dim,
                               max_rows=report_rows).select("id", key)


def dim_backfill(report_all: DataFrame, dim: DataFrame | None, column: str, key: str,
                 key_type: str, batch_col: str = "billing_year",
                 report_rows: int | None = None) -> DataFrame:
    """Rows the yearly dimension loads insert over every billing year, in one
    pass: a value enters in the first year it appears, NULL once per year;
    ids run in (year, key) order, continuing from the dimension's maximum.
    ``report_rows``: optional bound on the report's rows (bounds the new values)."""
    vals = report_all.select(F.col(column).cast(key_type).alias(key), batch_col)
    first = (vals.groupBy(F.col(key), F.when(F.col(key).isNull(), F.col(batch_col)).alias("_nb"))
             .agg(F.min(batch_col).alias("_batch")))
    if dim is not None:
        first = first.join(dim.select(key), key, "left_anti")
    new = first.select(key, "_batch")
    order = [F.col("_batch").asc(), F.col(key).asc_nulls_last()]
    return append_sequence_ids(new, order, dim, max_rows=report_rows).select("id", key)


def report_fact(report: DataFrame, dims: dict[str, DataFrame],
                spec: dict[str, tuple[str, str, str]] = DIMS,
                dim_rows: dict[str, int] | None = None) -> DataFrame:
    """Q27: the report with dimension ids; inner joins, so rows with a NULL
    dimension value drop out (t11).  Dimensions are broadcast after a size check
    (``dim_rows``: optional proven bounds per dimension).
    ``spec`` is ``DIMS`` (variant A) or ``DIMS_B``."""
    out = report
    ids = []
    for name, (column, key, key_type) in spec.items():
        d = checked_broadcast(dims[name].select(F.col("id").alias(f"{column}_id"), key),
                              (dim_rows or {}).get(name))
        out = out.join(d, F.col(column).cast(key_type) == F.col(key)).drop(key)
        ids.append(f"{column}_id")
    return out.select(*ids, "is_vip", "sum")

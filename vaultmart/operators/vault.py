"""Data Vault loads: payment stage, hubs, link, satellites (Q08-Q13, Q15, Q17, Q18).

Building blocks (SURVEY 2.8), each returning the rows to *insert*:

``hub_load``   first row per hash key (by load date, then key text) whose key
               the hub does not hold.  Implemented as two aggregations
               rather than a window, so rows of a hot key collapse map-side
               before the shuffle.
``link_load``  distinct rows whose key the link does not hold.
``sat_load``   rows whose (key, hashdiff) is not among the key's latest
               versions; "latest" = versions with the newest load date at or
               before the batch's load date (ties all kept).  The fan-out join
               of the reference is replaced by one cut-off per key, and the
               rank window by map-side-combined aggregations and a join.

A NULL key never matches in an anti-join, so NULL-key rows are inserted once
per batch, as in the reference (SURVEY t5).

``hub_backfill`` / ``link_backfill`` load many yearly batches in one pass with
the same result as loading them one year after another: a key is inserted in
the first year it appears, a NULL key once per year.  Satellites depend on
the order of loads and are folded year by year (plans/backfill.py).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultmart.functions import dates as D
from vaultmart.functions.joins import _filter_keys, anti_join_existing, checked_broadcast, is_small, some_keys
from vaultmart.functions.lineage import cut_measured
from vaultmart.functions.keys import RECORD_SOURCE, hash_key, hashdiff, norm

STAGE_SOURCE = ["user_id", "pay_doc_type", "pay_doc_num", "account", "phone",
                "billing_period", "pay_date", "sum"]
AUDIT = ["load_date", "record_source"]
_HASHED = ["user_id", "account", "billing_period", "pay_doc_type", "pay_doc_num", "phone",
           "pay_date", "sum"]


# ---------------------------------------------------------------- staging (Q08, Q09)

def payment_stage(ods: DataFrame, year: int | None = None,
                  load_date: _dt.datetime | str | None = None, undated: bool = False) -> DataFrame:
    """Q08: the yearly staging view: text keys, hash keys, hashdiffs, audit columns.

    ``year`` given: rows with pay_date in that year (a range that reaches the
    Parquet scan), LOAD_DATE = ``load_date`` or 1 January of the year.
    ``year=None``: every dated row, each with the LOAD_DATE of the yearly run
    that would load it (1 January of its pay_date year).  No yearly run loads a row
    without pay_date; ``undated`` keeps those too (needs a ``load_date``).
    """
    src = ods.select(*STAGE_SOURCE)
    if year is not None:
        src = src.where(D.in_year("pay_date", year))
        ld = D.ts_literal(load_date) if load_date is not None else D.execution_ts(year)
    else:
        if undated and load_date is None:
            raise ValueError("rows without pay_date need a load_date")
        src = src if undated else src.where(F.col("pay_date").isNotNull())
        ld = D.ts_literal(load_date) if load_date is not None else D.year_start_ts("pay_date")
    # normalise each business key once; several hash keys reuse it
    normed = src.select("*", *[norm(c).alias(f"_n_{c}") for c in _HASHED])
    n = {c: f"_n_{c}" for c in _HASHED}
    return normed.select(
        *STAGE_SOURCE,
        F.col("user_id").cast("string").alias("user_key"),
        F.col("account").cast("string").alias("account_key"),
        F.col("billing_period").cast("string").alias("billing_period_key"),
        F.col("pay_doc_type").cast("string").alias("pay_doc_type_key"),
        F.col("pay_doc_num").cast("string").alias("pay_doc_num_key"),
        F.lit(RECORD_SOURCE).alias("record_source"),
        hash_key(n["user_id"], normalized=True).alias("user_pk"),
        hash_key(n["account"], normalized=True).alias("account_pk"),
        hash_key(n["billing_period"], normalized=True).alias("billing_period_pk"),
        hash_key(n["pay_doc_type"], n["pay_doc_num"], normalized=True).alias("pay_doc_pk"),
        hash_key(n["user_id"], n["account"], n["billing_period"], n["pay_doc_type"],
                 n["pay_doc_num"], normalized=True).alias("user_account_billing_pay_pk"),
        hashdiff(n["phone"], normalized=True).alias("user_hashdiff"),
        hashdiff(n["pay_date"], n["sum"], normalized=True).alias("pay_doc_hashdiff"),
        ld.alias("load_date"),
        F.col("pay_date").alias("effective_from"),
    )


def payment_stage_all(ods: DataFrame, load_date: _dt.date | str) -> DataFrame:
    """Q09: the older warehouse view: no year filter, no pay-doc keys; PAY_PK
    hashes (user, account, period); LOAD_DATE is the run date (a DATE)."""
    return ods.select(*STAGE_SOURCE).select(
        *STAGE_SOURCE,
        F.col("user_id").cast("string").alias("user_key"),
        F.col("account").cast("string").alias("account_key"),
        F.col("billing_period").cast("string").alias("billing_period_key"),
        F.lit(RECORD_SOURCE).alias("record_source"),
        hash_key("user_id").alias("user_pk"),
        hash_key("account").alias("account_pk"),
        hash_key("billing_period").alias("billing_period_pk"),
        hash_key("user_id", "account", "billing_period").alias("pay_pk"),
        hashdiff("phone").alias("user_hashdiff"),
        F.lit(str(load_date)).cast("date").alias("load_date"),
        F.col("pay_date").alias("effective_from"),
    )


# ---------------------------------------------------------------- hubs (Q10-Q14)

def _first_per_key(stage: DataFrame, pk: str, keys: list[str], per_batch_null: bool) -> DataFrame:
    """One row per key: the least (load_date, keys...) row.  NULL keys form one
    group per batch (load date) when ``per_batch_null``, else one group."""
    group = [F.col(pk)]
    if per_batch_null:
        group.append(F.when(F.col(pk).isNull(), F.col("load_date")).alias("_null_batch"))
    # the earliest date per spelling first: a hash aggregate over the raw rows,
    # as its buffer is a number; min(struct) with text sorts, but only what is left
    spelled = (stage.groupBy(*group, *keys, "record_source")
               .agg(F.min("load_date").alias("load_date")))
    first = (spelled.groupBy(pk, *(["_null_batch"] if per_batch_null else []))
             .agg(F.min(F.struct("load_date", *keys, "record_source")).alias("_f")))
    return first.select(pk, *[F.col(f"_f.{c}").alias(c) for c in keys], "_f.load_date",
                        "_f.record_source")


def _keyed(rows: DataFrame, pk: str, skip_null_keys: bool) -> DataFrame:
    return rows.where(F.col(pk).isNotNull()) if skip_null_keys else rows


def hub_load(stage: DataFrame, hub: DataFrame, pk: str, keys: list[str],
             hub_rows: int | None = None, batch_rows: int | None = None,
             skip_null_keys: bool = False) -> DataFrame:
    """Rows to insert into a hub from one batch (row_number()=1, then anti-join).
    ``hub_rows`` / ``batch_rows``: optional size bounds (see functions.joins).
    ``skip_null_keys``: load no NULL keys, which every batch repeats (t5)."""
    first = _first_per_key(_keyed(stage, pk, skip_null_keys), pk, keys, per_batch_null=False)
    return anti_join_existing(first, hub, [pk], hub_rows, batch_rows).select(pk, *keys, *AUDIT)


def hub_backfill(stage_all: DataFrame, hub: DataFrame, pk: str, keys: list[str],
                 hub_rows: int | None = None) -> DataFrame:
    """Rows that loading every batch of ``stage_all`` in load-date order inserts."""
    first = _first_per_key(stage_all, pk, keys, per_batch_null=True)
    return anti_join_existing(first, hub, [pk], hub_rows).select(pk, *keys, *AUDIT)


HUBS = {
    "hub_user": ("user_pk", ["user_key"]),
    "hub_account": ("account_pk", ["account_key"]),
    "hub_billing_period": ("billing_period_pk", ["billing_period_key"]),
    "hub_pay_doc": ("pay_doc_pk", ["pay_doc_type_key", "pay_doc_num_key"]),
}


# ---------------------------------------------------------------- links (Q15, Q16)

LINK_PK = "user_account_billing_pay_pk"
LINK_COLS = [LINK_PK, "user_pk", "account_pk", "billing_period_pk", "pay_doc_pk", *AUDIT]


def link_load(stage: DataFrame, link: DataFrame, pk: str, cols: list[str],
              link_rows: int | None = None, batch_rows: int | None = None,
              skip_null_keys: bool = False) -> DataFrame:
    """Distinct batch rows (``cols``, including the audit columns) with a new key."""
    rows = _keyed(stage.select(*cols), pk, skip_null_keys).distinct()
    return anti_join_existing(rows, link, [pk], link_rows, batch_rows).select(*cols)


def link_backfill(stage_all: DataFrame, link: DataFrame, pk: str, cols: list[str],
                  link_rows: int | None = None) -> DataFrame:
    """All batches at once: a key's rows of its first batch; NULL keys every batch.

    After the distinct, a key holds at most one row per batch, so the window
    over the key is bounded by the number of batches, whatever the skew.
    """
    rows = stage_all.select(*cols).distinct()
    first = F.min("load_date").over(Window.partitionBy(pk))
    rows = (rows.withColumn("_first", first)
            .where(F.col(pk).isNull() | (F.col("load_date") == F.col("_first")))
            .drop("_first"))
    return anti_join_existing(rows, link, [pk], link_rows).select(*cols)


# ---------------------------------------------------------------- satellites (Q17, Q18, Q20)

def latest_versions(sat: DataFrame, cut_off: DataFrame, pk: str, hd: str,
                    sat_rows: int | None = None, batch_rows: int | None = None) -> DataFrame:
    """(pk, hashdiff) of each key's newest versions at or before its cut-off.

    ``cut_off`` holds one row per key (``pk``, ``_cut``).  A version qualifies
    when its load date is <= the cut-off (the reference joins the satellite to
    every batch row and keeps a.load_date <= b.load_date; "some b" is the same
    as "the latest b").  Latest = qualifying versions at the key's maximum
    qualifying load date, ties all kept.

    ``sat_rows`` / ``batch_rows`` are the two inputs' sizes, or upper bounds on them,
    where the caller knows them.  They pick the join: broadcast the satellite while it is young,
    else broadcast the batch's cut-offs and only scan the history, else
    shuffle both on the key.
    """
    versions = sat.select(pk, hd, "load_date")
    shuffled = False
    if is_small(sat, sat_rows):
        qual = cut_off.join(F.broadcast(versions), pk)
    else:
        shuffled = not is_small(sat, batch_rows)
        if shuffled:
            # joined on the key and its hash, which the grouping of the cut-offs is not
            # partitioned by: both sides get exchanges of their own, and only then
            # may AQE split a hot key's history
            own = F.xxhash64(pk).alias("_own")
            qual = versions.select("*", own).join(cut_off.select("*", own), [pk, "_own"]).drop("_own")
        else:
            qual = versions.join(F.broadcast(cut_off), pk)
    qual = qual.where(F.col("load_date") <= F.col("_cut"))
    if shuffled:
        # an exchange of its own for the grouping, so that it does not hold on to
        # the join's partitioning and AQE can split a hot key's history there
        qual = qual.repartition(pk, hd)
    return newest_per_key(qual, pk, hd).select(pk, hd)


def latest_current(current: DataFrame, stage: DataFrame, pk: str, hd: str, current_rows: int | None = None,
                   batch_rows: int | None = None, whole: bool = False) -> DataFrame:
    """(pk, hashdiff) of the newest versions of the batch's keys, from a satellite's
    current versions instead of its history.  Right when no row of the batch has a load
    date before the newest in the satellite: the guard then excludes no version.

    ``whole``: the batch has nearly all keys, so that reducing ``current`` to them is no gain.
    ``current`` may still hold a key's older versions, from before it changed; of each
    key the newest load date counts."""
    if is_small(current, current_rows):           # one exchange of a proven small table
        newest = F.max("load_date").over(Window.partitionBy(pk))
        latest = current.select(pk, hd, "load_date", newest.alias("_newest")).where("load_date = _newest")
        return F.broadcast(latest.select(pk, hd))
    if whole:                                     # a key's newest versions as they are: no use in grouping them
        newest = current.groupBy(pk).agg(F.max("load_date").alias("_newest"))
        return current.join(newest, pk).where("load_date = _newest").select(pk, hd)
    # only the batch's keys go on; a big batch's are in the form of a Bloom filter
    if is_small(current, batch_rows):
        current = current.join(F.broadcast(some_keys(stage, [pk])), pk, "left_semi")
        return newest_per_key(current, pk, hd).select(pk, hd)
    current = current.join(_filter_keys(stage, [pk]), pk, "left_semi")
    latest, size = cut_measured(newest_per_key(current, pk, hd).select(pk, hd), "latest")
    return checked_broadcast(latest, size.rows)


def newest_per_key(versions: DataFrame, pk: str, hd: str) -> DataFrame:
    """(pk, hashdiff, load_date) of each key's versions at its newest load date.

    Two map-side-combined aggregations and an equi-join, no window: a hot key
    with many distinct versions never has to fit in one task (AQE splits the
    skewed side of the join)."""
    per_hd = versions.groupBy(pk, hd).agg(F.max("load_date").alias("load_date"))
    newest = per_hd.groupBy(pk).agg(F.max("load_date").alias("_newest"))
    return (per_hd.join(newest, pk)
            .where(F.col("load_date") == F.col("_newest"))
            .select(pk, hd, "load_date"))


def sat_load(stage: DataFrame, sat: DataFrame, pk: str, hd: str, cols: list[str],
             sat_rows: int | None = None, batch_rows: int | None = None,
             skip_null_keys: bool = False, unique: bool = False,
             current: DataFrame | None = None, current_rows: int | None = None, whole: bool = False) -> DataFrame:
    """Rows to insert into a satellite from one batch.

    ``current``: the satellite's current versions (pk, hashdiff, load_date), see
    ``latest_current`` (there ``whole`` too); the history in ``sat`` is then not read.

    ``cols`` is the insert column list (pk, hashdiff, payload, audit columns);
    ``sat_rows`` / ``batch_rows``: optional size bounds, see ``latest_versions``;
    ``unique``: the batch has no row twice, so none is looked for.
    """
    source = _keyed(stage.select(*cols), pk, skip_null_keys)
    rows = source if unique else source.distinct()
    if sat_rows == 0:             # proven empty satellite: every distinct row is new
        return rows
    if current is not None:
        latest = latest_current(current, source, pk, hd, current_rows, batch_rows, whole)
    else:
        cut_off = (source.where(F.col(pk).isNotNull())
                   .groupBy(pk).agg(F.max("load_date").alias("_cut")))
        latest = latest_versions(sat, cut_off, pk, hd, sat_rows, batch_rows)
    return rows.join(latest, [pk, hd], "left_anti").select(*cols)


SAT_USER_COLS = ["user_pk", "user_hashdiff", "phone", "effective_from", *AUDIT]
SAT_PAY_COLS = [LINK_PK, "pay_doc_hashdiff", "pay_date", "sum", "effective_from", *AUDIT]

SATS = {
    "sat_user_details": ("user_pk", "user_hashdiff", SAT_USER_COLS),
    "sat_pay_details": (LINK_PK, "pay_doc_hashdiff", SAT_PAY_COLS),
}

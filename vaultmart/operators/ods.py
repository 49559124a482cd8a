"""Raw -> typed ODS loads (Q01-Q04, Q06, Q07).

Each lake load takes the raw table and a ``year``.  With a year it is the
reference's yearly run: rows whose year column falls in that year, plus the
``year`` partition value.  With ``year=None`` it is the same load for every
year at once (a backfill in one pass, written with dynamic partition
overwrite); rows whose year does not parse are never loaded by any yearly run
and are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultmart.functions import casts as C
from vaultmart.functions import dates as D
from vaultmart.sources import schemas as S


def _by_year(df: DataFrame, year_expr: Column, year: int | None,
             pushable: Column | None = None) -> DataFrame:
    """Keep rows of ``year`` (or of any year) and add the STRING partition value."""
    if year is None:
        kept = df.where(year_expr.isNotNull())
    else:
        cond = year_expr == F.lit(year)
        kept = df.where(pushable & cond if pushable is not None else cond)
    return kept.withColumn("year", year_expr.cast("string"))


def ods_billing(stg: DataFrame, year: int | None = None) -> DataFrame:
    """Q01: period 'YYYY-MM' -> first-of-month DATE, amount text -> INT,
    created_at -> DATE; filtered by the year of created_at."""
    typed = stg.select(
        F.col("user_id").cast("int").alias("user_id"),
        C.period_to_date("billing_period").alias("billing_period"),
        "service", "tariff",
        C.text_to_int("sum").alias("sum"),
        C.text_to_date("created_at").alias("created_at"),
        D.text_year("created_at").alias("_y"),
    )
    return _by_year(typed, F.col("_y"), year).drop("_y")


def ods_issue(stg: DataFrame, year: int | None = None) -> DataFrame:
    """Q02: user id text -> INT, start/end text -> TIMESTAMP; by year of start_time."""
    typed = stg.select(
        C.text_to_int("user_id").alias("user_id"),
        C.text_to_timestamp("start_time").alias("start_time"),
        C.text_to_timestamp("end_time").alias("end_time"),
        "title", "description", "service",
        D.text_year("start_time").alias("_y"),
    )
    return _by_year(typed, F.col("_y"), year).drop("_y")


def _typed_payment(stg: DataFrame) -> DataFrame:
    """Text columns are parsed (the lake's files); columns that are already
    typed (the warehouse's external table) are only cast."""
    kind = dict(stg.dtypes)

    def typed(column: str, parse, as_type: str) -> Column:
        return parse(column) if kind[column] == "string" else F.col(column).cast(as_type)

    return stg.select(
        F.col("user_id").cast("int").alias("user_id"),
        "pay_doc_type",
        F.col("pay_doc_num").cast("int").alias("pay_doc_num"),
        "account", "phone",
        typed("billing_period", C.period_to_date, "date").alias("billing_period"),
        typed("pay_date", C.text_to_date, "date").alias("pay_date"),
        C.to_money("sum").alias("sum"),
    )


def ods_payment(stg: DataFrame, year: int | None = None) -> DataFrame:
    """Q03: period and pay_date -> DATE, amount DOUBLE -> DECIMAL(10,2); by year of pay_date."""
    typed = _typed_payment(stg)
    return _by_year(typed, F.year("pay_date"), year)


def ods_traffic(stg: DataFrame, year: int | None = None) -> DataFrame:
    """Q04: epoch milliseconds -> TIMESTAMP; filtered by its (UTC) year.

    The exact filter truncates ms/1000 toward zero; a millisecond range that
    contains it is ANDed in so Parquet row groups outside the year are skipped.
    """
    pushable = None
    if year is not None:
        pushable = D.epoch_ms_in_year("timestamp", year)
    typed = stg.where(pushable) if pushable is not None else stg
    typed = typed.select(
        "user_id",
        D.epoch_ms_to_timestamp("timestamp").alias("timestamp"),
        "device_id", "device_ip_addr", "bytes_sent", "bytes_received",
        D.epoch_ms_year("timestamp").alias("_y"),
    )
    return _by_year(typed, F.col("_y"), year).drop("_y")


def ods_payment_copy(stg: DataFrame) -> DataFrame:
    """Q06: the warehouse's full STG -> ODS copy (``insert ... select *``).

    The external table declares DATE/NUMERIC columns, which are selected by name
    and cast as they are; a table of the lake's text form is parsed.  Rows with a
    NULL pay_date are kept.
    """
    return _typed_payment(stg).select(*S.ODS_PAYMENT.fieldNames())


def ods_payment_reload(ods: DataFrame, stg: DataFrame, year: int) -> DataFrame:
    """Q07: delete the year's rows from ODS, insert the year's rows from STG.

    Written as one DataFrame (other years, untouched, plus the new slice) so a
    sink can swap it in one step: no moment with the year missing.  Rows with
    a NULL pay_date are neither deleted nor inserted.
    """
    cols = S.ODS_PAYMENT.fieldNames()
    keep = ods.select(*cols).where(F.col("pay_date").isNull() | ~D.in_year("pay_date", year))
    fresh = ods_payment_copy(stg).where(D.in_year("pay_date", year))
    return keep.unionByName(fresh)

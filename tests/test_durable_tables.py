"""Tables that outlive a process, safe overwrites, the typed source, undated rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from vaultmart.functions import joins as J
from vaultmart.operators import ods as O
from vaultmart.operators import second_vault as V2
from vaultmart.operators import vault as V
from vaultmart.plans import yearly as Y
from vaultmart.sources import fixtures, schemas as S, sinks
from vaultmart.sources.lake import scan

SF = "/root/testdata/sf0.001"


def typed(spark, data):
    return spark.createDataFrame(data, S.STG_PAYMENT_TYPED)


PAID = [(1, "F", 1, "A", "p", dt.date(1998, 3, 1), dt.date(1998, 3, 9), Decimal("1.50")),
        (2, "F", 2, "A", "p", dt.date(1999, 3, 1), None, Decimal("2.50"))]


def test_typed_source_keeps_its_period(spark):
    got = O.ods_payment_copy(typed(spark, PAID))
    assert rows(got) == rows(typed(spark, PAID)) and got.schema == S.ODS_PAYMENT
    stale = got.withColumn("sum", F.lit(9).cast(S.MONEY))
    reloaded = rows(O.ods_payment_reload(stale, typed(spark, PAID), 1998), "user_id", "billing_period", "sum")
    assert reloaded == [(1, dt.date(1998, 3, 1), Decimal("1.50")), (2, dt.date(1999, 3, 1), Decimal("9.00"))]


def test_undated_rows_reach_the_second_vault_only(spark):
    ods = O.ods_payment_copy(typed(spark, PAID))
    assert V.payment_stage(ods).count() == 1
    assert V2.payment_stage_v2(ods, "2002-01-01 00:00:00").count() == 2
    with pytest.raises(ValueError):
        V.payment_stage(ods, undated=True)


def test_no_customer_is_left_out(spark):
    customers = spark.read.parquet(f"{SF}/customer.parquet").count()
    assert fixtures.mdm_user(spark, SF).count() == customers


def year_rows(spark, root, year):
    return rows(scan(spark, "ods_payment", root).where(F.col("year") == str(year)), "user_id")


def test_a_failed_overwrite_leaves_the_year(spark, tmp_dir):
    root = f"{tmp_dir}/ods"
    ods = O.ods_payment(typed(spark, PAID + [(3, "F", 3, "A", "p", None, dt.date(1997, 1, 1), None)]))
    sinks.overwrite_partitions(ods, root, "ods_payment")
    bad = ods.withColumn("user_id", F.when(F.col("user_id") > 0, F.raise_error("broken").cast("int")))
    with pytest.raises(Exception, match="broken"):
        sinks.overwrite_partition(bad, root, 1998, "ods_payment")
    assert year_rows(spark, root, 1998) == [(1,)]
    # a backfill without 1997 empties it only if it is a whole one
    sinks.overwrite_partitions(ods.where("year = '1998'"), root, "ods_payment")
    assert year_rows(spark, root, 1997) == [(3,)]
    sinks.overwrite_partitions(ods.where("year = '1998'"), root, "ods_payment", whole=True)
    assert year_rows(spark, root, 1997) == [] and year_rows(spark, root, 1998) == [(1,)]


def test_a_reopened_vault_goes_on_where_it_was(spark, tmp_dir):
    ods = O.ods_payment_copy(fixtures.stg_payment(spark, SF)).cache()

    def load(vault, years):
        for year in years:
            Y.run_vault_year(ods, vault, year)

    load(Y.Vault.open(spark, tmp_dir, "dv_"), [1995, 1996])
    again = Y.Vault.open(spark.newSession(), tmp_dir, "dv_")
    assert again.hub_user.read().count() > 0 and again.bounds["hub_user"] == again.hub_user.read().count()
    load(again, [1997])
    whole = Y.Vault.empty(spark)
    load(whole, [1995, 1996, 1997])
    for name in again.bounds:
        assert rows(getattr(again, name).read()) == rows(getattr(whole, name).read()), name


def test_broadcast_limit_is_in_bytes(spark):
    df = spark.createDataFrame([("k", 1)], "pk string, n long")
    spark.conf.set(J.MAX_BYTES_CONF, str(96 * 5))
    try:
        assert J.broadcast_limit(df) == 5
    finally:
        spark.conf.unset(J.MAX_BYTES_CONF)

"""Sinks and scans (S1-S5, S10) and the ODS slice reload (Q07)."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.helpers import rows
from vaultmart.operators import ods as O
from vaultmart.plans import yearly as Y
from vaultmart.sources import fixtures, sinks
from vaultmart.sources.lake import scan, scan_year


def _ods(spark):
    return O.ods_payment(fixtures.raw(spark, SF_SMALL, "stg_payment"))


def test_overwrite_partition_leaves_other_years(spark, tmp_dir):
    root = tmp_dir + "/ods_payment"
    ods = _ods(spark)
    sinks.overwrite_partitions(ods, root, "ods_payment")
    before = {y: scan_year(spark, "ods_payment", root, y).count() for y in range(1995, 2002)}
    assert sum(before.values()) == ods.count()
    # replace 1996 with only its first 10 rows' worth (a smaller slice)
    smaller = ods.where(F.col("year") == "1996").orderBy("pay_doc_num").limit(10)
    sinks.overwrite_partition(smaller, root, 1996, "ods_payment")
    after = {y: scan_year(spark, "ods_payment", root, y).count() for y in range(1995, 2002)}
    assert after[1996] == 10
    assert {y: n for y, n in after.items() if y != 1996} == \
           {y: n for y, n in before.items() if y != 1996}
    # an empty result empties the partition (Hive INSERT OVERWRITE ... PARTITION)
    sinks.overwrite_partition(ods.limit(0), root, 1996, "ods_payment")
    assert scan_year(spark, "ods_payment", root, 1996).count() == 0
    assert scan(spark, "ods_payment", root).schema["year"].dataType.simpleString() == "string"


def test_partition_scan_prunes(spark, tmp_dir):
    root = tmp_dir + "/ods_payment"
    sinks.overwrite_partitions(_ods(spark), root, "ods_payment")
    plan = scan_year(spark, "ods_payment", root, 1997)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(year" in plan


def test_lake_year_run_writes_ods_and_mart(spark, tmp_dir):
    stg = {n: fixtures.raw(spark, SF_SMALL, n)
           for n in ("stg_billing", "stg_issue", "stg_payment", "stg_traffic")}
    Y.run_lake_year(stg, tmp_dir, 2024)
    traffic = scan(spark, "ods_traffic", tmp_dir + "/ods_traffic")
    mart = scan(spark, "dm_bytes_received", tmp_dir + "/dm_bytes_received")
    assert traffic.count() == 345  # FIXTURES.md: stg_traffic rows of 2024 at sf0.001
    assert traffic.agg(F.sum("bytes_received")).first()[0] == 17205112
    assert mart.count() == 15
    assert scan(spark, "ods_billing", tmp_dir + "/ods_billing").count() == 0  # no 2024 billing


def test_reload_replaces_only_the_year(spark):
    stg = fixtures.raw(spark, SF_SMALL, "stg_payment")
    ods = O.ods_payment_copy(stg)
    # an ODS whose 1997 rows are stale (amounts zeroed) plus a NULL-dated row
    stale = ods.withColumn("sum", F.when(F.year("pay_date") == 1997, F.lit(0).cast("decimal(10,2)"))
                           .otherwise(F.col("sum")))
    stale = stale.unionByName(ods.limit(1).withColumn("pay_date", F.lit(None).cast("date")))
    out = O.ods_payment_reload(stale, stg, 1997)
    assert rows(out.where(F.year("pay_date") == 1997)) == rows(ods.where(F.year("pay_date") == 1997))
    assert rows(out.where(F.year("pay_date") != 1997)) == rows(stale.where(F.year("pay_date") != 1997))
    assert out.where(F.col("pay_date").isNull()).count() == 1


def test_fixture_raw_counts(spark):
    pay = fixtures.raw(spark, SF_SMALL, "stg_payment")
    assert pay.count() == 1500
    assert pay.where(F.col("account").isNull()).count() == 15
    assert pay.where(F.col("phone") == "").count() == 137
    mdm = fixtures.raw(spark, SF_SMALL, "mdm_user")
    assert mdm.count() == 150 and mdm.where(F.col("legal_type").isNull()).count() == 6


def test_lake_backfill_equals_yearly_runs(spark, tmp_dir):
    stg = {n: fixtures.raw(spark, SF_SMALL, n)
           for n in ("stg_billing", "stg_issue", "stg_payment", "stg_traffic")}
    Y.run_lake_backfill(stg, tmp_dir + "/all")
    for year in (2024, 2025, 2026):
        Y.run_lake_year(stg, tmp_dir + "/yearly", year)
    for table in ("ods_traffic", "dm_bytes_received"):
        once = scan(spark, table, f"{tmp_dir}/all/{table}")
        yearly = scan(spark, table, f"{tmp_dir}/yearly/{table}")
        assert rows(once) == rows(yearly), table
    counts = {r["year"]: r["count"] for r in
              scan(spark, "ods_traffic", tmp_dir + "/all/ods_traffic").groupBy("year").count().collect()}
    assert counts == {"2024": 345, "2025": 333, "2026": 322}   # FIXTURES.md


def test_glob_scan_of_several_directories(spark, tmp_dir):
    stg = fixtures.raw(spark, SF_SMALL, "stg_payment")
    stg.where("pay_date < '1998'").write.parquet(tmp_dir + "/payment/a")
    stg.where("pay_date >= '1998'").write.parquet(tmp_dir + "/payment/b")
    df = scan(spark, "stg_payment", tmp_dir + "/payment/*/")
    assert df.count() == 1500 and df.schema == fixtures.S.STG_PAYMENT
